import random

import pytest

from ledgerloom.llm import token_counts as T


@pytest.mark.parametrize("block", [7, 64, 1 << 18])
def test_counts_against_the_tokenizer(spark, block):
    draw = random.Random(1)
    texts = [None, "", " ", "<|endoftext|> x", "é" * 50] + [" ".join(draw.choice(["the", "zebra", "ß", "12", "\n"]) for _ in range(draw.randint(0, 200))) for _ in range(60)]
    rows = [(i if i % 9 else None, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, block int").repartition(3)
    encode = T.load_tokenizer(T.TOKENIZER).encode_ordinary
    got = sorted(map(str, map(tuple, T.token_counts(df, block_tokens=block).collect())))
    assert got == sorted(str((i, len(encode(t or "")))) for i, t, _ in rows)


def test_empty_table(spark):
    assert T.token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
