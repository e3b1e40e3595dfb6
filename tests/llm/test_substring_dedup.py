import hashlib
import random

import numpy as np
import pytest

from brute import removed, words
from ledgerloom.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, print string, id int, __spans string"


def rows_with_shared_passages(seed, n=60):
    draw = random.Random(seed)
    common = " ".join(f"p{i}" for i in range(40))
    rows = [(None, common, "x", 1, None), (7, None, None, None, None), (8, "", "x", 1, ""), (9, " \t\n", "x", 1, "")]
    for i in range(n):
        body = [draw.choice("abcdefgh") + str(draw.randint(0, 9)) for _ in range(draw.randint(0, 60))]
        at = draw.randint(0, len(body))
        if i % 3 == 0:
            body[at:at] = common.split()
        rows.append((draw.randint(10, 60), draw.choice([" ", "\n", "  ", "\x0b"]).join(body), "x", i, "s"))
    rows += [(100, "same " * 40, "", 0, ""), (101, "same " * 30, "", 0, ""), (102, rows[10][1], "", 0, ""), (102, rows[10][1], "", 0, "")]
    return rows


def expected(rows):
    docs = [(r[0], r[1]) for r in rows]
    out = []
    for (i, text), gone in zip(docs, removed(docs)):
        w = words(text)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["3", "64"])
def test_against_brute_force(spark, partitions):
    # With 64 partitions the shared passage is hot and takes the aggregated way.
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = rows_with_shared_passages(3)
        df = spark.createDataFrame(rows, SCHEMA)
        hot = S._hot_minimisers(df.selectExpr("text").na.drop(), 13, 3, int(partitions))
        assert (len(hot) > 0) == (partitions == "64")
        assert sorted(map(tuple, S.digests(df).collect()), key=str) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cut_keeps_clean_text_and_columns(spark):
    rows = rows_with_shared_passages(5)
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.cut_repeats(df)
    assert out.columns == df.columns
    got = sorted(map(tuple, out.collect()), key=str)
    want = []
    for row, gone in zip(rows, removed([(r[0], r[1]) for r in rows])):
        w = words(row[1])
        if not gone:
            want.append(row)
        elif len(gone) < len(w):
            want.append((row[0], [x for k, x in enumerate(w) if k not in gone], *row[2:]))
    assert len(got) == len(want)
    assert sorted(str(r) for r in got if r in rows) == sorted(str(r) for r in want if isinstance(r[1], (str, type(None))))
    assert sorted(str((r[0], words(r[1]))) for r in got if r not in rows) == sorted(str((r[0], r[1])) for r in want if isinstance(r[1], list))


def test_empty_table(spark):
    assert S.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_windows_with_equal_hashes_are_told_apart():
    tokens = np.array([0, 1, 2, 0, 1, 3, 0, 1, 2])
    order, group = S._equal_windows(tokens, np.array([0, 3, 6]), np.zeros(3, np.uint64), 3)
    groups = dict(zip(order.tolist(), group.tolist()))
    assert groups[0] == groups[2] != groups[1]
