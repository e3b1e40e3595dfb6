import random
from collections import Counter

import pyarrow as pa

from brute import words
from ledgerloom.llm import quality_rules as R


def covered(w, k):
    found = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    places = set()
    for i in range(len(w) - k + 1):
        if found[tuple(w[i : i + k])] > 1:
            places.update(range(i, i + k))
    return len(places)


def texts():
    draw = random.Random(1)
    out = [None, "", " ", "a", "a b\x0b c é x\n\n", "a " * 700]
    out += [" ".join(draw.choice("abc") for _ in range(draw.randint(0, 70))) + draw.choice(["", "\n", " "]) for _ in range(150)]
    out += [" ".join([f"w{i}" for i in range(200)] + [f"t{i}" for i in range(20)] * 2)] * 2
    return out


def test_measures_against_brute_force():
    given = texts()
    got = R.measure(pa.array(given), 8)
    for i, text in enumerate(given):
        w = words(text)
        assert got["n_words"][i] == len(w)
        assert got["word_chars"][i] == sum(map(len, w))
        assert got["n_repeat_words"][i] == covered(w, 8)
        assert got["longest_repeat"][i] == max((k for k in range(8, len(w)) if covered(w, k)), default=0)


def test_lines_and_symbols():
    got = R.measure(pa.array(["a\nb\na\n\n\n a\n#$ x<", "a\x0b\na", None]), 8)
    assert got["n_dup_lines"].tolist() == [1, 0, 0]
    assert got["n_symbols"].tolist() == [3, 0, 0]


def test_keep_clean_with_clashing_columns(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    long_repeat = " ".join([f"u{i}" for i in range(101)] * 2 + [f"v{i}" for i in range(900)])
    rows = [(1, clean, 5), (1, clean, 5), (2, "short", 5), (3, None, None), (4, "a b c d " * 30, 5), (5, clean + " ####" * 9, 5), (None, clean, 5), (6, long_repeat, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    out = R.keep_clean(df)
    assert out.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in out.collect()))) == ["1", "1", "None"]
    assert R.keep_clean(df.limit(0)).count() == 0
