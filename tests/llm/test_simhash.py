import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from brute import components, words
from ledgerloom.llm import simhash as S
from ledgerloom.session import cut_lineage


def fingerprint(text, k=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(max(1, len(w) - k + 1))] if w else []
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h)) if h else 0


def clustered(n, seed):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        centre = draw.getrandbits(64)
        for _ in range(20):
            x = centre
            for _ in range(draw.randint(0, 4)):
                x ^= 1 << draw.randint(0, 63)
            out.append(x)
    return sorted(set(out))


def test_fingerprints():
    texts = [None, "", " ", "A", "a B", "É x Y\x85z\x0bW q", "a b c " * 9]
    assert [int(x) for x in S.fingerprints(pa.array(texts))] == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 2, 6, 22])
def test_bit_sliced_pairs(radius):
    values = clustered(20, 2)
    keys = np.arange(len(values)) // 170
    got = {p for a, b in S.close_pairs(np.array(values, np.uint64), keys, radius) for p in zip(a.tolist(), b.tolist())}
    assert got == {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if keys[i] == keys[j] and (values[i] ^ values[j]).bit_count() <= radius}


@pytest.mark.parametrize("bucket", [3, 2048])
def test_components_of_fingerprints(spark, bucket):
    values = clustered(15, 4)
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    links = S.fingerprint_links(spark.createDataFrame(signed, "fp long, rep long"), 2, bucket)
    got = {i: i for i in range(len(values))} | dict(map(tuple, S.components(links).collect()))
    assert got == components(range(len(values)), lambda a, b: (values[a] ^ values[b]).bit_count() <= 2)


@pytest.fixture
def late_broadcasts(spark):
    """As with large tables: no side is broadcast when a join is planned, adaptive execution does so later, and tasks stay apart."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_rows_of_a_key_meet_after_a_late_broadcast(spark, late_broadcasts):
    values = clustered(15, 4)
    signed = [(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)]
    links = S.fingerprint_links(cut_lineage(spark.createDataFrame(signed, "fp long, rep long").repartition(4)))
    got = {i: i for i in range(len(values))} | dict(map(tuple, S.components(links).collect()))
    assert got == components(range(len(values)), lambda a, b: (values[a] ^ values[b]).bit_count() <= 2)


def test_long_chain(spark):
    links = spark.range(1, 120).selectExpr("id as a", "id - 1 as b")
    assert set(map(tuple, S.components(links).collect())) == {(i, 0) for i in range(1, 120)}


def rows():
    draw = random.Random(9)
    long = [f"w{draw.randint(0, 300)}" for _ in range(400)]
    near = list(long)
    near[200] = "other"
    out = [(5, " ".join(long), 1), (9, " ".join(long).upper(), 2), (3, "\n".join(near), 3), (None, " ".join(long), 4), (8, None, 5), (7, "", 6), (6, " ", 7), (5, " ".join(long), 1)]
    return out + [(20 + i, " ".join(draw.choice("abcdefghij") * 3 + str(draw.randint(0, 99)) for _ in range(50)), i) for i in range(20)]


def test_near_duplicates(spark):
    given = rows()
    df = spark.createDataFrame(given, "doc_id long, text string, component_id int")
    prints = {i: fingerprint(t) for i, t, _ in given if i is not None}
    root = components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    want = [(i, f"{fingerprint(t):016x}", None if i is None else root[i]) for i, t, _ in given]
    assert sorted(map(tuple, S.near_duplicates(df).collect()), key=str) == sorted(want, key=str)


def changed(count):
    return " ".join([f"q{i}" for i in range(count)] + [f"w{i}" for i in range(count, 300)])


def apart(a, b):
    return (fingerprint(a) ^ fingerprint(b)).bit_count()


def test_links_are_between_fingerprints_and_not_between_ids(spark):
    texts = [changed(n) for n in range(40)]
    near, other = next((a, b) for a in texts for b in texts if 0 < apart(a, b) <= 2)
    draw = random.Random(4)
    two, three = (" ".join(f"w{draw.randint(0, 5000)}" for _ in range(80)) for _ in range(2))
    # Id 7 has two texts that do not link; only one of them stands with id 3.
    given = [(7, near, 3), (7, two, 7), (3, other, 3), (9, two, 7), (12, three, 12)]
    got = S.near_duplicates(spark.createDataFrame([g[:2] for g in given], "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == sorted((i, f"{fingerprint(t):016x}", c) for i, t, c in given)


def test_rows_without_id_link_others(spark):
    texts = [changed(n) for n in range(60)]
    a, b, c = next((a, b, c) for a in texts for b in texts if 0 < apart(a, b) <= 2 for c in texts if 0 < apart(b, c) <= 2 < apart(a, c))
    df = spark.createDataFrame([(1, a), (None, b), (2, c)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in S.near_duplicates(df).collect()} == {1: 1, None: None, 2: 1}


def test_keep_one(spark):
    given = rows()
    df = spark.createDataFrame(given, "doc_id long, text string, component_id int")
    out = S.keep_one(df)
    assert out.columns == df.columns
    prints = {i: fingerprint(t) for i, t, _ in given if i is not None}
    root = components(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(["None", *[str(i) for i in set(root.values())]])
    assert S.keep_one(df.limit(0)).count() == 0 and S.near_duplicates(df.limit(0)).count() == 0


def test_keep_one_tells_texts_of_one_id_apart(spark):
    draw = random.Random(6)
    one, two, three = (" ".join(f"w{draw.randint(0, 5000)}" for _ in range(80)) for _ in range(3))
    given = [(7, one, 1), (7, two, 2), (7, two, 2), (3, one.upper(), 3), (9, three, 4), (9, three.upper(), 5), (12, two, 6), (7, " ", 7)]
    nines = []
    for order in (given, given[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, n int").repartition(3)
        got = sorted(map(tuple, S.keep_one(df).collect()), key=str)
        assert [r for r in got if r[0] != 9] == sorted([(3, one.upper(), 3), (7, two, 2), (7, " ", 7)], key=str)
        nines.append([r for r in got if r[0] == 9])
    assert len(nines[0]) == 1 and nines[0] == nines[1]


def test_radius_is_bounded(spark):
    with pytest.raises(ValueError):
        S.fingerprint_links(spark.createDataFrame([], "fp long, rep long"), 3)
