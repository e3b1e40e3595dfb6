import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import packing as P

LENGTHS = (8, 16, 64)


def sound(sizes, home, position, capacity, lengths):
    filled = defaultdict(list)
    for s, h, p, c in zip(sizes, home, position, capacity):
        filled[h].append((p, s, c))
    for pieces in filled.values():
        at = 0
        for p, s, _ in sorted(pieces):
            assert p == at
            at += s
        assert {c for *_, c in pieces} == {min(n for n in lengths if n >= at)}
    return filled


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_every_piece_has_its_place(sizes):
    sizes.sort(reverse=True)
    filled = sound(sizes, *P.best_fit(sizes, LENGTHS, 2), LENGTHS)
    assert sum(len(v) for v in filled.values()) == len(sizes)


def test_close_to_the_best():
    draw = random.Random(2)
    sizes = sorted((draw.randint(1, 40) for _ in range(500)), reverse=True)
    filled = sound(sizes, *P.best_fit(sizes, LENGTHS, 2), LENGTHS)
    assert sum(v[0][2] for v in filled.values()) <= 1.03 * sum(sizes)


def test_least_cost_length_is_opened():
    # Alone, a short piece takes the short length; with company the overhead favours the long one.
    assert P.best_fit([5], LENGTHS, 2)[2] == [8]
    assert set(P.best_fit([8] * 8, LENGTHS, 8)[2]) == {64}


def plain_best_fit(sizes, lengths, overhead):
    """Capacity and content of each sequence, by looking at every open sequence and every waiting piece."""
    open_, waiting = [], list(sizes)
    while waiting:
        size = waiting.pop(0)
        fitting = [s for s in open_ if s[0] - s[1] >= size]
        if fitting:
            min(fitting, key=lambda s: s[0] - s[1])[1] += size
            continue
        best = None
        for length in sorted(lengths):
            if length >= size:
                used = size
                for piece in waiting:
                    if used + piece <= length:
                        used += piece
                cost = (length + overhead) / used
                if best is None or cost < best[0]:
                    best = cost, length
        open_.append([best[1], size])
    return sorted((min(n for n in lengths if n >= used), used) for _, used in open_)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([0, 2, 8, 40]))
def test_against_plain_best_fit(sizes, overhead):
    sizes.sort(reverse=True)
    filled = sound(sizes, *P.best_fit(sizes, LENGTHS, overhead), LENGTHS)
    assert sorted((v[0][2], sum(s for _, s, _ in v)) for v in filled.values()) == plain_best_fit(sizes, LENGTHS, overhead)


def test_equal_rows_spread_over_shards(spark):
    one = spark.range(40_000).selectExpr("CAST(IF(id % 2 = 0, 7, NULL) AS BIGINT) doc_id", "'a b c' text")
    rows = one.unionByName(spark.range(100).selectExpr("id doc_id", "'d e' text"))
    for with_text in (False, True):
        shards = P.pack(rows, with_text=with_text).selectExpr("shiftright(seq_id, 32) shard").groupBy("shard").count().collect()
        assert sum(r["count"] for r in shards) == 40_100 and len(shards) > 5 and max(r["count"] for r in shards) <= 2 * P.SHARD
    assert P.pack(rows, with_text=True).filter("text = 'a b c' AND n_tokens = 4").count() == 40_000


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x1f", max_size=60)), st.integers(1, 5))
def test_pieces_are_the_text(text, greatest):
    pieces = P._cut(text, greatest)
    words = [len([w for w in P.WORD.findall(p.encode())]) for p in pieces]
    assert "".join(pieces) == (text or "") and len(pieces) == sum(words) // greatest + 1
    assert all(n == greatest for n in words[:-1]) and words[-1] == sum(words) % greatest


def test_very_long_text(spark):
    text = "word\n  indented " * 300_000
    got = P.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), with_text=True).orderBy("piece").collect()
    assert "".join(r.text for r in got) == text and sum(r.n_tokens for r in got) == 600_001


def test_pack(spark):
    rows = [(1, "a " * 20, 9), (1, "a " * 20, 9), (2, None, 9), (3, "", 9), (None, "x y", 9), (4, " ".join(f"w{i}" for i in range(200)), 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    got = P.pack(df, lengths=LENGTHS, with_text=True).collect()
    total = defaultdict(int)
    for r in got:
        total[r.doc_id] += r.n_tokens
    assert total == {1: 42, 2: 1, 3: 1, None: 3, 4: 201}
    assert "".join(r.text for r in sorted((r for r in got if r.doc_id == 4), key=lambda r: r.piece)) == rows[-1][1]
    order = sorted(got, key=lambda r: -r.n_tokens)
    sound([r.n_tokens for r in order], [r.seq_id for r in order], [r.position for r in order], [r.capacity for r in order], LENGTHS)
    plain = P.pack(df, lengths=LENGTHS).drop("text").collect()
    assert sorted(map(str, plain)) == sorted(str(r) for r in P.pack(df, lengths=LENGTHS).collect())
    assert P.pack(df.limit(0)).count() == 0
