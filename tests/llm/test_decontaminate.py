import random
from collections import Counter

import numpy as np

from ledgerloom.llm import decontaminate as D


def normal(text):
    return "".join(c if c.isalnum() or ord(c) > 126 or ord(c) <= 32 else " " for c in (text or "").lower()).split()


def brute(docs, items, least=0.8):
    out = {}
    for row, (i, text) in enumerate(docs):
        w = normal(text)
        for item, t in items:
            x = normal(t)
            k = min(5, len(x))
            if not x:
                continue
            bag = Counter(tuple(x[j : j + k]) for j in range(len(x) - k + 1))
            for a in range(len(w) - len(x) + 1):
                own = Counter(tuple(w[a + j : a + j + k]) for j in range(len(x) - k + 1))
                score = D.weighted_similarity(own, bag)
                if score >= least:
                    out[row, i, item] = max(out.get((row, i, item), 0), score)
    return sorted((str(i), item, round(s, 9)) for (_, i, item), s in out.items())


def tables():
    draw = random.Random(4)
    sentence = lambda n: " ".join(f"w{draw.randint(0, 400)}" for _ in range(n))
    items = [(i, sentence(draw.randint(15, 60))) for i in range(25)] + [(90, "Two words"), (91, ""), (92, None), (93, "a b c d a b c d a b c d"), (None, sentence(20))]
    docs = [(None, items[0][1]), (1, None), (2, ""), (3, "x two WORDS, y"), (4, "a b c d " * 8)]
    for i in range(60):
        body = sentence(draw.randint(0, 120)).split()
        inserted = (items[draw.randrange(25)][1]).split()
        if i % 3 == 1:
            inserted = inserted[draw.randint(0, 3) :]
        if i % 3 == 2:
            inserted[0] = "changed"
        if i % 2:
            body[len(body) // 2 : len(body) // 2] = inserted
        docs.append((10 + i // 2, ", ".join(body).upper() if i % 4 == 1 else " ".join(body)))
    return docs, items


def test_against_brute_force(spark):
    docs, items = tables()
    df = spark.createDataFrame([(*d, 1.5) for d in docs], "doc_id long, text string, similarity double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, round(r.similarity, 9)) for r in D.matches(df, bench).collect())
    want = brute(docs, items)
    key = lambda r: (r[0], str(r[1]), r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    hit = Counter(i for i, *_ in {(row, i) for row, (i, t) in enumerate(docs) for _ in [0] if brute([(i, t)], items)})
    assert kept.count() == len(docs) - sum(hit.values())
    assert D.matches(df.limit(0), bench).count() == 0 and D.drop_contaminated(df, bench.limit(0)).count() == df.count()


def brute_short(docs, items, least=0.8):
    """``brute``, and a text shorter than an item as its one window."""
    out = brute(docs, items, least)
    for i, text in docs:
        w = normal(text)
        for item, t in items:
            x = normal(t)
            k = min(5, len(x))
            if len(w) < len(x):
                bags = [Counter(tuple(v[j : j + k]) for j in range(len(v) - k + 1)) for v in (w, x)]
                if (score := D.weighted_similarity(*bags)) >= least:
                    out.append((str(i), item, round(score, 9)))
    return sorted(out, key=str)


def test_texts_shorter_than_an_item(spark):
    draw = random.Random(7)
    items = [(i, " ".join(f"w{draw.randint(0, 400)}" for _ in range(draw.randint(15, 60)))) for i in range(20)]
    items += [(30, items[0][1] + " and more words"), (31, "a b c d " * 6), (32, "v w x y"), (33, "")]
    docs = [(90, items[0][1]), (91, "a b c d " * 5), (92, "v w x"), (93, ""), (94, None), (95, "b c d a")]
    for i in range(100):
        w = items[i % 20][1].split()
        for _ in range(draw.randint(1, 9)):
            w.pop(draw.choice([0, -1, -1, draw.randrange(len(w))]))
        docs.append((i % 80, " ".join(w)))
    docs.append((96, " ".join(max((t for _, t in items), key=len).split()[:-2])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((str(r.doc_id), r.item_id, round(r.similarity, 9)) for r in D.matches(df, bench).collect()), key=str)
    want = brute_short(docs, items)
    assert got == want and len(want) > len(brute(docs, items)) + 30
    assert D.drop_contaminated(df, bench).count() == sum(not brute_short([d], items) for d in docs)


def test_index_finds_all_within_radius():
    draw = np.random.default_rng(1)
    items = draw.integers(0, 2**63, 50, dtype=np.uint64)
    queries = items[draw.integers(0, 50, 300)]
    for _ in range(14):
        queries = queries ^ (np.uint64(1) << draw.integers(0, 64, 300).astype(np.uint64))
    index = D.HammingIndex(items, 15)
    got = set(zip(*(v.tolist() for v in index.search(queries))))
    assert got == {(q, i) for q in range(300) for i in range(50) if int(queries[q] ^ items[i]).bit_count() <= 15}


def test_repeated_items_are_one(spark):
    text = " ".join(f"w{i}" for i in range(30))
    items = spark.range(9_000).selectExpr("1L AS item_id", f"'{text}' AS text")
    docs = spark.createDataFrame([(1, text), (2, "other words")], "doc_id long, text string")
    assert len(list(D._blocks(items, "item_id", "text", D.RADIUS))) == 1
    assert [(r.doc_id, r.item_id) for r in D.matches(docs, items).collect()] == [(1, 1)]
