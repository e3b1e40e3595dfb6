import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np

from brute import words
from ledgerloom.llm import filter_audit as A


def brute(docs, labels):
    """Counts by running every order over every document."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, part in docs:
        t, w = text or "", words(text)
        fails = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and least[t] < i]
        parts[part or ""].append((i, {f for f, failed in zip("ABCDE", fails) if failed}))
    out = {}
    for part, rows in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = list(rows)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                earlier = sum(f in r[1] for r in rows) - len(gone)
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), earlier, sum(r[1] == {f} for r in rows), sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return {(*k, *v) for k, v in out.items()}


def given():
    draw = random.Random(5)
    texts = [" ".join(f"{draw.choice(['w', 'W', 'É'])}{draw.randint(0, n)}" for _ in range(size)) + end for size in (50, 99, 100, 130) for n in (20, 90, 9000) for end in ("", " #", "\x85|\x1c")]
    texts += [None, "", " \t", "a" * 300_000, "A " * 40_000]
    docs = [(i, draw.choice(texts), draw.choice(["en", "de", None, ""])) for i in range(300)]
    docs += [(7, docs[7][1], docs[7][2])] * 3 + [(7, "other", "en"), (None, docs[3][1], "en"), (None, None, None), (-5, docs[9][1], "fr")]
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    return docs, labels


def test_counts(spark):
    docs, labels = given()
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, lang string, mask int, n int").repartition(5)
    marks = spark.createDataFrame([(*x, "x") for x in labels], "doc_id long, quality int, toxic int, part string")
    out = A.interactions(frame, marks)
    assert out.columns == ["part", "filter_order", "step", *A.MEASURES]
    rows = out.collect()
    assert len(rows) == len({r[:3] for r in rows}) and set(map(tuple, rows)) == brute(docs, labels)
    assert A.interactions(frame.limit(0), marks).count() == 0
    assert A.interactions(frame, marks.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_removal_steps():
    orders, steps = A.removal_steps(4)
    for mask in range(16):
        for o, order in enumerate(orders):
            assert steps[mask, o] == min([p for p, f in enumerate(order) if mask >> f & 1], default=4)


def test_every_failing_document_is_removed_once():
    weights = np.array([[3, 5, 2, 4], [1, 0, 2, 1], [0, 0, 1, 0]])
    _, counts = A.audit(np.array([0, 1, 6, 31]), weights)
    removed = counts[:, :, A.MEASURES.index("removed")]
    assert (removed.sum(axis=1) == 11).all() and (counts[:, -1, 0] == 3).all()
