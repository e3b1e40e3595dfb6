import hashlib
import math
import random

import numpy as np
import pytest

from ledgerloom.llm import code_compression as C


def brute(rows, entries=256):
    """The contract with plain integers and loops."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    grid = [[math.floor(1024 * float(x)) for x in v] for _, v, _ in kept]
    if not kept:
        return []
    w = len(grid[0]) // 4
    codes, errors, spelled = [[] for _ in kept], [0] * len(kept), []
    for p in range(4):
        part = [g[p * w : p * w + w] for g in grid]
        book = [list(x) for x in part[:entries]]

        def nearest(x):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
        for _ in range(4):
            own = [nearest(x)[1] for x in part]
            for k in range(len(book)):
                mine = [x for x, o in zip(part, own) if o == k]
                if mine:
                    book[k] = [sum(c) // len(mine) for c in zip(*mine)]
        for r, x in enumerate(part):
            gap, k = nearest(x)
            codes[r].append(f"{k:02x}")
            errors[r] += gap
        spelled += [str(x) for e in book for x in e]
    digest = hashlib.sha256(",".join(spelled).encode()).hexdigest()
    total = {lab: sum(e for e, r in zip(errors, kept) if r[2] == lab) for lab in {r[2] for r in kept}}
    return [(r[0], "".join(c), e, total[r[2]], digest) for r, c, e in zip(kept, codes, errors)]


def given(n, width, seed):
    draw = random.Random(seed)
    centers = [[draw.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = draw.choice(centers)
        v = [x + draw.choice([0, 0.001, 0.2]) * draw.uniform(-1, 1) for x in c]
        rows.append((draw.randint(0, 10**6), v, draw.choice([1, 2, None])))
    rows += rows[:5] + [(None, rows[0][1], 1), (None, rows[3][1], None)]
    rows += [(9, None, 1), (10, [None] * width, 1), (11, [math.nan] * width, 2), (12, [math.inf] + [0.0] * (width - 1), 2)]
    return rows


@pytest.mark.parametrize("n,width", [(700, 8), (40, 16)])
def test_compress(spark, n, width):
    rows = given(n, width, n)
    df = spark.createDataFrame([(i, v, lab, "x", 0) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(3)
    out = C.compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(brute(rows), key=str)


def test_nothing_usable(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [None], 2)], "vec_id long, embedding array<float>, label int")
    assert C.compress(df).count() == 0 and C.compress(df.limit(0)).count() == 0


def test_uneven_vectors_are_refused(spark):
    with pytest.raises(ValueError):
        C.integers([[1.0] * 4, [1.0] * 8])
    with pytest.raises(ValueError):
        C.integers([[1.0] * 6])


def points(kind, rng):
    base = rng.integers(-500, 500, (20, 6))
    if kind == "copies":
        return base[rng.integers(0, 20, 900)]
    if kind == "clusters":
        return base[rng.integers(0, 20, 900)] + rng.integers(-3, 4, (900, 6))
    if kind == "large":
        return rng.integers(-(2**27), 2**27, (60, 6))
    return rng.integers(-500, 500, (900, 6))


@pytest.mark.parametrize("kind", ["copies", "clusters", "large", "even"])
def test_tree_gives_exact_sums(kind):
    rng = np.random.default_rng(4)
    p = points(kind, rng)
    tree = C.build_tree(p)
    assert sorted(tree.order) == list(range(len(p)))
    for s, e, c, r, child, children in zip(tree.start, tree.end, tree.center, tree.radius, tree.child, tree.children):
        run = tree.order[s:e]
        assert c in run and np.sqrt(((p[run] - p[c]) ** 2).sum(axis=1)).max() <= r + 1e-6
        if children:
            # Children cover the run, and their centres are more than half the radius apart.
            kids = range(child, child + children)
            assert tree.start[child] == s and tree.end[child + children - 1] == e and all(tree.radius[k] <= r / 2 for k in kids)
            at = p[tree.center[list(kids)]]
            apart = np.sqrt(((at[:, None] - at[None]) ** 2).sum(axis=2))
            assert (apart[~np.eye(len(at), dtype=bool)] > r / 2).all()
    entries = np.concatenate([p[:30], p[:10], p[5:6] + 1])
    code, sums, counts = C.assign(p, tree, entries)
    gaps = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, e)) for e in entries] for x in p]
    assert code.tolist() == [g.index(min(g)) for g in gaps]
    assert counts.tolist() == np.bincount(code, minlength=len(entries)).tolist()
    assert all((sums[k] == p[code == k].sum(axis=0)).all() for k in range(len(entries)))


def test_clusters_are_assigned_whole(monkeypatch):
    p, base = points("clusters", np.random.default_rng(4)), np.random.default_rng(4).integers(-500, 500, (20, 6))
    tree, compared = C.build_tree(p), []
    plain = C.squared
    monkeypatch.setattr(C, "squared", lambda a, b: compared.append(len(a)) or plain(a, b))
    code = C.assign(p, tree, base)[0]
    assert sum(compared) < len(p) / 10 and len(set(code)) == 20
