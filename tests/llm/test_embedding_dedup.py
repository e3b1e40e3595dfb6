import math

import numpy as np
import pytest

from brute import components
from ledgerloom.llm import embedding_dedup as E


def cosine(a, b):
    top = max(abs(x) for x in a), max(abs(x) for x in b)
    a, b = [x / top[0] for x in a], [x / top[1] for x in b]
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))


def brute(rows, least=0.93):
    """Row by row, as ``(id, links, component, kept)``."""
    sound = [r for r, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    near = {(a, b) for a in sound for b in sound if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]) and cosine(rows[a][1], rows[b][1]) >= least}
    root = components(range(len(rows)), lambda a, b: (a, b) in near)
    out = []
    for r, (i, _, _) in enumerate(rows):
        links = sum(r in pair for pair in near)
        group = [rows[x][0] for x in range(len(rows)) if root[x] == root[r]]
        least_id = None if i is None else min(group)
        out.append((i, links, least_id, None if i is None else i == least_id))
    return out


def given(dims, seed, n=40):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        center = rng.normal(size=dims)
        for spread in rng.choice([0.0, 0.05, 0.25, 0.4], rng.integers(1, 9)):
            rows.append((rng.normal(size=dims) * spread + center) * rng.choice([1e-30, 1.0, 1e30]))
    ids = rng.permutation(len(rows)).tolist()
    rows = [(i, r.tolist(), int(rng.choice([1, 1, 1, 2]))) for i, r in zip(ids, rows)]
    special = [(5000, None, 1), (5001, [0.0] * dims, 1), (5002, [None] * dims, 1), (5003, [math.nan] * dims, 1), (5004, [math.inf] * dims, 1), (5005, rows[0][1], None), (None, rows[0][1], rows[0][2])]
    special += [rows[3], rows[3], (rows[4][0], rows[3][1], rows[3][2]), (5006, [1.0, 2.0], 1), (5007, [2.0, 4.1], 1), (5008, [], 1)]
    return rows + special


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, lab, "x", 7) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, kept string, n_links int").repartition(3)
    out = E.near_vectors(df, **options)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("dims,options", [
    (12, {}), (40, {"lists": 6, "margin": 10.0}), (40, {"lists": 6, "margin": 10.0, "piece": 3, "visits": 7}), (40, {"lists": 1}), (40, {"lists": 9, "margin": math.sqrt(0.14), "piece": 5}),
])
def test_equals_brute_force(spark, dims, options):
    rows = given(dims, dims)
    assert run(spark, rows, **options) == sorted(brute(rows), key=str)


def test_default_margin_finds_pairs(spark):
    rows = given(64, 3, 120)
    got, want = (dict((r[0], r[1]) for r in x if r[0] is not None and r[0] < 5000) for x in (run(spark, rows, lists=24), brute(rows)))
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.99 * sum(want.values()) > 200


def test_recall_at_the_threshold():
    # Pairs at exactly the threshold, the hardest ones, that either side's visits find.
    rng = np.random.default_rng(8)
    points = E.unit(rng.normal(size=(6000, 64)))
    q = E.Quantiser(points, 40)
    aside = rng.normal(size=points.shape)
    aside = E.unit(aside - (aside * points).sum(axis=1, keepdims=True) * points)
    other = 0.93 * points + math.sqrt(1 - 0.93**2) * aside
    (own_a, a), (own_b, b) = q.visits(points), q.visits(other)
    at = np.arange(len(points))
    assert (a[at, own_b] | b[at, own_a]).mean() >= 0.999
    assert a.sum(axis=1).mean() < 25


def test_no_member_within_reach_is_pruned():
    rng = np.random.default_rng(2)
    points = E.unit(np.repeat(rng.normal(size=(40, 32)), 10, axis=0) + rng.normal(size=(400, 32)) * 0.2)
    q = E.Quantiser(points, 5)
    codes, error = q.code(points - q.centers[0])
    near = points @ points.T >= 0.93
    passed = q.look_up(points - q.centers[0], codes) <= q.reach + error + 1e-6
    assert near.sum() > 1000 and (passed | ~near).all() and passed.mean() < 0.5


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1)]) == [(1, 0, 1, True)]
