import hashlib
import math

import numpy as np
import pytest

from tillroll.llm.centroids import Search, cluster, nearest, sequency_order, transform

SCHEMA = "vec_id long, embedding array<double>, cluster string"
LONGEST = (1 << 63) - 1


def slow(rows, k, rounds, dims, scale=1024, seed=3):
    """Plain distances in Python integers."""
    kept = []
    for vec_id, v, *_ in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((vec_id, [max(-LONGEST - 1, min(LONGEST, math.floor(scale * x))) if math.isfinite(scale * x)
                                  else (LONGEST if x > 0 else -LONGEST - 1) for x in v], v))
    known = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), raw, v) for i, v, raw in kept if i is not None)
    centroids = [v for _, _, v in known[:k]]
    if not centroids:
        return []

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v, _ in kept]

    for _ in range(rounds):
        groups = {}
        for (_, j), (_, v, _) in zip(assign(), kept):
            groups.setdefault(j, []).append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centroids)]
    final = assign()
    spent = [sum(d for d, j in final if j == c) for c in range(len(centroids))]
    fits = lambda x: x if x <= LONGEST else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, fits(d), fits(spent[j]), fits(sum(spent)), sha[j]) for (d, j), (i, _, _) in zip(final, kept)]


def key(row):
    return [(x is None, x or 0) for x in row]


def run(spark, rows, **how):
    out = cluster(spark.createDataFrame(rows, SCHEMA).repartition(5), **how)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=key)


def test_coefficients_are_exact_and_coarse_to_fine():
    rng = np.random.default_rng(0)
    x, y = rng.integers(-5000, 5000, (2, 64))
    order = sequency_order(64)
    a, b = transform(np.array([x, y]), order)
    assert ((a - b) ** 2).sum() == 64 * ((x - y) ** 2).sum()
    assert a[0] == x.sum() and sorted(order.tolist()) == list(range(64))
    basis = transform(np.eye(64, dtype=np.int64), order).T  # one coefficient's signs a row
    changes = (np.diff(basis, axis=1) != 0).sum(axis=1)
    assert changes.tolist() == list(range(64))


@pytest.mark.parametrize("spread", [1, 3, 1000])
def test_search_keeps_the_nearest_and_ties(spread):
    rng = np.random.default_rng(spread)
    x, c = rng.integers(-spread, spread + 1, (400, 16)), rng.integers(-spread, spread + 1, (6, 16))
    c[4] = c[1]
    order = sequency_order(16)
    number, whole = nearest(transform(x, order), transform(c, order))
    plain = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert number.tolist() == plain.argmin(axis=1).tolist()
    assert (whole // 16).tolist() == plain.min(axis=1).tolist()


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist(), "x") for i in range(700)]
    assert run(spark, rows, k=5, rounds=4, dims=8) == sorted(slow(rows, 5, 4, 8), key=key)


def test_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i // 2, rng.integers(-1, 2, 4).astype(float).tolist(), "x") for i in range(300)] + [(7, [0.0] * 4, "y")] * 200
    assert run(spark, rows, k=8, rounds=10, dims=4) == sorted(slow(rows, 8, 10, 4), key=key)


def test_edge_rows(spark):
    rows = [(1, [0.5, -0.25], "a"), (1, [0.5, -0.25], "a"), (2, None, "a"), (3, [], "a"), (4, [1.0], "a"), (5, [1.0, None], "a"),
            (6, [float("nan"), 0.0], "a"), (7, [float("-inf"), 0.0], "a"), (None, [9.0, 9.0], "a"), (8, [1e300, -1e300], "a"),
            (9, [1e13, 1e13], "a"), (10, [-0.0001, 0.0001], "a")]
    assert run(spark, rows, k=8, rounds=3, dims=2) == sorted(slow(rows, 8, 3, 2), key=key)
    assert run(spark, rows, k=2, rounds=3, dims=2) == sorted(slow(rows, 2, 3, 2), key=key)
    assert run(spark, [], k=8, rounds=3, dims=2) == []
    assert run(spark, [(None, [1.0, 1.0], "a")], k=8, rounds=3, dims=2) == []
    with pytest.raises(ValueError):
        run(spark, rows, dims=3)


def test_search_takes_wide_and_narrow_rows_together():
    c = [[0, 0], [1 << 21, 5]]
    v = np.array([[1, 1], [1 << 40, 0], [1 << 21, 4]])
    number, distance = Search(c)(v)
    assert number.tolist() == [0, 1, 1]
    assert [int(d) for d in distance] == [2, ((1 << 40) - (1 << 21)) ** 2 + 25, 1]
