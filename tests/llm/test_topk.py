import math

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, query_id long"


def slow(rows, k, scale=64):
    """Brute force over every query and candidate."""
    vectors = []
    for vec_id, v, *_ in rows:
        if vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((vec_id, [math.floor(scale * float(np.float32(x))) for x in v]))
    queries = {}
    for i, v in vectors:
        if i % 20 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, u in queries.items():
        found = [(-sum(a * b for a, b in zip(u, v)), i) for i, v in vectors if i != q and len(v) == len(u)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = top_k(df, F.col("vec_id") % 20 == 0, **more)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in out.collect())


def test_random_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist(), 1) for i in range(1500)]
    assert run(spark, rows, k=20) == slow(rows, 20)
    assert run(spark, rows, k=20, queries_at_once=10) == slow(rows, 20)


def test_ties_everywhere(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-1, 2, 3).astype(float).tolist(), 1) for i in range(800)]
    assert run(spark, rows, k=20) == slow(rows, 20)
    same = [(i, [0.5, -0.5], 1) for i in range(300)]
    assert run(spark, same, k=7) == slow(same, 7)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (20, [1.0, -2.0], 1), (20, [1.0, -2.0], 1), (40, None, 1), (60, [], 1),
            (80, [1.0, None], 1), (100, [float("nan"), 1.0], 1), (120, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1),
            (3, [0.0, 0.0], 1), (3, [0.0, 0.0], 1), (5, [1.0, 2.0, 3.0], 1), (140, [1.0, 2.0, 3.0], 1), (160, [1.0] * 4, 1),
            (7, [1e30, 1.0], 1), (9, [-100.015625, 3.3], 1)]
    want = slow([r for r in rows if r[0] != 7], 20)
    assert run(spark, rows, k=20) == want
    assert run(spark, rows, k=1) == slow([r for r in rows if r[0] != 7], 1)
    assert run(spark, [], k=3) == []
    assert run(spark, [(1, [1.0], 1)], k=3) == [] and run(spark, [(20, [1.0], 1)], k=3) == []


def test_large_scores_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(6) * 3e5).astype(np.float32).tolist(), 1) for i in range(200)]
    assert run(spark, rows, k=5) == slow(rows, 5)


def test_products_beyond_a_long_are_no_error(spark):
    top = float(np.float32(2 ** 27 - 16)) / 64
    rows = [(20, [top] * 512, 1), (1, [top] * 512, 1), (2, [-top] * 512, 1), (3, [1.0] * 512, 1)]
    found = run(spark, rows, k=3)
    assert [r[2] for r in found] == [1, 3, 2] and found[0][3] == 1 << 61 and found[2][3] == -(1 << 61)
    assert found[1][3] == 512 * 64 * int(64 * top)
