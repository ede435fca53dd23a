"""Centroid clustering with progressive search over Walsh-Hadamard coefficients.

Vectors and centroids are integers.  Both are transformed once by the exact
integer Walsh-Hadamard transform, coefficients in order of sign changes (coarse
to fine).  The squared distance of two vectors of d components is the squared
distance of their coefficients divided by d, so the sum over the first few
coefficients is a lower bound.  The search finishes the centroid that looks
nearest, drops every centroid whose partial sum is strictly above a finished
one, and goes on to finer coefficients with those left; what is left at the end
has all its coefficients, so distances are exact and ties go to the smaller number.

Every round is one pass over the vectors: centroids are broadcast (their number
is a parameter), tasks send one row of exact sums a centroid and component.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; rows with a null id are assigned but are no
first centroids; repeated rows count each, and of rows with one id the smaller
vector comes first as a centroid; with fewer vectors than centroids there are
fewer centroids; an empty centroid stays where it is; a scaled component beyond
a long counts as the long nearest to it; a squared distance, or a sum of them,
that no long can hold is null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 4096
EXACT = 1 << 22  # components below this give 64-bit sums of squared coefficients, for up to 256 of them
LONGEST = (1 << 63) - 1
HUGE = 10 ** 30  # stands for any inertia of a task that no long can hold
COUNT, INERTIA = -1, -2  # places of the count and the inertia among a cluster's sums
SUMS = "cluster int, place int, s decimal(38,0)"


def sequency_order(d: int) -> np.ndarray:
    """Rows of the natural Walsh-Hadamard matrix of size ``d`` by falling coarseness: sign changes ascending."""
    bits = d.bit_length() - 1
    changes = np.zeros(d, dtype=np.int64)
    for i in range(d):
        row = [bin(i & j).count("1") & 1 for j in range(d)]
        changes[i] = sum(a != b for a, b in zip(row, row[1:]))
    assert 1 << bits == d
    return np.argsort(changes, kind="stable")


def transform(vectors: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, coarse to fine; exact, in the dtype of ``vectors``."""
    n, d = vectors.shape
    out, half = vectors, 1
    while half < d:
        pairs = out.reshape(n, d // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return out[:, order]


def stages(d: int) -> list[slice]:
    """Coefficients looked at together: the first four, then as many as before, up to all."""
    edges = [0, min(4, d)]
    while edges[-1] < d:
        edges.append(min(d, 2 * edges[-1]))
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance times d) for rows of coefficients."""
    n, d = x.shape
    first, *finer = stages(d)
    rows = np.arange(n)
    sums = ((x[:, None, first] - c[None, :, first]) ** 2).sum(axis=2)
    likely = sums.argmin(axis=1)
    whole = ((x - c[likely]) ** 2).sum(axis=1)  # of the centroid that looks nearest: a bound for the others
    row, number = np.nonzero(sums <= whole[:, None])
    partial = sums[row, number]
    for stage in finer:
        partial = partial + ((x[row, stage] - c[number, stage]) ** 2).sum(axis=1)
        left = partial <= whole[row]  # strictly worse ones go
        row, number, partial = row[left], number[left], partial[left]
    best, least = np.full(n, len(c)), whole.copy()
    # All that are left have every coefficient; the likely one is among them.
    np.minimum.at(least, row, partial)
    tied = partial == least[row]
    np.minimum.at(best, row[tied], number[tied])
    assert (best < len(c)).all() and len(rows) == n
    return best, least


class Search:
    """The centroids' coefficients, in 64 bits where they fit and in Python integers where they don't."""

    def __init__(self, centroids: list[list[int]]):
        self.d = len(centroids[0])
        self.order = sequency_order(self.d)
        self.exact = transform(np.array(centroids, dtype=object), self.order)
        self.small = all(abs(x) < EXACT for c in centroids for x in c)
        self.fast = self.exact.astype(np.int64) if self.small else None

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of each row of 64-bit components."""
        narrow = (vectors < EXACT).all(axis=1) & (vectors > -EXACT).all(axis=1) if self.small else np.zeros(len(vectors), dtype=bool)
        if narrow.all():
            cluster, whole = nearest(transform(vectors, self.order), self.fast)
            return cluster, whole // self.d
        cluster, distance = np.zeros(len(vectors), dtype=np.int64), np.zeros(len(vectors), dtype=object)
        if narrow.any():
            cluster[narrow], whole = nearest(transform(vectors[narrow], self.order), self.fast)
            distance[narrow] = whole // self.d
        cluster[~narrow], whole = nearest(transform(vectors[~narrow].astype(object), self.order), self.exact)
        distance[~narrow] = whole // self.d
        return cluster, distance


def kept_vectors(vectors: DataFrame, *, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as they are stored."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return (vectors.where(v.isNotNull() & (F.size(v) == dims) & finite)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")))


def scaled(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, as rows of 64-bit integers."""
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, dims)
    wide = np.abs(x) >= 2.0 ** 63
    out = np.where(wide, 0, x).astype(np.int64)
    out[wide] = np.where(x[wide] > 0, LONGEST, -LONGEST - 1)
    return out


def _blocks(batches, dims: int, scale: int):
    for b in batches:
        for lo in range(0, len(b), ROWS_AT_ONCE):
            part = b.slice(lo, ROWS_AT_ONCE)
            yield part.column("vec_id"), scaled(part.column("v"), dims, scale)


def _first(kept: DataFrame, k: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of the smallest SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.where("vec_id IS NOT NULL").withColumn("h", digest).orderBy("h", "v").limit(k).collect()
    flat = pa.array([[float(x) for x in r["v"]] for r in rows], pa.list_(pa.float64()))
    return [[int(x) for x in v] for v in scaled(flat, dims, scale)] if rows else []


def _sums(shared, k: int, dims: int, scale: int, inertia: bool):
    """A task's sums: components and count a cluster, or the inertia a cluster."""
    def run(batches):
        search: Search = shared.value
        count, total = [0] * k, [[0] * dims for _ in range(k)]
        spent = [0] * k
        for _, v in _blocks(batches, dims, scale):
            cluster, distance = search(v)
            for c in np.unique(cluster).tolist():
                own = cluster == c
                if inertia:
                    spent[c] += sum(distance[own].tolist())
                else:
                    part = v[own]
                    wide = np.abs(part.astype(np.float64)).max() >= 2.0 ** 50
                    total[c] = [a + int(b) for a, b in zip(total[c], part.astype(object if wide else np.int64).sum(axis=0))]
                count[c] += int(own.sum())
        rows = [(c, COUNT, count[c]) for c in range(k)]
        rows += ([(c, INERTIA, min(spent[c], HUGE)) for c in range(k)] if inertia else
                 [(c, i, s) for c in range(k) for i, s in enumerate(total[c])])
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([Decimal(r[2]) for r in rows], pa.decimal128(38, 0))], names=["cluster", "place", "s"])

    return run


def _gathered(kept: DataFrame, run) -> dict[tuple[int, int], int]:
    found = kept.mapInArrow(run, SUMS).groupBy("cluster", "place").agg(F.sum("s").alias("s")).collect()
    return {(r["cluster"], r["place"]): int(r["s"]) for r in found}


def fit(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
        id_col: str = "vec_id", vector_col: str = "embedding") -> list[list[int]]:
    """The centroids after ``rounds`` rounds, as integer vectors of ``dims`` (a power of two) components."""
    if dims < 1 or dims & (dims - 1) or dims > 256:
        raise ValueError("dims must be a power of two up to 256")
    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dims=dims)
    centroids = _first(kept, k, dims, scale, seed)
    context = vectors.sparkSession.sparkContext
    for _ in range(rounds if centroids else 0):
        shared = context.broadcast(Search(centroids))
        sums = _gathered(kept, _sums(shared, len(centroids), dims, scale, False))
        after = [[sums[c, i] // sums[c, COUNT] for i in range(dims)] if sums.get((c, COUNT)) else old
                 for c, old in enumerate(centroids)]
        shared.unpersist()
        if after == centroids:  # the rounds left would change nothing
            break
        centroids = after
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]], *, scale: int = 1024, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance) of every vector that takes part."""
    spark = vectors.sparkSession
    if not centroids:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long")
    dims = len(centroids[0])
    shared = spark.sparkContext.broadcast(Search(centroids))

    def run(batches):
        search: Search = shared.value
        for ids, v in _blocks(batches, dims, scale):
            cluster, distance = search(v)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array([x if x <= LONGEST else None for x in distance.tolist()], pa.int64())],
                names=["vec_id", "cluster", "distance"])

    return (kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dims=dims)
            .mapInArrow(run, "vec_id long, cluster int, distance long"))


def inertias(vectors: DataFrame, centroids: list[list[int]], *, scale: int = 1024, id_col: str = "vec_id",
             vector_col: str = "embedding") -> list[int]:
    """Sum of squared distances of each cluster."""
    if not centroids:
        return []
    dims = len(centroids[0])
    shared = vectors.sparkSession.sparkContext.broadcast(Search(centroids))
    kept = kept_vectors(vectors, id_col=id_col, vector_col=vector_col, dims=dims)
    sums = _gathered(kept, _sums(shared, len(centroids), dims, scale, True))
    return [sums.get((c, INERTIA), 0) for c in range(len(centroids))]


def cluster(vectors: DataFrame, *, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Fit centroids and assign every vector.

    Returns vec_id, cluster, distance (squared), cluster_inertia, inertia (squared
    distances summed over the cluster and over all) and centroid_sha256 (of the
    cluster's components as decimal integers joined by commas).
    """
    columns = {"scale": scale, "id_col": id_col, "vector_col": vector_col}
    centroids = fit(vectors, k=k, rounds=rounds, dims=dims, seed=seed, **columns)
    spent = inertias(vectors, centroids, **columns)
    fits = lambda x: x if x <= LONGEST else None
    about = vectors.sparkSession.createDataFrame(
        [(c, fits(spent[c]), fits(sum(spent)), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
         for c, v in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    found = assign(vectors, centroids, **columns)
    return found.join(F.broadcast(about), "cluster").select(  # one row a centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """DuckDB SQL for ``cluster`` over the table ``embeddings``, in plain distances."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, v FROM kept),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS INTEGER) AS cluster, v
  FROM kept WHERE vec_id IS NOT NULL ORDER BY 1 LIMIT {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT n, any_value(x.vec_id) AS vec_id, any_value(x.v) AS v, min(ROW(d, cluster)) AS best
  FROM (SELECT n, vec_id, x.v, cluster,
          CAST(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM numbered x CROSS JOIN c{r} c) x GROUP BY n)""")
        if r < rounds:
            steps.append(f"""
m{r} AS MATERIALIZED (
  SELECT cluster, list(CAST(floor_div AS BIGINT) ORDER BY place) AS v
  FROM (SELECT best[2] AS cluster, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
        FROM (SELECT best, unnest(v) AS x, unnest(range(1, {dims + 1})) AS place FROM a{r}) GROUP BY 1, 2)
  GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return "WITH" + ",".join(steps) + f"""
SELECT vec_id, best[2] AS cluster, best[1] AS distance,
       CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = best[2]"""
