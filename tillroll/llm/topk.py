"""Exact top-k inner-product search by distributed histogram selection.

Queries go to the executors in batches of bounded size.  For a batch, every
partition scores all its vectors against all queries.  A first histogram of the
integer scores, summed over partitions, gives for each query the bin that holds
its k-th highest score; that bin is split again and again until it is one score
wide.  A last pass keeps the scores above the k-th, and of those equal to it the
smallest ids.  No pass sends more than about k bins or rows a query and
partition: bins below a partition's own k-th score can't hold the global one.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part, as query or candidate, nor do rows with a null id, nor
components of 2 ** 27 or more once scaled (64-bit scores can't hold their
products); a product beyond 2 ** 61 (vectors of over 128 such components) counts as 2 ** 61; vectors of another dimension than a query's are no candidates for it;
repeated rows are candidates each; an id with several rows queries once, with
the smallest vector, and none of its rows is its own candidate; fewer than k
candidates are all returned; empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_AT_ONCE = 2048
BINS = 256
MOST = 1 << 61  # half of what scores and the bins around them can be
HISTOGRAM = "query int, bin long, n long"
FOUND = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, *, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, for the vectors that take part."""
    ints = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    whole = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < 2.0 ** 27))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v")))


class Batch:
    """A batch of queries of one dimension, with the state of their selection."""

    def __init__(self, ids: list[int], vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = np.array(ids, dtype=np.int64), vectors, k
        self.low = np.zeros(len(ids), dtype=np.int64)  # first score of the bin that holds the k-th
        self.width = np.ones(len(ids), dtype=np.int64)  # scores a bin is wide
        self.above = np.zeros(len(ids), dtype=np.int64)  # candidates above that bin
        self.span = np.full(len(ids), np.iinfo(np.int64).max)  # scores the current range is wide


def scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Integer inner products; exact in floating point below 2 ** 53, else in integers."""
    if not len(vectors):
        return np.zeros((len(queries), 0), dtype=np.int64)
    bound = vectors.shape[1] * float(np.abs(vectors).max()) * float(np.abs(queries).max())
    if bound < 2 ** 53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if bound < MOST:
        return queries @ vectors.T
    exact = queries.astype(object) @ vectors.T.astype(object)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def _blocks(batches, dimension: int):
    """(ids, vectors) of the candidates of one dimension, a bounded number at once."""
    for b in batches:
        ids = b.column("vec_id").to_numpy(zero_copy_only=False)
        column = b.column("v")
        size = np.diff(column.offsets.to_numpy())
        keep = size == dimension
        if keep.all():
            vectors = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
        else:
            vectors = np.array([v for v, ok in zip(column.to_pylist(), keep) if ok], dtype=np.int64).reshape(-1, dimension)
            ids = ids[keep]
        for lo in range(0, len(ids), ROWS_AT_ONCE):
            yield ids[lo:lo + ROWS_AT_ONCE], vectors[lo:lo + ROWS_AT_ONCE]


def _own(ids: np.ndarray, batch: Batch) -> np.ndarray:
    return batch.ids[:, None] == ids[None, :]


def _merge_top(counts: dict, found: list[tuple[np.ndarray, np.ndarray]], k: int) -> None:
    """Add (bin, n) pairs to each query's counts, and drop bins below its own k-th candidate."""
    for query, (bins, n) in enumerate(found):
        held = counts.setdefault(query, {})
        for b, c in zip(bins.tolist(), n.tolist()):
            held[b] = held.get(b, 0) + c
        if len(held) > 4 * k:
            counts[query] = _top_bins(held, k)


def _top_bins(held: dict, k: int) -> dict:
    out, total = {}, 0
    for b in sorted(held, reverse=True):
        if total >= k:
            break
        out[b] = held[b]
        total += held[b]
    return out


def _histogram(shared, dimension: int):
    def run(batches):
        batch: Batch = shared.value
        counts: dict[int, dict[int, int]] = {}
        first = batch.span[0] == np.iinfo(np.int64).max
        for ids, vectors in _blocks(batches, dimension):
            s = scores(vectors, batch.vectors)
            bins = (s - batch.low[:, None]) // batch.width[:, None]
            drop = _own(ids, batch)
            if not first:
                drop |= (s < batch.low[:, None]) | (s >= (batch.low + batch.span)[:, None])
            found = []
            for q in range(len(batch.ids)):
                row = bins[q][~drop[q]]
                if first and len(row) > batch.k:
                    row = row[row >= np.partition(row, len(row) - batch.k)[len(row) - batch.k]]
                found.append(np.unique(row, return_counts=True))
            _merge_top(counts, found, batch.k)
        rows = [(q, b, n) for q, held in counts.items() for b, n in _top_bins(held, batch.k).items()]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["query", "bin", "n"])

    return run


def _select(shared, dimension: int):
    def run(batches):
        batch: Batch = shared.value
        ties: dict[int, list] = {}
        for ids, vectors in _blocks(batches, dimension):
            s = scores(vectors, batch.vectors)
            own = _own(ids, batch)
            kth = batch.low[:, None]
            q, c = np.nonzero((s > kth) & ~own)
            yield _rows(batch.ids[q], ids[c], s[q, c])
            for q in np.flatnonzero(((s == kth) & ~own).any(axis=1)).tolist():
                held = ties.setdefault(q, [])
                held.extend(ids[(s[q] == batch.low[q]) & ~own[q]].tolist())
                if len(held) > 4 * batch.k:
                    ties[q] = sorted(held)[:batch.k]
        rows = [(q, i) for q, held in ties.items() for i in sorted(held)[:batch.k]]
        q = np.array([r[0] for r in rows], dtype=np.int64)
        yield _rows(batch.ids[q], np.array([r[1] for r in rows], dtype=np.int64), batch.low[q])

    return run


def _rows(query_ids, ids, s) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(s, pa.int64())],
                                      names=["query_id", "vec_id", "score"])


def _refine(batch: Batch, histogram, bins: int) -> bool:
    """Move every query's range to the bin of its k-th candidate; True once all are one score wide."""
    by_query: dict[int, dict[int, int]] = {}
    for q, b, n in zip(histogram["query"].tolist(), histogram["bin"].tolist(), histogram["n"].tolist()):
        by_query.setdefault(q, {})[b] = n
    done = True
    for q in range(len(batch.ids)):
        held, total = by_query.get(q, {}), batch.above[q]
        at = None
        for b in sorted(held, reverse=True):
            at = b
            if total + held[b] >= batch.k:
                break
            total += held[b]
        else:
            if at is not None and total < batch.k:  # fewer than k candidates: all of them count
                batch.low[q], batch.width[q], batch.span[q] = np.iinfo(np.int64).min // 4, 1, 1
                continue
        if at is None:
            batch.span[q] = 1
            continue
        batch.low[q] += at * batch.width[q]
        batch.span[q] = batch.width[q]
        batch.above[q] = total
        batch.width[q] = max(1, math.ceil(batch.span[q] / bins))
        done &= bool(batch.span[q] == 1)
    return done


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding", queries_at_once: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products over all other rows.

    ``is_query`` is a condition on the vector's id column ``vec_id``.  Batches
    hold about ``queries_at_once`` queries, dealt by a hash of their id, and are
    the only vectors that reach the driver; each batch takes its own passes.
    """
    spark = vectors.sparkSession
    candidates = quantised(vectors, id_col=id_col, vector_col=vector_col, scale=scale)
    queries = (candidates.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")))
    out = None
    for size in queries.groupBy("dim").agg(F.count("*").alias("n")).orderBy("dim").collect():
        parts = max(1, math.ceil(size["n"] / queries_at_once))
        for part in range(parts):
            rows = (queries.where((F.col("dim") == size["dim"]) & (F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part))
                    .orderBy("vec_id").collect())
            if not rows:
                continue
            batch = Batch([r["vec_id"] for r in rows], np.array([r["v"] for r in rows], dtype=np.int64), k)
            found = _top_k_batch(spark, candidates, batch, size["dim"])
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _top_k_batch(spark, candidates: DataFrame, batch: Batch, dimension: int) -> DataFrame:
    context = spark.sparkContext
    # Any score lies within the product of the norms; the first bins cut that range.
    norms = candidates.where(F.size("v") == dimension).agg(
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("n")).first()
    reach = np.minimum(math.sqrt(norms["n"]) * np.sqrt((batch.vectors.astype(np.float64) ** 2).sum(axis=1)) + 1, float(MOST) + 1)
    batch.low = -np.ceil(reach).astype(np.int64)
    batch.width = np.maximum(1, np.ceil(2 * reach / BINS)).astype(np.int64)
    done = False
    while not done:
        shared = context.broadcast(batch)
        histogram = (candidates.mapInArrow(_histogram(shared, dimension), HISTOGRAM)
                     .groupBy("query", "bin").agg(F.sum("n").alias("n")).toPandas())
        done = _refine(batch, histogram, BINS)
    return candidates.mapInArrow(_select(context.broadcast(batch), dimension), FOUND)
