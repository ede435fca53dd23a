"""Helpers shared by the training-data operators.

Every operator first selects the columns it needs under its own names, so extra
or clashing columns of the input never reach a join.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handed to Python at once; texts may be long, so batches stay small.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, for operators that read whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there.

    The folder is the one the session names in ``spark.checkpoint.dir``; only
    where none is set (tests on one machine) a temporary one is taken.
    """
    _set_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _set_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoints-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, below the shared checkpoint folder, for tables that a job writes."""
    _set_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a table that this job wrote, on whatever file system it lies."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def map_batches(docs: DataFrame, change, *, text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, each Arrow batch passed through a function that ``change()`` makes in the task.

    The function gets (batch, list of texts) and returns a batch of the same columns.
    """
    def run(batches):
        step = change()
        for b in batches:
            yield step(b, b.column(text_col).to_pylist())

    return docs.mapInArrow(run, docs.schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls into fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def sampled(share: float, *columns: str, seed: int) -> Column:
    """Whether a row falls into a sample of ``share`` of all rows, by a 64-bit hash of ``columns`` and the row's place.

    The place parts repeated rows and null ids, so a group of copies is sampled row by row."""
    if share >= 1:
        return F.lit(True)
    at = F.xxhash64(*columns, F.monotonically_increasing_id(), F.lit(seed))
    return at < F.lit(threshold(share))


def threshold(share: float) -> int:
    """The signed 64-bit number below which ``share`` of all hashes lie."""
    return max(-2 ** 63, min(2 ** 63 - 1, round(share * 2 ** 64) - 2 ** 63))


def text_docs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(doc_id, text) of ``docs`` and nothing else but ``more``; a null text becomes empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[c.alias(k) for k, c in more.items()],
    )


def connected_components(edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """Smallest reachable node for every node of an undirected edge list.

    ``edges`` has two long columns (a, b).  Returns (node, component), one row a
    node.  Alternates the two star contractions (every larger neighbour is hung
    on the smallest neighbour, then every smaller one) until nothing changes:
    a logarithmic number of rounds in practice.  Neighbour minima are partial
    aggregates.  They are written to the checkpoint folder, as each round's
    edges are, and so meet the edges of a hub as plain rows, whose join AQE can
    split.
    """
    pairs = checkpointed(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct())
    state = _state(pairs)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpointed(both.where("v > u").join(least, "u")
                             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        smallest = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = checkpointed(
            small.union(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").union(roots)


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]
