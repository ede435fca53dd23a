"""Loading of landed files with Structured Streaming.

One loader serves a full reload and an incremental load.  A file stream
remembers, in its checkpoint, which files it has read, so each file reaches
bronze once; ``availableNow`` processes what is there and stops, so the job
runs as a batch on a schedule.  Every micro-batch is parsed by the functions
of :mod:`tillroll.sources.envelopes` and written by one job: loaded and
quarantined rows side by side, in a folder of its own that a retry overwrites,
so files are loaded exactly once.  Beside them it writes a ledger, one row a file
with its counts, so that counts and completeness are read without the records.

A full reload starts a new generation: new checkpoint, new tables.  Later
incremental loads go on with the latest generation.  Nothing is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENTITIES
from ..sources import envelopes

LOADED, QUARANTINED = "loaded", "quarantined"


def _generations(spark: SparkSession, root: str) -> list[int]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[4:]) for n in names if n.startswith("gen=") and n[4:].isdigit())


def generation(spark: SparkSession, bronze_root: str, full: bool) -> str:
    """Folder of the generation to load into: a new one for a full reload, else the latest."""
    have = _generations(spark, bronze_root)
    number = (have[-1] + 1 if have else 0) if full else (have[-1] if have else 0)
    return f"{bronze_root.rstrip('/')}/gen={number}"


def load_files(spark: SparkSession, root: str, entity: str, folder: str, max_files: int | None = None) -> None:
    """Append the records of files not yet loaded to ``folder/<entity>``."""
    path = f"{folder}/{entity}"

    def write(lines: DataFrame, batch: int) -> None:
        # Every file of this batch is there by now, so none is larger than what is found.
        largest = envelopes.largest_file(lines.sparkSession, root, entity)
        rows = envelopes.parse_records(envelopes.landed_values(lines, entity, largest=largest), entity)
        status = F.when(F.col("_bad").isNull(), LOADED).otherwise(QUARANTINED)
        rows.withColumn("_status", status).write.mode("overwrite").partitionBy("_status").parquet(f"{path}/_load={batch}")
        written = lines.sparkSession.read.schema(_schema(entity, of_load=True)).parquet(f"{path}/_load={batch}")
        per_file = written.groupBy("_source").agg(
            F.count_if(F.col("_status") == LOADED).alias("_landed_n"), F.count_if(F.col("_status") == QUARANTINED).alias("_quarantined"),
            F.max("_total").alias("_reported"))
        per_file.write.mode("overwrite").parquet(f"{folder}/_ledger/{entity}/_load={batch}")

    query = (envelopes.stream_lines(spark, root, entity, max_files).writeStream.foreachBatch(write)
             .option("checkpointLocation", f"{folder}/_checkpoints/{entity}").trigger(availableNow=True).start())
    query.awaitTermination()


def _schema(entity: str, of_load: bool = False) -> T.StructType:
    """Columns of the loaded rows of an entity, of one load or of all."""
    _, record, single = ENTITIES[entity]
    return T.StructType([
        T.StructField("_source", T.StringType()), T.StructField("_landed", T.TimestampType()),
        T.StructField("_total", T.LongType()), T.StructField("_bad", T.StringType()), T.StructField(single, record),
        *([] if of_load else [T.StructField("_load", T.IntegerType())]), T.StructField("_status", T.StringType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(envelopes.require_folder(spark, path))
    except FileNotFoundError:  # no file was ever landed for it
        return spark.createDataFrame([], schema)


def read_loaded(spark: SparkSession, folder: str, entity: str, status: str = LOADED) -> DataFrame:
    """Rows of one status, by their declared schema (so an entity without rows is an empty table)."""
    rows = _read(spark, f"{folder}/{entity}", _schema(entity))
    return rows.where(F.col("_status") == status).drop("_status", "_load")


def read_ledger(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    """The load's ledger: one row a landed file with ``_source, _landed_n, _quarantined, _reported``."""
    return _read(spark, f"{folder}/_ledger/{entity}", T.StructType([
        T.StructField("_source", T.StringType()), T.StructField("_landed_n", T.LongType()),
        T.StructField("_quarantined", T.LongType()), T.StructField("_reported", T.LongType()),
        T.StructField("_load", T.IntegerType())])).drop("_load")
