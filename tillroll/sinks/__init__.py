"""Sinks (K3-K8): tables, views, by-name appends and copies over JDBC.

Writes happen on the executors; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


KEPT_VERSIONS = 2  # the current one, and the one before for readers that have begun with it


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """(all versions of a stored table, those written to the end: their job has left its marker)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return [], []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = sorted(int(n[8:]) for n in names if n.startswith("version=") and n[8:].isdigit())
    return numbers, [n for n in numbers if stored(spark, f"{path.rstrip('/')}/version={n}/_SUCCESS")]


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest whole version of the table stored at ``path``; None when there is none."""
    _, done = _versions(spark, path)
    return f"{path.rstrip('/')}/version={done[-1]}" if done else None


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def save_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None) -> str:
    """Full rebuild of a model (K3), as Parquet below ``path`` (by default the
    warehouse's folder of that name).

    A rebuild writes a new folder ``version=N``, whose marker file appears when the
    whole job has succeeded, and then points the catalog's table at it in one
    step.  A build that fails or is killed leaves the table as it was; what it
    wrote has no marker, is never read, and goes with the next rebuild."""
    spark = df.sparkSession
    path = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}").rstrip("/")
    numbers, done = _versions(spark, path)
    folder = f"{path}/version={numbers[-1] + 1 if numbers else 0}"
    w = df.write.mode("error")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(folder)
    table = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"  # a view of that name is another thing
    if spark.catalog.tableExists(table) and not partition_by and spark.table(table).schema == spark.read.parquet(folder).schema:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:  # new, or of other columns
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=folder, source="parquet")
        if partition_by:
            spark.catalog.recoverPartitions(table)
    kept = done[-(KEPT_VERSIONS - 1):]
    for n in numbers:
        if n not in kept:
            _delete(spark, f"{path}/version={n}")
    return name


def save_view(df: DataFrame, alias: str) -> str:
    """A model materialized as a view under its alias (K4)."""
    df.createOrReplaceTempView(alias)
    return alias


def create_empty(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> bool:
    """Create an empty table with ``schema`` unless it exists.
    Returns True when the table was created."""
    if spark.catalog.tableExists(name):
        return False
    w = spark.createDataFrame([], schema).write.format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return True


def append_by_name(df: DataFrame, name: str) -> None:
    """Append matching columns by name, not position (K6); extra columns of
    ``df`` are dropped and missing ones become NULL."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        target = spark.table(name).schema
        from pyspark.sql import functions as F

        cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
        df = df.select(*cols)
    df.write.mode("append").format("parquet").saveAsTable(name)


# Connections that a copy opens at once, at most.
CONNECTIONS = 16


def copy_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
              batch_size: int = 10000, connections: int = CONNECTIONS) -> str:
    """Append ``df`` to an external database table (K7): skipped when empty,
    never an upsert.  Each executor writes its own partitions, over at most
    ``connections`` connections."""
    if df.isEmpty():
        return "skipped"
    opts = {"batchsize": str(batch_size), "numPartitions": str(connections), **(properties or {})}
    df.write.mode("append").jdbc(url, table, properties=opts)
    return "written"


def stored(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, on any file system Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def copy_tables(spark: SparkSession, names: list[str], url: str, properties: dict | None = None,
                writer=copy_jdbc, folder: str | None = None) -> list[tuple[str, str]]:
    """Copy a list of tables (K8), from the catalog or from those stored below
    ``folder``.  Tables that do not exist are reported as 'missing' and the
    rest go on, also when one fails."""
    report = []
    for name in names:
        path = current(spark, f"{folder.rstrip('/')}/{name}") if folder else None
        if not (path if folder else spark.catalog.tableExists(name)):
            report.append((name, "missing"))
            continue
        try:
            df = spark.read.parquet(path) if path else spark.table(name)
            report.append((name, writer(df, url, name, properties)))
        except Exception as e:  # noqa: BLE001 - one failed table must not stop the others
            report.append((name, f"error: {type(e).__name__}"))
    return report
