"""Catalog reads (S11-S17): table lists, existence, columns, inspection and
which analytics models are present.  These touch metadata, plus one count
(from the footers of stored files) and one first row per inspected table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.models import analytics_models  # noqa: F401  (S16)


def list_tables(spark: SparkSession, db: str | None = None) -> list[str]:
    """Table and view names of a database (default: current)."""
    return sorted(t.name for t in spark.catalog.listTables(db))


def existing(spark: SparkSession, names: list[str], db: str | None = None) -> list[str]:
    """Those of ``names`` that exist, ordered by name."""
    have = set(list_tables(spark, db))
    return sorted(n for n in set(names) if n in have)


def describe(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """(column, type) of a table; an unknown table gives []."""
    if not spark.catalog.tableExists(name):
        return []
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]


@contextmanager
def _from_footers(spark: SparkSession):
    """Parquet is read by the reader that answers counts from file footers, within the block."""
    wanted = {"spark.sql.parquet.aggregatePushdown": "true",
              "spark.sql.sources.useV1SourceList": ",".join(
                  x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet")}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def footer_counts(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """A10/A23 of stored tables: (table_name, row_count) of Parquet folders, from their footers alone.

    Planned here, so that the result reads no column chunk wherever it is used."""
    with _from_footers(spark):
        out = None
        for name, folder in folders.items():
            one = spark.read.parquet(folder).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count")
            out = one if out is None else out.unionByName(one)
        if out is None:
            return spark.createDataFrame([], "table_name string, row_count bigint")
        out._jdf.queryExecution().executedPlan()
    return out


def table_folders(spark: SparkSession, names: list[str]) -> dict[str, str]:
    """Folders of those catalog tables that are stored as Parquet without partitions."""
    out = {}
    for name in names:
        if name in {t.name for t in spark.catalog.listTables() if t.isTemporary} or not spark.catalog.tableExists(name):
            continue
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
        if about.get("Provider") == "parquet" and "# Partition Information" not in about:
            out[name] = about["Location"]
    return out


def inspect(spark: SparkSession, names: list[str], folders: dict[str, str] | None = None) -> list[dict]:
    """Row count and first row per table; a failing table is reported
    and the others go on.  ``folders`` says where tables are stored that the catalog holds as views."""
    where = {**table_folders(spark, names), **(folders or {})}
    out = []
    for n in names:
        try:
            df = spark.table(n)
            first = df.limit(1).collect()
            rows = footer_counts(spark, {n: where[n]}).first()["row_count"] if n in where else df.count()
            out.append({"table": n, "rows": rows, "sample": first[0].asDict() if first else None,
                        "error": None})
        except Exception as e:  # noqa: BLE001
            out.append({"table": n, "rows": None, "sample": None, "error": f"{type(e).__name__}: {e}"[:200]})
    return out


def present_models(spark: SparkSession, models: dict[str, str], db: str | None = None) -> dict[str, str]:
    """The registered models that exist in the catalog; their number is
    the 'reports executed' count of the dashboard."""
    have = set(existing(spark, list(models.values()), db))
    return {alias: t for alias, t in models.items() if t in have}
