"""Catalog reads (S11-S17) and sinks (K3-K8)."""

from pyspark.sql import types as T

from tillroll import sinks
from tillroll.sources import catalog


def test_tables_views_and_catalog(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    sinks.save_table(df, "t_dim")
    sinks.save_table(df, "t_dim")  # full rebuild, not append
    sinks.save_view(df, "v_stage")
    assert spark.table("t_dim").count() == 2
    assert catalog.existing(spark, ["t_dim", "v_stage", "nope"]) == ["t_dim", "v_stage"]
    assert catalog.describe(spark, "t_dim") == [("id", "bigint"), ("v", "string")]
    assert catalog.describe(spark, "nope") == []
    info = {r["table"]: r for r in catalog.inspect(spark, ["t_dim", "nope"])}
    assert info["t_dim"]["rows"] == 2 and info["nope"]["error"]


def test_create_empty_and_append_by_name(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    assert sinks.create_empty(spark, "t_raw", schema) is True
    assert sinks.create_empty(spark, "t_raw", schema) is False
    assert spark.table("t_raw").count() == 0
    sinks.append_by_name(spark.createDataFrame([("x", 1, 9)], "name string, id long, extra int"), "t_raw")
    sinks.append_by_name(spark.createDataFrame([(2,)], "id long"), "t_raw")
    got = sorted((r["id"], r["name"]) for r in spark.table("t_raw").collect())
    assert got == [(1, "x"), (2, None)]
    assert spark.table("t_raw").columns == ["id", "name"]


def test_present_models_and_copy_report(spark):
    sinks.save_table(spark.createDataFrame([(1,)], "x int"), "mtd_revenue")
    present = catalog.present_models(spark, {"mtd_revenue": "mtd_revenue", "customer_churn": "customer_churn"})
    assert present == {"mtd_revenue": "mtd_revenue"}
    assert len(catalog.analytics_models()) == 5
    sinks.save_table(spark.createDataFrame([], "x int"), "empty_t")
    calls = []

    def fake_writer(df, url, table, props):  # no database is started in tests
        calls.append(table)
        return "skipped" if df.isEmpty() else "written"

    rep = sinks.copy_tables(spark, ["mtd_revenue", "fact_sales", "empty_t"], "jdbc:none", writer=fake_writer)
    assert rep == [("mtd_revenue", "written"), ("fact_sales", "missing"), ("empty_t", "skipped")]


def test_killed_rebuild_leaves_the_table(spark, scratch):
    """A build that dies half-way is never seen; the next one takes its place."""
    import os

    import pytest
    from pyspark.sql import functions as F

    path = f"{scratch}/t_atomic"
    sinks.save_table(spark.range(5), "t_atomic", path)
    broken = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long"))
                                                  .otherwise(F.col("id")))
    with pytest.raises(Exception, match="killed"):
        sinks.save_table(broken, "t_atomic", path)
    os.makedirs(f"{path}/version=1", exist_ok=True)
    with open(f"{path}/version=1/part-0.parquet", "wb") as f:  # what a killed driver leaves behind
        f.write(b"half a file")
    assert spark.table("t_atomic").count() == 5
    assert sinks.current(spark, path).endswith("version=0") and sinks.current(spark, f"{scratch}/none") is None
    sinks.save_table(spark.range(7), "t_atomic", path)
    assert spark.table("t_atomic").count() == 7 and sinks.current(spark, path).endswith("version=2")
    assert sorted(os.listdir(path)) == ["version=0", "version=2"]
    sinks.save_table(spark.range(3).withColumn("more", F.lit("x")), "t_atomic", path)  # other columns
    assert spark.table("t_atomic").columns == ["id", "more"] and spark.table("t_atomic").count() == 3
    assert sorted(os.listdir(path)) == ["version=2", "version=3"]


def test_a_partitioned_table_is_rebuilt(spark, scratch):
    for n in (4, 6):
        sinks.save_table(spark.range(n).selectExpr("id", "id % 2 AS p"), "t_parts", f"{scratch}/t_parts", partition_by=["p"])
        assert spark.table("t_parts").count() == n and spark.table("t_parts").where("p = 1").count() == n // 2
