import datetime as dt
import hashlib
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import (cents_to_dollars, count_text, day_diff, money_text, pct2,
                                pct_text, ratio2, surrogate_key, trunc_ts)


def one(spark, col, value=None, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_surrogate_key_single_and_null(spark):
    assert one(spark, surrogate_key(F.lit(1))) == "c4ca4238a0b923820dcc509a6f75849b"
    assert one(spark, surrogate_key(F.col("v"))) == "d41d8cd98f00b204e9800998ecf8427e"


def test_surrogate_key_parts_unescaped(spark):
    a = one(spark, surrogate_key(F.lit("a-b"), F.lit("c")))
    b = one(spark, surrogate_key(F.lit("a"), F.lit("b-c")))
    assert a == b == hashlib.md5(b"a-b-c").hexdigest()


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-10**12, 10**12)), min_size=1, max_size=3))
def test_surrogate_key_matches_md5(spark, ids):
    text = "-".join("" if i is None else str(i) for i in ids)
    cols = [F.lit(i).cast("bigint") for i in ids]
    assert one(spark, surrogate_key(*cols)) == hashlib.md5(text.encode()).hexdigest()


def test_money_and_percent_text(spark):
    assert one(spark, money_text(F.lit(1234.5))) == "$1,234.50"
    assert one(spark, money_text(F.lit(None).cast("double"))) == "$0.00"
    assert one(spark, money_text(F.lit(1.005))) == "$1.01"  # decimal rounding, half away from zero
    assert one(spark, pct_text(F.lit(12.345))) == "12.35%"
    assert one(spark, pct_text(F.lit(None).cast("double"))) == "0.00%"
    assert one(spark, count_text(F.lit(1234567))) == "1,234,567"


def test_rounding_rules(spark):
    assert one(spark, ratio2(F.lit(10), F.lit(3))) == 3.33
    assert one(spark, ratio2(F.lit(1), F.lit(0))) is None
    assert one(spark, pct2(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, cents_to_dollars(F.lit(12345))) == 123.45


def test_day_diff_and_trunc(spark):
    d = spark.createDataFrame([(dt.datetime(2001, 1, 1, 23, 59), dt.datetime(2001, 1, 2, 0, 1))],
                              "a timestamp_ntz, b timestamp_ntz")
    r = d.select(day_diff("b", "a").alias("x"), trunc_ts("month", "b").alias("m")).first()
    assert r["x"] == 1
    assert r["m"] == dt.datetime(2001, 1, 1)


def test_money_text_or_dash_and_whole_numbers(spark):
    from tillroll.functions import money_text_or_dash, whole

    df = spark.createDataFrame([("12.5",), ("abc",), (None,), ("1234567.891",)], "v string")
    got = [r["t"] for r in df.select(money_text_or_dash("v").alias("t")).collect()]
    assert got == ["$12.50", "-", "-", "$1,234,567.89"]
    assert one(spark, whole(F.lit(2.5))) == 2 and one(spark, whole(F.lit(1.5))) == 2
    assert one(spark, whole(F.lit(5000000000))) == 5000000000


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=30))
def test_money_sum_is_exact(spark, units):
    """Sums of 4-decimal amounts equal the exact decimal sum, in any order."""
    from decimal import Decimal

    from tillroll.functions import money_sum

    amounts = [u / 10000 for u in units]  # the doubles a source would carry
    df = spark.createDataFrame([(a,) for a in amounts], "x double").repartition(3)
    got = df.agg(money_sum("x").alias("s")).first()["s"]
    assert got == sum(Decimal(u) / Decimal(10000) for u in units)


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 10**14), st.integers(1, 10**6))
def test_ratio2_rounds_the_exact_quotient(spark, units, n):
    from decimal import ROUND_HALF_UP, Decimal

    s = Decimal(units) / Decimal(10000)
    want = float((s / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    got = spark.createDataFrame([(s, n)], "s decimal(28,4), n long").select(
        ratio2("s", "n").alias("r")).first()["r"]
    assert got == want


def test_money_sum_of_huge_totals_does_not_overflow(spark):
    """KPIs re-sum mart totals; at 100 TB those pass 1e15 and their units
    pass the bigint range."""
    from tillroll.functions import money_sum

    df = spark.createDataFrame([(2.3e16,), (4.6e16,), (1.25,)], "x double")
    got = df.agg(money_sum("x").alias("s")).first()["s"]
    assert float(got) == 6.9e16 + 1.25


def test_ratio2_does_not_round_twice(spark):
    """14.9999 / 3000 = 0.0049999...: exact rounding gives 0.00; a quotient
    first rounded to 6 decimals would give 0.005 and then 0.01."""
    df = spark.createDataFrame([("14.9999", 3000), ("15.0000", 3000)], "s string, n long").selectExpr(
        "cast(s as decimal(38,4)) s", "n")
    assert [r["r"] for r in df.select(ratio2("s", "n").alias("r")).collect()] == [0.0, 0.01]


def test_ratio2_signs_and_huge_divisors(spark):
    rows = [("-1.005", 1), ("1.005", -1), ("-1.004", 1), ("0", 5), ("7", 0),
            ("150000000000000000.0049", 150000000000)]
    df = spark.createDataFrame(rows, "s string, n long").selectExpr("cast(s as decimal(38,4)) s", "n")
    got = [r["r"] for r in df.select(ratio2("s", "n").alias("r")).collect()]
    assert got == [-1.01, -1.01, -1.0, 0.0, None, 1000000.0]


def units_of(x):
    """The money rule by definition: the double times 10^4, to the nearest unit, halves away from zero."""
    v = x * 10000.0
    return int(math.copysign(math.floor(abs(v) + 0.5), v)) if abs(v) < 2**53 else int(v)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(
    st.floats(-1e9, 1e9), st.sampled_from([1.00005, 0.00005, 2.00015, 12.34565, -0.00005, -12.34565, 0.0, -1.00015]),
    st.floats(-8e14, 8e14)), min_size=1, max_size=20))
def test_one_money_rule_in_spark_and_sql(spark, amounts):
    """More than four decimals, ties, negative and large amounts: Spark, DuckDB and the definition agree."""
    import duckdb
    import oracle_sql

    from tillroll.functions import money_sum, money_units_wide

    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    got = [int(r["u"]) for r in df.select(money_units_wide("x").alias("u")).collect()]
    assert sorted(got) == sorted(map(units_of, amounts))
    small = [a for a in amounts if abs(a) < 1e11]
    sql = [duckdb.execute(f"SELECT {oracle_sql.units('?::DOUBLE')}".replace("?", repr(a))).fetchone()[0] for a in small[:5]]
    assert sql == [units_of(a) for a in small[:5]]
    total = df.agg(money_sum("x").alias("s")).first()["s"]
    assert int(total * 10000) == sum(map(units_of, amounts))
