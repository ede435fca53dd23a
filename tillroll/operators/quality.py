"""Declarative data tests (2.10) run as Spark jobs, and their summary.

Each test yields one row ``(model, column, test, failing_rows)``; a test
passes when ``failing_rows`` is 0.  NULL rules follow the usual defaults:
``unique`` ignores NULLs, ``accepted_values`` lets NULL pass and counts each
unaccepted *value* once, ``relationships`` ignores NULL child keys and counts
child rows without a parent.

All ``not_null`` and ``accepted_values`` tests of one model run as a single
aggregate (one scan), all its ``unique`` tests as another.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

@dataclass(frozen=True)
class DataTest:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: tuple = field(default=())  # accepted values
    to: tuple = field(default=())  # (parent model, parent column)


def _row(model: str, column: str, test: str, failing: F.Column, src: DataFrame) -> DataFrame:
    return src.select(F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(test).alias("test"),
                      failing.cast("bigint").alias("failing_rows"))


def row_checks(df: DataFrame, model: str, nulls: list[str], accepted: dict[str, tuple]) -> DataFrame:
    """All not_null and accepted_values tests of a model in one aggregate,
    unpivoted to rows.  A NULL passes accepted_values (the predicate is NULL),
    and each unaccepted value counts once."""
    counts = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in nulls]
    counts += [(c, "accepted_values", F.count_distinct(F.when(~F.col(c).isin(list(v)), F.col(c))))
               for c, v in accepted.items()]
    agg = df.agg(*[n.alias(f"_n{i}") for i, (_, _, n) in enumerate(counts)])
    rows = ", ".join(f"'{c}', '{t}', _n{i}" for i, (c, t, _) in enumerate(counts))
    return agg.selectExpr(f"stack({len(counts)}, {rows}) as (column, test, failing_rows)").select(
        F.lit(model).alias("model"), "column", "test", F.col("failing_rows").cast("bigint").alias("failing_rows"))


def not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """All not_null counts of a model."""
    return row_checks(df, model, columns, {})


def unique(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once (each counted once)."""
    dup = df.where(F.col(column).isNotNull()).groupBy(column).count().where(F.col("count") > 1)
    return _row(model, column, "unique", F.col("n"), dup.agg(F.count(F.lit(1)).alias("n")))


def unique_many(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """All ``unique`` tests of one model in one scan and one shuffle.

    Values are stacked as (column, value-as-string) pairs and grouped once;
    keys are ids and strings, whose string forms are distinct exactly when
    the values are.  Same result as :func:`unique` per column."""
    if len(columns) == 1:
        return unique(df, model, columns[0])
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)").where(F.col("value").isNotNull())
    dup = long.groupBy("column", "value").count().where(F.col("count") > 1)
    wide = dup.agg(*[F.count_if(F.col("column") == c).alias(f"_u{i}") for i, c in enumerate(columns)])
    back = ", ".join(f"'{c}', _u{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {back}) AS (column, failing_rows)").select(
        F.lit(model).alias("model"), "column", F.lit("unique").alias("test"),
        F.col("failing_rows").cast("bigint").alias("failing_rows"))


def accepted_values(df: DataFrame, model: str, column: str, values: list[str]) -> DataFrame:
    """Number of distinct non-NULL values that are not accepted."""
    return row_checks(df, model, [], {column: tuple(values)})


def relationships(child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent.

    Child rows are first counted per key (combined map-side), then the keys
    are anti-joined with the parent keys: the same count as anti-joining
    every row, but a key holding a third of the child rows is one row in
    the join."""
    c = (child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k"))
         .agg(F.count(F.lit(1)).alias("_rows")))
    p = parent.select(F.col(parent_column).alias("_k"))
    orphans = c.join(p, "_k", "left_anti")
    return _row(model, column, "relationships", F.coalesce(F.col("n"), F.lit(0)),
                orphans.agg(F.sum("_rows").alias("n")))


KINDS = ("not_null", "unique", "accepted_values", "relationships")


def models_needed(tests: list[DataTest], kinds: set[str] | None = None) -> set[str]:
    """Models that the tests of some kinds read."""
    chosen = [t for t in tests if t.test in (kinds or KINDS)]
    return {t.model for t in chosen} | {t.to[0] for t in chosen if t.to}


def run_tests(models: dict[str, DataFrame], tests: list[DataTest], kinds: set[str] | None = None) -> DataFrame:
    """Run ``tests`` (optionally only some kinds) against ``models``: one row
    per test.  A test whose model or parent is absent is an error."""
    chosen = [t for t in tests if t.test in (kinds or KINDS)]
    if not chosen:
        raise ValueError("no data test is asked for")
    absent = sorted(models_needed(chosen) - set(models))
    if absent:
        raise ValueError(f"models under test are absent: {', '.join(absent)}")
    frames: list[DataFrame] = []
    for m in dict.fromkeys(t.model for t in chosen):
        own = [t for t in chosen if t.model == m]
        nulls = [t.column for t in own if t.test == "not_null"]
        accepted = {t.column: t.values for t in own if t.test == "accepted_values"}
        if nulls or accepted:
            frames.append(row_checks(models[m], m, nulls, accepted))
        unique_columns = [t.column for t in own if t.test == "unique"]
        if unique_columns:
            frames.append(unique_many(models[m], m, unique_columns))
        frames += [relationships(models[m], m, t.column, models[t.to[0]], t.to[1]) for t in own if t.test == "relationships"]
    return reduce(lambda a, b: a.unionByName(b), frames)


def summary(results: DataFrame, models_built: int) -> DataFrame:
    """Passed / failed test counts and the number of models built."""
    return results.agg(
        F.count(F.lit(1)).alias("tests_run"),
        F.count_if(F.col("failing_rows") == 0).alias("tests_passed"),
        F.count_if(F.col("failing_rows") > 0).alias("tests_failed"),
    ).select("tests_run", "tests_passed", "tests_failed", F.lit(models_built).cast("bigint").alias("models_built"))
