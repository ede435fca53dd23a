"""Command line: ``python -m tillroll <command> ...``.

  pipeline LANDING WORK [--as-of D] [--incremental]   load, build, test and report
  dashboard WORK [--as-of D]                     dashboard over a built WORK folder
  validate-landing LANDING                       landed files per entity and day
  inspect WORK [--table T ...]                   columns, row count and first row of built tables
  copy-jdbc WORK URL [--table T ...] [--prop k=v ...]  append built tables to a database

Under spark-submit the session comes from its settings; started by plain
Python, a local[*] session is built.  The build date is today by default.
"""

from __future__ import annotations

import argparse
import json
import sys

from . import sinks
from .session import job_session

# The tables the original sync copies by default.
COPIED = ["dim_customer", "dim_product", "fact_orders", "fact_sales", "fact_churn"]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("landing")
    p.add_argument("work")
    p.add_argument("--as-of", default=None, help="build date, today by default")
    p.add_argument("--incremental", action="store_true", help="load only files not loaded before")
    d = sub.add_parser("dashboard")
    d.add_argument("work")
    d.add_argument("--as-of", default=None, help="build date, today by default")
    v = sub.add_parser("validate-landing")
    v.add_argument("landing")
    i = sub.add_parser("inspect")
    i.add_argument("work")
    i.add_argument("--table", action="append", default=None, help="table to show (repeatable); default: all models")
    c = sub.add_parser("copy-jdbc")
    c.add_argument("work")
    c.add_argument("url")
    c.add_argument("--table", action="append", default=None,
                   help="table to copy (repeatable); default: the fact and dimension tables")
    c.add_argument("--prop", action="append", default=[], help="JDBC property key=value (repeatable)")
    a = ap.parse_args(argv)
    spark = job_session()

    if a.cmd == "pipeline":
        from .plans.pipeline import run_pipeline

        out = run_pipeline(spark, a.landing, a.work, a.as_of, incremental=a.incremental)
        print("\n".join(out["report"]))
        failed = [t for t in out["tests"] if t["failing_rows"]]
        print(json.dumps({"loaded": out["loaded"], "quarantined": out["quarantined"], "models_built": len(out["models_built"]),
                          "tests_passed": out["tests_passed"], "tests_failed": failed,
                          "seconds": out["seconds"]}, default=str))
        return 1 if failed else 0
    if a.cmd == "dashboard":
        from .operators import kpis
        from .operators.staging import order_lines
        from .plans.models import analytics_models
        from .plans.pipeline import read_bronze
        from .streaming import generation

        reports = tuple(analytics_models())
        have = {t: folder for t in reports if (folder := sinks.current(spark, f"{a.work}/models/{t}"))}
        models = {t: spark.read.parquet(folder) for t, folder in have.items()}
        models["order_lines"] = order_lines(read_bronze(spark, generation(spark, f"{a.work}/bronze", full=False)).lines)
        section = None
        for row in kpis.dashboard(models, a.as_of, reports).orderBy("section_no", "row_no").collect():
            if row["section"] != section:
                section = row["section"]
                print(f"-- {section} --")
            print(f"{row['metric']}: {row['value']}")
        return 0
    if a.cmd == "inspect":
        from .plans.models import MODELS
        from .sources import catalog

        names = a.table or [m.name for m in MODELS if m.materialized == "table"]
        folders = {name: folder for name in names if (folder := sinks.current(spark, f"{a.work}/models/{name}"))}
        for name, folder in folders.items():
            sinks.save_view(spark.read.parquet(folder), name)
        for row in catalog.inspect(spark, names, folders):
            print(f"{row['table']}: {row['error'] or str(row['rows']) + ' rows'}")
            for column, kind in catalog.describe(spark, row["table"]):
                print(f"  {column} {kind}")
            if row["sample"]:
                print(f"  first row: {json.dumps(row['sample'], default=str)}")
        return 0
    if a.cmd == "validate-landing":
        from .sources.envelopes import landing_manifest, validate_landing

        for row in validate_landing(landing_manifest(spark, a.landing)).orderBy("entity", "landing_date").collect():
            print(f"{row['entity']} {row['landing_date']}: {row['files']} files, {row['bytes']} bytes")
        return 0
    if a.cmd == "copy-jdbc":
        props = dict(p.split("=", 1) for p in a.prop)
        for name, said in sinks.copy_tables(spark, a.table or COPIED, a.url, props, folder=f"{a.work}/models"):
            print(f"{name}: {said}")
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
