"""Command line of the jobs, for ``spark-submit``.

    spark-submit --py-files tidecast.zip tidecast/cli.py panel --raw RAW --root ROOT --as-of 2024-01-01
    spark-submit ... cli.py ingest --root ROOT --incoming DIR
    spark-submit ... cli.py retrain --root ROOT --run-id RUN --params '{"n_estimators": 300}'
    spark-submit ... cli.py reports --root ROOT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidecast import jobs as J
from tidecast.sources.bank import load_bank


def arguments(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="tidecast")
    ap.add_argument("job", choices=["panel", "validate", "check", "ingest", "ingest-changed", "retrain", "finalise", "reports"])
    ap.add_argument("--root", required=True, help="folder of the stored tables")
    ap.add_argument("--raw", help="folder of the raw bank tables")
    ap.add_argument("--incoming", help="folder of incoming CSV files")
    ap.add_argument("--run-id", default="manual")
    ap.add_argument("--as-of", help="date of ages and tenures")
    ap.add_argument("--status", default="completed", help="transaction status kept; blank keeps all")
    ap.add_argument("--min-months", type=int, default=6)
    ap.add_argument("--max-customers", type=int)
    ap.add_argument("--params", default="{}")
    ap.add_argument("--fit-scope", choices=["all", "train"], default="all")
    ap.add_argument("--append", action="store_true", help="add prediction rows instead of replacing partitions")
    ap.add_argument("--catalog", default="", help="database in which published tables are registered")
    ap.add_argument("--all-at-once", action="store_true", help="merge all pending files in one batch")
    return ap.parse_args(argv)


def main(argv=None) -> None:
    a = arguments(argv)
    spark = SparkSession.builder.appName(f"tidecast-{a.job}").getOrCreate()
    cfg = J.Config(a.root, a.run_id, a.params, a.fit_scope, a.append, a.catalog)
    if a.job == "panel":
        options = {"status": a.status, "min_months": a.min_months, "max_customers": a.max_customers}
        J.build_panel(spark, load_bank(spark, a.raw), cfg, a.as_of, **options)
    elif a.job == "validate":
        J.validate(spark, cfg, a.raw or a.incoming).show(truncate=False)
    elif a.job == "finalise":
        J.finalise(spark, cfg).show(truncate=False)
    elif a.job == "check":
        J.check_new_data(spark, cfg, a.incoming).show(truncate=False)
    elif a.job == "ingest":
        print(J.ingest(spark, cfg, a.incoming, one_by_one=not a.all_at_once), "batches")
    elif a.job == "ingest-changed":
        report = J.ingest_changed(spark, cfg, a.incoming)
        print("no new files") if report is None else report.show(truncate=False)
    elif a.job == "retrain":
        J.retrain(spark, cfg).show(truncate=False, vertical=True)
    else:
        print("\n".join(J.export_reports(spark, cfg)))


if __name__ == "__main__":
    main()
