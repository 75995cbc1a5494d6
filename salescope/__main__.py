"""Run the analyses over CRM files and write each result as Parquet.

    spark-submit run_salescope.py --sales deals.csv --teams teams.csv \\
        --products products.csv --accounts accounts.csv \\
        --home "Homeland" --focal-agent "Some Agent" --threshold 400000 \\
        --out /shared/salescope/results [--analyses a,b] [--format parquet] \\
        [--repair product:BAD=GOOD] [--snapshot /shared/salescope/deals [--refresh]] \\
        [--fail-on-fk] [--largest-shuffle-gb 25000]

(``python -m salescope ...`` works the same in local mode.)  Each analysis is
written to ``<out>/<name>``; nothing is collected to the driver.  With
``--snapshot`` the denormalised deal frame is written once (partitioned by
stage) and every analysis reads it instead of joining the dimensions again.
``--fail-on-fk`` exits with status 2 when a deal references a missing agent,
product or account (after repairs); with ``--snapshot`` the pass that writes it
counts them, and nothing is published.  ``--refresh`` writes only the partitions
of the snapshot that changed.  ``--largest-shuffle-gb`` sizes shuffle partitions,
file splits and the broadcast threshold (``plans.session.cluster_conf``).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from salescope.operators.quality import fk_violations, repair_values
from salescope.plans.session import cluster_conf
from salescope.plans.snapshot import UnmatchedKeys, from_snapshot, refresh_snapshot, write_snapshot
from salescope.registry import Params, analyses
from salescope.sources.crm import (
    ACCOUNTS_SCHEMA,
    PRODUCTS_SCHEMA,
    SALES_SCHEMA,
    TEAMS_SCHEMA,
    model_from_frames,
    read_table,
)


def parse(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="salescope", description=__doc__.split("\n")[0])
    for name in ("sales", "teams", "products", "accounts"):
        ap.add_argument(f"--{name}", required=True, help=f"path of the {name} table")
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--out", required=True, help="output folder (one Parquet table per analysis)")
    ap.add_argument("--home", required=True, help="home country of the part-to-whole and segment analyses")
    ap.add_argument("--focal-agent", required=True, help="agent of the focal share and the forced top segment")
    ap.add_argument("--threshold", type=int, required=True, help="running revenue of the threshold dates")
    ap.add_argument("--top-n", type=int, default=10)
    ap.add_argument("--tiles", type=int, default=4)
    ap.add_argument("--kpi-type", default="decimal(38,2)", help="type of the KPI value column")
    ap.add_argument("--analyses", default="", help="comma-separated names (default: all)")
    ap.add_argument("--repair", action="append", default=[], help="COLUMN:BAD=GOOD, applied to the deals")
    ap.add_argument("--snapshot", default=None, help="folder for the materialised deal frame")
    ap.add_argument("--refresh", action="store_true", help="write only the snapshot's changed partitions")
    ap.add_argument("--fail-on-fk", action="store_true")
    ap.add_argument("--largest-shuffle-gb", type=int, default=None, help="size the session's SQL settings by it")
    return ap.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("salescope").getOrCreate()
    if args.largest_shuffle_gb is not None:
        for key, value in cluster_conf(args.largest_shuffle_gb << 30).items():
            if key.startswith("spark.sql."):  # the others are fixed when a session starts
                spark.conf.set(key, value)

    sales = read_table(spark, args.sales, SALES_SCHEMA, args.format)
    repairs: dict[str, dict[str, str]] = {}
    for spec in args.repair:
        column, _, pair = spec.partition(":")
        bad, _, good = pair.partition("=")
        repairs.setdefault(column, {})[bad] = good
    for column, mapping in repairs.items():
        sales = repair_values(sales, column, mapping)
    model = model_from_frames(
        sales,
        read_table(spark, args.teams, TEAMS_SCHEMA, args.format),
        read_table(spark, args.products, PRODUCTS_SCHEMA, args.format),
        read_table(spark, args.accounts, ACCOUNTS_SCHEMA, args.format),
    )

    broken = json.dumps({"error": "foreign-key violations; run the fk_violations analysis"})
    if args.snapshot:
        write = refresh_snapshot if args.refresh else write_snapshot
        try:
            write(model, args.snapshot, fail_on_unmatched=args.fail_on_fk)
        except UnmatchedKeys:
            print(broken)
            return 2
        model = from_snapshot(spark, args.snapshot, model)
    elif args.fail_on_fk and not fk_violations(model).isEmpty():
        print(broken)
        return 2

    params = Params(
        home=args.home,
        focal_agent=args.focal_agent,
        threshold=args.threshold,
        top_n=args.top_n,
        tiles=args.tiles,
        kpi_type=args.kpi_type,
    )
    catalog = analyses(model, params)
    wanted = [a for a in args.analyses.split(",") if a] or list(catalog)
    unknown = [a for a in wanted if a not in catalog]
    if unknown:
        print(json.dumps({"error": f"unknown analyses {unknown}", "known": list(catalog)}))
        return 1
    written = {}
    for name in wanted:
        path = f"{args.out.rstrip('/')}/{name}"
        catalog[name]().write.mode("overwrite").parquet(path)
        written[name] = path
    print(json.dumps({"written": written}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
