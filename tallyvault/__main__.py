"""Command line: load the five source files into a vault and write the reports.

    python -m tallyvault --vault /data/vault --output /data/output \
        --customers-path ... --products-path ... --payments-path ... \
        --orders-path ... --events-path ...
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tallyvault.plans.pipeline import Load
from tallyvault.plans.report import (
    check_choices,
    default_queries,
    reported_tables,
    structure_report,
    write_analytics,
    write_lines,
)
from tallyvault.plans.staging import Staging
from tallyvault.plans.vault import StoredVault
from tallyvault.session import configured
from tallyvault.sources.readers import SourcePaths


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallyvault", description=__doc__.splitlines()[0])
    parser.add_argument("--vault", required=True, help="root folder of the vault tables")
    parser.add_argument("--output", required=True, help="folder for reports and results")
    parser.add_argument("--reset-db", action="store_true", help="empty the vault and log first")
    for source in ("customers", "products", "payments", "orders", "events"):
        parser.add_argument(f"--{source}-path", required=True)
    parser.add_argument(
        "--buckets", type=int, help="buckets of a new vault; by default the shuffle partitions, 0 for none"
    )
    parser.add_argument("--orders-layout", default="split", choices=["split", "lines", "array"])
    parser.add_argument("--events-layout", default="split", choices=["split", "document"])
    parser.add_argument(
        "--csv-multi-line", action="store_true", help="allow line feeds inside quoted CSV fields"
    )
    parser.add_argument("--json-null-token", help="text an explicit JSON null stands for")
    parser.add_argument("--preferred-currency", "--prefered_currency", default="RUB")
    parser.add_argument("--rub", default="1", help="value of one RUB")
    parser.add_argument("--usd", default="75", help="value of one USD")
    parser.add_argument("--eur", default="85", help="value of one EUR")
    parser.add_argument("--top-products-by", "--top_products_by", default="views")
    parser.add_argument(
        "--top-customers-last-date-by", "--top_customers_last_date_by", default="orders"
    )
    return parser


def run(spark: SparkSession, args: argparse.Namespace, now: datetime) -> dict[str, str]:
    """One complete run; returns the errors of the analytics queries."""
    rates = {"RUB": args.rub, "USD": args.usd, "EUR": args.eur}
    choices = (args.preferred_currency, rates, args.top_products_by, args.top_customers_last_date_by)
    check_choices(*choices)
    sources = SourcePaths(
        customers=args.customers_path,
        products=args.products_path,
        payments=args.payments_path,
        orders=args.orders_path,
        events=args.events_path,
        options={
            **dict.fromkeys(("customers", "products", "payments"), {"multi_line": args.csv_multi_line}),
            "orders": {"layout": args.orders_layout, "json_null_token": args.json_null_token},
            "events": {"layout": args.events_layout},
        },
    )
    raw = sources.read(spark)  # raises here if an input is missing
    buckets = StoredVault.default_buckets(spark, args.vault) if args.buckets is None else args.buckets
    vault = StoredVault(spark, args.vault, buckets or None)
    if args.reset_db:
        vault.clear()

    stamp = now.strftime("%Y%m%d_%H%M%S")
    staging = Staging(spark)
    load = Load(spark, vault, now, staging)
    try:
        load.run(raw)
        report = structure_report(reported_tables(load))
        write_lines(spark, report, f"{args.output}/structure_example_{stamp}.txt")
    finally:
        staging.drop()
    return write_analytics(spark, default_queries(vault, *choices), args.output, stamp)


def main(argv: list[str] | None = None) -> int:
    args = arguments().parse_args(argv)
    spark = configured(SparkSession.builder.appName("tallyvault")).getOrCreate()
    try:
        errors = run(spark, args, datetime.now())
    except (AnalysisException, ValueError) as error:
        print(f"ERROR: {error}", file=sys.stderr)
        return 1
    for name, error in errors.items():
        print(f"Analytics failed: {name}: {error}", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
