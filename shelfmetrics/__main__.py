"""Run a report bundle as a Spark job.

    spark-submit --py-files shelfmetrics.zip shelfmetrics/__main__.py \\
        monthly --dataset shop --out /reports/2026-03 --month 2026-03
"""

from __future__ import annotations

import argparse
from datetime import date, datetime, timezone
from decimal import Decimal

from shelfmetrics.operators.inventory import ROCKET
from shelfmetrics.plans import bundles
from shelfmetrics.session import get_session
from shelfmetrics.sinks.files import write_report
from shelfmetrics.sinks.publish import publish
from shelfmetrics.sources.tables import read_table


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    today = datetime.now(timezone.utc).date()
    parser = argparse.ArgumentParser(prog="shelfmetrics", description=__doc__)
    parser.add_argument("report", choices=["daily", "inventory", "monthly", "ads"])
    parser.add_argument("--dataset", required=True, help="catalog database of the report tables")
    parser.add_argument("--out", required=True, help="output directory, one sub-directory per tab")
    parser.add_argument("--as-of", type=date.fromisoformat, default=today)
    parser.add_argument("--month", help="YYYY-MM, default: the month of --as-of")
    parser.add_argument("--target", type=Decimal, default=Decimal(bundles.DEFAULT_TARGET))
    parser.add_argument("--start", type=date.fromisoformat, help="default: 7 days before --as-of")
    parser.add_argument("--channel", default=ROCKET)
    parser.add_argument("--warehouse", default=ROCKET)
    parser.add_argument(
        "--publish", action="store_true", help="stage all tabs, then commit them at once by a manifest"
    )
    parser.add_argument(
        "--stamp", help="time of the report, default: now; a lost --publish run goes on under its stamp"
    )
    return parser.parse_args(argv)


def build(args: argparse.Namespace, table) -> bundles.Report:
    if args.report == "daily":
        return bundles.daily_sales_report(table("orders"), args.as_of)
    if args.report == "inventory":
        return bundles.weekly_inventory_alert(
            table("inventory"), table("orders"), args.as_of, args.channel, args.warehouse
        )
    if args.report == "monthly":
        month = args.month or f"{args.as_of:%Y-%m}"
        return bundles.monthly_business_report(
            table("orders"), table("inventory"), table("ad_campaigns"), month, args.as_of, args.target
        )
    return bundles.ad_roas_report(
        table("ad_campaigns"), table("ad_keywords"), args.as_of, args.start
    )


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = get_session(f"shelfmetrics-{args.report}")
    stamp = args.stamp or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    with build(args, lambda name: read_table(spark, args.dataset, name)) as report:
        if args.publish:
            manifest = publish(report, args.out, stamp)
            counts = {tab: told["rows"] for tab, told in manifest["tabs"].items()}
        else:
            counts = write_report(report, args.out, stamp)
        for tab, count in counts.items():
            print(f"{tab}: {count} rows")


if __name__ == "__main__":
    main()
