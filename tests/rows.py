"""Small hand-made report tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from shelfmetrics.sources.schemas import REPORT_TABLES
from shelfmetrics.sources.tables import conform

AS_OF = date(2026, 3, 20)


def back(days: int) -> datetime:
    day = AS_OF - timedelta(days=days)
    return datetime(day.year, day.month, day.day, 9, 30)


def _frame(spark, table: str, rows: list[dict], defaults: dict):
    schema = REPORT_TABLES[table]
    kinds = ", ".join(
        f"{f.name} {'double' if f.dataType.typeName() == 'decimal' else f.dataType.simpleString()}"
        for f in schema.fields
    )
    full = [{**defaults, **row} for row in rows]
    unknown = {name for row in full for name in row} - set(schema.names)
    assert not unknown, unknown
    df = spark.createDataFrame([tuple(row[n] for n in schema.names) for row in full], kinds)
    return conform(df, schema)


def orders(spark, *rows: dict):
    return _frame(
        spark,
        "orders",
        list(rows),
        dict(
            order_id="o1", order_date=back(0), channel="web", category="case", product_id="p1",
            product_name="Case", sku="s1", quantity=1, revenue=100.0, cost=60.0,
            unit_price=100.0, unit_cost=60.0,
        ),
    )


def inventory(spark, *rows: dict):
    return _frame(
        spark,
        "inventory",
        list(rows),
        dict(sku="s1", product_name="Case", warehouse="own", current_stock=100),
    )


_AD = dict(
    campaign_name="c one", platform="web", report_date=back(0), impressions=1000, clicks=100,
    ad_spend=1000.0, attributed_orders=10, attributed_revenue=5000.0,
)


def ad_campaigns(spark, *rows: dict):
    return _frame(spark, "ad_campaigns", list(rows), {**_AD, "campaign_id": "c1"})


def ad_keywords(spark, *rows: dict):
    return _frame(spark, "ad_keywords", list(rows), {**_AD, "keyword": "k1", "match_type": "exact"})


def only(df):
    """The single row of a result."""
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def by(df, *names: str) -> dict:
    """Rows keyed by one or more columns."""
    rows = df.collect()
    keyed = {tuple(r[n] for n in names) if len(names) > 1 else r[names[0]]: r for r in rows}
    assert len(keyed) == len(rows)
    return keyed
