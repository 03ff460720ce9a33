import pytest
from pyspark.sql import functions as F

from rows import AS_OF, by, only, orders
from shelfmetrics.functions.labels import PRICE_BAND, PRICE_TIER, competitiveness, grade
from shelfmetrics.operators import product as ops


def product(sku, price, qty=5, cost=0.0, **more):
    return dict(sku=sku, product_name=sku, unit_price=price, unit_cost=cost, quantity=qty, **more)


@pytest.mark.parametrize(
    "cost, tier",
    [(60.0, "🟢 고수익"), (60.01, "🟡 보통"), (75.0, "🟡 보통"), (75.01, "🟠 저수익"), (90.0, "🟠 저수익"), (90.01, "🔴 적자위험")],
)
def test_gpm_tier_limits(spark, cost, tier):
    df = orders(spark, dict(quantity=10, revenue=100.0, cost=cost))
    assert only(ops.gpm_analysis(df, AS_OF, AS_OF)).gpm_tier == tier


def test_gpm_needs_ten_units_and_grades_no_revenue_worst(spark):
    df = orders(
        spark,
        dict(sku="few", quantity=9),
        dict(sku="free", quantity=10, revenue=0.0, cost=2.5),
    )
    row = only(ops.gpm_analysis(df, AS_OF, AS_OF))
    assert (row.sku, row.gpm_pct, row.gpm_tier) == ("free", None, "🔴 적자위험")
    assert (row.cogs, row.gross_profit) == (3.0, -3.0)


def test_price_position(spark):
    df = orders(
        spark, product("a", 100.0, cost=50.0), product("b", 200.0), product("c", 300.0, qty=60),
        product("few", 200.0, qty=4),
    )
    rows = by(ops.price_competitiveness(df, AS_OF, AS_OF), "sku")
    assert set(rows) == {"a", "b", "c"}
    assert {r.category_avg_price for r in rows.values()} == {200.0}
    assert {r.category_sku_count for r in rows.values()} == {4}  # before the quantity filter
    assert [rows[s].price_index for s in "abc"] == [50.0, 100.0, 150.0]
    assert [rows[s].price_percentile for s in "abc"] == [0.0, 50.0, 100.0]
    assert [rows[s].pct_of_max_price for s in "abc"] == [33.3, 66.7, 100.0]
    assert [rows[s].price_tier for s in "abc"] == ["① 저가", "③ 중간", "⑤ 고가"]
    assert [rows[s].competitiveness_label for s in "abc"] == [
        "🟢 가격우위+고마진",
        "🔵 적정가격",
        "🟣 프리미엄(판매호조)",
    ]
    assert rows["a"].margin_pct == 50.0


def test_margin_is_a_mean_of_ratios_and_price_is_per_line(spark):
    df = orders(spark, product("a", 100.0, qty=1, cost=50.0), product("a", 200.0, qty=9, cost=50.0))
    row = only(ops.price_competitiveness(df, AS_OF, AS_OF))
    assert (row.avg_selling_price, row.margin_pct) == (150.0, 62.5)


def test_single_sku_category_has_no_position(spark):
    row = only(ops.price_competitiveness(orders(spark, product("a", 9.0)), AS_OF, AS_OF))
    assert (row.price_percentile, row.price_index) == (None, 100.0)


def test_unknown_price_is_high_and_unclassified(spark):
    df = orders(spark, product("a", None), product("b", 10.0))
    row = by(ops.price_competitiveness(df, AS_OF, AS_OF), "sku")["a"]
    assert (row.price_tier, row.competitiveness_label) == ("⑤ 고가", "⚪ 분류불가")
    assert row.avg_selling_price is row.price_index is None


def test_categories_with_null_keys_are_left_out(spark):
    df = orders(spark, product("a", 5.0, channel=None), product("b", 5.0))
    assert only(ops.price_competitiveness(df, AS_OF, AS_OF)).sku == "b"


def verdicts(spark, *rows):
    df = spark.createDataFrame(rows, "price double, mean double, margin double, qty long")
    price, mean = F.col("price"), F.col("mean")
    return [
        tuple(r)
        for r in df.select(
            grade(price, PRICE_TIER, mean),
            grade(price, PRICE_BAND, mean),
            competitiveness(price, mean, F.col("margin"), F.col("qty")),
        ).collect()
    ]


def test_price_at_exactly_1_1_times_the_mean(spark):
    # 8 * 1.1 and the double 8.8 are the same number.
    assert verdicts(spark, (8.8, 8.0, 30.0, 60)) == [
        ("④ 중고가", "④ 중고가 (110~130%)", "🔵 적정가격")
    ]


@pytest.mark.parametrize(
    "price, tier, band",
    [
        (69.9, "① 저가", "① 저가 (~70%)"),
        (70.0, "② 중저가", "② 중저가 (70~90%)"),
        (90.0, "③ 중간", "③ 중간 (90~110%)"),
        (110.1, "④ 중고가", "④ 중고가 (110~130%)"),
        (130.0, "⑤ 고가", "⑤ 고가 (130%~)"),
    ],
)
def test_price_tiers_and_bands(spark, price, tier, band):
    assert verdicts(spark, (price, 100.0, 0.0, 0))[0][:2] == (tier, band)


@pytest.mark.parametrize(
    "price, margin, qty, label",
    [
        (89.0, 25.0, 0, "🟢 가격우위+고마진"),
        (89.0, 24.9, 0, "🟡 가격우위+저마진"),
        (89.0, None, 0, "⚪ 분류불가"),
        (90.0, None, 0, "🔵 적정가격"),
        (111.0, None, 50, "🟣 프리미엄(판매호조)"),
        (111.0, None, 49, "🔴 고가(판매부진)"),
        (111.0, None, None, "⚪ 분류불가"),
    ],
)
def test_competitiveness_arms(spark, price, margin, qty, label):
    assert verdicts(spark, (price, 100.0, margin, qty))[0][2] == label


def test_price_bands_group_products(spark):
    df = orders(
        spark, product("a", 50.0, qty=1, cost=25.0), product("b", 60.0, qty=2, cost=15.0),
        product("c", 190.0, qty=4),
    )
    bands = by(ops.price_bands(df, AS_OF, AS_OF), "price_band")
    low, high = bands["① 저가 (~70%)"], bands["⑤ 고가 (130%~)"]
    assert (low.sku_count, low.band_total_qty, low.band_avg_price) == (2, 3, 55.0)
    assert low.band_avg_margin_pct == 62.5
    assert (high.sku_count, high.band_avg_margin_pct) == (1, 100.0)


def test_category_stats(spark):
    df = orders(spark, *[product(f"s{i}", float(i)) for i in range(1, 101)])
    row = only(ops.category_price_stats(df, AS_OF, AS_OF))
    assert (row.cat_avg_price, row.cat_min_price, row.cat_max_price) == (50.5, 1.0, 100.0)
    assert row.sku_count == 100
    assert len(row.price_quantiles) == 101
    assert (row.price_quantiles[0], row.price_quantiles[50], row.price_quantiles[100]) == (1, 50, 100)


def test_category_stats_keep_null_categories_and_count_a_sku_once(spark):
    df = orders(
        spark,
        product("a", 1.0, category=None),
        product("b", 2.0),
        {**product("b", 4.0), "product_name": "other name"},
    )
    rows = by(ops.category_price_stats(df, AS_OF, AS_OF), "category")
    assert (rows[None].cat_avg_price, rows[None].sku_count) == (1.0, 1)
    assert (rows["case"].cat_avg_price, rows["case"].sku_count) == (3.0, 1)
    assert set(rows["case"].price_quantiles) == {2.0, 4.0}


def test_quantile_ranks_of_exact_multiples(spark):
    df = orders(spark, *[product(f"s{i:02}", float(i)) for i in range(1, 26)])
    quantiles = only(ops.category_price_stats(df, AS_OF, AS_OF)).price_quantiles
    assert quantiles == [max(1, (i * 25 + 99) // 100) for i in range(101)]


@pytest.mark.parametrize("partitions", [4, 16])
def test_quantiles_of_a_large_shelf_are_exact(spark, partitions):
    n = 60_000
    price = (F.col("id") * 7919 % n + 1).cast("double")
    base = spark.range(n).repartition(partitions).select(
        F.col("id").cast("string").alias("sku"), F.lit("case").alias("category"),
        F.when(F.col("id") < 0, "web").alias("channel"), price.alias("mean_price"),
    )
    # one price that many products share
    hot = spark.range(n).select(
        F.concat(F.lit("h"), "id").alias("sku"), F.lit("hot"), F.lit("web"),
        F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id").cast("double")),
    )
    unknown = spark.createDataFrame([("u", "none", "web", None)], base.schema)
    rows = by(ops.category_price_stats(None, AS_OF, AS_OF, base.union(hot).union(unknown)), "category")
    assert rows["case"].price_quantiles == [max(1, i * n // 100) for i in range(101)]
    prices = sorted([5.0] * (n - n // 10) + [float(k) for k in range(0, n, 10)])
    assert rows["hot"].price_quantiles == [prices[max(1, i * n // 100) - 1] for i in range(101)]
    assert rows["none"].price_quantiles is None
