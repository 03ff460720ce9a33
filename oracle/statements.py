"""DuckDB statements that recompute every registered query from the test tables.

They share no code with the package. Grades are looked up by counting the limits a
value has passed, instead of the package's chained conditions.
"""

from __future__ import annotations

ORDER_LINES = """order_lines AS (
  SELECT l_orderkey AS order_id, o_orderdate AS order_date, c_mktsegment AS channel,
         p_type AS category, CAST(p_partkey AS VARCHAR) AS product_id,
         p_brand || '-' || p_type AS sku, p_brand || ' ' || p_type AS product_name,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS revenue,
         CAST(p_retailprice AS DECIMAL(18,2))
           * CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(10,0)) AS cost,
         l_extendedprice / l_quantity AS unit_price, p_retailprice AS unit_cost
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey)"""

STOCK = """stock AS (
  SELECT p_brand || '-' || p_type AS sku, p_brand || ' ' || p_type AS product_name,
         r_name AS warehouse,
         CAST((sum(p_size) * (r_regionkey + 1) * 7) % 900 AS BIGINT) AS current_stock
  FROM part, region GROUP BY p_brand, p_type, r_name, r_regionkey)"""

AD_FACTS = """ad_facts AS (
  SELECT 'C' || lpad(CAST(user_id % 20 AS VARCHAR), 3, '0') AS campaign_id,
         'campaign_' || (user_id % 20) AS campaign_name, 'platform_' || (user_id % 3) AS platform,
         'kw_' || (k % 10) AS keyword,
         ['exact', 'phrase', 'broad'][CAST((k % 10) % 3 + 1 AS INT)] AS match_type, ts,
         CASE event_type WHEN 'view' THEN 1000 ELSE 0 END AS impressions,
         CASE event_type WHEN 'click' THEN 40 ELSE 0 END AS clicks,
         CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END AS purchases,
         CAST(value AS DECIMAL(18,2))
           * CASE event_type WHEN 'click' THEN 100 WHEN 'error' THEN 20 ELSE 0 END AS spend,
         CAST(value AS DECIMAL(18,2)) * CASE event_type WHEN 'purchase' THEN 300 ELSE 0 END AS sales
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""


def half_away(x: str, places: int = 0) -> str:
    scale = f"{10**places}.0::DOUBLE"
    return f"(sign({x}) * floor(abs({x}) * {scale} + 0.5::DOUBLE) / {scale})"


def ratio(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def percent(a: str, b: str, places: int = 1) -> str:
    return half_away(f"({ratio(a, b)} * 100)", places)


def growth(now: str, before: str) -> str:
    return percent(f"({now} - {before})", before)


def passed(value: str, test: str, limits: list[str], labels: list[str]) -> str:
    """The label after as many limits as ``value`` fails; NULL fails them all."""
    failed = " + ".join(f"CAST(NOT coalesce({value} {test} {x}, false) AS INT)" for x in limits)
    listed = ", ".join(f"'{label}'" for label in labels)
    return f"[{listed}][1 + {failed}]"


def day_window(first: str, last: str, column: str = "order_date") -> str:
    return f"CAST({column} AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'"


def money(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE)"


def mean(x: str, places: int = 18) -> str:
    """Mean over decimals, taken from the printed digits of the double."""
    digits = f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,{places}))"
    return f"(CAST(sum({digits}) AS DOUBLE) / count({x}))"


def whole(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


MARCH = day_window("2001-03-01", "2001-03-31")
MARCH_2000 = day_window("2000-03-01", "2000-03-31")
YEAR_TO_DATE = day_window("2001-01-01", "2001-07-31")

# Sales ------------------------------------------------------------------------

DAILY = f"""{with_(ORDER_LINES)}
SELECT *, total_revenue - total_cost AS gross_profit,
       {ratio("(total_revenue - total_cost)", "total_revenue")} * 100 AS gpm_pct
FROM (SELECT CAST(order_date AS DATE) AS sale_date, channel, category,
             count(DISTINCT order_id) AS order_count, {whole("quantity")} AS total_qty,
             {money("revenue")} AS total_revenue, {money("cost")} AS total_cost
      FROM order_lines WHERE {day_window("2001-03-15", "2001-03-15")} GROUP BY ALL)"""

WEEKLY = f"""{with_(ORDER_LINES)}
SELECT week_start, channel, orders, revenue, revenue - cost AS profit,
       {percent("(revenue - cost)", "revenue")} AS gpm_pct,
       {growth("revenue", "before")} AS wow_change_pct
FROM (SELECT *, lag(revenue) OVER (PARTITION BY channel ORDER BY week_start) AS before
      FROM (SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start, channel,
                   count(DISTINCT order_id) AS orders, {money("revenue")} AS revenue,
                   {money("cost")} AS cost
            FROM order_lines WHERE {day_window("2001-05-08", "2001-07-31")} GROUP BY ALL))"""


def month_cells(name: str, window: str) -> str:
    return f"""{name} AS (
  SELECT channel, category, count(DISTINCT order_id) AS orders, sum(revenue) AS revenue,
         sum(cost) AS cost
  FROM order_lines WHERE {window} GROUP BY ALL)"""


BOTH_MONTHS = f"""{month_cells("now_cells", MARCH)},
{month_cells("then_cells", MARCH_2000)},
pairs AS (
  SELECT coalesce(n.channel, t.channel) AS channel, coalesce(n.category, t.category) AS category,
         n.orders AS n_orders, n.revenue AS n_revenue, n.cost AS n_cost,
         t.orders AS t_orders, t.revenue AS t_revenue, t.cost AS t_cost
  FROM now_cells n FULL JOIN then_cells t ON n.channel = t.channel AND n.category = t.category)"""

MONTH_DETAIL = f"""{with_(ORDER_LINES, BOTH_MONTHS)},
d AS (SELECT channel, category, n_orders, t_orders, CAST(n_revenue AS DOUBLE) AS nr,
             CAST(n_revenue AS DOUBLE) - CAST(n_cost AS DOUBLE) AS np,
             CAST(t_revenue AS DOUBLE) AS tr,
             CAST(t_revenue AS DOUBLE) - CAST(t_cost AS DOUBLE) AS tp FROM pairs)
SELECT channel, category,
       coalesce(n_orders, 0) AS cur_orders, coalesce(nr, 0) AS cur_revenue,
       coalesce(np, 0) AS cur_profit, coalesce({percent("np", "nr")}, 0) AS cur_gpm_pct,
       coalesce(t_orders, 0) AS yoy_orders, coalesce(tr, 0) AS yoy_revenue,
       coalesce(tp, 0) AS yoy_profit, coalesce({percent("tp", "tr")}, 0) AS yoy_gpm_pct,
       {growth("nr", "tr")} AS revenue_yoy_pct, {growth("n_orders", "t_orders")} AS orders_yoy_pct,
       {growth("np", "tp")} AS profit_yoy_pct,
       {percent("nr", "50000000")} AS target_contribution_pct
FROM d"""

MONTH_TOTAL = f"""{with_(ORDER_LINES, BOTH_MONTHS)},
ytd AS (SELECT {money("revenue")} AS ytd_revenue FROM order_lines WHERE {YEAR_TO_DATE}),
d AS (SELECT {whole("n_orders")} AS n_orders, {whole("t_orders")} AS t_orders,
             {money("n_revenue")} AS nr, {money("n_revenue")} - {money("n_cost")} AS np,
             {money("t_revenue")} AS tr, {money("t_revenue")} - {money("t_cost")} AS tp FROM pairs)
"""

MONTH_SUMMARY = f"""{MONTH_TOTAL}
SELECT '** TOTAL **' AS channel, '** ALL **' AS category,
       n_orders AS cur_orders, nr AS cur_revenue, np AS cur_profit,
       {percent("np", "nr")} AS cur_gpm_pct,
       t_orders AS yoy_orders, tr AS yoy_revenue, tp AS yoy_profit,
       {percent("tp", "tr")} AS yoy_gpm_pct,
       {growth("nr", "tr")} AS revenue_yoy_pct, {growth("n_orders", "t_orders")} AS orders_yoy_pct,
       {growth("np", "tp")} AS profit_yoy_pct,
       {percent("nr", "50000000")} AS target_achievement_pct, ytd_revenue
FROM d, ytd"""

YTD = f"""{with_(ORDER_LINES)}
SELECT strftime(order_date, '%Y-%m') AS month, {money("revenue")} AS cumulative_revenue
FROM order_lines WHERE {YEAR_TO_DATE} GROUP BY ALL"""

TOP = f"""{with_(ORDER_LINES)}
SELECT product_id, product_name, sku, total_qty, total_revenue, order_count, avg_price,
       {percent("(total_revenue - c)", "total_revenue")} AS gpm_pct
FROM (SELECT product_id, product_name, sku, {whole("quantity")} AS total_qty,
             {money("revenue")} AS total_revenue, count(DISTINCT order_id) AS order_count,
             {half_away(mean("unit_price"))} AS avg_price, {money("cost")} AS c
      FROM order_lines WHERE {MARCH} GROUP BY ALL)
ORDER BY total_revenue DESC, product_id, product_name, sku LIMIT 20"""

# Inventory --------------------------------------------------------------------


def demand(name: str, days: str, keys: str = "sku", more: str = "") -> str:
    return f"""{name} AS (
  SELECT {keys}, CAST(order_date AS DATE) AS d, sum(quantity) AS q FROM order_lines
  WHERE {day_window(days, "2001-07-31")} {more} GROUP BY ALL)"""


STATUS = f"""{STOCK}, {demand("by_day", "2001-07-01")},
mean AS (SELECT sku, avg(q) AS m FROM by_day GROUP BY sku),
status AS (
  SELECT sku, product_name, warehouse, current_stock, {half_away("m", 1)} AS avg_daily_sales,
         {half_away("days")} AS days_of_stock,
         {passed("days", "<", ["7", "14", "30"], ["🔴 긴급", "🟡 주의", "🟢 양호", "⚪ 저회전"])} AS status
  FROM (SELECT stock.*, m, CASE WHEN m > 0 THEN current_stock / m END AS days
        FROM stock LEFT JOIN mean USING (sku)))"""

FORECAST = f"""{with_(ORDER_LINES, STOCK, demand("by_day", "2001-06-01", "sku, product_name"))},
shape AS (
  SELECT sku, min(product_name) AS name,
         avg(q) FILTER (d >= DATE '2001-07-24') AS m7, avg(q) FILTER (d >= DATE '2001-07-17') AS m14,
         avg(q) FILTER (d >= DATE '2001-07-01') AS m30,
         avg(q) FILTER (d BETWEEN DATE '2001-07-17' AND DATE '2001-07-23') AS before,
         stddev_samp(q) FILTER (d >= DATE '2001-07-01') AS s30
  FROM by_day GROUP BY sku),
j AS (SELECT sku, name, warehouse, current_stock, m7, m14, m30, before, s30,
             {ratio("current_stock", "m7")} AS days, {ratio("(m7 - m30)", "m30")} AS trend
      FROM stock JOIN shape USING (sku) WHERE m7 > 0)
SELECT sku, name AS product_name, warehouse, current_stock,
       {half_away("m7", 1)} AS ma_7d, {half_away("m14", 1)} AS ma_14d, {half_away("m30", 1)} AS ma_30d,
       {half_away("days")} AS depletion_days_7d,
       {half_away(ratio("current_stock", "m14"))} AS depletion_days_14d,
       {half_away(ratio("current_stock", "m30"))} AS depletion_days_30d,
       DATE '2001-07-31' + CAST({half_away("days")} AS INT) AS estimated_depletion_date,
       {half_away("(trend * 100)", 1)} AS trend_pct,
       {half_away("(m7 - before)", 2)} AS weekly_acceleration,
       {percent("s30", "m30")} AS demand_cv_pct,
       {passed("days", "<", ["7", "14", "30"],
               ["🔴 7일 내 소진", "🟡 2주 내 소진", "🟢 1개월 내 소진", "⚪ 여유"])} AS forecast_status,
       {passed("trend", ">", ["0.2::DOUBLE", "0", "-0.2::DOUBLE"],
               ["📈 급증", "↗️ 증가", "↘️ 감소", "📉 급감"])} AS trend_direction
FROM j"""

REORDER = f"""{with_(ORDER_LINES, STOCK, demand("by_day", "2001-07-01"))},
spread AS (SELECT sku, avg(q) AS m, coalesce(stddev_samp(q), 0) AS s FROM by_day GROUP BY sku),
plan AS (
  SELECT sku, product_name, warehouse, current_stock, {half_away("m", 1)} AS avg_daily_sales,
         {half_away("s", 1)} AS sales_stddev, CAST(7 AS BIGINT) AS lead_time_days,
         {half_away("(m * 7)")} AS lead_time_demand,
         {half_away("(1.65::DOUBLE * s * sqrt(7))")} AS safety_stock,
         {half_away("(m * 7 + 1.65::DOUBLE * s * sqrt(7))")} AS reorder_point,
         {half_away(ratio("current_stock", "m"))} AS days_of_stock
  FROM stock JOIN spread USING (sku) WHERE m > 0)
SELECT *, CASE WHEN reorder_point > current_stock THEN reorder_point - current_stock ELSE 0 END
            AS order_quantity,
       {half_away(ratio("(current_stock - reorder_point)", "avg_daily_sales"))} AS days_until_reorder,
       {passed("current_stock", "<=", ["safety_stock", "reorder_point", "reorder_point * 1.2::DOUBLE"],
               ["🔴 긴급발주", "🟡 발주필요", "🟢 발주임박", "⚪ 여유"])} AS alert_level
FROM plan WHERE current_stock <= reorder_point * 1.2::DOUBLE"""

RISK = f"""{demand("fast_days", "2001-07-17", "sku, product_name", "AND channel = 'BUILDING'")},
fast AS (
  SELECT sku, min(product_name) AS name, avg(q) AS m, max(q) AS peak,
         avg(q) FILTER (d >= DATE '2001-07-24') AS recent,
         avg(q) FILTER (d < DATE '2001-07-24') AS before
  FROM fast_days GROUP BY sku),
risk AS (
  SELECT f.sku, name AS product_name, current_stock AS rocket_stock,
         {half_away("m", 1)} AS avg_daily_sales,
         {half_away("CAST(peak AS DOUBLE)")} AS peak_daily_sales,
         {half_away(ratio("current_stock", "m"))} AS days_remaining,
         {growth("recent", "before")} AS sales_acceleration_pct,
         {passed(ratio("current_stock", "m"), "<", ["3", "7", "14"],
                 ["🚨 즉시 입고", "⚠️ 입고 필요", "📋 모니터링", "✅ 안전"])} AS risk_level
  FROM fast f JOIN stock s ON s.sku = f.sku AND warehouse = 'ASIA'
  WHERE {ratio("current_stock", "m")} < 14)"""

STATUS_COUNTS = """counts AS (
  SELECT count(*) FILTER (status LIKE '%긴급%') AS critical_count,
         count(*) FILTER (status LIKE '%주의%') AS warning_count FROM status)"""

URGENT = f"""{with_(ORDER_LINES, STATUS, RISK)}
SELECT '재고' AS source, sku, product_name, days_of_stock AS days_left
FROM status WHERE status LIKE '%긴급%'
UNION ALL
SELECT '로켓', sku, product_name, days_remaining FROM risk WHERE risk_level LIKE '%즉시%'"""

ALERTS = f"""{with_(ORDER_LINES, STATUS, RISK, STATUS_COUNTS)}
SELECT critical_count, warning_count, n AS immediate_count, critical_count + n AS urgent_total
FROM counts, (SELECT count(*) AS n FROM risk WHERE risk_level LIKE '%즉시%')"""

KPIS = f"""{MONTH_TOTAL}, {STATUS}, {STATUS_COUNTS},
kpi AS (SELECT {percent("nr", "50000000")} AS target_pct, {growth("nr", "tr")} AS yoy, nr,
               critical_count, warning_count FROM d, counts)
SELECT 1 AS position, '당월 매출' AS item,
       coalesce(CAST(CAST(nr AS DECIMAL(38,2)) AS VARCHAR), '0') AS value FROM kpi
UNION ALL SELECT 2, '매출 YoY 증감률',
       coalesce(CAST(CAST(yoy AS DECIMAL(38,1)) AS VARCHAR), 'N/A') || '%' FROM kpi
UNION ALL SELECT 3, '목표 달성률',
       coalesce(CAST(CAST(target_pct AS DECIMAL(38,1)) AS VARCHAR), 'N/A') || '%' FROM kpi
UNION ALL SELECT 4, '매출 목표', '50000000' FROM kpi
UNION ALL SELECT 5, '긴급 SKU', CAST(critical_count AS VARCHAR) FROM kpi
UNION ALL SELECT 6, '주의 SKU', CAST(warning_count AS VARCHAR) FROM kpi"""

# Advertising ------------------------------------------------------------------


def ad_sums(keys: str, first: str, last: str) -> str:
    return f"""(SELECT {keys}, {whole("impressions")} AS imp, {whole("clicks")} AS clk,
              {whole("purchases")} AS ord, {money("spend")} AS sp, {money("sales")} AS rev
       FROM ad_facts WHERE {day_window(first, last, "ts")} GROUP BY ALL)"""


def campaigns(first: str, last: str) -> str:
    return f"""campaigns AS (
  SELECT campaign_id, campaign_name, platform, imp AS impressions, clk AS clicks,
         {percent("clk", "imp", 2)} AS ctr_pct, sp AS total_spend, rev AS attributed_revenue,
         {half_away(ratio("rev", "sp"), 2)} AS roas, ord AS orders,
         {half_away(ratio("sp", "ord"))} AS cpa,
         {passed(ratio("rev", "sp"), ">=", ["5", "3", "1"],
                 ["🟢 우수", "🟡 양호", "🟠 주의", "🔴 적자"])} AS efficiency
  FROM {ad_sums("campaign_id, campaign_name, platform", first, last)})"""


def keywords(first: str, last: str) -> str:
    rate = ratio("ord", "clk")
    return f"""keywords AS (
  SELECT keyword, match_type, campaign_name, platform, imp AS impressions, clk AS clicks,
         {percent("clk", "imp", 2)} AS ctr_pct, sp AS keyword_spend,
         {half_away(ratio("sp", "clk"))} AS cpc, ord AS conversions,
         {percent("ord", "clk", 2)} AS cvr_pct, rev AS revenue,
         {half_away(ratio("rev", "sp"), 2)} AS roas, {half_away(ratio("sp", "ord"))} AS cpa,
         {passed(ratio("rev", "sp"), ">=", ["5", "3", "1"],
                 ["🟢 핵심 키워드", "🟡 유지 키워드", "🟠 개선 필요", "🔴 중단 검토"])} AS keyword_grade,
         CASE WHEN clk < 10 THEN '데이터 부족' WHEN clk < 100 THEN '보통'
              WHEN {rate} >= 0.05::DOUBLE THEN '높은 전환'
              WHEN {rate} < 0.01::DOUBLE THEN '낮은 전환' ELSE '보통' END AS conversion_quality
  FROM {ad_sums("keyword, match_type, campaign_name, platform", first, last)}
  WHERE imp > 0)"""


WEEK = ("2024-01-05", "2024-01-12")
ALL_DAYS = ("2024-01-01", "2024-01-30")

SPEND = f"""{with_(AD_FACTS)}
SELECT report_date, platform, sp AS daily_spend, imp AS impressions, clk AS clicks, ord AS orders,
       {half_away("c")} AS cpc, {half_away(ratio("sp", "imp") + " * 1000")} AS cpm,
       {half_away(ratio("sp", "ord"))} AS cpa, {percent("clk", "imp", 2)} AS ctr_pct,
       {percent("ord", "clk", 2)} AS cvr_pct, {half_away(ratio("rev", "sp"), 2)} AS roas,
       {growth("c", "before")} AS cpc_change_pct,
       {passed(ratio("sp", "ord"), "<=", ["3000", "5000", "8000"],
               ["🟢 고효율", "🟡 보통", "🟠 비효율", "🔴 과다지출"])} AS spend_efficiency
FROM (SELECT *, lag(c) OVER (PARTITION BY platform ORDER BY report_date) AS before
      FROM (SELECT *, {ratio("sp", "clk")} AS c
            FROM {ad_sums("CAST(ts AS DATE) AS report_date, platform", *ALL_DAYS)}))"""

AD_WEEKS = f"""{with_(AD_FACTS)}
SELECT week_start, sp AS weekly_spend, rev AS weekly_revenue,
       {half_away(ratio("rev", "sp"), 2)} AS weekly_roas, ord AS weekly_orders,
       {half_away(ratio("sp", "ord"))} AS weekly_cpa, {percent("clk", "imp", 2)} AS weekly_ctr_pct,
       {percent("ord", "clk", 2)} AS weekly_cvr_pct
FROM {ad_sums("CAST(date_trunc('week', ts) AS DATE) AS week_start", "2024-01-02", "2024-01-30")}"""

OVERALL = f"""{with_(AD_FACTS, campaigns(*WEEK), keywords(*WEEK))}
SELECT campaign_count, total_spend, total_revenue, deficit_count,
       CASE WHEN total_spend > 0 THEN {half_away(ratio("total_revenue", "total_spend"), 2)}
            ELSE 0 END AS overall_roas, stop_keyword_count
FROM (SELECT count(*) AS campaign_count, count(*) FILTER (roas < 1) AS deficit_count,
             coalesce({money("CAST(CAST(total_spend AS VARCHAR) AS DECIMAL(38,8))")}, 0) AS total_spend,
             coalesce({money("CAST(CAST(attributed_revenue AS VARCHAR) AS DECIMAL(38,8))")}, 0) AS total_revenue
      FROM campaigns),
     (SELECT count(*) FILTER (keyword_grade LIKE '%중단%') AS stop_keyword_count FROM keywords)"""

# Product ----------------------------------------------------------------------

GPM = f"""{with_(ORDER_LINES)}
SELECT sku, product_name, category, channel, total_qty, {half_away("r")} AS revenue,
       {half_away("c")} AS cogs, {half_away("(r - c)")} AS gross_profit,
       {percent("(r - c)", "r")} AS gpm_pct, {half_away("p")} AS avg_selling_price,
       {half_away("u")} AS avg_unit_cost,
       {passed(ratio("(r - c)", "r"), ">=", ["0.4::DOUBLE", "0.25::DOUBLE", "0.1::DOUBLE"],
               ["🟢 고수익", "🟡 보통", "🟠 저수익", "🔴 적자위험"])} AS gpm_tier
FROM (SELECT sku, product_name, category, channel, {whole("quantity")} AS total_qty,
             {money("revenue")} AS r, {money("cost")} AS c,
             {mean("unit_price")} AS p, {mean("unit_cost")} AS u
      FROM order_lines WHERE {MARCH} GROUP BY ALL)
WHERE total_qty >= 10"""

PRICES = f"""prices AS (
  SELECT sku, product_name, category, channel, {mean("unit_price")} AS p, {whole("quantity")} AS qty,
         {money("revenue")} AS r,
         {mean("((unit_price - unit_cost) / nullif(unit_price, 0))")} * 100 AS margin
  FROM order_lines WHERE {MARCH} GROUP BY ALL),
shelf AS (
  SELECT category, channel, {mean("p")} AS mean, min(p) AS low, max(p) AS high,
         count(DISTINCT sku) AS skus FROM prices GROUP BY ALL),
placed AS (SELECT * FROM prices JOIN shelf USING (category, channel))"""


def by_mean(labels: list[str]) -> str:
    return passed("p", "<", [f"mean * {x}::DOUBLE" for x in ("0.7", "0.9", "1.1", "1.3")], labels)


COMPETITION = f"""{with_(ORDER_LINES, PRICES)}
SELECT sku, product_name, category, channel, {half_away("p")} AS avg_selling_price,
       {half_away("mean")} AS category_avg_price, {percent("p", "mean")} AS price_index,
       {percent("(p - low)", "(high - low)")} AS price_percentile, qty AS total_qty,
       {half_away("r")} AS revenue, {half_away("margin", 1)} AS margin_pct,
       {by_mean(["① 저가", "② 중저가", "③ 중간", "④ 중고가", "⑤ 고가"])} AS price_tier,
       CASE WHEN p < mean * 0.9::DOUBLE
              THEN if(margin >= 25, '🟢 가격우위+고마진', if(margin < 25, '🟡 가격우위+저마진', '⚪ 분류불가'))
            WHEN p <= mean * 1.1::DOUBLE THEN '🔵 적정가격'
            WHEN p > mean * 1.1::DOUBLE THEN if(qty >= 50, '🟣 프리미엄(판매호조)', '🔴 고가(판매부진)')
            ELSE '⚪ 분류불가' END AS competitiveness_label,
       {percent("p", "high")} AS pct_of_max_price, skus AS category_sku_count
FROM placed WHERE qty >= 5"""

BANDS = f"""{with_(ORDER_LINES, PRICES)}
SELECT category, channel,
       {by_mean(["① 저가 (~70%)", "② 중저가 (70~90%)", "③ 중간 (90~110%)",
                 "④ 중고가 (110~130%)", "⑤ 고가 (130%~)"])} AS price_band,
       count(DISTINCT sku) AS sku_count, {whole("qty")} AS band_total_qty,
       {half_away(mean("p"))} AS band_avg_price, {half_away(mean("margin"), 1)} AS band_avg_margin_pct
FROM placed GROUP BY ALL"""

SHELVES = f"""{with_(ORDER_LINES, PRICES)},
steps AS (SELECT unnest(range(101)) AS i),
ranked AS (SELECT category, channel, p, skus, row_number() OVER w AS n, count(*) OVER (
             PARTITION BY category, channel) AS size
           FROM placed WINDOW w AS (PARTITION BY category, channel ORDER BY p))
SELECT s.category, s.channel, mean AS cat_avg_price, low AS cat_min_price, high AS cat_max_price,
       s.skus AS sku_count, CAST(i AS INT) AS percentile, r.p AS quantile_price
FROM shelf s, steps, ranked r
WHERE r.category = s.category AND r.channel = s.channel
  AND r.n = greatest(1, (i * size + 99) // 100)"""

# Funding and profile ----------------------------------------------------------

FUNDING = """SELECT date, sku_id, quantity, quantity * 125000 AS funding_cost,
       price * quantity AS sample_supply_cost,
       quantity * 125000 + price * quantity AS total_cost
FROM (SELECT last_day(o_orderdate) AS date, l_partkey AS sku_id,
             CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
LEFT JOIN (SELECT p_partkey AS sku_id, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part)
  USING (sku_id)"""

# Test tables: column and type, with * on REQUIRED and + on REPEATED columns.
TABLES = {
    "region": "*r_regionkey INTEGER, r_name STRING",
    "nation": "*n_nationkey INTEGER, n_name STRING, n_regionkey INTEGER",
    "customer": "*c_custkey INTEGER, c_name STRING, c_nationkey INTEGER, c_acctbal FLOAT, "
    "c_mktsegment STRING",
    "supplier": "*s_suppkey INTEGER, s_name STRING, s_nationkey INTEGER, s_acctbal FLOAT",
    "part": "*p_partkey INTEGER, p_name STRING, p_brand STRING, p_type STRING, p_size INTEGER, "
    "p_retailprice FLOAT",
    "orders": "*o_orderkey INTEGER, *o_custkey INTEGER, o_orderstatus STRING, o_totalprice FLOAT, "
    "o_orderdate DATETIME, o_orderpriority STRING",
    "lineitem": "*l_orderkey INTEGER, *l_partkey INTEGER, l_suppkey INTEGER, "
    "*l_linenumber INTEGER, l_quantity FLOAT, l_extendedprice FLOAT, l_discount FLOAT, "
    "l_tax FLOAT, l_returnflag STRING, l_linestatus STRING, l_shipdate DATETIME",
    "events": "*event_id INTEGER, *ts DATETIME, user_id INTEGER, event_type STRING, value FLOAT, "
    "props STRING",
    "documents": "*doc_id INTEGER, text STRING, lang STRING, source STRING, n_chars INTEGER",
    "embeddings": "*vec_id INTEGER, +embedding FLOAT, label INTEGER",
    "pages": "*page_id INTEGER, url STRING, html STRING",
    "benchmark": "*item_id INTEGER, text STRING",
    "labels": "*doc_id INTEGER, quality INTEGER, toxic INTEGER",
    "conversations": "*conv_id INTEGER, *turn INTEGER, role STRING, text STRING",
}
MODES = {"*": "REQUIRED", "+": "REPEATED"}


def profile_sql() -> str:
    parts = []
    for table, columns in TABLES.items():
        listed = [c.split() for c in columns.split(", ")]
        for name, kind in listed:
            column, mode = name.lstrip("*+"), MODES.get(name[0], "NULLABLE")
            nulls = f"count(*) - count({column})"
            parts.append(
                f"SELECT '{table}' AS table_name, count(*) AS row_count, "
                f"CAST({len(listed)} AS BIGINT) AS column_count, '{column}' AS column_name, "
                f"'{kind}' AS type, '{mode}' AS mode, "
                f"{nulls} AS null_count, {nulls if mode == 'REQUIRED' else 'CAST(0 AS BIGINT)'} "
                f"AS required_violations FROM {table}"
            )
    return "\nUNION ALL ".join(parts)


# Bundles: cells ------------------------------------------------------------------


def cells(tab: str, source: str, columns: str, keys: str = "", headers: str = "") -> str:
    """Each value of ``source``, under its row's key; columns with # are doubles."""
    listed = columns.split()
    names = headers.split(", ") if headers else [c.lstrip("#") for c in listed]
    values = ", ".join(
        f"{{'header': '{name}', "
        + (
            f"'text': NULL::VARCHAR, 'number': CAST({column[1:]} AS DOUBLE)}}"
            if column.startswith("#")
            else f"'text': CAST({column} AS VARCHAR), 'number': NULL::DOUBLE}}"
        )
        for column, name in zip(listed, names, strict=True)
    )
    key = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys.split())
    return f"""SELECT tab, row_key, c.header AS header, c.text AS text, c.number AS number
FROM (SELECT '{tab}' AS tab, CAST(to_json([{key}]::VARCHAR[]) AS VARCHAR) AS row_key,
             unnest([{values}]) AS c FROM ({source}) AS t)"""


DAILY_CELLS = (
    "sale_date channel category order_count total_qty #total_revenue #total_cost #gross_profit "
    "#gpm_pct"
)
TOP_CELLS = "product_id product_name sku total_qty #total_revenue order_count #avg_price #gpm_pct"
TOP_KEY = "product_id product_name sku"
MONTH_CELLS = (
    "channel category cur_orders #cur_revenue #cur_profit #cur_gpm_pct yoy_orders #yoy_revenue "
    "#yoy_profit #yoy_gpm_pct #revenue_yoy_pct #orders_yoy_pct #profit_yoy_pct "
)
CAMPAIGN_CELLS = (
    "campaign_id campaign_name platform impressions clicks #ctr_pct #total_spend "
    "#attributed_revenue #roas orders #cpa efficiency"
)
CAMPAIGN_KEY = "campaign_id campaign_name platform"
KEYWORD_CELLS = (
    "keyword match_type campaign_name platform impressions clicks #ctr_pct #keyword_spend #cpc "
    "conversions #cvr_pct #revenue #roas #cpa keyword_grade conversion_quality"
)
KEYWORD_KEY = "keyword match_type campaign_name platform"
# The month's tab names columns by hand; these are the orders in which the sheets print them.
SOLD_SHEET = (
    "채널, 카테고리, 당월 주문수, 당월 매출, 당월 이익, 당월 GPM%, 전년 주문수, 전년 매출, 전년 이익, "
    "전년 GPM%, 매출 YoY%, 주문 YoY%, 이익 YoY%, 목표기여율%"
)
TOP_SHEET = "상품ID, 상품명, SKU, 판매수량, 매출, 주문수, 평균단가, GPM%"
STOCK_SHEET = "SKU, 상품명, 창고, 현재재고, 일평균판매, 잔여일수, 상태"
ADS_SHEET = (
    "캠페인ID, 캠페인명, 플랫폼, 노출수, 클릭수, CTR%, 광고비, 기여매출, ROAS, 주문수, CPA, 효율등급"
)


def on_days(sql: str, *days: tuple[str, str]) -> str:
    """The statement with other days in place of its own."""
    for own, other in days:
        assert own in sql
        sql = sql.replace(own, other)
    return sql


def bundle_cells() -> dict[str, str]:
    a_day = day_window("2001-03-15", "2001-03-15")
    ads = with_(AD_FACTS, campaigns(*WEEK), keywords(*WEEK))
    own_month = with_(AD_FACTS, campaigns("2024-01-01", "2024-01-31"))
    tabs = {
        "daily_sales_report_cells": [
            cells("daily_sales", DAILY, DAILY_CELLS, "sale_date channel category"),
            cells(
                "top_sellers",
                on_days(TOP, (MARCH, a_day), ("LIMIT 20", "LIMIT 10")),
                TOP_CELLS,
                TOP_KEY,
            ),
        ],
        "weekly_inventory_alert_cells": [
            cells("summary", ALERTS, "critical_count warning_count immediate_count urgent_total"),
            cells(
                "urgent_skus",
                URGENT,
                "source sku product_name #days_left",
                "source sku product_name",
            ),
        ],
        "monthly_business_report_cells": [
            cells("summary", KPIS, "item value", "item", "항목, 값"),
            cells(
                "monthly_sales",
                MONTH_DETAIL,
                MONTH_CELLS + "#target_contribution_pct",
                "channel category",
                SOLD_SHEET,
            ),
            cells(
                "monthly_total", MONTH_SUMMARY, MONTH_CELLS + "#target_achievement_pct #ytd_revenue"
            ),
            cells("top_sellers", TOP, TOP_CELLS, TOP_KEY, TOP_SHEET),
            cells(
                "stock_status",
                with_(ORDER_LINES, STATUS) + "SELECT * FROM status",
                "sku product_name warehouse current_stock #avg_daily_sales #days_of_stock status",
                "sku product_name warehouse",
                STOCK_SHEET,
            ),
            cells(
                "ad_performance",
                own_month + "SELECT * FROM campaigns",
                CAMPAIGN_CELLS,
                CAMPAIGN_KEY,
                ADS_SHEET,
            ),
        ],
        "ad_roas_report_cells": [
            cells("campaigns", ads + "SELECT * FROM campaigns", CAMPAIGN_CELLS, CAMPAIGN_KEY),
            cells(
                "deficit_campaigns",
                ads + "SELECT * FROM campaigns WHERE roas < 1",
                CAMPAIGN_CELLS,
                CAMPAIGN_KEY,
            ),
            cells(
                "spend_efficiency",
                on_days(SPEND, *zip(ALL_DAYS, WEEK, strict=True)),
                "report_date platform #daily_spend impressions clicks orders #cpc #cpm #cpa "
                "#ctr_pct #cvr_pct #roas #cpc_change_pct spend_efficiency",
                "report_date platform",
            ),
            cells("keywords", ads + "SELECT * FROM keywords", KEYWORD_CELLS, KEYWORD_KEY),
            cells(
                "stop_review_keywords",
                ads + "SELECT * FROM keywords WHERE keyword_grade LIKE '%중단%'",
                KEYWORD_CELLS,
                KEYWORD_KEY,
            ),
            cells(
                "weekly_trend",
                on_days(AD_WEEKS, ("2024-01-02", "2023-12-15"), ("2024-01-30", "2024-01-12")),
                "week_start #weekly_spend #weekly_revenue #weekly_roas weekly_orders #weekly_cpa "
                "#weekly_ctr_pct #weekly_cvr_pct",
                "week_start",
            ),
            cells(
                "summary",
                OVERALL,
                "campaign_count #total_spend #total_revenue deficit_count #overall_roas "
                "stop_keyword_count",
            ),
        ],
    }
    return {name: "\nUNION ALL ".join(parts) for name, parts in tabs.items()}


# Positions, publications, sources ---------------------------------------------------


def ranked(source: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {source}"


MONTH_TABS = {
    "summary": ("요약", f"({KPIS})"),
    "monthly_sales": ("매출요약", f"({MONTH_DETAIL})"),
    "monthly_total": ("매출요약", f"({MONTH_SUMMARY})"),
    "top_sellers": ("베스트셀러", f"({TOP})"),
    "stock_status": ("재고현황", f"({with_(ORDER_LINES, STATUS)} SELECT * FROM status)"),
    "ad_performance": (
        "광고성과", f"({with_(AD_FACTS, campaigns('2024-01-01', '2024-01-31'))} SELECT * FROM campaigns)"
    ),
}
STAMP = (
    "SELECT 'stamp' AS tab, '[\"' || tab || '\"]' AS row_key, c.header AS header, c.text AS text, "
    "NULL::DOUBLE AS number FROM (SELECT tab, unnest([{'header': 'report', 'text': 'monthly_business'}, "
    "{'header': 'generated_at', 'text': '2001-08-01 09:00:00'}, "
    "{'header': 'period', 'text': '2001-03-01 ~ 2001-03-31'}, {'header': 'title', 'text': title}, "
    "{'header': 'rows', 'text': n::VARCHAR}]) AS c FROM ("
    + " UNION ALL ".join(
        f"SELECT '{tab}' AS tab, '{title}' AS title, count(*) AS n FROM {source}"
        for tab, (title, source) in MONTH_TABS.items()
    )
    + "))"
)

ACTIVE = f"""{with_(ORDER_LINES, STOCK)}
SELECT sku, count(DISTINCT d) FILTER (d >= DATE '2001-07-24') AS active_days_7d,
       count(DISTINCT d) FILTER (d >= DATE '2001-07-17') AS active_days_14d,
       count(DISTINCT d) FILTER (d >= DATE '2001-07-01') AS active_days_30d,
       count(DISTINCT d) AS active_days_60d
FROM (SELECT sku, CAST(order_date AS DATE) AS d FROM order_lines
      WHERE {day_window("2001-06-01", "2001-07-31")} AND sku IN (SELECT sku FROM stock))
GROUP BY sku HAVING max(d) >= DATE '2001-07-24'"""

SHEET = """WITH f AS (SELECT *, (conv_id * 7 + turn) % 11 AS fault FROM conversations)
SELECT '' AS reason, 1::BIGINT AS n, conv_id, turn, role, text FROM f WHERE fault > 3
UNION ALL
SELECT ['too many cells', 'too few cells', 'turn: not a bigint', 'conv_id: missing'][fault + 1], count(*),
       NULL, NULL, NULL, NULL
FROM f WHERE fault <= 3 GROUP BY fault"""

WEEKEND_ROAS = (
    with_(AD_FACTS.replace("FROM events)", "FROM events WHERE isodow(ts) >= 6)"), campaigns(*ALL_DAYS))
    + "SELECT * FROM campaigns"
)


STOCK_DAYS = f"""{with_(ORDER_LINES, STOCK)},
days AS (SELECT CAST(unnest(generate_series(DATE '2001-07-02', DATE '2001-07-31', INTERVAL 1 DAY)) AS DATE) AS as_of),
by_day AS (SELECT sku, CAST(order_date AS DATE) AS d, sum(quantity) AS q FROM order_lines
           WHERE {day_window("2001-06-02", "2001-07-31")} GROUP BY ALL),
mean AS (SELECT as_of, sku, avg(q) AS m FROM by_day JOIN days ON d BETWEEN as_of - 30 AND as_of GROUP BY ALL)
SELECT as_of, sku, product_name, warehouse, current_stock, {half_away("m", 1)} AS avg_daily_sales,
       {half_away("days_left")} AS days_of_stock,
       {passed("days_left", "<", ["7", "14", "30"], ["🔴 긴급", "🟡 주의", "🟢 양호", "⚪ 저회전"])} AS status
FROM (SELECT days.as_of, stock.*, m, CASE WHEN m > 0 THEN current_stock / m END AS days_left
      FROM stock CROSS JOIN days LEFT JOIN mean ON mean.sku = stock.sku AND mean.as_of = days.as_of)"""

QUANTILES = f"""{with_(ORDER_LINES)},
l AS (SELECT channel, CAST(order_date AS DATE) AS d, unit_price AS v FROM order_lines
      WHERE {day_window("2001-03-01", "2001-05-31")} AND unit_price IS NOT NULL),
p AS (SELECT *, row_number() OVER (PARTITION BY d, channel ORDER BY v) AS r,
             (count(*) OVER (PARTITION BY d, channel) + 3) // 4 AS run FROM l),
s AS (SELECT channel, d, run, max(v) AS v, count(*) AS held FROM p GROUP BY channel, d, run, (r - 1) // run),
z AS (SELECT channel, CAST(sum(held) AS BIGINT) AS n FROM s GROUP BY channel),
b AS (SELECT channel, CAST(sum(run) AS BIGINT) AS bound
      FROM (SELECT DISTINCT channel, d, run FROM s) GROUP BY channel),
c AS (SELECT channel, v, held, sum(held) OVER (PARTITION BY channel ORDER BY v) AS high
      FROM (SELECT channel, v, sum(held) AS held FROM s GROUP BY ALL)),
a AS (SELECT unnest(range(0, 101, 5)) AS percentile),
q AS (SELECT channel, percentile, n, v, bound, greatest(1, (percentile * n + 99) // 100) AS rank, high, held
      FROM c JOIN z USING (channel) JOIN b USING (channel), a),
t AS (SELECT channel, v, min(i) AS low, max(i) AS top
      FROM (SELECT channel, v, row_number() OVER (PARTITION BY channel ORDER BY v) AS i FROM l) GROUP BY ALL)
SELECT channel, CAST(percentile AS INT) AS percentile, n, v AS value, bound,
       CAST(greatest(low - rank, rank - top, 0) AS BIGINT) AS rank_error
FROM q JOIN t USING (channel, v) WHERE rank <= high AND rank > high - held"""

EVENT_PROFILE = "\nUNION ALL ".join(
    f"SELECT 'events' AS table_name, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, "
    f"'{name}' AS column_name, '{kind}' AS type, '{mode}' AS mode, {nulls} AS null_count, "
    f"{nulls if mode == 'REQUIRED' else 'CAST(0 AS BIGINT)'} AS required_violations FROM events"
    for name, kind, mode, nulls in [
        ("event_id", "INTEGER", "REQUIRED", "count(*) - count(event_id)"),
        ("ts", "DATETIME", "REQUIRED", "count(*) - count(ts)"),
        ("user_id", "INTEGER", "NULLABLE", "count(*) - count(user_id)"),
        ("event_type", "STRING", "NULLABLE", "count(*) - count(event_type)"),
        ("value", "FLOAT", "NULLABLE", "count(*) - count(value)"),
        ("props", "RECORD", "NULLABLE", "count(*) - count(props)"),
        ("props.k", "INTEGER", "NULLABLE", "count(props) - count(json_extract(props, '$.k'))"),
    ]
)

SUMMARY_SHEET = f"""WITH kpis AS ({KPIS})
SELECT CASE WHEN position <= 4 THEN position + 4 ELSE position + 6 END AS position, item, value FROM kpis
UNION ALL SELECT 1, '월간 비즈니스 리포트', '2001-03'
UNION ALL SELECT 2, '최종 업데이트', '2001-08-01 09:00:00'
UNION ALL SELECT 3, '', NULL
UNION ALL SELECT 4, '항목', '값'
UNION ALL SELECT 9, '', NULL
UNION ALL SELECT 10, '재고 현황', NULL
UNION ALL SELECT 13, '', NULL
UNION ALL SELECT 14, '시트별 상세', NULL
UNION ALL SELECT 15, '매출요약', '채널별/카테고리별 YoY 비교'
UNION ALL SELECT 16, '베스트셀러', 'TOP 20 상품 매출순'
UNION ALL SELECT 17, '재고현황', '전 SKU 재고 소진 예측'
UNION ALL SELECT 18, '광고성과', '캠페인별 ROAS 분석'"""


def statements() -> dict[str, str]:
    return {
        "daily_sales_summary": DAILY,
        "weekly_trend": WEEKLY,
        "monthly_comparison_detail": MONTH_DETAIL,
        "monthly_comparison_summary": MONTH_SUMMARY,
        "ytd_revenue_by_month": YTD,
        "top_sellers": TOP,
        "stock_status": with_(ORDER_LINES, STATUS) + "SELECT * FROM status",
        "depletion_forecast": FORECAST,
        "reorder_alert": REORDER,
        "rocket_delivery_risk": with_(ORDER_LINES, STOCK, RISK) + "SELECT * FROM risk",
        "roas_by_campaign": with_(AD_FACTS, campaigns(*WEEK)) + "SELECT * FROM campaigns",
        "ad_spend_efficiency": SPEND,
        "keyword_performance": with_(AD_FACTS, keywords(*ALL_DAYS)) + "SELECT * FROM keywords",
        "gpm_analysis": GPM,
        "price_competitiveness": COMPETITION,
        "category_price_stats": SHELVES,
        "price_bands": BANDS,
        "weekly_ad_trend": AD_WEEKS,
        "deficit_campaigns": with_(AD_FACTS, campaigns(*WEEK))
        + "SELECT * FROM campaigns WHERE roas < 1",
        "stop_review_keywords": with_(AD_FACTS, keywords(*ALL_DAYS))
        + "SELECT * FROM keywords WHERE keyword_grade LIKE '%중단%'",
        "ad_overall_summary": OVERALL,
        "stock_status_counts": with_(ORDER_LINES, STATUS, STATUS_COUNTS) + "SELECT * FROM counts",
        "urgent_sku_list": URGENT,
        "inventory_alert_summary": ALERTS,
        "monthly_kpi_dashboard": KPIS,
        "reviewer_funding_costs": FUNDING,
        "table_profile": profile_sql(),
        **bundle_cells(),
        **{name.removesuffix("_cells"): sql for name, sql in bundle_cells().items()},
        "stock_status_ranked": with_(ORDER_LINES, STATUS)
        + ranked("status", "days_of_stock NULLS LAST, sku, warehouse"),
        "reorder_alert_ranked": ranked(
            f"({REORDER})",
            "list_position(['🔴 긴급발주', '🟡 발주필요', '🟢 발주임박', '⚪ 여유'], alert_level), "
            "days_of_stock, sku, warehouse",
        ),
        "price_competitiveness_ranked": ranked(
            f"({COMPETITION})",
            "category, price_percentile DESC NULLS LAST, channel, sku, product_name",
        ),
        "published_monthly_report": bundle_cells()["monthly_business_report_cells"] + "\nUNION ALL " + STAMP,
        "active_days": ACTIVE,
        "exported_parts_json": "SELECT * FROM part",
        "exported_parts_csv": "SELECT * FROM part",
        "exported_conversations_json": "SELECT * FROM conversations",
        "exported_conversations_csv": "SELECT * FROM conversations",
        "conversations_sheet": SHEET,
        "weekend_roas": WEEKEND_ROAS,
        "stock_status_daily": STOCK_DAYS,
        "price_quantiles_of_days": QUANTILES,
        "event_profile": EVENT_PROFILE,
        "monthly_summary_sheet": SUMMARY_SHEET,
    }
