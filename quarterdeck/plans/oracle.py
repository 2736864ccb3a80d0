"""Oracle SQL (DuckDB dialect) for every registered query, over the driver's tables.

Written as plain decimal arithmetic: measures are summed and rounded as DECIMAL values, half away
from zero; shared CTEs mirror the adapter's mapping.
"""

from __future__ import annotations


def sround(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,8)), {n}) AS DOUBLE)"


def xsum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(24,6))) AS DOUBLE)"


GROSS = "CAST(l.l_extendedprice AS DECIMAL(18,2))"
DISC = f"ROUND({GROSS} * CAST(l.l_discount AS DECIMAL(4,2)), 2)"
TAX = f"ROUND(({GROSS} - {DISC}) * CAST(l.l_tax AS DECIMAL(4,2)), 2)"

BRONZE = f"""
bronze AS (
  SELECT
    CAST(o.o_orderdate AS DATE) AS business_date,
    n.n_name AS country_code,
    'LOC' || lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS location_id,
    n.n_name || ' Terminal' AS location_name,
    'U' || CAST(l.l_suppkey AS VARCHAR) AS unit_id,
    s.s_name AS unit_name,
    'T' || CAST(l.l_orderkey AS VARCHAR) AS transaction_id,
    'T' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_line_id,
    o.o_orderdate + to_seconds(CAST(18000 + (o.o_orderkey * 7919) % 64800 AS BIGINT)) AS transaction_completed_ts,
    'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
    p.p_name AS product_name,
    p.p_type AS product_category,
    l.l_linestatus = 'O' AS is_combo,
    l.l_quantity AS quantity,
    l.l_extendedprice AS gross_sales,
    CAST({DISC} AS DOUBLE) AS discount_amount,
    CAST({TAX} AS DOUBLE) AS tax_amount,
    CASE WHEN l.l_discount = 0 THEN 'NONE'
         WHEN l.l_discount < 0.03 THEN 'LOYALTY'
         WHEN l.l_discount < 0.06 THEN 'STAFF'
         WHEN l.l_discount < 0.09 THEN 'PROMO'
         ELSE 'WASTE' END AS discount_type,
    o.o_orderpriority AS discount_name,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'returned'
         WHEN o.o_orderstatus = 'P' AND l.l_returnflag = 'N' THEN 'cancelled'
         ELSE 'completed' END AS line_status,
    p.p_size > 3 AS is_priced_product,
    (p.p_type = 'ECONOMY' AND p.p_size <= 10) AS is_kitchen_instruction,
    CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS source_sequence,
    l.l_shipdate AS source_update_ts,
    l.l_shipdate + INTERVAL 2 HOUR AS extraction_ts,
    CASE WHEN r.r_name = 'MIDDLE EAST' THEN NULL
         ELSE 'pos_extract_' || strftime(l.l_shipdate, '%Y%m%d') || '.csv' END AS source_file_name,
    CASE WHEN r.r_name = 'MIDDLE EAST' THEN 'new_unit_json_files' ELSE 'pos_db_extract' END
      AS _source_ingestion_route
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RANKED = """
ranked AS (
  SELECT *, ROW_NUMBER() OVER (
      PARTITION BY business_date, transaction_id, transaction_line_id
      ORDER BY source_sequence DESC NULLS LAST, source_update_ts DESC NULLS LAST,
               extraction_ts DESC NULLS LAST, product_id DESC NULLS LAST, unit_id DESC NULLS LAST
    ) AS version_rank
  FROM bronze
),
dedup AS (SELECT * EXCLUDE (version_rank) FROM ranked WHERE version_rank = 1)"""

NSB = sround("coalesce(gross_sales, 0.0) - coalesce(discount_amount, 0.0) - coalesce(tax_amount, 0.0)", 2)


def _rules(src: str, name: str) -> str:
    return f"""
{name}_a AS (
  SELECT *, {NSB} AS net_sales_before_status FROM {src}
),
{name} AS (
  SELECT *,
    {sround("CASE WHEN lower(line_status) = 'cancelled' THEN 0.0 WHEN lower(line_status) = 'returned' THEN -abs(net_sales_before_status) ELSE net_sales_before_status END", 2)} AS net_sales,
    CASE WHEN coalesce(is_priced_product, false) AND NOT coalesce(is_kitchen_instruction, true)
         THEN coalesce(TRY_CAST(quantity AS DOUBLE), 0.0) ELSE 0.0 END AS enhanced_quantity,
    time_bucket(INTERVAL '15 minutes', transaction_completed_ts) AS quarter_hour_start_ts,
    strftime(time_bucket(INTERVAL '15 minutes', transaction_completed_ts), '%H:%M') AS quarter_hour_key
  FROM {name}_a
)"""


SILVER = _rules("dedup", "silver")

EVENT_UNIT = """
    'EVT_' || CAST((user_id // 15) % 5 AS VARCHAR) AS country_code,
    'LOC' || lpad(CAST((user_id // 15) % 5 AS VARCHAR), 3, '0') AS location_id,
    'E' || CAST(user_id // 15 AS VARCHAR) AS unit_id"""

EVENT_LINES = f"""
elines AS (
  SELECT CAST(ts AS DATE) AS business_date, {EVENT_UNIT},
    'E' || CAST(event_id AS VARCHAR) AS transaction_id,
    'E' || CAST(event_id AS VARCHAR) || '-1' AS transaction_line_id,
    ts AS transaction_completed_ts,
    value AS gross_sales, 0.0 AS discount_amount, 0.0 AS tax_amount,
    CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'completed' END AS line_status, 1.0 AS quantity,
    true AS is_priced_product, false AS is_kitchen_instruction
  FROM events WHERE event_type NOT IN ('view', 'click')
)"""

ESILVER = EVENT_LINES + "," + _rules("elines", "esilver")

ENERGY = f"""
readings AS (
  SELECT 'E' || CAST(user_id // 15 AS VARCHAR) AS unit_id, ts AS reading_ts, value AS kwh_consumed,
    CAST(ROUND(CAST(value AS DECIMAL(18,2)) * CAST('0.20' AS DECIMAL(4,2)), 2) AS DOUBLE) AS estimated_running_cost
  FROM events WHERE event_type IN ('view', 'click')
),
energy AS (
  SELECT unit_id, time_bucket(INTERVAL '15 minutes', reading_ts) AS quarter_hour_start_ts,
    {xsum("kwh_consumed")} AS kwh_consumed,
    {xsum("estimated_running_cost")} AS estimated_running_cost
  FROM readings GROUP BY 1, 2
)"""


def _bucket_sales(dated: bool) -> str:
    d = "business_date, " if dated else ""
    return f"""
bsales AS (
  SELECT {d}country_code, location_id, unit_id, quarter_hour_start_ts,
    {xsum("net_sales")} AS net_sales,
    SUM(enhanced_quantity) AS enhanced_quantity,
    COUNT(DISTINCT transaction_id) AS transaction_count
  FROM esilver GROUP BY ALL
)"""


def _break_even(dated: bool, idle: bool, multiplier: float = 1.0) -> str:
    join = "FULL JOIN" if idle else "LEFT JOIN"
    bd = ""
    if dated:
        bd = ("coalesce(s.business_date, CAST(e.quarter_hour_start_ts AS DATE))" if idle else "s.business_date") + " AS business_date,"
    return f"""
gold_a AS (
  SELECT {bd}
    s.country_code, s.location_id,
    coalesce(s.unit_id, e.unit_id) AS unit_id,
    coalesce(s.quarter_hour_start_ts, e.quarter_hour_start_ts) AS quarter_hour_start_ts,
    coalesce(s.net_sales, 0.0) AS net_sales,
    coalesce(s.enhanced_quantity, 0.0) AS enhanced_quantity,
    coalesce(s.transaction_count, 0) AS transaction_count,
    coalesce(e.kwh_consumed, 0.0) AS kwh_consumed,
    coalesce(e.estimated_running_cost, 0.0) AS estimated_running_cost,
    coalesce(e.estimated_running_cost, 0.0) * {multiplier!r} AS break_even_threshold
  FROM bsales s {join} energy e
    ON s.unit_id = e.unit_id AND s.quarter_hour_start_ts = e.quarter_hour_start_ts
),
gold AS (
  SELECT *, {sround("net_sales - break_even_threshold", 2)} AS profitability_gap,
    CASE WHEN {sround("net_sales - break_even_threshold", 2)} < 0 THEN 'review_open_close_time'
         ELSE 'keep_current_trading_window' END AS trading_recommendation
  FROM gold_a
)"""


BREAK_EVEN_VIEW = """
SELECT business_date, country_code, location_id, unit_id, quarter_hour_start_ts,
  strftime(quarter_hour_start_ts, '%H:%M') AS quarter_hour_key,
  net_sales, enhanced_quantity, transaction_count, estimated_running_cost,
  profitability_gap, trading_recommendation
FROM gold"""

DISCOUNT = f"""
strategy_a AS (
  SELECT country_code, location_id, unit_id, discount_type, discount_name, product_category,
    {xsum("gross_sales")} AS gross_sales,
    {xsum("discount_amount")} AS discount_amount,
    {xsum("net_sales")} AS net_sales,
    COUNT(DISTINCT transaction_id) AS transaction_count
  FROM silver GROUP BY ALL
),
strategy AS (
  SELECT *,
    {sround("coalesce(discount_amount / NULLIF(gross_sales, 0), 0.0) * 100", 2)} AS discount_rate_percent,
    {sround("coalesce(net_sales / NULLIF(transaction_count, 0), 0.0)", 2)} AS net_sales_per_transaction
  FROM strategy_a
)"""

COMBO = f"""
priced AS (
  SELECT product_id, product_name, is_combo, enhanced_quantity,
    net_sales / NULLIF(enhanced_quantity, 0) AS unit_net_price
  FROM silver WHERE enhanced_quantity > 0
),
standalone AS (
  SELECT product_id, product_name, AVG(unit_net_price) AS standalone_avg
  FROM priced WHERE is_combo = false GROUP BY ALL
),
combo AS (
  SELECT product_id, product_name, AVG(unit_net_price) AS combo_avg, SUM(enhanced_quantity) AS combo_units
  FROM priced WHERE is_combo = true GROUP BY ALL
),
combo_variance AS (
  SELECT c.product_id, c.product_name,
    {sround("c.combo_avg", 6)} AS combo_avg_unit_net_price,
    {sround("s.standalone_avg", 6)} AS standalone_avg_unit_net_price,
    {sround("c.combo_avg - s.standalone_avg", 2)} AS combo_vs_standalone_delta,
    {sround(sround("c.combo_avg - s.standalone_avg", 2) + " / NULLIF(s.standalone_avg, 0) * 100", 2)} AS combo_discount_percent,
    c.combo_units
  FROM combo c LEFT JOIN standalone s ON c.product_id = s.product_id AND c.product_name = s.product_name
)"""

OVERRIDES = """
overrides AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id,
    CAST(ROUND(CAST(p_retailprice AS DECIMAL(18,2)) * CAST('0.90' AS DECIMAL(4,2)), 2) AS VARCHAR) AS override_unit_price,
    p_size <= 40 AS is_active
  FROM part WHERE p_brand = 'Brand#2'
),
active_overrides AS (
  SELECT product_id, MAX(TRY_CAST(override_unit_price AS DOUBLE)) AS override_unit_price
  FROM overrides WHERE coalesce(is_active, false) GROUP BY product_id
)"""

EXCLUSIONS = """
exclusions AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, 'Not priced for ATV' AS exclusion_reason,
    p_size >= 26 AS is_active
  FROM part WHERE p_brand = 'Brand#1'
)"""

DIM_UNIT = """
dim_unit AS (
  SELECT n.n_name AS country_code,
    'LOC' || lpad(CAST(n.n_nationkey AS VARCHAR), 3, '0') AS location_id,
    'U' || CAST(s.s_suppkey AS VARCHAR) AS unit_id,
    CASE WHEN s.s_acctbal < 0 THEN s.s_name || ' (renamed)' ELSE s.s_name END AS unit_name,
    CASE r.r_name WHEN 'AFRICA' THEN 'ZAR' WHEN 'AMERICA' THEN 'USD' WHEN 'ASIA' THEN 'JPY'
      WHEN 'EUROPE' THEN 'EUR' WHEN 'MIDDLE EAST' THEN 'AED' END AS currency_code
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DIM_PRODUCT = f"""{EXCLUSIONS},
dim_product AS (
  SELECT 'P' || CAST(p.p_partkey AS VARCHAR) AS product_id, p.p_name AS product_name,
    CASE WHEN p.p_type = 'PROMO' THEN 'Meal Deal' ELSE p.p_type END AS product_category,
    p.p_retailprice AS standard_unit_price,
    p.p_size > 3 AS is_priced_product,
    (p.p_type = 'ECONOMY' AND p.p_size <= 10) AS is_kitchen_instruction,
    coalesce(e.is_active, false) AS is_excluded_from_enhanced_quantity
  FROM part p LEFT JOIN exclusions e ON 'P' || CAST(p.p_partkey AS VARCHAR) = e.product_id
)"""

BUDGET = """
daily_gross AS (
  SELECT CAST(l_shipdate AS DATE) AS business_date, 'U' || CAST(l_suppkey AS VARCHAR) AS unit_id,
    CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS gross
  FROM lineitem GROUP BY 1, 2
),
budget AS (
  SELECT business_date, unit_id,
    CAST(ROUND(gross * CAST('1.05' AS DECIMAL(4,2)), 2) AS DOUBLE) AS daily_budget_net_sales
  FROM daily_gross
),
forecast AS (
  SELECT business_date + 7 AS business_date, unit_id,
    CAST(ROUND(gross * CAST('0.97' AS DECIMAL(4,2)), 2) AS DOUBLE) AS forecast_net_sales
  FROM daily_gross
),
budget_forecast AS (
  SELECT coalesce(b.business_date, f.business_date) AS business_date,
    coalesce(b.unit_id, f.unit_id) AS unit_id,
    b.daily_budget_net_sales, f.forecast_net_sales
  FROM budget b FULL JOIN forecast f ON b.business_date = f.business_date AND b.unit_id = f.unit_id
)"""

KEYS = "business_date, transaction_id, transaction_line_id"
FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN NOT (tax_amount = 0 AND discount_amount = 0) THEN transaction_id END AS transaction_id,
    CASE WHEN source_sequence >= -2000 THEN business_date END AS business_date,
    CASE WHEN is_priced_product THEN gross_sales ELSE -gross_sales END AS gross_sales)
  FROM bronze
)"""
# The Silver contract held against lines whose status rules were not applied.
UNRULED = """
unruled AS (
  SELECT * REPLACE (
    CASE WHEN tax_amount <> 0 THEN net_sales_before_status END AS net_sales,
    CASE WHEN is_priced_product THEN enhanced_quantity ELSE -quantity END AS enhanced_quantity)
  FROM silver
)"""
SILVER_BASE = f"WITH {BRONZE},{RANKED},{SILVER}"
SILVER_OUT = (
    f"{KEYS}, country_code, location_id, unit_id, product_id, is_combo, line_status, quantity, "
    "gross_sales, discount_amount, tax_amount, net_sales_before_status, net_sales, enhanced_quantity, "
    "transaction_completed_ts, quarter_hour_start_ts, quarter_hour_key, source_sequence, "
    "source_update_ts, extraction_ts"
)

DEDUPE_OUT = (
    f"{KEYS}, unit_id, product_id, gross_sales, discount_amount, line_status, "
    "source_sequence, source_update_ts, extraction_ts"
)

DQ_SILVER = """
SELECT 'valid_net_sales' AS rule_name, COUNT(*) AS rows_checked,
  COUNT(*) FILTER (WHERE NOT coalesce(net_sales IS NOT NULL, false)) AS rows_failed FROM unruled
UNION ALL
SELECT 'valid_enhanced_quantity', COUNT(*),
  COUNT(*) FILTER (WHERE NOT coalesce(enhanced_quantity >= 0, false)) FROM unruled
UNION ALL
SELECT 'cancelled_lines_net_to_zero', COUNT(*),
  COUNT(*) FILTER (WHERE NOT coalesce(coalesce(lower(line_status), '') <> 'cancelled' OR net_sales = 0, false)) FROM unruled
UNION ALL
SELECT 'returned_lines_not_positive', COUNT(*),
  COUNT(*) FILTER (WHERE NOT coalesce(coalesce(lower(line_status), '') <> 'returned' OR net_sales <= 0, false)) FROM unruled
"""

OWNERS = """
owners(rule_name, technical_owner, functional_owner) AS (VALUES
  ('valid_net_sales', 'data-platform', 'finance-reporting'),
  ('valid_enhanced_quantity', 'data-platform', 'commercial-analytics'),
  ('cancelled_lines_net_to_zero', 'pos-integration', 'finance-reporting'),
  ('returned_lines_not_positive', 'pos-integration', 'finance-reporting'),
  ('transaction_id_is_present', 'pos-integration', 'store-operations'),
  ('business_date_is_present', 'pos-integration', 'store-operations'),
  ('gross_sales_is_not_negative_for_completed_lines', 'pos-integration', 'finance-reporting'),
  ('unit_id_is_present', 'energy-integration', 'estates'),
  ('running_cost_is_non_negative', 'energy-integration', 'estates'))"""

BRONZE_FLAGS = """
CASE WHEN NOT coalesce(transaction_id IS NOT NULL, false) THEN 'transaction_id_is_present' END,
CASE WHEN NOT coalesce(business_date IS NOT NULL, false) THEN 'business_date_is_present' END,
CASE WHEN NOT coalesce(line_status <> 'completed' OR TRY_CAST(gross_sales AS DOUBLE) >= 0, false)
     THEN 'gross_sales_is_not_negative_for_completed_lines' END"""

SILVER_FLAGS = """
CASE WHEN NOT coalesce(net_sales IS NOT NULL, false) THEN 'valid_net_sales' END,
CASE WHEN NOT coalesce(enhanced_quantity >= 0, false) THEN 'valid_enhanced_quantity' END,
CASE WHEN NOT coalesce(coalesce(lower(line_status), '') <> 'cancelled' OR net_sales = 0, false)
     THEN 'cancelled_lines_net_to_zero' END,
CASE WHEN NOT coalesce(coalesce(lower(line_status), '') <> 'returned' OR net_sales <= 0, false)
     THEN 'returned_lines_not_positive' END"""


def _flags(cases: str) -> str:
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), ',')"


ORACLE: dict[str, str] = {
    "atv": f"""{SILVER_BASE}
SELECT business_date, country_code, location_id, unit_id,
  COUNT(DISTINCT transaction_id) AS transaction_count,
  {xsum("net_sales")} AS net_sales,
  SUM(enhanced_quantity) AS enhanced_quantity,
  {xsum("net_sales")} / NULLIF(COUNT(DISTINCT transaction_id), 0) AS average_transaction_value,
  {xsum("net_sales")} / NULLIF(SUM(enhanced_quantity), 0) AS net_sales_per_enhanced_item
FROM silver GROUP BY business_date, country_code, location_id, unit_id""",
    "silver_business": f"{SILVER_BASE}\nSELECT {SILVER_OUT} FROM silver",
    "dedupe_reposted": f"WITH {BRONZE},{RANKED}\nSELECT {DEDUPE_OUT} FROM dedup",
    "superseded_versions": f"""WITH {BRONZE},{RANKED}
SELECT {KEYS}, unit_id, product_id, source_sequence, version_rank FROM ranked WHERE version_rank > 1""",
    "net_sales": f"""WITH {BRONZE},{_rules("bronze", "ns")}
SELECT {KEYS}, product_id, unit_id, line_status, gross_sales, discount_amount, tax_amount,
  net_sales_before_status, net_sales FROM ns""",
    "enhanced_quantity": f"""WITH {BRONZE}
SELECT {KEYS}, product_id, unit_id, quantity, is_priced_product, is_kitchen_instruction,
  CASE WHEN coalesce(is_priced_product, false) AND NOT coalesce(is_kitchen_instruction, true)
       THEN coalesce(quantity, 0.0) ELSE 0.0 END AS enhanced_quantity
FROM bronze""",
    "quarter_hour_bucket": f"""WITH {EVENT_LINES}
SELECT transaction_id, unit_id, transaction_completed_ts,
  time_bucket(INTERVAL '15 minutes', transaction_completed_ts) AS quarter_hour_start_ts,
  strftime(time_bucket(INTERVAL '15 minutes', transaction_completed_ts), '%H:%M') AS quarter_hour_key
FROM elines""",
    "discount_strategy": f"{SILVER_BASE},{DISCOUNT}\nSELECT * FROM strategy",
    "discount_actions": f"""{SILVER_BASE},{DISCOUNT}
SELECT *,
  CASE WHEN discount_rate_percent > 20 AND net_sales_per_transaction < 5 THEN 'review_discount_depth'
       WHEN transaction_count > 100 AND net_sales_per_transaction >= 8 THEN 'candidate_for_promotion'
       ELSE 'monitor' END AS commercial_action
FROM strategy""",
    "top_discounts": f"""{SILVER_BASE},{DISCOUNT}
SELECT * FROM strategy
ORDER BY net_sales DESC, transaction_count DESC, country_code ASC NULLS FIRST, location_id ASC NULLS FIRST,
  unit_id ASC NULLS FIRST, discount_type ASC NULLS FIRST, discount_name ASC NULLS FIRST,
  product_category ASC NULLS FIRST
LIMIT 10""",
    "break_even_15min": f"WITH {ESILVER},{ENERGY},{_bucket_sales(True)},{_break_even(True, False)}\n{BREAK_EVEN_VIEW}",
    "break_even_idle": f"WITH {ESILVER},{ENERGY},{_bucket_sales(True)},{_break_even(True, True)}\n{BREAK_EVEN_VIEW}",
    "unit_15min_profitability": f"""WITH {ESILVER},{ENERGY},{_bucket_sales(False)},{_break_even(False, False, 1.25)}
SELECT country_code, location_id, unit_id, quarter_hour_start_ts, net_sales, enhanced_quantity,
  transaction_count, kwh_consumed, estimated_running_cost, break_even_threshold, profitability_gap,
  trading_recommendation
FROM gold""",
    "energy_15min": f"WITH {ENERGY}\nSELECT * FROM energy",
    "combo_variance": f"{SILVER_BASE},{COMBO}\nSELECT * FROM combo_variance",
    "combo_override": f"""{SILVER_BASE},{COMBO},{OVERRIDES}
SELECT c.product_id, c.product_name, c.combo_avg_unit_net_price, o.override_unit_price,
  coalesce(o.override_unit_price, c.combo_avg_unit_net_price) AS effective_combo_unit_price,
  o.override_unit_price IS NOT NULL AS is_price_overridden, c.combo_units
FROM combo_variance c LEFT JOIN active_overrides o ON c.product_id = o.product_id""",
    "product_controls": f"""{SILVER_BASE},{OVERRIDES},{EXCLUSIONS},
active_exclusions AS (
  SELECT product_id, MIN(exclusion_reason) AS exclusion_reason FROM exclusions
  WHERE coalesce(is_active, false) GROUP BY product_id
)
SELECT s.business_date, s.transaction_id, s.transaction_line_id, s.product_id, s.is_combo,
  CASE WHEN e.exclusion_reason IS NOT NULL THEN 0.0 ELSE s.enhanced_quantity END AS enhanced_quantity,
  e.exclusion_reason, e.exclusion_reason IS NOT NULL AS is_masterdata_excluded_product,
  o.override_unit_price AS combo_override_unit_price
FROM silver s
LEFT JOIN active_exclusions e ON s.product_id = e.product_id
LEFT JOIN active_overrides o ON s.product_id = o.product_id""",
    "dim_unit": f"WITH {DIM_UNIT}\nSELECT * FROM dim_unit",
    "dim_product": f"WITH {DIM_PRODUCT}\nSELECT * FROM dim_product",
    "budget_forecast": f"WITH {BUDGET}\nSELECT * FROM budget_forecast",
    "budget_variance": f"""{SILVER_BASE},{BUDGET},
actual AS (SELECT business_date, unit_id, {xsum("net_sales")} AS actual_net_sales FROM silver GROUP BY 1, 2)
SELECT coalesce(a.business_date, b.business_date) AS business_date, coalesce(a.unit_id, b.unit_id) AS unit_id,
  a.actual_net_sales, b.daily_budget_net_sales, b.forecast_net_sales,
  {sround("coalesce(a.actual_net_sales, 0.0) - b.daily_budget_net_sales", 2)} AS budget_variance,
  {sround("coalesce(a.actual_net_sales, 0.0) - b.forecast_net_sales", 2)} AS forecast_variance,
  {sround("a.actual_net_sales / NULLIF(b.daily_budget_net_sales, 0) * 100", 2)} AS budget_attainment_percent
FROM actual a FULL JOIN budget_forecast b ON a.business_date = b.business_date AND a.unit_id = b.unit_id""",
    "transactional": f"""{SILVER_BASE},{DIM_UNIT},{DIM_PRODUCT},{BUDGET}
SELECT s.business_date, s.country_code, s.location_id, s.unit_id, u.unit_name, s.transaction_id,
  s.transaction_line_id, s.transaction_completed_ts, s.quarter_hour_start_ts, s.product_id,
  p.product_name, p.product_category, s.gross_sales, s.discount_amount, s.tax_amount, s.net_sales,
  s.enhanced_quantity, s.discount_type, s.discount_name, b.daily_budget_net_sales, b.forecast_net_sales
FROM silver s
LEFT JOIN dim_unit u ON s.country_code = u.country_code AND s.location_id = u.location_id AND s.unit_id = u.unit_id
LEFT JOIN dim_product p ON s.product_id = p.product_id
LEFT JOIN budget_forecast b ON s.business_date = b.business_date AND s.unit_id = b.unit_id""",
    "unified_bronze": f"""WITH {BRONZE}
SELECT {KEYS}, unit_id, product_id, gross_sales, source_file_name, _source_ingestion_route FROM bronze""",
    "dq_flags": f"""WITH {BRONZE},{FAULTY}
SELECT {KEYS}, unit_id, product_id, {_flags(BRONZE_FLAGS)} AS dq_failed_rules FROM faulty""",
    "dq_metrics": f"""{SILVER_BASE},{UNRULED}, m AS ({DQ_SILVER})
SELECT rule_name, rows_checked, rows_failed, rows_checked - rows_failed AS rows_passed FROM m""",
    "quarantine": f"""{SILVER_BASE},{UNRULED}, flagged AS (
  SELECT {KEYS}, line_status, net_sales, enhanced_quantity, {_flags(SILVER_FLAGS)} AS dq_failed_rules FROM unruled
)
SELECT * FROM flagged WHERE dq_failed_rules <> ''""",
    "dq_alerts": f"""{SILVER_BASE},{UNRULED}, m AS ({DQ_SILVER}), {OWNERS}
SELECT m.rule_name, m.rows_checked, m.rows_failed, o.technical_owner, o.functional_owner
FROM m LEFT JOIN owners o ON m.rule_name = o.rule_name WHERE m.rows_failed > 0""",
    "duplicate_keys": f"""WITH {BRONZE}
SELECT {KEYS}, COUNT(*) AS row_count FROM bronze GROUP BY ALL HAVING COUNT(*) > 1""",
    "recon_bronze_silver": f"""{SILVER_BASE},
b AS (SELECT business_date, COUNT(*) AS bronze_rows FROM bronze GROUP BY 1),
s AS (SELECT business_date, COUNT(*) AS silver_rows FROM dedup GROUP BY 1)
SELECT coalesce(b.business_date, s.business_date) AS business_date,
  coalesce(b.bronze_rows, 0) AS bronze_rows, coalesce(s.silver_rows, 0) AS silver_rows,
  coalesce(b.bronze_rows, 0) - coalesce(s.silver_rows, 0) AS dropped_rows
FROM b FULL JOIN s ON b.business_date = s.business_date""",
    "recon_gold_silver": f"""WITH {ESILVER},{ENERGY},{_bucket_sales(True)},{_break_even(True, False)},
g AS (SELECT country_code, business_date, {xsum("net_sales")} AS gold_net_sales FROM gold GROUP BY 1, 2),
s AS (SELECT country_code, business_date, {xsum("net_sales")} AS silver_net_sales FROM esilver GROUP BY 1, 2)
SELECT coalesce(g.country_code, s.country_code) AS country_code,
  coalesce(g.business_date, s.business_date) AS business_date,
  g.gold_net_sales, s.silver_net_sales,
  {sround("coalesce(g.gold_net_sales, 0.0) - coalesce(s.silver_net_sales, 0.0)", 2)} AS net_sales_difference,
  abs({sround("coalesce(g.gold_net_sales, 0.0) - coalesce(s.silver_net_sales, 0.0)", 2)}) <= 0.005 AS is_reconciled
FROM g FULL JOIN s ON g.country_code = s.country_code AND g.business_date = s.business_date""",
    "missing_countries": f"""{SILVER_BASE},
span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
runs AS (SELECT CAST(unnest(range(lo, hi + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS business_date FROM span),
countries AS (SELECT n_name AS country_code FROM nation),
seen AS (SELECT DISTINCT business_date, country_code FROM silver)
SELECT r.business_date, c.country_code FROM runs r, countries c
WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.business_date = r.business_date AND x.country_code = c.country_code)""",
    "duplicate_silver_keys": f"""{SILVER_BASE}
SELECT {KEYS}, COUNT(*) AS row_count FROM silver GROUP BY ALL HAVING COUNT(*) > 1""",
    "dq_energy": f"""WITH {ENERGY},
faulty AS (SELECT CASE WHEN unit_id <> 'E0' THEN unit_id END AS unit_id,
    CASE WHEN kwh_consumed < 100 THEN estimated_running_cost ELSE -estimated_running_cost END AS cost FROM readings)
SELECT 'unit_id_is_present' AS rule_name, COUNT(*) AS rows_checked, COUNT(*) FILTER (unit_id IS NULL) AS rows_failed,
  COUNT(unit_id) AS rows_passed FROM faulty
UNION ALL
SELECT 'running_cost_is_non_negative', COUNT(*), COUNT(*) FILTER (NOT coalesce(cost >= 0, false)), COUNT(*) FILTER (coalesce(cost >= 0, false)) FROM faulty""",
    "dq_landing": f"""WITH {BRONZE},{FAULTY}
SELECT 'transaction_id_is_present' AS rule_name, COUNT(*) AS rows_checked, COUNT(*) FILTER (transaction_id IS NULL) AS rows_failed,
  COUNT(transaction_id) AS rows_passed FROM faulty
UNION ALL
SELECT 'business_date_is_present', COUNT(*), COUNT(*) FILTER (business_date IS NULL), COUNT(business_date) FROM faulty""",
    "event_discount_actions": f"""WITH {EVENT_LINES.replace("0.0 AS discount_amount", "CAST(ROUND(CAST(value AS DECIMAL(18,2)) * CAST(user_id % 4 AS DECIMAL(2,0)) * CAST('0.1' AS DECIMAL(2,1)), 2) AS DOUBLE) AS discount_amount")},{_rules("elines", "silver")},
strategy_a AS (
  SELECT country_code, location_id, unit_id, {xsum("gross_sales")} AS gross_sales, {xsum("discount_amount")} AS discount_amount,
    {xsum("net_sales")} AS net_sales, COUNT(DISTINCT transaction_id) AS transaction_count,
    ['none', 'loyalty', 'staff', 'promo'][CAST(band + 1 AS INTEGER)] AS discount_type
  FROM silver JOIN (SELECT event_id, user_id % 4 AS band FROM events) b ON transaction_id = 'E' || CAST(b.event_id AS VARCHAR)
  GROUP BY ALL
),
strategy AS (
  SELECT country_code, location_id, unit_id, discount_type, 'events' AS discount_name, 'events' AS product_category,
    gross_sales, discount_amount, net_sales, transaction_count,
    {sround("coalesce(discount_amount / NULLIF(gross_sales, 0), 0.0) * 100", 2)} AS discount_rate_percent,
    {sround("coalesce(net_sales / NULLIF(transaction_count, 0), 0.0)", 2)} AS net_sales_per_transaction
  FROM strategy_a
)
SELECT *,
  CASE WHEN discount_rate_percent > 20 AND net_sales_per_transaction < 5 THEN 'review_discount_depth'
       WHEN transaction_count > 100 AND net_sales_per_transaction >= 8 THEN 'candidate_for_promotion'
       ELSE 'monitor' END AS commercial_action
FROM strategy""",
    "folder_paths": """
WITH f AS (
  SELECT p_partkey, p_brand, p_name,
    trim(regexp_replace(regexp_replace(replace(lower(trim(p_brand)), ' ', ''), '[/\\\\&?#%:]', '_', 'g'), '_+', '_', 'g'), '_') AS folder,
    trim(regexp_replace(regexp_replace(replace(lower(trim(p_name)), ' ', ''), '[/\\\\&?#%:]', '_', 'g'), '_+', '_', 'g'), '_') AS entity
  FROM part
)
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, folder,
  '/lake/landing/master' || '/' || folder || '/' || entity AS target_path
FROM f""",
    "incremental_extract": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
FROM lineitem WHERE l_shipdate > TIMESTAMP '1999-06-30 00:00:00'""",
    "watermark_advance": """
SELECT '1999-06-30 00:00:00' AS previous_watermark,
  coalesce(strftime(MAX(l_shipdate), '%Y-%m-%d %H:%M:%S'), '1999-06-30 00:00:00') AS new_watermark,
  COUNT(*) AS rows_extracted
FROM lineitem WHERE l_shipdate > TIMESTAMP '1999-06-30 00:00:00'""",
    "latest_master_snapshot": """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  """ + sround("p_retailprice + 1.0", 2) + """ AS standard_unit_price, '20260102020000' AS _file_stamp
FROM part""",
    "scd1_stream": f"WITH {BRONZE},{RANKED}\nSELECT {DEDUPE_OUT} FROM dedup",
    "analytics_stream": f"""{SILVER_BASE},{DIM_UNIT},{DIM_PRODUCT},{BUDGET}
SELECT s.business_date, s.country_code, s.location_id, s.unit_id, u.unit_name, s.transaction_id,
  s.transaction_line_id, s.transaction_completed_ts, s.quarter_hour_start_ts, s.product_id,
  p.product_name, p.product_category, s.gross_sales, s.discount_amount, s.tax_amount, s.net_sales,
  s.enhanced_quantity, s.discount_type, s.discount_name, s.line_status, b.daily_budget_net_sales,
  b.forecast_net_sales, s.source_sequence, s.source_update_ts, s.extraction_ts
FROM silver s
LEFT JOIN dim_unit u ON s.country_code = u.country_code AND s.location_id = u.location_id AND s.unit_id = u.unit_id
LEFT JOIN dim_product p ON s.product_id = p.product_id
LEFT JOIN budget_forecast b ON s.business_date = b.business_date AND s.unit_id = b.unit_id""",
    "energy_stream": f"WITH {ENERGY}\nSELECT * FROM energy",
    "recon_source_landing": """
SELECT 'orders' AS target_entity, COUNT(*) AS source_rows, COUNT(*) AS bronze_rows, CAST(0 AS BIGINT) AS row_difference,
  coalesce(strftime(MAX(o_orderdate), '%Y-%m-%d %H:%M:%S'), '1999-12-31 00:00:00') AS new_watermark
FROM orders WHERE o_orderdate > TIMESTAMP '1999-12-31 00:00:00'
UNION ALL SELECT 'customer', COUNT(*), COUNT(*), 0, NULL FROM customer
UNION ALL SELECT 'supplier', COUNT(*), COUNT(*), 0, NULL FROM supplier""",
    "load_delays": """
WITH runs AS (
  SELECT o_custkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN 'Failed' ELSE 'Succeeded' END AS status FROM orders
),
known AS (
  SELECT o_custkey, MAX(o_orderdate) FILTER (status = 'Succeeded') AS last_success_utc,
    arg_max(status, (o_orderdate, status = 'Failed')) AS last_status,
    COUNT(*) FILTER (status = 'Failed') AS failed_runs
  FROM runs GROUP BY o_custkey
),
lagged AS (
  SELECT c.c_custkey AS ingestion_id, k.last_success_utc, coalesce(k.last_status, 'Never run') AS last_status,
    coalesce(k.failed_runs, 0) AS failed_runs,
    date_diff('second', k.last_success_utc, TIMESTAMP '2001-08-02 00:00:00') / 3600.0 AS hours_since_success
  FROM customer c LEFT JOIN known k ON k.o_custkey = c.c_custkey WHERE c.c_acctbal >= 0
)
SELECT *, coalesce(hours_since_success > 2160, true) AS is_delayed FROM lagged""",
    "schema_drift": """
SELECT 'custkey' AS column_name, 'missing' AS change, 'bigint' AS stored_type, NULL AS found_type, (SELECT COUNT(*) FROM supplier) AS rows_affected
UNION ALL SELECT 'mktsegment', 'missing', 'string', NULL, (SELECT COUNT(*) FROM supplier)
UNION ALL SELECT 'nationkey', 'retyped', 'int', 'string', (SELECT COUNT(*) FROM supplier WHERE s_acctbal < 0)
UNION ALL SELECT 'suppkey', 'added', NULL, 'bigint', (SELECT COUNT(s_suppkey) FROM supplier)""",
    "key_checks": " UNION ALL ".join(
        f"""
SELECT '{table}' AS target_entity, '{",".join(keys)}' AS key_columns, CAST(SUM(n) AS BIGINT) AS rows_checked,
  COUNT(*) FILTER ({" AND ".join(f"{k} IS NOT NULL" for k in keys)}) AS distinct_keys,
  COUNT(*) FILTER ({" AND ".join(f"{k} IS NOT NULL" for k in keys)} AND n > 1) AS duplicate_keys,
  CAST(coalesce(SUM(n - 1) FILTER ({" AND ".join(f"{k} IS NOT NULL" for k in keys)} AND n > 1), 0) AS BIGINT) AS surplus_rows,
  CAST(coalesce(SUM(n) FILTER ({" OR ".join(f"{k} IS NULL" for k in keys)}), 0) AS BIGINT) AS null_key_rows
FROM (SELECT {", ".join(keys)}, COUNT(*) AS n FROM {table} GROUP BY ALL)"""
        for table, keys in (
            ("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]),
            ("part", ["p_partkey"]), ("customer", ["c_nationkey", "c_mktsegment"]),
        )
    ),
    "landing_day": """
SELECT *, CAST(ts AS DATE) AS extract_date, 'run1' AS run_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "json_lines": f"""WITH {BRONZE}
SELECT {KEYS}, unit_id, product_id, transaction_completed_ts, is_combo, quantity, gross_sales, discount_amount, tax_amount,
  discount_name, source_sequence, extraction_ts
FROM bronze WHERE _source_ingestion_route = 'new_unit_json_files'""",
    "table_registry": f"""WITH {DIM_UNIT},{DIM_PRODUCT},{BUDGET}
SELECT 'silver_dim_unit' AS table_name, 'silver' AS layer, 'overwrite' AS write_mode, NULL AS merge_pattern, NULL AS source_pattern,
  'Trading units under their business names' AS comment, (SELECT COUNT(*) FROM dim_unit) AS row_count
UNION ALL SELECT 'silver_dim_product', 'silver', 'overwrite', NULL, NULL, 'Products in their corrected category', (SELECT COUNT(*) FROM dim_product)
UNION ALL SELECT 'silver_daily_budget_forecast', 'silver', 'overwrite', NULL, NULL, 'Budget and forecast by date and unit', (SELECT COUNT(*) FROM budget_forecast)""",
}

# The SQL views answer the same questions as their DataFrame builders.
ORACLE["vw_atv"] = ORACLE["atv"]
ORACLE["vw_discount_strategy"] = ORACLE["discount_actions"]
ORACLE["vw_break_even"] = ORACLE["break_even_15min"]
ORACLE["vw_combo_analytics"] = ORACLE["combo_variance"]
ORACLE["vw_transactional"] = ORACLE["transactional"]
