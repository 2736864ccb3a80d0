"""Analytical data products built from Silver sales (DataFrame -> DataFrame).

Plan notes that matter at scale:
* Aggregate first, join after (Catalyst has no eager aggregation): the break-even product
  reduces sales and energy to one row per bucket *before* the join.
* ``COUNT(DISTINCT transaction_id)`` is rewritten by Catalyst into an aggregate on
  (group, transaction) and then on group; the first shuffle is on (group, transaction), so a
  hot unit or country is spread over many reducers, and the second shuffle carries one
  partial row per group and map task.
* Money sums are exact decimal sums (``exact_sum``), so totals do not depend on row order.
* The combo report reads priced lines once (one conditional aggregate) instead of two
  filtered aggregates and a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.money import (
    exact_avg,
    exact_sum,
    ratio_or_null,
    ratio_or_zero,
    round_half_up,
    to_double_or_null,
)
from quarterdeck.functions.time import quarter_hour_key
from quarterdeck.operators.rules import require_columns, trading_recommendation

# Thresholds of the commercial action rule (first match wins).
REVIEW_DISCOUNT_RATE_ABOVE = 20
REVIEW_NET_PER_TXN_BELOW = 5
PROMOTE_TXNS_ABOVE = 100
PROMOTE_NET_PER_TXN_AT_LEAST = 8
ACTION_REVIEW = "review_discount_depth"
ACTION_PROMOTE = "candidate_for_promotion"
ACTION_MONITOR = "monitor"

# Averages of per-line prices are rounded to this many decimals in reports: a float mean
# depends on summation order, its first 6 decimals do not.
AVG_DECIMALS = 6

# Names that a sales line carries and the line-level table takes from the dimensions instead.
NAMES_ON_LINES = ["unit_name", "product_name", "product_category", "location_name"]

BUCKET_KEYS = ["country_code", "location_id", "unit_id", "quarter_hour_start_ts"]
DISCOUNT_KEYS = ["country_code", "location_id", "unit_id", "discount_type", "discount_name", "product_category"]
ATV_KEYS = ["business_date", "country_code", "location_id", "unit_id"]


def bucket_sales(sales: DataFrame, by_business_date: bool = True) -> DataFrame:
    keys = (["business_date"] if by_business_date else []) + BUCKET_KEYS
    require_columns(sales, keys + ["net_sales", "enhanced_quantity", "transaction_id"])
    return sales.groupBy(*keys).agg(
        exact_sum("net_sales").alias("net_sales"),
        exact_sum("enhanced_quantity").alias("enhanced_quantity"),
        F.count_distinct("transaction_id").alias("transaction_count"),
    )


def bucket_cost(energy: DataFrame) -> DataFrame:
    """Energy readings summed per unit and bucket (several readings per cell allowed)."""
    require_columns(energy, ["unit_id", "quarter_hour_start_ts", "estimated_running_cost"])
    aggs = [exact_sum("estimated_running_cost").alias("estimated_running_cost")]
    if "kwh_consumed" in energy.columns:
        aggs.insert(0, exact_sum("kwh_consumed").alias("kwh_consumed"))
    return energy.groupBy("unit_id", "quarter_hour_start_ts").agg(*aggs)


def unit_15_min_profitability(
    sales: DataFrame,
    energy: DataFrame,
    break_even_multiplier: float = 1.0,
    by_business_date: bool = True,
    include_idle: bool = False,
) -> DataFrame:
    """Net sales per unit and 15-minute bucket against running cost.

    ``by_business_date`` keeps the date in the sales grain (the pipeline's Gold table);
    ``include_idle`` also keeps buckets with running cost but no sales (full join), which
    is the opening-hours question itself.
    """
    sales_agg = bucket_sales(sales, by_business_date)
    cost = bucket_cost(energy)
    how = "full" if include_idle else "left"
    joined = sales_agg.join(cost, ["unit_id", "quarter_hour_start_ts"], how)
    fills = {"estimated_running_cost": 0.0, "net_sales": 0.0, "enhanced_quantity": 0.0, "transaction_count": 0}
    if "kwh_consumed" in joined.columns:
        fills["kwh_consumed"] = 0.0
    threshold = F.col("estimated_running_cost") * F.lit(float(break_even_multiplier))
    gap = round_half_up(F.col("net_sales") - F.col("break_even_threshold"), 2)
    out = (
        joined.fillna(fills)
        .withColumn("break_even_threshold", threshold)
        .withColumn("profitability_gap", gap)
        .withColumn("trading_recommendation", trading_recommendation(F.col("profitability_gap")))
    )
    if include_idle and by_business_date:
        out = out.withColumn(
            "business_date", F.coalesce(F.col("business_date"), F.to_date("quarter_hour_start_ts"))
        )
    return out


def break_even_view(gold: DataFrame) -> DataFrame:
    """The 15-minute break-even report with an ``HH:mm`` key."""
    return gold.select(
        "business_date",
        "country_code",
        "location_id",
        "unit_id",
        "quarter_hour_start_ts",
        quarter_hour_key(F.col("quarter_hour_start_ts")).alias("quarter_hour_key"),
        "net_sales",
        "enhanced_quantity",
        "transaction_count",
        "estimated_running_cost",
        "profitability_gap",
        "trading_recommendation",
    )


def discount_strategy(sales: DataFrame) -> DataFrame:
    """Discount performance by geography, unit, discount and category (zero divisors → 0)."""
    require_columns(sales, DISCOUNT_KEYS + ["gross_sales", "discount_amount", "net_sales", "transaction_id"])
    return (
        sales.groupBy(*DISCOUNT_KEYS)
        .agg(
            exact_sum("gross_sales").alias("gross_sales"),
            exact_sum("discount_amount").alias("discount_amount"),
            exact_sum("net_sales").alias("net_sales"),
            F.count_distinct("transaction_id").alias("transaction_count"),
        )
        .withColumn(
            "discount_rate_percent",
            round_half_up(ratio_or_zero("discount_amount", "gross_sales") * 100, 2),
        )
        .withColumn(
            "net_sales_per_transaction",
            round_half_up(ratio_or_zero("net_sales", "transaction_count"), 2),
        )
    )


def commercial_action(df: DataFrame) -> DataFrame:
    rate, per_txn, txns = (
        F.col("discount_rate_percent"),
        F.col("net_sales_per_transaction"),
        F.col("transaction_count"),
    )
    return df.withColumn(
        "commercial_action",
        F.when((rate > REVIEW_DISCOUNT_RATE_ABOVE) & (per_txn < REVIEW_NET_PER_TXN_BELOW), ACTION_REVIEW)
        .when((txns > PROMOTE_TXNS_ABOVE) & (per_txn >= PROMOTE_NET_PER_TXN_AT_LEAST), ACTION_PROMOTE)
        .otherwise(ACTION_MONITOR),
    )


def top_discounts(strategy: DataFrame, k: int = 10) -> DataFrame:
    """The k strongest discount groups (net sales, then transactions, then keys for a total
    order); the limit is the feature. Plans as a TakeOrderedAndProject: each task keeps its
    own k best rows, so only k × tasks rows meet in the final merge."""
    order = [F.col("net_sales").desc(), F.col("transaction_count").desc()] + [
        F.col(c).asc_nulls_first() for c in DISCOUNT_KEYS
    ]
    return strategy.orderBy(*order).limit(k)


def order_discount_report(strategy: DataFrame) -> DataFrame:
    """Presentation order of the discount report: net sales, then transactions, descending
    (keys break ties). A global sort is a range-partitioned shuffle: apply it only where a
    consumer reads rows in order (exports, top-k); products stay unordered otherwise."""
    return strategy.orderBy(
        F.col("net_sales").desc(), F.col("transaction_count").desc(), *[F.col(c).asc_nulls_first() for c in DISCOUNT_KEYS]
    )


def order_combo_report(combo: DataFrame) -> DataFrame:
    """Presentation order of the combo report: most combo units first."""
    return combo.orderBy(F.col("combo_units").desc_nulls_last(), "product_id", "product_name")


def combo_price_variance(sales: DataFrame) -> DataFrame:
    """Average realised unit price of each product inside combos vs sold alone.

    One pass over priced lines: conditional averages for both kinds, keeping products that
    have combo lines (the report is driven by combos; standalone may be missing → null).
    """
    require_columns(sales, ["product_id", "product_name", "is_combo", "net_sales", "enhanced_quantity"])
    priced = sales.filter(F.col("enhanced_quantity") > 0).withColumn(
        "unit_net_price", ratio_or_null("net_sales", "enhanced_quantity")
    )
    combo = F.coalesce(F.col("is_combo"), F.lit(False))
    alone = F.col("is_combo") == F.lit(False)
    agg = (
        priced.groupBy("product_id", "product_name")
        .agg(
            exact_avg(F.when(combo, F.col("unit_net_price"))).alias("combo_avg"),
            exact_avg(F.when(alone, F.col("unit_net_price"))).alias("standalone_avg"),
            exact_sum(F.when(combo, F.col("enhanced_quantity"))).alias("combo_units"),
            F.max(combo).alias("has_combo"),
        )
        .filter("has_combo")
    )
    delta = round_half_up(F.col("combo_avg") - F.col("standalone_avg"), 2)
    return agg.select(
        "product_id",
        "product_name",
        round_half_up("combo_avg", AVG_DECIMALS).alias("combo_avg_unit_net_price"),
        round_half_up("standalone_avg", AVG_DECIMALS).alias("standalone_avg_unit_net_price"),
        delta.alias("combo_vs_standalone_delta"),
        round_half_up(ratio_or_null(delta, F.col("standalone_avg")) * 100, 2).alias("combo_discount_percent"),
        F.col("combo_units"),
    )


def active_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.coalesce(F.col("is_active"), F.lit(False)))


def product_master_controls(sales: DataFrame, exclusions: DataFrame, overrides: DataFrame) -> DataFrame:
    """Business master-data controls on sales lines.

    Active exclusions zero the enhanced quantity and flag the line; active price overrides
    are attached as ``combo_override_unit_price`` (unparseable → null). Both control sets
    are one row per product at most (deduplicated here); sizes decide the join at runtime.
    """
    require_columns(sales, ["product_id", "is_combo", "enhanced_quantity"])
    require_columns(exclusions, ["product_id", "exclusion_reason", "is_active"])
    require_columns(overrides, ["product_id", "override_unit_price", "is_active"])
    excl = active_rows(exclusions).groupBy("product_id").agg(F.min("exclusion_reason").alias("exclusion_reason"))
    over = (
        active_rows(overrides)
        .groupBy("product_id")
        .agg(F.max(to_double_or_null("override_unit_price")).alias("combo_override_unit_price"))
    )
    flagged = sales.join(excl, "product_id", "left").withColumn(
        "is_masterdata_excluded_product", F.col("exclusion_reason").isNotNull()
    )
    flagged = flagged.withColumn(
        "enhanced_quantity",
        F.when(F.col("is_masterdata_excluded_product"), F.lit(0.0)).otherwise(F.col("enhanced_quantity")),
    )
    return flagged.join(over, "product_id", "left")


def combo_price_with_override(combo: DataFrame, overrides: DataFrame) -> DataFrame:
    """Effective combo price = active governed override if present, else the observed average."""
    over = (
        active_rows(overrides)
        .groupBy("product_id")
        .agg(F.max(to_double_or_null("override_unit_price")).alias("override_unit_price"))
    )
    return (
        combo.join(over, "product_id", "left")
        .withColumn(
            "effective_combo_unit_price",
            F.coalesce(F.col("override_unit_price"), F.col("combo_avg_unit_net_price")),
        )
        .withColumn("is_price_overridden", F.col("override_unit_price").isNotNull())
    )


def average_transaction_value(sales: DataFrame) -> DataFrame:
    """ATV and net sales per enhanced item by date and unit (zero divisors → null)."""
    require_columns(sales, ATV_KEYS + ["transaction_id", "net_sales", "enhanced_quantity"])
    return (
        sales.groupBy(*ATV_KEYS)
        .agg(
            F.count_distinct("transaction_id").alias("transaction_count"),
            exact_sum("net_sales").alias("net_sales"),
            exact_sum("enhanced_quantity").alias("enhanced_quantity"),
        )
        .withColumn("average_transaction_value", ratio_or_null("net_sales", "transaction_count"))
        .withColumn("net_sales_per_enhanced_item", ratio_or_null("net_sales", "enhanced_quantity"))
    )


TRANSACTIONAL_COLUMNS = [
    "business_date",
    "country_code",
    "location_id",
    "unit_id",
    "unit_name",
    "transaction_id",
    "transaction_line_id",
    "transaction_completed_ts",
    "quarter_hour_start_ts",
    "product_id",
    "product_name",
    "product_category",
    "gross_sales",
    "discount_amount",
    "tax_amount",
    "net_sales",
    "enhanced_quantity",
    "discount_type",
    "discount_name",
]
TRANSACTIONAL_STREAM_EXTRA = ["line_status", "source_sequence", "source_update_ts", "extraction_ts"]
# Columns that the line-level table takes from each dimension; the plan's key comes first.
UNIT_COLUMNS = ["country_code", "location_id", "unit_id", "unit_name"]
PRODUCT_COLUMNS = ["product_id", "product_name", "product_category"]
PLAN_KEY = ["business_date", "unit_id"]
PLAN_COLUMNS = [*PLAN_KEY, "daily_budget_net_sales", "forecast_net_sales"]


def transactional_from_silver(
    sales: DataFrame,
    dim_unit: DataFrame,
    dim_product: DataFrame,
    budget_forecast: DataFrame,
    with_versions: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Denormalised line-level table: sales ⟕ unit ⟕ product ⟕ budget/forecast.

    ``sales`` may be a stream: the joins are then stream-static left joins. ``keep`` names columns
    of ``sales`` that follow the contract's.

    Dimension names win over the names carried on the sales line. Each side is one row per
    join key (dims are deduplicated upstream), so the left joins never multiply lines.
    The product comes first, as lines may come partitioned by it; the unit comes last, as it may be
    sent along.
    """
    s = sales.drop(*NAMES_ON_LINES)
    u = dim_unit.select(*UNIT_COLUMNS)
    p = dim_product.select(*PRODUCT_COLUMNS)
    b = budget_forecast.select(*PLAN_COLUMNS)
    joined = (
        s.join(p, "product_id", "left")
        .join(b, PLAN_KEY, "left")
        .join(u, ["country_code", "location_id", "unit_id"], "left")
    )
    cols = TRANSACTIONAL_COLUMNS[:]
    if with_versions:
        cols = cols[:19] + ["line_status"] + ["daily_budget_net_sales", "forecast_net_sales"] + cols[19:]
        cols += ["source_sequence", "source_update_ts", "extraction_ts"]
    else:
        cols += ["daily_budget_net_sales", "forecast_net_sales"]
    return joined.select(*cols, *keep)


def budget_variance(sales: DataFrame, budget_forecast: DataFrame) -> DataFrame:
    """Actual net sales vs budget and forecast per (date, unit).

    Actuals are aggregated before the join; a full join keeps days that have a plan but no
    sales, and sales without a plan.
    """
    actual = sales.groupBy("business_date", "unit_id").agg(exact_sum("net_sales").alias("actual_net_sales"))
    plan = budget_forecast.select("business_date", "unit_id", "daily_budget_net_sales", "forecast_net_sales")
    j = actual.join(plan, ["business_date", "unit_id"], "full")
    return j.select(
        "business_date",
        "unit_id",
        "actual_net_sales",
        "daily_budget_net_sales",
        "forecast_net_sales",
        round_half_up(F.coalesce("actual_net_sales", F.lit(0.0)) - F.col("daily_budget_net_sales"), 2).alias(
            "budget_variance"
        ),
        round_half_up(F.coalesce("actual_net_sales", F.lit(0.0)) - F.col("forecast_net_sales"), 2).alias(
            "forecast_variance"
        ),
        round_half_up(ratio_or_null(F.col("actual_net_sales"), F.col("daily_budget_net_sales")) * 100, 2).alias(
            "budget_attainment_percent"
        ),
    )
