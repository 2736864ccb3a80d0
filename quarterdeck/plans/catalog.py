"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

They compose the adapter (``quarterdeck.sources.adapter``) with the library operators,
exactly as a job over real Bronze/Silver tables would compose file sources with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.paths import build_target_path, normalise_folder_name
from quarterdeck.operators import dims, products, quality, recon
from quarterdeck.operators.dedupe import (
    dedupe_reposted_sales_lines,
    latest_master_snapshot,
    superseded_versions,
)
from quarterdeck.operators.rules import (
    add_quarter_hour_bucket,
    apply_enhanced_quantity,
    apply_sales_business_rules,
    calculate_net_sales,
)
from quarterdeck.schemas import INGESTION_CONTROL
from quarterdeck.session import scratch_path
from quarterdeck.sources import adapter as A
from quarterdeck.sources import schema_registry, tables
from quarterdeck.sources.files import read_json_lines, split_corrupt, unified_sales, write_json_lines
from quarterdeck.sources.ingest import (
    advance_watermark,
    incremental_extract,
    land_by_day,
    read_landing,
    run_ingestion,
    source_counts_from_audit,
)

Query = Callable[[SparkSession, str], DataFrame]

KEYS = ["business_date", "transaction_id", "transaction_line_id"]

# The incremental-extract example (watermark of the previous run).
EXTRACT_WATERMARK_COLUMN = "l_shipdate"
EXTRACT_LAST_WATERMARK = "1999-06-30 00:00:00"
# Two loads of the product master file, older then newer.
SNAPSHOT_STAMPS = ("20260101020000", "20260102020000")
BREAK_EVEN_MULTIPLIER = 1.25
# The watermark of the run that is reconciled, the delay report's clock and limit,
# and the landed day that is read back.
ORDERS_LAST_WATERMARK = "1999-12-31 00:00:00"
SLA_NOW, SLA_HOURS = "2001-08-02 00:00:00", 24.0 * 90
LANDING_DAY, LANDING_RUN = "2024-01-15", "run1"


# ---------------------------------------------------------------- building blocks


def bronze_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.sales_lines(spark, sf_dir)


def silver_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_reposted_sales_lines(bronze_sales(spark, sf_dir), tiebreak=A.ADAPTER_TIEBREAK)


def silver_sales(spark: SparkSession, sf_dir: str, by_product: bool = False) -> DataFrame:
    return A.current_sales_lines(spark, sf_dir, by_product).transform(apply_sales_business_rules)


def unruled_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver lines on which the status rules were not applied, so the contract has failures:
    amounts before status, none for untaxed lines, negative quantities of unpriced products."""
    return silver_sales(spark, sf_dir).withColumns(
        {
            "net_sales": F.when(F.col("tax_amount") != 0, F.col("net_sales_before_status")),
            "enhanced_quantity": F.when(F.col("is_priced_product"), F.col("enhanced_quantity")).otherwise(-F.col("quantity")),
        }
    )


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.event_sales_lines(spark, sf_dir).transform(apply_sales_business_rules)


def energy_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.energy_15_minute_cost(A.energy_readings(spark, sf_dir), timestamp_col="reading_ts")


def silver_dim_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_unit(A.unit_master(spark, sf_dir), A.unit_mapping_override(spark, sf_dir))


def lookup_dim_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit dimension for joins with sales lines, sent along with them if it is small enough."""
    return A.sent_along(silver_dim_unit(spark, sf_dir))


def silver_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_product(
        A.product_master(spark, sf_dir),
        A.product_hierarchy_corrections(spark, sf_dir),
        A.product_exclusions(spark, sf_dir),
    )


def silver_budget_forecast(spark: SparkSession, sf_dir: str, partitioned: bool = True) -> DataFrame:
    return dims.daily_budget_forecast(A.daily_budget(spark, sf_dir), A.daily_forecast(spark, sf_dir, partitioned), partitioned)


def gold_discount_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.discount_strategy(silver_sales(spark, sf_dir))


def gold_break_even(spark: SparkSession, sf_dir: str, include_idle: bool = False) -> DataFrame:
    return products.unit_15_min_profitability(
        event_silver(spark, sf_dir), energy_cost(spark, sf_dir), include_idle=include_idle
    )


def combo_variance_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.combo_price_variance(silver_sales(spark, sf_dir))


SILVER_OUT = KEYS + [
    "country_code",
    "location_id",
    "unit_id",
    "product_id",
    "is_combo",
    "line_status",
    "quantity",
    "gross_sales",
    "discount_amount",
    "tax_amount",
    "net_sales_before_status",
    "net_sales",
    "enhanced_quantity",
    "transaction_completed_ts",
    "quarter_hour_start_ts",
    "quarter_hour_key",
    "source_sequence",
    "source_update_ts",
    "extraction_ts",
]


# ---------------------------------------------------------------- registered queries


def q_atv(spark, sf_dir):
    return products.average_transaction_value(silver_sales(spark, sf_dir))


def q_silver_business(spark, sf_dir):
    return silver_sales(spark, sf_dir).select(*SILVER_OUT)


def q_dedupe_reposted(spark, sf_dir):
    return silver_deduped(spark, sf_dir).select(
        *KEYS, "unit_id", "product_id", "gross_sales", "discount_amount", "line_status",
        "source_sequence", "source_update_ts", "extraction_ts",
    )


def q_superseded_versions(spark, sf_dir):
    return superseded_versions(bronze_sales(spark, sf_dir), tiebreak=A.ADAPTER_TIEBREAK).select(
        *KEYS, "unit_id", "product_id", "source_sequence", "version_rank"
    )


def q_net_sales(spark, sf_dir):
    return calculate_net_sales(bronze_sales(spark, sf_dir)).select(
        *KEYS, "product_id", "unit_id", "line_status", "gross_sales", "discount_amount", "tax_amount",
        "net_sales_before_status", "net_sales",
    )


def q_enhanced_quantity(spark, sf_dir):
    return apply_enhanced_quantity(bronze_sales(spark, sf_dir)).select(
        *KEYS, "product_id", "unit_id", "quantity", "is_priced_product", "is_kitchen_instruction",
        "enhanced_quantity",
    )


def q_quarter_hour_bucket(spark, sf_dir):
    return add_quarter_hour_bucket(A.event_sales_lines(spark, sf_dir)).select(
        "transaction_id", "unit_id", "transaction_completed_ts", "quarter_hour_start_ts", "quarter_hour_key"
    )


def q_discount_strategy(spark, sf_dir):
    return gold_discount_strategy(spark, sf_dir)


def q_discount_actions(spark, sf_dir):
    return products.commercial_action(gold_discount_strategy(spark, sf_dir))


def q_top_discounts(spark, sf_dir):
    return products.top_discounts(gold_discount_strategy(spark, sf_dir), 10)


def q_break_even_15min(spark, sf_dir):
    return products.break_even_view(gold_break_even(spark, sf_dir))


def q_break_even_idle(spark, sf_dir):
    return products.break_even_view(gold_break_even(spark, sf_dir, include_idle=True))


def q_unit_15min_profitability(spark, sf_dir):
    """Undated bucket grain with a break-even multiplier (the rule library's variant)."""
    out = products.unit_15_min_profitability(
        event_silver(spark, sf_dir),
        energy_cost(spark, sf_dir),
        break_even_multiplier=BREAK_EVEN_MULTIPLIER,
        by_business_date=False,
    )
    return out.select(
        *products.BUCKET_KEYS, "net_sales", "enhanced_quantity", "transaction_count", "kwh_consumed",
        "estimated_running_cost", "break_even_threshold", "profitability_gap", "trading_recommendation",
    )


def q_energy_15min(spark, sf_dir):
    return energy_cost(spark, sf_dir)


def q_combo_variance(spark, sf_dir):
    return combo_variance_df(spark, sf_dir)


def q_combo_override(spark, sf_dir):
    return products.combo_price_with_override(
        combo_variance_df(spark, sf_dir), A.combo_price_overrides(spark, sf_dir)
    ).select(
        "product_id", "product_name", "combo_avg_unit_net_price", "override_unit_price",
        "effective_combo_unit_price", "is_price_overridden", "combo_units",
    )


def q_product_controls(spark, sf_dir):
    out = products.product_master_controls(
        silver_sales(spark, sf_dir), A.product_exclusions(spark, sf_dir), A.combo_price_overrides(spark, sf_dir)
    )
    return out.select(
        *KEYS, "product_id", "is_combo", "enhanced_quantity", "exclusion_reason",
        "is_masterdata_excluded_product", "combo_override_unit_price",
    )


def q_dim_unit(spark, sf_dir):
    return silver_dim_unit(spark, sf_dir).drop("_silver_refreshed_at")


def q_dim_product(spark, sf_dir):
    return silver_dim_product(spark, sf_dir).drop("_silver_refreshed_at")


def q_budget_forecast(spark, sf_dir):
    return silver_budget_forecast(spark, sf_dir).drop("_silver_refreshed_at")


def q_budget_variance(spark, sf_dir):
    return products.budget_variance(silver_sales(spark, sf_dir), silver_budget_forecast(spark, sf_dir))


def q_transactional(spark, sf_dir):
    return products.transactional_from_silver(
        silver_sales(spark, sf_dir, by_product=True),
        lookup_dim_unit(spark, sf_dir),
        silver_dim_product(spark, sf_dir),
        silver_budget_forecast(spark, sf_dir),
    )


def q_unified_bronze(spark, sf_dir):
    """Both ingestion routes, whose columns differ, in one table by name."""
    unified = unified_sales(A.pos_extract_lines(spark, sf_dir), A.new_unit_lines(spark, sf_dir))
    return unified.select(*KEYS, "unit_id", "product_id", "gross_sales", "source_file_name", "_source_ingestion_route")


def q_dq_flags(spark, sf_dir):
    flagged = quality.with_dq_flags(A.faulty_sales_lines(spark, sf_dir), quality.BRONZE_SALES_RULES)
    return flagged.select(
        *KEYS, "unit_id", "product_id", F.array_join("_dq_failed_rules", ",").alias("dq_failed_rules")
    )


def q_dq_metrics(spark, sf_dir):
    return quality.dq_metrics(unruled_silver(spark, sf_dir), quality.SILVER_BUSINESS_RULES)


def q_quarantine(spark, sf_dir):
    _, bad = quality.quarantine_split(unruled_silver(spark, sf_dir), quality.SILVER_BUSINESS_RULES)
    return bad.select(*KEYS, "line_status", "net_sales", "enhanced_quantity",
                      F.array_join("_dq_failed_rules", ",").alias("dq_failed_rules"))


def q_dq_alerts(spark, sf_dir):
    metrics = quality.dq_metrics(unruled_silver(spark, sf_dir), quality.SILVER_BUSINESS_RULES)
    return quality.dq_alerts(metrics, quality.notification_owners(spark))


def q_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(bronze_sales(spark, sf_dir), KEYS)


def q_recon_bronze_silver(spark, sf_dir):
    return recon.bronze_silver_dropped(bronze_sales(spark, sf_dir), KEYS)


def q_recon_gold_silver(spark, sf_dir):
    silver = event_silver(spark, sf_dir)
    gold = products.unit_15_min_profitability(silver, energy_cost(spark, sf_dir))
    return recon.gold_silver_net_sales(gold, silver)


def q_missing_countries(spark, sf_dir):
    """Countries of the master with no sales line in a run; runs are the days of the orders."""
    day = F.col("o_orderdate").cast("date")
    orders = A.read_table(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(day)).scalar(), orders.agg(F.max(day)).scalar()
    return recon.missing_countries(A.country_master(spark, sf_dir), silver_sales(spark, sf_dir), first, last)


def q_duplicate_silver_keys(spark, sf_dir):
    """The one-row-per-key contract held against deduplicated Silver."""
    return quality.duplicate_keys(silver_sales(spark, sf_dir), KEYS)


def q_dq_landing(spark, sf_dir):
    return quality.dq_metrics(A.faulty_sales_lines(spark, sf_dir), quality.LANDING_JSON_RULES)


def q_dq_energy(spark, sf_dir):
    return quality.dq_metrics(A.faulty_energy_readings(spark, sf_dir), quality.BRONZE_ENERGY_RULES)


def q_event_discount_actions(spark, sf_dir):
    """Commercial actions over the event lines, whose rates and counts reach all three."""
    band = F.col("user_id") % 4
    share = F.round(F.col("value").cast("decimal(18,2)") * band / 10, 2).cast("double")
    bands = A.read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.element_at(F.array(*[F.lit(x) for x in ("none", "loyalty", "staff", "promo")]), (band + 1).cast("int")).alias("discount_type"),
        share.alias("discount_amount"),
    )
    lines = A.event_sales_lines(spark, sf_dir).drop("discount_amount").join(bands, "transaction_id")
    lines = lines.withColumns({"discount_name": F.lit("events"), "product_category": F.lit("events")})
    return products.commercial_action(products.discount_strategy(lines.transform(apply_sales_business_rules)))


def q_folder_paths(spark, sf_dir):
    part = A.read_table(spark, sf_dir, "part")
    return part.select(
        A.product_id_expr(F.col("p_partkey")).alias("product_id"),
        normalise_folder_name(F.col("p_brand")).alias("folder"),
        build_target_path(F.lit("/lake/landing/master/"), F.col("p_brand"), F.col("p_name")).alias("target_path"),
    )


def q_incremental_extract(spark, sf_dir):
    li = A.read_table(spark, sf_dir, "lineitem")
    return incremental_extract(li, EXTRACT_WATERMARK_COLUMN, EXTRACT_LAST_WATERMARK).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )


def q_watermark_advance(spark, sf_dir):
    li = A.read_table(spark, sf_dir, "lineitem")
    extract = incremental_extract(li, EXTRACT_WATERMARK_COLUMN, EXTRACT_LAST_WATERMARK)
    return advance_watermark(extract, EXTRACT_WATERMARK_COLUMN, EXTRACT_LAST_WATERMARK)


def q_latest_master_snapshot(spark, sf_dir):
    """Two full loads of the product master land as two stamped files; keep the newest."""
    master = A.product_master(spark, sf_dir)
    older = master.withColumn("_file_stamp", F.lit(SNAPSHOT_STAMPS[0]))
    newer = master.withColumns(
        {
            "_file_stamp": F.lit(SNAPSHOT_STAMPS[1]),
            "standard_unit_price": F.round(F.col("standard_unit_price") + 1.0, 2),
        }
    )
    snap = latest_master_snapshot(older.unionByName(newer), ["product_id"])
    return snap.select("product_id", "product_name", "standard_unit_price", "_file_stamp")


def q_analytics_stream(spark, sf_dir):
    """Line-level analytics from a stream of sales lines, joined to the dimensions in the stream."""
    from quarterdeck.streaming.replay import replay_lines_to_analytics

    dimensions = silver_dim_unit(spark, sf_dir), silver_dim_product(spark, sf_dir), silver_budget_forecast(spark, sf_dir, partitioned=False)
    return replay_lines_to_analytics(spark, bronze_sales(spark, sf_dir), dimensions, tiebreak=A.ADAPTER_TIEBREAK)


def q_energy_stream(spark, sf_dir):
    """Energy by quarter hour from the stateful streaming aggregate, readings in time order."""
    from quarterdeck.streaming.energy import replay_readings

    return replay_readings(spark, A.energy_readings(spark, sf_dir), scratch_path(spark, "energy_replay"))[0]


def _control_frame(spark, rows: list[dict]):
    """A control table of the given rows; what a row does not say is empty."""
    names = INGESTION_CONTROL.fieldNames()
    return spark.createDataFrame([tuple({"is_active": True, **row}.get(n) for n in names) for row in rows], INGESTION_CONTROL)


def q_recon_source_landing(spark, sf_dir):
    """Rows that the source reported against rows in the landing area, per entity, of a run over
    orders (since a watermark), customers and suppliers."""
    rows = [
        {"ingestion_id": i, "source_table": table, "target_entity": table, "target_folder": table, "load_pattern": "full"}
        for i, table in enumerate(("orders", "customer", "supplier"), 1)
    ]
    rows[0] |= {"load_pattern": "incremental", "watermark_column": "o_orderdate", "last_watermark_value": ORDERS_LAST_WATERMARK}
    control = _control_frame(spark, rows)
    read = lambda s, row: A.read_table(s, sf_dir, row["source_table"])
    base = scratch_path(spark, "landing")
    audit, updated = run_ingestion(spark, control, read, base)
    landed = [
        read_landing(spark, base, row["target_folder"], A.read_table(spark, sf_dir, row["source_table"]).schema).select(F.lit(row["target_entity"]).alias("target_entity"))
        for row in rows
    ]
    counts = recon.source_bronze_counts(source_counts_from_audit(audit, control), reduce(DataFrame.unionByName, landed), ["target_entity"])
    marks = updated.select("target_entity", F.col("last_watermark_value").alias("new_watermark"))
    return counts.join(marks, "target_entity").select("target_entity", "source_rows", "bronze_rows", "row_difference", "new_watermark")


def q_load_delays(spark, sf_dir):
    """Customers as source entities, their orders as load runs: who is late against the SLA, those
    that never loaded or only failed included."""
    customer, orders = A.read_table(spark, sf_dir, "customer"), A.read_table(spark, sf_dir, "orders")
    control = customer.select(F.col("c_custkey").alias("ingestion_id"), (F.col("c_acctbal") >= 0).alias("is_active"))
    audit = orders.select(
        F.col("o_custkey").alias("ingestion_id"),
        F.col("o_orderdate").cast("timestamp").alias("trigger_time_utc"),
        F.when(F.col("o_orderstatus") == "P", "Failed").otherwise("Succeeded").alias("status"),
    )
    return recon.load_delays(control, audit, F.lit(SLA_NOW).cast("timestamp"), SLA_HOURS)


def q_schema_drift(spark, sf_dir):
    """Drift of a supplier delivery against the schema that customers were stored with.

    Both lose the table's prefix; the nation of suppliers in debt comes as text with a mark.
    """
    customer, supplier = A.read_table(spark, sf_dir, "customer"), A.read_table(spark, sf_dir, "supplier")
    first = customer.toDF(*[c.removeprefix("c_") for c in customer.columns])
    nation = F.when(F.col("acctbal") < 0, F.concat(F.lit("N"), F.col("nationkey").cast("string"))).otherwise(F.col("nationkey").cast("string"))
    later = supplier.toDF(*[c.removeprefix("s_") for c in supplier.columns]).withColumn("nationkey", nation)
    registry = scratch_path(spark, "schema_registry")
    schema_registry.read_tracked(spark, registry, "partners", first)
    _, stored = schema_registry.stored_schema(spark, registry, "partners")
    return schema_registry.drift_report(later, stored)


def q_key_checks(spark, sf_dir):
    """The key contract of orders, line items, parts and customers, from their control rows."""
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey, l_linenumber", "part": "p_partkey", "customer": "c_nationkey, c_mktsegment"}
    control = _control_frame(spark, [{"ingestion_id": i, "source_table": t, "target_entity": t, "primary_key_columns": k} for i, (t, k) in enumerate(keys.items())])
    return quality.key_checks(control, lambda table: A.read_table(spark, sf_dir, table))


def q_landing_day(spark, sf_dir):
    """Events landed by day and one day read back, from that day's folders alone."""
    events = A.read_table(spark, sf_dir, "events")
    base = scratch_path(spark, "landing")
    land_by_day(events, base, "events", F.col("ts"), LANDING_RUN)
    return read_landing(spark, base, "events", events.schema, extract_date=LANDING_DAY, run_id=LANDING_RUN)


def q_json_lines(spark, sf_dir):
    """The lines of the new units through JSON-lines files and back, typed."""
    lines = A.new_unit_lines(spark, sf_dir)
    path = scratch_path(spark, "json_lines")
    write_json_lines(lines, path)
    parsed, _ = split_corrupt(read_json_lines(spark, path, lines.schema))
    return parsed.select(
        *KEYS, "unit_id", "product_id", "transaction_completed_ts", "is_combo", "quantity", "gross_sales",
        "discount_amount", "tax_amount", "discount_name", "source_sequence", "extraction_ts",
    )


def q_table_registry(spark, sf_dir):
    """The dimension tables as written and declared: properties from the catalog, rows from the data."""
    root, database = scratch_path(spark, "registered"), "quarterdeck_registry"
    frames = {"silver_dim_unit": silver_dim_unit, "silver_dim_product": silver_dim_product, "silver_daily_budget_forecast": silver_budget_forecast}
    counts = []
    for name, build in frames.items():
        tables.declare_table(spark, database, name, tables.write_table(build(spark, sf_dir), root, name))
        counts.append(spark.table(f"{database}.{name}").agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")))
    return tables.declared_tables(spark, database).join(reduce(DataFrame.unionByName, counts), "table_name")


def q_scd1_stream(spark, sf_dir):
    """Current lines from a stream of their versions, in the columns of the answer: landing, upserts
    and table are written, so columns that nothing reads would travel through all of them."""
    from quarterdeck.streaming.replay import replay_sales_as_stream

    lines = bronze_sales(spark, sf_dir).select(
        *KEYS, "unit_id", "product_id", "gross_sales", "discount_amount", "line_status",
        "source_sequence", "source_update_ts", "extraction_ts",
    )
    return replay_sales_as_stream(spark, lines, tiebreak=A.ADAPTER_TIEBREAK).select(*lines.columns)


def _view(name: str, needs: tuple[str, ...]):
    """A registered query answered through the SQL API: source tables as temp views, the
    analytics view on top (``spark.sql``), Catalyst planning both paths identically."""

    def build(spark, sf_dir):
        from quarterdeck.plans.views import register_views

        sources = {
            "silver_sales_line_items_business": lambda: silver_sales(spark, sf_dir, by_product="silver_dim_product" in needs),
            "gold_discount_strategy": lambda: gold_discount_strategy(spark, sf_dir),
            "gold_unit_quarter_hour_sales": lambda: gold_break_even(spark, sf_dir),
            "silver_dim_unit": lambda: lookup_dim_unit(spark, sf_dir),
            "silver_dim_product": lambda: silver_dim_product(spark, sf_dir),
            "silver_daily_budget_forecast": lambda: silver_budget_forecast(spark, sf_dir),
        }
        register_views(spark, {t: sources[t]() for t in needs})
        return spark.table(name)

    return build


QUERIES: dict[str, Query] = {
    "atv": q_atv,
    "silver_business": q_silver_business,
    "dedupe_reposted": q_dedupe_reposted,
    "superseded_versions": q_superseded_versions,
    "net_sales": q_net_sales,
    "enhanced_quantity": q_enhanced_quantity,
    "quarter_hour_bucket": q_quarter_hour_bucket,
    "discount_strategy": q_discount_strategy,
    "discount_actions": q_discount_actions,
    "top_discounts": q_top_discounts,
    "break_even_15min": q_break_even_15min,
    "break_even_idle": q_break_even_idle,
    "unit_15min_profitability": q_unit_15min_profitability,
    "energy_15min": q_energy_15min,
    "combo_variance": q_combo_variance,
    "combo_override": q_combo_override,
    "product_controls": q_product_controls,
    "dim_unit": q_dim_unit,
    "dim_product": q_dim_product,
    "budget_forecast": q_budget_forecast,
    "budget_variance": q_budget_variance,
    "transactional": q_transactional,
    "unified_bronze": q_unified_bronze,
    "dq_flags": q_dq_flags,
    "dq_metrics": q_dq_metrics,
    "quarantine": q_quarantine,
    "dq_alerts": q_dq_alerts,
    "duplicate_keys": q_duplicate_keys,
    "recon_bronze_silver": q_recon_bronze_silver,
    "recon_gold_silver": q_recon_gold_silver,
    "missing_countries": q_missing_countries,
    "duplicate_silver_keys": q_duplicate_silver_keys,
    "dq_landing": q_dq_landing,
    "dq_energy": q_dq_energy,
    "event_discount_actions": q_event_discount_actions,
    "folder_paths": q_folder_paths,
    "incremental_extract": q_incremental_extract,
    "watermark_advance": q_watermark_advance,
    "latest_master_snapshot": q_latest_master_snapshot,
    "scd1_stream": q_scd1_stream,
    "analytics_stream": q_analytics_stream,
    "energy_stream": q_energy_stream,
    "recon_source_landing": q_recon_source_landing,
    "load_delays": q_load_delays,
    "schema_drift": q_schema_drift,
    "key_checks": q_key_checks,
    "landing_day": q_landing_day,
    "json_lines": q_json_lines,
    "table_registry": q_table_registry,
    "vw_atv": _view("vw_enhanced_quantity_atv", ("silver_sales_line_items_business",)),
    "vw_discount_strategy": _view("vw_discount_strategy", ("gold_discount_strategy",)),
    "vw_break_even": _view("vw_unit_sales_15_min_break_even", ("gold_unit_quarter_hour_sales",)),
    "vw_combo_analytics": _view("vw_combo_analytics", ("silver_sales_line_items_business",)),
    "vw_transactional": _view(
        "vw_sales_transactional_from_silver",
        ("silver_sales_line_items_business", "silver_dim_unit", "silver_dim_product", "silver_daily_budget_forecast"),
    ),
}
