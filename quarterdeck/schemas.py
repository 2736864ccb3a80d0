"""Explicit schemas, column contracts and the table registry.

Types are declared, never inferred: CSV and JSON inference disagree on dates and timestamps,
and the two sales routes are unioned by name.
"""

from __future__ import annotations

from pyspark.sql import types as T

DEDUP_KEYS = ["business_date", "transaction_id", "transaction_line_id"]
SEQUENCE_COLS = ["source_sequence", "source_update_ts", "extraction_ts"]
MONEY_COLUMNS = ["gross_sales", "discount_amount", "tax_amount"]

# Raw sales line as extracted from the POS database (CSV route). Timestamps stay text here:
# the two routes write them differently (ISO 'T' vs space), and parsing is a Silver rule.
SALES_RAW = T.StructType(
    [
        T.StructField("business_date", T.DateType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("unit_name", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("transaction_line_id", T.StringType()),
        T.StructField("transaction_completed_ts", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("product_category", T.StringType()),
        T.StructField("is_combo", T.BooleanType()),
        T.StructField("quantity", T.StringType()),
        T.StructField("gross_sales", T.StringType()),
        T.StructField("discount_amount", T.StringType()),
        T.StructField("tax_amount", T.StringType()),
        T.StructField("discount_type", T.StringType()),
        T.StructField("discount_name", T.StringType()),
        T.StructField("line_status", T.StringType()),
        T.StructField("is_priced_product", T.BooleanType()),
        T.StructField("is_kitchen_instruction", T.BooleanType()),
        T.StructField("source_sequence", T.LongType()),
        T.StructField("source_update_ts", T.StringType()),
        T.StructField("extraction_ts", T.StringType()),
        T.StructField("source_file_name", T.StringType()),
    ]
)

# The JSON route carries the same fields minus source_file_name.
SALES_JSON = T.StructType([f for f in SALES_RAW.fields if f.name != "source_file_name"])

METADATA_COLS = ["_ingested_at", "_source_file", "_source_ingestion_route"]

# Contract order of the standardised Bronze sales projection (28 columns).
SALES_COLS = [f.name for f in SALES_JSON.fields] + METADATA_COLS

ENERGY_RAW = T.StructType(
    [
        T.StructField("unit_id", T.StringType()),
        T.StructField("quarter_hour_start_ts", T.StringType()),
        T.StructField("kwh_consumed", T.StringType()),
        T.StructField("energy_unit_rate", T.StringType()),
        T.StructField("estimated_running_cost", T.StringType()),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("snapshot_date", T.DateType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("on_hand_quantity", T.LongType()),
        T.StructField("reserved_quantity", T.LongType()),
        T.StructField("waste_quantity", T.LongType()),
    ]
)


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Business-owned master files, keyed by the normalised entity (folder) name.
MASTER_SCHEMAS: dict[str, T.StructType] = {
    "product": T.StructType(
        _s("product_id", "product_name", "product_category")
        + [
            T.StructField("standard_unit_price", T.DoubleType()),
            T.StructField("is_priced_product", T.BooleanType()),
            T.StructField("is_kitchen_instruction", T.BooleanType()),
        ]
    ),
    "unit": T.StructType(
        _s("country_code", "location_id", "location_name", "unit_id", "unit_name", "currency_code")
    ),
    "unitmappingoverride": T.StructType(_s("unit_id", "corrected_unit_name")),
    "country": T.StructType(_s("country_code", "country_name", "region")),
    "dailybudget": T.StructType(
        [
            T.StructField("business_date", T.DateType()),
            T.StructField("unit_id", T.StringType()),
            T.StructField("daily_budget_net_sales", T.DoubleType()),
        ]
    ),
    "forecast": T.StructType(
        [
            T.StructField("business_date", T.DateType()),
            T.StructField("unit_id", T.StringType()),
            T.StructField("forecast_net_sales", T.DoubleType()),
        ]
    ),
    "producthierarchycorrections": T.StructType(
        _s("product_id", "product_category", "corrected_category")
    ),
    "productexclusions": T.StructType(
        _s("product_id", "exclusion_reason") + [T.StructField("is_active", T.BooleanType())]
    ),
    "comboaveragepriceoverride": T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("override_unit_price", T.StringType()),
            T.StructField("is_active", T.BooleanType()),
        ]
    ),
}

# Entity key of each master file, used to pick one current row per key.
MASTER_KEYS: dict[str, list[str]] = {
    "product": ["product_id"],
    "unit": ["unit_id"],
    "unitmappingoverride": ["unit_id"],
    "country": ["country_code"],
    "dailybudget": ["business_date", "unit_id"],
    "forecast": ["business_date", "unit_id"],
    "producthierarchycorrections": ["product_id"],
    "productexclusions": ["product_id"],
    "comboaveragepriceoverride": ["product_id"],
}

# Control table that drives database extraction (one row per source object).
INGESTION_CONTROL = T.StructType(
    [
        T.StructField("ingestion_id", T.LongType()),
        *_s("source_system", "source_schema", "source_table", "target_entity", "load_pattern"),
        *_s("watermark_column", "last_watermark_value", "primary_key_columns"),
        *_s("target_container", "target_folder", "file_format", "run_group"),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at_utc", T.TimestampType()),
        T.StructField("updated_at_utc", T.TimestampType()),
    ]
)

RUN_AUDIT = T.StructType(
    [
        T.StructField("audit_id", T.LongType()),
        T.StructField("ingestion_id", T.LongType()),
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("trigger_time_utc", T.TimestampType()),
        T.StructField("rows_read", T.LongType()),
        T.StructField("rows_written", T.LongType()),
        *_s("status", "previous_watermark", "new_watermark", "error_message"),
        T.StructField("created_at_utc", T.TimestampType()),
    ]
)

MASTER_CONTROL = T.StructType(
    [
        T.StructField("master_ingestion_id", T.LongType()),
        *_s("source_system", "source_site_url", "source_folder_path", "source_file_name"),
        *_s("file_format", "worksheet_name", "entity_name", "secret_store_service"),
        *_s("app_id_secret_name", "app_secret_secret_name", "tenant_id_secret_name"),
        *_s("target_container", "target_base_folder"),
        T.StructField("remove_spaces_from_folder", T.BooleanType()),
        *_s("target_file_format", "load_pattern"),
        T.StructField("is_active", T.BooleanType()),
        T.StructField("created_at_utc", T.TimestampType()),
        T.StructField("updated_at_utc", T.TimestampType()),
    ]
)

# One registry of table names, layers, write modes and comments: writers take their mode from it
# (``sources/tables.py``, ``streaming/pipeline.py``), the catalog gets all of it as properties.
TABLES: dict[str, dict[str, str]] = {
    "landing_new_unit_sales_json": {
        "layer": "landing", "mode": "append", "source_pattern": "json_files",
        "comment": "JSON-lines sales files of newly onboarded units, as delivered, with failed rules",
    },
    "bronze_oracle_sales_line_items": {
        "layer": "bronze", "mode": "append", "source_pattern": "csv_extract",
        "comment": "Sales lines extracted from the point-of-sale database, with failed rules",
    },
    "bronze_new_unit_sales_line_items": {
        "layer": "bronze", "mode": "append", "source_pattern": "json_files",
        "comment": "Sales lines of newly onboarded units under the sales contract",
    },
    "bronze_sales_line_items_unified": {
        "layer": "bronze", "mode": "append", "comment": "Sales lines of both routes, united by name",
    },
    "bronze_energy_meter_readings": {
        "layer": "bronze", "mode": "append", "source_pattern": "csv_extract", "comment": "Energy readings by reading date",
    },
    "bronze_master_files": {
        "layer": "bronze", "mode": "append", "source_pattern": "master_parquet",
        "comment": "Every load of the business-owned master files, one folder per entity",
    },
    "silver_sales_line_items_deduped": {
        "layer": "silver", "mode": "upsert", "merge_pattern": "scd1", "comment": "Current version of each sales line",
    },
    "silver_sales_line_items_business": {
        "layer": "silver", "mode": "upsert", "merge_pattern": "scd1", "comment": "Current sales lines after the business rules",
    },
    "silver_sales_line_items_changes": {
        "layer": "silver", "mode": "append", "comment": "Change feed: the lines of each batch in their current version",
    },
    "silver_dim_unit": {"layer": "silver", "mode": "overwrite", "comment": "Trading units under their business names"},
    "silver_dim_product": {"layer": "silver", "mode": "overwrite", "comment": "Products in their corrected category"},
    "silver_daily_budget_forecast": {"layer": "silver", "mode": "overwrite", "comment": "Budget and forecast by date and unit"},
    "silver_energy_15_minute_cost": {
        "layer": "silver", "mode": "recompute_touched_dates", "comment": "Energy use and cost by unit and quarter hour",
    },
    "gold_unit_quarter_hour_sales": {"layer": "gold", "mode": "overwrite", "comment": "Break-even of units by quarter hour"},
    "gold_discount_strategy": {"layer": "gold", "mode": "overwrite", "comment": "Discounts by unit, type and category"},
    "analytics_sales_transactional": {
        "layer": "analytics", "mode": "upsert", "merge_pattern": "scd1",
        "comment": "Sales lines with unit, product, budget and forecast, one row per line",
    },
}
