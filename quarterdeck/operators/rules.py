"""Sales business rules as DataFrame -> DataFrame transforms (chain with ``df.transform``).

Each rule validates its input columns when the plan is built (no Spark job), then adds
columns with native expressions only, so a chain of rules is one narrow, codegen'd stage.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.functions.money import round_half_up, to_double_or_zero
from quarterdeck.functions.time import parse_utc_ts, quarter_hour_key, quarter_hour_start
from quarterdeck.schemas import MONEY_COLUMNS, SALES_COLS

# Line statuses with special revenue treatment (compared case-insensitively).
STATUS_CANCELLED = "cancelled"
STATUS_RETURNED = "returned"

# Trading recommendations of the break-even product.
REVIEW_OPEN_CLOSE = "review_open_close_time"
KEEP_TRADING_WINDOW = "keep_current_trading_window"


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """The column as a UTC timestamp: text is parsed, timestamps pass through."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampType):
        return F.col(name)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        return F.col(name).cast("timestamp")
    return parse_utc_ts(F.col(name))


def net_sales_expr(before: Column, status: Column) -> Column:
    """cancelled → 0; returned → -|before|; anything else (incl. null status) → before."""
    s = F.lower(status)
    return (
        F.when(s == STATUS_CANCELLED, F.lit(0.0))
        .when(s == STATUS_RETURNED, -F.abs(before))
        .otherwise(before)
    )


def calculate_net_sales(df: DataFrame) -> DataFrame:
    """Money columns coerced (bad/null → 0), ``net_sales_before_status`` and ``net_sales``."""
    require_columns(df, MONEY_COLUMNS + ["line_status"])
    coerced = {c: to_double_or_zero(c) for c in MONEY_COLUMNS}
    before = round_half_up(
        coerced["gross_sales"] - coerced["discount_amount"] - coerced["tax_amount"], 2
    )
    return df.withColumns(coerced).withColumns(
        {
            "net_sales_before_status": before,
            "net_sales": round_half_up(net_sales_expr(before, F.col("line_status")), 2),
        }
    )


def enhanced_quantity_expr(quantity: Column, priced: Column, kitchen: Column) -> Column:
    """Quantity of priced, non-kitchen-instruction lines; 0 otherwise (null flags → 0)."""
    valid = F.coalesce(priced, F.lit(False)) & ~F.coalesce(kitchen, F.lit(True))
    return F.when(valid, to_double_or_zero(quantity)).otherwise(F.lit(0.0))


def apply_enhanced_quantity(df: DataFrame) -> DataFrame:
    require_columns(df, ["quantity", "is_priced_product", "is_kitchen_instruction"])
    return df.withColumns(
        {
            "quantity": to_double_or_zero("quantity"),
            "enhanced_quantity": enhanced_quantity_expr(
                F.col("quantity"), F.col("is_priced_product"), F.col("is_kitchen_instruction")
            ),
        }
    )


def add_quarter_hour_bucket(df: DataFrame, timestamp_col: str = "transaction_completed_ts") -> DataFrame:
    """Parse ``timestamp_col`` to UTC and add ``quarter_hour_start_ts`` / ``quarter_hour_key``."""
    require_columns(df, [timestamp_col])
    ts = as_timestamp(df, timestamp_col)
    return df.withColumn(timestamp_col, ts).withColumns(
        {
            "quarter_hour_start_ts": quarter_hour_start(F.col(timestamp_col)),
            "quarter_hour_key": quarter_hour_key(quarter_hour_start(F.col(timestamp_col))),
        }
    )


def parse_sequence_columns(df: DataFrame) -> DataFrame:
    """Typed version columns: sequence as long, update/extraction times as UTC timestamps."""
    require_columns(df, ["source_sequence", "source_update_ts", "extraction_ts"])
    return df.withColumns(
        {
            "source_sequence": F.col("source_sequence").try_cast("long"),
            "source_update_ts": as_timestamp(df, "source_update_ts"),
            "extraction_ts": as_timestamp(df, "extraction_ts"),
        }
    )


def apply_sales_business_rules(df: DataFrame) -> DataFrame:
    """Silver business rules on deduplicated lines: net sales, enhanced quantity, bucket."""
    require_columns(df, ["transaction_id"])
    return (
        df.transform(calculate_net_sales)
        .transform(apply_enhanced_quantity)
        .transform(add_quarter_hour_bucket)
    )


def standardise_sales_columns(df: DataFrame) -> DataFrame:
    """Fixed projection in contract order; columns a route lacks come through as null."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SALES_COLS]
    )


def with_ingestion_metadata(df: DataFrame, route: str | None = None, source_file: Column | None = None) -> DataFrame:
    """``_ingested_at``, ``_source_file`` (file path from the scan metadata) and route tag."""
    cols = {
        "_ingested_at": F.current_timestamp(),
        "_source_file": source_file if source_file is not None else F.col("_metadata.file_path"),
    }
    if route is not None:
        cols["_source_ingestion_route"] = F.lit(route)
    return df.withColumns(cols)


def trading_recommendation(gap: Column) -> Column:
    return F.when(gap < 0, F.lit(REVIEW_OPEN_CLOSE)).otherwise(F.lit(KEEP_TRADING_WINDOW))
