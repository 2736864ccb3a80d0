"""Reconciliation between layers and against the run schedule.

Every check aggregates each side first and joins the (small) aggregates, never the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions.money import exact_sum, round_half_up

DEFAULT_TOLERANCE = 0.005


def source_bronze_counts(source_counts: DataFrame, bronze: DataFrame, by: Sequence[str]) -> DataFrame:
    """R1: rows reported by the source (e.g. the run audit) vs rows landed in Bronze."""
    b = bronze.groupBy(*by).agg(F.count(F.lit(1)).alias("bronze_rows"))
    j = source_counts.join(b, list(by), "full")
    return j.withColumn(
        "row_difference", F.coalesce("source_rows", F.lit(0)) - F.coalesce("bronze_rows", F.lit(0))
    )


def bronze_silver_dropped(bronze: DataFrame, keys: Sequence[str], by: str = "business_date") -> DataFrame:
    """R2: rows that deduplication drops between Bronze and Silver, per value of ``by``.

    Silver holds one row per key, so one pass over Bronze tells both counts: rows per key first
    (partial aggregates shrink a key that was posted very often), then keys per value.
    """
    per_key = bronze.groupBy(*dict.fromkeys([by, *keys])).agg(F.count(F.lit(1)).alias("rows"))
    counts = per_key.groupBy(by).agg(F.sum("rows").alias("bronze_rows"), F.count(F.lit(1)).alias("silver_rows"))
    return counts.withColumn("dropped_rows", F.col("bronze_rows") - F.col("silver_rows"))


def gold_silver_net_sales(gold: DataFrame, silver: DataFrame, tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """R3: Gold vs Silver net sales by country and business date."""
    keys = ["country_code", "business_date"]
    g = gold.groupBy(*keys).agg(exact_sum("net_sales").alias("gold_net_sales"))
    s = silver.groupBy(*keys).agg(exact_sum("net_sales").alias("silver_net_sales"))
    j = g.join(s, keys, "full")
    diff = round_half_up(F.coalesce("gold_net_sales", F.lit(0.0)) - F.coalesce("silver_net_sales", F.lit(0.0)), 2)
    return j.withColumn("net_sales_difference", diff).withColumn(
        "is_reconciled", F.abs(F.col("net_sales_difference")) <= F.lit(tolerance)
    )


def missing_countries(countries: DataFrame, sales: DataFrame, first_run, last_run, run_col: str = "business_date") -> DataFrame:
    """R4: (run, country) pairs of a daily run calendar for which a country sent no sales line.

    The calendar from ``first_run`` to ``last_run`` is expanded for each country of the master,
    so a run in which every country was silent is reported too. The days may be dates or columns,
    such as scalar subqueries.
    """
    days = F.sequence(F.lit(first_run).cast("date"), F.lit(last_run).cast("date"))
    expected = countries.select("country_code").distinct().select(F.explode(days).alias(run_col), "country_code")
    return expected.join(sales.select(run_col, "country_code").distinct(), [run_col, "country_code"], "left_anti")


def load_delays(control: DataFrame, audit: DataFrame, now: Column, max_hours: float, entity: str = "ingestion_id") -> DataFrame:
    """R5: every active entity of the control table with its last successful load and whether that
    is older than ``max_hours``.

    An entity that never loaded, or whose runs all failed, is delayed as well, with a null lag. The
    status and error of the newest run tell why (of runs at one time, a failed one counts).
    """
    active = control.where(F.coalesce("is_active", F.lit(False))).select(entity).distinct()
    done = F.when(F.col("status") == "Succeeded", F.col("trigger_time_utc"))
    newest = F.max_by("status", F.struct("trigger_time_utc", (F.col("status") != "Succeeded").alias("failed"), "status"))
    runs = audit.groupBy(entity).agg(
        F.max(done).alias("last_success_utc"),
        newest.alias("last_status"),
        F.count_if(F.col("status") != "Succeeded").alias("failed_runs"),
    )
    lag = (F.unix_seconds(now) - F.unix_seconds("last_success_utc")) / 3600.0
    return active.join(runs, entity, "left").select(
        entity,
        "last_success_utc",
        F.coalesce("last_status", F.lit("Never run")).alias("last_status"),
        F.coalesce("failed_runs", F.lit(0)).cast("long").alias("failed_runs"),
        lag.alias("hours_since_success"),
        F.coalesce(lag > F.lit(max_hours), F.lit(True)).alias("is_delayed"),
    )
