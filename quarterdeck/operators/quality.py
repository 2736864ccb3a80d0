"""Data-quality expectations: named SQL predicates; failing rows are kept and flagged.

Predicates over Bronze read raw text columns, so numeric checks ``try_cast`` first (an
unparseable amount fails the rule instead of failing the job under ANSI mode).

``with_dq_flags`` adds ``_dq_failed_rules``; ``dq_metrics`` counts failures of every rule in
one aggregate pass (map-side partial counts, one tiny shuffle); ``quarantine_split`` routes
flagged rows. A predicate that evaluates to NULL counts as failed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators.rules import require_columns
from quarterdeck.sources.control import active_control_rows, key_columns

# The expectations of each table, name → predicate.
LANDING_JSON_RULES = {
    "transaction_id_is_present": "transaction_id IS NOT NULL",
    "business_date_is_present": "business_date IS NOT NULL",
}
BRONZE_SALES_RULES = {
    "transaction_id_is_present": "transaction_id IS NOT NULL",
    "business_date_is_present": "business_date IS NOT NULL",
    "gross_sales_is_not_negative_for_completed_lines": (
        "line_status <> 'completed' OR try_cast(gross_sales AS DOUBLE) >= 0"
    ),
}
BRONZE_ENERGY_RULES = {
    "unit_id_is_present": "unit_id IS NOT NULL",
    "running_cost_is_non_negative": "try_cast(estimated_running_cost AS DOUBLE) >= 0",
}
SILVER_BUSINESS_RULES = {
    "valid_net_sales": "net_sales IS NOT NULL",
    "valid_enhanced_quantity": "enhanced_quantity >= 0",
    "cancelled_lines_net_to_zero": "coalesce(lower(line_status), '') <> 'cancelled' OR net_sales = 0",
    "returned_lines_not_positive": "coalesce(lower(line_status), '') <> 'returned' OR net_sales <= 0",
}

# Who is told when a rule fails (rule, technical owner, functional owner).
NOTIFICATION_OWNERS = [
    ("valid_net_sales", "data-platform", "finance-reporting"),
    ("valid_enhanced_quantity", "data-platform", "commercial-analytics"),
    ("cancelled_lines_net_to_zero", "pos-integration", "finance-reporting"),
    ("returned_lines_not_positive", "pos-integration", "finance-reporting"),
    ("transaction_id_is_present", "pos-integration", "store-operations"),
    ("business_date_is_present", "pos-integration", "store-operations"),
    ("gross_sales_is_not_negative_for_completed_lines", "pos-integration", "finance-reporting"),
    ("unit_id_is_present", "energy-integration", "estates"),
    ("running_cost_is_non_negative", "energy-integration", "estates"),
]

FAILED_COL = "_dq_failed_rules"


def passed(predicate: str):
    return F.coalesce(F.expr(predicate), F.lit(False))


def with_dq_flags(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    checks = [F.when(~passed(p), F.lit(name)) for name, p in rules.items()]
    return df.withColumn(FAILED_COL, F.array_compact(F.array(*checks)))


def dq_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows checked, failed, passed (a single scan of ``df``)."""
    names = list(rules)
    wide = df.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(~passed(rules[n])).alias(n) for n in names],
    )
    long = wide.unpivot("rows_checked", names, "rule_name", "rows_failed")
    return long.select(
        "rule_name",
        "rows_checked",
        "rows_failed",
        (F.col("rows_checked") - F.col("rows_failed")).alias("rows_passed"),
    )


def observe_expectations(df: DataFrame, rules: Mapping[str, str], name) -> DataFrame:
    """Count rows and failures per rule as named metrics while the data flows (no extra
    pass). ``name`` is a metric name (streams: each micro-batch's ``observedMetrics`` in the
    query progress, i.e. the expectation log of a run) or an ``Observation`` (batch)."""
    return df.observe(
        name,
        F.count(F.lit(1)).alias("rows_checked"),
        *[F.count_if(~passed(p)).alias(f"failed_{n}") for n, p in rules.items()],
    )


def quarantine_split(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows) — both keep ``_dq_failed_rules``."""
    flagged = with_dq_flags(df, rules)
    bad = F.size(FAILED_COL) > 0
    return flagged.filter(~bad), flagged.filter(bad)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (must be empty after deduplication)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def notification_owners(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        NOTIFICATION_OWNERS, "rule_name string, technical_owner string, functional_owner string"
    )


def dq_alerts(metrics: DataFrame, owners: DataFrame) -> DataFrame:
    """Failed rules with their owners (both inputs are one row per rule)."""
    return (
        metrics.filter("rows_failed > 0")
        .join(F.broadcast(owners), "rule_name", "left")
        .select("rule_name", "rows_checked", "rows_failed", "technical_owner", "functional_owner")
    )


def key_checks(control: DataFrame, read: Callable[[str], DataFrame]) -> DataFrame:
    """The one-row-per-key contract of every active entity of a control table.

    The control table says per entity its source object and its key columns as a comma list; any
    number of entities takes the same check. Rows with a null in a key column are counted apart and
    belong to no key. A key's rows are summed map-side first, so one very frequent key is no group
    of its own. The control rows are configuration; they are read to build the plan.
    """
    out = []
    for row in key_columns(active_control_rows(control)).orderBy("target_entity").collect():
        keys = list(row["primary_key_array"])
        entity = read(row["source_table"])
        require_columns(entity, keys)
        per_key = entity.groupBy(*keys).agg(F.count("*").alias("__rows"))
        whole = F.lit(True)
        for key in keys:
            whole = whole & F.col(key).isNotNull()
        total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("long")
        again = whole & (F.col("__rows") > 1)
        out.append(
            per_key.agg(
                F.lit(row["target_entity"]).alias("target_entity"),
                F.lit(",".join(keys)).alias("key_columns"),
                total(F.col("__rows")).alias("rows_checked"),
                total(whole.cast("int")).alias("distinct_keys"),
                total(again.cast("int")).alias("duplicate_keys"),
                total(F.when(again, F.col("__rows") - 1)).alias("surplus_rows"),
                total(F.when(~whole, F.col("__rows"))).alias("null_key_rows"),
            )
        )
    if not out:
        raise ValueError("the control table has no active entity")
    return reduce(DataFrame.unionByName, out)
