"""The control table: which source objects are active, and the key columns of each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_control_rows(control: DataFrame, run_group: str | None = None) -> DataFrame:
    active = control.filter(F.coalesce(F.col("is_active"), F.lit(False)))
    return active if run_group is None else active.filter(F.col("run_group") == run_group)


def key_columns(control: DataFrame) -> DataFrame:
    """Primary-key list of each object as an array of trimmed column names."""
    return control.withColumn(
        "primary_key_array", F.transform(F.split("primary_key_columns", ","), lambda c: F.trim(c))
    )
