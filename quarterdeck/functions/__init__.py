"""Column -> Column building blocks (all JVM-side built-ins, no Python UDFs)."""

from quarterdeck.functions.money import (
    exact_avg,
    exact_sum,
    ratio_or_null,
    ratio_or_zero,
    to_double_or_null,
    to_double_or_zero,
)
from quarterdeck.functions.paths import build_target_path, normalise_folder_name
from quarterdeck.functions.time import parse_utc_ts, quarter_hour_key, quarter_hour_start

__all__ = [
    "build_target_path",
    "exact_sum",
    "normalise_folder_name",
    "parse_utc_ts",
    "quarter_hour_key",
    "quarter_hour_start",
    "ratio_or_null",
    "ratio_or_zero",
    "to_double_or_null",
    "to_double_or_zero",
]
