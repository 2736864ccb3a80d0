"""Latest-version selection: reposted sales lines (W1/W3) and master-file snapshots (W5).

The latest row per key is a ``row_number() = 1`` filter over a window partitioned by the
business key. Catalyst turns that filter into a ``WindowGroupLimit`` on *both* sides of
the shuffle, so superseded versions are dropped map-side and a hot key (a line reposted
many times, or a flood of copies) reaches its reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.operators.rules import parse_sequence_columns, require_columns
from quarterdeck.schemas import DEDUP_KEYS, SEQUENCE_COLS

_RN = "__qd_version_rank"


def version_order(df: DataFrame, order: Sequence[str], tiebreak: Sequence[str] | None) -> list[Column]:
    """Newest first; nulls lose. Ties fall to ``tiebreak`` columns, else to the source file
    and a hash of every remaining column, which makes the order total (replay-safe)."""
    cols = [F.col(c).desc_nulls_last() for c in order]
    if tiebreak is not None:
        cols += [F.col(c).desc_nulls_last() for c in tiebreak]
    else:
        if "_source_file" in df.columns:
            cols.append(F.col("_source_file").desc_nulls_last())
        rest = [c for c in df.columns if c not in set(order) | {"_source_file", "_ingested_at"}]
        cols.append(F.xxhash64(*[F.col(c) for c in rest]).desc())
    return cols


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*version_order(df, order, tiebreak))
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_reposted_sales_lines(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = SEQUENCE_COLS,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """One current row per sales-line key: highest (sequence, update ts, extraction ts)."""
    require_columns(df, list(keys) + list(order))
    return latest_per_key(df.transform(parse_sequence_columns), keys, order, tiebreak)


def superseded_versions(
    df: DataFrame,
    keys: Sequence[str] = DEDUP_KEYS,
    order: Sequence[str] = SEQUENCE_COLS,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The rows W1 drops (repost evidence), with their rank (2 = first superseded)."""
    typed = df.transform(parse_sequence_columns)
    w = Window.partitionBy(*keys).orderBy(*version_order(typed, order, tiebreak))
    return typed.withColumn("version_rank", F.row_number().over(w)).filter("version_rank > 1")


def latest_master_snapshot(df: DataFrame, keys: Sequence[str], stamp_col: str = "_file_stamp") -> DataFrame:
    """Rows of the newest load of a master entity, then one row per entity key.

    Each full load of a business master file lands as a new time-stamped file and Bronze is
    append-only, so older loads must not fan out joins. The newest stamp is a one-row
    aggregate, joined back by broadcast (its size is one row by construction).
    """
    require_columns(df, list(keys) + [stamp_col])
    newest = df.agg(F.max(stamp_col).alias("__qd_newest"))
    current = df.join(F.broadcast(newest), F.col(stamp_col) == F.col("__qd_newest")).drop("__qd_newest")
    return latest_per_key(current, keys, [stamp_col])
