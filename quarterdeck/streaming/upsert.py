"""Keyed current-state tables on plain parquet: a ``foreachBatch`` upsert (SCD type 1).

The table is partitioned by ``business_date`` (part of the key) or by a coarser value
derived from it (``partition_expr``, e.g. the month), so a key never moves between
partitions. For each micro-batch:

1. rows with a null key part go to quarantine (``{target}_quarantine/batch_id=N``);
2. the touched partitions of the batch are found (one aggregate; a set bounded by the
   calendar, not by the data);
3. the stored rows of those partitions (partition pruning) are unioned with the batch and
   reduced to the newest version per key (the same total order as batch dedupe);
4. the result is written once, by partition, to a stage of its own, ``_staging/{uuid}``; its
   partition folders then take the place of the table's by renaming, and the stage is deleted.

No decision rests on a batch id or a checkpoint: a stage that a crash left behind holds
versions that may be missing from the table, so the next call reads what every complete one still
holds as further input, with the partitions it touches, and deletes it after the swap. The pick of the
newest version is a maximum under a total order, so replays and repairs give the same rows, and
an older version that arrives later loses.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators.dedupe import latest_per_key
from quarterdeck.operators.rules import parse_sequence_columns
from quarterdeck.schemas import DEDUP_KEYS, SEQUENCE_COLS


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        fs, p = _fs(spark, path)
    except Exception:  # no JVM gateway (Spark Connect): probe by listing through Spark
        try:
            spark.read.format("binaryFile").load(path).limit(1).collect()
            return True
        except Exception:
            return False
    return bool(fs.exists(p))


def list_folders(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [f"{path}/{x.getPath().getName()}" for x in fs.listStatus(p) if x.isDirectory()] if fs.exists(p) else []


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path pattern matches anything."""
    fs, p = _fs(spark, pattern)
    return bool(fs.globStatus(p))


def ensure_folder(spark: SparkSession, path: str) -> None:
    """An empty folder that a stream may watch before anything is delivered."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[1]):
        raise OSError(f"{path} could not be moved to {to}")


def read_partitions(spark: SparkSession, target: str, partition_col: str, values: list) -> DataFrame | None:
    """Only the given partitions of a table, with their schemas merged.

    Reading the whole table would take its schema from one file (possibly an old one
    without columns added later) and drop those columns when the partitions are rewritten;
    merging the footers of just the touched partitions keeps every column at a cost
    bounded by the batch, not the table.
    """
    paths = [f"{target}/{partition_col}={v}" for v in values]
    paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return None
    return spark.read.option("mergeSchema", "true").option("basePath", target).parquet(*paths)


def _typed(df: DataFrame) -> DataFrame:
    return df.transform(parse_sequence_columns) if "source_sequence" in df.columns else df


class Scd1Upsert:
    """``foreachBatch`` callable keeping the newest version of every key in ``target``."""

    def __init__(
        self,
        target: str,
        keys: Sequence[str] = DEDUP_KEYS,
        order: Sequence[str] = SEQUENCE_COLS,
        tiebreak: Sequence[str] | None = None,
        partition_col: str = "business_date",
        partition_expr: Column | None = None,
        quarantine: str | None = None,
        prepare: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        self.target = target.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.tiebreak = list(tiebreak) if tiebreak is not None else None
        self.partition_col = partition_col
        self.partition_expr = partition_expr
        self.quarantine = quarantine or f"{self.target}_quarantine"
        self.prepare = prepare
        self.staging = f"{self.target}/_staging"

    def __call__(self, batch: DataFrame, batch_id: int) -> list:
        """Upsert one micro-batch; returns the partition values it touched."""
        spark = batch.sparkSession
        left = self._left_stages(spark)
        stage = f"{self.staging}/{uuid.uuid4().hex}"
        touched = self._stage(spark, batch, stage, batch_id, left)
        if touched:
            self._swap(spark, stage)
        for done in (*left, stage):
            delete_path(spark, done)
        return touched

    def _left_stages(self, spark: SparkSession) -> list[str]:
        """Complete stages of calls that did not finish (incomplete and swapped ones are deleted)."""
        found = list_folders(spark, self.staging)
        complete = [p for p in found if path_exists(spark, f"{p}/_SUCCESS") and any_match(spark, f"{p}/[!_.]*")]
        for path in found:
            if path not in complete:
                delete_path(spark, path)
        return complete

    def _stage(self, spark: SparkSession, batch: DataFrame, stage: str, batch_id: int = 0, left: Sequence[str] = ()) -> list:
        rows = _typed(batch if self.prepare is None else self.prepare(batch))
        if self.partition_expr is not None:
            rows = rows.withColumn(self.partition_col, self.partition_expr)
        null_key = F.lit(False)
        for k in self.keys:
            null_key = null_key | F.col(k).isNull()
        rows = rows.persist()  # the batch is read by the check, the quarantine and the merge
        try:
            if rows.filter(null_key).limit(1).count():
                # one folder per batch id, overwritten on replay: quarantined rows never double
                rows.filter(null_key).write.mode("overwrite").parquet(f"{self.quarantine}/batch_id={batch_id}")
            merged = rows.filter(~null_key)
            for path in left:
                merged = merged.unionByName(spark.read.parquet(path), allowMissingColumns=True)
            # partition values: a set bounded by the calendar
            touched = [r[0] for r in merged.select(self.partition_col).distinct().collect()]
            if not touched:
                return []
            stored = read_partitions(spark, self.target, self.partition_col, touched)
            if stored is not None:
                # by name, so a column added by a later extract is null on older stored rows
                merged = merged.unionByName(stored, allowMissingColumns=True)
            newest = latest_per_key(merged, self.keys, self.order, self.tiebreak)
            newest.write.mode("overwrite").option("compression", "zstd").partitionBy(self.partition_col).parquet(stage)
            return touched
        finally:
            rows.unpersist()

    def _swap(self, spark: SparkSession, stage: str) -> None:
        ensure_folder(spark, self.target)
        for folder in list_folders(spark, stage):
            name = folder.rsplit("/", 1)[1]
            if name.startswith(f"{self.partition_col}="):
                delete_path(spark, f"{self.target}/{name}")
                move_path(spark, folder, f"{self.target}/{name}")


def read_current(spark: SparkSession, target: str) -> DataFrame:
    """The upserted table (its ``_staging`` folder is hidden from the file index); schemas
    of all partitions merged, as columns may have been added over time."""
    return spark.read.option("mergeSchema", "true").parquet(target)
