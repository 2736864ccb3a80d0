"""Replay Bronze sales through the streaming upsert, as several micro-batches.

Bronze rows are landed as parquet files spread over three folders (by day of the update
time, so versions of one key arrive in different, unordered batches — including older
versions after newer ones), then a file-source stream with ``availableNow`` feeds them to
``Scd1Upsert`` a few files at a time. The result must equal batch deduplication.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarterdeck.operators import products
from quarterdeck.operators.dedupe import dedupe_reposted_sales_lines
from quarterdeck.operators.rules import apply_sales_business_rules
from quarterdeck.session import scratch_path, settings, shuffle_files_removed
from quarterdeck.sources.adapter import sent_along
from quarterdeck.streaming.upsert import Scd1Upsert, delete_path, read_current

REPLAY_BATCHES = 3

# Settings of tables that a job writes for itself: ids, times and amounts are nearly all different, so
# dictionaries cost more time than they save space, and buckets of one file are read in their order.
OWN_TABLES = {
    "parquet.enable.dictionary": "false",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}
# Columns that the business rules read beside those of the answer.
RULE_COLUMNS = ["quantity", "is_priced_product", "is_kitchen_instruction"]


def replay_lines_to_analytics(
    spark: SparkSession,
    lines: DataFrame,
    dimensions: tuple[DataFrame, DataFrame, DataFrame],
    tiebreak: Sequence[str] | None = None,
    batches: int = REPLAY_BATCHES,
) -> DataFrame:
    """Line-level analytics (25 columns) from a stream of sales lines.

    The lines are landed and read as a stream of several micro-batches; the business rules and the
    left joins with the three dimensions are part of the streaming query, which appends every
    version of a line with its dimension columns. The current version of each line is the answer.

    The dimensions are written once and read by every micro-batch; the unit dimension is sent along
    if it is small enough, the plan lies in buckets sorted by its key, so that a micro-batch neither
    shuffles nor sorts it. Only what the rules and the answer read is landed. Landing and dimensions
    go when the stream has ended, and shuffle files when the query that wrote them has.
    """
    root = scratch_path(spark, "analytics_replay")
    landing, log = f"{root}/landing", f"{root}/log"
    unit, product, plan = dimensions
    with shuffle_files_removed(spark), settings(spark, OWN_TABLES):
        unit = _written(spark, unit.select(*products.UNIT_COLUMNS), f"{root}/dimensions/unit")
        product = _written(spark, product.select(*products.PRODUCT_COLUMNS), f"{root}/dimensions/product")
        lines.select(*_landed(lines, tiebreak)).write.option("compression", "zstd").parquet(landing)
        with _bucketed(spark, plan.select(*products.PLAN_COLUMNS), products.PLAN_KEY, f"{root}/dimensions/plan") as plan:
            schema = _stream_lines(spark, root, (sent_along(unit), product, plan), tiebreak, batches)
    for done in (landing, f"{root}/dimensions"):
        delete_path(spark, done)
    versions = spark.read.schema(schema).parquet(log)
    return dedupe_reposted_sales_lines(versions, tiebreak=tiebreak).drop(*_extra(tiebreak))


def _extra(tiebreak: Sequence[str] | None) -> list[str]:
    return [c for c in tiebreak or () if c not in products.TRANSACTIONAL_COLUMNS]


def _landed(lines: DataFrame, tiebreak: Sequence[str] | None) -> list[str]:
    """The columns of the lines that the rules, the version order and the answer read."""
    read = {*products.TRANSACTIONAL_COLUMNS, *products.TRANSACTIONAL_STREAM_EXTRA, *RULE_COLUMNS, *_extra(tiebreak)}
    return [c for c in lines.columns if c in read and c not in products.NAMES_ON_LINES]


def _stream_lines(spark: SparkSession, root: str, dimensions: tuple[DataFrame, DataFrame, DataFrame], tiebreak: Sequence[str] | None, batches: int) -> StructType:
    """The streaming query from the landing folder into the log; returns the log's schema."""
    landing, log = f"{root}/landing", f"{root}/log"
    per_trigger = max(1, math.ceil(_count_files(spark, landing) / batches))
    stream = spark.readStream.schema(spark.read.parquet(landing).schema).option("maxFilesPerTrigger", per_trigger).parquet(landing)
    joined = products.transactional_from_silver(stream.transform(apply_sales_business_rules), *dimensions, with_versions=True, keep=_extra(tiebreak))
    query = (
        joined.writeStream.outputMode("append").format("parquet").option("compression", "zstd")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(log)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"analytics stream failed: {query.exception()}")
    return joined.schema


def _written(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _bucketed(spark: SparkSession, df: DataFrame, keys: Sequence[str], path: str) -> Iterator[DataFrame]:
    """The rows written in one sorted file per shuffle partition of their keys, where a join on these
    takes them as they lie. Buckets need a table in the catalog; it goes with the block, the files stay.

    Rows that come out of a join on the keys are in that partitioning and order already, as long
    as small partitions are not put together.
    """
    table = f"quarterdeck_replay_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path)
    try:
        with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def _count_files(spark: SparkSession, path: str) -> int:
    return len(spark.read.parquet(path).inputFiles())


def replay_sales_as_stream(
    spark: SparkSession,
    bronze: DataFrame,
    tiebreak: Sequence[str] | None = None,
    batches: int = REPLAY_BATCHES,
) -> DataFrame:
    root = scratch_path(spark, "scd1_replay")
    landing, target, ckpt = f"{root}/landing", f"{root}/target", f"{root}/checkpoint"
    (
        bronze.withColumn("arrival_group", F.dayofmonth("source_update_ts") % F.lit(batches))
        .write.mode("overwrite").option("compression", "zstd")
        .partitionBy("arrival_group")
        .parquet(landing)
    )
    schema = spark.read.parquet(landing).schema
    per_trigger = max(1, math.ceil(_count_files(spark, landing) / batches))
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(landing)
        .drop("arrival_group")
    )
    # A few rows per business date here: month partitions (a function of the key) keep the
    # number of partition folders proportional to the data, not to the calendar.
    upsert = Scd1Upsert(
        target,
        tiebreak=tiebreak,
        partition_col="business_month",
        partition_expr=F.trunc(F.col("business_date"), "month"),
    )
    with shuffle_files_removed(spark):
        query = (
            stream.writeStream.foreachBatch(upsert)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"replay stream failed: {query.exception()}")
    delete_path(spark, landing)
    return read_current(spark, target).drop("business_month")
