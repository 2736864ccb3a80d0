"""The medallion pipeline as plain Structured Streaming and batch jobs over files.

Each table hop is one query with its own checkpoint, run with ``trigger(availableNow=True)``
(triggered, non-continuous: a scheduler starts ``run_pipeline`` a few times a day), in
topological order:

    landing JSON ─► landing_new_unit_sales_json ─► bronze_new_unit_sales_line_items ─┐
    landing CSV  ─► bronze_oracle_sales_line_items ──────────────────────────────────┴► [union by name] bronze_sales_line_items_unified
    bronze unified ─► [foreachBatch] silver_sales_line_items_deduped (SCD1 upsert)
                                     └► silver_sales_line_items_business (touched partitions)
                                     └► silver_sales_line_items_changes (changed lines, append-only)
    silver changes ─► [stream-static joins] ─► [foreachBatch] analytics_sales_transactional (SCD1 upsert)
    landing energy CSV ─► bronze_energy_meter_readings ─► [foreachBatch] silver_energy_15_minute_cost
    master parquet ─► bronze_master_files/{entity} (one stream per entity) ─► dims (batch overwrite)
    silver ─► gold tables (batch overwrite)

Parquet has no change feed, so the keyed Silver table writes its own: the current version of every
line that a micro-batch brought, one folder per batch. Streams read that feed, not the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from quarterdeck.operators import dims, products, quality
from quarterdeck.operators.dedupe import latest_master_snapshot
from quarterdeck.operators.rules import apply_sales_business_rules, standardise_sales_columns
from quarterdeck.schemas import MASTER_KEYS, MASTER_SCHEMAS, SALES_JSON, SALES_RAW
from quarterdeck.sources import files, tables
from quarterdeck.streaming.upsert import Scd1Upsert, any_match, ensure_folder, path_exists, read_current, read_partitions

PARTITION = "business_date"
UNIFIED = "bronze_sales_line_items_unified"
BUSINESS, CHANGES = "silver_sales_line_items_business", "silver_sales_line_items_changes"
ANALYTICS = "analytics_sales_transactional"
DB_ROUTE, JSON_ROUTE = "bronze_oracle_sales_line_items", "bronze_new_unit_sales_line_items"
CHANGE_BATCH = "_change_batch"


@dataclass(frozen=True)
class LakeLayout:
    """Where the pipeline reads and writes (all on shared storage)."""

    landing: str  # {landing}/sales_line_items/*.csv, {landing}/energy_meter_readings/*.csv
    new_unit_json: str  # JSON-lines files of newly onboarded units
    master: str  # {master}/{folder}/{entity}/{entity}_{stamp}/ parquet loads
    lake: str  # output tables
    checkpoints: str
    max_files_per_trigger: int | None = None
    # Partition grain of the keyed sales tables: "day" (business_date) at production volume;
    # "month" (derived from business_date, so keys still never move) for sparse history.
    date_grain: str = "day"

    def partitioning(self):
        if self.date_grain == "day":
            return PARTITION, None
        if self.date_grain == "month":
            return "business_month", F.trunc(F.col(PARTITION), "month")
        raise ValueError(f"unknown date_grain {self.date_grain!r}")

    def table(self, name: str) -> str:
        return f"{self.lake.rstrip('/')}/{name}"

    def ckpt(self, name: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{name}"


def _append(df: DataFrame, layout: LakeLayout, name: str, partition_by: list[str] | None = None) -> StreamingQuery:
    w = (
        df.writeStream.format("parquet")
        .outputMode(tables.batch_mode(name))
        .option("checkpointLocation", layout.ckpt(name))
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(layout.table(name))


# observed expectation metrics of the last run, per metric name (summed over micro-batches)
EXPECTATION_LOG: dict[str, dict[str, int]] = {}


def _await(q: StreamingQuery) -> int:
    """Waits for a triggered query; returns the rows it read and logs its expectations."""
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")
    seen = {str(p.batchId): p for p in q.recentProgress}
    for progress in seen.values():
        for metric, values in (progress.observedMetrics or {}).items():
            total = EXPECTATION_LOG.setdefault(metric, {})
            for k, v in values.asDict().items():
                total[k] = total.get(k, 0) + int(v or 0)
    return sum(int(p.numInputRows or 0) for p in seen.values())


def _read_stream_table(spark: SparkSession, layout: LakeLayout, name: str, schema: StructType | None = None) -> DataFrame:
    path = layout.table(name)
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if layout.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", layout.max_files_per_trigger)
    return reader.parquet(path)


# ------------------------------------------------------------------------ bronze hops


def bronze_schema(delivered: StructType) -> StructType:
    """A route's Bronze columns: those delivered and the ingestion metadata."""
    return StructType([*delivered.fields, StructField("_ingested_at", TimestampType()), StructField("_source_file", StringType()), StructField("_source_ingestion_route", StringType())])


def run_bronze(spark: SparkSession, layout: LakeLayout) -> bool:
    """Lands everything new; tells whether new master files came."""
    new_masters = False
    mf = layout.max_files_per_trigger
    landing = layout.landing.rstrip("/")
    if path_exists(spark, layout.new_unit_json):
        raw_json = files.read_new_unit_json(spark, layout.new_unit_json, streaming=True, max_files=mf)
        flagged = quality.with_dq_flags(raw_json, quality.LANDING_JSON_RULES)
        flagged = quality.observe_expectations(flagged, quality.LANDING_JSON_RULES, "dq_landing_new_unit_sales_json")
        _await(_append(flagged, layout, "landing_new_unit_sales_json"))
        std = standardise_sales_columns(_read_stream_table(spark, layout, "landing_new_unit_sales_json"))
        _await(_append(std, layout, "bronze_new_unit_sales_line_items"))
    if path_exists(spark, f"{landing}/sales_line_items"):
        raw_csv = files.read_sales_csv(spark, f"{landing}/sales_line_items", streaming=True, max_files=mf)
        flagged = quality.with_dq_flags(raw_csv, quality.BRONZE_SALES_RULES)
        flagged = quality.observe_expectations(flagged, quality.BRONZE_SALES_RULES, "dq_bronze_oracle_sales_line_items")
        _await(_append(flagged, layout, "bronze_oracle_sales_line_items"))
    if path_exists(spark, layout.table(DB_ROUTE)) or path_exists(spark, layout.table(JSON_ROUTE)):
        # One stream over both routes. A route that delivers nothing yet is an empty folder, so the
        # checkpoint knows both from the first run.
        streams = []
        for name, schema in ((DB_ROUTE, SALES_RAW), (JSON_ROUTE, SALES_JSON)):
            ensure_folder(spark, layout.table(name))
            streams.append(_read_stream_table(spark, layout, name, bronze_schema(schema)))
        _await(_append(files.unified_sales(*streams), layout, UNIFIED))
    if path_exists(spark, layout.master):
        for entity in MASTER_KEYS:
            if any_match(spark, f"{layout.master.rstrip('/')}/*/{entity}/{entity}_*"):  # else not delivered yet
                master = files.read_master_parquet(spark, layout.master, entity, streaming=True, max_files=mf)
                new_masters |= _await(_append(master, layout, f"bronze_master_files/{entity}")) > 0
    if path_exists(spark, f"{landing}/energy_meter_readings"):
        energy = files.read_energy_csv(spark, f"{landing}/energy_meter_readings", streaming=True, max_files=mf)
        energy = quality.with_dq_flags(
            energy.withColumn("estimated_running_cost", F.col("estimated_running_cost").try_cast("double")),
            quality.BRONZE_ENERGY_RULES,
        ).withColumn("reading_date", F.to_date(F.try_to_timestamp("quarter_hour_start_ts")))
        energy = quality.observe_expectations(energy, quality.BRONZE_ENERGY_RULES, "dq_bronze_energy_meter_readings")
        _await(_append(energy, layout, "bronze_energy_meter_readings", ["reading_date"]))
    return new_masters


# ------------------------------------------------------------------------ silver hops


class SilverSalesUpsert(Scd1Upsert):
    """SCD1 upsert of deduplicated lines, then the Silver business rows of the same touched dates
    and the change feed: the current version of every line that the batch brought."""

    def __init__(self, layout: LakeLayout, tiebreak=None) -> None:
        col, expr = layout.partitioning()
        super().__init__(
            layout.table("silver_sales_line_items_deduped"),
            tiebreak=tiebreak,
            partition_col=col,
            partition_expr=expr,
        )
        self.layout = layout

    def __call__(self, batch: DataFrame, batch_id: int) -> list:
        spark = batch.sparkSession
        pc = self.partition_col
        touched = super().__call__(batch, batch_id)
        if not touched:
            return touched
        deduped = read_partitions(spark, self.target, pc, touched)
        business = deduped.transform(apply_sales_business_rules)
        _overwrite_partitions(business, self.layout.table(BUSINESS), pc)
        keys = batch.select(*self.keys).distinct()
        changed = read_partitions(spark, self.layout.table(BUSINESS), pc, touched).join(keys, self.keys, "left_semi")
        # one folder per batch id, overwritten on replay: a replayed batch is not fed twice
        derived = [] if self.partition_expr is None else [pc]
        changed.drop(*derived).write.mode("overwrite").parquet(f"{self.layout.table(CHANGES)}/{CHANGE_BATCH}={batch_id}")
        return touched


def current_dimensions(spark: SparkSession, layout: LakeLayout) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Unit, product and plan dimensions; one that was not delivered yet is empty, so its columns
    stay null until it comes."""

    def dim(name: str, schema: str) -> DataFrame:
        path = layout.table(name)
        return spark.read.parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)

    return (
        dim("silver_dim_unit", "country_code string, location_id string, unit_id string, unit_name string"),
        dim("silver_dim_product", "product_id string, product_name string, product_category string"),
        dim("silver_daily_budget_forecast", "business_date date, unit_id string, daily_budget_net_sales double, forecast_net_sales double"),
    )


def run_analytics(spark: SparkSession, layout: LakeLayout) -> None:
    """The line-level analytics table: changed Silver lines, joined to the current dimensions in the
    stream, upserted by key. Of equal versions the later change wins."""
    if not path_exists(spark, layout.table(CHANGES)):
        return
    changes = _read_stream_table(spark, layout, CHANGES)
    joined = products.transactional_from_silver(changes, *current_dimensions(spark, layout), with_versions=True, keep=(CHANGE_BATCH,))
    col, expr = layout.partitioning()
    upsert = Scd1Upsert(layout.table(ANALYTICS), tiebreak=[CHANGE_BATCH], partition_col=col, partition_expr=expr)
    q = (
        joined.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", layout.ckpt(ANALYTICS))
        .trigger(availableNow=True)
        .start()
    )
    _await(q)


def refresh_analytics(spark: SparkSession, layout: LakeLayout) -> None:
    """Recomputes the analytics table of all Silver lines, after new or changed dimensions."""
    if not path_exists(spark, layout.table(BUSINESS)):
        return
    col, expr = layout.partitioning()
    lines = read_current(spark, layout.table(BUSINESS)).withColumn(CHANGE_BATCH, F.lit(None).cast("int"))
    rows = products.transactional_from_silver(lines, *current_dimensions(spark, layout), with_versions=True, keep=(CHANGE_BATCH,))
    _overwrite_partitions(rows if expr is None else rows.withColumn(col, expr), layout.table(ANALYTICS), col)


def _overwrite_partitions(df: DataFrame, path: str, partition_col: str = PARTITION) -> None:
    """Replace only the partitions present in ``df``; REBALANCE lets AQE size the files
    (small partitions coalesced, a hot date split over several writers)."""
    (
        df.hint("rebalance", partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def run_silver_sales(spark: SparkSession, layout: LakeLayout, tiebreak=None) -> None:
    if not path_exists(spark, layout.table(UNIFIED)):
        return
    src = _read_stream_table(spark, layout, UNIFIED)
    q = (
        src.writeStream.foreachBatch(SilverSalesUpsert(layout, tiebreak))
        .option("checkpointLocation", layout.ckpt("silver_sales_line_items_deduped"))
        .trigger(availableNow=True)
        .start()
    )
    _await(q)


def run_silver_energy(spark: SparkSession, layout: LakeLayout) -> None:
    """Energy cost per 15 minutes: each batch recomputes its reading dates from all Bronze
    readings of those dates (no streaming state; late readings are counted)."""
    bronze_path = layout.table("bronze_energy_meter_readings")
    if not path_exists(spark, bronze_path):
        return
    target = layout.table("silver_energy_15_minute_cost")

    def recompute(batch: DataFrame, batch_id: int) -> None:
        # a reading without a readable time has no bucket: kept aside, never dropped silently
        unread = batch.filter(F.col("reading_date").isNull())
        if unread.limit(1).count():
            unread.write.mode("overwrite").parquet(f"{target}_quarantine/batch_id={batch_id}")
        touched = [r[0] for r in batch.filter(F.col("reading_date").isNotNull()).select("reading_date").distinct().collect()]
        if not touched:
            return
        readings = spark.read.parquet(bronze_path).filter(F.col("reading_date").isin(touched))
        cost = dims.energy_15_minute_cost(readings).withColumn(
            "reading_date", F.to_date("quarter_hour_start_ts")
        )
        (
            cost.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("reading_date")
            .parquet(target)
        )

    q = (
        _read_stream_table(spark, layout, "bronze_energy_meter_readings")
        .writeStream.foreachBatch(recompute)
        .option("checkpointLocation", layout.ckpt("silver_energy_15_minute_cost"))
        .trigger(availableNow=True)
        .start()
    )
    _await(q)


# ------------------------------------------------------------------------ dims and gold


def master_entity(spark: SparkSession, layout: LakeLayout, entity: str) -> DataFrame | None:
    """Newest load of one master entity from its Bronze table (every load is kept there as
    evidence; the load stamp travels with the rows)."""
    path = layout.table(f"bronze_master_files/{entity}")
    if not path_exists(spark, path):
        return None
    return latest_master_snapshot(spark.read.parquet(path), MASTER_KEYS[entity])


def run_dims(spark: SparkSession, layout: LakeLayout) -> None:
    get = lambda e: master_entity(spark, layout, e)
    unit, override = get("unit"), get("unitmappingoverride")
    if unit is not None:
        override = override if override is not None else spark.createDataFrame([], "unit_id string, corrected_unit_name string")
        tables.write_table(dims.dim_unit(unit, override), layout.lake, "silver_dim_unit")
    product = get("product")
    if product is not None:
        corr = get("producthierarchycorrections")
        excl = get("productexclusions")
        corr = corr if corr is not None else spark.createDataFrame([], "product_id string, corrected_category string")
        excl = excl if excl is not None else spark.createDataFrame([], "product_id string, is_active boolean")
        tables.write_table(dims.dim_product(product, corr, excl), layout.lake, "silver_dim_product")
    budget, forecast = get("dailybudget"), get("forecast")
    if budget is not None or forecast is not None:
        if budget is None:
            budget = spark.createDataFrame([], MASTER_SCHEMAS["dailybudget"])
        if forecast is None:
            forecast = spark.createDataFrame([], MASTER_SCHEMAS["forecast"])
        tables.write_table(dims.daily_budget_forecast(budget, forecast), layout.lake, "silver_daily_budget_forecast")


def run_gold(spark: SparkSession, layout: LakeLayout) -> None:
    silver_path = layout.table("silver_sales_line_items_business")
    if not path_exists(spark, silver_path):
        return
    silver = read_current(spark, silver_path)
    tables.write_table(products.discount_strategy(silver), layout.lake, "gold_discount_strategy")
    energy_path = layout.table("silver_energy_15_minute_cost")
    if path_exists(spark, energy_path):
        energy = spark.read.parquet(energy_path)
        gold = products.unit_15_min_profitability(silver, energy)
        col, expr = layout.partitioning()
        gold = gold if expr is None else gold.withColumn(col, expr)
        tables.write_table(gold.hint("rebalance", col), layout.lake, "gold_unit_quarter_hour_sales", [col])


def run_pipeline(spark: SparkSession, layout: LakeLayout, tiebreak=None) -> None:
    """One triggered run of the whole graph (idempotent: a rerun without new files changes
    nothing, a replayed micro-batch gives the same rows)."""
    EXPECTATION_LOG.clear()
    # a triggered run ends; keep the progress of all its micro-batches until it is counted
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(2**31 - 1))
    new_masters = run_bronze(spark, layout)
    run_dims(spark, layout)
    if new_masters:  # lines of earlier runs get the new dimensions
        refresh_analytics(spark, layout)
    run_silver_sales(spark, layout, tiebreak)
    run_analytics(spark, layout)
    run_silver_energy(spark, layout)
    run_gold(spark, layout)
