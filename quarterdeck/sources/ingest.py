"""Control-table-driven batch ingestion into the landing area.

A control row names a source object, its load pattern (``full`` / ``incremental``), the
watermark column and last value, and the landing folder. For every active row of a run
group an extract job runs (up to 8 at a time, each its own Spark job from a driver thread,
the control table itself being a handful of rows). Rows read are counted with an
``Observation`` on the source side, rows written by reading the landed files back, and one audit
row is appended whatever the outcome. A load whose counts differ has status ``Incomplete``.
The watermark advances only after a complete load, and never on an empty extract.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from quarterdeck.functions.paths import build_target_path
from quarterdeck.schemas import INGESTION_CONTROL, MASTER_SCHEMAS, RUN_AUDIT
from quarterdeck.sources.control import active_control_rows

WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_PARALLELISM = 8
# CSV landing files: a header, times with their microseconds, quoted values over line ends.
CSV_FORMAT = {
    "header": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
STATUS_OK = "Succeeded"
STATUS_FAILED = "Failed"
STATUS_INCOMPLETE = "Incomplete"  # landed rows differ from the rows read


def incremental_extract(df: DataFrame, watermark_column: str | None, last_value: str | None) -> DataFrame:
    """Rows strictly newer than the last watermark (pushed down to the scan); the whole
    object when there is no watermark (full load or first run)."""
    if not watermark_column or last_value in (None, ""):
        return df
    dtype = df.schema[watermark_column].dataType
    # the literal takes the column's own type, so the comparison reaches the scan as a filter
    return df.filter(F.col(watermark_column) > F.lit(last_value).cast(dtype))


def watermark_text(df: DataFrame, watermark_column: str) -> Column:
    """The largest value of a watermark column as text, in one format for any zone and type."""
    largest = F.max(watermark_column)
    kind = df.schema[watermark_column].dataType.typeName()
    return F.date_format(largest, WATERMARK_FORMAT) if kind in ("timestamp", "timestamp_ntz", "date") else largest.cast("string")


def advance_watermark(extract: DataFrame, watermark_column: str, previous: str | None) -> DataFrame:
    """One row: previous / new watermark and the extract size. Empty extract keeps the old
    value."""
    return extract.agg(
        F.count(F.lit(1)).alias("rows_extracted"),
        watermark_text(extract, watermark_column).alias("__max"),
    ).select(
        F.lit(previous).cast("string").alias("previous_watermark"),
        F.coalesce("__max", F.lit(previous).cast("string")).alias("new_watermark"),
        "rows_extracted",
    )


def landing_path(base: str, folder: str, extract_date: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{folder}/extract_date={extract_date}/run_id={run_id}"


def land_by_day(df: DataFrame, base: str, folder: str, day: Column, run_id: str) -> str:
    """Lands one run's rows of an object in Hive-style folders by extract date; returns the object's folder."""
    path = f"{base.rstrip('/')}/{folder}"
    rows = df.withColumns({"extract_date": day.cast("date"), "run_id": F.lit(run_id)})
    rows.write.mode("append").options(**CSV_FORMAT).partitionBy("extract_date", "run_id").csv(path)
    return path


def read_landing(
    spark: SparkSession, base: str, folder: str, schema, extract_date: str | None = None, run_id: str | None = None
) -> DataFrame:
    """Landing CSV of one object; Hive-style ``extract_date`` / ``run_id`` folders are
    discovered as columns, so a filter on them prunes folders before any file is opened."""
    typed = StructType([*schema.fields, StructField("extract_date", DateType()), StructField("run_id", StringType())])
    df = spark.read.schema(typed).options(**CSV_FORMAT, multiLine=True).csv(f"{base.rstrip('/')}/{folder}")
    if extract_date is not None:
        df = df.filter(F.col("extract_date") == F.lit(extract_date).cast("date"))
    return df if run_id is None else df.filter(F.col("run_id") == run_id)


SourceReader = Callable[[SparkSession, Row], DataFrame]


def read_landed_load(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of one load folder as they were landed (quoted values may hold line ends)."""
    return spark.read.schema(schema).options(**CSV_FORMAT, multiLine=True).csv(path)


def _extract_one(spark, row: Row, reader: SourceReader, landing_base: str, run_id: str, trigger: dt.datetime):
    obs = Observation(f"extract_{row['ingestion_id']}_{uuid.uuid4().hex[:8]}")
    previous = row["last_watermark_value"]
    wm_col = row["watermark_column"] if row["load_pattern"] == "incremental" else None
    try:
        extract = incremental_extract(reader(spark, row), wm_col, previous)
        measured = extract.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            *([watermark_text(extract, wm_col).alias("max_wm")] if wm_col else []),
        )
        path = landing_path(landing_base, row["target_folder"], trigger.strftime("%Y-%m-%d"), run_id)
        measured.write.mode("overwrite").options(**CSV_FORMAT).csv(path)
        stats = obs.get
        rows = int(stats.get("rows", 0))
        written = read_landed_load(spark, path, extract.schema).count()
        if written != rows:
            return (row["ingestion_id"], rows, written, STATUS_INCOMPLETE, previous, previous, f"{rows} rows read, {written} rows landed")
        new_wm = previous
        if wm_col and rows > 0 and stats.get("max_wm") is not None:
            new_wm = stats["max_wm"]
        return (row["ingestion_id"], rows, written, STATUS_OK, previous, new_wm, None)
    except Exception as exc:  # the audit row records the failure; other objects go on
        return (row["ingestion_id"], None, None, STATUS_FAILED, previous, previous, str(exc))


def run_ingestion(
    spark: SparkSession,
    control: DataFrame,
    reader: SourceReader,
    landing_base: str,
    run_group: str | None = None,
    parallelism: int = DEFAULT_PARALLELISM,
    run_id: str | None = None,
    trigger_time: dt.datetime | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Extract every active object of ``run_group``; returns (audit rows, updated control).

    The control table is tiny configuration (one row per source object), so its rows are
    collected to drive the per-object jobs; no data row passes through the driver.
    """
    run_id = run_id or uuid.uuid4().hex
    trigger = trigger_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = active_control_rows(control, run_group).collect()
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(lambda r: _extract_one(spark, r, reader, landing_base, run_id, trigger), rows))
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    audit_rows = [
        (0, ing, run_id, trigger, rr, rw, st, pw, nw, err, now) for ing, rr, rw, st, pw, nw, err in results
    ]
    # an id of run and object: no run repeats another's
    audit = spark.createDataFrame(audit_rows, RUN_AUDIT).withColumn("audit_id", F.abs(F.xxhash64("pipeline_run_id", "ingestion_id")))
    new_wm = spark.createDataFrame(
        [(ing, nw) for ing, _, _, st, _, nw, _ in results if st == STATUS_OK],
        "ingestion_id long, __new_wm string",
    )
    updated = (
        control.join(new_wm, "ingestion_id", "left")
        .withColumn("last_watermark_value", F.coalesce("__new_wm", "last_watermark_value"))
        .withColumn(
            "updated_at_utc",
            F.when(F.col("__new_wm").isNotNull(), F.lit(now)).otherwise(F.col("updated_at_utc")),
        )
        .drop("__new_wm")
        .select(*INGESTION_CONTROL.fieldNames())
    )
    return audit, updated


def master_file_to_parquet(
    spark: SparkSession,
    source_path: str,
    target_base: str,
    folder: str,
    entity: str,
    stamp: str | None = None,
) -> str:
    """Copy one business master CSV into ``{base}/{folder}/{entity}/{entity}_{stamp}``.

    Each load lands in a new stamped folder (full loads accumulate; readers pick the newest
    with ``latest_master_snapshot``).
    """
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    entity_key = entity.replace(" ", "").lower()
    schema = MASTER_SCHEMAS.get(entity_key)
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(source_path) if schema is not None else reader.csv(source_path)
    path = spark.range(1).select(build_target_path(F.lit(target_base), F.lit(folder), F.lit(entity)).alias("path")).first()["path"]
    target = f"{path}/{entity_key}_{stamp}"
    df.write.mode("overwrite").parquet(target)
    return target


def read_master_entity(spark: SparkSession, base: str, entity: str, folder: str | None = None) -> DataFrame:
    """All loads of one master entity, with ``entity_name`` and the load stamp as columns.

    One glob per entity replaces filtering a mixed table by a column the files do not have.
    """
    schema = MASTER_SCHEMAS[entity]
    folder_glob = "*" if folder is None else folder
    path = f"{base.rstrip('/')}/{folder_glob}/{entity}/{entity}_*"
    df = spark.read.schema(schema).parquet(path)
    return df.withColumns(
        {
            "entity_name": F.lit(entity),
            "_file_stamp": F.regexp_extract(F.col("_metadata.file_path"), rf"/{entity}_(\d{{14}})/", 1),
            "_source_file": F.col("_metadata.file_path"),
            "_ingested_at": F.current_timestamp(),
        }
    )


def append_run_audit(audit: DataFrame, path: str) -> None:
    """Append one run's audit rows (success and failure alike) to the audit table."""
    audit.coalesce(1).write.mode("append").parquet(path)


def source_counts_from_audit(audit: DataFrame, control: DataFrame) -> DataFrame:
    """Rows the source reported per entity and run, for reconciliation against Bronze."""
    return audit.join(F.broadcast(control.select("ingestion_id", "target_entity")), "ingestion_id").select(
        "target_entity", "pipeline_run_id", F.col("rows_read").alias("source_rows")
    )


def run_master_ingestion(
    spark: SparkSession,
    master_control: DataFrame,
    source_base: str,
    target_base: str,
    stamp: str | None = None,
    parallelism: int = DEFAULT_PARALLELISM,
) -> DataFrame:
    """Copy every active business master file (one control row each) into
    ``{target_base}/{normalised folder}/{entity}/{entity}_{stamp}``.

    The control table is configuration (one row per master file); each copy is its own job.
    Returns one row per file: entity, target path, status, error.
    """
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    rows = active_control_rows(master_control).collect()

    def copy(row: Row):
        src = f"{source_base.rstrip('/')}/{row['source_file_name']}"
        try:
            folder = row["target_base_folder"] + "/" + row["source_folder_path"].rsplit("/", 1)[-1]
            path = master_file_to_parquet(spark, src, target_base, folder, row["entity_name"], stamp)
            return (row["entity_name"], path, STATUS_OK, None)
        except Exception as exc:
            return (row["entity_name"], None, STATUS_FAILED, str(exc))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(copy, rows))
    return spark.createDataFrame(results, "entity_name string, target_path string, status string, error_message string")
