"""File sources for sales, energy and master data — batch and Structured Streaming.

Schemas are explicit. Streaming readers use the file source: its checkpoint records which
files were processed, so each landed file is read once across runs; ``max_files`` bounds a
micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarterdeck.operators.rules import standardise_sales_columns, with_ingestion_metadata
from quarterdeck.schemas import ENERGY_RAW, MASTER_SCHEMAS, SALES_JSON, SALES_RAW
from quarterdeck.sources.adapter import ROUTE_DB, ROUTE_JSON

# Times in JSON lines, with microseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _reader(spark: SparkSession, streaming: bool, max_files: int | None):
    r = spark.readStream if streaming else spark.read
    if streaming and max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r


def read_sales_csv(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """POS extracts (CSV with header) landed by the database copy; a header that is not the
    contract's, in its order, fails the read instead of filling wrong columns."""
    df = _reader(spark, streaming, max_files).schema(SALES_RAW).option("header", True).option("enforceSchema", False).csv(path)
    return with_ingestion_metadata(df, ROUTE_DB)


def read_new_unit_json(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """JSON-lines sales files shared by newly onboarded units."""
    df = _reader(spark, streaming, max_files).schema(SALES_JSON).json(path)
    return with_ingestion_metadata(df, ROUTE_JSON)


def read_energy_csv(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    df = _reader(spark, streaming, max_files).schema(ENERGY_RAW).option("header", True).option("enforceSchema", False).csv(path)
    return with_ingestion_metadata(df)


def read_master_parquet(
    spark: SparkSession, base: str, entity: str, streaming: bool = False, max_files: int | None = None
) -> DataFrame:
    path = f"{base.rstrip('/')}/*/{entity}/{entity}_*"
    df = _reader(spark, streaming, max_files).schema(MASTER_SCHEMAS[entity]).parquet(path)
    return with_ingestion_metadata(df).withColumns(
        {
            "entity_name": F.lit(entity),
            "_file_stamp": F.regexp_extract(F.col("_metadata.file_path"), rf"/{entity}_(\d{{14}})/", 1),
        }
    )


def unified_sales(db_rows: DataFrame, json_rows: DataFrame) -> DataFrame:
    """Both routes in one Bronze table: JSON rows standardised to the contract, then a
    union by name (columns a route lacks are null). Works for batch and for two streams."""
    return db_rows.unionByName(standardise_sales_columns(json_rows), allowMissingColumns=True)


CORRUPT = "_corrupt_record"


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row and line; null fields are left out, times keep their microseconds."""
    df.write.mode("overwrite").options(**JSON_TIMES).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """JSON lines under a typed schema; a line that does not parse stands in ``_corrupt_record``."""
    typed = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return _reader(spark, streaming, max_files).schema(typed).options(columnNameOfCorruptRecord=CORRUPT, mode="PERMISSIVE", **JSON_TIMES).json(path)


def split_corrupt(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parsed rows under the schema, texts of the lines that did not parse)."""
    corrupt = F.col(CORRUPT).isNotNull()
    return lines.where(~corrupt).drop(CORRUPT), lines.where(corrupt).select(CORRUPT)
