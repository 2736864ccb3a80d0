"""Tables by the registry: writers take their mode from it, the catalog gets its properties.

``schemas.TABLES`` says of each table its layer, how it is written and what it holds. A table is
declared in Spark's catalog over the folder that the jobs write, with these as table properties, so
a user finds layer, mode and comment beside the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterdeck.schemas import TABLES

PROPERTIES = "table_name string, layer string, write_mode string, merge_pattern string, source_pattern string, comment string"
BATCH_MODES = ("append", "overwrite")


def entry(name: str) -> dict[str, str]:
    """The registry entry of a table; a folder below a table (``bronze_master_files/unit``) has its table's."""
    try:
        return TABLES[name.split("/")[0]]
    except KeyError:
        raise KeyError(f"{name} is not in the table registry") from None


def batch_mode(name: str) -> str:
    """``append`` or ``overwrite``; keyed tables are written by their stream alone."""
    mode = entry(name)["mode"]
    if mode not in BATCH_MODES:
        raise ValueError(f"{name} is written by {mode}, not by a batch writer")
    return mode


def write_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Writes a table's folder under ``root`` in the mode of the registry; returns the folder."""
    path = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode(batch_mode(name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def declare_table(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Declares the table over its folder, with its registry entry as properties (again: anew)."""
    known = entry(name)
    properties = ", ".join(f"{_text('quarterdeck.' + k)} = {_text(v)}" for k, v in known.items() if k != "comment")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION {_text(path)} COMMENT {_text(known['comment'])} TBLPROPERTIES ({properties})")


def declared_tables(spark: SparkSession, database: str) -> DataFrame:
    """Layer, mode, patterns and comment of every declared table, read back from the catalog."""
    rows = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:  # the session's views are listed with every database
            continue
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{database}`.`{table.name}`").collect()}
        get = lambda key: found.get(f"quarterdeck.{key}")  # noqa: E731, B023
        rows.append((table.name, get("layer"), get("mode"), get("merge_pattern"), get("source_pattern"), table.description))
    return spark.createDataFrame(rows, PROPERTIES)
