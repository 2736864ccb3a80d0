"""Stored schemas: what a source delivered first, how later deliveries drift, and what then happens.

The registry is a small Parquet table, one row for each version of a source's schema. The first
read of a source stores its schema; each later read is compared with the newest version and brought
to it by a rule. Work on rows (rescue, counts of affected rows) is one pass over the delivery.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarterdeck.streaming.upsert import path_exists

REGISTRY = "source string, version int, schema_json string, registered_at timestamp"
DRIFT = "column_name string, change string, stored_type string, found_type string"
RESCUED = "_rescued"
ADDED, MISSING, RETYPED = "added", "missing", "retyped"

# Rules: a drifted delivery fails; or new columns join the schema as a new version; or the schema
# stays and what does not fit is kept aside as JSON text.
STRICT, EVOLVE, RESCUE = "strict", "evolve", "rescue"


class SchemaDrift(ValueError):
    """A delivery does not have the stored schema."""


def stored_schema(spark: SparkSession, registry: str, source: str) -> tuple[int, StructType] | None:
    """Newest version and schema of a source, or None before its first read."""
    if not path_exists(spark, registry):
        return None
    rows = spark.read.schema(REGISTRY).parquet(registry).where(F.col("source") == source)
    newest = rows.orderBy(F.col("version").desc(), F.col("registered_at").desc()).limit(1).collect()
    return (newest[0]["version"], StructType.fromJson(json.loads(newest[0]["schema_json"]))) if newest else None


def store_schema(spark: SparkSession, registry: str, source: str, schema: StructType, version: int) -> None:
    row = spark.createDataFrame([(source, version, schema.json())], "source string, version int, schema_json string")
    row.withColumn("registered_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(registry)


def differences(stored: StructType, found: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, stored type, found type) of each drifted column, by name.

    Names compare without case, as Spark resolves them; nullability and order are no drift.
    """
    old, new = ({f.name.lower(): f for f in schema} for schema in (stored, found))
    out = [(f.name, MISSING, f.dataType.simpleString(), None) for k, f in old.items() if k not in new]
    out += [(f.name, ADDED, None, f.dataType.simpleString()) for k, f in new.items() if k not in old]
    out += [
        (f.name, RETYPED, f.dataType.simpleString(), new[k].dataType.simpleString())
        for k, f in old.items() if k in new and new[k].dataType.simpleString() != f.dataType.simpleString()
    ]
    return sorted(out)


def _unfit(field: StructField) -> Column:
    """Whether a value is there and does not read as the stored type."""
    return F.col(f"`{field.name}`").isNotNull() & F.col(f"`{field.name}`").try_cast(field.dataType).isNull()


def drift_report(delivery: DataFrame, stored: StructType) -> DataFrame:
    """The drift of a delivery with the number of its rows that each change touches.

    A missing column touches every row, an added one the rows that fill it, a retyped one the rows
    whose value does not read as the stored type. One aggregate over the delivery.
    """
    spark = delivery.sparkSession
    changes = differences(stored, delivery.schema)
    if not changes:
        return spark.createDataFrame([], DRIFT + ", rows_affected long")
    fields = {f.name.lower(): f for f in stored}
    touched = {
        MISSING: lambda name: F.lit(True),
        ADDED: lambda name: F.col(f"`{name}`").isNotNull(),
        RETYPED: lambda name: _unfit(fields[name.lower()]),
    }
    counted = delivery.agg(*[F.count_if(touched[change](name)).alias(f"c{i}") for i, (name, change, _, _) in enumerate(changes)])
    listed = F.array(*[
        F.struct(*[F.lit(v).cast("string").alias(k) for k, v in zip(("column_name", "change", "stored_type", "found_type"), row, strict=True)], F.col(f"c{i}").alias("rows_affected"))
        for i, row in enumerate(changes)
    ])
    return counted.select(F.explode(listed).alias("row")).select("row.*")


def conformed(delivery: DataFrame, schema: StructType, rescue: bool = True) -> DataFrame:
    """The delivery under ``schema``: columns by name, absent ones null, others read as their type.

    With ``rescue``, added columns and values that do not read as their type are kept as JSON text
    in ``_rescued`` (null where all fits).
    """
    found = {f.name.lower(): f for f in delivery.schema}
    out = []
    for field in schema:
        have = found.get(field.name.lower())
        value = F.lit(None) if have is None else F.col(f"`{have.name}`")
        same = have is not None and have.dataType == field.dataType
        out.append((value if same else value.try_cast(field.dataType)).alias(field.name))
    if not rescue:
        return delivery.select(*out)
    known = {f.name.lower(): f for f in schema}
    aside = []
    for key, field in found.items():
        value = F.col(f"`{field.name}`")
        if key not in known:
            aside.append(value.cast("string").alias(field.name))
        elif field.dataType != known[key].dataType:
            aside.append(F.when(_unfit(known[key]), value.cast("string")).alias(field.name))
    kept = F.lit(None).cast("string") if not aside else F.nullif(F.to_json(F.struct(*aside), {"ignoreNullFields": "true"}), F.lit("{}"))
    return delivery.select(*out, kept.alias(RESCUED))


def read_tracked(spark: SparkSession, registry: str, source: str, delivery: DataFrame, rule: str = EVOLVE) -> DataFrame:
    """A delivery under its source's stored schema; the first one stores it.

    ``strict`` raises :class:`SchemaDrift` on any change. ``evolve`` stores a new version with the
    added columns at the end; columns never leave and never change their type. ``rescue`` keeps the
    schema. What does not fit stands in ``_rescued``.
    """
    if rule not in (STRICT, EVOLVE, RESCUE):
        raise ValueError(f"unknown rule {rule!r}")
    known = stored_schema(spark, registry, source)
    if known is None:
        store_schema(spark, registry, source, delivery.schema, 1)
        return conformed(delivery, delivery.schema)
    version, schema = known
    changes = differences(schema, delivery.schema)
    if changes and rule == STRICT:
        raise SchemaDrift(f"{source}: " + ", ".join(f"{name} {change}" for name, change, _, _ in changes))
    added = {name for name, change, _, _ in changes if change == ADDED}
    if added and rule == EVOLVE:
        schema = StructType([*schema.fields, *[StructField(f.name, f.dataType) for f in delivery.schema if f.name in added]])
        store_schema(spark, registry, source, schema, version + 1)
    return conformed(delivery, schema)
