"""Declared, versioned event schemas and catalog-table management.

A schema is a ``VersionedSchema(version, struct)``.  Each ``StructField``
carries its logical type, default and description in the field metadata,
so the plain ``StructType`` is what DataFrames, readers and writers use.
Schema edits are pure functions returning a new schema; table changes are
Spark SQL DDL run through the session's catalog.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

# fixed values: logical types and their Spark types (LONG is an addition for
# sinks that store integers as 64-bit)
SPARK_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "integer": IntegerType(),
    "long": LongType(),
    "float": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "datetime": TimestampType(),
    "json": StringType(),
    "jsonb": StringType(),
}
JSON_TYPES = ("json", "jsonb")

# fixed values: logical type → column type in each target's SQL dialect
SQL_TYPES: dict[str, dict[str, str]] = {
    "clickhouse": {"string": "String", "integer": "Int64", "long": "Int64", "float": "Float64",
                   "boolean": "UInt8", "timestamp": "DateTime", "datetime": "DateTime",
                   "json": "String", "jsonb": "String"},
    "postgres": {"string": "VARCHAR(255)", "integer": "INTEGER", "long": "BIGINT", "float": "DOUBLE PRECISION",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "datetime": "TIMESTAMP",
                 "json": "JSONB", "jsonb": "JSONB"},
    "iceberg": {"string": "STRING", "integer": "BIGINT", "long": "BIGINT", "float": "DOUBLE",
                "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "datetime": "TIMESTAMP",
                "json": "STRING", "jsonb": "STRING"},
    "spark": {k: v.simpleString().upper() for k, v in SPARK_TYPES.items()},
}
TARGETS = tuple(SQL_TYPES)
VERSION_PROPERTY = "quayside.schema.version"


@dataclass(frozen=True)
class VersionedSchema:
    version: int
    struct: StructType

    @property
    def names(self) -> list[str]:
        return self.struct.fieldNames()


def field(name: str, logical: str, nullable: bool = True, default: str | None = None,
          description: str | None = None) -> StructField:
    """One declared field.  Unknown logical types are an error."""
    key = logical.lower()
    if key not in SPARK_TYPES:
        raise ValueError(f"unknown logical type {logical!r} for field {name!r}")
    meta = {"logical_type": key}
    if default is not None:
        meta["default"] = default
    if description is not None:
        meta["description"] = description
    return StructField(name, SPARK_TYPES[key], nullable, meta)


def logical_type(f: StructField) -> str:
    return (f.metadata or {}).get("logical_type") or _logical_from_spark(f.dataType)


def _logical_from_spark(dtype: DataType) -> str:
    for k, v in SPARK_TYPES.items():
        if v == dtype and k not in ("datetime", "json", "jsonb"):
            return k
    raise ValueError(f"no logical type for Spark type {dtype.simpleString()}")


def declared_default_sql(f: StructField) -> str | None:
    """Declared default as SQL; ``CURRENT_TIMESTAMP`` is the batch time."""
    d = (f.metadata or {}).get("default")
    if d is None:
        return None
    if str(d).upper() == "CURRENT_TIMESTAMP":
        return "current_timestamp()"
    return "'" + str(d).replace("\\", "\\\\").replace("'", "\\'") + "'"


def event_schema(version: int = 1) -> VersionedSchema:
    """D3: the default event schema (7 columns)."""
    # fixed values: default event schema v1
    return VersionedSchema(version, StructType([
        field("event_id", "string", nullable=False, description="unique event id"),
        field("event_type", "string", nullable=False, description="event type"),
        field("timestamp", "timestamp", nullable=False, description="event time"),
        field("payload", "json", description="event payload"),
        field("source", "string", description="producing source"),
        field("metadata", "json", description="event metadata"),
        field("processed_at", "timestamp", default="CURRENT_TIMESTAMP", description="processing time"),
    ]))


def get_field(schema: VersionedSchema, name: str) -> StructField | None:
    """D4."""
    return next((f for f in schema.struct.fields if f.name == name), None)


def add_field(schema: VersionedSchema, f: StructField, version: int | None = None) -> VersionedSchema:
    """Append a field; a name that exists already is an error."""
    if get_field(schema, f.name) is not None:
        raise ValueError(f"field {f.name} already exists")
    return VersionedSchema(schema.version if version is None else version,
                           StructType([*schema.struct.fields, f]))


def remove_field(schema: VersionedSchema, name: str, version: int | None = None) -> VersionedSchema:
    """Drop a field; absent names are ignored."""
    return VersionedSchema(schema.version if version is None else version,
                           StructType([f for f in schema.struct.fields if f.name != name]))


def sql_type(f: StructField, target: str) -> str:
    """A field's column type in a target dialect (Postgres adds NOT NULL)."""
    if target not in SQL_TYPES:
        raise ValueError(f"Unsupported target: {target!r} (expected one of {', '.join(TARGETS)})")
    t = SQL_TYPES[target][logical_type(f)]
    if target == "postgres" and not f.nullable:
        t += " NOT NULL"
    return t


@dataclass(frozen=True)
class SchemaChange:
    kind: str          # "add" | "remove" | "type" | "nullability"
    name: str
    old: StructField | None
    new: StructField | None


def diff_schemas(old: VersionedSchema, new: VersionedSchema) -> list[SchemaChange]:
    """Changes from ``old`` to ``new``, in the new schema's field order
    (removals after, in the old order).  Type and nullability changes are
    reported too; the migration only ever adds columns."""
    before = {f.name: f for f in old.struct.fields}
    after = {f.name: f for f in new.struct.fields}
    out = []
    for f in new.struct.fields:
        o = before.get(f.name)
        if o is None:
            out.append(SchemaChange("add", f.name, None, f))
        elif logical_type(o) != logical_type(f):
            out.append(SchemaChange("type", f.name, o, f))
        elif o.nullable != f.nullable:
            out.append(SchemaChange("nullability", f.name, o, f))
    out += [SchemaChange("remove", f.name, f, None) for f in old.struct.fields if f.name not in after]
    return out


def migration_statements(table: str, changes: list[SchemaChange]) -> list[str]:
    """Spark SQL for the additive part of a diff (one ALTER per batch
    of added columns).  Removed columns stay in the table: old rows keep
    their values and new rows write NULL."""
    adds = [c.new for c in changes if c.kind == "add"]
    if not adds:
        return []
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in adds)
    return [f"ALTER TABLE {table} ADD COLUMNS ({cols})"]


def _columns_ddl(struct: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
                     for f in struct.fields)


def table_version(spark: SparkSession, table: str) -> int | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    props = {r["key"]: r["value"] for r in rows}
    v = props.get(VERSION_PROPERTY)
    return int(v) if v is not None else None


def ensure_database(spark: SparkSession, database: str) -> None:
    """D9."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")


def ensure_table(spark: SparkSession, schema: VersionedSchema, table: str, using: str = "parquet",
                 partition_by: tuple[str, ...] = ("event_date",), location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for a catalog table.

    With ``using="iceberg"`` the table is partitioned by ``days(timestamp)``
    (hidden partitioning).  For file formats the partition columns must be
    real columns; ``event_date`` (the event time's UTC date) is appended.
    """
    struct = schema.struct
    if using.lower() == "iceberg":
        parts = "PARTITIONED BY (days(`timestamp`))"
        props = ("TBLPROPERTIES ('write.format.default'='parquet', "
                 "'write.parquet.compression-codec'='snappy', "
                 f"'{VERSION_PROPERTY}'='{schema.version}')")
    else:
        extra = [StructField(p, _partition_type(p))
                 for p in partition_by if p not in struct.fieldNames()]
        struct = StructType([*struct.fields, *extra])
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        props = f"TBLPROPERTIES ('{VERSION_PROPERTY}'='{schema.version}')"
    loc = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_columns_ddl(struct)}) USING {using} {parts} {loc} {props}")


def _partition_type(name: str) -> DataType:
    return DateType() if name.endswith("_date") else StringType()


def evolve_table(spark: SparkSession, table: str, current: VersionedSchema, target: VersionedSchema) -> bool:
    """Bring a table to ``target``.

    What is added follows from the catalog's own columns, so a run that
    crashed between adding columns and setting the version can be repeated.
    The table keeps columns that ``target`` lacks.  False when ``current``
    and ``target`` do not differ, or the table already has all of ``target``.
    Errors from the catalog are raised to the caller.
    """
    if current.version == target.version or not diff_schemas(current, target):
        return False
    held = set(spark.table(table).columns)
    adds = [SchemaChange("add", f.name, None, f) for f in target.struct.fields if f.name not in held]
    if not adds and table_version(spark, table) == target.version:
        return False
    for stmt in migration_statements(table, adds):
        spark.sql(stmt)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{VERSION_PROPERTY}'='{target.version}')")
    return True


POLICIES = ("refuse", "evolve", "quarantine")
# types that a table's column takes without loss
WIDENINGS = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
             ("int", "bigint"), ("int", "double"), ("float", "double"), ("date", "timestamp")}


class SchemaMismatch(ValueError):
    """A batch has columns that the table lacks or can't take."""


@dataclass(frozen=True)
class Mismatch:
    newer: tuple[StructField, ...]      # columns the table lacks
    other: tuple[StructField, ...]      # the table's fields of another type than the batch's

    def __bool__(self) -> bool:
        return bool(self.newer or self.other)


def mismatch(batch: StructType, held: StructType) -> Mismatch:
    """What of ``batch`` a table with the columns ``held`` would lose or refuse."""
    of = {f.name.lower(): f for f in held.fields}
    newer = tuple(f for f in batch.fields if f.name.lower() not in of)
    other = tuple(h for f in batch.fields if (h := of.get(f.name.lower())) is not None and h.dataType != f.dataType
                  and (f.dataType.simpleString(), h.dataType.simpleString()) not in WIDENINGS)
    return Mismatch(newer, other)


def add_missing_columns(spark: SparkSession, table: str, batch: StructType, tries: int = 5) -> None:
    """Bring the table to all columns of ``batch``; another writer may do the same meanwhile, so a refused change is
    looked at again.  Every change raises the table's stored version by one."""
    for k in range(tries):
        spark.catalog.refreshTable(table)
        found = mismatch(batch, spark.table(table).schema)
        if found.other:
            raise SchemaMismatch(f"{table}: other types for {', '.join(f.name for f in found.other)}; only columns can be added")
        if not found.newer:
            return
        version = table_version(spark, table)
        try:
            # one column at a time: what another writer has added by now stops only its own statement
            for f in found.newer:
                spark.sql(migration_statements(table, [SchemaChange("add", f.name, None, f)])[0])
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{VERSION_PROPERTY}'='{(version or 0) + 1}')")
        except Exception:
            if k == tries - 1:
                raise
