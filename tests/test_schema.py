"""Declared schemas, diffs and table evolution."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StringType, TimestampType

from quayside.schema import (SPARK_TYPES, VersionedSchema, add_field, diff_schemas, ensure_table, event_schema,
                             evolve_table, field, get_field, migration_statements, remove_field, sql_type,
                             table_version)


def test_default_schema_shape():
    s = event_schema()
    assert s.version == 1
    assert s.names == ["event_id", "event_type", "timestamp", "payload", "source", "metadata", "processed_at"]
    assert [f.nullable for f in s.struct.fields] == [False, False, False, True, True, True, True]
    assert isinstance(get_field(s, "timestamp").dataType, TimestampType)
    assert get_field(s, "processed_at").metadata["default"] == "CURRENT_TIMESTAMP"


def test_one_field_per_logical_type():
    types = {"string": StringType(), "integer": IntegerType(), "float": DoubleType(), "boolean": BooleanType(),
             "timestamp": TimestampType(), "datetime": TimestampType(), "json": StringType(), "jsonb": StringType()}
    for logical, spark_type in types.items():
        assert field("f", logical).dataType == spark_type
    assert set(types) <= set(SPARK_TYPES)
    with pytest.raises(ValueError):
        field("f", "decimal")


def test_sql_types_per_target():
    s = event_schema()
    assert sql_type(get_field(s, "event_id"), "postgres") == "VARCHAR(255) NOT NULL"
    assert sql_type(get_field(s, "payload"), "postgres") == "JSONB"
    assert sql_type(get_field(s, "timestamp"), "clickhouse") == "DateTime"
    assert sql_type(field("n", "integer"), "iceberg") == "BIGINT"
    assert sql_type(field("b", "boolean"), "clickhouse") == "UInt8"
    with pytest.raises(ValueError):
        sql_type(get_field(s, "event_id"), "oracle")


def test_add_remove_lookup():
    s = event_schema()
    s2 = add_field(s, field("region", "string"), version=2)
    assert s2.names[-1] == "region" and s2.version == 2 and s.names[-1] == "processed_at"
    with pytest.raises(ValueError):
        add_field(s2, field("region", "string"))
    assert remove_field(s2, "nope").names == s2.names
    assert "source" not in remove_field(s2, "source").names
    assert get_field(s, "nope") is None


def test_diff_reports_add_remove_type():
    v1 = event_schema()
    v2 = VersionedSchema(2, remove_field(add_field(v1, field("region", "string")), "source").struct)
    v3 = VersionedSchema(3, add_field(remove_field(v1, "payload"), field("payload", "integer")).struct)
    kinds = [(c.kind, c.name) for c in diff_schemas(v1, v2)]
    assert kinds == [("add", "region"), ("remove", "source")]
    assert [(c.kind, c.name) for c in diff_schemas(v1, v3)] == [("type", "payload")]
    assert migration_statements("t", diff_schemas(v1, v2)) == ["ALTER TABLE t ADD COLUMNS (`region` STRING)"]
    assert migration_statements("t", diff_schemas(v1, v3)) == []


def test_evolve_catalog_table(spark, tmp_dir):
    table = f"evolve_{uuid.uuid4().hex[:8]}"
    v1 = event_schema()
    ensure_table(spark, v1, table, location=f"{tmp_dir}/{table}")
    ensure_table(spark, v1, table, location=f"{tmp_dir}/{table}")   # idempotent
    assert table_version(spark, table) == 1
    v1_same_version = add_field(v1, field("x", "string"))
    assert evolve_table(spark, table, v1, v1_same_version) is False
    v2 = add_field(v1, field("region", "string"), version=2)
    old = spark.createDataFrame([("a", "t", "s")], "event_id string, event_type string, source string") \
        .select("event_id", "event_type", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
                F.lit("{}").alias("payload"), "source", F.lit(None).cast("string").alias("metadata"),
                F.lit(None).cast("timestamp").alias("processed_at"), F.lit("2024-01-01").cast("date").alias("event_date"))
    old.write.insertInto(table)
    assert evolve_table(spark, table, v1, v2) is True
    assert table_version(spark, table) == 2
    assert "region" in spark.table(table).columns
    assert spark.table(table).filter("event_id = 'a'").first()["region"] is None
    removed_only = remove_field(v2, "source", version=3)
    assert evolve_table(spark, table, v2, removed_only) is True
    assert "source" in spark.table(table).columns   # additive only


def test_ensure_table_unknown_format_fails(spark):
    with pytest.raises(Exception):
        ensure_table(spark, event_schema(), f"bad_{uuid.uuid4().hex[:6]}", using="nosuchformat")


def test_read_old_files_under_new_schema(spark, tmp_dir):
    from quayside.operators.conform import conform, read_conformed
    v1 = event_schema()
    v2 = add_field(v1, field("region", "string"), version=2)
    rows = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-02 00:00:00")],
                                 "event_id string, ts string") \
        .select("event_id", F.lit("t").alias("event_type"), F.col("ts").cast("timestamp").alias("timestamp"),
                F.lit("{}").alias("payload"), F.lit("s").alias("source"))
    conform(rows.filter("event_id = 'a'"), v1.struct).write.parquet(f"{tmp_dir}/t/v=1")
    conform(rows.filter("event_id = 'b'").withColumn("region", F.lit("eu")), v2.struct).write.parquet(f"{tmp_dir}/t/v=2")
    out = {r.event_id: r for r in read_conformed(spark, f"{tmp_dir}/t", v2.struct).collect()}
    assert out["a"].region is None and out["b"].region == "eu"
    assert list(out["a"].asDict())[:8] == v2.names


def test_ensure_database_and_empty(spark):
    from quayside.operators.conform import empty
    from quayside.schema import ensure_database
    name = f"db_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name)
    ensure_database(spark, name)     # idempotent
    assert spark.catalog.databaseExists(name)
    e = empty(spark, event_schema().struct)
    assert e.count() == 0 and e.schema == event_schema().struct


def _v1_rows(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "event_id string").select(
        "event_id", F.lit("t").alias("event_type"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"), F.lit("{}").alias("payload"),
        F.lit("s").alias("source"), F.lit(None).cast("string").alias("metadata"), F.lit(None).cast("timestamp").alias("processed_at"))


def test_newer_rows_into_an_older_table(spark, tmp_dir):
    from quayside.schema import SchemaMismatch
    from quayside.sinks.writers import files_sink, table_sink
    newer = _v1_rows(spark, ["a", "b"]).withColumn("region", F.when(F.col("event_id") == "b", "eu"))
    for policy in ("refuse", "evolve", "quarantine"):
        table = f"newer_{uuid.uuid4().hex[:8]}"
        ensure_table(spark, event_schema(), table, location=f"{tmp_dir}/{table}")
        sink = table_sink("t", table, on_newer=policy, quarantine=files_sink("q", f"{tmp_dir}/q"))
        sink.write(_v1_rows(spark, ["old"]), 0)
        if policy == "refuse":
            with pytest.raises(SchemaMismatch):
                sink.write(newer, 1)
            assert [r.event_id for r in spark.table(table).collect()] == ["old"]
        elif policy == "evolve":
            sink.write(newer, 1)
            sink.write(_v1_rows(spark, ["old2"]), 2)          # a writer of the older schema goes on
            assert sorted((r.event_id, r.region) for r in spark.table(table).collect()) == [("a", None), ("b", "eu"), ("old", None), ("old2", None)]
            assert table_version(spark, table) == 2
        else:
            sink.write(newer, 1)
            assert sorted(r.event_id for r in spark.table(table).collect()) == ["a", "old"]
            away = spark.read.parquet(f"{tmp_dir}/q").collect()
            assert [(r.event_id, r.reject_reason) for r in away] == [("b", "newer_schema")] and '"region":"eu"' in away[0].raw_value
    with pytest.raises(ValueError):
        table_sink("t", "x", on_newer="quarantine")


def test_other_types_and_a_second_writer(spark, tmp_dir, monkeypatch):
    from quayside import schema as schema_module
    from quayside.schema import SchemaMismatch, add_missing_columns
    from quayside.sinks.writers import files_sink, table_sink
    table = f"types_{uuid.uuid4().hex[:8]}"
    ensure_table(spark, add_field(event_schema(), field("n", "integer")), table, location=f"{tmp_dir}/{table}")
    rows = _v1_rows(spark, ["a", "b"]).withColumn("n", F.when(F.col("event_id") == "a", "7").otherwise("x"))
    for policy in ("refuse", "evolve"):
        with pytest.raises(SchemaMismatch):
            table_sink("t", table, on_newer=policy).write(rows, 0)
    table_sink("t", table, on_newer="quarantine", quarantine=files_sink("q", f"{tmp_dir}/q2")).write(rows, 0)
    assert [(r.event_id, r.n) for r in spark.table(table).collect()] == [("a", 7)]
    assert [r.event_id for r in spark.read.parquet(f"{tmp_dir}/q2").collect()] == ["b"]
    # another writer adds the column between the look and the change
    wider = rows.drop("n").withColumn("region", F.lit("eu")).withColumn("zone", F.lit("z")).schema
    statements = schema_module.migration_statements

    def late(name, changes):
        monkeypatch.undo()
        spark.sql(statements(name, changes)[0])
        return statements(name, changes)
    monkeypatch.setattr(schema_module, "migration_statements", late)
    add_missing_columns(spark, table, wider)
    assert {"region", "zone"} <= set(spark.table(table).columns)
