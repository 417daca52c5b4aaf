"""Sink option builders and write layouts."""

from pyspark.sql import functions as F

from quayside.sinks.writers import (CLICKHOUSE_TABLE_OPTIONS, clickhouse_jdbc_options, clickhouse_layout,
                                    clickhouse_options, merge_insert_sql, postgres_options)


def test_postgres_options():
    o = postgres_options("db", 5432, "events", "stream_events")
    assert o["url"] == "jdbc:postgresql://db:5432/events"
    assert o["driver"] == "org.postgresql.Driver"
    assert o["user"] == "postgres" and o["password"] == ""
    assert o["dbtable"] == "stream_events" and "numPartitions" not in o
    assert postgres_options("db", 5432, "events", "t", num_partitions=3)["numPartitions"] == "3"
    assert o["createTableColumnTypes"] == "event_id VARCHAR(255), event_type VARCHAR(255), source VARCHAR(255)"


def test_clickhouse_options_and_layout(spark):
    o = clickhouse_options("ch", 8123, "db", "t")
    assert o == {"host": "ch", "port": "8123", "database": "db", "table": "t", "user": "default", "password": ""}
    assert "ORDER BY (timestamp, event_id)" in CLICKHOUSE_TABLE_OPTIONS
    df = spark.createDataFrame(
        [(f"e{i}", f"2024-0{1 + i % 3}-{10 + i % 17} 0{i % 10}:00:00") for i in range(200)],
        "event_id string, ts string").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    laid = clickhouse_layout(df)
    assert laid.columns == ["event_id", "timestamp"]
    parts = laid.rdd.glom().collect()
    for rows in parts:   # sorted by (month, timestamp, event_id) inside every task
        keys = [(r.timestamp.strftime("%Y%m"), r.timestamp, r.event_id) for r in rows]
        assert keys == sorted(keys)
    assert sum(len(p) for p in parts) == 200


def test_clickhouse_jdbc_options():
    o = clickhouse_jdbc_options("ch", 8123, "db", "t")
    assert o["url"] == "jdbc:clickhouse://ch:8123/db" and o["user"] == "default"
    assert o["createTableOptions"] == CLICKHOUSE_TABLE_OPTIONS


def test_merge_insert_sql_parses(spark):
    sql = merge_insert_sql("db.t", "v", ["event_id", "timestamp", "payload"])
    assert sql.startswith("MERGE INTO db.t t USING v s ON t.`event_id` = s.`event_id`")
    assert "WHEN NOT MATCHED THEN INSERT (`event_id`, `timestamp`, `payload`)" in sql
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    assert "MergeIntoTable" in plan.getClass().getName()
