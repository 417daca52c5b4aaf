"""Sink writers.

A sink is a name plus a function ``(DataFrame, batch_id) → None`` that
appends one batch.  Writers only declare the layout; Spark does the work on
the executors.  Optional connectors (JDBC drivers, ClickHouse, Iceberg) are
looked up by Spark when the write runs; a missing jar fails that sink only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from quayside.schema import POLICIES, SchemaMismatch, VersionedSchema, add_missing_columns, event_schema, mismatch, table_version
from quayside.session import path_exists
from quayside.sinks.commit import BatchCommits
from quayside.sinks.keyindex import KeyIndex

WriteFn = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Sink:
    name: str
    write: WriteFn
    # (spark, dates | None) → DataFrame with the sink's existing (event_date,
    # event_id), limited to those dates when given; None when the sink cannot
    # be read back (then only the ledger guards replays)
    existing: Callable | None = field(default=None, compare=False)
    # file/catalog sinks partition by event_date; other sinks never see it
    wants_event_date: bool = False
    # the landing copy keeps partition and offset, which order a later dedup
    keeps_positions: bool = False
    # columns a batch must have
    needs: tuple[str, ...] = ()
    # (DataFrame, run_id, batch_id) → (rows, written now): the batch as one commit that a replay finds; None when the sink can only append
    commit: Callable | None = field(default=None, compare=False)
    # index of the sink's keys over all dates
    keys: KeyIndex | None = field(default=None, compare=False)

    def check(self, columns: list[str]) -> None:
        """Raise if a batch of these columns can't be written."""
        lacking = [c for c in self.needs if c not in columns and not (c == "event_date" and "timestamp" in columns)]
        if lacking:
            raise ValueError(f"sink {self.name} needs the columns {', '.join(lacking)}; the batch has {', '.join(columns)}")


def _read_written(reader, paths: list[str]) -> DataFrame | None:
    """Read folders that exist; None if they hold no data file yet.  Any other
    failure is raised: taken for an empty sink it would switch the replay
    checks off."""
    try:
        return reader.load(paths)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":   # fixed value: Spark's error class for a folder without data files
            return None
        raise


def with_event_date(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    return df if "event_date" in df.columns else df.withColumn("event_date", F.to_date(F.col(ts_col)))


def files_sink(name: str, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ("event_date",),
               max_records_per_file: int = 1_000_000) -> Sink:
    """K7: append Parquet (or any file format) partitioned by event date.

    ``REBALANCE(event_date)`` lets AQE cut a hot date into several tasks and
    merge small ones, so file counts stay bounded without a skewed
    ``repartition``.  A batch of a named run is one atomic commit, which a replay finds
    (``sinks.commit``); without a run there is nothing to tell a replay by, and the batch is appended.
    """
    def save(df: DataFrame, folder: str) -> None:
        out = with_event_date(df).hint("rebalance", *partition_by) if partition_by else df
        (out.write.mode("append").format(fmt).option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(*partition_by).save(folder))

    def write(df: DataFrame, batch_id: int) -> None:
        save(df, path)

    def commit(df: DataFrame, run_id: str, batch_id: int) -> tuple[int, bool]:
        def staged(folder: str) -> int:
            rows = Observation()
            save(df.observe(rows, F.count(F.lit(1)).alias("rows")), folder)
            return int(rows.get["rows"])
        return BatchCommits(df.sparkSession, path).commit(run_id, batch_id, staged)

    def existing(spark, dates=None):
        """Only the given dates' partition folders are listed: a path-based
        read otherwise lists every file of the table up front."""
        if dates is not None and partition_by == ("event_date",):
            where = [f"{path}/event_date={d}" for d in dates]
        else:
            where = [path]
        where = [w for w in where if path_exists(spark, w)]
        return _read_written(spark.read.format(fmt).option("basePath", path), where) if where else None
    return Sink(name, write, existing, wants_event_date=True, needs=partition_by, commit=commit, keys=KeyIndex(f"{path}/_keys"))


def landing_sink(name: str, path: str, fmt: str = "parquet") -> Sink:
    """The batch as delivered, with its source positions, in one folder per
    ``batch_id``: the source for re-delivering a batch to a sink that failed
    (``deliver.redeliver``).  Batch ids are those of one query: give every
    query a path of its own."""
    def write(df: DataFrame, batch_id: int) -> None:
        # a batch's folder is replaced, so a replay leaves one copy
        df.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return Sink(name, write, wants_event_date=True, keeps_positions=True)


NEWER_SCHEMA = "newer_schema"      # reject reason of rows that a table of an older schema can't hold


def table_sink(name: str, table: str, using: str = "parquet", on_newer: str = "refuse", quarantine: Sink | None = None) -> Sink:
    """K3 / K7 for catalog tables.  ``using="iceberg"`` appends with
    DataFrameWriterV2 (hidden ``days(timestamp)`` partitioning comes from
    the table); file-format tables get the ``event_date`` column.

    The batch's schema is held against the table's at every write.  ``on_newer`` says what happens to columns that the table
    lacks: ``"refuse"`` fails the batch, with nothing written; ``"evolve"`` adds them to the table first;
    ``"quarantine"`` writes the rows that have no value there and sends the others, as JSON, to the ``quarantine`` sink.
    A column of another type fails the batch, or under ``"quarantine"`` sends the rows whose value can't be cast there.  Rows of an older
    schema have NULL in the columns they lack."""
    if on_newer not in POLICIES:
        raise ValueError(f"on_newer must be one of {POLICIES}")
    if on_newer == "quarantine" and quarantine is None:
        raise ValueError("on_newer='quarantine' needs a quarantine sink")

    def fitted(df: DataFrame, batch_id: int) -> DataFrame:
        """The rows that go to the table, after the policy."""
        spark = df.sparkSession
        found = mismatch(df.schema, spark.table(table).schema)
        if not found:
            return df
        if on_newer == "evolve":
            add_missing_columns(spark, table, df.schema)
            return df
        if on_newer == "refuse":
            raise SchemaMismatch(f"{table} (version {table_version(spark, table)}) lacks {', '.join(f.name for f in found.newer) or 'nothing'}"
                                 f" and has other types for {', '.join(f.name for f in found.other) or 'nothing'}")
        newer = [F.col(f.name).isNotNull() for f in found.newer]
        uncast = [F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull() for f in found.other]
        odd = F.lit(False)
        for c in [*newer, *uncast]:
            odd = odd | c
        away = df.filter(odd).withColumn("raw_value", F.to_json(F.struct(*df.columns)))
        quarantine.write(away.select("raw_value", "event_id", F.lit(NEWER_SCHEMA).alias("reject_reason"), F.to_date("timestamp").alias("event_date")), batch_id)
        kept = df.filter(~odd).drop(*[f.name for f in found.newer])
        return kept.withColumns({f.name: F.col(f.name).try_cast(f.dataType) for f in found.other}) if found.other else kept

    def write(df: DataFrame, batch_id: int) -> None:
        if using.lower() == "iceberg":
            fitted(df, batch_id).writeTo(table).append()
        else:
            out = fitted(with_event_date(df), batch_id).hint("rebalance", "event_date")
            columns = df.sparkSession.table(table).schema
            # rows of an older schema, or one with removed fields, have NULL in the columns they lack
            out.select(*[F.col(f.name) if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in columns.fields]).write.insertInto(table)

    def existing(spark, dates=None):
        # a literal date filter prunes partitions from the catalog's metadata
        t = spark.table(table)
        t = t if "event_date" in t.columns else with_event_date(t)
        return t if dates is None else t.filter(F.col("event_date").isin(*dates))
    return Sink(name, write, existing, wants_event_date=using.lower() != "iceberg")


def iceberg_sink(name: str, database: str, table: str, merge: bool = False) -> Sink:
    """K3: append to an Iceberg table ``database.table``.

    ``merge=True`` (K8 for table formats with MERGE): insert only events whose
    ``event_id`` the table does not hold yet, in one atomic commit, so a
    replayed batch is a no-op even without the ledger.  The match is on the
    key alone, over the whole table: the event time of a row without a usable
    time text is the batch time, which a replay changes.
    """
    full = f"{database}.{table}"
    if not merge:
        return table_sink(name, full, using="iceberg")

    def write(df: DataFrame, batch_id: int) -> None:
        view = f"quayside_batch_{name}_{batch_id}"
        df.createOrReplaceTempView(view)
        try:
            df.sparkSession.sql(merge_insert_sql(full, view, df.columns))
        finally:
            df.sparkSession.catalog.dropTempView(view)

    def existing(spark, dates=None):
        t = with_event_date(spark.table(full))
        return t if dates is None else t.filter(F.col("event_date").isin(*dates))
    return Sink(name, write, existing)


def merge_insert_sql(table: str, view: str, columns: list[str], key: str = "event_id") -> str:
    """``MERGE INTO`` that inserts rows with new keys only."""
    cols = ", ".join(f"`{c}`" for c in columns)
    vals = ", ".join(f"s.`{c}`" for c in columns)
    return (f"MERGE INTO {table} t USING {view} s "
            f"ON t.`{key}` = s.`{key}` "
            f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def jdbc_options(url: str, table: str, user: str, password: str, driver: str, num_partitions: int | None = None,
                 batchsize: int = 10_000, column_types: str | None = None,
                 table_options: str | None = None) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
            "batchsize": str(batchsize)}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if column_types:
        opts["createTableColumnTypes"] = column_types
    if table_options:
        opts["createTableOptions"] = table_options
    return opts


def jdbc_sink(name: str, url: str, table: str, user: str, password: str = "", driver: str | None = None,
              num_partitions: int | None = None, batchsize: int = 10_000, column_types: str | None = None,
              table_options: str | None = None) -> Sink:
    """K2: JDBC append.  ``num_partitions`` caps concurrent connections (Spark
    coalesces to it; unset, every task of the batch writes); ``batchsize`` rows go per round trip.  The table is
    created by the first append when it does not exist."""
    opts = jdbc_options(url, table, user, password, driver or "", num_partitions, batchsize, column_types,
                        table_options)
    if not driver:
        opts.pop("driver")

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format("jdbc").options(**opts).mode("append").save()
    return Sink(name, write)


def postgres_column_types(schema: VersionedSchema | None = None) -> str:
    """D2/D11 for JDBC: string fields as ``VARCHAR(255)``.  Spark's writer
    can create JSON fields only as ``TEXT``: ``createTableColumnTypes`` takes
    Spark types and ``JSONB`` is none, so a table with JSONB columns has to be
    created beforehand (``sql_type(field, "postgres")`` has the types)."""
    schema = schema or event_schema()
    return ", ".join(f"{f.name} VARCHAR(255)" for f in schema.struct.fields
                     if (f.metadata or {}).get("logical_type") == "string")


POSTGRES_DRIVER = "org.postgresql.Driver"  # fixed value: the Postgres JDBC driver class


def postgres_options(host: str, port: int, database: str, table: str, user: str | None = None,
                     password: str | None = None, schema: VersionedSchema | None = None,
                     num_partitions: int | None = None, batchsize: int = 10_000) -> dict[str, str]:
    """JDBC writer options for Postgres (user defaults to ``postgres``)."""
    return jdbc_options(f"jdbc:postgresql://{host}:{port}/{database}", table, user or "postgres", password or "",
                        POSTGRES_DRIVER, num_partitions, batchsize, postgres_column_types(schema))


def postgres_sink(name: str, host: str, port: int, database: str, table: str, user: str | None = None,
                  password: str | None = None, schema: VersionedSchema | None = None, **kw) -> Sink:
    """K2 with the Postgres URL, driver class and default user."""
    return jdbc_sink(name, f"jdbc:postgresql://{host}:{port}/{database}", table, user or "postgres",
                     password or "", POSTGRES_DRIVER, column_types=postgres_column_types(schema), **kw)


# fixed value: the MergeTree layout
CLICKHOUSE_TABLE_OPTIONS = "ENGINE = MergeTree() ORDER BY (timestamp, event_id) PARTITION BY toYYYYMM(timestamp)"


def clickhouse_layout(df: DataFrame) -> DataFrame:
    """Rows grouped by month and sorted by (timestamp, event_id) inside
    each task, matching the MergeTree sorting key so inserts need no merge
    work.  ``REBALANCE`` on the month keeps a hot month from landing in one
    task."""
    month = F.date_format(F.col("timestamp"), "yyyyMM")
    return (df.withColumn("_month", month).hint("rebalance", "_month")
            .sortWithinPartitions("_month", "timestamp", "event_id").drop("_month"))


def clickhouse_options(host: str, port: int, database: str, table: str, user: str | None = None,
                       password: str | None = None) -> dict[str, str]:
    return {"host": host, "port": str(port), "database": database, "table": table,
            "user": user or "default", "password": password or ""}


CLICKHOUSE_DRIVER = "com.clickhouse.jdbc.ClickHouseDriver"  # fixed value: ClickHouse JDBC driver class


def clickhouse_jdbc_options(host: str, port: int, database: str, table: str, user: str | None = None,
                            password: str | None = None, num_partitions: int | None = None,
                            batchsize: int = 100_000) -> dict[str, str]:
    """D10 over JDBC: the first append creates a MergeTree table with the
    ``(timestamp, event_id)`` sorting key and monthly partitions."""
    return jdbc_options(f"jdbc:clickhouse://{host}:{port}/{database}", table, user or "default", password or "",
                        CLICKHOUSE_DRIVER, num_partitions, batchsize, table_options=CLICKHOUSE_TABLE_OPTIONS)


def clickhouse_sink(name: str, host: str, port: int, database: str, table: str, user: str | None = None,
                    password: str | None = None, via: str = "connector") -> Sink:
    """K1: append to ClickHouse, rows laid out by month and sorting key.

    ``via="connector"``: the ClickHouse Spark connector (format
    ``clickhouse``); ``via="jdbc"``: Spark's JDBC writer with the MergeTree
    DDL as ``createTableOptions``.
    """
    if via == "jdbc":
        jopts = clickhouse_jdbc_options(host, port, database, table, user, password)

        def write_jdbc(df: DataFrame, batch_id: int) -> None:
            clickhouse_layout(df).write.format("jdbc").options(**jopts).mode("append").save()
        return Sink(name, write_jdbc)
    if via != "connector":
        raise ValueError("via must be 'connector' or 'jdbc'")
    opts = {f"clickhouse.{k}": v for k, v in clickhouse_options(host, port, database, table, user, password).items()}

    def write(df: DataFrame, batch_id: int) -> None:
        clickhouse_layout(df).write.format("clickhouse").mode("append").options(**opts).save()
    return Sink(name, write)


def sinks_from_settings(settings: dict) -> list[Sink]:
    """K4: a sink is on when all its required settings are given; the order is
    ClickHouse, Postgres, Iceberg; none configured is an error."""
    s = {k: v for k, v in settings.items() if v not in (None, "")}
    out = []
    if all(k in s for k in ("clickhouse_host", "clickhouse_port", "clickhouse_database", "clickhouse_table")):
        out.append(clickhouse_sink("clickhouse", s["clickhouse_host"], s["clickhouse_port"],
                                   s["clickhouse_database"], s["clickhouse_table"],
                                   s.get("clickhouse_user"), s.get("clickhouse_password")))
    if all(k in s for k in ("postgres_host", "postgres_port", "postgres_database", "postgres_table")):
        out.append(postgres_sink("postgres", s["postgres_host"], s["postgres_port"], s["postgres_database"],
                                 s["postgres_table"], s.get("postgres_user"), s.get("postgres_password")))
    if all(k in s for k in ("iceberg_database", "iceberg_table")):
        out.append(iceberg_sink("iceberg", s["iceberg_database"], s["iceberg_table"]))
    if not out:
        raise ValueError("at least one sink must be configured")
    return out
