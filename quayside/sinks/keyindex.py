"""Index of the keys a sink holds, with Bloom filters (K8).

Keys are dealt by hash to buckets.  ``keys/bucket=b`` has the keys of a bucket; ``bloom/bucket=b``
has its Bloom filter as rows (word, bits), appended batch by batch and united by ``bit_or``.  A
batch first probes the filters of its own buckets, which are a fraction of the keys' size; only
buckets that may hold one of its keys are then opened for the exact anti-join.  A batch of
new keys thus reads hardly any key, however many the sink has.

Appending a key twice changes nothing, so an append can be repeated after a crash.  The index
is made from the sink's data when it is first used; ``rebuild`` makes a new generation,
which also merges small files, and switches over by one entry of a commit log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import path_exists
from quayside.sinks.commitlog import CommitLog, HadoopFolder

BUCKETS = 256
# 2^20 bits per bucket, seven probes: 1 % false positives at about 100,000 keys a bucket (26 million in all); more keys want more buckets
BITS, PROBES = 1 << 20, 7


class KeyIndex:
    def __init__(self, path: str, key: str = "event_id", buckets: int = BUCKETS, bits: int = BITS, probes: int = PROBES):
        self.path, self.key, self.buckets, self.bits, self.probes = path.rstrip("/"), key, buckets, bits, probes

    def _log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(HadoopFolder(spark, f"{self.path}/log"))

    def generation(self, spark: SparkSession) -> str | None:
        """Folder of the index in use."""
        records = self._log(spark).records()
        return f"{self.path}/{records[-1]['generation']}" if records else None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _probes(self, keys: DataFrame) -> DataFrame:
        """(key, bucket, word, bit) of every probe of every key."""
        at = F.explode(F.array(*[F.pmod(F.xxhash64(F.lit(i), self.key), F.lit(self.bits)) for i in range(1, self.probes + 1)]))
        probes = keys.select(self.key, "bucket", at.alias("at"))
        return probes.select(self.key, "bucket", (F.col("at") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at % 64 AS int))").alias("bit"))

    def _append(self, keys: DataFrame, folder: str) -> None:
        keyed = keys.filter(F.col(self.key).isNotNull()).select(self.key).distinct().withColumn("bucket", self._bucket())
        words = self._probes(keyed).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
        # the filter first: a key that only the filter has costs a look, one that only the keys have would be missed
        words.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{folder}/bloom")
        keyed.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{folder}/keys")

    def rebuild(self, spark: SparkSession, target: DataFrame | None) -> None:
        """A new generation from all keys of ``target``; the one before stays for those who read it."""
        name = f"generation-{uuid.uuid4().hex[:12]}"
        if target is not None:
            self._append(target, f"{self.path}/{name}")
        self._log(spark).append([{"generation": name}])

    def add(self, rows: DataFrame) -> None:
        folder = self.generation(rows.sparkSession)
        if folder is not None:                       # else the first use makes it from the sink's data
            self._append(rows, folder)

    def _read(self, spark: SparkSession, table: str, schema: str, buckets: list[int], folder: str) -> DataFrame:
        """The given buckets only: other folders are not even listed."""
        where = [w for b in buckets if path_exists(spark, w := f"{folder}/{table}/bucket={b}")]
        if not where:
            return spark.createDataFrame([], f"{schema}, bucket int")
        return spark.read.schema(f"{schema}, bucket int").option("basePath", f"{folder}/{table}").parquet(*where)

    def held(self, batch: DataFrame) -> DataFrame:
        """(key) of the buckets that may hold a key of ``batch``; the plan reads no other file."""
        spark = batch.sparkSession
        folder = self.generation(spark)
        kind = batch.schema[self.key].dataType.simpleString()
        keyed = batch.filter(F.col(self.key).isNotNull()).select(self.key).distinct().withColumn("bucket", self._bucket())
        own = [r[0] for r in keyed.select("bucket").distinct().collect()]             # at most ``buckets`` numbers
        words = self._read(spark, "bloom", "word int, bits bigint", own, folder).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        hit = self._probes(keyed).join(words, ["bucket", "word"]).filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
        may = hit.groupBy(self.key, "bucket").count().filter(F.col("count") >= self.probes)
        opened = sorted(r[0] for r in may.select("bucket").distinct().collect())
        return self._read(spark, "keys", f"`{self.key}` {kind}", opened, folder).select(self.key)

    def drop_held(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key the sink does not hold."""
        return batch.join(self.held(batch), [self.key], "left_anti")
