"""SimHash near-dedup with vantage-point trees (operator 5).

Fingerprints: a bit is 1 if it is set in over half of the XXH64 hashes of a text's shingles.
Equal fingerprints are one class, so copies never meet each other.  A vantage-point tree
deals the distinct fingerprints out to shards: a node has a vantage point and a distance;
what is nearer goes inside, the rest outside, and what is outside but within the link
distance of the border is also sent inside.  By the triangle inequality two linked
fingerprints then share a shard, at every border and so at every depth.  Inside a shard the
same tree goes on down to small blocks, where links are exact.  A shard returns each linked
group as a star, at most one edge per member and block; stars of all shards are joined to
components by alternating large-star and small-star rounds on written tables.

The dealing tree is fitted to about ``SAMPLE`` distinct fingerprints (those with the least hashes);
its shape only decides how even the shards are, never which links are found.

Contract: null and blank texts have fingerprint zero and are linked like any other; fewer
words than a shingle's are one shingle; an id's rows count one by one; a component's id is
its smallest non-null document id; an empty table gives an empty result; extra columns play
no part, and ``near_dedup`` keeps them.  Whole texts count; a very long one is hashed in blocks of
``HASHES_AT_ONCE`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.texts import slices, texts_of
from quayside.session import scratch_path

SEED, WORDS, BITS = 42, 3, 2
SAMPLE = 32_768          # fingerprints the dealing tree is fitted to
SHARD = 2_048            # distinct fingerprints a shard should have
BLOCK = 64               # fingerprints compared directly
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """64-bit SimHash of a text's word shingles, unsigned."""
    found = text.encode().lower().split()        # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    row = b" ".join(found)
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(row, SEED)]
    else:
        stops = list(accumulate(map(len, found), lambda a, n: a + 1 + n))
        starts = [0, *(s + 1 for s in stops[:len(found) - words])]
        hashes = [xxhash.xxh64_intdigest(row[a:b], SEED) for a, b in zip(starts, stops[words - 1:])]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        some = np.array(hashes[at:at + HASHES_AT_ONCE], ">u8")
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(df: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, fp) of every row; fp as a signed long, row a hash that tells rows of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fps = np.array([fingerprint(t, words) for t in texts_of(part.column(2))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps)], ["id", "row", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, row long, fp long")


def distance(fps: np.ndarray, to: int | np.integer) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(to))


def best_split(fps: np.ndarray, rng: np.random.Generator, bits: int) -> tuple[np.uint64, int] | None:
    """Vantage point and distance that leave the fewest fingerprints on both sides; None if no split makes them fewer."""
    best, found = 0.9 * len(fps), None
    for point in rng.choice(fps, min(6, len(fps)), replace=False):
        d = distance(fps, point)
        for mu in {int(np.median(d)), int(np.median(d)) - 1}:
            larger = max(int((d <= mu + bits).sum()), int((d > mu).sum()))
            if 0 <= mu and larger < best:
                best, found = larger, (point, mu)
    return found


class DealingTree:
    """Vantage-point tree that sends fingerprints to shards."""

    def __init__(self, sample: np.ndarray, shards: int, bits: int):
        self.bits, self.nodes, rng = bits, [], np.random.default_rng(SEED)
        self.shards, least = 0, max(8, len(sample) // max(1, shards))

        def grow(fps: np.ndarray) -> int:
            split = best_split(fps, rng, bits) if len(fps) > least else None
            at = len(self.nodes)
            if split is None:
                self.nodes.append(("shard", self.shards, 0, 0))
                self.shards += 1
                return at
            self.nodes.append(None)
            d = distance(fps, split[0])
            self.nodes[at] = (*split, grow(fps[d <= split[1]]), grow(fps[d > split[1]]))
            return at

        grow(sample)

    def deal(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, positions in fps) of all shards that get any."""
        todo = [(0, np.arange(len(fps)))]
        while todo:
            node, at = todo.pop()
            point, mu, inside, outside = self.nodes[node]
            if not len(at):
                continue
            if isinstance(point, str):
                yield mu, at
                continue
            d = distance(fps[at], point)
            todo += [(inside, at[d <= mu + self.bits]), (outside, at[d > mu])]


def stars(fps: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.uint64]]:
    """(members, smallest member) of each linked group, block by block of a vantage-point tree."""
    rng, out, todo = np.random.default_rng(SEED), [], [np.unique(fps)]
    while todo:
        some = todo.pop()
        split = best_split(some, rng, bits) if len(some) > BLOCK else None
        if split is not None:
            d = distance(some, split[0])
            todo += [some[d <= split[1] + bits], some[d > split[1]]]
            continue
        left = some                                  # groups by breadth-first search; links aren't kept
        while len(left):
            queue, left, group = [left[0]], left[1:], []
            while queue:
                x = queue.pop()
                group.append(x)
                near = distance(left, x) <= bits
                if near.any():
                    queue += left[near].tolist()
                    left = left[~near]
            if len(group) > 1:
                group = np.array(group, np.uint64)
                out.append((group, group.min()))
    return out


def edges(classes: DataFrame, bits: int = BITS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(a, b) of distinct fingerprints whose components are those of the link graph; classes: one row per ``fp``, a written table."""
    n = classes.count()
    # about ``sample`` fingerprints come to the driver, whatever their number: those whose hash is under sample / n
    part = F.pmod(F.xxhash64("fp"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, sample / max(1, n)))
    first = classes.filter(part).select("fp").toPandas()["fp"].to_numpy(np.int64)
    tree = DealingTree(np.sort(first).view(np.uint64), -(-n // shard), bits)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for number, at in tree.deal(fps.view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number, np.int32)), pa.array(fps[at])], ["shard", "fp"])

    def link(group: pd.DataFrame) -> pd.DataFrame:
        found = [(m, np.full(len(m), s, np.uint64)) for m, s in stars(group["fp"].to_numpy().view(np.uint64), bits)]
        a, b = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.uint64) for k in (0, 1))
        return pd.DataFrame({"a": a[a != b].view(np.int64), "b": b[a != b].view(np.int64)})

    return classes.select("fp").mapInArrow(deal, "shard int, fp long").groupBy("shard").applyInPandas(link, "a long, b long").distinct()


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links`` (a, b) but the roots; the root is the component's
    smallest node.  Rounds of large-star and small-star, each a written table, until none changes."""
    spark = links.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "stars")
        df.write.parquet(path)
        df = spark.read.parquet(path)
        return df, tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.shiftright(F.xxhash64("b", "a"), 20))).first())

    now, mark = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while mark[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        large = (both.join(low, F.col("a") == F.col("n")).filter("b > a")
                 .select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct())
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        small = (large.join(low, F.col("a") == F.col("n")).filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .union(low.select("n", "low")).distinct())
        before, (now, mark) = mark, written(small)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_groups(df: DataFrame, words: int = WORDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, fp, root, component_id) of every row; root: the component's smallest fingerprint."""
    spark = df.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    docs = written(fingerprints(df, words, id_col, text_col), "fingerprints")
    classes = written(docs.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = star_components(edges(classes, bits))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that both sides of the last join are plain exchanges and a hot fingerprint can be split
    labels = written(rooted.join(ids, "root").select(F.col("fp").alias("of"), "root", "component_id"), "labels")
    return docs.join(labels, F.col("fp") == F.col("of")).select("id", "row", "fp", "root", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(df: DataFrame, words: int = WORDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every document."""
    return near_groups(df, words, bits, id_col, text_col).select(F.col("id").alias(id_col), hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def near_dedup(df: DataFrame, words: int = WORDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each component: the one with the smallest id (nulls last), then the smallest hash of its text, then the
    smallest of the other columns.  An id that occurs with unrelated texts keeps a row for each of their components."""
    groups = near_groups(df, words, bits, id_col, text_col)
    # ids are compared as numbers or texts; a null id comes last
    key = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    keep = groups.groupBy("root").agg(F.min(key).alias("key")).select(F.col("key.id").alias("__id"), F.col("key.row").alias("__row")).distinct()
    kept = df.join(keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__row")))
    # rows with the same id and text are one document; maps have no order
    rest = [kept[f.name] for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    same = Window.partitionBy("__id", "__row").orderBy(*rest)
    return kept.withColumn("__n", F.row_number().over(same)).filter("__n = 1").select(*[kept[c] for c in df.columns])
