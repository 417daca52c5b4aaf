"""Approximate nearest neighbours by stable projections (operator 2).

Largest inner product becomes least Euclidean distance when every candidate is scaled by the
largest norm and given one more component that makes it a unit vector (queries get 0 there).
A Gaussian projection to ``DIMENSIONS`` dimensions is stable: projected over true squared
distance follows the chi-square distribution.  Candidates are dealt by the hash of their id
to shards, each of which holds a kd-tree over its projected vectors.  For a query, leaves
come in the order of their projected distance; their candidates are verified on the original
vectors, and the search stops when the chi-square test holds: a candidate as near as the
k-th best found so far would, with probability ``CERTAINTY`` or more, project nearer than
any leaf that is left.  The k best of all shards are merged.

Candidates and queries are scaled by powers of two before they are multiplied, and ranked by the
scaled products, so that squares and scores beyond the range of a double change no rank; the
score itself may read as infinite or zero there.

Every row is indexed.  Queries meet shards in blocks; a pair of blocks is one bounded task.

Contract: rows without an id, and vectors that are null, empty, zero or hold a null or
non-finite component take no part; shorter vectors read as padded with zeros.  Candidates
are all rows with another id than the query's; a query id that repeats is searched once, by
its first vector in order; equal scores go to the smaller id.  Fewer than k candidates are
all returned.  An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from math import exp, frexp, ldexp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

DIMENSIONS, CERTAINTY, SEED = 12, 0.95, 7
SHARD_ROWS, BLOCK_QUERIES, LEAF = 8_192, 2_048, 128
TIE, TIE_PROJECTED, MOST = 1e-9, 1e-7, np.finfo(float).max
QUERIES_AT_ONCE = 512


def chi_square_cdf(x: float, dimensions: int) -> float:
    """For an even number of dimensions."""
    term, total = 1.0, 1.0
    for j in range(1, dimensions // 2):
        term *= x / 2 / j
        total += term
    return 1 - exp(-x / 2) * total


def chi_square_quantile(p: float, dimensions: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dimensions) < p else (low, mid)
    return high


class ProjectedTree:
    """kd-tree over projected unit vectors; vectors and largest_norm: scaled by a power of two to about 1."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest_norm: float, dimensions: int = DIMENSIONS, leaf: int = LEAF):
        scaled = vectors / largest_norm
        last = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        self.axes = np.random.default_rng(SEED).standard_normal((dimensions, vectors.shape[1] + 1))
        points = np.column_stack([scaled, last]) @ self.axes.T
        leaves, todo = [], [np.arange(len(ids))]
        while todo:
            at = todo.pop()
            spread = np.ptp(points[at], axis=0)
            if len(at) <= leaf or not spread.max() > 0:
                leaves.append(at)
                continue
            axis = int(spread.argmax())
            order = at[np.argsort(points[at, axis], kind="stable")]
            todo += [order[:len(order) // 2], order[len(order) // 2:]]
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points, self.norm = ids[order], vectors[order], points[order], largest_norm
        self.squares = (self.points * self.points).sum(axis=1)
        stops = np.cumsum([len(x) for x in leaves])
        self.bounds = list(zip([0, *stops[:-1].tolist()], stops.tolist()))
        self.low = np.array([points[x].min(axis=0) for x in leaves])
        self.high = np.array([points[x].max(axis=0) for x in leaves])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, limit: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and inner products, as scaled as vectors and queries, of the k best found for each query; limit: quantile of the stopping test.

        All queries take their next nearest leaf together, and a leaf is multiplied with all queries that are at it."""
        n = len(queries)
        size = np.sqrt((queries * queries).sum(axis=1))
        points = (queries / size[:, None]) @ self.axes[:, :-1].T
        gap = np.stack([(np.maximum(0.0, np.maximum(low - points, points - high)) ** 2).sum(axis=1) for low, high in zip(self.low, self.high)], axis=1)
        turn = np.argsort(gap, axis=1, kind="stable")
        best, live = np.full((n, k), -np.inf), np.arange(n)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []          # queries, places of candidates, scores
        for step in range(len(self.bounds)):
            kth = best[live].min(axis=1)
            true2 = np.maximum(0.0, 2 - 2 * kth / (self.norm * size[live]))      # squared distance of the k-th best; endless before there are k
            leaf = turn[live, step]
            on = gap[live, leaf] <= limit * true2 + TIE
            live, leaf, true2, kth = live[on], leaf[on], true2[on], kth[on]
            if not len(live):
                break
            order = np.argsort(leaf, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(leaf[order])) + 1):
                a, b = self.bounds[leaf[at[0]]]
                q = live[at]
                away = ((points[q] ** 2).sum(axis=1)[:, None] + self.squares[a:b] - 2 * points[q] @ self.points[a:b].T)
                near = (away <= (limit * true2[at] + TIE_PROJECTED)[:, None]) & (self.ids[a:b] != query_ids[q][:, None])
                s = np.where(near, queries[q] @ self.vectors[a:b].T, -np.inf)
                good, place = np.nonzero(s >= np.maximum(kth[at] - TIE, -MOST)[:, None])
                found.append((q[good], a + place, s[good, place]))
                both = np.concatenate([best[q], s], axis=1)
                best[q] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        who, place, score = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))
        keep = score >= best[who].min(axis=1) - TIE if len(who) else np.empty(0, bool)
        who, place = who[keep], place[keep]
        exact = np.concatenate([(self.vectors[place[x:x + 65_536]] * queries[who[x:x + 65_536]]).sum(axis=1) for x in range(0, len(who), 65_536)] or [np.empty(0)])   # equal vectors score equally
        order = np.lexsort((self.ids[place], -exact, who))
        cuts = np.searchsorted(who[order], np.arange(n + 1))
        return [(self.ids[place[some]], exact[some]) for some in (order[x:min(y, x + k)] for x, y in zip(cuts, cuts[1:]))]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy()
    return out


def nearest(df: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS,
            certainty: float = CERTAINTY, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by ``every``."""
    spark = df.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    largest_component = F.array_max(F.transform(F.col("v"), F.abs))
    norm = F.sqrt(F.aggregate(F.col("v"), F.lit(0.0), lambda acc, x: acc + (x / F.col("m")) * (x / F.col("m"))))      # over m, so 1 or more
    folder = scratch_path(spark, "vectors")
    (df.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).withColumn("m", largest_component)
     .filter("id IS NOT NULL AND m > 0 AND NOT isnan(m) AND m < double('infinity') AND NOT exists(v, x -> x IS NULL)")
     .withColumn("norm", norm).write.parquet(folder))
    rows = spark.read.parquet(folder)
    stats = rows.agg(F.count("*").alias("n"), F.sum((F.col("id") % every == 0).cast("long")).alias("q"), F.max("m").alias("m"), F.max(F.size("v")).alias("width")).first()
    shift = frexp(stats["m"] or 1.0)[1] - 1
    largest = rows.agg(F.max(F.col("m") / F.lit(ldexp(1.0, shift)) * F.col("norm"))).first()[0]
    width, limit = stats["width"], chi_square_quantile(certainty, dimensions)
    shards, blocks = max(1, -(-stats["n"] // shard_rows)), max(1, -(-(stats["q"] or 0) // block_queries))

    def deal(number: int, seed: int):
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(number)).cast("int")

    def to_all(number: int):
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    candidates = rows.select(deal(shards, 1).alias("shard"), to_all(blocks).alias("block"), "id", "v")
    # other names than the candidates': with the same columns on both sides Spark drops the queries' ones where not all of the result is read
    queries = rows.filter(F.col("id") % every == 0).select(to_all(shards).alias("shard"), deal(blocks, 2).alias("block"), F.col("id").alias("asked"), F.col("v").alias("query"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        asked, ids, scores, scaled = [], [], [], []
        if left.num_rows and right.num_rows:
            tree = ProjectedTree(left.column("id").to_numpy(), np.ldexp(_matrix(left.column("v"), width), -shift), largest, dimensions)
            ask = _matrix(right.column("query"), width)
            query_ids = right.column("asked").to_numpy()
            order = np.lexsort((*ask.T[::-1], query_ids))
            first = np.concatenate(([True], query_ids[order][1:] != query_ids[order][:-1]))
            for some in np.array_split(order[first], -(-len(order[first]) // QUERIES_AT_ONCE)):
                own = np.frexp(np.abs(ask[some]).max(axis=1))[1] - 1
                for i, scale, (found, score) in zip(some.tolist(), own.tolist(), tree.search(query_ids[some], np.ldexp(ask[some], -own[:, None]), k, limit)):
                    asked.append(np.full(len(found), query_ids[i]))
                    ids.append(found)
                    scaled.append(score)
                    with np.errstate(over="ignore", under="ignore"):
                        scores.append(np.ldexp(score, shift + scale))
        return pa.table({"query_id": pa.array(np.concatenate(asked) if asked else [], pa.int64()), "vec_id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
                         "score": pa.array(np.concatenate(scores) if scores else [], pa.float64()), "scaled": pa.array(np.concatenate(scaled) if scaled else [], pa.float64())})

    found = (candidates.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
             .applyInArrow(search, "query_id long, vec_id long, score double, scaled double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("scaled"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
