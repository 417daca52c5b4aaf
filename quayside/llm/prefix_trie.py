"""Prefix trie of conversations by union-find over sorted neighbours (operator 11).

A conversation is the sequence of its turns; a turn is known by a 128-bit hash of role and text
and by its size in bytes.  The sequences are sorted over range shards, so conversations with a
common prefix are neighbours, and the longest common prefix (LCP) of two neighbours is an edge.
Within a shard the edges are united in descending depth: every merge of components at depth d
makes (or widens) the branching node at depth d, and the depths between a component's own node
and the merge are a chain of nodes with one child each.

Shards meet at their ends.  A node is open if its component touches an end of its shard and its
depth is within the LCP across that border; all other nodes are complete.  Each shard's forest
is contracted to its open nodes, and the open nodes of one prefix in neighbouring shards are merged by
(first shard, depth).  Every figure of a node is a sum or a minimum over its shards: a child is counted where it
begins, a childless node where it ends, and the last text's bytes are taken off once, where the
node begins.  So a prefix that a third of all conversations share costs each shard one row.

Memory: a task holds one shard (8 + 24 bytes a turn, and its nodes); a conversation's
hashes stand in one row, so one of five million turns is a row of 120 MB.  The driver gets four
numbers per shard.  The digest of a node's ends is taken over a stream of sorted chunks.

Contract: turns are ordered by turn (nulls first), then role, then text; null role or text is empty;
rows without conv_id take no part; repeated rows are turns of their own; whole texts are
hashed, whatever their length; an empty table gives no nodes; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import scratch_path

TURN = "struct<h1:bigint,h2:bigint,n:int>"
NODE = ("shard int, owner int, parent_owner int, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends string")
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
CLOSED, OPEN, BEGUN = 0, 1, 2          # a node complete in its shard, one that begins there and goes on, one that began before
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, seq): the turns of every conversation, as hashes and sizes, in order."""
    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    turns = (df.filter(F.col(conv_col).isNotNull())
             .select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), given(role_col).alias("role"), given(text_col).alias("text")))
    # the sort of a window spills, so texts of a long conversation are never held together
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    turn = F.struct(F.col("pos"), F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(1), "role", "text").alias("h2"), F.octet_length("text").alias("n"))
    return (turns.withColumn("pos", F.row_number().over(order)).select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda t: F.struct(t["h1"].alias("h1"), t["h2"].alias("h2"), t["n"].alias("n"))).alias("seq")))


def rebuilt(convs: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c with its first h turns (h = crc32(c) mod ``heads``) replaced by those of conversation c - c % ``every``."""
    convs = written(convs, "conversations")      # read twice
    base = convs.select(F.col("conv_id").alias("base"), F.slice("seq", 1, heads - 1).alias("head"))   # at most heads - 1 turns a row
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = convs.withColumn("h", h).withColumn("of", F.col("conv_id") - F.col("conv_id") % every)
    joined = own.join(base, F.col("of") == F.col("base"), "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(f"array<{TURN}>"))
    tail = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, tail).alias("seq"))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.size(a)).otherwise(differs - 1).cast("int")


def neighbour_lcps(start: np.ndarray, size: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """LCP of each sequence and the next one."""
    out = np.zeros(max(0, len(size) - 1), np.int64)
    least, live, d = np.minimum(size[:-1], size[1:]), np.arange(len(out)), 0
    while len(live):
        live = live[least[live] > d]
        a, b = start[live] + d, start[live + 1] + d
        live = live[(h1[a] == h1[b]) & (h2[a] == h2[b])]
        d += 1
        out[live] = d
    return out


class Forest:
    """Nodes of one shard's sorted sequences; left, right: LCP across its borders (-1 at the ends of the table)."""

    def __init__(self, conv: np.ndarray, start: np.ndarray, size: np.ndarray, nbytes: np.ndarray, lcp: np.ndarray, left: int, right: int):
        self.start, self.nbytes, self.left, self.right, self.last = start.tolist(), nbytes, left, right, len(conv) - 1
        self.nodes: list[list] = []     # [depth, open at left, open at right, conv, parent conv or None, state of the parent, n, children, leaves, saved, ends]
        self.parent = list(range(len(conv)))
        conv, size = conv.tolist(), size.tolist()
        # a component: first row, last row, depth of its node, smallest conv, children, children that begin here, leaves, saved, ends, nodes below
        self.part: list = [[i, i, size[i], conv[i], 0, 0, 0, 0, [conv[i]], []] for i in range(len(conv))]
        depths = lcp.tolist()
        for i in np.argsort(-lcp, kind="stable").tolist():
            self.unite(self.find(i), self.find(i + 1), depths[i])
        if conv:
            self.raise_to(self.part[self.find(0)], -1)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def unite(self, i: int, j: int, depth: int) -> None:
        a, b = self.part[i], self.part[j]
        for x in (a, b):
            if x[2] > depth:
                self.raise_to(x, depth)
        if len(a[8]) + len(a[9]) < len(b[8]) + len(b[9]):     # the longer lists take in the shorter ones
            i, j, a, b = j, i, b, a
        a[0], a[1], a[3] = min(a[0], b[0]), max(a[1], b[1]), min(a[3], b[3])
        for k in (4, 5, 6, 7):
            a[k] += b[k]
        a[8] += b[8]
        a[9] += b[9]
        self.parent[j], self.part[j] = i, None

    def raise_to(self, c: list, depth: int) -> None:
        """Add the component's node and the chain above it, down to depth + 1; the component then stands at ``depth`` as its only child."""
        first, last, d, conv, below, here, leaves, saved, ends, tops = c
        n, at = last - first + 1, self.start[first] - 1
        while d > depth:
            begun, goes_on = first == 0 and d <= self.left, last == self.last and d <= self.right
            size = int(self.nbytes[at + d]) if d else 0
            leaves += below == 0 and not goes_on
            saved += n * size - (0 if begun else size)
            state = BEGUN if begun else OPEN if goes_on else CLOSED
            for k in tops:
                self.nodes[k][4], self.nodes[k][5] = None if state else conv, state
            tops = [len(self.nodes)]
            self.nodes.append([d, begun, goes_on, conv, None, CLOSED, n, here, leaves, saved, ",".join(map(str, sorted(ends))) if ends else ""])
            below, here, ends, d = 1, 0 if begun else 1, [], d - 1
        c[2:] = [d, conv, below, here, leaves, saved, ends, tops]


def owners(shard: int, depth: np.ndarray, begun: np.ndarray, span: np.ndarray) -> np.ndarray:
    """First shard of each node of ``shard``: the last one at or before it that the prefix doesn't both fill and enter from the left.

    span: by shard, the depth up to which it does."""
    out = np.full(len(depth), shard, np.int64)
    for d in np.unique(depth[begun]).tolist():
        out[begun & (depth == d)] = np.flatnonzero(span[:shard] < d)[-1]
    return out


def trie_nodes(convs: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct prefix of the sequences of ``convs`` (conv_id, seq)."""
    spark = convs.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, shard, np.int32)), pa.array(np.arange(at, at + n)), *batch.columns], ["shard", "at", *batch.schema.names])
            at += n

    order = ["seq", "conv_id"]
    # written, since a range exchange reads its input once for the sample and once for the sort
    ranged = written(convs.select(*order), "sequences").repartitionByRange(*([shards] if shards else []), *order).sortWithinPartitions(*order)
    rows = written(ranged.mapInArrow(number, f"shard int, at long, seq array<{TURN}>, conv_id long"), "trie-sorted")
    ends = rows.groupBy("shard").agg(F.min(F.struct("at", "seq")).alias("first"), F.max(F.struct("at", "seq")).alias("last"))
    before = Window.orderBy("shard")            # one row per shard, that is per task
    border = (ends.select("shard", common_prefix(F.col("first.seq"), F.col("last.seq")).alias("inner"),
                          common_prefix(F.lag("last.seq").over(before), F.col("first.seq")).alias("left"))
              .select("shard", "inner", F.coalesce("left", F.lit(-1)).alias("left")).orderBy("shard").collect())
    place = {r["shard"]: i for i, r in enumerate(border)}
    left = np.array([r["left"] for r in border], np.int64)
    right = np.append(left[1:], -1)
    span = np.minimum(left, np.array([r["inner"] for r in border], np.int64))
    shared = spark.sparkContext.broadcast((place, left, right, span))     # four numbers per shard

    def forest(key: tuple, table: pa.Table) -> pa.Table:
        place, left, right, span = shared.value
        shard = place[key[0].as_py()]
        table = table.sort_by("at")
        seq = table.column("seq").combine_chunks()
        flat = seq.flatten()
        size = np.diff(seq.offsets.to_numpy())
        start = np.cumsum(size) - size
        h1, h2, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        nodes = Forest(table.column("conv_id").to_numpy(), start, size, n, neighbour_lcps(start, size, h1, h2), int(left[shard]), int(right[shard])).nodes
        depth, begun, goes_on, conv, up, up_is, n_convs, children, leaves, saved, texts = map(list, zip(*nodes))
        depth, begun, up_is = np.array(depth), np.array(begun), np.array(up_is)
        is_open = begun | np.array(goes_on)
        texts = [t if o else hashlib.sha256(t.encode()).hexdigest() if t else EMPTY_SHA for t, o in zip(texts, is_open.tolist())]
        numbers = [pa.array(x, pa.int64()) for x in (conv, up, n_convs, children, leaves, saved)]
        return pa.Table.from_arrays([
            pa.array(np.full(len(depth), shard, np.int32)), pa.array(owners(shard, depth, begun, span).astype(np.int32), mask=~is_open),
            pa.array(owners(shard, depth - 1, up_is == BEGUN, span).astype(np.int32), mask=up_is == CLOSED), pa.array(depth.astype(np.int32)),
            *numbers, pa.array(texts, pa.string())], NODE_NAMES)

    nodes = written(rows.groupBy("shard").applyInArrow(forest, NODE), "trie-nodes")
    part = nodes.filter("owner IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    whole = part.groupBy("owner", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("parent_owner").alias("parent_owner"), *sums)
    digests = (part.filter("ends <> ''").select("owner", "depth", "shard", "ends").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "shard")
               .mapInArrow(digest_chunks, "owner int, depth int, ends string"))
    whole = written(whole.join(digests, ["owner", "depth"], "left").withColumn("ends", F.coalesce("ends", F.lit(EMPTY_SHA))), "trie-open")
    name = whole.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("named"))
    # a shard's nodes look their parents up among the open nodes of the same shard, so that no prefix makes a hot key
    here = part.select("shard", F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth")).join(name, ["parent_owner", "depth"])
    columns = ["conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "named").alias("parent_conv_id"),
               "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    inner = nodes.filter("owner IS NULL AND parent_owner IS NULL").withColumn("named", F.lit(None).cast("long"))
    tops = nodes.filter("owner IS NULL AND parent_owner IS NOT NULL").join(here, ["shard", "parent_owner", "depth"])
    merged = whole.withColumn("parent_conv_id", F.lit(None).cast("long")).join(name, ["parent_owner", "depth"], "left")
    return inner.select(*columns).unionByName(tops.select(*columns)).unionByName(merged.select(*columns))


def digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks in a row, joined by commas; rows are sorted by node and shard."""
    node, sha = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int32()), pa.array([node[1]], pa.int32()), pa.array([sha.hexdigest()])], ["owner", "depth", "ends"])

    for batch in batches:
        for owner, depth, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
            if (owner, depth) == node:
                sha.update(b",")
            else:
                if node:
                    yield done()
                node, sha = (owner, depth), hashlib.sha256()
            sha.update(text.as_buffer())
    if node:
        yield done()


def last_turns(nodes: DataFrame, df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes of ``trie_nodes(sequences(df))`` with role and text of their last turn (the root has none)."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first(turn_col), F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit("")))
    turns = (df.withColumn("conv_id", F.col(conv_col).cast("long")).withColumn("depth", F.row_number().over(order).cast("long"))
             .select("conv_id", "depth", F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")))
    return nodes.join(turns, ["conv_id", "depth"], "left")


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(x ORDER BY pos) AS seq FROM t GROUP BY conv_id),
bits AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS digits FROM own),
-- CRC-32 of the decimal digits: for each byte eight steps, folded over the list of characters
crc AS (
  SELECT conv_id, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(digits, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))) AS code FROM bits),
heads AS (SELECT o.*, code % 9 AS h FROM own o JOIN crc USING (conv_id)),
rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.seq, [])[1:a.h], a.seq[a.h + 1:]) AS seq
  FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
path AS (SELECT conv_id, unnest(range(0, len(seq) + 1)) AS depth, seq FROM rebuilt),
keyed AS (SELECT conv_id, depth, seq[1:depth] AS prefix, len(seq) AS size, CASE WHEN depth > 0 THEN strlen(seq[depth].t) ELSE 0 END AS bytes FROM path),
named AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS node FROM keyed),
nodes AS (
  SELECT node, depth, any_value(bytes) AS bytes, count(*) AS n_convs, bool_and(size = depth) AS childless,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM named GROUP BY node, depth),
-- the ancestors of a node (itself included) are the nodes on its smallest member's path
above AS (SELECT n.node, n.depth, p.node AS top, p.depth AS top_depth FROM nodes n JOIN named p ON p.conv_id = n.node AND p.depth <= n.depth),
sums AS (
  SELECT top, top_depth, sum(CASE WHEN n.childless THEN 1 ELSE 0 END) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens,
    sum(CASE WHEN n.depth = top_depth + 1 THEN 1 ELSE 0 END) AS n_children
  FROM above JOIN nodes n USING (node, depth) GROUP BY top, top_depth)
SELECT n.node AS conv_id, n.depth AS depth, p.top AS parent_conv_id, n.n_convs, CAST(s.n_children AS BIGINT) AS n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.top = n.node AND s.top_depth = n.depth LEFT JOIN above p ON p.node = n.node AND p.depth = n.depth AND p.top_depth = n.depth - 1
"""
