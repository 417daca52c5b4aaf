"""Benchmark decontamination with suffix arrays of the training text (operator 12).

Documents become arrays of word codes, a shard of about ``SHARD_WORDS`` words at a time.  A shard
gets a suffix array (by prefix doubling) over its suffixes that can begin a match; every suffix of
the benchmark is binary-searched in it, three words a step.  That gives all occurrences of the
benchmark's windows, with their places, and the longest verbatim match of every test suffix.
Suffixes that can't matter are never sorted: a window of n words is n - 1 word pairs of the
benchmark in a row, and only such runs are indexed.

A window is ``window`` consecutive words of an item; a shorter item is one window.  Words are runs
of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.

The benchmark is cut into pieces of at most ``PIECE_WORDS`` words (which overlap, so no window
is lost), equal pieces are one, and blocks of about ``BLOCK_WORDS`` words are broadcast; documents
go through one pass per block, all in one stage.  A block's bound is proven by its count; a larger
benchmark makes more blocks, never larger ones.  Documents are not shuffled.

Contract: a null or empty text has no words; items without an id or without words take no part;
rows with the same item id are one item; repeated documents are judged one by one; whole texts
count, a very long one makes a shard of its own; empty tables give empty results or no hits; extra
columns are kept by ``remove_contaminated`` and play no part elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import IntTable, slices
from quayside.session import scratch_path

WINDOW = 10
SHARD_WORDS, BLOCK_WORDS, PIECE_WORDS = 1 << 21, 1 << 20, 1 << 12
STEP = 3                            # words in one search key: codes have 21 bits
SPANS = "array<struct<start:int,stop:int>>"
_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


class TestSuffixes:
    """The suffixes of one block of benchmark pieces. pieces: (words, ids of the items that have them)."""

    __test__ = False

    def __init__(self, pieces: list[tuple[list[bytes], list[str]]], window: int):
        self.window, self.items = window, [ids for _, ids in pieces]
        size = np.array([len(w) for w, _ in pieces], np.int64)
        self.vocab = {w: i + 1 for i, w in enumerate(sorted({w for words, _ in pieces for w in words}))}
        self.base = np.int64(len(self.vocab) + 1)
        flat = np.fromiter((self.vocab[w] for words, _ in pieces for w in words), np.int64, int(size.sum()))
        self.longest = int(size.max(initial=0))
        start = np.cumsum(size) - size
        self.piece = np.repeat(np.arange(len(size)), size)
        self.left = (start + size)[self.piece] - np.arange(len(flat))          # words from each suffix's start to its piece's end
        self.codes = np.concatenate([flat, np.zeros(max(window, self.longest) + STEP, np.int64)])
        pair = flat[:-1] << 32 | flat[1:]
        self.pairs = IntTable(keys := np.unique(pair[self.left[:-1] > 1]), np.ones(len(keys), np.int32), missing=0)
        # windows: where they begin and how long they are
        self.length = np.minimum(window, size[self.piece])
        at = np.flatnonzero(self.left >= self.length)
        n = self.length[at]
        short = at[n < window]
        self.single = np.zeros(int(self.base), bool)
        self.single[flat[short[self.length[short] == 1]]] = True
        first = short[self.length[short] > 1]
        self.first_pairs = IntTable(keys := np.unique(pair[first]), np.ones(len(keys), np.int32), missing=0) if len(first) else None
        words = np.where(np.arange(window) < n[:, None], self.codes[at[:, None] + np.arange(window)], 0)
        self.windows, kind = np.unique(words, axis=0, return_inverse=True) if len(at) else (words, at)
        self.window_size = (self.windows > 0).sum(axis=1)
        pairs = np.unique(np.column_stack([kind.ravel(), self.piece[at]]), axis=0)
        self.window_pieces = pairs[:, 1]
        self.window_bounds = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))

    def runs(self, codes: np.ndarray) -> np.ndarray:
        """Whether each word of a shard may lie in a window's occurrence."""
        keep = np.zeros(len(codes) + self.window, bool)
        if len(codes) > 1:
            both = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
            key = codes[both] << 32 | codes[both + 1]
            hit = np.zeros(len(codes) + 1, np.int8)
            hit[both + 1] = self.pairs.get(key) > 0        # shifted by one, so that every run has a border
            edge = np.flatnonzero(np.diff(hit))            # a run of pairs from edge[2i] on and up to edge[2i + 1]
            a, b = edge[::2], np.append(edge[1::2], len(codes) - 1)[:len(edge[::2])]
            a, b = a[b - a >= self.window - 1], b[b - a >= self.window - 1]
            if self.first_pairs is not None:
                more = both[self.first_pairs.get(key) > 0]
                a, b = np.concatenate([a, more]), np.concatenate([b, more + self.window - 1])
            step = np.zeros(len(keep) + 1, np.int64)
            np.add.at(step, a, 1)
            np.add.at(step, b + 1, -1)
            keep = np.cumsum(step)[:-1] > 0
        keep = keep[:len(codes)]
        return keep | self.single[codes]


class SuffixArray:
    """Sorted suffixes of a shard's runs, in the order of their first ``depth`` words at least.

    codes: the shard's words, 0 for words the benchmark lacks and between documents."""

    def __init__(self, codes: np.ndarray, keep: np.ndarray, base: np.int64, depth: int):
        at = np.flatnonzero(keep)
        cut = np.flatnonzero(np.diff(at, prepend=-2) > 1)                          # a separator before every run
        self.at = np.insert(at, cut, -1)
        text = np.concatenate([np.where(self.at >= 0, codes[self.at], 0), np.zeros(depth + 2 * STEP, np.int64)])
        self.base, n = base, len(self.at)
        self.keys = (text[:-2] * base + text[1:-1]) * base + text[2:]
        rank, reach = self._ranks(self.keys[:n]), STEP
        while reach < depth and n and rank.max() < n - 1:
            after = np.zeros(n, np.int64)
            after[:n - reach] = rank[reach:] + 1
            rank, reach = self._ranks(rank * (n + 1) + after), 2 * reach
        self.order = np.argsort(rank, kind="stable")

    @staticmethod
    def _ranks(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        out = np.empty(len(keys), np.int64)
        out[order] = np.cumsum(np.diff(keys[order], prepend=keys[order[:1]]) != 0)
        return out

    def narrow(self, low: np.ndarray, high: np.ndarray, offset: int, bound: np.ndarray) -> np.ndarray:
        """First place in each [low, high) whose key ``offset`` words on is ``bound`` or more: a binary search of all at once."""
        low, high = low.copy(), high.copy()
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) >> 1
            less = self.keys[self.order[mid] + offset] < bound[live]
            low[live[less]] = mid[less] + 1
            high[live[~less]] = mid[~less]
            live = live[low[live] < high[live]]
        return low

    def key(self, words: np.ndarray) -> np.ndarray:
        return (words[:, 0] * self.base + words[:, 1]) * self.base + words[:, 2]

    def find(self, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[low, high) of the suffixes that begin with each row's first ``size`` words."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), len(self.order))
        for offset in range(0, words.shape[1], STEP):
            part = np.zeros((len(words), STEP), np.int64)
            part[:, :words.shape[1] - offset] = words[:, offset:offset + STEP]
            held = np.clip(size - offset, 0, STEP)                                  # words of this step that count
            bound = self.key(np.where(np.arange(STEP) < held[:, None], part, 0))
            up = bound + np.where(held == STEP, 1, np.where(held == 2, self.base, np.where(held == 1, self.base * self.base, self.base**3)))
            low, high = self.narrow(low, high, offset, bound), self.narrow(low, high, offset, up)
        return low, high

    def longest(self, test: TestSuffixes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of each test suffix, and where in the shard it is (-1: none)."""
        size, place = np.zeros(len(starts), np.int64), np.full(len(starts), -1)
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.order))
        live, offset = np.arange(len(starts) if len(self.order) else 0), 0
        while len(live):
            words = test.codes[starts[live] + offset][:, None] if STEP == 1 else test.codes[(starts[live] + offset)[:, None] + np.arange(STEP)]
            bound = self.key(words)
            a = self.narrow(low[live], high[live], offset, bound)
            b = self.narrow(a, high[live], offset, bound + 1)
            for side in (a, a - 1):                        # the neighbours of the place where the suffix would stand
                inside = np.flatnonzero((side >= low[live]) & (side < high[live]))
                found = self.order[side[inside]]
                key = self.keys[found + offset]
                same = np.stack([key // self.base**(STEP - 1 - k) for k in range(STEP)], axis=1) == np.stack([bound[inside] // self.base**(STEP - 1 - k) for k in range(STEP)], axis=1)
                n = np.minimum(offset + same.sum(axis=1), test.left[starts[live[inside]]])
                better = n > size[live[inside]]
                size[live[inside[better]]], place[live[inside[better]]] = n[better], self.at[found[better]]
            low[live], high[live] = a, b
            offset += STEP
            live = live[(a < b) & (test.left[starts[live]] > offset)]
        return size, place


def _blocks(benchmark: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> Iterator[list[tuple[list[bytes], list[str]]]]:
    """Blocks of (words, item ids) of the benchmark's distinct pieces."""
    spark = benchmark.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = []
            for item, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(text)
                rows += [(item, b" ".join(some), len(some)) for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS - window + 1)
                         if (some := words[at:at + PIECE_WORDS])]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int32()))], ["item", "words", "n"])

    path = scratch_path(spark, "benchmark-pieces")
    (benchmark.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
     .mapInArrow(cut, "item string, words binary, n int").distinct().groupBy("words", "n").agg(F.collect_list("item").alias("items")).write.parquet(path))
    pieces = spark.read.parquet(path)
    blocks = max(1, -(-(pieces.agg(F.sum("n")).first()[0] or 0) // block_words))
    for k in range(blocks):
        some = pieces if blocks == 1 else pieces.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        # about block_words words, that is what is broadcast
        yield [(bytes(r["words"]).split(b" "), r["items"]) for r in some.select("words", "items").collect()]


def _shards(batches: Iterator[pa.RecordBatch], column: int, shard_words: int) -> Iterator[tuple[list[pa.RecordBatch], list[list[bytes]]]]:
    """Record batches and the words of their texts, a shard at a time."""
    held, texts, n = [], [], 0
    for part in slices(batches):
        held.append(part)
        for text in part.column(column).cast(pa.binary()).to_pylist():
            texts.append(words_of(text))
            n += len(texts[-1]) + 1
        if n >= shard_words:
            yield held, texts
            held, texts, n = [], [], 0
    if held:
        yield held, texts


def _codes(test: TestSuffixes, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a shard, a 0 after every document, and where documents begin."""
    size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    start = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.int64)
    for at, words in zip(start.tolist(), texts):
        out[at:at + len(words)] = test.encode(words)
    return out, start


def find_windows(test: TestSuffixes, texts: list[list[bytes]]) -> tuple[dict[int, list[tuple[int, int]]], dict[int, set[int]]]:
    """By document: the spans of words inside windows' occurrences, and the pieces whose windows occur."""
    codes, start = _codes(test, texts)
    keep = test.runs(codes)
    if not keep.any():
        return {}, {}
    array = SuffixArray(codes, keep, test.base, test.window)
    low, high = array.find(test.windows, test.window_size)
    found = np.flatnonzero(high > low)
    count = (high - low)[found]
    kind = np.repeat(found, count)
    at = array.at[array.order[np.repeat(low[found] - (np.cumsum(count) - count), count) + np.arange(count.sum())]]
    # places in order give spans; those that overlap or touch are one
    stop = at + test.window_size[kind]
    order = np.argsort(at, kind="stable")
    doc = np.searchsorted(start, at, side="right") - 1
    spans: dict[int, list[tuple[int, int]]] = {}
    for d, a, b in zip(doc[order].tolist(), (at - start[doc])[order].tolist(), (stop - start[doc])[order].tolist()):
        mine = spans.setdefault(d, [])
        if mine and a <= mine[-1][1]:
            mine[-1] = (mine[-1][0], max(mine[-1][1], b))
        else:
            mine.append((a, b))
    pieces: dict[int, set[int]] = {}
    both = np.unique(doc * len(test.windows) + kind)
    for d, w in zip((both // len(test.windows)).tolist(), (both % len(test.windows)).tolist()):
        pieces.setdefault(d, set()).update(test.window_pieces[test.window_bounds[w]:test.window_bounds[w + 1]].tolist())
    return spans, pieces


def merge_spans(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x, y in sorted(a + b):
        if out and x <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], y))
        else:
            out.append((x, y))
    return out


def judged(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS, keep: list[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, spans, items): every row of ``df`` as a struct (of the columns ``keep``), its spans of hit words, and the items whose windows occur in it."""
    sc = df.sparkSession.sparkContext
    row = F.struct(*[F.col(c) for c in keep or df.columns])
    out = df.select(F.col(text_col).cast("string").alias("text"), F.lit(0).alias("n_words"), F.lit(0).alias("n_hit"),
                    F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"), row.alias("row"))
    schema = out.schema
    arrow = {"spans": pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])), "items": pa.list_(pa.string())}

    def one_pass(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test: TestSuffixes = shared.value
            for parts, texts in _shards(batches, 0, shard_words):
                spans, pieces = find_windows(test, texts)
                at = 0
                for part in parts:
                    mine = range(at, at + part.num_rows)
                    at += part.num_rows
                    had_spans, had_items = part.column(3).to_pylist(), part.column(4).to_pylist()
                    for i, d in enumerate(mine):
                        if d in spans:
                            had_spans[i] = [{"start": a, "stop": b} for a, b in merge_spans([(s["start"], s["stop"]) for s in had_spans[i]], spans[d])]
                            had_items[i] = sorted({x for p in pieces[d] for x in test.items[p]}.union(had_items[i]))
                    n_hit = [sum(s["stop"] - s["start"] for s in x) for x in had_spans]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([len(texts[d]) for d in mine], pa.int32()), pa.array(n_hit, pa.int32()),
                         pa.array(had_spans, arrow["spans"]), pa.array(had_items, arrow["items"]), part.column(5)], part.schema.names)
        return run

    for pieces in _blocks(benchmark, window, block_words, item_col, item_text_col):
        out = out.mapInArrow(one_pass(sc.broadcast(TestSuffixes(pieces, window))), schema)
    return out.select("row", "n_words", "n_hit", "spans", "items")


def contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items) of every document; spans count words from 0."""
    found = judged(df, benchmark, window, text_col, item_col, item_text_col, shard_words, block_words, [id_col])
    return found.select(F.col("row")[id_col].alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.col("n_hit").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "spans", "items")


def remove_contaminated(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df`` that hold no window of the benchmark."""
    return judged(df, benchmark, window, text_col, **kw).filter("n_hit = 0").select("row.*")


def longest_matches(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(item_id, n_words, item_at, doc_id, doc_at): each item's longest verbatim match of at least a window in all documents, and one place of it.

    Among equally long ones the first in the item counts, then the smallest document id.  Items longer than ``PIECE_WORDS`` words are
    matched within their pieces, and item_at counts from the piece's first word."""
    sc = df.sparkSession.sparkContext
    kind = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def one_pass(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            test: TestSuffixes = shared.value
            for parts, texts in _shards(batches, 1, shard_words):
                codes, start = _codes(test, texts)
                keep = test.runs(codes)
                if not keep.any():
                    continue
                array = SuffixArray(codes, keep, test.base, test.longest)
                suffix = np.flatnonzero(test.left >= test.length)
                size, place = array.longest(test, suffix)
                good = np.flatnonzero(size >= test.length[suffix])
                # a piece's best match of this shard
                order = good[np.lexsort((suffix[good], -size[good], test.piece[suffix[good]]))]
                first = order[np.flatnonzero(np.diff(test.piece[suffix[order]], prepend=-1))]
                ids = pa.chunked_array([p.column(0) for p in parts]).combine_chunks()
                doc = np.searchsorted(start, place[first], side="right") - 1
                begin = np.searchsorted(test.piece, test.piece[suffix[first]])
                rows = [(item, n, a, d, at) for piece, n, a, d, at in zip(test.piece[suffix[first]].tolist(), size[first].tolist(), (suffix[first] - begin).tolist(),
                                                                          doc.tolist(), (place[first] - start[doc]).tolist()) for item in test.items[piece]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2)),
                                                  ids.take(pa.array([r[3] for r in rows], pa.int64())), pa.array([r[4] for r in rows], pa.int64())], ["item_id", "n_words", "item_at", "doc_id", "doc_at"])
        return run

    out = None
    for pieces in _blocks(benchmark, window, block_words, item_col, item_text_col):
        found = docs.mapInArrow(one_pass(sc.broadcast(TestSuffixes(pieces, window))), f"item_id string, n_words long, item_at long, doc_id {kind}, doc_at long")
        out = found if out is None else out.unionByName(found)
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "item_at", "doc_id", "doc_at")).alias("b")
    return out.groupBy("item_id").agg(best).select("item_id", (-F.col("b.less")).alias("n_words"), "b.item_at", "b.doc_id", "b.doc_at")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
bw AS (
  SELECT DISTINCT item, CAST(least(len(words), 10) AS BIGINT) AS n, array_to_string(words[i:i + 9], ' ') AS w
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)),
found AS (SELECT dw.rid, dw.i, dw.n, bw.item FROM dw JOIN bw USING (n, w)),
hits AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM (SELECT rid, i, unnest(range(0, n)) AS k FROM (SELECT DISTINCT rid, i, n FROM found)) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""
