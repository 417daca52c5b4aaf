"""Token files of directly addressable codes (operator 6).

An id is split into chunks of eight bits, lowest first.  Level k of a segment holds the k-th
chunk of every id that has one, a bitmap that tells which of them go on at level k + 1, and a
rank directory (ones before each block of bits), so that the place of an id's next chunk is
the rank of its bit: any token, or any stretch of tokens, is read without decoding others.

A corpus is written as rows of Parquet files, one per segment: the shard (range of document
ids) and place of the segment, its documents and where they start, and the codes.  Segments
close at the first document end after ``SEGMENT_TOKENS`` tokens, so a task holds one segment.

Contract: null and empty text have the end id only; documents stand in ascending id order,
null ids first, equal ids by text; repeated rows are written as they come; an empty table gives
no segment; other columns of the input play no part.  Whole texts are encoded; a very long one makes a
segment of its own, which a task holds with its ids (4 bytes a token).
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.texts import slices, texts_of
from quayside.llm.vocab import load_byte_bpe

SEGMENT_TOKENS = 1 << 18
BLOCK = 512                     # bits between two entries of a rank directory
MAGIC = b"DAC1"
ROW_CHUNKS = 1_000              # chunks of text the library gets in one row
GROUP_BYTES = 8 << 20           # text encoded together
RANGE_CHARS = 64                # of a text, so that rows without an id, or with the same one, are dealt over shards


def dac_encode(ids: np.ndarray) -> bytes:
    """Codes of an array of unsigned 32-bit ids."""
    out, rest = [MAGIC], np.asarray(ids, np.uint32)
    while len(rest):
        go_on = rest > 0xFF
        bits = np.packbits(go_on, bitorder="little")
        before = np.concatenate(([0], np.cumsum(np.add.reduceat(go_on, np.arange(0, len(rest), BLOCK), dtype=np.int64))))
        out += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), before.astype("<u8").tobytes()]
        rest = rest[go_on] >> 8
    return b"".join(out) + struct.pack("<Q", 0)


class DacReader:
    """Random access to the ids of one segment."""

    def __init__(self, codes: bytes):
        if codes[:4] != MAGIC:
            raise ValueError("no directly addressable codes")
        self.levels, at = [], 4
        while n := struct.unpack_from("<Q", codes, at)[0]:
            at += 8
            level = []
            for kind, size in ((np.uint8, n), (np.uint8, -(-n // 8)), ("<u8", -(-n // BLOCK) + 1)):
                level.append(np.frombuffer(codes, kind, size, at))
                at += level[-1].nbytes
            self.levels.append(level)

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    @staticmethod
    def _rank(bits: np.ndarray, before: np.ndarray, i: int) -> int:
        """Ones before bit i: the directory's entry and what its block has up to i."""
        block = i // BLOCK
        return int(before[block]) + int(np.unpackbits(bits[block * BLOCK // 8:-(-i // 8)], bitorder="little", count=i - block * BLOCK).sum())

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop - 1."""
        value = np.zeros(stop - start, np.uint32)
        held = np.arange(stop - start)          # the ids that have a chunk on this level
        for k, (chunks, bits, before) in enumerate(self.levels):
            if start == stop:
                break
            value[held] |= chunks[start:stop].astype(np.uint32) << np.uint32(8 * k)
            byte = start // 8
            go_on = np.unpackbits(bits[byte:-(-stop // 8)], bitorder="little")[start - 8 * byte:stop - 8 * byte]
            start = self._rank(bits, before, start)
            stop = start + int(go_on.sum())
            held = held[go_on.view(bool)]
        return value

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        return int(self.read(i, i + 1)[0])


class Library:
    """The tokenizers library on one vocabulary file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _library(path: str) -> Library:
    return Library(path)


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``start``, one after another."""
    stop = np.cumsum(size)
    return values[np.repeat(start - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]


class WordIds:
    """Ids of words that follow a blank: ``words`` in an Arrow array, their ids one after another.  At most ``limit`` words are kept."""

    def __init__(self, path: str, limit: int = 1_000_000):
        self.cache, self.limit = _library(path), limit
        self.size_of = np.array([len(x) for x in load_byte_bpe(path).labels], np.int64)
        self.clear()

    def clear(self) -> None:
        self.words, self.ids, self.size = pa.array([], pa.string()), np.empty(0, np.uint32), np.empty(0, np.int64)

    def learn(self, words: pa.Array) -> np.ndarray:
        """Adds distinct words; their places.  Those without white space at their ends read the same in a row as alone, and go to the library in long
        rows; the bytes of the tokens tell which are whose."""
        odd = pc.or_(pc.equal(words, ""), pc.or_(pc.not_equal(words, pc.utf8_trim_whitespace(words)), pc.match_substring_regex(words, r"^[\x1c-\x1f]|[\x1c-\x1f]$")))
        rest, alone = words.filter(pc.invert(odd)), words.filter(odd)
        found, sizes = [], []
        for at in range(0, len(rest), ROW_CHUNKS):
            some = rest.slice(at, ROW_CHUNKS)
            ids = np.array(self.cache.encode(" " + " ".join(some.to_pylist())), np.uint32)
            stops = np.searchsorted(np.cumsum(self.size_of[ids]), np.cumsum(pc.binary_length(some).to_numpy().astype(np.int64) + 1)) + 1
            found.append(ids)
            sizes.append(np.diff(stops, prepend=0))
        for word in alone.to_pylist():
            found.append(np.array(self.cache.encode(" " + word), np.uint32))
            sizes.append(np.array([len(found[-1])]))
        place, is_odd = np.empty(len(words), np.int64), odd.to_numpy(zero_copy_only=False)
        place[~is_odd], place[is_odd] = len(self.words) + np.arange(len(rest)), len(self.words) + len(rest) + np.arange(len(alone))
        self.words = pa.concat_arrays([self.words, rest, alone])
        self.ids, self.size = np.concatenate([self.ids, *found]), np.concatenate([self.size, *sizes])
        return place

    def get(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each of the distinct words' ids begin in ``ids``, and how many they are."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        new = at < 0
        if new.any():
            if len(self.words) + int(new.sum()) > self.limit:
                self.clear()
                new[:] = True
            at[new] = self.learn(words.filter(pa.array(new)))
        return (np.cumsum(self.size) - self.size)[at], self.size[at]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


#: A word of letters with one of these marks at its end is two pre-tokens.
MARKED = r"^\p{L}+[.,;:!?]$"


def library_id_arrays(path: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row as the tokenizers library gives them, and how many each text has.

    Texts are cut at single blanks, and each distinct word is encoded once, whatever stands before and after it; the first word of a
    text, and texts with blanks in a row or special tokens, go to the library as they are."""
    table = _word_ids(path)
    special = load_byte_bpe(path).special
    plain = np.fromiter(("  " not in t and not any(s in t for s in special) for t in texts), bool, len(texts))
    split = pc.split_pattern(pa.array([t for t, ok in zip(texts, plain.tolist()) if ok], pa.string()), " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    coded = split.values.dictionary_encode()
    # stems and marks stand for the words that have both
    distinct = coded.dictionary
    marked = pc.match_substring_regex(distinct, MARKED)
    stem = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct).dictionary_encode()
    start, size = table.get(stem.dictionary)
    ids = table.ids
    marks = pc.if_else(marked, pc.utf8_slice_codeunits(distinct, -1), "").dictionary_encode()
    # a mark alone, the first words of texts, and the texts that are no row of words
    others = [*marks.dictionary.to_pylist(), *split.values.take(pa.array(bounds[:-1])).to_pylist(), *(t for t, ok in zip(texts, plain.tolist()) if not ok)]
    other_ids = [np.array(table.cache.encode(t), np.uint32) for t in others]
    other_size = np.fromiter(map(len, other_ids), np.int64, len(others))
    start, size = np.concatenate([start, len(ids) + np.cumsum(other_size) - other_size]), np.concatenate([size, other_size])
    ids = np.concatenate([ids, *other_ids])
    stems, mark = stem.indices.to_numpy().astype(np.int64), len(stem.dictionary) + marks.indices.to_numpy().astype(np.int64)
    # pieces of all texts in a row: two for each word (the mark may be empty), one for each first word and each text as it is
    word = coded.indices.to_numpy().astype(np.int64)
    pieces = np.column_stack([stems[word], mark[word]])
    first = len(stem.dictionary) + len(marks.dictionary)
    empty = len(start)
    start, size = np.append(start, 0), np.append(size, 0)
    pieces[bounds[:-1], 0], pieces[bounds[:-1], 1] = first + np.arange(len(split)), empty
    per_text = np.ones(len(texts), np.int64)
    per_text[plain] = 2 * np.diff(bounds)
    order = np.empty(int(per_text.sum()), np.int64)
    as_is = np.repeat(~plain, per_text)
    order[as_is], order[~as_is] = first + len(split) + np.arange(int((~plain).sum())), pieces.ravel()
    n = size[order]
    ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(per_text)))]
    return gather(ids, start[order], n), np.diff(ends)


def library_ids(path: str, texts: list[str]) -> list[bytes]:
    """Packed ids of each text as the tokenizers library gives them."""
    ids, size = library_id_arrays(path, texts)
    cut = (4 * np.concatenate(([0], np.cumsum(size)))).tolist()
    packed = ids.tobytes()
    return [packed[a:b] for a, b in zip(cut, cut[1:])]


def _groups(batches: Iterator[pa.RecordBatch], nbytes: int) -> Iterator[pa.Table]:
    """Rows in groups of about so many bytes."""
    held, size = [], 0
    for part in slices(batches, 64):
        held.append(part)
        size += part.nbytes
        if size >= nbytes:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def write_token_files(df: DataFrame, path: str, out: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                      segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text, append ``end_id`` and write the segments under ``out``."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []          # document ids, their sizes, their token ids

        def close() -> pa.RecordBatch:
            nonlocal segment, first, held
            stops = np.cumsum(np.concatenate([size for _, size, _ in held]))
            docs = pa.concat_arrays([i for i, _, _ in held])
            batch = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([first], pa.int64()), pa.array([int(stops[-1])], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                pa.ListArray.from_arrays(pa.array([0, len(stops) + 1], pa.int32()), pa.array(np.concatenate(([0], stops)))),
                pa.array([dac_encode(np.concatenate([x for _, _, x in held]))], pa.binary()),
            ], ["shard", "segment", "first", "n", "ids", "bounds", "codes"])
            segment, first, held = segment + 1, first + int(stops[-1]), []
            return batch

        open_tokens = 0
        for group in _groups(batches, GROUP_BYTES):
            docs = group.column(0).combine_chunks()
            ids, size = library_id_arrays(path, texts_of(group.column(1)))
            ids = np.insert(ids, np.cumsum(size), end_id)                 # one after each document
            stops = np.cumsum(size + 1)
            at, done = 0, 0                                               # documents and ids of the group that are dealt with
            while at < len(size):
                # the first document end at or after the segment's size
                to = min(int(np.searchsorted(stops, done + segment_tokens - open_tokens)) + 1, len(size))
                held.append((docs.slice(at, to - at), size[at:to] + 1, ids[done:int(stops[to - 1])]))
                open_tokens += int(stops[to - 1]) - done
                at, done = to, int(stops[to - 1])
                if open_tokens >= segment_tokens:
                    yield close()
                    open_tokens = 0
        if held:
            yield close()

    (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
     .repartitionByRange("id", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("id", "text")
     .mapInArrow(run, f"shard int, segment int, first long, n long, ids array<{kind}>, bounds array<long>, codes binary")
     .write.parquet(out))


def read_documents(spark: SparkSession, out: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files under ``out``; start
    counts the ids of all documents before it."""
    files = spark.read.parquet(out)
    kind = files.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 1):
            shard, first, ids, bounds, codes = (part.column(i)[0] for i in range(5))
            reader, cut = DacReader(codes.as_py()), bounds.as_py()
            packed = memoryview(reader.read(0, cut[-1]).astype("<u4").tobytes())       # the documents are one stretch
            crc = [zlib.crc32(packed[4 * a:4 * b]) for a, b in zip(cut, cut[1:])]
            n = len(cut) - 1
            yield pa.RecordBatch.from_arrays([
                pa.array([shard.as_py()] * n, pa.int32()), ids.values, pa.array(np.array(cut[:-1], np.int64) + first.as_py()),
                pa.array(np.diff(cut), pa.int64()), pa.array(crc, pa.int64()),
            ], ["shard", "id", "start", "n_tokens", "ids_crc32"])

    docs = files.select("shard", "first", "ids", "bounds", "codes").mapInArrow(run, f"shard int, id {kind}, start long, n_tokens long, ids_crc32 long")
    # one row per shard, that is per task of the write: small enough for one task and to broadcast
    totals = files.groupBy("shard").agg(F.sum("n").alias("tokens"))
    before = totals.select("shard", (F.sum("tokens").over(Window.orderBy("shard")) - F.col("tokens")).alias("before"))
    return docs.join(F.broadcast(before), "shard").select(F.col("id").alias(id_col), (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
