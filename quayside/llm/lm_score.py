"""Subword lattice likelihood (operator 7).

A document is the sequence of its words, each written with the vocabulary's word-start mark,
and one end.  Its probability under a unigram model over an existing vocabulary's pieces is
the sum over all segmentations of its lattice.  No piece spans two words, so the lattice
falls apart into word lattices: a word's marginal is computed once, by the forward recursion
in log space, and a document's log-probability is the sum over its words and its end.

The vocabulary's own scores are merge ranks, no probabilities; the piece scores are learned
here from all training words: the library's segmentation of each distinct training word,
weighed by how often it occurs, one added to each piece.  A character that is no piece is
spelled with the byte pieces.

Plan: each task turns its documents into batches of postings (a row per distinct word of the
batch, with the documents that have it packed in one binary value), written once.  Words are
counted and scored over all batches; scores go back to the postings by a join on the word,
where a frequent word has one row per batch, not one per occurrence.  Each task of the join
sums up what its words add to each document and sends one packed row per batch, and the rows
of a batch are summed to its documents.

Contract: null and blank texts are the end alone; ids that repeat give a row each; a null id
reads as the empty text in the split; an empty table gives an empty result; extra columns
play no part.  Whole texts count; the time for a word without blanks grows with its length.  Without training rows all counts are 0: N + 1 * (V + 1) is 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.langid import held_out
from quayside.llm.texts import IntTable, slices, texts_of
from quayside.session import scratch_path

START = "▁"
#: A batch is closed when it has so many distinct words, or so many words.
BATCH_WORDS, BATCH_TOKENS = 400_000, 6_000_000
#: Documents of a batch, and occurrences in one posting: both fit in 16 bits.
MOST = 1 << 16
#: Postings whose sums a task holds before it packs and sends them.
POSTINGS_HELD = 2_000_000
POSTING = np.dtype([("doc", "<u2"), ("n", "<u2")])
SUMS = np.dtype([("doc", "<u2"), ("known", "<u4"), ("tokens", "<u4"), ("base", "<f8"), ("score", "<f8")])
WORDS_AT_ONCE = 8_192
#: A word of more characters is scored by itself, in stretches of so many places.
LONG_WORD, STRETCH = 256, 1 << 16
END = ""                       # stands for the end in the postings; no word is empty


@lru_cache(maxsize=2)
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Forward recursion over all segmentations of words into a vocabulary's pieces."""

    def __init__(self, path: str, piece_logp: np.ndarray):
        library = _library(path)
        self.logp, n = piece_logp, library.get_piece_size()
        byte = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_logp = piece_logp[byte]
        children: dict[int, int] = {}
        self.depth, ends = 0, {}
        for i in range(n):
            if library.is_control(i) or library.is_unknown(i) or library.is_byte(i):
                continue
            piece, node = library.id_to_piece(i), 0
            for c in piece:
                node = children.setdefault(node << 21 | ord(c), len(children) + 1)
            ends[node] = i
            self.depth = max(self.depth, len(piece))
        self.child = IntTable(np.fromiter(children, np.int64, len(children)), np.fromiter(children.values(), np.int32, len(children)))
        self.piece = np.full(len(children) + 1, -1, np.int32)   # trie node -> piece that ends there
        self.piece[list(ends)] = list(ends.values())

    def score(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.zeros(len(words))
        order = sorted((i for i, w in enumerate(words) if len(w) <= LONG_WORD), key=lambda i: len(words[i]))
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._score_long(START + w)
        for at in range(0, len(order), WORDS_AT_ONCE):
            some = order[at:at + WORDS_AT_ONCE]
            out[some] = self._score_block([START + words[i] for i in some])
        return out

    def _score_block(self, words: list[str]) -> np.ndarray:
        """Words in order of length."""
        size = np.array([len(w) for w in words])
        longest, n = int(size[-1]), len(words)
        start = np.cumsum(size) - size
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        # alpha of each place in each word: where in a word, and where in the row of all words
        alpha = np.full(len(chars) + n, -np.inf)
        first = start + np.arange(n)
        alpha[first] = 0.0
        for s in range(longest):
            live = np.arange(np.searchsorted(size, s, "right"), n)      # words with a character number s
            node = np.zeros(len(live), np.int64)
            for k in range(self.depth):
                node = self.child.get(node << 21 | chars[start[live] + s + k]).astype(np.int64)
                if k == 0 and (alone := np.concatenate(([], np.flatnonzero((node < 0) | (self.piece[node] < 0)))).astype(np.int64)).size:
                    spelled = live[alone]
                    cost = np.array([self.byte_logp[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in chars[start[spelled] + s].tolist()])
                    self._add(alpha, first[spelled] + s, 1, cost)
                going = node >= 0
                live, node = live[going], node[going]
                piece = self.piece[node]
                hit = piece >= 0
                if hit.any():
                    self._add(alpha, first[live[hit]] + s, k + 1, self.logp[piece[hit]])
                more = size[live] > s + k + 1
                live, node = live[more], node[more]
                if not len(live):
                    break
        return alpha[first + size]

    def _score_long(self, word: str) -> float:
        """One word: its pieces are found for many places at once, then summed up place by place."""
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
        alpha = [0.0]                                              # of the places before and in this stretch, the last one last
        for a in range(0, len(chars), STRETCH):
            b = min(a + STRETCH, len(chars))
            start = np.arange(max(0, a - self.depth + 1), b)       # pieces that end after a and not after b
            node = np.zeros(len(start), np.int64)
            ends, lengths, costs = [], [], []
            for k in range(self.depth):
                node = self.child.get(node << 21 | chars[start + k]).astype(np.int64)
                piece = np.where(node >= 0, self.piece[node], -1)
                hit = (piece >= 0) & (start + k >= a)
                ends.append(start[hit] + k + 1)
                costs.append(self.logp[piece[hit]])
                if k == 0:
                    spelled = start[(piece < 0) & (start >= a)]
                    seen, which = np.unique(chars[spelled], return_inverse=True)
                    cost = np.array([self.byte_logp[list(chr(c).encode("utf-8", "surrogatepass"))].sum() for c in seen.tolist()])
                    ends.append(spelled + 1)
                    costs.append(cost[which] if len(seen) else cost)
                lengths.append(np.full(sum(map(len, ends)) - sum(map(len, lengths)), k + 1))
                going = (node >= 0) & (start + k + 1 < b)
                start, node = start[going], node[going]
                if not len(start):
                    break
            end, length, cost = map(np.concatenate, (ends, lengths, costs))
            order = np.argsort(end, kind="stable")
            length, cost = length[order].tolist(), cost[order].tolist()
            cut = np.searchsorted(end[order], np.arange(a + 1, b + 2)).tolist()
            for lo, hi in zip(cut, cut[1:]):
                terms = [alpha[-n] + c for n, c in zip(length[lo:hi], cost[lo:hi])]
                most = max(terms)
                alpha.append(most + math.log(sum([math.exp(t - most) for t in terms])))
            del alpha[:-self.depth]
        return alpha[-1]

    @staticmethod
    def _add(alpha: np.ndarray, at: np.ndarray, step: int, logp: np.ndarray) -> None:
        alpha[at + step] = np.logaddexp(alpha[at + step], alpha[at] + logp)


def postings(df: DataFrame, parts: int, part: int, id_col: str, text_col: str) -> DataFrame:
    """(batch, word, c, postings, ids, held): a row per batch and distinct word, c counting its
    training documents' occurrences only; the end's row also has the documents themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {}
        tokens: list[np.ndarray] = []
        ids, held, count, flushed = [], [], 0, 0
        where = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            docs = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens])
            key, n = np.unique(np.concatenate(tokens).astype(np.int64) << 32 | docs, return_counts=True)
            trained = np.bincount(key >> 32, n * ~np.array(held, bool)[key & 0xFFFFFFFF], minlength=len(number)).astype(np.int64)
            more = -(-n // (MOST - 1))                            # postings of a word that a document has very often
            key, left = np.repeat(key, more), np.repeat(n, more)
            left[:] -= (np.arange(len(left)) - np.repeat(np.cumsum(more) - more, more)) * (MOST - 1)
            packed = np.empty(len(key), POSTING)
            packed["doc"], packed["n"] = key & 0xFFFFFFFF, np.minimum(left, MOST - 1)
            offsets = (np.searchsorted(key >> 32, np.arange(len(number) + 1)) * POSTING.itemsize).astype(np.int32)
            rows = len(number)
            empty = [None] * (rows - 1)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(rows, where << 32 | flushed, np.int64)), pa.array(list(number), pa.binary()).cast(pa.string()), pa.array(trained),
                pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]),
                pa.array([ids, *empty], pa.list_(id_type)), pa.array([held, *empty], pa.list_(pa.bool_())),
            ], ["batch", "word", "c", "postings", "ids", "held"])

        for some in slices(batches):
            id_type = some.schema.field(0).type
            for i, h, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), texts_of(some.column(2))):
                if not number:
                    number[END.encode()] = 0
                found = text.encode().lower().split()         # bytes: ASCII letters and ASCII white space only
                tokens.append(np.array([0, *[number.setdefault(w, len(number)) for w in found]], np.int32))
                ids.append(i)
                held.append(h)
                count += len(found) + 1
                if len(number) > BATCH_WORDS or count > BATCH_TOKENS or len(ids) == MOST:
                    yield flush()
                    number, tokens, ids, held, count, flushed = {}, [], [], [], 0, flushed + 1
        if ids:
            yield flush()

    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(id_col).alias("id"), held_out(F.col(id_col), parts, part).alias("held"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"batch long, word string, c long, postings binary, ids array<{kind}>, held array<boolean>"))


def learn_pieces(words: DataFrame, path: str, ends: int) -> tuple[np.ndarray, float]:
    """Natural-log probability of every piece and of the end; words: (word, c), words only."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _library(path)
        total = np.zeros(library.get_piece_size(), np.int64)
        for some in slices(batches, WORDS_AT_ONCE):
            c = some.column(1).to_numpy(zero_copy_only=False)
            pieces = library.encode(some.column(0).to_pylist(), num_threads=1)
            np.add.at(total, np.concatenate([np.array(p, np.int64) for p in pieces]), np.repeat(c, [len(p) for p in pieces]))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["piece", "n"])

    counted = words.mapInArrow(count, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()   # at most a row per piece
    total = np.ones(_library(path).get_piece_size() + 1)
    total[-1] += ends
    for r in counted:
        total[r["piece"]] += r["n"]
    logp = np.log(total / total.sum())
    return logp[:-1], float(logp[-1])


def score_documents(df: DataFrame, path: str, parts: int = 7, part: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()

    def written(frame: DataFrame, name: str) -> DataFrame:
        folder = scratch_path(spark, name)
        frame.write.parquet(folder)
        return spark.read.parquet(folder)

    posted = written(postings(df, parts, part, id_col, text_col), "postings")
    counts = written(posted.groupBy("word").agg(F.sum("c").alias("c")), "words")
    seen = counts.filter("c > 0")
    total = seen.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    n, v = total["n"] or 0, total["v"]
    piece_logp, end_logp = learn_pieces(seen.filter(F.col("word") != END), path, total["ends"] or 0)
    shared = spark.sparkContext.broadcast(piece_logp)      # one number per piece of the vocabulary

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path, shared.value)
        for some in slices(batches, WORDS_AT_ONCE):
            words = some.column(0).to_pylist()
            score = lattice.score(words)
            score[[i for i, w in enumerate(words) if w == END]] = end_logp
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(score / np.log(10))], ["word", "c", "score"])

    scored = counts.mapInArrow(marginals, "word string, c long, score double")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the words of this task add to each document, packed by batch."""
        keys, sums, held = [], [], 0

        def pack() -> Iterator[pa.RecordBatch]:
            batch, doc = (np.concatenate([k[i] for k in keys]) for i in (0, 1))
            order = np.lexsort((doc, batch))
            batch, doc = batch[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], (batch[1:] != batch[:-1]) | (doc[1:] != doc[:-1]))))
            packed = np.empty(len(first), SUMS)
            packed["doc"] = doc[first]
            for i, name in enumerate(("known", "tokens", "base", "score")):
                packed[name] = np.add.reduceat(np.concatenate([x[i] for x in sums])[order], first)
            batch = batch[first]
            cut = np.flatnonzero(np.concatenate(([True], batch[1:] != batch[:-1], [True])))
            yield pa.RecordBatch.from_arrays([pa.array(batch[cut[:-1]]), pa.array([packed[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["batch", "sums"])

        for some in batches:
            size = np.diff(np.frombuffer(some.column(1).buffers()[1], np.int32)[some.column(1).offset:][:some.num_rows + 1]) // POSTING.itemsize
            posted = np.frombuffer(b"".join(some.column(1).to_pylist()), POSTING)
            c, n = some.column(2).to_numpy(), posted["n"].astype(np.int64)
            word = np.repeat(np.arange(some.num_rows), size)
            keys.append((some.column(0).to_numpy()[word], posted["doc"]))
            sums.append(((c > 0)[word] * n, n, np.log10((c + 1) / (total_n + total_v + 1))[word] * n, some.column(3).to_numpy()[word] * n))
            held += len(n)
            if held > POSTINGS_HELD:
                yield from pack()
                keys, sums, held = [], [], 0
        if held:
            yield from pack()

    def gather(sums: pa.Table, docs: pa.Table) -> pa.Table:
        ids, held = docs.column("ids").combine_chunks().flatten(), docs.column("held").combine_chunks().flatten()
        added = np.frombuffer(b"".join(sums.column("sums").to_pylist()), SUMS)

        def by_doc(name: str) -> np.ndarray:
            return np.bincount(added["doc"], added[name], minlength=len(ids))

        return pa.table({"id": ids, "held_out": held, "n_tokens": pa.array(by_doc("tokens").astype(np.int64)), "n_known": pa.array(by_doc("known").astype(np.int64)),
                         "base_score": pa.array(by_doc("base")), "score": pa.array(by_doc("score"))})

    total_n, total_v = n, v
    # a row of the scored side per distinct word: hashed, the many postings need no sort
    added = posted.select("batch", "word", "postings").join(scored.hint("shuffle_hash"), "word").select("batch", "postings", "c", "score").mapInArrow(add_up, "batch long, sums binary")
    docs = posted.filter("ids IS NOT NULL").select("batch", "ids", "held")
    return (added.groupBy("batch").cogroup(docs.groupBy("batch")).applyInArrow(gather, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
            .select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"))
