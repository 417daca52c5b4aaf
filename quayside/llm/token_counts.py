"""Token counts by rank-synchronous array merging (operator 8).

The distinct pre-tokens of a slice of texts stand in one ragged numpy array of symbols.  In
each round every sequence finds its own lowest-ranked pair and merges all of that pair's
occurrences, left to right, all sequences at once; sequences without a pair left drop out.
What counts is how many symbols survive, so no ids are kept.

Contract: null and empty text count 0 bytes and 0 tokens; a special token's string in a text
is one token, as in the library's default; repeated rows are counted as they come; an empty
table gives an empty result; other columns of the input play no part.  Whole texts count,
in bounded memory: one slice of texts, one block of pre-tokens, a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import IntTable, slices, texts_of
from quayside.llm.vocab import ByteBpe, ChunkCache, load_byte_bpe

NO_PAIR = np.int32(2**31 - 1)
#: Pre-tokens merged together.
WORDS_AT_ONCE = 8_192


class RankMerger:
    """Merges ragged arrays of symbols by the ranks of a byte-level BPE vocabulary."""

    def __init__(self, vocab: ByteBpe):
        merges = np.array(vocab.merges, np.int64).reshape(-1, 3)
        self.merged = merges[:, 2].astype(np.int32)
        self.base = np.array(vocab.base, np.int32)
        self.ranks = IntTable(merges[:, 0] << 32 | merges[:, 1], np.arange(len(merges)), missing=NO_PAIR)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return self.ranks.get(a.astype(np.int64) << 32 | b)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Symbols of each word that survive all merges."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.base[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        rank = np.full(len(symbol), NO_PAIR, np.int32)         # of the pair that begins at each symbol
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        survive = size.copy()
        while len(symbol):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            length = np.diff(np.append(start, len(word)))
            lowest = np.minimum.reduceat(rank, start)
            going = np.repeat(lowest != NO_PAIR, length)
            lowest = np.repeat(lowest, length)[going]
            symbol, word, rank = symbol[going], word[going], rank[going]
            if not len(symbol):
                break
            hit = rank == lowest
            if (hit[1:] & hit[:-1]).any():                     # a run of one symbol: every other pair, from the left
                at = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), at, 0))
                hit &= (at - run) % 2 == 0
            symbol[hit] = self.merged[rank[hit]]
            survive -= np.bincount(word[hit], minlength=len(words))
            keep = np.ones(len(hit), bool)
            keep[1:] = ~hit[:-1]
            symbol, word, rank, hit = symbol[keep], word[keep], rank[keep], hit[keep]
            changed = hit
            changed[:-1] |= hit[1:]
            at = np.flatnonzero(changed)
            rank[at] = NO_PAIR
            at = at[at + 1 < len(word)]
            at = at[word[at] == word[at + 1]]
            rank[at] = self._rank(symbol[at], symbol[at + 1])
        return survive


@lru_cache(maxsize=2)
def _counter(path: str) -> ChunkCache:
    vocab = load_byte_bpe(path)
    merger = RankMerger(vocab)

    def resolve(words: list[str]) -> list[int]:
        out: list[int] = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            out += merger.count([w.encode() for w in words[at:at + WORDS_AT_ONCE]]).tolist()
        return out

    return ChunkCache(vocab, resolve, lambda i: 1, sum)


def count_tokens(path: str, texts: list[str]) -> list[int]:
    return [sum(v) for v in _counter(path).values(texts)]


def token_counts(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text; over_limit: more than ``limit`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = texts_of(part.column(1))
            n = pa.array(count_tokens(path, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), n], ["id", "n_bytes", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
