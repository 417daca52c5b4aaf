"""BPE encoding and decoding with a tokenization automaton (operator 1).

The merges are compiled, in rank order, into a deterministic automaton over token arcs.  It
starts as one state with an arc per byte; each merge is one gadget: the left token's arcs
are led to a new state that lacks the right token's arc (the pair may no longer stand), and
wherever the left arc leaves a state the merged token's arc is added, leading to where the
right token led.  After the last gadget the automaton accepts exactly the merged form of
every byte string.  A new state differs from the one it was split from by a single arc, so
states are kept as (parent, missing arc, birth) and an arc is looked up along that chain.

Encoding drives the automaton over a pre-split word's bytes through a transition table: a
table state is the set of arcs now being spelled (automaton state, position in the token
trie), its output the one token that ends the unique valid form of the bytes so far.  Table
states are made when first reached, as in a lazy DFA; the table is bounded and starts anew
when full.  The tokens are then read off backwards.  Decoding emits the arc labels.

Contract: null and empty text have no tokens; repeated rows are encoded as they come; an
empty table gives an empty result; other columns of the input play no part.  Texts of any
length are handled whole; memory per worker is bounded by the table and cache limits plus
one slice of texts.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.texts import slices, texts_of
from quayside.llm.vocab import ByteBpe, ChunkCache, load_byte_bpe

#: Table states kept (about 0.5 kB each), words that step together, and bytes of a word that skips the table.
TABLE_LIMIT = 150_000
WORDS_AT_ONCE = 8_192
LONG_WORD = 1_024
#: Distinct chunks whose ids a worker keeps.
CHUNKS_HELD = 500_000


class MergeAutomaton:
    """Token-arc automaton of a byte-level BPE vocabulary."""

    def __init__(self, vocab: ByteBpe, table_limit: int = TABLE_LIMIT):
        n = len(vocab.labels)
        self.vocab, self.labels, self.table_limit = vocab, vocab.labels, table_limit
        self.rank = array("i", [-1]) * n          # birth of the token's arc
        self.left = array("i", range(n))          # the token whose arcs the merged arc follows
        self.target = array("i", [0]) * n         # state an arc with this label leads to
        self.parent, self.missing, self.born = array("i", [0]), array("i", [-1]), array("i", [-1])
        usable = set(vocab.base)
        for rank, (u, v, merged) in enumerate(vocab.merges):
            if u not in usable or v not in usable or not self._built_arc(self.target[u], v):
                continue                          # the pair never stands: no gadget
            old_u, old_v = self.target[u], self.target[v]
            self.parent.append(old_u)
            self.missing.append(v)
            self.born.append(rank)
            self.target[u] = len(self.parent) - 1
            self.rank[merged], self.left[merged], self.target[merged] = rank, u, old_v
            usable.add(merged)
        self._index_states()
        self.length = np.array([len(x) for x in self.labels], np.int64)
        # trie of the usable tokens' bytes
        self.child: dict[int, int] = {}
        self.token_at = array("i", [-1])
        self.inner = bytearray(1)                 # 1: the node has children
        for t in usable:
            node = 0
            for b in self.labels[t]:
                key = node << 8 | b
                below = self.child.get(key)
                if below is None:
                    self.inner[node] = 1
                    below = self.child[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.inner.append(0)
                node = below
            self.token_at[node] = t
        self._clear()

    def _built_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``, by walking the chain of states it came from."""
        rank, born, missing, parent, left = self.rank, self.born, self.missing, self.parent, self.left
        while state:
            if rank[token] >= born[state]:
                token = left[token]               # added later: present iff the left token's arc was
            elif token == missing[state]:
                return False
            else:
                state = parent[state]
        return True

    def _index_states(self) -> None:
        """Chains of states are thousands long; number the tree of states so that ``has_arc``
        takes a search and a few jumps: ``first``/``last`` bound each state's descendants,
        ``jump`` leads up in steps that double, ``cuts`` has, by token, the ranges of states
        that lost its arc (a lost arc isn't lost again below, so ranges don't overlap)."""
        n = len(self.parent)
        depth, jump, size = array("i", [0]) * n, array("i", [0]) * n, array("i", [1]) * n
        for s in range(1, n):
            p = self.parent[s]
            depth[s] = depth[p] + 1
            far = jump[p]
            jump[s] = jump[far] if depth[p] - depth[far] == depth[far] - depth[jump[far]] else p
        for s in range(n - 1, 0, -1):
            size[self.parent[s]] += size[s]
        first, free = array("i", [0]) * n, array("i", [1]) * n
        for s in range(1, n):                     # a parent's number is known before its children's
            p = self.parent[s]
            first[s] = first[p] + free[p]
            free[p] += size[s]
        self.first, self.jump = first, jump
        ranges: dict[int, list[tuple[int, int]]] = {}
        for s in range(1, n):
            ranges.setdefault(self.missing[s], []).append((first[s], first[s] + size[s] - 1))
        self.cuts = {t: tuple(map(list, zip(*sorted(r)))) for t, r in ranges.items()}

    def has_arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may follow in ``state``; agrees with ``_built_arc``."""
        rank, born, parent, left, first, jump = self.rank, self.born, self.parent, self.left, self.first, self.jump
        while state:
            r = rank[token]
            if r >= born[state]:
                token = left[token]
                continue
            cut = self.cuts.get(token)
            if cut:
                at = bisect_right(cut[0], first[state]) - 1
                if at >= 0 and first[state] <= cut[1][at]:
                    return False
            if r < 0:
                return True
            while born[state] > r:                # up to the state the arc was added to
                far = jump[state]
                state = far if born[far] > r else parent[state]
        return True

    def _clear(self) -> None:
        self.column = np.full(256, -1, np.int32)          # byte -> column of the table, in order of appearance
        self.columns = 0
        self.table = np.full((1024, 32), -1, np.int32)    # table state, column -> table state
        self.open: list[tuple[int, ...]] = [(0,)]         # arcs being spelled in each table state: state << 32 | trie node << 8
        self.out = np.full(1024, -1, np.int32)            # token that ends there
        self.number: dict[tuple[int, ...], int] = {}

    def _spell(self, open_arcs: tuple[int, ...], byte: int) -> tuple[int, ...]:
        """Token that ends with ``byte``, then the arcs being spelled after it."""
        going, ended, child, token_at, inner = [], -1, self.child, self.token_at, self.inner
        for arc in open_arcs:
            below = child.get(arc & 0xFFFFFFFF | byte)
            if below is None:
                continue
            if ended < 0 <= token_at[below] and self.has_arc(arc >> 32, token_at[below]):
                ended = token_at[below]                   # just one token can end here
            if inner[below]:
                going.append(arc >> 32 << 32 | below << 8)
        return (ended, *going, self.target[ended] << 32)

    def _advance(self, state: int, byte: int) -> None:
        """Fill the table's entry."""
        key = self._spell(self.open[state], byte)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.open)
            self.open.append(key[1:])
            if to == len(self.out):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.out = np.concatenate([self.out, np.full_like(self.out, -1)])
            self.out[to] = key[0]
        self.table[state, self.column[byte]] = to

    def _add_columns(self, text: np.ndarray) -> None:
        for byte in np.unique(text).tolist():
            if self.column[byte] < 0:
                if self.columns == self.table.shape[1]:
                    self.table = np.concatenate([self.table, np.full((len(self.table), 32), -1, np.int32)], axis=1)
                self.column[byte] = self.columns
                self.columns += 1

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed token ids of each pre-token, all words stepping through the table together."""
        done: list[bytes] = [b""] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for at in range(0, len(short), WORDS_AT_ONCE):
            some = short[at:at + WORDS_AT_ONCE]
            for i, ids in zip(some, self._encode_block([words[i] for i in some])):
                done[i] = ids
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                done[i] = self._encode_long(w)
        return done

    def _encode_block(self, words: list[bytes]) -> list[bytes]:
        if len(self.open) > self.table_limit:
            self._clear()
        text = np.frombuffer(b"".join(words), np.uint8)
        self._add_columns(text)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        ends = np.empty(len(text), np.int32)
        order = np.argsort(-size, kind="stable")
        longest_first = -size[order]
        state = np.zeros(len(words), np.int32)
        for k in range(int(size.max(initial=0))):
            live = order[:np.searchsorted(longest_first, -k, "left")]   # words with a byte number k
            at, byte = state[live], text[start[live] + k]
            column = self.column[byte]
            to = self.table[at, column]
            if (new := to < 0).any():
                for key in np.unique(at[new].astype(np.int64) << 8 | byte[new]).tolist():
                    self._advance(key >> 8, key & 255)
                to = self.table[at, column]
            state[live] = to
            ends[start[live] + k] = self.out[to]
        # read the tokens off backwards
        at, which, found, owner = start + size, np.flatnonzero(size), [], []
        while len(which):
            token = ends[at[which] - 1]
            found.append(token)
            owner.append(which)
            at[which] -= self.length[token]
            which = which[at[which] > start[which]]
        if not found:
            return [b""] * len(words)
        owners = np.concatenate(owner[::-1])
        ids = np.concatenate(found[::-1])[np.argsort(owners, kind="stable")].astype("<u4").tobytes()
        stop = np.cumsum(np.bincount(owners, minlength=len(words))) * 4
        return [ids[a:b] for a, b in zip([0, *stop[:-1].tolist()], stop.tolist())]

    def _encode_long(self, word: bytes) -> bytes:
        """A pre-token too long for the table: the same steps, kept for this word only."""
        open_arcs, ends = self.open[0], array("i")
        for byte in word:
            ended, *open_arcs = self._spell(open_arcs, byte)
            ends.append(ended)
        ids, at = array("I"), len(word)
        while at:
            ids.append(ends[at - 1])
            at -= len(self.labels[ends[at - 1]])
        ids.reverse()
        return ids.tobytes()


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkCache:
    vocab = load_byte_bpe(path)
    machine = MergeAutomaton(vocab)
    return ChunkCache(vocab, lambda words: machine.encode_words([w.encode() for w in words]),
                      lambda i: i.to_bytes(4, "little"), b"".join, limit=CHUNKS_HELD)


def encode_texts(path: str, texts: list[str]) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers."""
    return [b"".join(v) for v in _encoder(path).values(texts)]


def decode_ids(path: str, ids: bytes) -> str:
    """Text of packed token ids: the arc labels in order; bytes that are no UTF-8 read as U+FFFD."""
    return b"".join(map(load_byte_bpe(path).labels.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids binary): the packed ids of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = encode_texts(path, texts_of(part.column(1)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    return _mapped(df, id_col, text_col, run, "ids binary")


def bpe_round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text, encoded and decoded again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            packed = encode_texts(path, texts_of(part.column(1)))
            yield pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(decode_ids(path, p).encode()).hexdigest() for p in packed]),
            ], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _mapped(df, id_col, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _mapped(df: DataFrame, id_col: str, text_col: str, run, columns: str) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col))
