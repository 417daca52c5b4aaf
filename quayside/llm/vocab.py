"""Byte-level BPE vocabulary files and the split of texts that precedes the merges.

A byte-level vocabulary file writes every byte as one printable character.  Text is first
cut at the special tokens, then by the split pattern into pre-tokens; merges never cross
either cut.  Corpora repeat their words, so ``ChunkCache`` resolves each distinct chunk of
a text (a word with the blank before it) once and keeps the result, up to a fixed number
of entries per worker: results never depend on what the cache holds.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import lru_cache

import regex

# The split pattern of the byte-level vocabulary files.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(SPLIT_PATTERN)


def byte_characters() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in byte order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass(frozen=True)
class ByteBpe:
    """labels: bytes of every token id; merges: (left, right, merged) ids by rank;
    special: text -> id of the special tokens; base: the id of each byte."""

    labels: list[bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    base: list[int]
    special_split: object = field(repr=False, default=None)


@lru_cache(maxsize=4)
def load_byte_bpe(path: str) -> ByteBpe:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, to_byte = spec["model"], byte_characters()
    if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is no byte-level BPE vocabulary")
    ids = model["vocab"]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    labels = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in ids.items():
        labels[i] = bytes(to_byte[c] for c in text)
    for text, i in special.items():
        labels[i] = text.encode()
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    from_byte = {b: c for c, b in to_byte.items()}
    split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
    return ByteBpe(labels, merges, special, [ids[from_byte[b]] for b in range(256)], split)


def pre_tokens(chunk: str) -> list[str]:
    """The chunk as the split pattern cuts it; the two commonest kinds without a search."""
    word = chunk[1:]
    if chunk[:1] == " " and word:
        if word.isalpha():                                    # letters only: one pre-token
            return [chunk]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():      # and one mark
            return [chunk[:-1], word[-1]]
    return SPLIT.findall(chunk)


class ChunkCache:
    """Maps texts to lists of per-chunk values.

    ``resolve`` gets distinct pre-tokens and returns one value for each; ``special`` maps a
    special token's id to its value; ``join`` folds the values of the pre-tokens of a chunk.
    At most ``limit`` chunks are kept; when full the cache starts anew.
    """

    def __init__(self, vocab: ByteBpe, resolve: Callable[[list[str]], list], special: Callable[[int], object],
                 join: Callable[[list], object], limit: int = 1_000_000):
        self.vocab, self.resolve, self.join, self.limit = vocab, resolve, join, limit
        self.special = {text: special(i) for text, i in vocab.special.items()}
        self.after_blank: dict[str, object] = {}   # word -> value of " " + word
        self.as_is: dict[str, object] = {}         # chunk -> its value

    def _parts(self, text: str) -> list[str]:
        return self.vocab.special_split.split(text) if self.vocab.special_split and any(s in text for s in self.special) else [text]

    def values(self, texts: list[str]) -> list[list]:
        """One list of chunk values per text, in order."""
        gc.disable()   # nothing here makes cycles, and the collector would walk the caches again and again
        try:
            return self._values(texts)
        finally:
            gc.enable()

    def _values(self, texts: list[str]) -> list[list]:
        if len(self.after_blank) + len(self.as_is) > self.limit:
            self.after_blank, self.as_is = {}, {}
        out, holes = [], []                        # holes: cache, list, where in it a value is missing, its chunk

        def look_up(cache: dict, chunks: list[str], into: list) -> None:
            got = list(map(cache.get, chunks))
            if None in got:
                at = len(into)
                holes.extend((cache, into, at + i, chunks[i]) for i, v in enumerate(got) if v is None)
            into += got

        for text in texts:
            values: list = []
            for part in self._parts(text):
                if part in self.special:
                    values.append(self.special[part])
                elif "  " in part:   # blanks in a row belong together: the pattern itself cuts this part
                    look_up(self.as_is, SPLIT.findall(part), values)
                elif part:           # else every single blank opens a chunk
                    first, *rest = part.split(" ")
                    if first:
                        look_up(self.as_is, [first], values)
                    look_up(self.after_blank, rest, values)
            out.append(values)
        if holes:
            self._fill(list({c for cache, _, _, c in holes if cache is self.after_blank}), list({c for cache, _, _, c in holes if cache is self.as_is}))
            for cache, values, i, chunk in holes:
                values[i] = cache[chunk]
        return out

    def _fill(self, words: list[str], whole: list[str]) -> None:
        blank = self.after_blank
        cut = [pre_tokens(" " + w) for w in words] + [pre_tokens(w) for w in whole]
        value = {p: blank.get(p[1:]) if p[0] == " " else self.as_is.get(p) for c in cut for p in c}
        unknown = [p for p, v in value.items() if v is None]
        value.update(zip(unknown, self.resolve(unknown), strict=True))
        blank.update((p[1:], value[p]) for p in unknown if p[0] == " " and p[1:].isalpha())   # such a pre-token is a chunk as well
        got = [value[c[0]] if len(c) == 1 else self.join([value[p] for p in c]) for c in cut]
        blank.update(zip(words, got))
        self.as_is.update(zip(whole, got[len(words):]))
