"""Small helpers the operators of this package share."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What the contracts call a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: A-Z to a-z and nothing else (``str.lower`` would also change other scripts).
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Rows handed to Python code at a time, whatever the size of an Arrow batch.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow record batches cut into slices of at most ``rows`` rows, without copying."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(column: pa.Array) -> list[str]:
    """The column's strings; null reads as the empty text."""
    return [t or "" for t in column.to_pylist()]


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(ASCII_LOWER)


def lower_ascii_column(col: Column) -> Column:
    """A-Z to a-z in a string column, other letters untouched."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class IntTable:
    """Hash table of numpy arrays: non-negative 64-bit keys to 32-bit values, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int = -1):
        self.bits, self.missing = max(4, int(4 * len(keys)).bit_length()), np.int32(missing)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, self.missing, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):                      # each turn fills every free slot that is asked for; the rest look one slot on
            free = left[self.keys[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], self.missing)
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out
