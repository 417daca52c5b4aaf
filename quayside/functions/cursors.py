"""Read positions in a column of byte strings, all rows stepped at once.

The binary record decoders read a whole Arrow batch field by field: a step
reads the same thing at every row's own position with a handful of numpy
operations, so Python's cost is per field of a schema, not per row.  A row that
ends too early or breaks the format is marked ``bad`` and reads as zeros from
then on; the others are not affected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

LONGEST_VARINT = 10    # fixed value: bytes of a 64-bit varint


class Cursors:
    def __init__(self, data: np.ndarray, at: np.ndarray, end: np.ndarray, bad: np.ndarray):
        self.data, self.at, self.end, self.bad = data, at, end, bad

    @staticmethod
    def of(column: pa.Array) -> Cursors:
        """Cursors at the start of each value; null values are ``bad``."""
        column = column.cast(pa.large_binary())
        _, offsets, data = column.buffers()
        n = len(column)
        bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)
        return Cursors(raw, bounds[:-1].copy(), bounds[1:].copy(), np.asarray(column.is_null().to_numpy(zero_copy_only=False)).copy())

    def inside(self, starts: np.ndarray, sizes: np.ndarray) -> Cursors:
        """Cursors over parts of the values, e.g. nested messages."""
        return Cursors(self.data, starts.copy(), starts + sizes, np.zeros(len(starts), bool))

    def varints(self, rows: np.ndarray) -> np.ndarray:
        """One little-endian base-128 number of each row, unsigned."""
        value = np.zeros(len(rows), np.uint64)
        live = np.flatnonzero(~self.bad[rows])
        for k in range(LONGEST_VARINT):
            short = self.at[rows[live]] >= self.end[rows[live]]
            self.bad[rows[live[short]]] = True
            live = live[~short]
            byte = self.data[self.at[rows[live]]]
            self.at[rows[live]] += 1
            value[live] |= (byte & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
            live = live[byte >= 128]
            if not len(live):
                break
        self.bad[rows[live]] = True
        value[self.bad[rows]] = 0
        return value

    def zigzags(self, rows: np.ndarray) -> np.ndarray:
        return unzigzag(self.varints(rows))

    def take(self, rows: np.ndarray, sizes: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Step over ``sizes`` bytes: (starts, sizes), with size 0 for bad rows."""
        sizes = np.broadcast_to(np.asarray(sizes, np.int64), len(rows)).copy()
        left = self.end[rows] - self.at[rows]
        self.bad[rows[(sizes < 0) | (sizes > left)]] = True
        sizes[self.bad[rows]] = 0
        starts = self.at[rows].copy()
        self.at[rows] += sizes
        return starts, sizes

    def numbers(self, rows: np.ndarray, dtype: str) -> np.ndarray:
        """One little-endian number of fixed width of each row."""
        width = np.dtype(dtype).itemsize
        starts, sizes = self.take(rows, width)
        out = np.zeros((len(rows), width), np.uint8)
        ok = sizes == width
        out[ok] = self.data[starts[ok][:, None] + np.arange(width)]
        return out.reshape(-1).view(dtype)

    def bytes(self, rows: np.ndarray, sizes: np.ndarray | int) -> pa.Array:
        return self.gather(*self.take(rows, sizes))

    def gather(self, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The byte strings at ``starts`` as one binary array."""
        bounds = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        picked = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
        return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(self.data[picked])])

    def texts(self, rows: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """UTF-8 texts; bytes that are none make the row bad."""
        raw = self.bytes(rows, sizes)
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:     # rare: look at each value
            out = []
            for row, value in zip(rows, raw.to_pylist()):
                try:
                    out.append(value.decode())
                except UnicodeDecodeError:
                    self.bad[row] = True
                    out.append("")
            return pa.array(out, pa.string())


def unzigzag(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)


def placed(values: pa.Array, where: np.ndarray, n: int) -> pa.Array:
    """``values`` at positions ``where`` of an array of ``n``, nulls elsewhere; the last of several at one place stays."""
    index = np.full(n, -1, np.int64)
    index[where] = np.arange(len(where))
    return values.take(pa.array(index, mask=index < 0))


def listed(values: pa.Array, where: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """(offsets, values) of ``n`` lists: the values of each place, in order."""
    bounds = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(where, minlength=n), out=bounds[1:])
    return pa.array(bounds), values.take(pa.array(np.argsort(where, kind="stable")))
