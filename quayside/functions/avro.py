"""Avro records of a batch as Arrow columns (S3, P5), without Spark's Avro module.

``avro_column(body, writer, reader)`` is a column of Spark type
``avro_type(reader)``: the writer's schema says how the bytes are read, the
reader's (the writer's own by default) which fields come out, found by name or
alias, with defaults for those that the writer lacks and with the promotions of
the format (int → long → float → double, string ↔ bytes).

``["null", T]`` is a nullable T; a union of several types is a struct with
``member0``, ``member1``, …, as Spark's module has it.  The logical types
``date``, ``timestamp-millis`` and ``timestamp-micros`` become dates and
instants, others stay what they are stored as.  A value that is no record of the
schema gives NULL; bytes after the record are ignored.  Recursive schemas have
no column type and are refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import DataType

from quayside.functions.cursors import Cursors, listed, placed

# fixed values: the format's primitive types, and the wider types that each may be read as
PRIMITIVES = {"null": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "float": pa.float32(),
              "double": pa.float64(), "bytes": pa.binary(), "string": pa.string()}
LOGICAL = {("int", "date"): pa.date32(), ("long", "timestamp-millis"): pa.timestamp("us", "UTC"),
           ("long", "timestamp-micros"): pa.timestamp("us", "UTC")}
PROMOTIONS = {"int": ("long", "float", "double"), "long": ("float", "double"), "float": ("double",),
              "string": ("bytes",), "bytes": ("string",)}


def parse_avro(schema: str | dict | list) -> dict | list | str:
    """A schema with every reference to a named type replaced by its definition."""
    return _inlined(json.loads(schema) if isinstance(schema, str) and schema.lstrip()[:1] in '{["' else schema, {}, "", ())


def _inlined(s, known: dict, space: str, within: tuple):
    if isinstance(s, list):
        return [_inlined(x, known, space, within) for x in s]
    if isinstance(s, str):
        if s in PRIMITIVES:
            return s
        full = s if "." in s or not space else f"{space}.{s}"
        if full in within:
            raise ValueError(f"Avro type {full} contains itself, which no column type can hold")
        if full not in known:
            raise ValueError(f"unknown Avro type {s!r}")
        return known[full]
    kind = s["type"]
    if isinstance(kind, (dict, list)):
        return _inlined(kind, known, space, within)
    if kind == "array":
        return {**s, "items": _inlined(s["items"], known, space, within)}
    if kind == "map":
        return {**s, "values": _inlined(s["values"], known, space, within)}
    if kind not in ("record", "enum", "fixed"):
        return {**s, "type": kind} if kind in PRIMITIVES else _inlined(kind, known, space, within)
    name = s["name"]
    space = name.rpartition(".")[0] or s.get("namespace", space)
    full = f"{space}.{name.rpartition('.')[2]}" if space else name
    out = dict(s)
    if kind == "record":
        if not s["fields"]:
            raise ValueError(f"Avro record {full} has no fields")
        out["fields"] = []
        for f in s["fields"]:
            out["fields"].append({**f, "type": _inlined(f["type"], known, space, within + (full,))})
    known[full] = out
    return out


def _kind(s) -> str:
    return "union" if isinstance(s, list) else s if isinstance(s, str) else s["type"]


def _members(union: list) -> list:
    return [b for b in union if _kind(b) != "null"]


def arrow_type(s) -> pa.DataType:
    kind = _kind(s)
    if kind == "union":
        some = _members(s)
        if len(some) < 2:
            return arrow_type(some[0] if some else "null")
        return pa.struct([(f"member{k}", arrow_type(b)) for k, b in enumerate(some)])
    if kind == "record":
        return pa.struct([(f["name"], arrow_type(f["type"])) for f in s["fields"]])
    if kind == "array":
        return pa.list_(arrow_type(s["items"]))
    if kind == "map":
        return pa.map_(pa.string(), arrow_type(s["values"]))
    if kind in ("enum", "fixed"):
        return pa.string() if kind == "enum" else pa.binary()
    return LOGICAL.get((kind, s.get("logicalType")) if isinstance(s, dict) else None, PRIMITIVES[kind])


def avro_type(schema: str) -> DataType:
    return from_arrow_type(arrow_type(parse_avro(schema)))


def _matches(w, r) -> bool:
    a, b = _kind(w), _kind(r)
    if a == b:
        return a not in ("record", "enum", "fixed") or _simple(w) in {_simple(r), *(x.rpartition(".")[2] for x in r.get("aliases", ()))}
    return b in PROMOTIONS.get(a, ())


def _simple(s) -> str:
    return s["name"].rpartition(".")[2]


def _constant(value, s, n: int) -> pa.Array:
    """A reader's default, ``n`` times."""
    kind = _kind(s)
    if kind == "union" and len(_members(s)) > 1 and value is not None:
        value = {"member0": value}
    if kind in ("bytes", "fixed") and isinstance(value, str):
        value = value.encode("latin-1")
    if kind == "map":
        value = list(value.items())
    one = pa.array([value], arrow_type(s))
    return one.take(pa.array(np.zeros(n, np.int64)))


class AvroReader:
    """Reads values written with ``writer`` as ``reader`` at the cursors' rows."""

    def __init__(self, cursors: Cursors):
        self.c = cursors

    def read(self, w, r, rows: np.ndarray) -> pa.Array:
        if _kind(w) == "union":
            return self._branches(w, r, rows)
        if _kind(r) == "union":
            some = _members(r)
            fits = [k for k, b in enumerate(some) if _matches(w, b)]
            fits = [k for k in fits if _kind(some[k]) == _kind(w)] or fits
            if not fits and _kind(w) != "null":
                return self._refused(w, r, rows)
            if len(some) < 2 or not fits:
                values = self.read(w, some[0] if some and fits else w, rows)
                return values if fits else pa.nulls(len(rows), arrow_type(r))
            parts = [pa.nulls(len(rows), arrow_type(b)) for b in some]
            parts[fits[0]] = self.read(w, some[fits[0]], rows)
            return pa.StructArray.from_arrays(parts, [f"member{k}" for k in range(len(some))])
        if _kind(w) == "null" or not _matches(w, r):
            return pa.nulls(len(rows), arrow_type(r)) if _kind(w) == "null" == _kind(r) else self._refused(w, r, rows)
        return getattr(self, "_" + _kind(w), self._primitive)(w, r, rows)

    def _refused(self, w, r, rows):
        """A value that the reader's schema has no place for."""
        self.c.bad[rows] = True
        return pa.nulls(len(rows), arrow_type(r))

    def _branches(self, union, r, rows):
        which = self.c.zigzags(rows)
        self.c.bad[rows[(which < 0) | (which >= len(union))]] = True
        out = [], []
        for k, branch in enumerate(union):
            here = np.flatnonzero((which == k) & ~self.c.bad[rows])
            if len(here):
                out[0].append(self.read(branch, r, rows[here]))
                out[1].append(here)
        if not out[0]:
            return pa.nulls(len(rows), arrow_type(r))
        return placed(pa.concat_arrays(out[0]), np.concatenate(out[1]), len(rows))

    def _primitive(self, w, r, rows):
        kind, c = _kind(w), self.c
        if kind == "boolean":
            return pa.array(c.numbers(rows, "u1") != 0)
        if kind in ("int", "long"):
            values = c.zigzags(rows)
            if kind == "int":
                c.bad[rows[(values < -2**31) | (values >= 2**31)]] = True
                values = values.astype(np.int32)
            target = arrow_type(r)
            if isinstance(r, dict) and r.get("logicalType") == "timestamp-millis" and target in LOGICAL.values():
                values = values * 1000
            return pa.array(values).cast(target, safe=False)
        if kind in ("float", "double"):
            return pa.array(c.numbers(rows, "<f4" if kind == "float" else "<f8")).cast(arrow_type(r))
        sizes = c.zigzags(rows)
        return c.texts(rows, sizes) if arrow_type(r) == pa.string() else c.bytes(rows, sizes).cast(arrow_type(r))

    def _fixed(self, w, r, rows):
        if w["size"] != r["size"]:
            return self._refused(w, r, rows)
        return self.c.bytes(rows, w["size"]).cast(pa.binary())

    def _enum(self, w, r, rows):
        which = self.c.zigzags(rows)
        wrong = (which < 0) | (which >= len(w["symbols"]))
        self.c.bad[rows[wrong]] = True
        known = set(r["symbols"])
        names = [s if s in known else r.get("default") for s in w["symbols"]]
        out = pa.array(names, pa.string()).take(pa.array(np.where(wrong, 0, which)))
        self.c.bad[rows[out.is_null().to_numpy(zero_copy_only=False)]] = True
        return out

    def _record(self, w, r, rows):
        place = {}
        for k, f in enumerate(r["fields"]):
            for name in (*f.get("aliases", ()), f["name"]):
                place[name] = k
        got = {}
        for f in w["fields"]:
            k = place.get(f["name"])
            values = self.read(f["type"], f["type"] if k is None else r["fields"][k]["type"], rows)
            if k is not None:
                got[k] = values
        columns = []
        for k, f in enumerate(r["fields"]):
            if k not in got and "default" not in f:
                got[k] = self._refused(w, f["type"], rows)
            columns.append(got[k] if k in got else _constant(f["default"], f["type"], len(rows)))
        return pa.StructArray.from_arrays(columns, [f["name"] for f in r["fields"]])

    def _blocks(self, rows: np.ndarray, step: Callable[[np.ndarray], list[pa.Array]], empty: list[pa.DataType]):
        """Arrays and maps: blocks of items until a block of none. Rounds take one item of every row that has one."""
        c, left, live = self.c, np.zeros(len(rows), np.int64), np.arange(len(rows))
        parts, where = [[] for _ in empty], []
        while len(live):
            ask = live[left[live] == 0]
            if len(ask):
                count = c.zigzags(rows[ask])
                sized = count < 0
                c.varints(rows[ask[sized]])               # a negative count is followed by the block's size
                count = np.abs(count)
                room = c.end[rows[ask]] - c.at[rows[ask]]
                c.bad[rows[ask[count > room]]] = True     # items of no bytes are no way to write a long list
                left[ask] = count
                live = live[~np.isin(live, ask[count == 0])]
            live = live[~c.bad[rows[live]]]
            if len(live):
                for part, values in zip(parts, step(rows[live])):
                    part.append(values)
                where.append(live.copy())
                left[live] -= 1
        at = np.concatenate(where) if where else np.zeros(0, np.int64)
        return at, [pa.concat_arrays(p) if p else pa.nulls(0, t) for p, t in zip(parts, empty)]

    def _array(self, w, r, rows):
        at, (items,) = self._blocks(rows, lambda some: [self.read(w["items"], r["items"], some)], [arrow_type(r["items"])])
        return pa.ListArray.from_arrays(*listed(items, at, len(rows)))

    def _map(self, w, r, rows):
        def entry(some):
            return [self.c.texts(some, self.c.zigzags(some)), self.read(w["values"], r["values"], some)]
        at, (keys, values) = self._blocks(rows, entry, [pa.string(), arrow_type(r["values"])])
        bounds, keys = listed(keys, at, len(rows))
        return pa.MapArray.from_arrays(bounds, keys, listed(values, at, len(rows))[1])


def decode_avro(bodies: pa.Array, writer, reader) -> pa.Array:
    """The records of a batch; null where a body is none of ``writer`` (schemas as ``parse_avro`` gives them)."""
    cursors = Cursors.of(bodies)
    rows = np.arange(len(bodies))
    out = AvroReader(cursors).read(writer, reader, rows)
    good = np.flatnonzero(~cursors.bad)
    return placed(out.take(pa.array(good)), good, len(bodies)).cast(arrow_type(reader))


def avro_column(body: Column, writer: str, reader: str | None = None) -> Column:
    w = parse_avro(writer)
    r = parse_avro(reader) if reader else w
    return F.arrow_udf(lambda v: decode_avro(v, w, r), returnType=from_arrow_type(arrow_type(r)))(body)
