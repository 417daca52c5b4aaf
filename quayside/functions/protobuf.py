"""Protobuf messages of a batch as Arrow columns (S4, P5), without Spark's Protobuf module.

``protobuf_column(body, message, descriptor)`` decodes bodies of one message
type, described by a serialized ``FileDescriptorSet``.  Fields may come in any
order; unknown fields are skipped; of a singular field that comes several times
the last stays; fields that do not come are NULL.  Enums are their names (unknown
numbers: the number as text), ``uint32`` is a long and ``uint64`` a decimal, maps
are maps.  A value that is no message gives NULL.  Groups and recursive messages
are refused.  ``index_prefixes`` are the bytes that registry framing puts before
a message of the type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from quayside.functions.cursors import Cursors, listed, placed, unzigzag

# fixed values: field type number of a descriptor → (wire type, column type)
SCALARS = {1: (1, pa.float64()), 2: (5, pa.float32()), 3: (0, pa.int64()), 4: (0, pa.decimal128(20, 0)), 5: (0, pa.int32()),
           6: (1, pa.decimal128(20, 0)), 7: (5, pa.int64()), 8: (0, pa.bool_()), 9: (2, pa.string()), 12: (2, pa.binary()),
           13: (0, pa.int64()), 14: (0, pa.string()), 15: (5, pa.int32()), 16: (1, pa.int64()), 17: (0, pa.int32()), 18: (0, pa.int64())}
FIXED_WIDTH = {1: "<f8", 2: "<f4", 6: "<u8", 7: "<u4", 15: "<i4", 16: "<i8"}
MESSAGE, ENUM, REPEATED, VARINT, BYTES = 11, 14, 3, 0, 2


@dataclass
class Field:
    name: str
    kind: int
    repeated: bool
    message: Message | None = None
    symbols: dict[int, str] = field(default_factory=dict)

    @property
    def wire(self) -> int:
        return BYTES if self.kind == MESSAGE else SCALARS[self.kind][0]

    @property
    def one_type(self) -> pa.DataType:
        return self.message.type if self.message else SCALARS[self.kind][1]

    @property
    def type(self) -> pa.DataType:
        if self.repeated and self.message and self.message.map_entry:
            entry = self.message.fields
            return pa.map_(entry[1].one_type, entry[2].one_type)
        return pa.list_(self.one_type) if self.repeated else self.one_type


@dataclass
class Message:
    fields: dict[int, Field]
    map_entry: bool = False

    @property
    def type(self) -> pa.DataType:
        return pa.struct([(f.name, f.type) for f in self.fields.values()])


def _wire_fields(raw: bytes):
    """(number, value) of every field of one small message: numbers of varints, bytes of the rest (driver side, for descriptors)."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        number, wire = divmod(varint(), 8)
        if wire == VARINT:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, raw[at:at + size]
            at += size


def _all(raw: bytes, number: int) -> list:
    return [v for n, v in _wire_fields(raw) if n == number]


def _one(raw: bytes, number: int, default=b""):
    return (_all(raw, number) or [default])[-1]


def load_message(name: str, descriptor: bytes) -> tuple[Message, tuple[int, ...]]:
    """(message, its index path in its file) from a serialized descriptor set."""
    found, enums = {}, {}

    # fixed values: field numbers of the descriptor messages. File: 2 package, 4 messages, 5 enums; message: 1 name, 2 fields,
    # 3 nested messages, 4 enums, 7 options (7 map entry); enum: 1 name, 2 values (1 name, 2 number);
    # field: 1 name, 3 number, 4 label, 5 type, 6 type name
    def walk(prefix, messages, enum_types, path):
        for e in enum_types:
            enums[f"{prefix}.{_one(e, 1).decode()}"] = {_one(v, 2, 0): _one(v, 1).decode() for v in reversed(_all(e, 2))}
        for k, m in enumerate(messages):
            full = f"{prefix}.{_one(m, 1).decode()}"
            found[full] = (m, path + (k,))
            walk(full, _all(m, 3), _all(m, 4), path + (k,))

    for file in _all(bytes(descriptor), 1):
        package = _one(file, 2).decode()
        walk(f".{package}" if package else "", _all(file, 4), _all(file, 5), ())

    def build(full, within):
        if full in within:
            raise ValueError(f"Protobuf message {full[1:]} contains itself, which no column type can hold")
        m = found[full][0]
        fields = {}
        for f in _all(m, 2):
            label, kind, type_name, own = _one(f, 4, 1), _one(f, 5, 0), _one(f, 6).decode(), _one(f, 1).decode()
            if kind != MESSAGE and kind not in SCALARS:
                raise ValueError(f"Protobuf field {full[1:]}.{own} has type {kind}, which is not supported")
            fields[_one(f, 3, 0)] = Field(own, kind, label == REPEATED, build(type_name, within + (full,)) if kind == MESSAGE else None,
                                          enums[type_name] if kind == ENUM else {})
        if not fields:
            raise ValueError(f"Protobuf message {full[1:]} has no fields")
        return Message(fields, bool(_one(_one(m, 7), 7, 0)))

    full = "." + name.lstrip(".")
    if full not in found:
        raise ValueError(f"the descriptor has no message {name!r}")
    return build(full, ()), found[full][1]


def index_prefixes(path: tuple[int, ...]) -> list[bytes]:
    """The forms of a message's index list: its length and members as zigzag varints, and a 0 byte for the first message."""
    def varint(n):
        out = bytearray()
        n <<= 1
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes(out) + bytes([n])
    full = varint(len(path)) + b"".join(map(varint, path))
    return [b"\x00", full] if path == (0,) else [full]


def _scalars(f: Field, c: Cursors, rows: np.ndarray) -> pa.Array:
    """One value of a number-like field of each row."""
    if f.kind in FIXED_WIDTH:
        return pa.array(c.numbers(rows, FIXED_WIDTH[f.kind])).cast(f.one_type)
    raw = c.varints(rows)
    if f.kind == 8:
        return pa.array(raw != 0)
    if f.kind == ENUM:
        return pa.array([f.symbols.get(v, str(v)) for v in raw.astype(np.int64).astype(np.int32).tolist()], pa.string())
    if f.kind in (17, 18):
        raw = unzigzag(raw)
    if f.kind == 13:
        raw = raw & np.uint64(0xFFFFFFFF)
    if f.kind == 4:
        return pa.array(raw).cast(f.one_type)
    raw = raw.astype(np.int64)
    return pa.array(raw.astype(np.int32) if f.one_type == pa.int32() else raw)


def _skip(c: Cursors, rows: np.ndarray, wire: int) -> None:
    if wire == VARINT:
        c.varints(rows)
    elif wire == BYTES:
        c.take(rows, c.varints(rows).astype(np.int64))
    elif wire in (1, 5):
        c.take(rows, 8 if wire == 1 else 4)
    else:
        c.bad[rows] = True


def _read(m: Message, c: Cursors) -> pa.Array:
    """All messages of the cursors; each round reads one field of every message that has bytes left."""
    n = len(c.at)
    parts = {number: ([], []) for number in m.fields}
    live = np.flatnonzero(~c.bad)
    while True:
        live = live[~c.bad[live] & (c.at[live] < c.end[live])]
        if not len(live):
            break
        tags = c.varints(live)
        for tag in np.unique(tags):
            rows = live[(tags == tag) & ~c.bad[live]]
            number, wire = int(tag) >> 3, int(tag) & 7
            f = m.fields.get(number)
            if number == 0:
                c.bad[rows] = True
            elif f is not None and wire == BYTES and f.repeated and f.wire != BYTES:      # packed
                starts, sizes = c.take(rows, c.varints(rows).astype(np.int64))
                inner = c.inside(starts, sizes)
                some = np.flatnonzero(sizes > 0)
                while len(some):
                    parts[number][0].append(_scalars(f, inner, some))
                    parts[number][1].append(rows[some])
                    some = some[~inner.bad[some] & (inner.at[some] < inner.end[some])]
                c.bad[rows[inner.bad]] = True
            elif f is None or wire != f.wire:
                _skip(c, rows, wire)
            else:
                parts[number][0].append(_values(f, c, rows))
                parts[number][1].append(rows)
    columns = []
    for number, f in m.fields.items():
        arrays, where = parts[number]
        values = pa.concat_arrays(arrays) if arrays else pa.nulls(0, f.one_type)
        at = np.concatenate(where) if where else np.zeros(0, np.int64)
        if not f.repeated:
            columns.append(placed(values, at, n))
        elif f.message and f.message.map_entry:
            bounds, entries = listed(values, at, n)
            columns.append(pa.MapArray.from_arrays(bounds, *map(_filled, entries.flatten(), f.message.fields.values())))
        else:
            columns.append(pa.ListArray.from_arrays(*listed(values, at, n)))
    return pa.StructArray.from_arrays(columns, [f.name for f in m.fields.values()])


def _filled(values: pa.Array, f: Field) -> pa.Array:
    """Keys and values that a map entry leaves out are their type's zero (messages: null)."""
    if not values.null_count or f.message:
        return values
    zero = f.symbols.get(0, "0") if f.kind == ENUM else {9: "", 12: b"", 8: False}.get(f.kind, 0)
    return values.fill_null(pa.scalar(zero, f.one_type))


def _values(f: Field, c: Cursors, rows: np.ndarray) -> pa.Array:
    if f.wire != BYTES:
        return _scalars(f, c, rows)
    sizes = c.varints(rows).astype(np.int64)
    if f.kind == 9:
        return c.texts(rows, sizes)
    if f.kind == 12:
        return c.bytes(rows, sizes).cast(pa.binary())
    inner = c.inside(*c.take(rows, sizes))
    out = _read(f.message, inner)
    c.bad[rows[inner.bad]] = True
    return out


def decode_protobuf(bodies: pa.Array, message: Message) -> pa.Array:
    """The messages of a batch; null where a body is none."""
    cursors = Cursors.of(bodies)
    out = _read(message, cursors)
    good = np.flatnonzero(~cursors.bad)
    return placed(out.take(pa.array(good)), good, len(bodies)).cast(message.type)


def protobuf_column(body: Column, message: Message) -> Column:
    return F.arrow_udf(lambda v: decode_protobuf(v, message), returnType=from_arrow_type(message.type))(body)
