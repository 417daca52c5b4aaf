"""Schema-registry wire framing as column expressions.

A framed value is: byte 0 magic (0), bytes 1-4 the schema id (big-endian),
then the body.  Protobuf bodies additionally start with the message-index
list, in its single-message form one 0 byte.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAGIC_BYTE = 0  # fixed value: the registry framing's magic byte


def frame_magic(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int")


def frame_schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long").cast("int")


def frame_body(value: Column) -> Column:
    return F.substring(value, 6, 2147483647)


def frame_ok(value: Column) -> Column:
    return (F.octet_length(value) >= 5) & (frame_magic(value) == MAGIC_BYTE)


def protobuf_single_message(body: Column) -> Column:
    """True when the message-index list is the single-message form."""
    return F.hex(F.substring(body, 1, 1)) == "00"


def frame(schema_id: Column, body: Column) -> Column:
    """Build a framed value (used to publish and to make test envelopes)."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id.cast("int")), 8, "0")), body)


# The encoders name their argument many times over: give them plain columns, not long expressions.

def varint(n: Column) -> Column:
    """A number of 0 or more as base-128 bytes, low ones first."""
    n = n.cast("long")
    parts = []
    for k in range(9):
        rest = F.shiftright(n, 7 * k) if k else n
        more = F.when(rest > 127, F.lit(128)).otherwise(F.lit(0))
        byte = F.lpad(F.hex(rest.bitwiseAND(F.lit(127)) + more), 2, "0")
        parts.append(F.when(rest > 0, byte).otherwise(F.lit("")) if k else byte)
    return F.unhex(F.concat(*parts))


def zigzag(n: Column) -> Column:
    """A signed number as the varint of its zigzag form (below 2^61 in size)."""
    n = n.cast("long")
    return varint(F.shiftleft(n, 1).bitwiseXOR(F.shiftright(n, 63)))


def sized(value: Column) -> Column:
    """Bytes or text after their length, as Protobuf has them."""
    return F.concat(varint(F.octet_length(value)), value.cast("binary"))


def avro_sized(value: Column) -> Column:
    """Bytes or text after their length, as Avro has them."""
    return F.concat(varint(2 * F.octet_length(value)), value.cast("binary"))
