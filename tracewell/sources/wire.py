"""Binary messages in the protobuf wire format, read by a Spark schema whose fields are numbered from 1 in order."""

from __future__ import annotations

import sys
from itertools import accumulate
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions that run in tasks travel by value, so executors need no copy of the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Wire types by number.
VARINT, FIXED64, BYTES, FIXED32 = 0, 1, 2, 5


def _varint(data: bytes, at: int, end: int) -> tuple[int, int]:
    value = 0
    for shift in range(0, 70, 7):
        if at >= end:
            raise ValueError("cut inside a number")
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value & (1 << 64) - 1, at
    raise ValueError("number too long")


def _default(kind: T.DataType) -> Any:
    return [] if isinstance(kind, T.ArrayType) else None if isinstance(kind, T.StructType) else "" if isinstance(kind, T.StringType) else 0


def _integer(value: int, bits: int) -> int:
    value &= (1 << bits) - 1
    return value - (1 << bits) if value >> bits - 1 else value


#: How a field is read, see :func:`plan`.
NUMBER, TEXT, MESSAGE = range(3)


def plan(schema: T.StructType) -> list[tuple]:
    """For each field its name, how it is read, whether it repeats, the bits of a number and the plan of a message."""
    fields = []
    for f in schema.fields:
        kind = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        how = NUMBER if isinstance(kind, (T.IntegerType, T.LongType)) else MESSAGE if isinstance(kind, T.StructType) else TEXT
        bits, inner = 32 if isinstance(kind, T.IntegerType) else 64, plan(kind) if how == MESSAGE else None
        fields.append((f.name, how, isinstance(f.dataType, T.ArrayType), bits, inner, _default(f.dataType)))
    return fields


def _blank(fields: list[tuple]) -> dict:
    return {name: [] if repeats else default for name, _, repeats, _, _, default in fields}


def _read(data: bytes, at: int, end: int, fields: list[tuple], out: dict) -> dict:
    """The message in ``data[at:end]``."""
    count = len(fields)
    while at < end:
        key = data[at]
        if key < 128:
            at += 1
        else:
            key, at = _varint(data, at, end)
        number, wire = key >> 3, key & 7
        if wire == VARINT or wire == BYTES:
            if at < end and data[at] < 128:
                value = data[at]
                at += 1
            else:
                value, at = _varint(data, at, end)
            start = at
            if wire == BYTES:
                at += value
        elif wire == FIXED64 or wire == FIXED32:
            at += 8 if wire == FIXED64 else 4
        else:
            raise ValueError(f"wire type {wire}")
        if at > end:
            raise ValueError("cut inside a field")
        if not 1 <= number <= 0x1FFFFFFF:
            raise ValueError("field number")
        if number > count:
            continue
        name, how, repeats, bits, inner, _ = fields[number - 1]
        if how == NUMBER:
            if wire == VARINT:
                out[name] = value if value >> bits - 1 == 0 else _integer(value, bits)
        elif wire == BYTES:
            if repeats:
                out[name].append(_read(data, start, at, inner, _blank(inner)))
            elif how == MESSAGE:
                out[name] = _read(data, start, at, inner, _blank(inner) if out[name] is None else out[name])
            else:
                out[name] = data[start:at].decode()
    return out


def decode(data: bytes, schema: T.StructType, into: dict | None = None) -> dict:
    """One message. Absent fields have their type's default, absent messages are None, unknown fields are skipped and the
    parts of a message given twice are merged. ValueError if the bytes are no message."""
    fields = plan(schema)
    return _read(data, 0, len(data), fields, _blank(fields) if into is None else into)


def _columns(found: list, kind: pa.DataType) -> pa.Array:
    """Decoded values as an Arrow array, built by column."""
    if pa.types.is_struct(kind):
        if not kind.num_fields:
            return pa.array(found, kind)
        parts = [_columns([None if x is None else x[f.name] for x in found], f.type) for f in kind]
        return pa.StructArray.from_arrays(parts, fields=list(kind), mask=pa.array([x is None for x in found], pa.bool_()))
    if pa.types.is_list(kind):
        sizes = [0, *(0 if x is None else len(x) for x in found)]
        offsets = pa.array([None if x is None else n for x, n in zip([*found, 0], accumulate(sizes), strict=True)], pa.int32())
        return pa.ListArray.from_arrays(offsets, _columns([y for x in found if x for y in x], kind.value_type), type=kind)
    return pa.array(found, kind)


def decoded(payload: Column, schema: T.StructType) -> Column:
    """The messages of a binary column, a batch at a time; NULL where the bytes are none."""
    from pyspark.sql.pandas.types import to_arrow_type

    fields = plan(schema)

    @F.arrow_udf(schema)
    def read(batch: pa.Array) -> pa.Array:
        found = []
        for data in batch.to_pylist():
            try:
                found.append(None if data is None else _read(data, 0, len(data), fields, _blank(fields)))
            except ValueError:
                found.append(None)
        return _columns(found, to_arrow_type(schema))

    return read(payload)
