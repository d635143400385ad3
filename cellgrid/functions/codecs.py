"""Codecs between typed columns and cell bytes, as column expressions.

Integers, booleans, strings and bytes are encoded by built-in functions;
floating-point numbers and Avro need Arrow functions over batches.
"""

from __future__ import annotations

import importlib
import json
import struct
from abc import ABC, abstractmethod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_INTS = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


class Codec(ABC):
    """How values become bytes.  Register your own with ``register`` or by its import path."""

    row_keys = True
    composite_keys = True
    fixed_parts = True

    @abstractmethod
    def encode(self, value: Column, kind: T.DataType, avro: str | None = None) -> Column: ...

    @abstractmethod
    def decode(self, cell: Column, kind: T.DataType, avro: str | None = None) -> Column: ...

    def literal(self, value: object, kind: T.DataType) -> bytes | None:
        """A literal's bytes where their order is that of the values for the type; else none."""
        return None

    def pack(self, value: object, kind: T.DataType, avro: str | None = None) -> bytes:
        """The bytes of one value, as ``encode`` makes them; for writers outside of Spark's plans."""
        raise NotImplementedError(f"{type(self).__name__} packs no single values")

    def unpack(self, raw: bytes, kind: T.DataType, avro: str | None = None) -> object:
        raise NotImplementedError(f"{type(self).__name__} unpacks no single values")

    def pack_key(self, parts: list[tuple[object, T.DataType, int]]) -> bytes:
        out = []
        for k, (value, kind, width) in enumerate(parts):
            cell = self.pack(value, kind)
            if self.fixed_parts and width > 0 and len(parts) > 1 and len(cell) != width:
                raise ValueError(f"key part {k + 1} must have {width} bytes, it has {len(cell)}")
            if not self.fixed_parts and width <= 0 and k < len(parts) - 1:
                if b"\0" in cell:
                    raise ValueError(f"key part {k + 1} holds a zero byte")
                cell += b"\0"
            out.append(cell)
        return b"".join(out)

    def encode_key(self, parts: list[tuple[Column, T.DataType, int]]) -> Column:
        """One row key; a fixed-length part of another width is an error."""
        out = []
        for k, (value, kind, width) in enumerate(parts):
            cell = self.encode(value, kind)
            if width > 0 and len(parts) > 1:
                cell = F.when(F.octet_length(cell) == width, cell).otherwise(F.raise_error(F.concat(F.lit(f"key part {k + 1} must have {width} bytes, it has "), F.octet_length(cell).cast("string"))))
            out.append(cell)
        return F.concat(*out) if len(out) > 1 else out[0]

    def decode_key(self, key: Column, parts: list[tuple[T.DataType, int]]) -> list[Column]:
        out, at = [], 1
        for kind, width in parts:
            piece = F.substring(key, at, width) if width > 0 and len(parts) > 1 else F.substr(key, F.lit(at))
            out.append(self.decode(piece, kind))
            at += max(width, 0)
        return out


def _float_codec(kind: T.DataType, ordered: bool) -> tuple:
    f, i = (">f4", ">u4") if isinstance(kind, T.FloatType) else (">f8", ">u8")
    top = np.uint64(1 << (31 if f == ">f4" else 63))
    native = np.uint32 if f == ">f4" else np.uint64

    width = int(f[2])

    @F.arrow_udf(T.BinaryType())
    def put(x: pa.Array) -> pa.Array:
        null = x.is_null().to_numpy(zero_copy_only=False)
        bits = x.fill_null(0.0).to_numpy(zero_copy_only=False).astype(f).view(i).astype(native)
        if ordered:
            bits = np.where(bits & native(top), ~bits, bits | native(top)).astype(native)
        ends = np.arange(len(bits) + 1, dtype=np.int32) * width
        full = pa.Array.from_buffers(pa.binary(), len(bits), [None, pa.py_buffer(ends), pa.py_buffer(bits.astype(i).tobytes())])
        return pc.if_else(pa.array(null), pa.scalar(None, pa.binary()), full)

    @F.arrow_udf(kind)
    def get(x: pa.Array) -> pa.Array:
        null = x.is_null().to_numpy(zero_copy_only=False)
        x = x.cast(pa.binary()).fill_null(bytes(width))
        bits = np.frombuffer(b"".join(x.to_pylist()), i).astype(native)
        if ordered:
            bits = np.where(bits & native(top), bits & ~native(top), ~bits).astype(native)
        return pa.array(bits.astype(i).view(f).astype(f[1:]), mask=null)

    return put, lambda c: F.when(c.isNotNull(), get(c))


class Primitive(Codec):
    """Big-endian two's complement, IEEE bits, UTF-8."""

    ordered = False

    def encode(self, value: Column, kind: T.DataType, avro: str | None = None) -> Column:
        if type(kind) in _INTS:
            width = _INTS[type(kind)]
            v = value.cast("bigint")
            if self.ordered:
                v = v.bitwiseXOR(F.lit(-(1 << 63))) if width == 8 else v + F.lit(1 << (8 * width - 1))
            return F.unhex(F.right(F.lpad(F.hex(v), 16, "0"), F.lit(2 * width)))
        if isinstance(kind, T.BooleanType):
            return F.when(value, F.unhex(F.lit("01" if self.ordered else "FF"))).when(~value, F.unhex(F.lit("00")))
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.when(value.isNotNull(), _float_codec(kind, self.ordered)[0](value))
        if isinstance(kind, T.StringType):
            return F.encode(value, "UTF-8")
        if isinstance(kind, T.BinaryType):
            return value
        raise TypeError(f"{type(self).__name__} can't encode {kind.simpleString()}")

    def decode(self, cell: Column, kind: T.DataType, avro: str | None = None) -> Column:
        if type(kind) in _INTS:
            width = _INTS[type(kind)]
            u, half = F.conv(F.hex(F.substring(cell, 1, width)), 16, -10).cast("bigint"), 1 << (8 * width - 1)
            if width == 8:
                return u.bitwiseXOR(F.lit(-half)) if self.ordered else u
            # Flipping the sign bit and taking it away again extends the sign.
            return ((u if self.ordered else u.bitwiseXOR(F.lit(half))) - F.lit(half)).cast(kind)
        if isinstance(kind, T.BooleanType):
            return F.hex(F.substring(cell, 1, 1)) != "00"
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return _float_codec(kind, self.ordered)[1](cell)
        if isinstance(kind, T.StringType):
            return F.decode(cell, "UTF-8")
        if isinstance(kind, T.BinaryType):
            return cell
        raise TypeError(f"{type(self).__name__} can't decode {kind.simpleString()}")

    def pack(self, value: object, kind: T.DataType, avro: str | None = None) -> bytes:
        if isinstance(kind, T.BooleanType):
            return (b"\1" if self.ordered else b"\xff") if value else b"\0"
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            f, i = (">f", ">I") if isinstance(kind, T.FloatType) else (">d", ">Q")
            raw = struct.pack(f, value)
            if not self.ordered:
                return raw
            bits, top = struct.unpack(i, raw)[0], 1 << (8 * len(raw) - 1)
            return struct.pack(i, bits ^ (2 * top - 1) if bits & top else bits | top)
        raw = self.literal(value, kind)
        if raw is None:
            raise TypeError(f"{value!r} is no {kind.simpleString()}")
        return raw

    def unpack(self, raw: bytes, kind: T.DataType, avro: str | None = None) -> object:
        if type(kind) in _INTS:
            raw = raw[: _INTS[type(kind)]]
            return int.from_bytes(raw, "big") - (1 << (8 * len(raw) - 1)) if self.ordered else int.from_bytes(raw, "big", signed=True)
        if isinstance(kind, T.BooleanType):
            return raw[:1] != b"\0"
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            f, i = (">f", ">I") if isinstance(kind, T.FloatType) else (">d", ">Q")
            if self.ordered:
                bits, top = struct.unpack(i, raw)[0], 1 << (8 * len(raw) - 1)
                raw = struct.pack(i, bits ^ top if bits & top else bits ^ (2 * top - 1))
            return struct.unpack(f, raw)[0]
        return raw.decode() if isinstance(kind, T.StringType) else bytes(raw)

    def literal(self, value: object, kind: T.DataType) -> bytes | None:
        if type(kind) in _INTS and isinstance(value, int):
            width = _INTS[type(kind)]
            if not -(1 << (8 * width - 1)) <= value < 1 << (8 * width - 1):
                return None
            return (value + (1 << (8 * width - 1))).to_bytes(width, "big") if self.ordered else value.to_bytes(width, "big", signed=True)
        if isinstance(kind, T.StringType) and isinstance(value, str):
            return value.encode()
        if isinstance(kind, T.BinaryType) and isinstance(value, (bytes, bytearray)):
            return bytes(value)
        return None


class Ordered(Primitive):
    """Bytes that sort as the values do: sign bits flipped, strings in composite keys ended by a zero byte."""

    ordered = True
    fixed_parts = False

    def encode_key(self, parts: list[tuple[Column, T.DataType, int]]) -> Column:
        out = []
        for k, (value, kind, width) in enumerate(parts):
            cell = self.encode(value, kind)
            if width <= 0 and k < len(parts) - 1:
                bad = F.instr(F.hex(cell), "00") % 2 == 1
                if isinstance(kind, T.StringType):
                    bad = value.contains("\0")
                cell = F.when(bad, F.raise_error(F.lit(f"key part {k + 1} holds a zero byte"))).otherwise(F.concat(cell, F.unhex(F.lit("00"))))
            out.append(cell)
        return F.concat(*out) if len(out) > 1 else out[0]

    def decode_key(self, key: Column, parts: list[tuple[T.DataType, int]]) -> list[Column]:
        out, rest = [], key
        for k, (kind, width) in enumerate(parts):
            if k == len(parts) - 1:
                piece = rest
            elif width > 0:
                piece, rest = F.substring(rest, 1, width), F.substr(rest, F.lit(width + 1))
            else:
                # Pairs of hex digits keep byte borders; the first zero byte ends the part.
                size = F.length(F.regexp_extract(F.hex(rest), "^((?:(?!00)..)*)", 1)) / 2
                piece, rest = F.substr(rest, F.lit(1), size.cast("int")), F.substr(rest, size.cast("int") + 2)
            out.append(self.decode(piece, kind))
        return out


class AvroCodec(Codec):
    """Raw Avro datums against the declared schema; for cells, and for single keys declared with ``avro``."""

    row_keys = False
    composite_keys = False

    def encode(self, value: Column, kind: T.DataType, avro: str | None = None) -> Column:
        from cellgrid.functions import avro as A

        schema = avro or json.dumps(A.from_spark(kind))

        @F.arrow_udf(T.BinaryType())
        def put(x: pa.Array) -> pa.Array:
            one = A.codec(schema)[0]
            return pa.array([None if v is None else one(v) for v in x.to_pylist()], pa.binary())

        return put(value)

    def decode(self, cell: Column, kind: T.DataType, avro: str | None = None) -> Column:
        from cellgrid.functions import avro as A

        schema = avro or json.dumps(A.from_spark(kind))

        target = to_arrow_type(kind)

        @F.arrow_udf(kind)
        def get(x: pa.Array) -> pa.Array:
            one = A.codec(schema)[1]
            return pa.array([None if raw is None else one(raw) for raw in x.to_pylist()], target)

        return get(cell)


    def pack(self, value: object, kind: T.DataType, avro: str | None = None) -> bytes:
        from cellgrid.functions import avro as A

        return A.codec(avro or json.dumps(A.from_spark(kind)))[0](value.asDict(True) if hasattr(value, "asDict") else value)

    def unpack(self, raw: bytes, kind: T.DataType, avro: str | None = None) -> object:
        from cellgrid.functions import avro as A

        return A.codec(avro or json.dumps(A.from_spark(kind)))[1](bytes(raw))


_CODECS: dict[str, Codec] = {"PrimitiveType": Primitive(), "Ordered": Ordered(), "Phoenix": Ordered(), "Avro": AvroCodec()}


def register(name: str, codec: Codec) -> None:
    _CODECS[name] = codec


def get(name: str) -> Codec:
    """A codec by its registered name or as ``module.Class``."""
    if name not in _CODECS:
        module, _, cls = name.rpartition(".")
        try:
            _CODECS[name] = getattr(importlib.import_module(module), cls)()
        except (ImportError, AttributeError, ValueError) as e:
            raise KeyError(f"no codec {name!r}") from e
    return _CODECS[name]
