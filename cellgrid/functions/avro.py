"""Avro datums (raw binary, no container): schema conversion and a codec, for Arrow batches."""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Callable
from functools import lru_cache
from typing import Any

from pyspark.sql import types as T


class SchemaError(ValueError):
    """A schema without counterpart."""


_SIMPLE = {"int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(), "enum": T.StringType(), "fixed": T.BinaryType()}


def _kind(schema: Any) -> str:
    return "union" if isinstance(schema, list) else schema["type"] if isinstance(schema, dict) and isinstance(schema["type"], str) else schema if isinstance(schema, str) else _kind(schema["type"])


def to_spark(schema: Any, names: dict[str, Any] | None = None) -> tuple[T.DataType, bool]:
    """The Spark type of an Avro schema, and whether it takes null."""
    names = {} if names is None else names
    if isinstance(schema, str) and schema in names:
        return to_spark(names[schema], names)
    if isinstance(schema, dict) and isinstance(schema.get("type"), (dict, list)):
        return to_spark(schema["type"], names)
    kind = _kind(schema)
    if isinstance(schema, dict) and "name" in schema:
        names[schema["name"]] = schema
    if kind == "record":
        parts = [(f["name"], *to_spark(f["type"], names)) for f in schema["fields"]]
        return T.StructType([T.StructField(n, t, null) for n, t, null in parts]), False
    if kind == "array":
        return T.ArrayType(*to_spark(schema["items"], names)), False
    if kind == "map":
        return T.MapType(T.StringType(), *to_spark(schema["values"], names)), False
    if kind == "union":
        rest = [s for s in schema if s != "null"]
        null = len(rest) < len(schema)
        if len(rest) == 1:
            return to_spark(rest[0], names)[0], null
        for pair, wide in (({"int", "long"}, T.LongType()), ({"float", "double"}, T.DoubleType())):
            if len(rest) == 2 and {_kind(s) for s in rest} == pair:
                return wide, null
        raise SchemaError(f"no type for the union {schema}")
    if kind in _SIMPLE:
        return _SIMPLE[kind], False
    raise SchemaError(f"no type for {schema}")


def from_spark(kind: T.DataType, nullable: bool = False, name: str = "topLevelRecord", space: str = "recordNamespace") -> Any:
    """The Avro schema of a Spark type."""
    simple = {T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.BooleanType: "boolean", T.StringType: "string", T.BinaryType: "bytes", T.TimestampType: "long"}
    if isinstance(kind, T.DecimalType):
        out: Any = "string"
    elif type(kind) in simple:
        out = simple[type(kind)]
    elif isinstance(kind, T.ArrayType):
        out = {"type": "array", "items": from_spark(kind.elementType, kind.containsNull, name, space)}
    elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        out = {"type": "map", "values": from_spark(kind.valueType, kind.valueContainsNull, name, space)}
    elif isinstance(kind, T.StructType):
        out = {"type": "record", "name": name, "namespace": space, "fields": [{"name": f.name, "type": from_spark(f.dataType, f.nullable, f.name, f"{space}.{name}")} for f in kind]}
    else:
        raise SchemaError(f"no Avro schema for {kind.simpleString()}")
    return [out, "null"] if nullable else out


def _zigzag(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(b: io.BytesIO) -> int:
    shift = n = 0
    while True:
        c = b.read(1)[0]
        n |= (c & 0x7F) << shift
        if not c & 0x80:
            return (n >> 1) ^ -(n & 1)
        shift += 7


def _block(b: io.BytesIO, one: Callable[[], Any]) -> list:
    out = []
    while n := _number(b):
        if n < 0:
            _number(b)
        out += [one() for _ in range(abs(n))]
    return out


def _get(v: Any, name: str) -> Any:
    return v[name] if isinstance(v, dict) or hasattr(v, "__fields__") else getattr(v, name)


def _fits(v: Any, schema: Any) -> bool:
    if v is None:
        return _kind(schema) == "null"
    k = _kind(schema)
    if k == "null":
        return False
    if k == "int":
        return isinstance(v, int) and not isinstance(v, bool) and -(1 << 31) <= v < 1 << 31
    return True


@lru_cache(maxsize=256)
def codec(schema_text: str) -> tuple[Callable[[Any], bytes], Callable[[bytes], Any]]:
    """Encoder and decoder for one declared schema."""
    root, names = json.loads(schema_text), {}

    def note(s: Any) -> None:
        if isinstance(s, list):
            for x in s:
                note(x)
        elif isinstance(s, dict):
            if "name" in s and s.get("type") in ("record", "enum", "fixed"):
                names[s["name"]] = s
            for x in (s.get("type"), s.get("items"), s.get("values"), *(f["type"] for f in s.get("fields", []))):
                if isinstance(x, (dict, list)):
                    note(x)

    note(root)

    def plain(s: Any) -> Any:
        while True:
            if isinstance(s, str) and s in names:
                s = names[s]
            elif isinstance(s, dict) and isinstance(s.get("type"), (dict, list)):
                s = s["type"]
            else:
                return s

    def put(s: Any, v: Any) -> bytes:
        s = plain(s)
        k = _kind(s)
        if k == "union":
            i = next((i for i, x in enumerate(s) if _fits(v, plain(x))), None)
            if i is None:
                raise SchemaError(f"{v!r} fits no part of {s}")
            return _zigzag(i) + put(s[i], v)
        if k == "null":
            return b""
        if v is None:
            raise SchemaError(f"null for {s}")
        if k == "boolean":
            return b"\1" if v else b"\0"
        if k in ("int", "long"):
            return _zigzag(int(v))
        if k in ("float", "double"):
            return struct.pack("<f" if k == "float" else "<d", v)
        if k in ("bytes", "string"):
            raw = v.encode() if isinstance(v, str) else bytes(v)
            return _zigzag(len(raw)) + raw
        if k == "fixed":
            if len(v) != s["size"]:
                raise SchemaError(f"{len(v)} bytes for {s}")
            return bytes(v)
        if k == "enum":
            return _zigzag(s["symbols"].index(v))
        if k == "array":
            items = list(v)
            return (_zigzag(len(items)) + b"".join(put(s["items"], x) for x in items) if items else b"") + b"\0"
        if k == "map":
            items = list(v.items() if isinstance(v, dict) else v)
            return (_zigzag(len(items)) + b"".join(put("string", a) + put(s["values"], b) for a, b in items) if items else b"") + b"\0"
        if k == "record":
            return b"".join(put(f["type"], _get(v, f["name"])) for f in s["fields"])
        raise SchemaError(f"can't write {s}")

    def get(s: Any, b: io.BytesIO) -> Any:
        s = plain(s)
        k = _kind(s)
        if k == "union":
            return get(s[_number(b)], b)
        if k == "null":
            return None
        if k == "boolean":
            return b.read(1) == b"\1"
        if k in ("int", "long"):
            return _number(b)
        if k in ("float", "double"):
            return struct.unpack(*(("<f", b.read(4)) if k == "float" else ("<d", b.read(8))))[0]
        if k in ("bytes", "string"):
            raw = b.read(_number(b))
            return raw.decode() if k == "string" else raw
        if k == "fixed":
            return b.read(s["size"])
        if k == "enum":
            return s["symbols"][_number(b)]
        if k == "array":
            return _block(b, lambda: get(s["items"], b))
        if k == "map":
            return dict(_block(b, lambda: (get("string", b), get(s["values"], b))))
        if k == "record":
            return {f["name"]: get(f["type"], b) for f in s["fields"]}
        raise SchemaError(f"can't read {s}")

    return lambda v: put(root, v), lambda raw: get(root, io.BytesIO(raw))
