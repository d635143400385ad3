"""Table catalogs: JSON that maps (row key, family, qualifier) cells to a typed schema."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

#: Encoded widths in bytes of fixed-length types (fixed values).
WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}
VARIABLE = -1
#: What a variable-length key part counts in the length of a row key (fixed value).
VARIABLE_COUNTS = 256


_NAMED = {"boolean": T.BooleanType, "tinyint": T.ByteType, "smallint": T.ShortType, "int": T.IntegerType, "integer": T.IntegerType, "bigint": T.LongType, "long": T.LongType, "float": T.FloatType, "double": T.DoubleType, "string": T.StringType, "binary": T.BinaryType}


def type_of(text: str) -> T.DataType:
    """The type of a name or of maps of names, also where there is no session (in workers)."""
    text = text.strip()
    if text in _NAMED:
        return _NAMED[text]()
    if text.startswith("map<") and text.endswith(">"):
        key, _, value = text[4:-1].partition(",")
        return T.MapType(type_of(key), type_of(value))
    return T._parse_datatype_string(text)


class CatalogError(ValueError):
    """A catalog that contradicts itself or misses what it must declare."""


@dataclass(frozen=True)
class Field:
    name: str
    family: str
    qualifier: str
    type_name: str
    coder: str
    length: int = VARIABLE
    avro: str | None = None

    @property
    def is_key(self) -> bool:
        return self.family == "rowkey"

    @property
    def spark_type(self) -> T.DataType:
        if self.avro is not None:
            from cellgrid.functions.avro import to_spark

            return to_spark(json.loads(self.avro))[0]
        return type_of(self.type_name)

    @property
    def width(self) -> int:
        return self.length if self.length > 0 else WIDTHS.get(self.type_name, VARIABLE) if self.avro is None else VARIABLE

    @property
    def dynamic(self) -> str | None:
        """How a map column reads cells: by qualifier, by version, or both."""
        kind = self.spark_type if self.avro is None else None
        if not isinstance(kind, T.MapType):
            return None
        if isinstance(kind.keyType, T.LongType):
            return "versions"
        return "both" if isinstance(kind.valueType, T.MapType) else "qualifiers"

    @property
    def cell_type(self) -> T.DataType:
        kind = self.spark_type
        while self.avro is None and isinstance(kind, T.MapType):
            kind = kind.valueType
        return kind


@dataclass(frozen=True)
class Catalog:
    namespace: str
    name: str
    coder: str
    version: tuple[int, int]
    fields: tuple[Field, ...]
    keys: tuple[Field, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])

    @property
    def ddl(self) -> str:
        """The schema as text, which needs no session."""
        return ", ".join(f"`{f.name}` {f.type_name if f.avro is None else f.spark_type.simpleString()}" for f in self.fields)

    @property
    def columns(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if not f.is_key)

    @property
    def families(self) -> list[str]:
        return list(dict.fromkeys(f.family for f in self.columns))

    @property
    def key_length(self) -> int:
        return sum(VARIABLE_COUNTS if k.width == VARIABLE else k.width for k in self.keys)

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise CatalogError(f"no column {name!r} in the catalog of {self.name!r}")


def _version(text: str) -> tuple[int, int]:
    m = re.fullmatch(r"(\d+)(?:\.(\d+))?", text)
    if not m:
        raise CatalogError(f"version {text!r} is not N or N.M")
    return int(m[1]), int(m[2] or 0)


def parse(text: str, options: dict[str, str] | None = None) -> Catalog:
    """Read a catalog; ``options`` hold the schemas that ``avro`` names."""
    from cellgrid.functions import codecs

    tree, options = json.loads(text), options or {}

    def must(d: dict, key: str, what: str) -> str:
        if key not in d:
            raise CatalogError(f"{what} has no {key!r}")
        return d[key]

    table = must(tree, "table", "the catalog")
    version = _version(table.get("version", "1.0"))
    if version >= (2, 0) and "tableCoder" not in table:
        raise CatalogError("a catalog of version 2.0 or later must name its tableCoder")
    coder = table.get("tableCoder", "PrimitiveType")
    fields = []
    for name, c in must(tree, "columns", "the catalog").items():
        avro = None
        if "avro" in c:
            if c["avro"] not in options:
                raise CatalogError(f"column {name!r} names the option {c['avro']!r}, which is not given")
            avro = options[c["avro"]]
        own = "Avro" if avro is not None else c.get("coder", coder)
        kind = c.get("type", "binary").strip().lower()
        fields.append(Field(name, c.get("cf", "rowkey"), must(c, "col", f"column {name!r}"), kind, own, int(c.get("length", VARIABLE)), avro))
    keys = []
    for part in must(tree, "rowkey", "the catalog").split(":"):
        found = [f for f in fields if f.is_key and f.qualifier == part]
        if not found:
            raise CatalogError(f"row key part {part!r} has no column")
        keys.append(found[0])
    table_codec = codecs.get(coder)
    if not table_codec.row_keys:
        raise CatalogError(f"{coder} can't encode row keys")
    others = {f.coder for f in fields} | {coder}
    if len(others - {"Avro"}) > 1:
        raise CatalogError(f"one table can't mix the coders {sorted(others)}")
    if len(keys) > 1:
        if not table_codec.composite_keys:
            raise CatalogError(f"{coder} has no composite keys")
        if table_codec.fixed_parts and any(k.width == VARIABLE for k in keys[:-1]):
            raise CatalogError("only the last part of a composite key may be of variable length")
    return Catalog(table.get("namespace", "default"), must(table, "name", "the table"), coder, version, tuple(fields), tuple(keys))
