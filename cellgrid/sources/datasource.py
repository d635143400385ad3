"""``format("cellgrid")``: tables behind the reader and writer APIs and SQL's ``INSERT INTO``.

A reader task serves one region: the snapshot's rows of keys that were not
written since, and the newest cells of those that were.  Filters on the first
key column pick regions; Spark applies all filters again.  A writer task
encodes its rows as cells in a staging folder, which the commit renames, so a
task that is run twice or a write that fails leaves nothing to be read.

A region is merged in the memory of one task.  Large reads go through
``Table.read``, which Catalyst plans.  Paths are those of ``pyarrow.fs``.
"""

from __future__ import annotations

import json
import time
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from cellgrid.functions import codecs
from cellgrid.operators import pushdown
from cellgrid.operators.ranges import EVERYTHING, intersect
from cellgrid.sources.catalog import Catalog, Field, parse

_OPS = {EqualTo: "=", EqualNullSafe: "<=>", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", StringStartsWith: "startswith", In: "in"}


class _Options(dict):
    """Options by name without case, as Spark keeps them."""

    def __init__(self, options: dict[str, str]) -> None:
        super().__init__({k.lower(): v for k, v in options.items()})

    def __getitem__(self, key: str) -> str:
        return super().__getitem__(key.lower())

    def __contains__(self, key: object) -> bool:
        return super().__contains__(str(key).lower())

    def get(self, key: str, default: str | None = None) -> str | None:
        return super().get(key.lower(), default)


class _Store:
    """The folders of one table."""

    def __init__(self, options: dict[str, str], catalog: Catalog) -> None:
        from pyarrow import fs

        path = f"{options['root'].rstrip('/')}/{catalog.namespace}/{catalog.name}"
        self.fs, self.path = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def names(self, at: str) -> list[str]:
        from pyarrow import fs

        return sorted(f.base_name for f in self.fs.get_file_info(fs.FileSelector(f"{self.path}/{at}", allow_not_found=True)))

    def manifest(self) -> dict:
        found = [n for n in self.names("manifest") if n.endswith(".json")]
        if not found:
            raise FileNotFoundError(f"no table at {self.path}")
        with self.fs.open_input_stream(f"{self.path}/manifest/{found[-1]}") as f:
            return json.loads(f.read())

    def publish(self, manifest: dict) -> None:
        old = [n for n in self.names("manifest") if n.endswith(".json")]
        number = int(old[-1].split(".")[0]) + 1 if old else 0
        part = f"{self.path}/manifest/.{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.path}/manifest", recursive=True)
        with self.fs.open_output_stream(part) as f:
            f.write(json.dumps(manifest).encode())
        self.fs.move(part, f"{self.path}/manifest/{number:012d}.json")

    def files(self, folder: str) -> list[str]:
        return [f"{self.path}/{folder}/{n}" for n in self.names(folder) if n.endswith(".parquet")]

    def rows(self, folder: str, columns: list[str]) -> Iterator[dict]:
        import pyarrow.parquet as pq

        for name in self.files(folder):
            with self.fs.open_input_file(name) as f, pq.ParquetFile(f) as p:
                for batch in p.iter_batches(columns=columns):
                    yield from batch.to_pylist()


@dataclass
class _Region(InputPartition):
    number: int


class CellSource(DataSource):
    """Options: ``root``, ``catalog``, and what the catalog names; for new tables ``newtable`` and ``maxVersions``."""

    @classmethod
    def name(cls) -> str:
        return "cellgrid"

    def _catalog(self) -> Catalog:
        return parse(_Options(self.options)["catalog"], _Options(self.options))

    def schema(self) -> str:
        return self._catalog().ddl

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_Options(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(_Options(self.options), schema, overwrite)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType) -> None:
        self.options, self.names = options, schema.names
        self.ranges = EVERYTHING

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        catalog = parse(self.options["catalog"], self.options)
        for f in filters:
            op = _OPS.get(type(f))
            if op and len(f.attribute) == 1:
                self.ranges = intersect(self.ranges, pushdown.key_ranges((op, f.attribute[0], list(f.value) if op == "in" else f.value), catalog))
            yield f  # regions hold more than what is asked for

    def partitions(self) -> list[InputPartition]:
        catalog = parse(self.options["catalog"], self.options)
        splits = [bytes.fromhex(s) for s in _Store(self.options, catalog).manifest()["splits"]]
        return [_Region(n) for n in pushdown.regions(self.ranges, splits)] or [_Region(-1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        catalog = parse(self.options["catalog"], self.options)
        store = _Store(self.options, catalog)
        manifest, keys = store.manifest(), [k.name for k in catalog.keys]
        writes = [w for w in store.names("cells") if w.startswith("w=")]
        region = partition.number
        typing = json.dumps([[f.name, f.family, f.qualifier, f.type_name, f.coder, f.length, f.avro] for f in catalog.fields])
        whole = manifest["snapshot"] is not None and manifest["fields"] == typing
        changed: set | None = None
        if whole:
            held = set(manifest["holds"])
            changed = {tuple(r.values()) for w in writes if w not in held for r in store.rows(f"cells/{w}/region={region}", [f"k_{k}" for k in keys])}
            for r in store.rows(f"snapshots/{manifest['snapshot']}/_region={region}", list(dict.fromkeys([*keys, *self.names]))):
                if not changed or tuple(r[k] for k in keys) not in changed:
                    yield tuple(r[n] for n in self.names)
            if not changed:
                return
        newest: dict[tuple, dict[tuple, tuple]] = {}
        for w in writes:
            for r in store.rows(f"cells/{w}/region={region}", [*(f"k_{k}" for k in keys), "cf", "qualifier", "ts", "batch", "seq", "value"]):
                key = tuple(r[f"k_{k}"] for k in keys)
                if changed is None or key in changed:
                    cells, at, age = newest.setdefault(key, {}), (r["cf"], r["qualifier"]), (r["ts"], r["batch"], r["seq"])
                    if at not in cells or cells[at][0] < age:
                        cells[at] = (age, r["value"])
        for key, cells in newest.items():
            row = dict(zip(keys, key))
            yield tuple(row[n] if n in row else _value(catalog, catalog.field(n), cells) for n in self.names)


def _value(catalog: Catalog, f: Field, cells: dict[tuple, tuple]) -> object:
    """A column from the newest cells of a row."""
    unpack = codecs.get(f.coder).unpack
    if f.dynamic in ("qualifiers", "both"):
        own = {g.qualifier for g in catalog.columns if g.family == f.family and g.qualifier}
        found = {q: (age[0], unpack(v, f.cell_type, f.avro)) for (cf, q), (age, v) in sorted(cells.items()) if cf == f.family and q not in own}
        return {q: {t: v} if f.dynamic == "both" else v for q, (t, v) in found.items()} or None
    if (f.family, f.qualifier) not in cells:
        return None
    age, raw = cells[f.family, f.qualifier]
    v = unpack(raw, f.cell_type, f.avro)
    return {age[0]: v} if f.dynamic == "versions" else v


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool) -> None:
        self.options, self.names, self.overwrite = options, schema.names, overwrite
        self.batch = time.time_ns()
        self.ts = int(options.get("timestamp", self.batch // 1_000_000))
        self.id = f"{self.batch}-{uuid.uuid4().hex[:8]}"
        catalog = parse(options["catalog"], options)
        missing = [k.name for k in catalog.keys if k.name not in self.names] + [n for n in self.names if n not in {f.name for f in catalog.fields}]
        if missing:
            raise ValueError(f"columns {missing} are missing or not in the catalog")
        store = _Store(options, catalog)
        if not store.names("manifest"):
            from cellgrid.sources.table import RegionNumberError, split_points

            n = int(options.get("newtable", 0))
            if 0 < n <= 3:
                raise RegionNumberError(f"{n} regions; more than 3 are needed")
            points = split_points(options.get("minTableSplitPoint", "aaaaaa").encode(), options.get("maxTableSplitPoint", "zzzzzz").encode(), n) if n else []
            store.publish({"splits": [s.hex() for s in points], "retain": int(options.get("maxVersions", 1)), "snapshot": None, "holds": [], "fields": None})

    def write(self, rows: Iterator) -> WriterCommitMessage:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        catalog = parse(self.options["catalog"], self.options)
        store = _Store(self.options, catalog)
        splits = [bytes.fromhex(s) for s in store.manifest()["splits"]]
        keys = catalog.keys
        schema = pa.schema([*((f"k_{k.name}", to_arrow_type(k.spark_type)) for k in keys), ("rowkey", pa.binary()), ("cf", pa.string()), ("qualifier", pa.string()), ("ts", pa.int64()), ("seq", pa.int64()), ("value", pa.binary()), ("batch", pa.int64())])
        held: dict[int, list[dict]] = {}
        context = TaskContext.get()
        seq, made = context.partitionId() << 33, f"{context.partitionId()}-{context.taskAttemptId()}"

        def flush(region: int) -> None:
            folder = f"{store.path}/cells/.{self.id}/{made}/region={region}"
            store.fs.create_dir(folder, recursive=True)
            with store.fs.open_output_stream(f"{folder}/{uuid.uuid4().hex}.parquet") as f:
                pq.write_table(pa.Table.from_pylist(held.pop(region), schema), f)

        for r in rows:
            row = dict(zip(self.names, r))
            parts = [(row[k.name], k.spark_type, k.width) for k in keys]
            if any(v is None for v, _, _ in parts):
                raise ValueError("a row key part is null")
            coder = codecs.get("Avro") if len(keys) == 1 and keys[0].avro else codecs.get(catalog.coder)
            key = coder.pack(parts[0][0], parts[0][1], keys[0].avro) if keys[0].avro else coder.pack_key(parts)
            region = bisect_right(splits, key)
            out = held.setdefault(region, [])
            fixed = {f"k_{k.name}": row[k.name].asDict(True) if hasattr(row[k.name], "asDict") else row[k.name] for k in keys} | {"rowkey": key, "batch": self.batch}
            out.append(fixed | {"cf": "", "qualifier": "", "ts": self.ts, "seq": seq, "value": None})
            for f in catalog.columns:
                for q, ts, v in _cells(f, row.get(f.name), self.ts):
                    seq += 1
                    out.append(fixed | {"cf": f.family, "qualifier": q, "ts": ts, "seq": seq, "value": codecs.get(f.coder).pack(v, f.cell_type, f.avro)})
            seq += 1
            if len(out) >= 50_000:
                flush(region)
        for region in list(held):
            flush(region)
        return _Done(made)

    def commit(self, messages: list) -> None:
        catalog = parse(self.options["catalog"], self.options)
        store = _Store(self.options, catalog)
        old = [w for w in store.names("cells") if w.startswith("w=")] if self.overwrite else []
        staged, final = f"{store.path}/cells/.{self.id}", f"{store.path}/cells/w={self.id}"
        whole = f"{staged}/whole"
        for m in messages:
            if m is None:
                continue
            for region in store.names(f"cells/.{self.id}/{m.made}"):
                store.fs.create_dir(f"{whole}/{region}", recursive=True)
                for n in store.names(f"cells/.{self.id}/{m.made}/{region}"):
                    store.fs.move(f"{staged}/{m.made}/{region}/{n}", f"{whole}/{region}/{n}")
        if store.names(f"cells/.{self.id}/whole"):
            store.fs.move(whole, final)
        if store.names(f"cells/.{self.id}"):
            store.fs.delete_dir(staged)
        if self.overwrite:
            store.publish(store.manifest() | {"snapshot": None, "holds": [], "fields": None})
            for w in old:
                store.fs.delete_dir(f"{store.path}/cells/{w}")

    def abort(self, messages: list) -> None:
        store = _Store(self.options, parse(self.options["catalog"], self.options))
        if f".{self.id}" in store.names("cells"):
            store.fs.delete_dir(f"{store.path}/cells/.{self.id}")


@dataclass
class _Done(WriterCommitMessage):
    made: str


def _cells(f: Field, v: object, ts: int) -> Iterator[tuple[str, int, object]]:
    """(qualifier, timestamp, value) of a column's value."""
    if v is None:
        return
    if f.dynamic is None:
        yield f.qualifier, ts, v
    elif f.dynamic == "versions":
        yield from ((f.qualifier, t, x) for t, x in v.items() if x is not None)
    elif f.dynamic == "qualifiers":
        yield from ((q, ts, x) for q, x in v.items() if x is not None)
    else:
        yield from ((q, t, x) for q, m in v.items() for t, x in m.items() if x is not None)


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark pass filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CellSource)


def attach(spark: SparkSession, name: str, root: str, catalog: str, **options: str) -> None:
    """A table under a name for SQL, which also takes ``INSERT INTO``; it is made when rows first come."""
    register(spark)
    spark.read.format("cellgrid").options(root=root, catalog=catalog, **options).load().createOrReplaceTempView(name)
