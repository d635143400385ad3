"""Catalogued tables: cells in Parquet, dealt out by key regions, read as typed DataFrames.

A cell is (typed key columns, rowkey, family, qualifier, ts, batch, seq,
value).  Each write appends a folder of cells; reading reduces them to the
versions asked for and decodes them.  Typed key columns are part of the
grouping, so predicates on keys pass below it into partition and row-group
pruning.

``compact`` writes the newest values as a typed snapshot.  From then on a
read of newest values scans the snapshot and reduces cells only for the keys
that were written after it.  The manifest says which snapshot counts and
which writes it holds; it is replaced by renaming a whole file, so readers
see the state before a change or after it.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellgrid.functions import codecs
from cellgrid.operators import pushdown
from cellgrid.sources.catalog import Catalog, Field, parse

#: The cell that keeps a row without other cells in being.
_MARKER = ""

log = logging.getLogger("cellgrid.table")


class RegionNumberError(ValueError):
    """A new table needs more than three regions."""


@dataclass(frozen=True)
class ReadOptions:
    """``timestamp`` for one version, ``min_stamp`` and ``max_stamp`` for [min, max); ``restrictive`` COLUMN, FAMILY or NONE."""

    timestamp: int | None = None
    min_stamp: int | None = None
    max_stamp: int | None = None
    max_versions: int | None = None
    merge_to_latest: bool = True
    restrictive: str = "COLUMN"
    with_timestamp: bool = False

    @classmethod
    def of(cls, options: dict[str, str]) -> ReadOptions:
        def number(key: str) -> int | None:
            return int(options[key]) if key in options else None

        return cls(number("timestamp"), number("minStamp"), number("maxStamp"), number("maxVersions"), str(options.get("mergeToLatest", "true")).lower() == "true", str(options.get("restrictive", "COLUMN")).upper())

    def check(self) -> None:
        pair = (self.min_stamp is not None, self.max_stamp is not None)
        if pair[0] != pair[1] or (self.timestamp is not None and any(pair)):
            raise ValueError("give timestamp alone, or minStamp and maxStamp together")
        if self.restrictive not in ("COLUMN", "FAMILY", "NONE"):
            raise ValueError(f"restrictive is COLUMN, FAMILY or NONE, not {self.restrictive}")


def split_points(low: bytes, high: bytes, regions: int) -> list[bytes]:
    """``regions - 1`` keys: both bounds and evenly spaced ones between them."""
    width = max(len(low), len(high)) + 1
    a, b = (int.from_bytes(x.ljust(width, b"\0"), "big") for x in (low, high))
    if a >= b:
        raise ValueError("the lower split point is not below the upper one")
    n = regions - 2
    inner = [(a + (b - a) * k // n).to_bytes(width, "big").rstrip(b"\0") for k in range(1, n)]
    return [low, *inner, high]


class Table:
    """One table under ``root``; ``root`` stands for a cluster, and tables of several roots can be joined."""

    def __init__(self, spark: SparkSession, root: str, catalog: str | Catalog, options: dict[str, str] | None = None) -> None:
        self.spark, self.options = spark, dict(options or {})
        self.catalog = catalog if isinstance(catalog, Catalog) else parse(catalog, self.options)
        self.path = f"{root.rstrip('/')}/{self.catalog.namespace}/{self.catalog.name}"

    # Where things lie.

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, path: str) -> list[str]:
        """Names in a folder, sorted; a missing folder is empty."""
        fs, p = self._fs(path)
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def exists(self) -> bool:
        return any(n.endswith(".json") for n in self._names(f"{self.path}/manifest"))

    def manifest(self) -> dict:
        """``splits``, ``retain``, ``snapshot`` (its folder or none), ``holds`` (the writes in it), ``fields`` (as it was typed)."""
        found = [n for n in self._names(f"{self.path}/manifest") if n.endswith(".json")]
        if not found:
            raise FileNotFoundError(f"no table at {self.path}")
        fs, p = self._fs(f"{self.path}/manifest/{found[-1]}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        """A new manifest under the next number; older ones stay until the table is dropped."""
        old = [n for n in self._names(f"{self.path}/manifest") if n.endswith(".json")]
        number = int(old[-1].split(".")[0]) + 1 if old else 0
        fs, part = self._fs(f"{self.path}/manifest/.{uuid.uuid4().hex}")
        stream = fs.create(part)
        try:
            stream.write(json.dumps(manifest).encode())
        finally:
            stream.close()
        if not fs.rename(part, self._fs(f"{self.path}/manifest/{number:012d}.json")[1]):
            raise RuntimeError(f"another writer changed the manifest of {self.path}")

    def drop(self) -> None:
        fs, p = self._fs(self.path)
        fs.delete(p, True)

    # Keys and cells.

    def _parts(self) -> list[tuple[Field, T.DataType, int]]:
        return [(k, k.spark_type, k.width) for k in self.catalog.keys]

    def _codec(self, f: Field) -> codecs.Codec:
        return codecs.get(f.coder)

    def rowkey(self, columns: dict[str, Column]) -> Column:
        parts = self._parts()
        if len(parts) == 1 and parts[0][0].avro is not None:
            key = codecs.get("Avro").encode(columns[parts[0][0].name], parts[0][1], parts[0][0].avro)
        else:
            key = codecs.get(self.catalog.coder).encode_key([(columns[k.name], kind, width) for k, kind, width in parts])
        null = F.lit(False)
        for k, _, _ in parts:
            null = null | columns[k.name].isNull()
        return F.when(null, F.raise_error(F.lit("a row key part is null")).cast("binary")).otherwise(key)

    def _key_columns(self) -> list[str]:
        return [f"k_{k.name}" for k in self.catalog.keys]

    @staticmethod
    def region_of(key: Column, splits: list[bytes]) -> Column:
        """The number of splits that are not above ``key``, by halving."""

        def among(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(key >= F.lit(bytearray(splits[mid])), among(mid + 1, high)).otherwise(among(low, mid))

        return among(0, len(splits))

    def key_bytes(self, *values: object) -> bytes:
        """The row key of typed values (of the first key parts, at least), as it is stored."""
        parts = self.catalog.keys[: len(values)]
        raw = [self._codec(k).literal(v, k.spark_type) for k, v in zip(parts, values)]
        if any(r is None for r in raw):
            raise ValueError(f"{values} can't be written as keys that keep their order")
        return b"".join(raw)

    def points_of(self, df: DataFrame, regions: int, sample: int = 100_000) -> list[bytes]:
        """``regions - 1`` split points that deal the keys of ``df`` out evenly, from about ``sample`` of its rows."""
        columns = {k.name: F.col(k.name).cast(k.spark_type) for k in self.catalog.keys}
        step = max(1, df.count() // sample)
        keys = df.where(F.pmod(F.xxhash64(*columns), F.lit(step)) == 0).select(self.rowkey(columns).alias("k")).distinct()
        found = sorted(bytes(r.k) for r in keys.collect())  # bounded by the sample
        return sorted({found[len(found) * i // regions] for i in range(1, regions)}) if found else []

    def create(self, regions: int | None = None, retain: int | None = None, splits: Sequence[object] | None = None) -> None:
        """The manifest: split points and how many versions are kept.

        ``splits`` are values of the first key column, tuples of several, or bytes of row keys; without them
        the options give text bounds, between which points are spaced evenly.
        """
        n = int(regions if regions is not None else self.options.get("newtable", 0))
        points: list[bytes] = []
        if splits is not None:
            points = sorted({bytes(x) if isinstance(x, (bytes, bytearray)) else self.key_bytes(*(x if isinstance(x, tuple) else (x,))) for x in splits})
        elif n:
            if n <= 3:
                raise RegionNumberError(f"{n} regions; more than 3 are needed")
            points = split_points(self.options.get("minTableSplitPoint", "aaaaaa").encode(), self.options.get("maxTableSplitPoint", "zzzzzz").encode(), n)
        kept = retain if retain is not None else int(self.options.get("maxVersions", 1))
        self._publish({"splits": [s.hex() for s in points], "retain": kept, "snapshot": None, "holds": [], "fields": None})
        log.info("created %s with %d regions", self.path, len(points) + 1)

    def cells(self, df: DataFrame, timestamp: int | None, splits: list[bytes]) -> DataFrame:
        """The cells of typed rows; null columns have none, and a marker keeps the row."""
        unknown = set(df.columns) - {f.name for f in self.catalog.fields}
        if unknown:
            raise ValueError(f"columns {sorted(unknown)} are not in the catalog")
        ts = timestamp if timestamp is not None else int(self.options["timestamp"]) if "timestamp" in self.options else int(time.time() * 1000)
        missing = [k.name for k in self.catalog.keys if k.name not in df.columns]
        if missing:
            raise ValueError(f"row key columns {missing} are missing")
        column = {c: F.col(c).cast(self.catalog.field(c).spark_type) if self.catalog.field(c).avro is None else F.col(c) for c in df.columns}
        keyed = df.select(self.rowkey(column).alias("rowkey"), *(column[k.name].alias(f"k_{k.name}") for k in self.catalog.keys), *(column[f.name].alias(f"c_{f.name}") for f in self.catalog.columns if f.name in df.columns))
        cell = "struct<cf:string,qualifier:string,ts:bigint,value:binary>"
        groups = [F.array(F.struct(F.lit(_MARKER).alias("cf"), F.lit(_MARKER).alias("qualifier"), F.lit(ts).cast("bigint").alias("ts"), F.lit(None).cast("binary").alias("value")))]

        def one(f: Field, q: Column, t: Column, v: Column) -> Column:
            return F.struct(F.lit(f.family).alias("cf"), q.alias("qualifier"), t.cast("bigint").alias("ts"), self._codec(f).encode(v, f.cell_type, f.avro).alias("value"))

        for f in self.catalog.columns:
            if f.name not in df.columns:
                continue
            c = F.col(f"c_{f.name}")
            if f.dynamic is None:
                groups.append(F.array(one(f, F.lit(f.qualifier), F.lit(ts), c)))
        # A map becomes one row for each entry before its values are encoded, as encoders may be batch functions.
        out = keyed.select("rowkey", *self._key_columns(), F.explode(F.concat(*(g.cast(f"array<{cell}>") for g in groups))).alias("x"))
        for f in self.catalog.columns:
            if f.name not in df.columns or f.dynamic is None:
                continue
            rows = keyed.select("rowkey", *self._key_columns(), F.explode(f"c_{f.name}").alias("a", "b"))
            if f.dynamic == "versions":
                x = one(f, F.lit(f.qualifier), F.col("a"), F.col("b"))
            elif f.dynamic == "qualifiers":
                x = one(f, F.col("a"), F.lit(ts), F.col("b"))
            else:
                rows = rows.select("rowkey", *self._key_columns(), F.col("a").alias("q"), F.explode("b").alias("a", "b"))
                x = one(f, F.col("q"), F.col("a"), F.col("b"))
            out = out.unionByName(rows.select("rowkey", *self._key_columns(), x.cast(cell).alias("x")))
        out = out.where(F.col("x.value").isNotNull() | (F.col("x.cf") == _MARKER))
        return out.select(*self._key_columns(), "rowkey", "x.cf", "x.qualifier", "x.ts", F.monotonically_increasing_id().alias("seq"), "x.value", self.region_of(F.col("rowkey"), splits).alias("region"))

    def write(self, df: DataFrame, timestamp: int | None = None, overwrite: bool = False, write_id: str | None = None) -> None:
        """Upsert: newer cells hide older ones.  ``overwrite`` drops the table first.

        Of equal timestamps the later write counts.  A write that is repeated under the same ``write_id`` replaces itself.
        """
        if overwrite and self.exists():
            self.drop()
        if not self.exists():
            self.create()
        splits = [bytes.fromhex(s) for s in self.manifest()["splits"]]
        batch = time.time_ns()
        cells = self.cells(df, timestamp, splits).withColumn("batch", F.lit(batch).cast("bigint"))
        counted = Observation()
        cells = cells.observe(counted, F.count("*").alias("cells"))
        # Tasks keep their rows, so a region of a third of all rows is written by many of them.
        cells.sortWithinPartitions("region", "rowkey", "cf", "qualifier").write.mode("overwrite").partitionBy("region").parquet(f"{self.path}/cells/w={write_id or f'{batch}-{uuid.uuid4().hex[:8]}'}")
        log.info("wrote %s cells to %s", counted.get["cells"], self.path)

    def insert(self, df: DataFrame, overwrite: bool = False) -> None:
        """``INSERT INTO``: the columns of ``df`` count by their places, as in SQL."""
        names = [f.name for f in self.catalog.fields]
        if len(df.columns) != len(names):
            raise ValueError(f"{len(df.columns)} columns for the {len(names)} of {self.catalog.name}")
        self.write(df.toDF(*names), overwrite=overwrite)

    # Reading.

    def _stored(self, writes: list[str] | None = None) -> DataFrame:
        """All cells, or those of some writes."""
        keys = [T.StructField(f"k_{k.name}", k.spark_type) for k in self.catalog.keys]
        rest = [T.StructField("rowkey", T.BinaryType()), T.StructField("cf", T.StringType()), T.StructField("qualifier", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("value", T.BinaryType()), T.StructField("batch", T.LongType()), T.StructField("region", T.IntegerType())]
        schema = T.StructType(keys + rest)
        names = self._names(f"{self.path}/cells") if writes is None else writes
        # A write that ended early has no folder of any region.
        paths = [f"{self.path}/cells/{n}" for n in names if n.startswith("w=") and any(x.startswith("region=") for x in self._names(f"{self.path}/cells/{n}"))]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField("w", T.StringType())])).option("basePath", f"{self.path}/cells").parquet(*paths).drop("w")

    def regions(self, where: pushdown.Predicate | None) -> list[int]:
        splits = [bytes.fromhex(s) for s in self.manifest()["splits"]]
        return pushdown.regions(pushdown.key_ranges(where, self.catalog), splits)

    def _typing(self) -> str:
        return json.dumps([[f.name, f.family, f.qualifier, f.type_name, f.coder, f.length, f.avro] for f in self.catalog.fields])

    def _in_regions(self, df: DataFrame, manifest: dict, where: pushdown.Predicate | None, column: str) -> DataFrame:
        """Only the regions that ``where`` can meet; the folders of the others are not read."""
        if where is None or not manifest["splits"]:
            return df
        wanted = pushdown.regions(pushdown.key_ranges(where, self.catalog), [bytes.fromhex(s) for s in manifest["splits"]])
        log.info("%s: %d of %d regions for %s", self.path, len(wanted), len(manifest["splits"]) + 1, where)
        if len(wanted) > len(manifest["splits"]):
            return df
        return df.where(F.col(column).isin(wanted) if wanted else F.lit(False))

    def read(self, where: pushdown.Predicate | None = None, columns: list[str] | None = None, options: ReadOptions | None = None, keys: DataFrame | None = None, observe: Observation | None = None) -> DataFrame:
        """Typed rows.  ``where`` also picks regions; ``columns`` limits which cells are fetched; ``keys`` which rows.

        ``observe`` counts the rows that are returned, as ``rows``.
        """
        o = options or ReadOptions.of(self.options)
        o.check()
        manifest = self.manifest()
        plain = o.timestamp is None and o.min_stamp is None and o.merge_to_latest and (o.max_versions or 1) == 1 and not any(f.dynamic in ("versions", "both") for f in self.catalog.columns)
        if manifest["snapshot"] and plain and manifest["fields"] == self._typing():
            df = self._with_snapshot(manifest, where, columns, o, keys)
        else:
            df = self._reduced(self._stored(), manifest, where, columns, o, keys)
        return df.observe(observe, F.count("*").alias("rows")) if observe is not None else df

    def _with_snapshot(self, manifest: dict, where: pushdown.Predicate | None, columns: list[str] | None, o: ReadOptions, keys: DataFrame | None) -> DataFrame:
        names = [k.name for k in self.catalog.keys]
        wanted = [f.name for f in self.catalog.fields] if columns is None else columns
        schema = T.StructType([*self.catalog.schema.fields, T.StructField("_region", T.IntegerType())])
        old = self.spark.read.schema(schema).parquet(f"{self.path}/snapshots/{manifest['snapshot']}")
        old = self._in_regions(old, manifest, where, "_region")
        if where is not None:
            old = old.where(pushdown.to_column(where))
        if keys is not None:
            old = old.join(keys.select(*names).distinct(), names, "left_semi")
        later = [w for w in self._names(f"{self.path}/cells") if w not in set(manifest["holds"])]
        if not later:
            return old.select(*wanted)
        # Keys are compared as stored bytes, which also tells -0.0 from 0.0.
        changed = self._in_regions(self._stored(later), manifest, where, "region").select(*(F.col(f"k_{n}").alias(n) for n in names)).distinct()
        if keys is not None:
            changed = changed.join(keys.select(*names).distinct(), names, "left_semi")
        new = self._reduced(self._stored(), manifest, where, columns, o, changed)
        return old.join(changed, names, "left_anti").select(*wanted).unionByName(new)

    def _reduced(self, cells: DataFrame, manifest: dict, where: pushdown.Predicate | None, columns: list[str] | None, o: ReadOptions, only: DataFrame | None) -> DataFrame:
        """Rows from cells; ``only`` takes the cells of some keys before anything is grouped."""
        tested = pushdown.columns_of(where)
        fields = [f for f in self.catalog.columns if columns is None or f.name in columns or tested is None or f.name in tested]
        cells = self._in_regions(cells, manifest, where, "region")
        if only is not None:
            cells = cells.join(only.select(*(F.col(k.name).cast(k.spark_type).alias(f"k_{k.name}") for k in self.catalog.keys)).distinct(), self._key_columns(), "left_semi")
        if o.timestamp is not None:
            cells = cells.where(F.col("ts") == o.timestamp)
        if o.min_stamp is not None:
            cells = cells.where((F.col("ts") >= o.min_stamp) & (F.col("ts") < o.max_stamp))
        marker = F.col("cf") == _MARKER
        if o.restrictive == "COLUMN" and not any(f.dynamic in ("qualifiers", "both") for f in fields):
            test = marker
            for f in fields:
                test = test | ((F.col("cf") == f.family) & (F.col("qualifier") == f.qualifier))
            cells = cells.where(test)
        elif o.restrictive != "NONE":
            cells = cells.where(marker | F.col("cf").isin([f.family for f in fields]))
        keys = [*self._key_columns(), "rowkey"]
        versions = o.max_versions if o.max_versions is not None else 1
        many = not o.merge_to_latest or versions > 1 or any(f.dynamic in ("versions", "both") for f in fields)
        age = F.struct("ts", "batch", "seq")
        if many:
            # The last write of a (cell, ts) hides earlier ones; then the newest versions count.
            same = Window.partitionBy(*keys, "cf", "qualifier", "ts").orderBy(F.desc("batch"), F.desc("seq"))
            newest = Window.partitionBy(*keys, "cf", "qualifier").orderBy(F.desc("ts"))
            cells = cells.withColumn("_n", F.row_number().over(same)).where("_n = 1").withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= min(versions, max(1, manifest["retain"]))).drop("_n")
        group = keys if o.merge_to_latest else [*keys, "ts"]

        def here(f: Field) -> Column:
            if f.dynamic in ("qualifiers", "both"):
                own = [g.qualifier for g in self.catalog.columns if g.family == f.family and g.qualifier]
                test = F.col("cf") == f.family
                return test & ~F.col("qualifier").isin(own) if own else test
            return (F.col("cf") == f.family) & (F.col("qualifier") == f.qualifier)

        if not o.merge_to_latest:
            cells = cells.where(~marker)
        maps = [f for f in fields if f.dynamic]
        aggs = [F.max_by(F.when(here(f), F.col("value")), F.when(here(f), age)).alias(f"c_{f.name}") for f in fields if not f.dynamic]
        typed = cells
        for f in maps:  # map values are decoded as cells, before they are gathered
            typed = typed.withColumn(f"v_{f.name}", self._codec(f).decode(F.when(here(f), F.col("value")), f.cell_type, f.avro))
        if maps and not many:
            last = Window.partitionBy(*keys, "cf", "qualifier").orderBy(F.desc("ts"), F.desc("batch"), F.desc("seq"))
            typed = typed.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
        for f in maps:
            v, test = F.col(f"v_{f.name}"), here(f)
            if f.dynamic == "versions":
                item = F.struct(F.col("ts").alias("a"), v.alias("b"))
            elif f.dynamic == "qualifiers":
                item = F.struct(F.col("qualifier").alias("q"), F.col("ts").alias("t"), v.alias("b"))
            else:
                item = F.struct(F.col("qualifier").alias("q"), F.col("ts").alias("a"), v.alias("b"))
            aggs.append(F.sort_array(F.collect_list(F.when(test, item))).alias(f"c_{f.name}"))
        rows = typed.groupBy(*group).agg(*aggs) if aggs else typed.select(*group).distinct()
        out: list[Column] = []
        for f in self.catalog.fields:
            if columns is not None and f.name not in columns and tested is not None and f.name not in tested:
                continue
            c = F.col(f"k_{f.name}" if f.is_key else f"c_{f.name}")
            if not f.is_key and not f.dynamic:
                c = self._codec(f).decode(c, f.cell_type, f.avro)
            elif f.dynamic == "versions":
                c = F.when(F.size(c) > 0, F.map_from_entries(c))
            elif f.dynamic == "qualifiers":
                # Entries are ordered by qualifier and time; the last one of a qualifier counts.
                kept = F.filter(c, lambda x, i: F.coalesce(F.get(F.col(f"c_{f.name}"), i + 1)["q"] != x["q"], F.lit(True)))
                c = F.when(F.size(c) > 0, F.map_from_entries(F.transform(kept, lambda x: F.struct(x["q"], x["b"]))))
            elif f.dynamic == "both":
                names = F.array_distinct(F.transform(c, lambda x: x["q"]))
                inner = lambda q, c=c: F.map_from_entries(F.transform(F.filter(c, lambda x: x["q"] == q), lambda x: F.struct(x["a"], x["b"])))
                c = F.when(F.size(c) > 0, F.map_from_entries(F.transform(names, lambda q: F.struct(q, inner(q)))))
            out.append(c.alias(f.name))
        if o.with_timestamp and not o.merge_to_latest:
            out.append(F.col("ts").alias("_ts"))
        df = rows.select(*out)
        if not o.merge_to_latest:
            df = df.distinct()
        if where is not None:
            df = df.where(pushdown.to_column(where))
        return df.select(*columns, *(["_ts"] if o.with_timestamp and not o.merge_to_latest else [])) if columns is not None else df

    def with_options(self, **options: str) -> Table:
        """The same table with other read or write options."""
        return Table(self.spark, self.path.rsplit("/", 2)[0], self.catalog, self.options | {k: str(v) for k, v in options.items()})

    def count_keys(self) -> int:
        """Keys, whatever the versions; no cell is decoded."""
        return self._stored().select("rowkey").distinct().count()

    def view(self, name: str, **kw) -> DataFrame:
        """Register for SQL."""
        df = self.read(**kw)
        df.createOrReplaceTempView(name)
        return df

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows whose keys occur in ``keys`` (any number of them): cells are joined before they are grouped."""
        return self.read(keys=keys)

    def compact(self, trim: bool = False) -> None:
        """Write the newest values as one typed snapshot, sorted by key within regions, that reads without a shuffle.

        ``trim`` also rewrites the cells it holds, without the versions that no read may see any more.
        """
        manifest = self.manifest()
        splits = [bytes.fromhex(s) for s in manifest["splits"]]
        held = [w for w in self._names(f"{self.path}/cells") if w.startswith("w=")]
        new = uuid.uuid4().hex
        kept = held
        if trim:
            cells = self._stored(held)
            keys = [*self._key_columns(), "rowkey", "cf", "qualifier"]
            same = Window.partitionBy(*keys, "ts").orderBy(F.desc("batch"), F.desc("seq"))
            newest = Window.partitionBy(*keys).orderBy(F.desc("ts"))
            cells = cells.withColumn("_n", F.row_number().over(same)).where("_n = 1").withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= max(1, manifest["retain"])).drop("_n")
            kept = [f"w={new}"]
            cells.sortWithinPartitions("region", "rowkey", "cf", "qualifier").write.partitionBy("region").parquet(f"{self.path}/cells/{kept[0]}")
        df = self._reduced(self._stored(kept), manifest, None, None, ReadOptions(restrictive="FAMILY"), None)
        keyed = df.withColumn("_key", self.rowkey({k.name: F.col(k.name) for k in self.catalog.keys}))
        keyed = keyed.withColumn("_region", self.region_of(F.col("_key"), splits))
        keyed.sortWithinPartitions("_region", "_key").drop("_key").write.partitionBy("_region").parquet(f"{self.path}/snapshots/{new}")
        self._publish(manifest | {"snapshot": new, "holds": kept, "fields": self._typing()})
        for gone in [f"cells/{w}" for w in held if w not in kept] + [f"snapshots/{n}" for n in self._names(f"{self.path}/snapshots") if n != new]:
            fs, p = self._fs(f"{self.path}/{gone}")
            fs.delete(p, True)
        log.info("compacted %d writes of %s", len(held), self.path)

    def retaining(self, versions: int) -> Table:
        """Set how many versions reads may see."""
        self._publish(self.manifest() | {"retain": versions})
        return self


def read_table(spark: SparkSession, root: str, catalog: str, **options: str) -> DataFrame:
    return Table(spark, root, catalog, options).read()


def write_table(df: DataFrame, root: str, catalog: str, overwrite: bool = False, **options: str) -> Table:
    table = Table(df.sparkSession, root, catalog, options)
    table.write(df, overwrite=overwrite)
    return table
