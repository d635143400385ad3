import json

import pytest
from pyspark.sql import functions as F

from cellgrid.functions import avro, codecs
from cellgrid.operators import pushdown
from cellgrid.operators.ranges import Range, intersect, union
from cellgrid.plans.catalogue import QUERIES, catalog
from cellgrid.sources.catalog import CatalogError, parse
from cellgrid.sources.table import ReadOptions, RegionNumberError, Table, split_points

RECORD = catalog("rec", [("col0", "string")], [("col1", "cf1", "boolean"), ("col2", "cf2", "double"), ("col3", "cf3", "float"), ("col4", "cf4", "int"), ("col5", "cf5", "bigint"), ("col6", "cf6", "smallint"), ("col7", "cf7", "string"), ("col8", "cf8", "tinyint")])


def record(spark, n, start=0, t="plain"):
    i = F.col("id")
    return spark.range(start, n).select(F.format_string("row%03d", i).alias("col0"), (i % 2 == 0).alias("col1"), i.cast("double").alias("col2"), i.cast("float").alias("col3"), i.cast("int").alias("col4"), i.alias("col5"), i.cast("smallint").alias("col6"), F.concat(F.lit("Item"), i.cast("string"), F.lit(f": {t}")).alias("col7"), F.expr("cast((id + 128) % 256 - 128 AS tinyint)").alias("col8"))


@pytest.fixture(scope="module")
def rec(spark, tmp_path_factory):
    table = Table(spark, str(tmp_path_factory.mktemp("t")), RECORD, {"newtable": "5"})
    table.write(record(spark, 256))
    return table


def test_round_trip(spark, rec):
    assert sorted(rec.read().collect()) == sorted(record(spark, 256).collect())
    assert rec.count_keys() == 256


@pytest.mark.parametrize(
    "where, n",
    [
        (("<=", "col0", "row005"), 6),
        (("and", (">", "col0", "row100"), ("<=", "col0", "row120"), ("notnull", "col4")), 20),
        (("or", ("=", "col0", "row005"), ("<=", "col0", "row005")), 6),
        (("<", "col0", "row050"), 50),
        (("in", "col0", [f"row{i:03d}" for i in range(5)] + [f"x{i}" for i in range(2000)]), 5),
        (("not", ("in", "col0", [f"row{i:03d}" for i in range(5)])), 251),
        (("in", "col4", [1, 2]), 2),
        (("or", ("=", "col0", "row001"), ("=", "col4", 9)), 2),
        (("or", ("and", ("=", "col0", "row001"), ("=", "col4", 1)), ("and", ("=", "col0", "row002"), ("=", "col4", 1))), 1),
        (("contains", "col7", "item3:"), 0),
        (("and", ("contains", "col7", "Item3"), ("not", ("contains", "col7", "Item3:"))), 10),
        (("endswith", "col7", "7: plain"), 25),
        (("startswith", "col0", "row01"), 10),
        (("<", "col8", 5), 133),
        (("=", "col2", -0.0), 1),
    ],
)
def test_predicates(rec, where, n):
    assert rec.read(where).count() == n
    assert rec.read(where, columns=["col0"]).count() == n


def test_sql_and_pruning(spark, rec):
    rec.view("rec_view")
    assert [tuple(r) for r in spark.sql("SELECT col1, col0 FROM rec_view WHERE col4 = 5").collect()] == [(False, "row005")]
    assert rec.regions(("<=", "col0", "row100")) != rec.regions(None)
    plan = rec.read().where("col0 = 'row005'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k_col0,row005)" in plan


def test_nulls_empty_and_append(spark, tmp_path):
    table = Table(spark, str(tmp_path), RECORD)
    df = record(spark, 5).withColumn("col7", F.when(F.col("col4") > 2, F.col("col7")))
    table.write(df)
    assert table.read().where("col7 IS NULL").count() == 3
    assert table.read(columns=["col7"]).count() == 5
    table.write(record(spark, 8, 5))
    table.write(record(spark, 3, 0, "new"))
    assert table.read().count() == 8
    assert table.read().where("col7 LIKE '%new'").count() == 3
    table.write(record(spark, 2), overwrite=True)
    assert table.read().count() == 2
    with pytest.raises(Exception, match="null"):
        table.write(record(spark, 2).withColumn("col0", F.lit(None).cast("string")))


def test_timestamps_and_versions(spark, tmp_path):
    table = Table(spark, str(tmp_path), RECORD, {"maxVersions": "3"})
    for ts, name, n in ((1000, "first", 3), (2000, "second", 3), (3000, "third", 3), (4000, "fourth", 2)):
        table.write(record(spark, n, 0, name), timestamp=ts)

    def names(**o):
        return sorted(r.col7.split(": ")[1] for r in table.read(options=ReadOptions(**o)).collect())

    assert names(max_versions=2, merge_to_latest=False) == sorted(["fourth"] * 2 + ["third"] * 3 + ["second"])
    assert names(max_versions=4, merge_to_latest=False) == sorted(["first"] + ["fourth"] * 2 + ["third"] * 3 + ["second"] * 3)
    assert names() == ["fourth", "fourth", "third"]
    assert names(timestamp=2000) == ["second"] * 3
    assert names(min_stamp=0, max_stamp=2000) == ["first"] * 3
    with pytest.raises(ValueError):
        table.read(options=ReadOptions(min_stamp=1))


def test_signed_and_composite_keys(spark, tmp_path):
    key = F.expr("cast(if(id % 2 = 0, id, -id) AS int)")
    for coder in ("PrimitiveType", "Ordered"):
        t = Table(spark, str(tmp_path), catalog(f"ints{coder}", [("k", "int")], [("v", "a", "bigint")], coder), {"newtable": "4"})
        t.write(spark.range(32).select(key.alias("k"), F.col("id").alias("v")))
        for where, n in ((("<", "k", 0), 16), (("<=", "k", -10), 11), ((">=", "k", -9), 21), ((">", "k", 10), 10), (("and", (">", "k", -10), ("<=", "k", 10)), 11)):
            assert t.read(where).count() == n
        c = Table(spark, str(tmp_path), catalog(f"two{coder}", [("a", "string"), ("b", "int")], [("v", "f", "int")], coder, a={"length": "6"} if coder == "PrimitiveType" else {}), {"newtable": "5"})
        c.write(spark.range(256).select(F.format_string("row%03d", "id").alias("a"), key.alias("b"), F.col("id").cast("int").alias("v")))
        assert c.read(("and", (">=", "a", "row005"), ("<", "b", 0))).count() == 126
        parts = [(k.spark_type, k.width) for k in c.catalog.keys]
        back = c._stored().select("k_a", "k_b", *(x.alias(n) for x, n in zip(codecs.get(coder).decode_key(F.col("rowkey"), parts), "xy")))
        assert back.where("k_a <> x OR k_b <> y").count() == 0
    with pytest.raises(Exception, match="6 bytes"):
        Table(spark, str(tmp_path), catalog("w", [("a", "string"), ("b", "int")], [("v", "f", "int")], a={"length": "6"})).write(spark.sql("SELECT 'x' AS a, 1 AS b, 2 AS v"))


@pytest.mark.parametrize("coder", ["PrimitiveType", "Ordered"])
def test_codecs(spark, coder):
    codec = codecs.get(coder)
    values = {"double": [0.0, -0.0, 1.5, -2.25, float("inf"), float("-inf"), 5e-324, -1e308, None], "float": [0.5, -3.0, None], "bigint": [-(1 << 63), (1 << 63) - 1, -1, 0, None], "int": [-(1 << 31), 7, None], "smallint": [-32768, 5], "tinyint": [-128, 127], "boolean": [True, False, None], "string": ["", "a\0b", "é", None]}
    for kind, rows in values.items():
        df = spark.createDataFrame([(v,) for v in rows], f"v {kind}")
        got = df.select("v", codec.encode(F.col("v"), df.schema[0].dataType).alias("b")).select("v", "b", codec.decode(F.col("b"), df.schema[0].dataType).alias("w")).collect()
        assert [repr(r.v) for r in got] == [repr(r.w) for r in got]
        if coder == "Ordered":
            some = [r for r in got if r.v is not None]
            assert [r.v for r in sorted(some, key=lambda r: bytes(r.b))] == sorted(r.v for r in some)


def test_dynamic_columns(spark, tmp_path):
    text = catalog("dyn", [("k", "string")], [("a", "f", "int"), ("v", "g", "map<bigint,double>"), ("m", "f", "map<string,int>"), ("n", "h", "map<string,map<bigint,string>>")], m={"col": ""}, n={"col": ""})
    t = Table(spark, str(tmp_path), text, {"maxVersions": "5"})
    t.write(spark.sql("SELECT 'r1' AS k, 1 AS a, map(5L, 0.5D, 6L, 0.6D) AS v, map('x', 1, 'y', 2) AS m, map('q', map(7L, 's', 8L, 't')) AS n"), timestamp=100)
    t.write(spark.sql("SELECT 'r1' AS k, map('y', 3) AS m"), timestamp=200)
    r = t.read(options=ReadOptions(max_versions=5, restrictive="FAMILY")).first()
    assert (r.a, r.v, r.m, r.n) == (1, {5: 0.5, 6: 0.6}, {"x": 1, "y": 3}, {"q": {7: "s", 8: "t"}})
    assert t.read(("=", "k", "r1"), options=ReadOptions(restrictive="NONE")).first().m == {"x": 1, "y": 3}


def test_avro():
    schema = {"type": "record", "name": "r", "fields": [{"name": "name", "type": "string"}, {"name": "n", "type": ["int", "null"]}, {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}}, {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}}, {"name": "m", "type": {"type": "map", "values": ["int", "long"]}}, {"name": "l", "type": {"type": "array", "items": ["null", "double"]}}]}
    put, get = avro.codec(json.dumps(schema))
    row = {"name": "é", "n": None, "e": "B", "f": b"ab", "m": {"x": 1, "y": 1 << 40}, "l": [None, 1.5]}
    assert get(put(row)) == row
    assert avro.codec('"long"')[0](-65) == b"\x81\x01"
    kind, null = avro.to_spark(schema)
    assert not null and kind["m"].dataType.valueType.simpleString() == "bigint"
    assert avro.to_spark(avro.from_spark(kind))[0].simpleString() == kind.simpleString()
    with pytest.raises(avro.SchemaError):
        avro.to_spark(["int", "string"])


def test_catalog_rules():
    c = parse('{"table":{"name":"t"},"rowkey":"k1:k2","columns":{"a":{"cf":"rowkey","col":"k1","type":"string","length":"6"},"b":{"cf":"rowkey","col":"k2","type":"int"},"c8":{"cf":"f","col":"x","type":"tinyint"},"c7":{"cf":"g","col":"y","type":"string"}}}')
    assert c.key_length == 10 and c.schema.names == ["a", "b", "c8", "c7"] and c.families == ["f", "g"]
    base = {"table": {"name": "t", "version": "1"}, "rowkey": "k", "columns": {"k": {"cf": "rowkey", "col": "k", "type": "int"}}}
    assert parse(json.dumps(base)).version == (1, 0)
    for change in ({"table": {"name": "t", "version": "2.0"}}, {"rowkey": "z"}, {"table": {"name": "t", "tableCoder": "Avro"}}, {"table": {"name": "t", "version": "x"}}):
        with pytest.raises(CatalogError):
            parse(json.dumps(base | change))
    assert split_points(b"aaaaaa", b"zzzzzz", 5)[0] == b"aaaaaa" and len(split_points(b"aaaaaa", b"zzzzzz", 5)) == 4


def test_ranges_by_brute_force():
    import itertools
    import random

    rng = random.Random(3)

    def some():
        return [Range.of(rng.choice([None, rng.randint(0, 9)]), rng.random() < 0.5, rng.choice([None, rng.randint(0, 9)]), rng.random() < 0.5) for _ in range(rng.randint(0, 3))]

    points = [x / 2 for x in range(-2, 22)]
    for _ in range(400):
        a, b = some(), some()
        for f, test in ((intersect, all), (union, any)):
            got = f(a, b)
            assert all(x.end is not None and y.start is not None for x, y in itertools.pairwise(got))
            for p in points:
                assert any(r.contains(p) for r in got) == test(any(r.contains(p) for r in s) for s in (a, b))
    # Open ends that meet stay apart.
    assert len(union([Range.of(1, True, 5, False)], [Range.of(5, False, 9, True)])) == 2


def test_region_number_and_superset(spark, tmp_path):
    with pytest.raises(RegionNumberError):
        Table(spark, str(tmp_path), RECORD, {"newtable": "3"}).create()
    c = parse(catalog("x", [("k", "int")], [("v", "a", "int")]))
    for where in (("<", "k", -3), (">=", "k", 4), ("!=", "k", 1), ("not", ("and", (">", "k", 2), ("<", "k", 5)))):
        ranges = pushdown.key_ranges(where, c)
        for k in range(-9, 9):
            holds = {"<": k < -3, ">=": k >= 4, "!=": k != 1, "not": not (2 < k < 5)}[where[0]]
            assert not holds or any(r.contains(k.to_bytes(4, "big", signed=True)) for r in ranges)


def test_stream_and_facade(spark, tmp_path):
    from cellgrid.sources.datasource import register
    from cellgrid.streaming.sink import upsert_stream

    text = catalog("s", [("k", "bigint")], [("v", "a", "bigint")])
    table = Table(spark, str(tmp_path / "t"), text)
    spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k bigint, v bigint").parquet(str(tmp_path / "in"))
    upsert_stream(stream, table, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    assert table.read().agg(F.sum("v")).first()[0] == 380
    upsert_stream(stream, table, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    register(spark)

    def facade():
        return spark.read.format("cellgrid").option("root", str(tmp_path / "t")).option("catalog", text).load()

    assert sorted(facade().collect()) == sorted(table.read().collect())
    table.compact()
    table.write(spark.sql("SELECT 3L AS k, 7L AS v UNION ALL SELECT 99L, NULL"))
    rows = sorted(table.read().collect())
    assert len(rows) == 21 and (99, None) in rows and (3, 7) in rows
    assert sorted(facade().collect()) == rows
    assert sorted(facade().where("k >= 3 AND k < 6").collect()) == rows[3:6]
    assert sorted(table.lookup(spark.sql("SELECT 3L AS k UNION ALL SELECT 4L")).collect()) == rows[3:5]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    table = Table(spark, str(tmp_path), catalog("r", [("k", "bigint")], [("v", "a", "bigint")]), {"maxVersions": "5"})
    for _ in range(2):
        table.write(spark.sql("SELECT 1L AS k, 2L AS v"), write_id="q-0")
    assert table.read(options=ReadOptions(max_versions=5, merge_to_latest=False)).count() == 1
    table.write(spark.sql("SELECT 1L AS k, 3L AS v"), timestamp=5, write_id="q-1")
    table.write(spark.sql("SELECT 1L AS k, 4L AS v"), timestamp=5)
    assert table.read(options=ReadOptions(timestamp=5)).collect() == [(1, 4)]
    before = sorted(table.read(options=ReadOptions(max_versions=5, merge_to_latest=False)).collect())
    table.compact(trim=True)
    assert sorted(table.read(options=ReadOptions(max_versions=5, merge_to_latest=False)).collect()) == before


def test_format_writes(spark, tmp_path):
    from cellgrid.sources.datasource import register

    register(spark)
    options = {"root": str(tmp_path), "catalog": RECORD, "newtable": "5"}
    record(spark, 256).write.format("cellgrid").options(**options).mode("append").save()
    table = Table(spark, str(tmp_path), RECORD)
    assert sorted(table.read().collect()) == sorted(record(spark, 256).collect())
    record(spark, 3, 0, "new").write.format("cellgrid").options(**options).mode("append").save()
    assert table.read().where("col7 LIKE '%new'").count() == 3 and table.read().count() == 256
    record(spark, 2).write.format("cellgrid").options(**options).mode("overwrite").save()
    assert table.read().count() == 2
    with pytest.raises(Exception, match="null"):
        record(spark, 2).withColumn("col0", F.lit(None).cast("string")).write.format("cellgrid").options(**options).mode("append").save()
    assert table.read().count() == 2
    table.insert(record(spark, 5))
    assert table.read().count() == 5


def test_typed_split_points_prune(spark, tmp_path):
    table = Table(spark, str(tmp_path), catalog("p", [("k", "bigint")], [("v", "a", "bigint")]))
    df = spark.range(-500, 500).select(F.col("id").alias("k"), F.col("id").alias("v"))
    table.create(splits=[100, 200, -100])
    table.write(df)
    assert table._stored().select("region").distinct().count() == 4
    assert table.regions(("and", (">=", "k", 120), ("<", "k", 150))) == [1]
    assert table.read(("and", (">=", "k", 120), ("<", "k", 150))).count() == 30
    assert len(table.points_of(df, 8)) == 7


def test_queries_run(spark):
    assert QUERIES["key_range_filter"](spark, "/root/testdata/sf0.001").count() > 0
