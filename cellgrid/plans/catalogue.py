"""Queries over catalogued tables, each with its equivalent in SQL on the source tables.

Every query writes its source table whole through a catalog into a fresh
root, and reads it back through the engine.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellgrid.functions import avro
from cellgrid.functions.codecs import Primitive
from cellgrid.operators.ranges import Range, intersect, union
from cellgrid.sources import datasource
from cellgrid.sources.table import ReadOptions, RegionNumberError, Table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A fresh root in the shared folder; a folder of our own only where none is configured."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="cellgrid-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def catalog(name: str, keys: list[tuple[str, str]], columns: list[tuple[str, str, str]], coder: str = "PrimitiveType", **extra: dict) -> str:
    cols = {k: {"cf": "rowkey", "col": k, "type": t} for k, t in keys} | {c: {"cf": cf, "col": c, "type": t} for c, cf, t in columns}
    for c, more in extra.items():
        cols[c] |= more
    return json.dumps({"table": {"name": name, "tableCoder": coder, "version": "2.0"}, "rowkey": ":".join(k for k, _ in keys), "columns": cols})


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ORDERS = catalog("orders", [("o_orderkey", "bigint")], [("o_custkey", "a", "bigint"), ("o_orderstatus", "a", "string"), ("o_totalprice", "b", "double")])
CUSTOMER = catalog("customer", [("k", "int")], [("c_name", "a", "string"), ("c_acctbal", "b", "double"), ("c_mktsegment", "a", "string")])
PART = catalog("part", [("p_partkey", "bigint")], [("p_name", "a", "string"), ("p_size", "b", "int")])


def stored(spark: SparkSession, df: DataFrame, text: str, **options: str) -> Table:
    table = Table(spark, scratch(spark), text, {"newtable": "6"} | options)
    table.write(df.select(*(f.name for f in table.catalog.fields if f.name in df.columns)))
    return table


def millis(column: str):
    """Milliseconds since 1970 of a timestamp without time zone, read as UTC whatever the session's zone is."""
    return F.unix_millis(F.concat(F.col(column).cast("string"), F.lit("Z")).cast("timestamp"))


def query(sql: str | None) -> Callable:
    def note(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return note


def orders(spark: SparkSession, sf_dir: str) -> Table:
    return stored(spark, source(spark, sf_dir, "orders"), ORDERS)


def customers(spark: SparkSession, sf_dir: str) -> Table:
    return stored(spark, source(spark, sf_dir, "customer").withColumn("k", (F.col("c_custkey") - 750).cast("int")), CUSTOMER)


def parts(spark: SparkSession, sf_dir: str) -> Table:
    return stored(spark, source(spark, sf_dir, "part"), PART)


_O = "o_orderkey, o_custkey, o_orderstatus, o_totalprice"
_C = "CAST(c_custkey - 750 AS INTEGER) AS k, c_name, c_acctbal, c_mktsegment"


@query(f"SELECT {_O} FROM orders WHERE o_orderkey BETWEEN 100 AND 900 AND o_orderstatus = 'F'")
def key_range_filter(spark, sf_dir):
    return orders(spark, sf_dir).read(("and", (">=", "o_orderkey", 100), ("<=", "o_orderkey", 900), ("=", "o_orderstatus", "F")))


@query(f"SELECT {_O} FROM orders")
def full_scan(spark, sf_dir):
    return orders(spark, sf_dir).read()


@query(f"SELECT {_O} FROM orders WHERE o_orderkey = 77")
def key_point(spark, sf_dir):
    return orders(spark, sf_dir).read(("=", "o_orderkey", 77))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey IN (1, 2, 3, 500, 1000000)")
def key_in(spark, sf_dir):
    return orders(spark, sf_dir).read(("in", "o_orderkey", [1, 2, 3, 500, 1000000]))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey IN (1, 2, 3, 4) AND o_orderkey NOT IN (2, 3)")
def key_in_not_in(spark, sf_dir):
    return orders(spark, sf_dir).read(("and", ("in", "o_orderkey", [1, 2, 3, 4]), ("not", ("in", "o_orderkey", [2, 3]))))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey % 3 = 0)")
def key_bulk_get(spark, sf_dir):
    return orders(spark, sf_dir).lookup(source(spark, sf_dir, "orders").where("o_custkey % 3 = 0"))


@query(f"SELECT {_C} FROM customer WHERE c_custkey - 750 BETWEEN -10 AND 10")
def key_range_signed(spark, sf_dir):
    return customers(spark, sf_dir).read(("and", (">=", "k", -10), ("<=", "k", 10)))


@query(f"SELECT {_C} FROM customer WHERE c_custkey - 750 < -700 OR c_custkey - 750 > 700")
def key_range_or(spark, sf_dir):
    return customers(spark, sf_dir).read(("or", ("<", "k", -700), (">", "k", 700)))


@query("SELECT c_name, c_custkey FROM customer WHERE c_name LIKE 'Customer#0000001%'")
def key_prefix(spark, sf_dir):
    text = catalog("named", [("c_name", "string")], [("c_custkey", "a", "bigint")])
    return stored(spark, source(spark, sf_dir, "customer"), text).read(("startswith", "c_name", "Customer#0000001"))


@query(f"SELECT {_O} FROM orders WHERE o_orderstatus = 'O'")
def column_equal(spark, sf_dir):
    return orders(spark, sf_dir).read(("=", "o_orderstatus", "O"))


@query(f"SELECT {_O} FROM orders WHERE o_orderstatus IN ('F', 'P')")
def column_in(spark, sf_dir):
    return orders(spark, sf_dir).read(("in", "o_orderstatus", ["F", "P"]))


@query(f"SELECT {_O} FROM orders WHERE NOT (o_totalprice < 100000 OR o_totalprice >= 200000)")
def column_range_negated(spark, sf_dir):
    return orders(spark, sf_dir).read(("not", ("or", ("<", "o_totalprice", 100000.0), (">=", "o_totalprice", 200000.0))))


@query(f"SELECT {_O} FROM orders WHERE o_orderstatus <> 'F'")
def column_not_equal(spark, sf_dir):
    return orders(spark, sf_dir).read(("!=", "o_orderstatus", "F"))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey = 5 OR o_orderstatus = 'P'")
def or_of_key_and_column(spark, sf_dir):
    return orders(spark, sf_dir).read(("or", ("=", "o_orderkey", 5), ("=", "o_orderstatus", "P")))


@query(f"SELECT {_O} FROM orders WHERE (o_orderkey < 100 AND o_orderstatus = 'F') OR (o_orderkey > 1000 AND o_orderstatus = 'O')")
def or_of_ands(spark, sf_dir):
    return orders(spark, sf_dir).read(("or", ("and", ("<", "o_orderkey", 100), ("=", "o_orderstatus", "F")), ("and", (">", "o_orderkey", 1000), ("=", "o_orderstatus", "O"))))


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'a') AND NOT contains(p_name, 'e') OR p_name LIKE '%1'")
def string_tests(spark, sf_dir):
    where = ("or", ("and", ("contains", "p_name", "a"), ("not", ("contains", "p_name", "e"))), ("endswith", "p_name", "1"))
    return parts(spark, sf_dir).read(where, columns=["p_partkey", "p_name"])


@query("SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS lang, CASE WHEN n_chars > 1000 THEN n_chars END AS n_chars FROM documents")
def null_cells(spark, sf_dir):
    text = catalog("docs", [("doc_id", "bigint")], [("lang", "a", "string"), ("n_chars", "b", "bigint")])
    df = source(spark, sf_dir, "documents").select("doc_id", F.expr("CASE WHEN lang <> 'en' THEN lang END").alias("lang"), F.expr("CASE WHEN n_chars > 1000 THEN n_chars END").alias("n_chars"))
    return stored(spark, df, text).read()


@query("SELECT l_orderkey, l_linenumber, MAX(l_quantity) AS q, COUNT(*) AS n FROM lineitem WHERE l_orderkey >= 50 GROUP BY 1, 2")
def composite_key(spark, sf_dir):
    text = catalog("lines", [("l_orderkey", "bigint"), ("l_linenumber", "int")], [("q", "a", "double"), ("n", "a", "bigint")])
    df = source(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"), F.count("*").alias("n"))
    return stored(spark, df, text).read((">=", "l_orderkey", 50))


@query("SELECT r_name, n_name, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name >= 'ASIA'")
def ordered_composite_key(spark, sf_dir):
    text = catalog("places", [("r_name", "string"), ("n_name", "string")], [("n_nationkey", "a", "int")], coder="Ordered")
    df = source(spark, sf_dir, "nation").join(source(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return stored(spark, df, text).read((">=", "r_name", "ASIA"))


EVENTS = catalog("events", [("user_id", "bigint")], [("v", "e", "map<string,map<bigint,double>>")], v={"col": ""})


def events(spark: SparkSession, sf_dir: str, retain: int = 1 << 30) -> Table:
    """Users as rows, event types as qualifiers, milliseconds as versions; of events of one cell the largest id counts."""
    df = source(spark, sf_dir, "events").select("user_id", "event_type", millis("ts").alias("ms"), "value", "event_id")
    df = df.groupBy("user_id", "event_type", "ms").agg(F.max_by("value", "event_id").alias("value"))
    rows = df.groupBy("user_id", "event_type").agg(F.map_from_entries(F.collect_list(F.struct("ms", "value"))).alias("m")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "m"))).alias("v"))
    return stored(spark, rows, EVENTS, maxVersions=str(retain))


_EV = "SELECT user_id, event_type, epoch_us(ts) // 1000 AS ms, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2, 3"
_FLAT = "user_id, explode(v) AS (event_type, m)"


def flat(df: DataFrame) -> DataFrame:
    return df.select("user_id", F.explode("v").alias("event_type", "m")).select("user_id", "event_type", F.explode("m").alias("ms", "value"))


@query(f"SELECT * FROM ({_EV}) t")
def dynamic_columns_with_versions(spark, sf_dir):
    return flat(events(spark, sf_dir).read(options=ReadOptions(max_versions=1 << 30, restrictive="FAMILY")))


@query(f"SELECT user_id, event_type, ms, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ms DESC) AS n FROM ({_EV}) t) u WHERE n <= 2")
def newest_versions(spark, sf_dir):
    return flat(events(spark, sf_dir).read(options=ReadOptions(max_versions=2, restrictive="FAMILY")))


@query(f"SELECT user_id, event_type, max(ms) AS ms, arg_max(value, ms) AS value FROM ({_EV}) t WHERE ms >= (SELECT min(epoch_us(ts) // 1000) FROM events) + 86400000 AND ms < (SELECT max(epoch_us(ts) // 1000) FROM events) GROUP BY 1, 2")
def time_range(spark, sf_dir):
    low, high = source(spark, sf_dir, "events").agg(F.min(millis("ts")), F.max(millis("ts"))).first()
    return flat(events(spark, sf_dir).read(options=ReadOptions(min_stamp=low + 86400000, max_stamp=high, restrictive="FAMILY")))


@query(f"SELECT user_id, event_type, arg_max(value, ms) AS value FROM ({_EV}) t GROUP BY 1, 2")
def dynamic_columns_latest(spark, sf_dir):
    table = events(spark, sf_dir)
    text = EVENTS.replace("map<string,map<bigint,double>>", "map<string,double>")
    df = Table(spark, table.path.rsplit("/", 2)[0], text).read(options=ReadOptions(restrictive="FAMILY"))
    return df.select("user_id", F.explode("v").alias("event_type", "value"))


VERSIONS = catalog("prices", [("s_suppkey", "bigint")], [("s_name", "a", "string"), ("s_acctbal", "b", "double")])


def suppliers(spark: SparkSession, sf_dir: str) -> Table:
    df = source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    table = Table(spark, scratch(spark), VERSIONS, {"maxVersions": "3"})
    table.write(df, timestamp=1000)
    table.write(df.where("s_suppkey % 2 = 0").select("s_suppkey", (F.col("s_acctbal") * 2).alias("s_acctbal")), timestamp=2000)
    return table


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal FROM supplier")
def upsert_newest_wins(spark, sf_dir):
    return suppliers(spark, sf_dir).read()


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, NULL, s_acctbal * 2 FROM supplier WHERE s_suppkey % 2 = 0")
def version_rows(spark, sf_dir):
    return suppliers(spark, sf_dir).read(options=ReadOptions(max_versions=3, merge_to_latest=False))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def as_of_timestamp(spark, sf_dir):
    return suppliers(spark, sf_dir).read(options=ReadOptions(timestamp=1000))


@query("SELECT doc_id, lang, source, n_chars FROM documents WHERE lang <> 'en'")
def avro_struct(spark, sf_dir):
    schema = json.dumps({"type": "record", "name": "doc", "fields": [{"name": "lang", "type": ["string", "null"]}, {"name": "source", "type": ["string", "null"]}, {"name": "n_chars", "type": ["null", "long"]}]})
    text = catalog("avro_docs", [("doc_id", "bigint")], [("r", "a", "binary")], r={"avro": "doc_schema"})
    df = source(spark, sf_dir, "documents").select("doc_id", F.struct("lang", "source", "n_chars").alias("r"))
    return stored(spark, df, text, doc_schema=schema).read().where("r.lang <> 'en'").select("doc_id", "r.lang", "r.source", "r.n_chars")


@query("SELECT vec_id, embedding[1] AS first, len(embedding) AS n FROM embeddings")
def avro_array(spark, sf_dir):
    text = catalog("avro_vectors", [("vec_id", "bigint")], [("v", "a", "binary")], v={"avro": "vector"})
    df = source(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("v"))
    schema = json.dumps({"type": "array", "items": ["float", "null"]})
    return stored(spark, df, text, vector=schema).read().select("vec_id", F.get("v", F.lit(0)).alias("first"), F.size("v").cast("long").alias("n"))


@query("SELECT o_orderstatus, COUNT(*) AS n, COUNT(o_custkey) AS custs FROM orders WHERE o_orderkey < 5000 GROUP BY 1")
def sql_view_aggregate(spark, sf_dir):
    name = f"v_{uuid.uuid4().hex}"
    orders(spark, sf_dir).view(name)
    return spark.sql(f"SELECT o_orderstatus, count(1) AS n, count(o_custkey) AS custs FROM {name} WHERE o_orderkey < 5000 GROUP BY 1")


@query("SELECT DISTINCT o_orderstatus FROM orders")
def distinct_values(spark, sf_dir):
    return orders(spark, sf_dir).read(columns=["o_orderstatus"]).distinct()


@query(f"SELECT {_O} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_limit(spark, sf_dir):
    return orders(spark, sf_dir).read().orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def join_two_roots(spark, sf_dir):
    right = customers(spark, sf_dir).read(("=", "c_mktsegment", "BUILDING")).select((F.col("k") + 750).cast("long").alias("o_custkey"), "c_name")
    return orders(spark, sf_dir).read().join(right, "o_custkey").select("o_orderkey", "o_totalprice", "c_name")


@query("SELECT l_returnflag, SUM(l_quantity) AS qty, COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1")
def join_with_parquet(spark, sf_dir):
    left = orders(spark, sf_dir).read(("=", "o_orderstatus", "F"), columns=["o_orderkey"])
    return source(spark, sf_dir, "lineitem").join(left, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_returnflag").agg(F.sum("l_quantity").alias("qty"), F.count("*").alias("n"))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey BETWEEN 200 AND 400")
def compacted_snapshot(spark, sf_dir):
    table = orders(spark, sf_dir)
    table.compact()
    return table.read(("and", (">=", "o_orderkey", 200), ("<=", "o_orderkey", 400)))


# Counts, formats, SQL.


@query("SELECT COUNT(*) AS n, COUNT(DISTINCT o_orderkey) AS keys FROM orders")
def key_only_count(spark, sf_dir):
    table = orders(spark, sf_dir)
    return table.read(columns=["o_orderkey"]).agg(F.count("*").alias("n"), F.lit(table.count_keys()).cast("long").alias("keys"))


@query("SELECT (SELECT COUNT(*) FROM orders) AS n, COUNT(*) AS few FROM orders WHERE o_orderkey <= 64")
def count_action(spark, sf_dir):
    table = orders(spark, sf_dir)
    return spark.createDataFrame([(table.read().count(), table.read(("<=", "o_orderkey", 64)).count())], "n long, few long")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_suppkey BETWEEN 10 AND 50")
def format_write_read(spark, sf_dir):
    datasource.register(spark)
    options = {"root": scratch(spark), "catalog": VERSIONS, "newtable": "4"}
    source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.format("cellgrid").options(**options).mode("append").save()
    return spark.read.format("cellgrid").options(**options).load().where("s_suppkey >= 10 AND s_suppkey <= 50")


@query("SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_suppkey IN (1, 2, 3, 4, 77)")
def format_reads_newest(spark, sf_dir):
    datasource.register(spark)
    table = Table(spark, scratch(spark), VERSIONS)
    df = source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    table.write(df)
    table.compact()
    table.write(df.where("s_suppkey % 2 = 0").select("s_suppkey", (F.col("s_acctbal") * 2).alias("s_acctbal")))
    return spark.read.format("cellgrid").options(root=table.path.rsplit("/", 2)[0], catalog=VERSIONS).load().where("s_suppkey IN (1, 2, 3, 4, 77)")


@query("SELECT n_nationkey AS k, n_name AS v FROM nation UNION ALL SELECT 100 + r_regionkey, r_name FROM region")
def insert_into(spark, sf_dir):
    name, root, text = f"t_{uuid.uuid4().hex}", scratch(spark), catalog("names", [("k", "int")], [("v", "a", "string")])
    table = Table(spark, root, text)
    table.insert(source(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    datasource.attach(spark, name, root, text)
    source(spark, sf_dir, "region").createOrReplaceTempView(f"r_{name}")
    spark.sql(f"INSERT INTO {name} SELECT 100 + r_regionkey, r_name FROM r_{name}")
    return spark.table(name)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal > 0")
def saved_beside_and_dropped(spark, sf_dir):
    """A plain table is saved beside the catalogued one, read by SQL into a second one and dropped."""
    root, name = scratch(spark), f"saved_{uuid.uuid4().hex}"
    first = Table(spark, root, VERSIONS)
    first.write(source(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"))
    first.read().write.option("path", f"{root}/{name}").saveAsTable(name)
    second = Table(spark, root, VERSIONS.replace("prices", "positive"))
    second.write(spark.sql(f"SELECT * FROM {name} WHERE s_acctbal > 0"))
    spark.sql(f"DROP TABLE {name}")
    return second.read()


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def table_to_table(spark, sf_dir):
    text = catalog("cust", [("c_custkey", "bigint")], [("c_name", "a", "string"), ("c_acctbal", "a", "double"), ("c_mktsegment", "a", "string")])
    first = stored(spark, source(spark, sf_dir, "customer"), text)
    copy = catalog("copy", [("c_custkey", "bigint")], [("c_name", "a", "string"), ("c_acctbal", "b", "double")], coder="Ordered")
    return stored(spark, first.read(("=", "c_mktsegment", "BUILDING")), copy).read()


@query("SELECT CAST(range AS INTEGER) AS k, 'v' || range AS v FROM range(0, 300)")
def from_local_rows(spark, sf_dir):
    text = catalog("local", [("k", "int")], [("v", "a", "string")])
    return stored(spark, spark.createDataFrame([(k, f"v{k}") for k in range(300)], "k int, v string"), text).read()


@query("SELECT o_orderstatus, o_totalprice, o_orderkey FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey LIMIT 100")
def sort_by_three(spark, sf_dir):
    return orders(spark, sf_dir).read(columns=["o_orderkey", "o_orderstatus", "o_totalprice"]).orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey").limit(100)


@query("SELECT true AS key_pushed, true AS region_pushed")
def explain_shows_pushdown(spark, sf_dir):
    table = ranged(spark, sf_dir)
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = table.read(("and", (">=", "o_orderkey", 100), ("<=", "o_orderkey", 200)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    keys, regions = (re.search(rf"{name}: \[([^\]]*)\]", plan).group(1) for name in ("PushedFilters", "PartitionFilters"))
    return spark.createDataFrame([("GreaterThanOrEqual(k_o_orderkey,100)" in keys, "region" in regions)], "key_pushed boolean, region_pushed boolean")


# Regions.


def ranged(spark: SparkSession, sf_dir: str, regions: int = 8) -> Table:
    """Orders in regions of even sizes."""
    df = source(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    table = Table(spark, scratch(spark), ORDERS)
    table.create(splits=table.points_of(df, regions))
    table.write(df)
    return table


@query(f"SELECT {_O}, true AS pruned FROM orders WHERE o_orderkey BETWEEN 300 AND 500")
def region_pruned_range(spark, sf_dir):
    """Regions that hold rows, but none that are asked for, are not read."""
    table = ranged(spark, sf_dir)
    where = ("and", (">=", "o_orderkey", 300), ("<=", "o_orderkey", 500))
    filled = {r[0] for r in table._stored().select("region").distinct().collect()}
    return table.read(where).withColumn("pruned", F.lit(len(filled - set(table.regions(where))) > 0))


@query("SELECT c_name, c_custkey, true AS pruned FROM customer WHERE c_name >= 'Customer#000000100' AND c_name < 'Customer#000000200'")
def region_pruned_text(spark, sf_dir):
    text = catalog("byname", [("c_name", "string")], [("c_custkey", "a", "bigint")])
    table = Table(spark, scratch(spark), text, {"newtable": "6", "minTableSplitPoint": "Customer#000000050", "maxTableSplitPoint": "Customer#000000950"})
    table.write(source(spark, sf_dir, "customer").select("c_name", "c_custkey"))
    where = ("and", (">=", "c_name", "Customer#000000100"), ("<", "c_name", "Customer#000000200"))
    return table.read(where).withColumn("pruned", F.lit(len(table.regions(where)) < 6))


@query("SELECT k AS regions, k > 3 AS made FROM (VALUES (1), (2), (3), (4), (5), (6)) t(k)")
def region_numbers(spark, sf_dir):
    rows = []
    for n in range(1, 7):
        try:
            Table(spark, scratch(spark), ORDERS, {"newtable": str(n)}).create()
            rows.append((n, True))
        except RegionNumberError:
            rows.append((n, False))
    return spark.createDataFrame(rows, "regions int, made boolean")


_SPANS = [(1, True, 5, False, 3, True, 9, True), (1, True, 5, False, 5, False, 9, True), (1, True, 5, True, 5, True, 9, False), (None, False, 4, True, 2, False, None, False), (2, False, 3, False, 2, True, 2, True), (None, False, None, False, 7, True, 7, True), (8, True, 3, True, 1, True, 2, True)]


def _holds(p: str, a: int | None, a_in: bool, b: int | None, b_in: bool) -> str:
    low = "true" if a is None else f"{p} >{'=' if a_in else ''} {a}"
    high = "true" if b is None else f"{p} <{'=' if b_in else ''} {b}"
    return f"({low} AND {high})"


@query(" UNION ALL ".join(f"SELECT {i} AS pair, range / 2 AS point, {_holds('range / 2', *x[:4])} AND {_holds('range / 2', *x[4:])} AS common, {_holds('range / 2', *x[:4])} OR {_holds('range / 2', *x[4:])} AS either FROM range(-2, 24)" for i, x in enumerate(_SPANS)))
def range_algebra(spark, sf_dir):
    """Intersection and union of intervals with inclusive, exclusive and missing ends, told by the points they hold."""
    rows = []
    for i, x in enumerate(_SPANS):
        a, b = [Range.of(*x[:4])], [Range.of(*x[4:])]
        both, either = intersect(a, b), union(a, b)
        rows += [(i, p / 2, any(r.contains(p / 2) for r in both), any(r.contains(p / 2) for r in either)) for p in range(-2, 24)]
    return spark.createDataFrame(rows, "pair int, point double, common boolean, either boolean")


# Predicates.


@query("SELECT doc_id, lang, n_chars FROM (SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS lang, n_chars FROM documents) t WHERE lang IS NULL AND n_chars IS NOT NULL")
def column_is_null(spark, sf_dir):
    return _docs(spark, sf_dir).read(("and", ("isnull", "lang"), ("notnull", "n_chars")))


def _docs(spark: SparkSession, sf_dir: str) -> Table:
    text = catalog("docs", [("doc_id", "bigint")], [("lang", "a", "string"), ("n_chars", "b", "bigint")])
    return stored(spark, source(spark, sf_dir, "documents").select("doc_id", F.expr("CASE WHEN lang <> 'en' THEN lang END").alias("lang"), "n_chars"), text)


@query("SELECT doc_id, lang, n_chars FROM (SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS lang, n_chars FROM documents) t WHERE lang IS NOT DISTINCT FROM 'de' OR lang IS NOT DISTINCT FROM NULL AND doc_id IS NOT DISTINCT FROM 7")
def null_safe_equal(spark, sf_dir):
    return _docs(spark, sf_dir).read(("or", ("<=>", "lang", "de"), ("and", ("<=>", "lang", None), ("<=>", "doc_id", 7))))


@query("SELECT doc_id, lang, n_chars FROM (SELECT doc_id, CASE WHEN lang <> 'en' THEN lang END AS lang, n_chars FROM documents) t WHERE n_chars % 7 = 3 AND length(lang) = 2 AND doc_id < 500")
def sql_predicate(spark, sf_dir):
    return _docs(spark, sf_dir).read(("and", ("sql", "n_chars % 7 = 3 AND length(lang) = 2"), ("<", "doc_id", 500)))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey < 100.5 AND o_totalprice > 1000 OR o_orderkey = 2000.0")
def literals_of_other_types(spark, sf_dir):
    return orders(spark, sf_dir).read(("or", ("and", ("<", "o_orderkey", 100.5), (">", "o_totalprice", 1000)), ("=", "o_orderkey", 2000.0)))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey IN (SELECT range * 3 FROM range(0, 2002))")
def large_in(spark, sf_dir):
    return orders(spark, sf_dir).read(("in", "o_orderkey", [3 * k for k in range(2002)]))


@query(f"SELECT {_O} FROM orders WHERE o_orderkey NOT IN (SELECT range * 3 FROM range(0, 2002))")
def large_not_in(spark, sf_dir):
    return orders(spark, sf_dir).read(("not", ("in", "o_orderkey", [3 * k for k in range(2002)])))


# Codecs.


class Text(Primitive):
    """A codec of one's own, named by its import path: every value as text."""

    def encode(self, value, kind, avro=None):
        return F.encode(value.cast("string"), "UTF-8")

    def decode(self, cell, kind, avro=None):
        return F.decode(cell, "UTF-8").cast(kind)

    def literal(self, value, kind):
        return None


@query("SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey > 100")
def codec_by_path(spark, sf_dir):
    text = catalog("texts", [("p_partkey", "bigint")], [("p_name", "a", "string"), ("p_size", "b", "int")], coder=f"{__name__}.Text")
    return stored(spark, source(spark, sf_dir, "part"), text).read((">", "p_partkey", 100))


@query(f"SELECT {_C}, true AS ordered FROM customer WHERE c_custkey - 750 BETWEEN -40 AND 25")
def ordered_numbers(spark, sf_dir):
    """Stored bytes of the ordered codec sort as the signed numbers do."""
    table = stored(spark, source(spark, sf_dir, "customer").withColumn("k", (F.col("c_custkey") - 750).cast("int")), CUSTOMER.replace("PrimitiveType", "Ordered"))
    keys = [r.k_k for r in table._stored().select("rowkey", "k_k").distinct().orderBy("rowkey").collect()]
    return table.read(("and", (">=", "k", -40), ("<=", "k", 25))).withColumn("ordered", F.lit(keys == sorted(keys)))


@query("SELECT p_partkey, encode(p_name) AS raw FROM part")
def binary_column(spark, sf_dir):
    text = catalog("raws", [("p_partkey", "bigint")], [("raw", "a", "binary")])
    return stored(spark, source(spark, sf_dir, "part").select("p_partkey", F.encode("p_name", "UTF-8").alias("raw")), text).read()


_AVRO = {"type": "record", "name": "item", "fields": [{"name": "brand", "type": {"type": "enum", "name": "Brand", "symbols": ["odd", "even"]}}, {"name": "code", "type": {"type": "fixed", "name": "Four", "size": 4}}, {"name": "sizes", "type": {"type": "map", "values": ["int", "null"]}}, {"name": "number", "type": ["null", "int", "long"]}, {"name": "names", "type": {"type": "array", "items": "string"}}]}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = catalog("items", [("p_partkey", "bigint")], [("r", "a", "binary")], r={"avro": "item"})
    r = F.struct(
        F.expr("if(p_partkey % 2 = 0, 'even', 'odd')").alias("brand"),
        F.encode(F.lpad(F.col("p_size").cast("string"), 4, "0"), "UTF-8").alias("code"),
        F.create_map(F.lit("size"), F.col("p_size"), F.lit("none"), F.lit(None).cast("int")).alias("sizes"),
        F.expr("if(p_partkey % 3 = 0, NULL, p_partkey * 10000000000)").alias("number"),
        F.array("p_name", "p_brand").alias("names"),
    )
    return stored(spark, source(spark, sf_dir, "part").select("p_partkey", r.alias("r")), text, item=json.dumps(_AVRO)).read()


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'even' ELSE 'odd' END AS brand, lpad(CAST(p_size AS VARCHAR), 4, '0') AS code, CASE WHEN p_partkey % 3 <> 0 THEN p_partkey * 10000000000 END AS number FROM part")
def avro_enum_fixed_union(spark, sf_dir):
    return _items(spark, sf_dir).select("p_partkey", "r.brand", F.decode("r.code", "UTF-8").alias("code"), "r.number")


@query("SELECT p_partkey, p_size AS size, CAST(NULL AS INTEGER) AS none FROM part WHERE p_size > 10")
def map_item(spark, sf_dir):
    df = _items(spark, sf_dir)
    return df.where(F.col("r.sizes").getItem("size") > 10).select("p_partkey", F.col("r.sizes").getItem("size").alias("size"), F.col("r.sizes").getItem("none").alias("none"))


@query("SELECT p_partkey, p_brand AS second FROM part WHERE contains(p_name, 'a') AND p_partkey % 2 = 0")
def nested_contains(spark, sf_dir):
    df = _items(spark, sf_dir)
    return df.where(F.col("r.names")[0].contains("a") & F.col("r.brand").contains("eve")).select("p_partkey", F.col("r.names")[1].alias("second"))


@query("SELECT p_partkey FROM part WHERE p_partkey % 2 = 0 AND p_partkey % 3 <> 0")
def nested_predicate(spark, sf_dir):
    text = catalog("nested", [("p_partkey", "bigint")], [("r", "a", "binary")], r={"avro": "pair"})
    schema = {"type": "record", "name": "pair", "fields": [{"name": "brand", "type": "string"}, {"name": "number", "type": ["null", "long"]}]}
    df = source(spark, sf_dir, "part").select("p_partkey", F.struct(F.expr("if(p_partkey % 2 = 0, 'even', 'odd')").alias("brand"), F.expr("if(p_partkey % 3 = 0, NULL, p_partkey)").alias("number")).alias("r"))
    return stored(spark, df, text, pair=json.dumps(schema)).read(("and", ("=", "r.brand", "even"), ("notnull", "r.number")), columns=["p_partkey"])


@query("SELECT n_name AS name, n_nationkey AS number, n_regionkey AS v FROM nation WHERE n_regionkey > 1")
def avro_row_key(spark, sf_dir):
    schema = {"type": "record", "name": "place", "fields": [{"name": "name", "type": "string"}, {"name": "number", "type": ["int", "null"]}]}
    text = catalog("avro_keys", [("k", "binary")], [("v", "a", "int")], k={"avro": "place"})
    df = source(spark, sf_dir, "nation").select(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("number")).alias("k"), F.col("n_regionkey").alias("v"))
    return stored(spark, df, text, place=json.dumps(schema)).read((">", "v", 1)).select("k.name", "k.number", "v")


_TYPES = [
    ('"int"', "int", False), ('"long"', "bigint", False), ('"float"', "float", False), ('"double"', "double", False), ('"boolean"', "boolean", False), ('"string"', "string", False), ('"bytes"', "binary", False),
    ('["null","string"]', "string", True), ('["int","long"]', "bigint", False), ('["double","float","null"]', "double", True),
    ('{"type":"array","items":["int","null"]}', "array<int>", False), ('{"type":"map","values":"long"}', "map<string,bigint>", False),
    ('{"type":"enum","name":"e","symbols":["a"]}', "string", False), ('{"type":"fixed","name":"f","size":2}', "binary", False),
    ('{"type":"record","name":"r","fields":[{"name":"x","type":"int"},{"name":"y","type":["null","string"]}]}', "struct<x:int,y:string>", False),
]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}', {str(c).lower()})" for a, b, c in _TYPES) + ") t(avro, spark, nullable)")
def avro_to_spark_types(spark, sf_dir):
    rows = [(a, *(lambda t: (t[0].simpleString(), t[1]))(avro.to_spark(json.loads(a)))) for a, _, _ in _TYPES]
    return spark.createDataFrame(rows, "avro string, spark string, nullable boolean")


_BACK = [("int", '"int"'), ("smallint", '"int"'), ("bigint", '"long"'), ("float", '"float"'), ("double", '"double"'), ("boolean", '"boolean"'), ("string", '"string"'), ("binary", '"bytes"'), ("timestamp", '"long"'), ("decimal(10,2)", '"string"'), ("array<int>", '{"type": "array", "items": ["int", "null"]}'), ("map<string,double>", '{"type": "map", "values": ["double", "null"]}')]


@query("SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _BACK) + ") t(spark, avro)")
def spark_to_avro_types(spark, sf_dir):
    return spark.createDataFrame([(a, json.dumps(avro.from_spark(T._parse_datatype_string(a)))) for a, _ in _BACK], "spark string, avro string")


# Snapshots and later writes.


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders")
def snapshot_with_later_cells(spark, sf_dir):
    """Rows written after the snapshot are merged in; the others are scanned."""
    table = orders(spark, sf_dir)
    table.compact()
    table.write(source(spark, sf_dir, "orders").where("o_orderkey % 10 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")))
    return table.read()


@query(f"SELECT {_O} FROM orders WHERE o_custkey % 5 = 0")
def bulk_get_from_snapshot(spark, sf_dir):
    table = orders(spark, sf_dir)
    table.compact(trim=True)
    return table.lookup(source(spark, sf_dir, "orders").where("o_custkey % 5 = 0"))
