"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Tables are written and compacted once, timed apart.  Each query is run warm:
over cells (``cells``), over the compacted table (its plain name) and as the
same query on the Parquet file itself (``parquet``).
"""

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.plans import catalogue
from cellgrid.sources.table import Table


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    found, beside = {}, {}

    def run(make) -> float:
        start = time.time()
        out = make()
        if isinstance(out, DataFrame):
            out.write.format("noop").mode("overwrite").save()
        return time.time() - start

    def best(make) -> float:
        return round(min(run(make) for _ in range(3)), 3)

    orders, customers = (catalogue.source(spark, sf_dir, n) for n in ("orders", "customer"))
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    plain = orders.select(*names)
    best(lambda: plain)
    cells = Table(spark, catalogue.scratch(spark), catalogue.ORDERS)
    cells.create(splits=cells.points_of(plain, 8))
    beside["write"] = round(run(lambda: cells.write(plain)), 3)
    table = Table(spark, catalogue.scratch(spark), catalogue.ORDERS)
    table.create(splits=table.points_of(plain, 8))
    beside["write_again"] = round(run(lambda: table.write(plain)), 3)
    beside["compact"] = round(run(table.compact), 3)
    clients = catalogue.customers(spark, sf_dir)
    clients.compact()
    few = orders.where("o_custkey % 3 = 0")

    def joined(t: Table) -> DataFrame:
        right = clients.read(("=", "c_mktsegment", "BUILDING")).select((F.col("k") + 750).cast("long").alias("o_custkey"), "c_name")
        return t.read().join(right, "o_custkey").select("o_orderkey", "o_totalprice", "c_name")

    def grouped(t: Table) -> DataFrame:
        name = f"v_{uuid.uuid4().hex}"
        t.view(name)
        return spark.sql(f"SELECT o_orderstatus, count(1) AS n, sum(o_totalprice) AS total FROM {name} GROUP BY 1")

    pairs = {
        "full_scan": (lambda t: t.read(), lambda: plain),
        "key_range": (lambda t: t.read(("and", (">=", "o_orderkey", 100), ("<=", "o_orderkey", 9000))), lambda: plain.where("o_orderkey BETWEEN 100 AND 9000")),
        "key_in": (lambda t: t.read(("in", "o_orderkey", [1, 2, 3, 500, 1000000])), lambda: plain.where("o_orderkey IN (1, 2, 3, 500, 1000000)")),
        "bulk_get": (lambda t: t.lookup(few), lambda: plain.join(few.select("o_orderkey"), "o_orderkey", "left_semi")),
        "column_range": (lambda t: t.read(("and", (">=", "o_totalprice", 100000.0), ("<", "o_totalprice", 200000.0))), lambda: plain.where("o_totalprice >= 100000 AND o_totalprice < 200000")),
        "group_by": (grouped, lambda: plain.groupBy("o_orderstatus").agg(F.count("*"), F.sum("o_totalprice"))),
        "join": (joined, lambda: plain.join(customers.where("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select("o_orderkey", "o_totalprice", "c_name")),
    }
    for name, (ours, direct) in pairs.items():
        found[name] = best(lambda: ours(table))
        beside[f"cells_{name}"] = best(lambda: ours(cells))
        beside[f"parquet_{name}"] = best(direct)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(found.values()), 3), "unit": "sec", "queries": found | beside, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
