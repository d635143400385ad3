"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word definition ``[^\x20\x09-\x0D]+`` (fixed values).
SPACE_CHARS = " \t\n\x0b\x0c\r"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: A to Z in bytes as a to z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: A key with more than this share of the rows is joined by broadcast; there are fewer such keys than its inverse.
HOT_KEYS = 1024


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``.

    A folder of our own is made only where none is configured (tests, laptops).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="cellgrid-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Folders that ``materialise`` has written in this process.
MADE: list[str] = []


def drop_made(spark: SparkSession, since: int, keep: list[str]) -> None:
    """Delete what was materialised after the first ``since`` folders, but for ``keep``."""
    for path in [p for p in MADE[since:] if p not in keep]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        MADE.remove(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The files outlive any executor, so a lost executor costs only its tasks.
    Once they are there, nothing reads the shuffle files that led to them, so
    Spark is asked to delete these when the write ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    MADE.append(path)
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Hand freed memory of this process back to the system; else a worker keeps it, also between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, most: int = 1 << 20) -> None:
    """From now on rows go to Python in batches of about ``most`` bytes (one row at least); a lower limit stays.

    The limit changes how many rows go at once, never which; by default it is 64 MB, held twice in the JVM as buffers grow.
    """
    now = spark.conf.get(_BATCH_BYTES, None)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) if now and not now.startswith("-") else 0
    if not 0 < now <= most:
        spark.conf.set(_BATCH_BYTES, str(most))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (names are compared without case)."""
    used, name = {c.lower() for c in df.columns}, stem
    while name.lower() in used:
        name = f"_{name}"
    return name


def whole_text(column: str | Column = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none gives an empty array."""
    core = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(core) == 0, F.array().cast("array<string>")).otherwise(
        F.split(core, f"{SPACE_CLASS}+")
    )


def bounded_labels(labels: DataFrame, bound: int, *columns: str) -> DataFrame:
    """About ``bound`` labelled rows, one per doc_id, chosen by the hash of the id.

    Used for fitting only; the choice depends on nothing but ids and the count.
    """
    rows = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *columns)
    step = max(1, -(-rows.count() // bound))
    kept = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    return kept.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in columns))


def join_hot(rows: DataFrame, table: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """``rows`` joined with ``table``, which has each ``key`` once, whatever the rows of one key are.

    Keys with more than 1 / ``HOT_KEYS`` of the rows are looked up in a broadcast of fewer than ``HOT_KEYS``
    rows of ``table``; only the others are dealt out by key.
    """
    n = rows.count() if total is None else total
    hot = rows.groupBy(key).agg(F.count("*").alias("_rows")).where(F.col("_rows") * HOT_KEYS > n).select(key)
    hot = materialise(hot, "hot")
    few = table.join(F.broadcast(hot), key, "left_semi")
    by_broadcast = rows.join(F.broadcast(few), key)
    return rows.join(F.broadcast(hot), key, "left_anti").join(table, key).unionByName(by_broadcast)
