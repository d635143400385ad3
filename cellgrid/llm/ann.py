"""Approximate nearest neighbours by largest inner product: adaptive dimension scan.

Vectors get one more component that makes all norms equal, so the largest
inner product is the least distance; a random rotation then spreads distance
evenly over the dimensions.  Lists come from k-means on a bounded sample; all
rows are assigned.  Within a probed list the rotated vectors are scanned by
column blocks: after each block a hypothesis test compares the partial
distance with the query's bound and abandons candidates that are very
unlikely to end within it.  What is left is scored exactly on the original
vectors, in double precision.

The bound of a query is its k-th best among ``seeds`` vectors of the sample,
which are candidates themselves.  Lists grow with the square root of the rows, up to
what the sample can tell apart.  How many of them to probe is measured: the
true neighbours of ``held`` vectors among all rows are found by brute force,
and so many lists are probed that ``recall`` of them lie in these.  Vectors
without any structure of 64 dimensions need about four tenths of the lists
for that, which no order of lists can help; clustered ones need few.  Lists
and their queries are dealt out in blocks of at most ``block`` rows; no list
has to fit one task.

Defined cases: vectors that are null, zero, of another length than the most
frequent one, or that hold null or non-finite components take no part; rows
with a null id neither; fewer than k candidates are all returned; equal
scores go by the smaller id; an empty table gives no rows.  Rows that repeat
an id are one query, whose results are the best of all its vectors, and one
candidate of others, with its best score.  No other column is used, whatever
its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Numbers that one temporary array holds at most.
_CELLS = 1 << 20


@dataclass
class Index:
    """Rotation, centroids and sample: bounded by the parameters of ``fit``, not by the rows."""

    dim: int
    norm2: float
    rotation: np.ndarray
    centroids: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    probes: int
    counts: np.ndarray
    vparts: np.ndarray
    qparts: np.ndarray

    def rotated(self, x: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.norm2 - (x**2).sum(1)))
        return np.c_[x, last] @ self.rotation

    def nearest_lists(self, rotated: np.ndarray) -> np.ndarray:
        return (self.centroids**2).sum(1) - 2 * rotated @ self.centroids.T

    def own_list(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector, in blocks of at most ``_CELLS`` distances."""
        step = max(1, _CELLS // max(1, len(self.centroids)))
        got = [self.nearest_lists(self.rotated(x[s : s + step], False)).argmin(1) for s in range(0, len(x), step)]
        return np.concatenate(got) if got else np.empty(0, np.int64)


def usable(vectors: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """Rows that take part, as ``id`` and ``vec`` (doubles), and their length."""
    v = F.col(column)
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.cast("array<double>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    rows = rows.where("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)")
    most = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dim = most[0]["n"] if most else 0
    return rows.where(F.size("vec") == dim), dim


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.concatenate([((c**2).sum(1) - 2 * x[i : i + 4096] @ c.T).argmin(1) for i in range(0, len(x), 4096)])
        sums, n = np.zeros_like(c), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.choice(len(x), k)])
    return c


def fit(rows: DataFrame, dim: int, n_queries: int, k: int, sample: int = 16_384, sample_most: int = 65_536, recall: float = 0.93, held: int = 256, seeds: int = 4096, block: int = 16_384, seed: int = 11) -> Index | None:
    """The index from a sample of 32 rows a list (the documented bound: ``sample`` to ``sample_most``); counts and probes cover all rows."""
    n, norm2 = rows.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).first()
    if not n:
        return None
    lists = max(1, int(min(2 * n**0.5, sample_most // 16)))
    wanted = max(sample, min(sample_most, 32 * lists))
    step = max(1, -(-n // wanted))
    got = rows.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).limit(2 * wanted).collect() or rows.limit(1).collect()
    got.sort(key=lambda r: (r["id"], r["vec"]))
    ids, x = np.array([r["id"] for r in got], np.int64), np.array([r["vec"] for r in got])
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0]
    index = Index(dim, float(norm2) * (1 + 1e-12), rotation, np.empty(0), ids, x, 1, np.empty(0), np.empty(0), np.empty(0))
    turned = index.rotated(x, False)
    lists = max(1, min(lists, len(x) // 8))
    bounds = np.sort(rng.choice(len(x), min(seeds, len(x)), replace=False))
    index.sample_ids, index.sample = ids[bounds], x[bounds]
    index.centroids = _k_means(turned, lists, rng)
    # Probes: where the true neighbours of some vectors among all rows lie.
    few = rng.choice(len(x), min(held, len(x)), replace=False)
    asked, asked_ids = x[few], ids[few]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
        for b in batches:
            for s in range(0, b.num_rows, 4096):
                part = b.slice(s, 4096)
                y, mine = _matrix(part.column(1), dim), part.column(0).to_numpy()
                score = asked @ y.T
                score[asked_ids[:, None] == mine[None, :]] = -np.inf
                m = min(k, len(y))
                c = np.argpartition(-score, m - 1, axis=1)[:, :m]
                r = np.repeat(np.arange(len(asked)), m)
                at = index.own_list(y)[c.ravel()]
                top = tuple(np.concatenate(z) for z in zip(top, (r, score[r, c.ravel()], at)))
                order = np.lexsort((-top[1], top[0]))
                q = top[0][order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                top = tuple(z[order][place < k] for z in top)
        yield pa.RecordBatch.from_arrays([pa.array(z) for z in top], names=["q", "score", "list"])

    near = rows.select("id", "vec").mapInArrow(best, "q long, score double, list long").where("score > double('-Infinity')")
    top = near.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "list"))).where(F.col("n") <= k).collect()  # `held` * k rows
    rank = np.argsort(np.argsort(index.nearest_lists(index.rotated(asked, True)), axis=1), axis=1)
    place = rank[[r["q"] for r in top], [r["list"] for r in top]] if top else []
    index.probes = int(np.quantile(place, recall, method="higher")) + 1 if len(place) else lists

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                got = np.bincount(index.own_list(_matrix(b.column(0), dim)), minlength=lists)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lists)), pa.array(got)], names=["list", "n"])

    per = rows.select("vec").mapInArrow(assign, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect()
    index.counts = np.zeros(lists, np.int64)
    for r in per:
        index.counts[r["list"]] = r["n"]
    index.vparts = np.maximum(1, -(-index.counts // block))
    expected = np.maximum(n_queries * index.probes / lists, n_queries * index.counts / max(1, n))
    index.qparts = np.maximum(1, np.ceil(2 * expected / block)).astype(np.int64)
    return index


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _mixed(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(33)).astype(np.int64)


def _blocks(n: int, dim: int) -> Iterator[slice]:
    """Ranges of ``n`` rows of ``dim`` numbers that hold ``_CELLS`` numbers at most."""
    step = max(1, _CELLS // max(1, dim))
    return (slice(s, s + step) for s in range(0, n, step))


def _scores(q: np.ndarray, r: np.ndarray, x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The inner products of rows ``r`` of ``q`` and ``c`` of ``x``."""
    out = np.empty(len(r))
    for b in _blocks(len(r), q.shape[1]):
        out[b] = (q[r[b]] * x[c[b]]).sum(1)
    return out


def _best(q_ids: np.ndarray, r: np.ndarray, ids: np.ndarray, c: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of pairs (r, c) the k best of each r, as (query, vector, score)."""
    order = np.lexsort((ids[c], -score, r))
    r, c, score = r[order], c[order], score[order]
    top = np.arange(len(r)) - np.searchsorted(r, r) < k
    return q_ids[r[top]], ids[c[top]], score[top]


def nearest(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vector, score): for each query its best k of ``x``; only what may be among these is scored pair by pair."""
    out: list[tuple[np.ndarray, ...]] = []
    far = np.sqrt((x**2).sum(1).max(initial=0))
    for b in _blocks(len(q), len(x)):
        near = q[b] @ x.T
        near[q_ids[b][:, None] == ids[None, :]] = -np.inf
        m = min(k, len(x))
        kth = np.partition(near, len(x) - m, axis=1)[:, len(x) - m]
        # Sums in another order differ by far less than this.
        slack = 1e-9 * far * np.sqrt((q[b] ** 2).sum(1))
        r, c = np.nonzero((near >= (kth - slack)[:, None]) & (near > -np.inf))
        r += b.start
        out.append(_best(q_ids, r, ids, c, _scores(q, r, x, c), k))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def scan(index: Index, q: np.ndarray, q_ids: np.ndarray, bound2: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, trust: float = 1.2, width: int = 16) -> tuple[np.ndarray, ...]:
    """(query, vector, score): for each query its best k of ``x``, of those the tests leave."""
    turned, asked = index.rotated(x, False), index.rotated(q, True)
    d = index.dim + 1
    # The first block, which all pairs take, is half of the dimensions: before that, tests tell little.
    cuts = [*range(max(width, d // 2), d, width)]
    cuts = [*cuts[:-1], d] if cuts and d - cuts[-1] < width // 2 else [*cuts, d]
    out: list[tuple[np.ndarray, ...]] = []
    step = max(1, _CELLS // max(1, len(x)))
    for s in range(0, len(q), step):
        a, limit = asked[s : s + step], bound2[s : s + step]
        first = slice(0, cuts[0])
        part = a[:, first] @ turned[:, first].T
        part *= -2.0
        part += (a[:, first] ** 2).sum(1)[:, None]
        part += (turned[:, first] ** 2).sum(1)

        def within(value: np.ndarray, seen: int, lim: np.ndarray) -> np.ndarray:
            # Distances of rotated vectors, estimated from a part of the dimensions, are off by sqrt((1 - seen / d) / (2 seen)).
            slack = (1 + 2 * trust * ((1 - seen / d) / (2 * seen)) ** 0.5) ** 2
            return value <= (slack * seen / d) * lim

        r, c = np.nonzero(within(part, cuts[0], limit[:, None]))
        left = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for b in _blocks(len(r), d):
            i, j = r[b], c[b]
            acc = part[i, j]
            for low, high in zip(cuts, cuts[1:]):
                acc = acc + ((a[i, low:high] - turned[j, low:high]) ** 2).sum(1)
                ok = within(acc, high, limit[i])
                i, j, acc = i[ok], j[ok], acc[ok]
            ok = q_ids[s + i] != ids[j]
            left.append((i[ok] + s, j[ok]))
        r, c = (np.concatenate(z) for z in zip(*left))
        out.append(_best(q_ids, r, ids, c, _scores(q, r, x, c), k))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def search(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", column: str = "embedding", **fitting: float) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found for each row of ``vectors`` with ``is_query``."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, dim = usable(vectors, key, column)
    if not dim:
        return empty
    asked, _ = usable(vectors.where(is_query), key, column)
    asked = asked.where(F.size("vec") == dim)
    index = fit(rows, dim, asked.count(), k, **fitting)
    if index is None:
        return empty
    shared = spark.sparkContext.broadcast(index)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = b.column(0).to_numpy(), _matrix(b.column(1), dim)
            at = ix.own_list(x)
            part = _mixed(ids) % ix.vparts[at]
            times = ix.qparts[at]
            row = np.repeat(np.arange(len(ids)), times)
            qpart = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            for o in _blocks(len(row), dim):
                n = pa.array(row[o])
                yield pa.RecordBatch.from_arrays([pa.array(at[row[o]]), pa.array(part[row[o]]), pa.array(qpart[o]), b.column(0).take(n), b.column(1).take(n)], names=["list", "v", "q", "id", "vec"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                b = batch.slice(s, 256)
                ids, x = b.column(0).to_numpy(), _matrix(b.column(1), dim)
                near = ix.nearest_lists(ix.rotated(x, True))
                order = np.argsort(near, axis=1, kind="stable")
                enough = (np.cumsum(ix.counts[order], axis=1) > k).argmax(1) + 1
                enough = np.where(ix.counts.sum() > k, enough, len(ix.counts))
                probes = np.maximum(ix.probes, enough)
                score = x @ ix.sample.T
                score[ids[:, None] == ix.sample_ids[None, :]] = -np.inf
                full = score.shape[1] >= k
                kth = np.partition(score, -k, axis=1)[:, -k] if full else np.full(len(ids), -np.inf)
                base = (x**2).sum(1) + ix.norm2
                bound = np.where(np.isfinite(kth), base - 2 * kth + 1e-9 * base, np.inf)
                pick = np.arange(order.shape[1])[None, :] < probes[:, None]
                r, c = np.nonzero(pick)
                at = order[r, c]
                times = ix.vparts[at]
                row, at2 = np.repeat(r, times), np.repeat(at, times)
                vpart = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                qpart = _mixed(ids[row]) % ix.qparts[at2]
                for o in _blocks(len(row), dim):
                    n = pa.array(row[o])
                    yield pa.RecordBatch.from_arrays([pa.array(at2[o]), pa.array(vpart[o]), pa.array(qpart[o]), b.column(0).take(n), b.column(1).take(n), pa.array(bound[row[o]])], names=["list", "v", "q", "id", "vec", "bound"])

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if b.num_rows:
                got = nearest(_matrix(b.column(1), dim), b.column(0).to_numpy(), ix.sample, ix.sample_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(z) for z in got], names=["query_id", "vec_id", "score"])

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        ix = shared.value
        if not left.num_rows or not right.num_rows:
            got = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        else:
            x, q = (_matrix(t.column("vec").combine_chunks(), dim) for t in (left, right))
            got = scan(ix, q, right.column("id").to_numpy(), right.column("bound").to_numpy(), x, left.column("id").to_numpy(), k)
        return pa.table([pa.array(z) for z in got], names=["query_id", "vec_id", "score"])

    keys = ["list", "v", "q"]
    # Components of 32-bit tables travel as 32-bit numbers, which loses nothing.
    kind = "float" if dict(vectors.dtypes)[column] == "array<float>" else "double"
    pack = [*keys, "id", F.col("vec").cast(f"array<{kind}>").alias("vec")]
    dealt = rows.mapInArrow(deal, "list long, v long, q long, id long, vec array<double>").select(*pack)
    wanted = asked.mapInArrow(ask, "list long, v long, q long, id long, vec array<double>, bound double").select(*pack, "bound")

    def probe_wide(left: pa.Table, right: pa.Table) -> pa.Table:
        wide = [t.set_column(t.column_names.index("vec"), "vec", t.column("vec").cast(pa.list_(pa.float64()))) for t in (left, right)]
        return probe(*wide)

    found = dealt.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(probe_wide, "query_id long, vec_id long, score double")
    every = found.unionByName(asked.mapInArrow(seeds, "query_id long, vec_id long, score double"))
    best = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
