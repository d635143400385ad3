"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint is 64 bits.  Two fingerprints within two differing bits agree
wholly on one of three blocks (22, 21, 21 bits), so each distinct fingerprint
enters three groups, one per block value; turned so that the block comes
first, the block is the top of a trie whose upper levels must agree.  Within
a group the binary trie is joined with itself: pairs of nodes descend
together, add up their differing bits and are dropped beyond the budget.  A
group that is too large for one task descends four levels as a table: each
row goes to the pairs of child nodes that its own child can still form
within the budget, and each such pair is a group of its own; this is
repeated until every group is small enough.

Texts with equal fingerprints are one class from the start; pairs are only
ever made between different fingerprints, of which each has at most 2,080
within two bits.

Defined cases: a null, empty or blank text has fingerprint zero; a text of
fewer than three words is one shingle; a null doc_id is compared as the
largest id only for the choice of a component's name; repeated rows share a
class; extra columns are left out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

BLOCKS = ((0, 22), (22, 21), (43, 21))  # turned left by so many bits, the block of so many bits comes first
_SUM_AT_ONCE = 65_536


def fingerprint(text: str | None, width: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").translate(common.LOWER).split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(flat, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[a:b], 42) for a, b in zip(starts, ends[width - 1 :].tolist())], dtype="<u8")
    return bits_of(h)


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def bits_of(h: np.ndarray) -> int:
    """Of hashes, the bits that are set in over half of them."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), _SUM_AT_ONCE):
        part = h[k : k + _SUM_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << k for k in range(64) if 2 * ones[k] > len(h)))


def trie_pairs(values: np.ndarray, budget: int, leaf: int = 8, cut: int | None = None, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of sorted distinct ``values`` within ``budget`` differing bits.

    With ``cut`` only pairs i < cut <= j: two nodes of the given ``depth``.

    A node is a range of the sorted values that share their upper bits.  All
    node pairs of a level advance together, as arrays; ``cost`` has the bits
    in which their prefixes differ.  Pairs of small nodes are compared directly.
    """
    n = len(values)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    start = (0, n, 0, n, 0) if cut is None else (0, cut, cut, n, (int(values[0] ^ values[-1]) >> (64 - depth)).bit_count())
    a0, a1, b0, b1, cost = (np.array([x], np.int64) for x in start)
    for bit in range(63 - depth, -2, -1):
        small = np.maximum(a1 - a0, b1 - b0) <= (leaf if bit >= 0 else n)
        for da in range(leaf if small.any() else 0):
            for db in range(leaf):
                i, j = a0[small] + da, b0[small] + db
                ok = (i < a1[small]) & (j < b1[small]) & (i < j)
                i, j = i[ok], j[ok]
                near = np.bitwise_count(values[i] ^ values[j]) <= budget
                out.append((i[near], j[near]))
        keep = ~small
        a0, a1, b0, b1, cost = (x[keep] for x in (a0, a1, b0, b1, cost))
        if not len(a0) or bit < 0:
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = (a0 == b0) & (a1 == b1)
        parts = [
            (a0, am, b0, bm, cost, np.ones(len(a0), bool)),
            (am, a1, bm, b1, cost, np.ones(len(a0), bool)),
            (a0, am, bm, b1, cost + 1, np.ones(len(a0), bool)),
            (am, a1, b0, bm, cost + 1, ~same),
        ]
        a0, a1, b0, b1, cost, ok = (np.concatenate(x) for x in zip(*parts))
        ok &= (a0 < a1) & (b0 < b1) & (cost <= budget)
        a0, a1, b0, b1, cost = (x[ok] for x in (a0, a1, b0, b1, cost))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs, so many that they hold their connected parts together."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def links(distinct: DataFrame, budget: int = 2, group_most: int = 50_000, groups_most: int = 65_536) -> DataFrame:
    """Links ``(a, b)`` between the different values ``fp`` that hold their components together.

    Only groups of more than ``group_most`` rows, and of more than 1 / ``groups_most`` of all rows, descend as a
    table, so the list of them has fewer than ``groups_most`` rows and is broadcast.
    """
    if budget > 2:
        raise ValueError("three blocks serve at most two differing bits")
    turned = [(k, f"(shiftleft(fp, {t}) | shiftrightunsigned(fp, {64 - t}))" if t else "fp", bits) for k, (t, bits) in enumerate(BLOCKS)]
    nodes = F.expr("array(" + ", ".join(f"named_struct('block', {k}, 'depth', {bits}, 'u', shiftrightunsigned({v}, {64 - bits}), 'v', shiftrightunsigned({v}, {64 - bits}), 'x', {v})" for k, v, bits in turned) + ")")
    spread = distinct.select(F.inline(nodes))
    key = ["block", "depth", "u", "v"]
    rows = 0
    ready: DataFrame | None = None
    while True:
        sizes = spread.groupBy(*key).count()
        total = sizes.agg(F.sum("count")).first()[0] or 0
        rows += total
        most = max(group_most, -(-total // groups_most))
        large = F.broadcast(common.materialise(sizes.where(F.col("count") > most).select(*key), "large"))
        if not large.limit(1).count():
            ready = spread if ready is None else ready.unionByName(spread)
            break
        rest = spread.join(large, key, "left_anti")
        ready = rest if ready is None else ready.unionByName(rest)
        own, other = "shiftrightunsigned(x, 60 - depth)", "if(shiftrightunsigned(x, 64 - depth) = u, v, u)"
        down = spread.join(large, key, "left_semi").withColumns({"own": F.expr(own), "other": F.expr(f"explode(transform(sequence(0L, 15L), y -> shiftleft({other}, 4) | y))")})
        down = down.where(F.expr(f"bit_count(own ^ other) <= {budget}"))
        spread = common.materialise(down.select("block", (F.col("depth") + 4).alias("depth"), F.least("own", "other").alias("u"), F.greatest("own", "other").alias("v"), "x"), "nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by group, so one group is held at a time.
        held: list[np.ndarray] = []
        last = None

        def close() -> pa.RecordBatch | None:
            block, depth, u, v = last
            values = np.unique(np.concatenate(held).view(np.uint64))
            cut = None if u == v else int(np.searchsorted(values, np.uint64(v << (64 - depth))))
            if len(values) < 2 or (cut is not None and not 0 < cut < len(values)):
                return None
            got = _forest(len(values), *trie_pairs(values, budget, cut=cut, depth=depth))
            if not got:
                return None
            turn = BLOCKS[block][0]
            if turn:
                values = (values >> np.uint64(turn)) | (values << np.uint64(64 - turn))
            a, b = (values[[x[k] for x in got]].view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            parts = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            new = np.zeros(max(0, batch.num_rows - 1), bool)
            for c in parts[:4]:
                new |= np.diff(c) != 0
            cuts = (np.flatnonzero(new) + 1).tolist()
            for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
                if s == e:
                    continue
                now = tuple(int(c[s]) for c in parts[:4])
                if now != last and held:
                    if out := close():
                        yield out
                    held = []
                last = now
                held.append(parts[4][s:e].copy())
        if held and (out := close()):
            yield out

    # Rows are small and cost much, so their number sets the tasks, not their size.
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // 16_384))
    groups = ready.select(*key, "x").repartition(tasks, *key).sortWithinPartitions(*key)
    return groups.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, budget: int = 2, width: int = 3, group_most: int = 50_000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (hex) and ``component_id``."""
    prints = common.materialise(fingerprints(docs, width), "fingerprints")
    classes = common.materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = common.materialise(components(links(classes.select("fp"), budget, group_most)), "roots")
    # The roots are members of their components too.
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "fp")
    named = common.materialise(members.join(classes, "fp"), "members")
    lows = named.groupBy("root").agg(F.min("first").alias("low"))
    labels = common.join_hot(named, lows, "root").select("fp", "low")
    table = common.materialise(classes.join(labels, "fp", "left").select("fp", F.coalesce("low", "first").alias("component_id")), "table")
    return common.join_hot(prints, table, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_documents(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs`` with one row of each group that is near by Jaccard >= 0.8 over ``width``-word shingles (see ``jaccard``)."""
    from . import jaccard

    return jaccard.kept(docs, width)
