"""Near-duplicate documents: SimHash fingerprints and tries propose, Jaccard similarity of word shingles decides.

Two documents are near if their sets of shingles share at least 4 / 5 of
their union.  Documents with equal sets are one class.  Candidates among
classes come from two sides:

* the trie self-join of ``simhash`` over fingerprints of the sets, within two
  bits, which finds the closest copies;
* shingles are ordered by one global order; two near sets have a shingle in
  common among the first ``n - ceil(4 n / 5) + 1`` of each, whatever the
  order is, so only those are dealt out by shingle, once.  The order puts
  shingles that are common in a bounded sample last, which keeps groups
  small; the sample decides the cost, never the result.  First members of a
  group are compared with their neighbours by fingerprint, of which each
  document keeps the ``closest`` ones; this joins most of a large group of
  near copies.  Then all members of a group that are still in different
  components are compared.

Neighbours must be of near sizes and have fingerprints of 256 bits within
``budget`` bits, which costs no link, as all pairs of a group are still to
come.  Those are left out by two bounds that hold for every near pair:

* what two sets share lies, from the first shared shingle on, in the rest of
  both, so the shorter rest holds at least 4 / 9 of the sum of the sizes.
  Rare shingles come first, so a copy that has many of its own fails here;
* a parity sketch has one bit for the parity of the number of shingles of a
  hash value; two sketches never differ in more bits than the sets differ in
  shingles, which for near sets is at most 1 / 9 of the sum of the sizes.
  512 bits are compared in the groups and sketches of 2 n to 4 n bits
  (65,536 at most) once for each pair.

Of what is left each document's ``closest`` pairs come first, then what still
is in different components.  Every pair that is linked has been verified on
the two texts.

A shingle with more than 1 / 1024 of all entries, as far as a sixteenth of
the documents shows, is split: neighbours are sought in its parts, whose first
members are compared with one pivot, and members of different components by
pairs of parts.

Defined cases: words are as in ``simhash``; a text of fewer words than
``width`` is one shingle; null, empty and blank texts are one class; rows are
told apart by their place, so repeated and null ids are rows like others;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, simhash
from .components import components


def shingles(text: str | None, width: int = 5) -> set[bytes]:
    words = text.encode("utf-8", "surrogatepass").translate(common.LOWER).split() if text else []
    if not words:
        return set()
    return {b" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def _hashes(text: str | None, width: int) -> np.ndarray:
    found = shingles(text, width)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)))


def near(x: set[bytes], y: set[bytes]) -> bool:
    """Whether the Jaccard similarity is at least 0.8; two empty sets are equal."""
    shared = len(x & y)
    return 5 * shared >= 4 * (len(x) + len(y) - shared)


def common_shingles(docs: DataFrame, width: int, sample: int, least: int = 20, most: int = 65_536) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, and counts, of shingles in ``least`` or more of about ``sample`` documents (``most`` at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                found = [_hashes(t.as_py(), width) for t in b.column(0)[k : k + 256]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["h"])

    step = max(1, -(-docs.count() // sample))
    part = docs.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0).select("text")
    rows = part.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= least).orderBy(F.desc("count"), "h").limit(most).collect()
    h, n = np.array([r["h"] for r in rows], np.int64).view(np.uint64), np.array([r["count"] for r in rows], np.int64)
    order = np.argsort(h)
    return h[order], n[order]


_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _wide(s: np.ndarray) -> list[int]:
    """Four fingerprints of a set, by four hashes of each member."""
    out = [simhash.bits_of(s.astype("<u8"))]
    for m in _MIX:
        x = (s ^ (s >> np.uint64(29))) * m
        out.append(simhash.bits_of((x ^ (x >> np.uint64(32))).astype("<u8")))
    return out


_FEW, _MOST = 512, 65_536  # bits of the parity sketches


def _parity(s: np.ndarray, bits: int) -> np.ndarray:
    """The parities of how many members fall on each bit; a sketch of fewer bits is this one folded."""
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little")


def _fold(x: np.ndarray, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def _differ(x: bytes, y: bytes) -> int:
    """A lower bound of the number of shingles that only one of two sets has, by their parity sketches."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(_fold(np.frombuffer(x, np.uint8), size) ^ _fold(np.frombuffer(y, np.uint8), size)).sum())


def _prints(docs: DataFrame, width: int, usual: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``id``, two halves of a hash of the whole set, its size, its fingerprints (``fp`` and three more), the prefix and two parity sketches."""
    shared = docs.sparkSession.sparkContext.broadcast(usual)  # bounded by `most` of common_shingles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for b in batches:
            tops, lows, sizes, marks, prefixes, few, odd = [], [], [], [], [], [], []
            for t in b.column(1):
                s = _hashes(t.as_py(), width)
                n, whole = len(s), xxhash.xxh3_128_intdigest(s.tobytes())
                rank = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, counts[at], 0)
                tops.append(whole >> 64)
                lows.append(whole & (1 << 64) - 1)
                sizes.append(n)
                marks.append(_wide(s))
                prefixes.append(s[np.lexsort((s, rank))[: n - -(-4 * n // 5) + 1]].view(np.int64))
                parity = _parity(s, min(_MOST, max(_FEW, 1 << (2 * n - 1).bit_length() if n else 0)))
                few.append(_fold(parity, _FEW // 8).tobytes())
                odd.append(parity.tobytes())
            halves = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (tops, lows, *(zip(*marks) if marks else [[]] * 4))]
            yield pa.RecordBatch.from_arrays([b.column(0), *halves, pa.array(sizes, pa.int32()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(few, pa.binary()), pa.array(odd, pa.binary())], names=["id", "top", "low", "fp", "f1", "f2", "f3", "n", "prefix", "few", "odd"])

    return docs.mapInArrow(run, "id long, top long, low long, fp long, f1 long, f2 long, f3 long, n int, prefix array<long>, few binary, odd binary")


def _verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Those of ``(a, b)`` that are near, by their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = None  # the two texts of a pair follow on each other
        for batch in batches:
            a, b = [], []
            for x, y, t in zip(*(c.to_pylist() for c in batch.columns)):
                if first is None:
                    first = shingles(t, width)
                    continue
                if near(first, shingles(t, width)):
                    a.append(x)
                    b.append(y)
                first = None
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ends = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("id")).join(docs, "id")
    return ends.select("a", "b", "text").repartition("a", "b").sortWithinPartitions("a", "b").mapInArrow(run, "a long, b long")


def _grouped(entries: DataFrame) -> DataFrame:
    """``entries`` (h, part, id, s, p) of groups of two or more, and of all parts, with the ``last`` id before in the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # the last two rows: one that is out, and one that waits for its successor
        names = ["h", "part", "id", "s", "p", "last"]

        def out(t: pa.Table, first: int, end: int) -> pa.RecordBatch:
            h, part, ids = (t.column(k).to_numpy() for k in range(3))
            same = np.concatenate(([False], (h[1:] == h[:-1]) & (part[1:] == part[:-1]))) if len(h) else np.empty(0, bool)
            near = same | np.append(same[1:], False) | (part >= 0)
            rows = np.flatnonzero(near[first:end]) + first
            last = pa.array(ids[np.maximum(rows - 1, 0)], mask=~same[rows])
            return pa.RecordBatch.from_arrays([*(t.column(k).take(pa.array(rows)).combine_chunks() for k in range(5)), last], names=names)

        before = 0
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            yield out(t, before, t.num_rows - 1)
            held = t.slice(max(0, t.num_rows - 2))
            before = held.num_rows - 1
        if held is not None:
            yield out(held, before, held.num_rows)

    sorted_ = entries.repartition("h", "part").sortWithinPartitions("h", "part", "s", "id")
    return sorted_.select("h", "part", "id", "s", "p").mapInArrow(run, "h long, part int, id long, s int, p int, last long")


def _across(named: DataFrame) -> DataFrame:
    """Pairs (a, b) of one group and of different roots that may be near; rows (h, i, j, id, root, part, p, n, few)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(t: pa.Table) -> pa.RecordBatch:
            h, i, j, ids, root, part, p, n = (t.column(k).to_numpy() for k in range(8))
            few = np.frombuffer(b"".join(t.column(8).to_pylist()), np.uint64).reshape(len(h), -1)
            n = n.astype(np.int64)
            rest, out = n - p, []
            many = np.flatnonzero(np.concatenate(([True], (np.diff(h) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0))))
            ends = np.repeat(np.append(many[1:], len(h)), np.diff(np.append(many, len(h))))
            at = np.arange(len(h))
            step = 1
            while len(at := at[at + step < ends[at]]):
                x, y = at, at + step
                both = n[x] + n[y]
                ok = (root[x] != root[y]) & ((i[x] == j[x]) | (part[x] != part[y])) & (9 * np.minimum(rest[x], rest[y]) >= 4 * both)
                x, y, both = x[ok], y[ok], both[ok]
                ok = 9 * np.bitwise_count(few[x] ^ few[y]).sum(1, dtype=np.int64) <= both
                if ok.any():
                    out.append((ids[x[ok]], ids[y[ok]]))
                step += 1
            a = np.concatenate([np.minimum(*o) for o in out]) if out else np.empty(0, np.int64)
            b = np.concatenate([np.maximum(*o) for o in out]) if out else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            key = [t.column(k).to_numpy() for k in range(3)]
            same = np.flatnonzero((key[0] != key[0][-1]) | (key[1] != key[1][-1]) | (key[2] != key[2][-1]))
            cut = int(same[-1]) + 1 if len(same) else 0
            if cut:  # the last group may go on
                yield pairs(t.slice(0, cut))
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield pairs(held)

    return named.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(run, "a long, b long")


def _possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Those of ``(a, b)`` that may be near by their whole parity sketches, with the bits that ``differ``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b, d) for a, b, n, x, y in zip(*(c.to_pylist() for c in batch.columns)) if 9 * (d := _differ(x, y)) <= n]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], names=["a", "b", "differ"])

    one, other = (members.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("odd").alias(f"odd_{c}")) for c in "ab")
    both = pairs.join(one, "a").join(other, "b")
    return both.select("a", "b", F.expr("n_a + n_b"), "odd_a", "odd_b").mapInArrow(run, "a long, b long, differ long")


def _rooted(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of ``(a, b)`` that are in different components."""
    for c in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.where("coalesce(root_a, a) <> coalesce(root_b, b)").drop("root_a", "root_b")


def kept(docs: DataFrame, width: int = 5, sample: int = 20_000, budget: int = 70, closest: int = 4, part_most: int = 20_000) -> DataFrame:
    """``docs`` without the rows that are near one that stays linked to them: of each component one row, of the smallest doc_id, stays."""
    spark, made = docs.sparkSession, len(common.MADE)
    _id, columns = common.free_name(docs, "_row"), docs.columns
    docs = common.materialise(docs.withColumn(_id, F.monotonically_increasing_id()), "rows")
    keep = [common.MADE[-1]]
    texts = docs.select(F.col(_id).alias("id"), F.col("text").cast("string"))
    prints = common.materialise(_prints(texts, width, common_shingles(texts, width, sample)), "prints")
    order = docs.select(F.col(_id).alias("id"), F.col("doc_id").cast("long"))
    ranked = prints.select("id", "top", "low").join(order, "id").select("top", "low", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id").alias("rank"))
    classes = common.materialise(ranked.groupBy("top", "low").agg(F.min("rank").alias("rank")).select("rank.id", "rank"), "classes")
    members = common.materialise(prints.drop("top", "low").join(classes.select("id"), "id", "left_semi"), "members")
    common.drop_made(spark, made, [p for p in common.MADE[made:] if "/prints-" not in p])
    sketch = members.drop("prefix", "few", "odd")
    entries = members.select(F.posexplode("prefix").alias("p", "h"), "id", F.shiftright("fp", 32).cast("int").alias("s"))
    # Which shingles are split changes the cost, never the pairs.
    some = members.where("pmod(xxhash64(id), 16) = 0").select(F.explode("prefix").alias("h"), "id")
    total = members.agg(F.sum(F.size("prefix"))).first()[0] or 0
    seen = some.groupBy("h").agg((16 * F.count("*")).alias("rows"), F.min("id").alias("pivot"))
    parts = F.ceil(F.col("rows") / part_most).cast("int")
    hot = F.broadcast(common.materialise(seen.where(F.col("rows") * common.HOT_KEYS > total + 16 * common.HOT_KEYS).select("h", "pivot", F.greatest(parts, F.lit(2)).alias("parts")), "hot"))
    dealt = entries.join(hot, "h", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"), F.lit(-1)))
    groups = common.materialise(_grouped(dealt), "groups")
    pair = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    other = sketch.toDF(*(f"{c}2" for c in sketch.columns))
    differ = " + ".join(f"bit_count({c} ^ {c}2)" for c in ("fp", "f1", "f2", "f3"))

    def close(pairs: DataFrame) -> DataFrame:
        """Of ``(a, b)`` those of near sizes and fingerprints, with the bits that differ."""
        both = pairs.join(sketch, pairs.a == sketch.id).join(other, F.col("b") == F.col("id2"))
        return both.where("5L * least(n, n2) >= 4L * greatest(n, n2)").select("a", "b", F.expr(differ).alias("bits")).where(F.col("bits") <= budget)

    beside = groups.where("last IS NOT NULL").select(F.col("id").alias("x"), F.col("last").alias("y"))
    firsts = groups.where("last IS NULL AND part >= 0").join(hot, "h").select(F.col("id").alias("x"), F.col("pivot").alias("y"))
    one = common.materialise(sketch.groupBy("fp").agg(F.min("id").alias("id")), "fingerprints")
    tries = simhash.links(one.select("fp"))
    tries = tries.join(one.select(F.col("fp").alias("a"), F.col("id").alias("x")), "a").join(one.select(F.col("fp").alias("b"), F.col("id").alias("y")), "b").select("x", "y")
    found = close(beside.unionByName(firsts).unionByName(tries).where("x <> y").select(*pair).distinct())
    nearest = Window.partitionBy("b").orderBy("bits", "a")
    tested = common.materialise(found.withColumn("k", F.row_number().over(nearest)).where(F.col("k") <= closest).select("a", "b"), "tested")
    links = common.materialise(_verified(tested, texts, width), "links")
    roots = common.materialise(components(links), "roots")
    # Only members in different components are left to compare.
    rooted = groups.join(roots, groups.id == roots.node, "left").select("h", "part", "id", "p", F.coalesce("root", "id").alias("root"))
    rooted = common.materialise(rooted, "rooted")
    mixed = rooted.groupBy("h").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("h")
    rooted = rooted.join(mixed, "h", "left_semi").join(members.select("id", "n", "few"), "id")
    row = ("h", "i", "j", "id", "root", "part", "p", "n", "few")
    plain = rooted.where("part < 0").withColumns({"i": F.lit(0), "j": F.lit(0)})
    split = rooted.where("part >= 0").join(hot.select("h", "parts"), "h").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"i": F.least("part", "k"), "j": F.greatest("part", "k")})
    across = _across(plain.select(*row).unionByName(split.select(*row)))
    # A pair comes from each group that it shares; it is looked up once.
    across = common.materialise(across.distinct(), "across")
    rest = common.materialise(_possible(across.join(tested, ["a", "b"], "left_anti"), members), "rest")
    # The closest pairs of each document join most components, and need not all be compared.
    nearest = Window.partitionBy("b").orderBy("differ", "a")
    first = common.materialise(rest.withColumn("k", F.row_number().over(nearest)).where(F.col("k") <= closest).select("a", "b"), "first")
    if first.limit(1).count():
        links = common.materialise(links.unionByName(_verified(first, texts, width)), "links")
        roots = common.materialise(components(links), "roots")
        rest = common.materialise(_rooted(rest.join(first, ["a", "b"], "left_anti"), roots).select("a", "b"), "rest")
        if rest.limit(1).count():
            roots = common.materialise(components(links.unionByName(_verified(rest, texts, width))), "roots")
    both = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    ranks = both.join(classes.select(F.col("id").alias("node"), "rank"), "node")
    first = ranks.groupBy("root").agg(F.min("rank").alias("rank")).select("rank.id")
    gone = both.select(F.col("node").alias("id")).join(first, "id", "left_anti")
    stay = common.materialise(classes.select("id").join(gone, "id", "left_anti").withColumnRenamed("id", _id), "stay")
    common.drop_made(spark, made, [*keep, common.MADE[-1]])
    return docs.join(stay, _id, "left_semi").select(*columns)
