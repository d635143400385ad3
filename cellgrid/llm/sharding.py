"""Sharding by histogram sort (native): shards of near equal bytes, cut from one order of keys.

Rows are ordered by the hash of the text, then by doc_id, so equal texts lie
together.  Bytes below candidate boundaries are counted exactly over all
partitions; the interval around each target is refined round by round until
a boundary meets the tolerance; rows then move once.  Only the counts of a
round come to the driver: ``bins`` per boundary at most.

A boundary falls between two groups of equal texts if one is within the
tolerance, or within the longest text of the boundary's place; else it cuts
the group by doc_id, so that a group of a third of all rows can't make a
shard too large.

Defined cases: a null text counts as empty (size 1, checksum 0); a null
doc_id sorts first; fully equal rows share a boundary's side; an empty table
gives no rows; extra columns pass through (those named as the results are
replaced).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

_LEAST_ID = -(1 << 63)


@dataclass(frozen=True)
class Splitter:
    """Rows from this key on belong to later shards."""

    hash: int
    doc_id: int = _LEAST_ID

    def reached(self, h: Column, doc_id: Column) -> Column:
        if self.doc_id == _LEAST_ID:
            return h >= F.lit(self.hash)
        return (h > F.lit(self.hash)) | ((h == F.lit(self.hash)) & (doc_id >= F.lit(self.doc_id)))


def _order_key(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def _counts(keys: DataFrame, value: str, ranges: list[tuple[int, int]], within: Column | None, bins: int) -> dict[tuple[int, int], list]:
    """Exact (bin, bytes, least, most) of ``value`` in ``bins`` parts of each ``[low, high)``."""
    out: dict[tuple[int, int], list] = {r: [] for r in ranges}
    which, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, (low, high) in enumerate(ranges):
        shift = max(0, (high - low - 1).bit_length() - (bins - 1).bit_length())
        inside = (F.col(value) >= F.lit(low)) & (F.col(value) <= F.lit(high - 1))
        which = F.when(inside, F.lit(k)).otherwise(which)
        slot = F.when(inside, F.shiftrightunsigned(F.col(value) - F.lit(low), shift)).otherwise(slot)
    rows = keys if within is None else keys.where(within)
    found = (
        rows.select(which.alias("k"), slot.alias("bin"), F.col(value).alias("v"), "size")
        .where("k IS NOT NULL")
        .groupBy("k", "bin")
        .agg(F.sum("size").alias("bytes"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    for r in found.collect():  # len(ranges) * bins rows at most
        out[ranges[r.k]].append((r.low, r.high, r.bytes))
    return {k: sorted(v) for k, v in out.items()}


def find_splitters(keys: DataFrame, shards: int, tolerance: float = 0.002, bins: int = 2048) -> list[Splitter]:
    """``shards - 1`` boundaries for ``keys`` (``h``, ``id``, ``size``)."""
    total, longest = keys.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return [Splitter(0)] * (shards - 1)
    slack = max(tolerance * total / shards, longest)
    done: dict[int, Splitter] = {}
    # For each boundary: the range that holds it and the bytes below that range.
    hashes = {k: (0, 1 << 63, 0) for k in range(1, shards)}
    groups: dict[int, tuple[int, int, int, int]] = {}  # hash, then as above for ids
    while hashes or groups:
        counts = _counts(keys, "h", sorted({x[:2] for x in hashes.values()}), None, bins) if hashes else {}
        for k, (low, high, below) in list(hashes.items()):
            target = total * k / shards
            for least, most, size in counts[low, high]:
                if below + size >= target:
                    break
                below += size
            before, after = target - below, below + size - target
            if min(before, after) <= slack:
                done[k] = Splitter(least if before <= after else most + 1)
                del hashes[k]
            elif least == most:
                groups[k] = (least, _LEAST_ID, 1 << 63, below)
                del hashes[k]
            else:
                hashes[k] = (least, most + 1, below)
        for h in sorted({x[0] for x in groups.values()}):
            mine = {k: x for k, x in groups.items() if x[0] == h}
            counts = _counts_of_ids(keys, h, sorted({x[1:3] for x in mine.values()}), bins)
            for k, (_, low, high, below) in mine.items():
                target = total * k / shards
                for least, most, size in counts[low, high]:
                    if below + size >= target:
                        break
                    below += size
                before, after = target - below, below + size - target
                if least == most or min(before, after) <= min(slack, longest):
                    cut = least if before <= after else most + 1
                    done[k] = Splitter(h, cut) if cut < 1 << 63 else Splitter(h + 1)  # behind the largest long: behind the group
                    del groups[k]
                else:
                    groups[k] = (h, least, most + 1, below)
    return [done[k] for k in range(1, shards)]


def _counts_of_ids(keys: DataFrame, h: int, ranges: list[tuple[int, int]], bins: int) -> dict[tuple[int, int], list]:
    """As ``_counts``, for the ids of one group, which may be any longs.

    Bins are aligned cells, at most ``bins`` of a range, so nothing is
    subtracted; a range cut to the ids of one cell has smaller cells, down to
    single ids.
    """
    out: dict[tuple[int, int], list] = {r: [] for r in ranges}
    which, cell = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, (low, high) in enumerate(ranges):
        shift = next(s for s in range(65) if ((high - 1) >> s) - (low >> s) < bins)
        inside = (F.col("id") >= F.lit(low)) & (F.col("id") <= F.lit(high - 1))
        which = F.when(inside, F.lit(k)).otherwise(which)
        cell = F.when(inside, F.shiftright("id", shift)).otherwise(cell)
    rows = keys.where(F.col("h") == F.lit(h)).select(which.alias("k"), cell.alias("cell"), "id", "size").where("k IS NOT NULL")
    found = rows.groupBy("k", "cell").agg(F.sum("size").alias("bytes"), F.min("id").alias("low"), F.max("id").alias("high"))
    for r in found.collect():  # len(ranges) * bins rows at most
        out[ranges[r.k]].append((r.low, r.high, r.bytes))
    return {k: sorted(v) for k, v in out.items()}


def shard(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id", tolerance: float = 0.002, part_rows: int = 262_144) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard).

    Slots follow from one exchange by shard and a part of it, by a hash of the id, of about ``part_rows`` rows; the
    first slot of each part is looked up in a broadcast of one row for ``part_rows`` rows (32 a shard at least).
    """
    body = common.whole_text(text)
    ids = F.coalesce(F.col(key).cast("long"), F.lit(_LEAST_ID))
    sized = docs.drop("size", "text_crc32", "shard", "slot").withColumns(
        {"size": F.octet_length(body).cast("long") + 1, "text_crc32": F.crc32(F.encode(body, "UTF-8"))}
    )
    keys = common.materialise(docs.select(_order_key(body).alias("h"), ids.alias("id"), (F.octet_length(body).cast("long") + 1).alias("size")), "keys")
    splitters = find_splitters(keys, shards, tolerance)
    spread = max(32, -(-keys.count() // (shards * part_rows)))

    def place(h: Column, i: Column) -> Column:
        """The shard, by halving the list of splitters."""

        def among(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            mid = (low + high) // 2
            return F.when(splitters[mid].reached(h, i), among(mid + 1, high)).otherwise(among(low, mid))

        return among(0, len(splitters))

    def part(h: Column, i: Column) -> Column:
        return F.pmod(F.xxhash64(h, i), F.lit(spread)).cast("int")

    h, i, p, first = (common.free_name(sized, x) for x in ("_h", "_id", "_part", "_first"))
    counted = keys.groupBy(place(F.col("h"), F.col("id")).alias("shard"), part(F.col("h"), F.col("id")).alias(p)).agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy(p).rowsBetween(Window.unboundedPreceding, -1)
    starts = common.materialise(counted.select("shard", p, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first)), "starts")
    rows = sized.withColumns({h: _order_key(body), i: ids})
    rows = rows.withColumns({"shard": place(F.col(h), F.col(i)), p: part(F.col(h), F.col(i))}).join(F.broadcast(starts), ["shard", p])
    slot = F.col(first) + F.row_number().over(Window.partitionBy("shard", p).orderBy(h, i)) - 1
    return rows.withColumn("slot", slot.cast("long")).select(*sized.columns, "shard", "slot")
