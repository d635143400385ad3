"""Removal of repeated substrings with a difference cover.

Bytes covered by a string of ``length`` bytes that also starts earlier
(smaller doc_id, or earlier in the same document) are removed.  Suffixes are
compared up to ``length`` bytes only, so the difference-cover algorithm needs
one level of naming instead of a recursion to the end of the text:

0. Texts are cut where their content says so (a hash of 16 bytes), and each
   piece is named together with the ``length`` - 1 bytes behind it.  All starts
   in a piece that occurs earlier are repeats; they need no names of their own,
   as the first such piece holds the same strings.  Copies end here; what
   follows deals with the other starts only.
1. Positions whose residues lie in a difference cover D modulo v are the
   sampled suffixes.  Any two positions have a shift below v that takes both
   into the sample.  Sampled suffixes are named by their first length - v + 1
   bytes; names are sorted in buckets and those of one occurrence dropped.
2. A suffix that shares ``length`` bytes with another one lies less than v
   before a sampled suffix with a shared name.  Only these remaining suffixes
   are merged in: they are named by their ``length`` bytes, sorted together
   with their places, and adjacent entries are compared.  All but the first of
   a run of equal names start a removed string.

Names are hashes (64 bits for samples, 96 bits for whole strings), not ranks:
what has to be equal is equal, and sorting them puts equal prefixes together.
Within a pack of documents each name is sent once, so a passage that a third
of all documents share stays small.

Defined cases: a null text is empty; texts shorter than ``length`` keep all
bytes, as matches never cross documents; a null doc_id comes before all
others; rows that repeat a doc_id are ordered by the packs that hold them;
extra columns are not used; an empty table gives no rows.  A task needs about
80 bytes of memory for each byte of the longest text or of a pack.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: A perfect difference set modulo 57 (fixed values): its differences take every residue.
MODULUS = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
_NO_ID = -(1 << 63)
_PACK = 3 << 19
_CUT = 16
#: One position in so many is a cut, on average.
_PIECE = np.uint64(64)
_B1, _B2 = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64, kept for the worker's life."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base] = (out[0], out[1])
    return _POWERS[base]


class Hasher:
    """Polynomial hashes of any windows of one buffer."""

    def __init__(self, data: np.ndarray, base: int) -> None:
        self.up, self.down = _tables(base, max(1 << 20, len(data) + 1))
        byte = np.random.default_rng(base & 0xFFFF).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte[data] * self.up[: len(data)], out=self.sums[1:])

    def at(self, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
        h = (self.sums[starts + width] - self.sums[starts]) * self.down[starts]
        if not isinstance(width, int):
            h += width.astype(np.uint64) * np.uint64(_B2)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


class Pack:
    """Documents one behind the other, in the order of their ids."""

    def __init__(self, ids: bytes, sizes: bytes, data: bytes, length: int) -> None:
        self.ids, self.sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        raw = pa.decompress(data, decompressed_size=int(self.sizes.sum()), codec="zstd", asbytes=True) if self.sizes.sum() else b""
        self.data, self.length = np.frombuffer(raw, np.uint8), length
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def room(self) -> np.ndarray:
        """For each position the bytes from it to the end of its document."""
        return np.repeat(self.ends, self.sizes) - np.arange(len(self.data))

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces of the starts with room for ``length`` bytes begin and end."""
        long = self.sizes >= self.length
        if not long.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        first, last = self.starts[long], self.ends[long] - self.length
        at = np.arange(len(self.data) - _CUT + 1)
        cut = np.flatnonzero(Hasher(self.data, _B1).at(at, _CUT) % _PIECE == 0)
        doc = np.searchsorted(last, cut)
        doc = np.minimum(doc, len(last) - 1)
        cut = cut[(cut > first[doc]) & (cut <= last[doc])]
        begin = np.sort(np.concatenate([first, cut]))
        doc = np.searchsorted(last, begin)
        end = np.minimum(np.append(begin[1:], len(self.data)), last[doc] + 1)
        return begin, end

    def live(self, gone: np.ndarray) -> np.ndarray:
        """Starts with room for ``length`` bytes outside the pieces that are ``gone``."""
        begin, end = self.pieces()
        delta = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(delta, begin[~gone], 1)
        np.add.at(delta, end[~gone], -1)
        return np.cumsum(delta[:-1]) > 0

    def samples(self, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions behind live starts, the sorted distinct names, each position's name, and how often it occurs."""
        width = self.length - MODULUS + 1
        at = (np.arange(0, len(self.data), MODULUS)[:, None] + np.array(COVER)).ravel()
        at = at[at < len(self.data)]
        sums = np.concatenate(([0], np.cumsum(live)))
        doc = np.searchsorted(self.ends, at, side="right")
        at = at[(at + width <= self.ends[doc]) & (sums[at + 1] > sums[np.maximum(0, at - MODULUS + 1)])]
        names, back, counts = np.unique(Hasher(self.data, _B1).at(at, width), return_inverse=True, return_counts=True)
        return at, names, back, counts

    def candidates(self, live: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Live starts less than MODULUS before a sampled position with a shared name."""
        at, names, back, counts = self.samples(live)
        hit = at[shared[back]]
        delta = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(delta, np.maximum(0, hit - MODULUS + 1), 1)
        np.add.at(delta, hit + 1, -1)
        return np.flatnonzero((np.cumsum(delta[:-1]) > 0) & live)

    def strings(self, starts: np.ndarray, width: int | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.recarray]:
        """The strings' order by name, then place; which of them are the pack's first of a name; their names."""
        h, g = Hasher(self.data, _B1).at(starts, width), Hasher(self.data, _B2).at(starts, width).astype(np.uint32)
        order = np.lexsort((g, h))  # stable: places stay in order
        h, g = h[order], g[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))) if len(h) else np.empty(0, bool)
        return order, new, np.rec.fromarrays([h, g], names="h,g")


def _least(values: np.ndarray) -> tuple[int, bytes]:
    low = int(values.min(initial=1 << 62)) if len(values) else 0
    rest = (values.astype(object) - low) if len(values) and int(values.max()) - low > 1 << 62 else values - low
    top = int(max(rest)) if len(values) else 0
    kind = next(k for k in ("<u2", "<u4", "<u8") if top < 1 << (8 * int(k[2])))
    return low, kind[2].encode() + np.asarray(rest, kind).tobytes()


def _wide(low: int, blob: bytes) -> np.ndarray:
    return np.frombuffer(blob[1:], f"<u{blob[:1].decode()}").astype(np.int64) + low


def _packs(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        size, count = 0, 0
        part = TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            rows = sorted(held, key=lambda r: r[0])
            data = pa.compress(b"".join(r[1] for r in rows), codec="zstd", asbytes=True)
            cols = [[(part << 32) + count], [np.array([r[0] for r in rows], np.int64).tobytes()], [np.array([len(r[1]) for r in rows], np.int64).tobytes()], [data], [sum(len(r[1]) for r in rows)]]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:4]), pa.array(cols[4], pa.int64())], names=["pack", "ids", "sizes", "data", "n"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                if held and size + len(raw) > _PACK:
                    yield close()
                    held, size, count = [], 0, count + 1
                held.append((_NO_ID if i is None else i, raw))
                size += len(raw)
        if held:
            yield close()

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "pack long, ids binary, sizes binary, data binary, n long")


def _bits(flags: np.ndarray) -> bytes:
    return pa.compress(np.packbits(flags).tobytes(), codec="zstd", asbytes=True)


def _unbits(blob: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(blob, decompressed_size=-(-n // 8), codec="zstd", asbytes=True) if n else b""
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=n).astype(bool)


def _slices(sorted_hashes: np.ndarray, bits: int) -> dict[int, slice]:
    """Where the buckets (the upper ``bits``) that are not empty lie among sorted hashes."""
    bucket = sorted_hashes >> np.uint64(64 - bits)
    begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
    return {int(bucket[a]): slice(int(a), int(b)) for a, b in zip(begin, np.append(begin[1:], len(bucket)))}


def _joined(flags: list, sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    out, cuts = np.zeros(len(sorted_hashes), bool), _slices(sorted_hashes, bits)
    for f in flags or []:
        s = cuts[f["bucket"]]
        out[s] = _unbits(f["flags"], s.stop - s.start)
    return out


def _later(new: np.ndarray, names: np.recarray, flags: list, bits: int) -> np.ndarray:
    """In the order of names: all but the pack's first of a name, and firsts of which another pack has an earlier one."""
    out = ~new
    out[new] = _joined(flags, names.h[new], bits)
    return out


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))], names=names)


def remove_repeats(docs: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text", with_kept: bool = False, names_per_bucket: int = 2_000_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of each row, and the bytes ``kept`` if asked for."""
    if length < 2 * MODULUS - 14:
        raise ValueError(f"length must be at least {2 * MODULUS - 14}")
    packs = common.materialise(_packs(docs, key, text), "packs")
    total = packs.agg(F.sum("n")).first()[0] or 0
    # Buckets grow with the text, so that what one of them holds doesn't.
    bits = min(32, max(2, (int(total * len(COVER) / MODULUS / names_per_bucket)).bit_length()))
    skip = np.uint64(16 - bits if bits < 16 else 0)

    def open_pack(r: dict) -> tuple[Pack, np.ndarray]:
        """The pack, and which of its starts are live once repeated pieces are known."""
        pack = Pack(r["ids"], r["sizes"], r["data"], length)
        begin, end = pack.pieces()
        order, new, names = pack.strings(begin, end - begin + length - 1)
        gone = np.empty(len(begin), bool)
        gone[order] = _later(new, names, r["pieces"], bits)
        return pack, pack.live(gone)

    def open_strings(r: dict) -> tuple[Pack, np.ndarray, np.ndarray]:
        pack, live = open_pack(r)
        names = pack.samples(live)[1]
        return pack, live, pack.candidates(live, _joined(r["shared"], names, bits))

    def sent(pack: Pack, number: int, starts: np.ndarray, width: int | np.ndarray) -> Iterator[pa.RecordBatch]:
        order, new, names = pack.strings(starts, width)
        names, places = names[new], starts[order][new]
        ids = pack.ids[np.searchsorted(pack.ends, places, side="right")]
        rows = []
        for k, s in _slices(names.h, bits).items():
            low, blob = _least(ids[s])
            rows.append((k, number, names.h[s].astype("<u8").tobytes(), names.g[s].astype("<u4").tobytes(), low, blob))
        if rows:
            yield _batch(rows, ["bucket", "pack", "h", "g", "low", "ids"], [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()])

    def piece_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                pack = Pack(r["ids"], r["sizes"], r["data"], length)
                begin, end = pack.pieces()
                yield from sent(pack, r["pack"], begin, end - begin + length - 1)

    def sample_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                _, names, _, counts = Pack.samples(*open_pack(r))
                short = (names >> skip).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows = [(k, r["pack"], short[s].tobytes(), _bits(counts[s] > 1)) for k, s in _slices(names, bits).items()]
                if rows:
                    yield _batch(rows, ["bucket", "pack", "names", "many"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()])

    def string_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                pack, _, starts = open_strings(r)
                yield from sent(pack, r["pack"], starts, length)

    def shared_names(table: pa.Table) -> pa.Table:
        blobs = table.column("names").to_pylist()
        sizes = [len(x) // 6 for x in blobs]
        raw = np.zeros((sum(sizes), 8), np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 6)
        names = raw.view("<u8").ravel()
        many = np.concatenate([_unbits(x, n) for x, n in zip(table.column("many").to_pylist(), sizes)])
        order = np.argsort(names, kind="stable")
        ordered = names[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        run = np.cumsum(new) - 1
        shared = (np.bincount(run) > 1) | (np.bincount(run, weights=many[order]) > 0)
        flags = np.empty(len(names), bool)
        flags[order] = shared[run]
        ends = np.cumsum(sizes)
        return pa.table([table.column("bucket"), table.column("pack"), pa.array([_bits(flags[e - n : e]) for e, n in zip(ends, sizes)], pa.binary())], names=["bucket", "pack", "flags"])

    def later_strings(table: pa.Table) -> pa.Table:
        col = {n: table.column(n).to_pylist() for n in table.column_names}
        h, g = np.frombuffer(b"".join(col["h"]), "<u8"), np.frombuffer(b"".join(col["g"]), "<u4")
        sizes = [len(x) // 8 for x in col["h"]]
        ids = np.concatenate([_wide(a, x) for a, x in zip(col["low"], col["ids"])])
        packs_of = np.repeat(np.array(col["pack"], np.int64), sizes)
        order = np.lexsort((packs_of, ids, g, h))
        new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])))
        flags = np.empty(len(h), bool)
        flags[order] = ~new
        ends = np.cumsum(sizes)
        return pa.table([table.column("bucket"), table.column("pack"), pa.array([_bits(flags[e - n : e]) for e, n in zip(ends, sizes)], pa.binary())], names=["bucket", "pack", "flags"])

    reply, named = "bucket long, pack long, flags binary", "bucket long, pack long, h binary, g binary, low long, ids binary"

    def by_pack(flags: DataFrame, name: str) -> DataFrame:
        return common.materialise(flags.groupBy("pack").agg(F.collect_list(F.struct("bucket", "flags")).alias(name)), name)

    def ask(found: DataFrame, run, schema: str, answer, name: str) -> DataFrame:
        """One round: names go to their buckets, flags come back; the packs with the flags of all rounds so far."""
        back = by_pack(found.mapInArrow(run, schema).groupBy("bucket").applyInArrow(answer, reply), name)
        return found.join(back, "pack", "left")

    found = ask(packs, piece_names, named, later_strings, "pieces")
    found = ask(found, sample_names, "bucket long, pack long, names binary, many binary", shared_names, "shared")
    found = ask(found, string_names, named, later_strings, "later")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                pack, live, starts = open_strings(r)
                order, new, names = pack.strings(starts, length)
                again = starts[order][_later(new, names, r["later"], bits)]
                delta = np.zeros(len(pack.data) + 1, np.int32)
                begin, end = pack.pieces()
                inside = np.zeros(len(pack.data) + 1, np.int32)
                np.add.at(inside, begin, 1)
                np.add.at(inside, end, -1)
                begin = np.concatenate([again, np.flatnonzero((np.cumsum(inside[:-1]) > 0) & ~live)])
                np.add.at(delta, begin, 1)
                np.add.at(delta, begin + length, -1)
                covered = np.cumsum(delta[:-1]) > 0
                edge = covered.copy()
                edge[1:] &= ~covered[:-1]
                at = pack.starts[pack.sizes > 0]
                edge[at] = covered[at]
                sums, runs = np.concatenate(([0], np.cumsum(covered))), np.concatenate(([0], np.cumsum(edge)))
                rows = []
                for i, s, e in zip(pack.ids.tolist(), pack.starts.tolist(), pack.ends.tolist()):
                    removed = int(sums[e] - sums[s])
                    kept = pack.data[s:e][~covered[s:e]].tobytes() if removed else pack.data[s:e].tobytes()
                    rows.append((None if i == _NO_ID else i, e - s, removed, int(runs[e] - runs[s]), hashlib.sha256(kept).hexdigest(), *([kept] if with_kept else [])))
                if rows:
                    yield _batch(rows, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept], [pa.int64()] * 4 + [pa.string(), pa.binary()][: 1 + with_kept])

    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return found.mapInArrow(cut, out)
