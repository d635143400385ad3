"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

All different words of a batch that have the same length advance together,
one character at a time; long words, and texts without spaces, are cut where
no piece can span, so that their parts advance together too.  The substrings that end there are probed by their
polynomial hashes among the sorted piece keys, a vectorised maximum picks the
last piece of each prefix, and its length is stored as the back pointer.

For a unigram model the maximum is over the sum of scores.  The scores of a
BPE model are ranks of merges, whose sums mean nothing; there the last piece
of a prefix is the longest one that the merges leave standing beside the last
piece of the prefix before it (a pair is tested by undoing its merges, latest
first), which yields the merges' own segmentation.

Pieces are taken to hold a space mark only at their start, or to be runs of
space marks; runs of spaces are segmented apart.  Defined cases: a null text
has null ids, an empty one no ids; characters without a piece become byte
pieces, else the unknown piece; texts of any length are encoded whole;
repeated rows are encoded alike; an empty table gives no rows; columns of the
input pass through unless named as results (``ids``, ``n_tokens`` and that of
the check), which replace them.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bound_batches, give_back

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MARK = "▁"
_LATE = 1 << 40
_CACHE_MOST = 100_000
_BYTES_AT_ONCE = 1 << 20
_CELLS_AT_ONCE = 1 << 18
_IDS_AT_ONCE = 1 << 18
#: Spreads hashes (those of single characters are small) over all values; odd, so different ones stay different.
_SPREAD = np.uint64(0xD1B54A32D192ED03)
#: Words of more characters are cut where no piece can span.
_LONG = 48
_GATE_BITS = 18
_GATE_SHIFT = np.uint64(64 - _GATE_BITS)


@dataclass
class Model:
    """A piece table as arrays; its size is that of the vocabulary."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray  # as in the file: 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte
    bpe: bool
    byte_fallback: bool
    dummy_prefix: bool
    keys: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        normal = np.flatnonzero(np.isin(self.kinds, (1, 4)))
        texts = [self.pieces[i] for i in normal]
        chars = sorted({c for t in texts for c in t} - {t for t in texts if len(t) == 1})
        # Tokens: the pieces, then characters that occur in pieces only, then one for any other character.
        self.uid = uuid.uuid4().hex
        self.n = len(self.pieces)
        self.texts = self.pieces + chars + ["\0other"]
        self.other = len(self.texts) - 1
        ids = np.concatenate([normal, np.arange(self.n, self.other)]).astype(np.int64)
        self.most = max((len(t) for t in texts), default=1)
        h = np.array([_hash(self.texts[i]) for i in ids], np.uint64)
        order = np.argsort(h * _SPREAD, kind="stable")
        self.keys, self.key_ids = (h * _SPREAD)[order], ids[order]
        filled = np.bincount((self.keys >> _GATE_SHIFT).astype(np.int64), minlength=1 << _GATE_BITS)
        self.gate, self.deepest = filled > 0, int(filled.max())
        self.first_key = np.minimum(np.cumsum(filled) - filled, len(self.keys) - 1).astype(np.int32)
        self.keys = np.append(self.keys, self.keys[-1:].repeat(self.deepest))
        self.key_ids = np.append(self.key_ids, self.key_ids[-1:].repeat(self.deepest))
        if len(np.unique(h)) < len(h):
            raise ValueError("two pieces have the same hash")
        self.hashes = np.zeros(len(self.texts), np.uint64)
        self.hashes[ids] = h
        self.hashes[self.other] = np.uint64(0x1234567887654321)
        self.lengths = np.array([len(t) for t in self.texts[:-1]] + [1], np.int64)
        self.powers = np.array([pow(int(_BASE), k, 1 << 64) for k in range(2 * self.most + 2)], np.uint64)
        self.pairs = np.unique(np.array([(ord(a) << 32) | ord(b) for t in texts for a, b in zip(t, t[1:])] or [0], np.uint64))
        self.space = next((int(i) for i in normal if self.pieces[i] == _MARK), -1)
        self.ids_of = {self.pieces[i]: int(i) for i in normal}
        self.bytes_of = {int(self.pieces[i][3:5], 16): int(i) for i in np.flatnonzero(self.kinds == 6)}
        self.unknown = int(np.flatnonzero(self.kinds == 2)[0]) if (self.kinds == 2).any() else 0
        self.rank = np.full(len(self.texts), -1, np.int64)
        self.left = np.arange(len(self.texts))
        self.right = self.left.copy()
        self.proper = np.ones(len(self.texts), bool)
        multi = [int(i) for i in normal if len(self.pieces[i]) > 1 and set(self.pieces[i]) != {_MARK}]
        by_score = sorted(multi, key=lambda i: (-self.scores[i], i))
        self.rank[by_score] = np.arange(len(by_score))
        self.runs = {int(i) for i in normal if set(self.pieces[i]) == {_MARK} and len(self.pieces[i]) > 1}
        self.proper[list(self.runs)] = False
        if self.bpe:
            base = {t: i for i, t in enumerate(self.texts) if len(t) == 1 and (i >= self.n or self.kinds[i] in (1, 4))}
            for i in multi:
                got = self._merge(self.pieces[i], base)
                self.proper[i] = got is not None
                if got:
                    self.left[i], self.right[i] = got

    def _merge(self, text: str, base: dict[str, int]) -> tuple[int, int] | None:
        """The last two tokens that the merges join to ``text``; none if they end elsewhere."""
        row = [base[c] for c in text]
        while True:
            found = [(self.rank[j], k, j) for k in range(len(row) - 1) if (j := self.ids_of.get(self.texts[row[k]] + self.texts[row[k + 1]], -1)) >= 0 and self.rank[j] >= 0]
            if not found:
                return None
            _, k, j = min(found)
            if len(row) == 2:
                return row[0], row[1]
            row[k : k + 2] = [j]

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Token of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        at, tokens = self.probe(h)
        out[at] = tokens
        return out

    def probe(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the hashes of pieces are in ``h``, and their tokens.

        A table of the keys' upper bits turns most other hashes away and says
        where among the sorted keys the search for the rest begins.
        """
        h = h * _SPREAD
        maybe = np.flatnonzero(self.gate[h >> _GATE_SHIFT])
        h = h[maybe]
        at = self.first_key[h >> _GATE_SHIFT]
        for _ in range(self.deepest - 1):
            at = at + (self.keys[at] < h)
        hit = self.keys[at] == h
        return maybe[hit], self.key_ids[at[hit]]

    def stands(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merges leave tokens ``a`` and ``b`` side by side."""
        out = np.ones(len(a), bool)
        limit = np.full(len(a), _LATE, np.int64)
        rows = np.arange(len(a))
        while len(rows):
            joint = self.lookup(self.hashes[a] * self.powers[self.lengths[b]] + self.hashes[b])
            rank = np.where(joint >= 0, self.rank[joint], -1)
            rank = np.where(rank >= 0, rank, 2 * _LATE)
            bad = rank < limit
            out[rows[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            rows, a, b, ra, rb = rows[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def cut(self, word: str) -> list[str]:
        """The word in parts that no piece can span: no piece has two characters that follow on each other at a cut."""
        code = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        pair = (code[:-1] << np.uint64(32)) | code[1:]
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        cuts = (np.flatnonzero(self.pairs[at] != pair) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def segment(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each of the words, which have one length."""
        ids, counts = self.segments(words)
        return np.split(ids, np.cumsum(counts)[:-1])

    def segments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length, all at once: one behind the other, and each word's number of ids."""
        n, size = len(words), len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, size).astype(np.uint64)
        # One row for each prefix, one column for each word, so that all steps run along rows.
        code = np.ascontiguousarray(code.T)
        h = np.zeros((size + 1, n), np.uint64)
        for k in range(size):
            h[k + 1] = h[k] * _BASE + code[k] + np.uint64(1)
        back = np.zeros((size + 1, n), np.int64)
        last = np.full((size + 1, n), -1, np.int64)
        best = np.zeros((size + 1, n))
        low = float(self.scores.min(initial=0)) - 10
        every = np.arange(n)
        for end in range(1, size + 1):
            most = min(end, self.most)
            keys = h[end] - h[end - most : end][::-1] * self.powers[1 : most + 1, None]
            at, token = self.probe(keys.ravel())
            c, r = np.divmod(at, n)
            found = np.empty((most, n), np.int64)
            found[0] = self.other
            found[c, r] = token
            lone = np.ones(n, bool)
            lone[r[c == 0]] = False
            lone = np.flatnonzero(lone)
            r, c = np.concatenate([r, lone]), np.concatenate([c, np.zeros(len(lone), np.int64)])
            token = np.concatenate([token, np.full(len(lone), self.other)])
            if self.bpe:
                good = self.proper[token]
                r, c, token = r[good], c[good], token[good]
                before = last[end - 1 - c, r]
                inner = before >= 0
                good = np.ones(len(r), bool)
                good[inner] = self.stands(before[inner], token[inner])
                value = np.full((most, n), -1, np.int16)
                value[c[good], r[good]] = c[good]
            else:
                score = np.where(token < self.n, self.scores[np.minimum(token, self.n - 1)], low)
                value = np.full((most, n), -np.inf)
                value[c, r] = best[end - 1 - c, r] + score
            pick = value.argmax(0)
            back[end], last[end] = pick + 1, found[pick, every]
            if not self.bpe:
                best[end] = value[pick, every]
        end, tokens, begins = np.full(n, size), [], []
        while end.any():  # follow the back pointers of all words together
            tokens.append(np.where(end > 0, last[end, every], -1))
            end = end - back[end, every]
            begins.append(end)
        token = np.array(tokens[::-1]).T
        used = token >= 0
        counts, ids = used.sum(1), token[used]
        odd = np.flatnonzero(ids >= self.n)
        if not len(odd):
            return ids.astype(np.int32), counts
        word = np.repeat(every, counts)
        chars, which = np.unique(code[np.array(begins[::-1]).T[used][odd], word[odd]], return_inverse=True)
        spelled = [self._spelled(chr(int(x))) for x in chars]
        sizes = np.ones(len(ids), np.int64)
        sizes[odd] = np.array([len(x) for x in spelled])[which]
        out = np.repeat(ids, sizes)
        out[np.repeat(np.isin(np.arange(len(ids)), odd), sizes)] = np.concatenate([spelled[k] for k in which])
        return out.astype(np.int32), np.bincount(word, weights=sizes, minlength=n).astype(np.int64)

    def _spelled(self, char: str) -> np.ndarray:
        """Ids of a character without a piece."""
        known = self.byte_fallback and self.bytes_of
        return np.array([self.bytes_of[x] for x in char.encode("utf-8", "replace")] if known else [self.unknown], np.int64)

    def space_run(self, count: int) -> list[int]:
        """Ids of a run of space marks: the best-scored, then leftmost merges, one by one."""
        size, prev, nxt = [1] * count, list(range(-1, count - 1)), [*range(1, count), -1]
        heap: list[tuple[float, int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and (m := nxt[k]) >= 0 and (j := self.ids_of.get(_MARK * (size[k] + size[m]), -1)) >= 0:
                heapq.heappush(heap, (-float(self.scores[j]), k, size[k], size[m]))

        for k in range(count):
            offer(k)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            if size[k] != a or nxt[k] < 0 or size[nxt[k]] != b:
                continue
            m = nxt[k]
            size[k], size[m], nxt[k] = a + b, 0, nxt[m]
            if nxt[k] >= 0:
                prev[nxt[k]] = k
            offer(k)
            offer(prev[k])
        return [self.ids_of[_MARK * s] for s in size if s]


def _hash(text: str) -> np.uint64:
    h = 0
    for c in text:
        h = (h * int(_BASE) + ord(c) + 1) & ((1 << 64) - 1)
    return np.uint64(h)


def load(path: str) -> Model:
    """Read a model file on the driver; tasks get the arrays (as large as the vocabulary)."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or m.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normalisation and leading space marks are supported")
    if any(_MARK in p.piece[1:] and set(p.piece) != {_MARK} for p in m.pieces):
        raise ValueError("a piece holds a space mark behind other characters")
    return Model([p.piece for p in m.pieces], np.array([p.score for p in m.pieces]), np.array([p.type for p in m.pieces]), m.trainer_spec.model_type == 2, m.trainer_spec.byte_fallback, n.add_dummy_prefix)


class Codec:
    def __init__(self, model: Model) -> None:
        self.m = model
        # Known words, by number; the ids of word k are the counts[k] ones from starts[k] on.
        self.cache: dict[str, int] = {}
        self.known, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        texts = [bytes([int(p[3:5], 16)]) if k == 6 else b"" if k == 3 else b" \xe2\x81\x87 " if k == 2 else p.replace(_MARK, " ").encode() for p, k in zip(model.pieces, model.kinds)]
        self.table = pa.array(texts, pa.large_binary())
        self.sizes = np.array([len(t) for t in texts], np.int64)

    def _keep(self, words: list[str]) -> None:
        """Forget all words but these."""
        words = [w for w in words if w in self.cache]
        number = np.array([self.cache[w] for w in words], np.int64)
        self.known, self.counts = _gather(self.known, self.starts[number], self.counts[number]), self.counts[number]
        self.starts = np.cumsum(self.counts) - self.counts
        self.cache = {w: k for k, w in enumerate(words)}

    def _fill(self, words: list[str]) -> None:
        """Segment the words that are not known yet, those of equal length together."""
        new = [w for w in words if w not in self.cache]
        if not new:
            return
        if len(self.cache) + len(new) > _CACHE_MOST:
            self._keep(words)
        feed = self.m.segment(["\n"])[0]
        ids, counts = [self.known], [self.counts]
        # A word after a line feed has no space mark.
        for fed, mark in ((False, _MARK), (True, "")):
            part = [w for w in new if (w[:1] == "\n") == fed]
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            order = np.argsort(sizes, kind="stable")
            part, sizes = [part[k] for k in order.tolist()], sizes[order]
            at, usual = 0, int(np.searchsorted(sizes, _LONG, side="right"))
            while at < usual:
                cells = max(1, int(sizes[at])) * self.m.most
                end = min(int(np.searchsorted(sizes, sizes[at], side="right")), at + max(1, _CELLS_AT_ONCE // cells))
                bodies = [mark + w[fed:] for w in part[at:end]]
                got, n = self.m.segments(bodies) if bodies[0] else (np.empty(0, np.int32), np.zeros(len(bodies), np.int64))
                if fed:
                    got = np.insert(got, np.repeat(np.cumsum(n) - n, len(feed)), np.tile(feed, len(n)))
                    n = n + len(feed)
                ids.append(got)
                counts.append(n)
                at = end
            for got in self._long([mark + w[fed:] for w in part[usual:]]):
                got = np.concatenate([feed, got]) if fed else got
                ids.append(got)
                counts.append(np.array([len(got)], np.int64))
            self.cache.update(zip(part, range(len(self.cache), len(self.cache) + len(part))))
        self.known, self.counts = np.concatenate(ids), np.concatenate(counts)
        self.starts = np.cumsum(self.counts) - self.counts

    def _long(self, words: list[str]) -> Iterator[np.ndarray]:
        """Ids of long words: the parts of all of them that have one length advance together."""
        cut = [self.m.cut(w) for w in words]
        parts = sorted({p for c in cut for p in c}, key=len)
        found: dict[str, np.ndarray] = {}
        at = 0
        while at < len(parts):
            size = len(parts[at])
            end = at
            while end < len(parts) and len(parts[end]) == size and (end - at) * size * self.m.most <= _CELLS_AT_ONCE:
                end += 1
            found.update(zip(parts[at:end], self.m.segment(parts[at:end])))
            at = end
        for c in cut:
            yield np.concatenate([found[p] for p in c]).astype(np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the offsets of each text (null as empty)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.m.dummy_prefix:
            raise ValueError("models without the leading space mark are not supported")
        # Every line feed, which no piece holds beside other characters, starts a word of its own.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat = split.values.slice(split.offsets[0].as_py(), split.offsets[-1].as_py() - split.offsets[0].as_py())
        counts = np.where(pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), 0, np.diff(split.offsets.to_numpy()))
        if (counts == 0).any():
            flat = flat.filter(pa.array(np.repeat(counts > 0, np.diff(split.offsets.to_numpy()))))
        coded = flat.dictionary_encode() if len(flat) else None
        if coded is None:
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        words = coded.dictionary.to_pylist()
        self._fill(words)
        code = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))[coded.indices.to_numpy()]
        each = self.counts[code]
        ends = np.cumsum(each)
        out = _gather(self.known, self.starts[code], each)
        offsets = np.concatenate(([0], np.concatenate(([0], ends))[np.cumsum(counts)]))
        return self._join_spaces(out, offsets)

    def _join_spaces(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of lone space marks within a text, merged as the model merges them."""
        lone = ids == self.m.space
        both = lone[1:] & lone[:-1]
        starts = np.zeros(len(ids) + 1, bool)
        starts[offsets[:-1]] = True
        both &= ~starts[1:-1]
        if not both.any() or not self.m.runs:
            return ids, offsets
        edge = np.diff(np.concatenate(([0], both.astype(np.int8), [0])))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        parts, lost, at = [], [0], 0
        memo: dict[int, list[int]] = {}
        for a, b in zip(begin.tolist(), end.tolist()):
            run = memo.setdefault(b - a, []) or memo.__setitem__(b - a, self.m.space_run(b - a)) or memo[b - a]
            parts += [ids[at:a], np.array(run, np.int32)]
            lost.append((b - a) - len(run))
            at = b
        parts.append(ids[at:])
        return np.concatenate(parts), offsets - np.cumsum(lost)[np.searchsorted(end, offsets, side="right")]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))[offsets]
        data = self.table.take(pa.array(ids)).buffers()[2].to_pybytes() if len(ids) else b""
        out = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return [t[1:] if t.startswith(" ") else t for t in out]


def _gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The ``counts`` values from each of ``starts`` on, one behind the other; indices are made for a bounded number at once."""
    ends = np.cumsum(counts)
    out, shift = np.empty(int(ends[-1]) if len(ends) else 0, values.dtype), starts - ends + counts
    at, done = 0, 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, done + _IDS_AT_ONCE, side="right")))
        high = int(ends[stop - 1])
        out[done:high] = values[np.arange(done, high) + np.repeat(shift[at:stop], counts[at:stop])]
        at, done = stop, high
    return out


_CODECS: dict[str, Codec] = {}


def _codec(model: Model) -> Codec:
    """The worker's codec for a model, so that known words outlive a task; one model at a time."""
    if model.uid not in _CODECS:
        _CODECS.clear()
        _CODECS[model.uid] = Codec(model)
    return _CODECS[model.uid]


def _pieces_of(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded bytes of text (one text at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for k, s in enumerate(sizes.tolist()):
        if held + s > _BYTES_AT_ONCE and k > start:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += s
    yield batch.slice(start)


def encode(docs: DataFrame, model: Model, text: str = "text", ids: str = "ids", check: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``; ``check`` names a column for whether decoding gives the text back.

    Without ``keep_text`` the texts are not handed back.  A session's limit of bytes in an Arrow batch is lowered to
    that of a slice, so that no task holds more text than a few slices (one text at least), in Python or in the JVM.
    """
    docs = docs.drop("n_tokens", ids, *([check] if check else []))
    bound_batches(docs.sparkSession, _BYTES_AT_ONCE)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as large as the vocabulary
    at = docs.columns.index(text)
    held = [k for k in range(len(docs.columns)) if keep_text or k != at]
    names = [*(docs.columns[k] for k in held), "n_tokens", ids, *([check] if check else [])]
    schema = T.StructType([*(docs.schema.fields[k] for k in held), T.StructField("n_tokens", T.LongType()), T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(check, T.BooleanType())] if check else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            for b in _pieces_of(batch, at) if batch.num_rows else ():
                column = b.column(at)
                flat, offsets = codec.encode(column)
                null = column.is_null().to_numpy(zero_copy_only=False)
                counts = pa.array(np.diff(offsets), mask=null)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), mask=np.append(null, False)), pa.array(flat.astype(np.int32, copy=False)))
                extra = [counts, lists]
                if check:
                    extra.append(pa.array([None if t is None else t == d for t, d in zip(column.to_pylist(), codec.decode(flat, offsets))], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in held), *extra], names=names)
                del column, flat, offsets, null, counts, lists, extra
                give_back()

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: Model, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with ``text`` made from ``ids`` (null ids give null)."""
    rows = rows.drop(text)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    at, names = rows.columns.index(ids), [*rows.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for b in batches:
            lists = b.column(at)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = codec.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(([0], np.cumsum(counts))))
            null = lists.is_null().to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([None if n else t for n, t in zip(null, texts)], pa.string())], names=names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())]))
