"""Mixing to target weights with soft membership.

A classifier fitted on a labelled table gives each document posteriors over
domains.  Rates r (0 <= r <= most) are fitted to all documents by projected
gradient descent on the squared differences between expected domain token
totals, sum of tokens * posterior * r, and their targets, the wanted shares
of the sum of all totals.  A step moves r by the residuals, solved for with
the Gram matrix of the posteriors of the documents that can still move, and
clips it, so r stays a function of the posteriors: the driver keeps a few
numbers per step and each step is two aggregations over all rows.  The fit
ends when every domain is within ``tolerance`` of its own target; shares
that no rates reach end at the least squares found, and the result says so.

Defined cases: a null or blank text has no tokens and moves no total; its
rate follows its posterior like any other; texts of any length are read
whole; repeated rows get equal rates; an empty table gives no rows and no
steps; columns pass through unless named as results; without labelled rows of
two domains every posterior is the first domain's and every rate is 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

_SYMBOLS = b"#*$%&|<>"
_STYLES = 6


def _style(raw: bytes, words: list[bytes]) -> list[float]:
    n, size = max(1, len(words)), max(1, len(raw))
    upper = size - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return [
        math.log1p(len(words)),
        min(1.0, (len(raw) - len(raw.translate(None, _SYMBOLS))) / n),
        min(1.0, (raw.count(b"!") + raw.count(b"?")) / n),
        upper / size,
        len(set(words)) / n,
        min(1.0, raw.count(b"\n") / n),
    ]


@dataclass
class Classifier:
    domains: list[str]
    lexicon: dict[bytes, int]  # word: the domain it speaks for (bounded by `words` of fit)
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def features(self, text: str | None) -> tuple[int, list[float]]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        counts = [0.0] * len(self.domains)
        for w in self.lexicon.keys() & {w.strip(b".,;:!?\"'()").lower() for w in set(words)}:
            counts[self.lexicon[w]] += 1
        return len(words), _style(raw, words) + [math.log1p(c) for c in counts]

    def posteriors(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[np.ones(len(x)), (x - self.mean) / self.scale] @ self.weights
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = 8_000, words: int = 1_000) -> Classifier:
    """Softmax regression from about ``sample`` labelled documents (the documented bound).

    ``labelled``: doc_id, domain.  Besides the style of a text its features
    are how many words it holds that, in the sample, occur in at least a
    twelfth of one domain's documents and there eight times as often as in
    the rest; ``words`` bounds that lexicon.
    """
    k = len(domains)
    empty = Classifier(domains, {}, np.zeros(_STYLES + k), np.ones(_STYLES + k), np.zeros((1 + _STYLES + k, k)))
    empty.weights[0, 0] = 50.0
    chosen = common.bounded_labels(labelled.where(F.col("domain").isin(domains)), sample, "domain")
    joined = common.materialise(docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id"), "labelled")
    sizes = {r["domain"]: r["count"] for r in joined.groupBy("domain").count().collect()}
    if len(sizes) < 2:
        return empty
    found = joined.select("domain", F.explode(F.array_distinct(F.transform(common.words_of(F.lower(common.whole_text())), lambda w: F.btrim(w, F.lit(".,;:!?\"'()"))))).alias("word"))
    per = found.groupBy("word").agg(*(F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(domains)))
    total = sum(sizes.values())
    scores = []
    for i, d in enumerate(domains):
        n, rest = sizes.get(d, 0), total - sizes.get(d, 0)
        others = sum((F.col(f"n{j}") for j in range(k) if j != i), F.lit(0))
        share, other = F.col(f"n{i}") / F.lit(max(1, n)), (others + 0.5) / F.lit(rest + 1.0)
        scores.append(F.when((share >= 1 / 12) & (F.col(f"n{i}") >= 5) & (share >= 8 * other), share / other).otherwise(0.0))
    top = per.select("word", F.array(*scores).alias("s")).select("word", F.array_max("s").alias("best"), F.expr("array_position(s, array_max(s)) - 1").alias("i"))
    top = top.where("best > 0 AND word <> ''").orderBy(F.desc("best"), "word").limit(words)
    lexicon = {r["word"].encode(): int(r["i"]) for r in top.collect()}
    model = Classifier(domains, lexicon, np.zeros(_STYLES + k), np.ones(_STYLES + k), empty.weights)
    rows = sorted(_featured(joined, model).drop("text").collect(), key=lambda r: (r["doc_id"], r["_x"]))
    x = np.array([r["_x"] for r in rows])
    y = np.eye(k)[[domains.index(r["domain"]) for r in rows]]
    model.mean, model.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.c_[np.ones(len(x)), (x - model.mean) / model.scale]
    w, speed = np.zeros((z.shape[1], k)), np.zeros((z.shape[1], k))
    for _ in range(800):
        p = np.exp((a := z @ w) - a.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 0.1 * (z.T @ (p - y) / len(z) + 1e-4 * w)
        w = w + speed
    model.weights = w
    return model


def _featured(docs: DataFrame, model: Classifier) -> DataFrame:
    at = docs.columns.index("text")
    names = [*docs.columns, "_x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [model.features(t.as_py())[1] for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(x, pa.list_(pa.float64()))], names=names)

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_x", T.ArrayType(T.DoubleType()))]))


def score(docs: DataFrame, model: Classifier, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``tokens`` (words) and ``posterior``."""
    docs = docs.drop("tokens", "posterior")
    at = docs.columns.index(text)
    held = [k for k in range(len(docs.columns)) if keep_text or k != at]
    names = [*(docs.columns[k] for k in held), "tokens", "posterior"]
    schema = T.StructType([*(docs.schema.fields[k] for k in held), T.StructField("tokens", T.LongType()), T.StructField("posterior", T.ArrayType(T.DoubleType()))])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by `words` of fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            got = [m.features(t.as_py()) for t in b.column(at)]
            p = m.posteriors(np.array([x for _, x in got]))
            extra = [pa.array([n for n, _ in got], pa.int64()), pa.array(p.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in held), *extra], names=names)

    return docs.mapInArrow(run, schema)


def _rate(steps: list[list[float]], most: float) -> Column:
    """The rate after the given steps, as a function of the posteriors (one expression, whatever the steps)."""
    if not steps:
        return F.lit(1.0)
    move = " + ".join(f"get(g, {d}) * get(posterior, {d})" for d in range(len(steps[0])))
    table = ", ".join("array(" + ", ".join(f"{x!r}D" for x in g) + ")" for g in steps)
    return F.expr(f"aggregate(array({table}), 1.0D, (r, g) -> greatest(0.0D, least({float(most)!r}D, r - ({move}))))")


@dataclass
class Rates:
    steps: list[list[float]]
    wanted: list[float]  # shares of the token total
    reached: list[float]
    fits: bool  # whether every domain is within the tolerance of its share
    anchor: float = 1.0  # all rates are multiplied by it, which changes no share


def fit_rates(scored: DataFrame, weights: list[float], most: float = 1.0, rounds: int = 40, tolerance: float = 5e-3, anchor_most: float = 2.0) -> Rates:
    """Rates for ``weights`` (token shares wanted, more than zero; they are normalised).

    Shares leave the scale of the rates open: it is set so that documents that are likeliest of the first domain
    have a rate of 1 at least, as far as ``anchor_most`` allows.
    """
    k = len(weights)
    wanted = np.array(weights, float) / sum(weights)
    posterior = [F.get("posterior", F.lit(d)) for d in range(k)]

    def totals(steps: list[list[float]]) -> np.ndarray:
        r = _rate(steps, most)
        row = scored.agg(*(F.sum(F.col("tokens") * r * p) for p in posterior)).first()
        return np.array([float(x or 0.0) for x in row])

    def gram(steps: list[list[float]], way: np.ndarray) -> np.ndarray:
        """Sums of tokens * posterior * posterior over documents that a step along ``way`` moves."""
        r = _rate(steps, most)
        move = sum((F.lit(float(w)) * p for w, p in zip(way, posterior)), F.lit(0.0))
        free = ((r > 0) & (move > 0)) | ((r < most) & (move < 0))
        pairs = [(d, e) for d in range(k) for e in range(d, k)]
        row = scored.where(free).agg(*(F.sum(F.col("tokens") * posterior[d] * posterior[e]) for d, e in pairs)).first()
        out = np.zeros((k, k))
        for (d, e), x in zip(pairs, row):
            out[d, e] = out[e, d] = float(x or 0.0)
        return out

    def error(now: np.ndarray) -> np.ndarray:
        return now / max(now.sum(), 1e-9) / wanted - 1.0

    steps: list[list[float]] = []
    now = totals(steps)
    size = 1.0
    for _ in range(rounds):
        if not now.sum() or np.abs(error(now)).max() <= tolerance:
            break
        gap = now - wanted * now.sum()
        scale = 1.0 / (wanted * now.sum())
        # The slope of the relative squared error for a document of each domain: what it adds to its own gap, and to the sum.
        slope = gap * scale**2
        way = slope - (wanted * slope).sum()
        m = gram(steps, way)
        change = (m - np.outer(wanted, m.sum(0))) * scale[:, None]
        move = np.linalg.lstsq(np.vstack([change, 1e-4 * np.eye(k) * max(np.abs(change).max(), 1e-12)]), np.append(gap * scale, np.zeros(k)), rcond=None)[0]
        while True:
            tried = [*steps, [float(f"{size * x:.10g}") for x in move]]
            after = totals(tried)
            if (error(after) ** 2).sum() < (error(now) ** 2).sum() or size < 1e-2:
                break
            size /= 2
        if (error(after) ** 2).sum() >= (error(now) ** 2).sum():
            break
        steps, now, size = tried, after, min(1.0, 2 * size)
    reached = now / max(now.sum(), 1e-9)
    least = scored.where(F.get("posterior", F.lit(0)) >= F.array_max("posterior")).agg(F.min(_rate(steps, most))).first()[0]
    anchor = min(anchor_most, max(1.0, 1.0 / least)) if least else 1.0
    return Rates(steps, wanted.tolist(), reached.tolist(), bool(now.sum()) and bool(np.abs(error(now)).max() <= tolerance), float(f"{anchor:.10g}"))


def with_rates(scored: DataFrame, rates: Rates, most: float = 1.0, seed: int = 7, key: str = "doc_id") -> DataFrame:
    """``scored`` with ``rate`` and ``copies``: its whole part and, by a hash of the id, its rest."""
    u = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    df = scored.withColumn("rate", F.round(_rate(rates.steps, most) * F.lit(rates.anchor), 9))
    return df.withColumn("copies", (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("long")).cast("long"))
