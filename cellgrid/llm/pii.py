"""Personal data by candidate gradient boosting (native).

Base spans are fixed patterns with checks.  Besides, high-recall generators
propose overlapping spans; each has features of its format and of the words
before it; boosted trees score them, Platt scaling turns scores into
probabilities, and candidates that no base span meets are added from a
probability of ``least`` on.  The trees are emitted as one SQL expression.

The trees learn from labelled examples that ``examples`` writes by rule:
personal data in forms that the base patterns leave out (local phone numbers,
spelled-out addresses, cards with other separators, numbered identities) and
look-alikes (dates, times, ranges, versions, prices, order numbers), with
and without words that announce them.  No label comes from a base pattern or
from the corpus, so what is found does not depend on how large or how usual
the corpus is.  Half of the examples fit the trees, the other half fits the
calibration and gives precision and recall.

Defined cases: a null text is empty (no spans); empty tables give no rows;
texts and matches of any length are searched whole; repeated rows are
handled alike; columns of ``docs`` pass through unless named as the results
(or beginning with ``_pii``).
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting, common, spans

KINDS = ("email", "ip", "card", "phone")
#: The base patterns (fixed values), with possessive repeats, and starts limited to the first place of a run, where a
#: later start can't match if the first one doesn't; \G lets a match follow on the last one.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
CHECKS = {
    "email": "true",
    "ip": f"x.hit rlike {spans.quoted(f'^{_PART}(?:[.]{_PART}){{3}}$')}",
    "card": f"length({spans.digits('x.hit')}) BETWEEN 13 AND 19 AND {spans.luhn('x.hit')}",
    "phone": f"length({spans.digits('x.hit')}) BETWEEN 9 AND 15",
}
_SEP = r"[\x20().:/_-]{0,3}"
GENERATORS = {
    "number": rf"(?<![0-9A-Za-z])[+(]?[0-9](?:{_SEP}[0-9]){{5,}}+(?![0-9A-Za-z])",
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[(\[](?:at|AT)[)\]])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++",
}
#: Words that announce personal data, and words that announce other numbers (fixed values).
CUES = "phone|tel|call|mobile|fax|contact|mail|reach|card|visa|ssn|passport|whatsapp"
OTHER_CUES = "order|invoice|isbn|issn|version|page|year|date|price|total|serial|ticket|score|step|since|until|born|part"
_DIGITS = spans.digits("x.hit")
FEATURES = {
    "n_digits": f"least(length({_DIGITS}), 30)",
    "n_groups": "least(size(filter(split(x.hit, '[^0-9]+'), g -> g <> '')), 16)",
    "longest": "least(array_max(transform(split(x.hit, '[^0-9]+'), g -> length(g))), 20)",
    "last": "least(length(regexp_extract(x.hit, '([0-9]*)$', 1)), 20)",
    "n_dots": "least(length(x.hit) - length(replace(x.hit, '.', '')), 8)",
    "n_dashes": "least(length(x.hit) - length(replace(x.hit, '-', '')), 8)",
    "n_spaces": "least(length(x.hit) - length(replace(x.hit, ' ', '')), 8)",
    "area": "cast(x.hit rlike '^[+]?[0-9]*[ ]?[(][0-9]{2,5}[)]' AS int)",
    "at": "CASE WHEN x.hit rlike '[(\\\\[](at|AT)[)\\\\]]' THEN 2 WHEN x.hit LIKE '%@%' THEN 1 ELSE 0 END",
    "other": "cast(x.hit rlike '[:/_]' AS int)",
    "luhn": f"CASE WHEN length({_DIGITS}) BETWEEN 13 AND 19 AND {spans.luhn('x.hit')} THEN 1 ELSE 0 END",
    "cue": f"cast(lower(x.before) rlike '\\\\b(?:{CUES})\\\\b' AS int)",
    "other_cue": f"cast(lower(x.before) rlike '\\\\b(?:{OTHER_CUES})\\\\b' AS int)",
}


def _gates(text: str) -> dict[str, Column]:
    t = F.col(text)
    return {
        "email": t.contains("@"),
        "ip": t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        "card": t.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": t.rlike(r"\+[0-9]"),
        "number": t.rlike(rf"[0-9](?:{_SEP}[0-9]){{5}}"),
        "mail": t.contains("@") | t.rlike(r"[(\[](?:at|AT)[)\]]"),
    }


def _with_candidates(docs: DataFrame, text: str) -> DataFrame:
    """``_pii_text``, the base spans ``_pii_base`` and the candidates ``_pii_cand`` that none of them meets, with their features."""
    df = docs.withColumn("_pii_text", common.whole_text(text))
    gates = _gates("_pii_text")
    for kind in KINDS:
        df = spans.add_matches(df, "_pii_text", f"_pii_{kind}", PATTERNS[kind], gates[kind])
    df = df.withColumns({f"_pii_{k}": spans.kept(f"_pii_{k}", CHECKS[k]) for k in KINDS})
    for kind in GENERATORS:
        df = spans.add_matches(df, "_pii_text", f"_pii_{kind}", GENERATORS[kind], gates[kind])
    base = ", ".join(spans.placed(f"_pii_{k}", k, n) for n, k in enumerate(KINDS))
    df = df.withColumn("_pii_base", F.expr(f"if(monotonically_increasing_id() >= 0, concat({base}), NULL)"))
    df = df.withColumn("_pii_blocks", F.expr(f"if(monotonically_increasing_id() >= 0, {spans.blocked('_pii_base')}, NULL)"))
    values = ", ".join(f"'{k}', cast({v} AS double)" for k, v in FEATURES.items())
    free = f"filter(concat(_pii_number, _pii_mail), x -> NOT {spans.meets('_pii_blocks', 'x')})"
    return df.withColumn("_pii_cand", F.expr(f"transform({free}, x -> named_struct('start', x.start, 'end', x.end, {values}))")).drop("_pii_blocks")


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _luhn_number(rng: np.random.Generator, n: int = 16) -> str:
    raw = str(rng.integers(3, 7)) + _digits(rng, n - 2)
    total = sum(sum(divmod(int(c) * (2 if k % 2 == 0 else 1), 10)) for k, c in enumerate(reversed(raw)))
    return raw + str(-total % 10)


def examples(n: int = 3_000, seed: int = 5) -> list[tuple[str, int]]:
    """Labelled snippets: half of them hold one piece of personal data, half of them a look-alike."""
    rng = np.random.default_rng(seed)
    pick = lambda *options: options[rng.integers(len(options))]
    words = ["alder", "moss", "river", "stone", "field", "harbour", "lamp", "wool", "cedar", "north"]

    def phone() -> str:
        a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
        return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{a}/{b}{c}", f"0{a} {b} {c[:2]} {c[2:]}", f"({a}){b}-{c}", f"00{a[:2]} {b} {c}{a}")

    def mail() -> str:
        at, dot = pick(" (at) ", " [at] ", "(at)", "[AT]"), pick(" (dot) ", " [dot] ", ".", "(dot)")
        return f"{pick(*words)}{pick('.', '_', '')}{pick(*words)}{at}{pick(*words)}{dot}{pick('com', 'org', 'net', 'example')}"

    def card() -> str:
        raw = _luhn_number(rng)
        sep = pick(".", "/", "_", " - ", "  ")
        return sep.join(raw[k : k + 4] for k in range(0, 16, 4))

    def identity() -> str:
        return f"{_digits(rng, 3)}-{_digits(rng, 2)}-{_digits(rng, 4)}"

    def other() -> str:
        year, month, day = 1900 + int(rng.integers(0, 130)), int(rng.integers(1, 13)), int(rng.integers(1, 29))
        return pick(
            f"{year}-{month:02d}-{day:02d}", f"{day:02d}/{month:02d}/{year}", f"{day:02d}.{month:02d}.{year}", f"{year}/{month:02d}/{day:02d} {day:02d}:{month:02d}:{_digits(rng, 2)}", f"{year}-{year + 5}", f"{day}:{month:02d}:{_digits(rng, 2)}.{_digits(rng, 3)}",
            f"978-{day % 10}-{_digits(rng, 2)}-{_digits(rng, 6)}-{day % 9}", f"{day} {_digits(rng, 3)} {_digits(rng, 3)}", _digits(rng, int(rng.integers(6, 25))), f"{day}.{month}.{_digits(rng, 4)}", f"{_digits(rng, 2)}.{_digits(rng, 5)}", f"{_digits(rng, 4)}-{_digits(rng, 6)}",
            " ".join(_digits(rng, int(rng.integers(1, 5))) for _ in range(int(rng.integers(3, 12)))), f"{_digits(rng, 3)}_{_digits(rng, 3)}", f"{_digits(rng, 4)} {_digits(rng, 4)} {_digits(rng, 4)} {_digits(rng, 4)}", f"{pick(*words)}@{pick(*words)}{pick('', ' 4.2.')}", f"({year}) {_digits(rng, 3)}-{_digits(rng, 3)}",
        )

    out = []
    for k in range(n):
        if k % 2:
            kind = pick(phone, phone, mail, card, identity)
            cue = {phone: ["phone: ", "call ", "tel. ", "mobile ", "fax ", "reach me at "], mail: ["mail ", "contact "], card: ["card ", "visa "], identity: ["ssn ", "passport "]}[kind]
            # A bare run of grouped digits says little; it counts where a word announces it, or its form is telling.
            value = kind()
            bare = kind is identity or (kind is phone and "(" not in value)
            out.append((f"{pick(*words)} {pick(*words)} {pick(*cue) if bare or rng.random() < 0.5 else ''}{value} {pick(*words)}", 1))
        else:
            cue = pick("", "", "", "order ", "invoice no. ", "version ", "page ", "since ", "price ", "serial ", "date ", "score ", "call ", "mail ", "card ")
            out.append((f"{pick(*words)} {pick(*words)} {cue}{other()} {pick(*words)}", 0))
    return out


@dataclass
class Model:
    trees: tuple
    scale: float  # probability = 1 / (1 + exp(-(scale * score + shift)))
    shift: float
    least: float
    precision: float  # on the examples that fitted nothing but the calibration
    recall: float

    @property
    def limit(self) -> float:
        return (math.log(self.least / (1 - self.least)) - self.shift) / self.scale


def fit(spark: SparkSession, least: float = 0.9, n: int = 3_000, seed: int = 5) -> Model:
    """Trees and calibration from ``n`` written examples, which are all that comes to the driver."""
    written = examples(n, seed)
    rows = json.dumps([{"doc_id": k, "text": t} for k, (t, _) in enumerate(written)])
    df = spark.sql("SELECT inline(from_json(:rows, 'array<struct<doc_id:bigint,text:string>>'))", args={"rows": rows})
    names = list(FEATURES)
    rows = _with_candidates(df, "text").select("doc_id", F.explode("_pii_cand").alias("c")).select("doc_id", *(F.col(f"c.{f}").alias(f) for f in names)).collect()
    rows.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in names] for r in rows], float)
    y = np.array([float(written[r["doc_id"]][1]) for r in rows])
    half = np.array([r["doc_id"] // 2 % 2 for r in rows])
    trees = boosting.fit(x[half == 1], y[half == 1], np.ones(int((half == 1).sum())))
    score, y = boosting.predict(trees, x[half == 0]), y[half == 0]
    # Platt scaling by Newton's method, with targets drawn in a little.
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w, z = np.array([1.0, 0.0]), np.c_[score, np.ones(len(score))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w - np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + 1e-6 * np.eye(2), z.T @ (p - t))
    model = Model(trees, float(max(w[0], 1e-3)), float(w[1]), least, 1.0, 0.0)
    said = score >= model.limit
    model.precision, model.recall = float(y[said].mean()) if said.any() else 1.0, float(said[y == 1].mean())
    return model


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``n_email`` ... ``n_phone``, ``base_spans`` and ``pii_spans`` (arrays of start, rank, end, kind)."""
    results = [f"n_{k}" for k in KINDS] + ["base_spans", "pii_spans"]
    df = _with_candidates(docs.drop(*results), text)
    score = boosting.sql(model.trees, [f"x.{f}" for f in FEATURES])
    rank = "CASE WHEN x.at > 0 THEN 0 WHEN x.n_digits >= 13 AND x.luhn = 1 THEN 2 ELSE 3 END"
    kinds = f"array({', '.join(map(repr, KINDS))})"
    added = f"transform(filter(_pii_cand, x -> ({score}) >= {model.limit!r}D), x -> named_struct('start', x.start, 'rank', {rank}, 'end', x.end, 'kind', get({kinds}, {rank})))"
    df = df.withColumns({f"n_{k}": F.size(f"_pii_{k}").cast("long") for k in KINDS} | {"base_spans": F.col("_pii_base")})
    df = df.withColumn("pii_spans", F.expr(f"if(monotonically_increasing_id() >= 0, concat(_pii_base, {added}), NULL)"))
    return df.drop("_pii_text", "_pii_base", "_pii_cand", *(f"_pii_{k}" for k in (*KINDS, *GENERATORS)))


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    # Spans in order, by blocks; one that starts inside an earlier one extends it.  `upto` is where the text has been
    # copied to; the text of a block is cut out once, as `g`.
    step = (
        "CASE WHEN x.start >= c.upto THEN named_struct('done', concat(c.done, substring(g, cast(c.upto - a.upto + 1 AS int), cast(x.start - c.upto AS int)), "
        "'<', upper(x.kind), '>'), 'upto', x.end) ELSE named_struct('done', c.done, 'upto', greatest(c.upto, x.end)) END"
    )
    cut = f"substring({text}, cast(a.upto + 1 AS int), cast(array_max(transform(p, x -> x.end)) - a.upto AS int))"
    block = f"element_at(transform(array({cut}), g -> aggregate(p, named_struct('done', '', 'upto', a.upto), (c, x) -> {step})), 1)"
    add = f"element_at(transform(array({block}), d -> named_struct('done', concat(a.done, array(d.done)), 'upto', d.upto)), 1)"
    blocks = "transform(sequence(0, (size(o) - 1) div 128), b -> slice(o, cast(b * 128 + 1 AS int), 128))"
    start = "named_struct('done', cast(array() AS array<string>), 'upto', 0)"
    new = f"element_at(transform(array(sort_array(pii_spans)), o -> aggregate({blocks}, {start}, (a, p) -> {add}, a -> concat(array_join(a.done, ''), substring({text}, cast(a.upto + 1 AS int))))), 1)"
    return found.withColumn(text, F.expr(f"CASE WHEN size(pii_spans) = 0 THEN {text} ELSE {new} END"))
