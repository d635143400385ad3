"""Quality rules: text statistics and a learned decision list (native).

Statistics come from built-in functions only.  The list is fitted by
sequential covering on a bounded sample of labelled rows: each rule is a
conjunction of thresholds, grown on two thirds of the rows by information
gain, pruned on the last third, and kept only if it is precise there.  What
is emitted is one ordered ``CASE WHEN`` expression over the statistics.

Defined cases: a null or blank text has no words and all counts are zero (it
fails the base rule); repeated rows are judged separately and alike; extra
columns pass through; with no labelled rows the list is empty and the base
rule alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Symbols that the base statistics count (fixed values).
SYMBOLS = "[#*$%&|<>]"
#: Above so many different repeated windows they are found by sorting, not by look-up.
LOOKUP_MOST = 64
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` and the base statistics, and those that only the rules use.

    A repeated three-word window is found by its 64-bit hash inside one text.
    Columns of ``docs`` with the names of the statistics are replaced.
    """
    body, words, lines, h, s, dup, pos, size = ("_q_" + x for x in "text words lines hashes sorted dup pos size".split())
    df = docs.drop(*BASE, "n_marks", "n_upper")
    df = df.withColumn(body, common.whole_text(text))
    df = df.withColumn(words, common.words_of(F.col(body))).withColumn(
        lines, F.expr(rf"filter(split({body}, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')")
    )
    df = df.withColumn(size, F.size(words)).withColumn(
        h,
        F.expr(
            f"CASE WHEN size({words}) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size({words}) - 3), "
            f"i -> xxhash64(get({words}, i), get({words}, i + 1), get({words}, i + 2))) END"
        ),
    )
    df = df.withColumns(
        {
            "n_words": F.col(size).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.regexp_count(F.col(body), F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_marks": F.regexp_count(F.col(body), F.lit("[!?]")).cast("long"),
            "n_upper": F.regexp_count(F.col(body), F.lit("[A-Z]")).cast("long"),
            s: F.sort_array(h),
        }
    ).drop(words, lines)
    df = df.withColumn(dup, F.expr(f"array_distinct(filter({s}, (x, i) -> i > 0 AND x = get({s}, i - 1)))"))
    # The sorted hashes line up with the sorted (hash, index) pairs, so neighbours tell the repeats.
    by_sort = (
        f"sort_array(transform(filter(transform(sort_array(transform({h}, (x, i) -> struct(x AS h, i AS i))), (e, j) -> "
        f"struct(e.i AS i, (coalesce(get({s}, j - 1) = e.h, false) OR coalesce(get({s}, j + 1) = e.h, false)) AS d)), e -> e.d), e -> e.i))"
    )
    df = df.withColumn(
        pos,
        F.expr(
            f"CASE WHEN size({dup}) = 0 THEN cast(array() AS array<int>) WHEN size({dup}) <= {LOOKUP_MOST} THEN "
            f"filter(sequence(0, size({h}) - 1), i -> array_contains({dup}, get({h}, i))) ELSE {by_sort} END"
        ),
    )
    covered = (
        f"aggregate(transform({pos}, (x, j) -> cast(coalesce(least(3, get({pos}, j + 1) - x), 3) AS bigint)), 0L, (a, b) -> a + b)"
    )
    # An id is never negative.  The test keeps a filter on the result from being moved below this point,
    # where every reference to an array would be replaced by the expression that makes it.
    df = df.withColumn("n_repeat_words", F.expr(f"if(monotonically_increasing_id() >= 0, {covered}, NULL)"))
    return df.drop(body, size, h, s, dup, pos)


def features() -> dict[str, Column]:
    """What the thresholds are set on, as expressions over the statistics."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "words": F.col("n_words").cast("double"),
        "mean_length": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "marks_per_word": F.col("n_marks") / n,
        "upper_share": F.col("n_upper") / chars,
        "repeat_share": F.col("n_repeat_words") / n,
        "dup_lines": F.col("n_dup_lines").cast("double"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def column(self, columns: dict[str, Column]) -> Column:
        x = columns[self.feature]
        return x > F.lit(self.limit) if self.above else x <= F.lit(self.limit)

    def holds(self, row: dict) -> bool:
        return (row[self.feature] > self.limit) == self.above


Rule = tuple[Test, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(t.holds(row) for t in rule)


def _best_test(rows: list[tuple[dict, bool]], names: list[str]) -> tuple[float, Test] | None:
    """The threshold of largest information gain for the rejected class."""
    p0, n0 = sum(y for _, y in rows), sum(not y for _, y in rows)
    if not p0 or not n0:
        return None
    before, best = math.log2(p0 / (p0 + n0)), None
    for name in names:
        ordered = sorted((r[name], y) for r, y in rows)
        p = n = 0
        for k in range(len(ordered) - 1):
            p, n = p + ordered[k][1], n + (not ordered[k][1])
            if ordered[k][0] == ordered[k + 1][0]:
                continue
            limit = (ordered[k][0] + ordered[k + 1][0]) / 2
            for above, a, b in ((False, p, n), (True, p0 - p, n0 - n)):
                if a and (best is None or (gain := a * (math.log2(a / (a + b)) - before)) > best[0]):
                    best = (a * (math.log2(a / (a + b)) - before), Test(name, above, limit))
    return best


def learn(rows: list[tuple[dict, bool]], precision: float = 0.97, least: int = 5, most_rules: int = 12) -> list[Rule]:
    """Ordered rules for rows to reject, by sequential covering.

    ``rows``: statistics and whether the row is labelled bad.  A rule stays
    if, on the pruning third, at least ``precision`` of what it covers is bad.
    """
    names = sorted(rows[0][0]) if rows else []
    grow = [r for i, r in enumerate(rows) if i % 3]
    prune = [r for i, r in enumerate(rows) if i % 3 == 0]
    rules: list[Rule] = []
    while len(rules) < most_rules:
        rule: Rule = ()
        held = grow
        while len(rule) < 4 and any(not y for _, y in held) and (found := _best_test(held, names)) and found[0] > 0:
            rule += (found[1],)
            held = [r for r in held if found[1].holds(r[0])]
        if not rule or sum(y for _, y in held) < least:
            return rules

        def worth(x: Rule) -> tuple[float, int]:
            got = [y for r, y in prune if _covers(x, r)]
            return ((2 * sum(got) - len(got)) / max(1, len(got)), -len(x))

        rule = max((rule[: k + 1] for k in range(len(rule))), key=worth)
        got = [y for r, y in prune if _covers(rule, r)]
        if len(got) < max(1, least // 2) or sum(got) < precision * len(got):
            return rules
        rules.append(rule)
        grow = [r for r in grow if not _covers(rule, r[0])]
        prune = [r for r in prune if not _covers(rule, r[0])]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered expression: true keeps the document."""
    columns, out = features(), None
    for rule in rules:
        test = F.lit(True)
        for t in rule:
            test = test & t.column(columns)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> list[Rule]:
    """Rules from at most about ``sample`` labelled documents (the documented bound)."""
    chosen = common.bounded_labels(labels.where("quality IS NOT NULL"), sample, "quality")
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by `sample`
    stats = with_statistics(joined).where(~base_failed())
    rows = stats.select("doc_id", "quality", *(c.alias(k) for k, c in features().items())).collect()
    rows.sort(key=lambda r: tuple(r))
    return learn([({k: r[k] for k in r.__fields__[2:]}, r["quality"] == 0) for r in rows])


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with the statistics, ``base_failed`` and ``kept``."""
    df = with_statistics(docs.drop("base_failed", "kept"))
    df = df.withColumn("base_failed", base_failed())
    return df.withColumn("kept", ~F.col("base_failed") & verdict(rules))
