"""Positions of regular-expression matches with built-in functions (native).

``split`` gives what lies between the matches and ``regexp_extract_all`` the
matches; positions are running sums of their lengths in code points.  Sums go
over blocks, so that a text of many thousand matches stays cheap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 128


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_matches(df: DataFrame, text: str, out: str, pattern: str, gate: Column, group: int = 0) -> DataFrame:
    """``out``: array of (start, end, hit, part, before) of all matches, end exclusive.

    ``gate`` is a cheap test that holds wherever the pattern can match; ``hit``
    is the match, ``part`` its ``group``, ``before`` up to 32 code points ahead.
    The pattern must not match the empty string.
    """
    hits, parts, gaps, steps, sums = (f"_{out}_{x}" for x in ("hits", "parts", "gaps", "steps", "sums"))
    none = "cast(array() AS array<string>)"
    df = df.withColumn(hits, F.when(gate, F.expr(f"regexp_extract_all({text}, {quoted(pattern)}, 0)")).otherwise(F.expr(none)))
    df = df.withColumns(
        {
            gaps: F.expr(f"CASE WHEN size({hits}) = 0 THEN {none} ELSE split({text}, {quoted(pattern)}, -1) END"),
            parts: F.expr(f"CASE WHEN size({hits}) = 0 THEN {none} ELSE regexp_extract_all({text}, {quoted(pattern)}, {group}) END") if group else F.col(hits),
        }
    )
    df = df.withColumn(steps, F.expr(f"transform({hits}, (x, i) -> length(x) + length(get({gaps}, i)))"))
    blocks = f"sequence(0, greatest(size({hits}) - 1, 0) div {_BLOCK})"
    df = df.withColumn(sums, F.expr(f"transform({blocks}, b -> aggregate(slice({steps}, cast(b * {_BLOCK} + 1 AS int), {_BLOCK}), 0, (a, x) -> a + x))"))
    # What lies before a block is summed once for the block, as `o`.
    start = f"o + aggregate(slice({steps}, cast(b * {_BLOCK} + 1 AS int), cast(i AS int)), 0, (a, x) -> a + x) + length(get({gaps}, k))"
    one = f"named_struct('start', {start}, 'hit', get({hits}, k), 'part', get({parts}, k), 'before', right(get({gaps}, k), 32))"
    within = f"flatten(transform(sequence(0, least(size({hits}) - cast(b * {_BLOCK} AS int), {_BLOCK}) - 1), i -> transform(array(cast(b * {_BLOCK} + i AS int)), k -> {one})))"
    every = f"flatten(transform({blocks}, b -> flatten(transform(array(aggregate(slice({sums}, 1, cast(b AS int)), 0, (a, x) -> a + x)), o -> {within}))))"
    shape = "array<struct<start:int,end:int,hit:string,part:string,before:string>>"
    made = f"transform({every}, x -> named_struct('start', x.start, 'end', x.start + length(x.hit), 'hit', x.hit, 'part', x.part, 'before', x.before))"
    made = f"CASE WHEN size({hits}) = 0 THEN cast(array() AS {shape}) ELSE cast({made} AS {shape}) END"
    # The test is always true; it keeps filters from being moved below (see quality.py).
    df = df.withColumn(out, F.expr(f"if(monotonically_increasing_id() >= 0, {made}, NULL)"))
    return df.drop(hits, parts, gaps, steps, sums)


def blocked(spans: str) -> str:
    """SQL: spans in blocks by start, each with its bounds, for ``meets``."""
    cut = f"transform(sequence(0, greatest(size({spans}) - 1, 0) div {_BLOCK}), b -> slice(sort_array({spans}), cast(b * {_BLOCK} + 1 AS int), {_BLOCK}))"
    cut = cut.replace(f"sort_array({spans})", "o")
    cut = f"flatten(transform(array(sort_array({spans})), o -> {cut}))"
    return f"transform(filter({cut}, p -> size(p) > 0), p -> named_struct('lo', array_min(transform(p, x -> x.start)), 'hi', array_max(transform(p, x -> x.end)), 'items', p))"


def meets(blocks: str, x: str) -> str:
    """SQL: whether ``x`` overlaps a span of ``blocks``; only blocks that it can meet are looked into."""
    return f"exists({blocks}, q -> q.lo < {x}.end AND {x}.start < q.hi AND exists(q.items, s -> s.start < {x}.end AND {x}.start < s.end))"


def kept(out: str, test: str) -> Column:
    """The matches ``x`` of which the SQL ``test`` holds."""
    return F.expr(f"filter({out}, x -> {test})")


def placed(column: str, kind: str, rank: int) -> str:
    """SQL: matches as (kind, rank, start, end)."""
    return f"transform({column}, x -> named_struct('start', x.start, 'rank', {rank}, 'end', x.end, 'kind', '{kind}'))"


def joined(spans: str, by_rank: bool) -> str:
    """SQL: ``kind:start:end``, comma-joined, by rank and start or by start and rank."""
    order = "x.rank, x.start, x.end" if by_rank else "x.start, x.rank, x.end"
    names = "a, b, c"
    first, second, third = names.split(", ")
    a, b, c = (v.replace("x.", "").strip() for v in order.split(","))
    sort = f"sort_array(transform({spans}, x -> named_struct('{first}', x.{a}, '{second}', x.{b}, '{third}', x.{c}, 'kind', x.kind, 'start', x.start, 'end', x.end)))"
    return f"array_join(transform({sort}, x -> concat(x.kind, ':', cast(x.start AS string), ':', cast(x.end AS string))), ',')"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def luhn(x: str) -> str:
    """SQL: whether the digits of ``x`` have a valid Luhn sum (``x`` holds 1 to 19 digits)."""
    d = f"reverse({digits(x)})"
    each = f"cast(substring({d}, cast(i AS int), 1) AS int)"
    return (
        f"(aggregate(transform(sequence(1, length({digits(x)})), i -> CASE WHEN i % 2 = 1 THEN {each} WHEN {each} > 4 THEN 2 * {each} - 9 "
        f"ELSE 2 * {each} END), 0, (s, v) -> s + v) % 10 = 0)"
    )
