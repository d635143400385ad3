"""Secrets by multipart credential linking (native).

Base spans are fixed patterns with checks.  Weak candidates (identifiers,
secrets of weak form, endpoints) are reported only if they are linked with
complementary parts: an identifier with a secret, a secret with an identifier
or an endpoint, an endpoint with both.  A part is linked with the nearest part
of the other role in its own section (between blank lines or braces); where
the section has none, with the nearest of the document, at any distance.
Base spans play roles too.  ``links`` names the two parts of each link.

Only the parts just before and after can be nearest; they are found by running
counts of each role over the sorted parts, so no pairs or rows are made.

Defined cases: a null text is empty; an empty table gives no rows; texts, and
values, of any length are searched whole, and many thousand parts of one text
are compared by blocks; each row is a scope of its own, also if rows repeat a
doc_id; columns other than ``doc_id`` and ``text`` are not used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, spans

KINDS = ("assign", "access", "hex")
_SET = r"""["']?\x20*[:=]\x20*["']?"""
#: The base patterns (fixed values); runs of hex digits and access ids that are too short are not matched at all.
PATTERNS = {
    "assign": rf"(?i)(?:password|passwd|secret|token|api_?key){_SET}([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]{14,}+",
    "hex": r"[0-9a-f]{16,}+",
}
WEAK = {
    "ident": rf"(?i)(?<![a-z])(?:user(?:_?name|_?id)?|login|client_?id|account_?(?:id|name)){_SET}([A-Za-z0-9+/_.@-]{{3,}}+)",
    "key": rf"(?i)(?<![a-z])(?:pwd|pass|auth|credentials?|(?:private|access|client|account)_?(?:key|secret)){_SET}([A-Za-z0-9+/_.=!$%-]{{6,}}+)",
    "endpoint": r"(?i)(?<![a-z0-9])(?:https?|jdbc:[a-z]{2,16}|postgres(?:ql)?|mysql|redis|mongodb|amqps?|ftp|ssh|ldap)://[^\x00-\x20\"'<>]{3,}+",
}

#: Ends of sections: blank lines and braces.
BREAK = r"\n[\x20\x09\x0D]*+(?=\n)|[{}]"
#: Ranks of the parts that play each role.
ROLES = {"ident": "1, 3", "secret": "0, 2, 4", "endpoint": "5"}
_COUNTED = ROLES | {"section": "9"}
_BLOCK = 64


def _numbered(items: str, sums: str) -> str:
    """SQL: the sorted ``items``, each with how many of each role, and of breaks, come before it."""
    plus = ", ".join(f"'{c}', a.{c} + o.{c}" for c in _COUNTED)
    before = f"aggregate(slice({sums}, 1, cast(b AS int)), {_zero()}, (a, o) -> named_struct({plus}))"
    fields = ", ".join([f"'{c}', x.{c}" for c in ("start", "rank", "end", "kind")] + [f"'{c}', n.{c}" for c in _COUNTED])
    counted = _counted(f"slice({items}, cast(b * {_BLOCK} + 1 AS int), cast(i AS int))", "o")
    one = f"element_at(transform(array({counted}), n -> element_at(transform(array(get({items}, cast(b * {_BLOCK} + i AS int))), x -> named_struct({fields})), 1)), 1)"
    within = f"transform(sequence(0, least(size({items}) - cast(b * {_BLOCK} AS int), {_BLOCK}) - 1), i -> {one})"
    return f"flatten(transform({_blocks(items)}, b -> element_at(transform(array({before}), o -> {within}), 1)))"


def _zero() -> str:
    return f"named_struct({', '.join(f"'{c}', 0" for c in _COUNTED)})"


def _counted(items: str, start: str) -> str:
    more = ", ".join(f"'{c}', a.{c} + if(y.rank IN ({ranks}), 1, 0)" for c, ranks in _COUNTED.items())
    return f"aggregate({items}, {start}, (a, y) -> named_struct({more}))"


def _blocks(items: str) -> str:
    return f"sequence(0, greatest(size({items}) - 1, 0) div {_BLOCK})"


def _nearest(role: str) -> str:
    """SQL: the part of ``role`` that ``x`` is linked with: of its section before others, then the nearest, then the first."""
    beside = f"filter(array(get(_all_{role}, x.{role} - 1), get(_all_{role}, x.{role})), y -> y IS NOT NULL)"
    fields = "'far', x.section <> y.section, 'gap', greatest(y.start - x.end, x.start - y.end, 0), 'start', y.start, 'end', y.end, 'kind', y.kind"
    return f"array_min(transform({beside}, y -> named_struct({fields})))"


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base``, ``spans`` and ``links`` (text forms) of each row."""
    df = docs.select(F.col(key).alias("doc_id"), common.whole_text(text).alias("_sec"))
    t = F.col("_sec")
    sets = t.contains("=") | t.contains(":")
    gates = {"assign": sets, "access": t.contains("AKIA"), "hex": t.rlike("[0-9a-f]{16}"), "ident": sets, "key": sets, "endpoint": t.contains("://")}
    for kind, pattern in (PATTERNS | WEAK).items():
        df = spans.add_matches(df, "_sec", f"_{kind}", pattern, gates[kind], group=int(kind == "assign"))
    short = spans.kept("_assign", "length(x.part) BETWEEN 6 AND 11")
    df = df.withColumns({"_short": short, "_assign": spans.kept("_assign", "length(x.part) >= 12")})
    base = [spans.placed(f"_{k}", k, n) for n, k in enumerate(KINDS)]
    weak = [spans.placed(f"_{k}", n, r) for k, n, r in (("ident", "ident", 3), ("key", "secret", 4), ("short", "secret", 4), ("endpoint", "endpoint", 5))]
    df = df.withColumns({f"n_{k}": F.size(f"_{k}").cast("long") for k in KINDS} | {"_base": F.expr(f"concat({', '.join(base)})")})
    # The tests that are always true keep the lists from being worked out once for each use (see spans.py).
    df = df.withColumn("_base", F.expr("if(monotonically_increasing_id() >= 0, _base, NULL)"))
    df = df.withColumn("_blocks", F.expr(f"if(monotonically_increasing_id() >= 0, {spans.blocked('_base')}, NULL)"))
    # A part also covered by a base span is not weak; it stays a base part.
    df = df.withColumn("_weak", F.expr(f"if(monotonically_increasing_id() >= 0, filter(concat({', '.join(weak)}), x -> NOT {spans.meets('_blocks', 'x')}), NULL)"))
    weak_there = F.size("_weak") > 0
    df = spans.add_matches(df, "_sec", "_break", BREAK, weak_there)
    every = f"CASE WHEN size(_weak) > 0 THEN sort_array(concat(_base, _weak, {spans.placed('_break', 'break', 9)})) ELSE filter(_weak, x -> false) END"
    df = _once(df, "_items", every)
    df = _once(df, "_sums", f"transform({_blocks('_items')}, b -> {_counted(f'slice(_items, cast(b * {_BLOCK} + 1 AS int), {_BLOCK})', _zero())})")
    none = "cast(array() AS array<struct<start:int,rank:int,end:int,kind:string,ident:int,secret:int,endpoint:int,section:int>>)"
    df = _once(df, "_parts", f"CASE WHEN size(_items) = 0 THEN {none} ELSE filter({_numbered('_items', '_sums')}, x -> x.rank < 9) END")
    for role, ranks in ROLES.items():
        df = _once(df, f"_all_{role}", f"filter(_parts, x -> x.rank IN ({ranks}))")
    ends = f"CASE WHEN x.rank IN ({ROLES['ident']}) THEN array({_nearest('secret')}) WHEN x.rank = 5 THEN array({_nearest('secret')}, {_nearest('ident')}) ELSE array({_nearest('ident')}, {_nearest('endpoint')}) END"
    made = f"transform(_parts, x -> named_struct('start', x.start, 'rank', x.rank, 'end', x.end, 'kind', x.kind, 'ends', filter({ends}, y -> y IS NOT NULL)))"
    df = _once(df, "_linked", f"filter({made}, x -> size(x.ends) >= if(x.rank = 5, 2, 1))")
    more = "transform(filter(_linked, x -> x.rank >= 3), x -> named_struct('start', x.start, 'rank', x.rank, 'end', x.end, 'kind', x.kind))"
    name = "concat({0}.kind, ':', cast({0}.start AS string), ':', cast({0}.end AS string))"
    links = f"array_join(flatten(transform(_linked, x -> transform(x.ends, y -> concat({name.format('x')}, '>', {name.format('y')})))), ',')"
    done = df.select("doc_id", *(f"n_{k}" for k in KINDS), F.expr(spans.joined("_base", by_rank=False)).alias("base"), "_base", F.expr(more).alias("_more"), F.expr(links).alias("links"))
    done = done.withColumn("spans", F.expr(spans.joined("concat(_base, _more)", by_rank=False)))
    return done.select("doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "links")


def _once(df: DataFrame, column: str, sql: str) -> DataFrame:
    """``df`` with a column that is worked out once, however often it is used."""
    return df.withColumn(column, F.expr(f"if(monotonically_increasing_id() >= 0, {sql}, NULL)"))
