"""Main text of web pages by wrapper induction.

Pages of one host are aligned as whole trees, in groups of bounded size, by
simple tree matching with the page of middle size.  A node that is the same
in nearly all pages of its group, although their other content differs, is
part of the host's template; slots that vary are content.  Among the slots,
the way to the main one leads, from the top, to the container that holds most
of the text of all aligned pages outside of links; containers beside that way
that are small against it, or mostly links, are no content on any page.  What
varies and still is no article is also told by its role: elements that HTML
itself or their class names mark as navigation, header, footer, sidebar,
notice, advert, form or reader comments never count as content.  Article and
main elements bound the content of pages that have any where the host has too
few other pages to tell its main slot.

Pages that are equal in content count once, and of two to four pages nodes
that make up most of the text are no template, so that copies of one article
don't take it away.  A host with more pages than ``group_most`` is dealt out to several
groups, each of which induces the wrapper from its own pages.

Text inside a block becomes one line; blocks are joined by blank lines.
Defined cases: a null or empty page, or one without content, has an empty
text; markup that is cut off or not closed ends with the page; quotes count
behind an equals sign only; pages of any length and depth are aligned whole;
a host with one page has no template; pages without a host are grouped
together; repeated rows give equal texts; columns other than the three are
not used, whatever their names.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Elements by their standard roles (fixed values).
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
RAW = set("script style textarea title noscript template iframe xmp".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = set("script style noscript template iframe head title nav header footer aside form button select option textarea input label svg canvas object embed menu dialog".split())
CLOSES_P = BLOCKS - {"html", "body"}
CONTAINERS = set("html body div section center table tbody tr td article main".split())
SLOTS = CONTAINERS | set("ul ol dl details fieldset span a".split())
#: Parts of class names and ids that mark what is no article, wherever they stand in a name, and those that do so alone,
#: at its end, or before a word for a container (fixed values).
_MARKS = set("nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts advertisement cookie cookies consent popup modal newsletter disqus pagination comments replies".split())
_WEAK_MARKS = set("header banner promo sponsor sponsored notice subscribe share social comment reply respond related widget skip".split())
_HOLDERS = set("area articles bar block box button buttons container form icons inner items link links list posts section stories thread widget wrap wrapper".split())
_OWN_HEADERS = set("article content entry post story".split())
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|</?[A-Za-z](?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+(?:>|$)", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_SPACE = re.compile(r"[\s/][^\s/>]")
_ATTR = re.compile(r"([A-Za-z_:][^\s=/>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")  # hidden has no value


def _marked(names: str) -> bool:
    """Whether class names or ids mark a part that is no article."""
    for name in names.lower().split():
        parts = [x for x in re.split(r"[-_]", name) if x]
        if not parts:
            continue
        if _MARKS.intersection(parts):
            return True
        if parts[-1] in _WEAK_MARKS and not (parts[-1] == "header" and len(parts) > 1 and parts[0] in _OWN_HEADERS):
            return True
        if len(parts) > 1 and parts[0] in _WEAK_MARKS and parts[1] in _HOLDERS:
            return True
    return False


class Node:
    __slots__ = ("tag", "children", "dropped", "sign", "size", "chars", "links")

    def __init__(self, tag: str, dropped: bool) -> None:
        self.tag, self.dropped = tag, dropped
        self.children: list[Node | str] = []
        self.sign = ""
        self.size = 1
        self.chars = 0
        self.links = 0


def parse(page: str) -> Node:
    """A tolerant tree of the page: void and raw elements, implied ends of p, li and cells, unclosed tags."""
    root = Node("#root", False)
    stack = [root]
    at = 0
    low = None
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        raw = m.group(0)
        if raw[1] in "!?":
            continue
        tag = _NAME.match(raw).group(1).lower()
        if raw[1] == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end does not close a block
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCKS:
                    break
        own = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}.get(tag)
        if own:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in own:
                    del stack[k:]
                    break
                if stack[k].tag in {"ul", "ol", "dl", "table", "select"}:
                    break
        attrs = {} if not _SPACE.search(raw) else {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(raw, _NAME.match(raw).end())}
        marked = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        dropped = tag in DROPPED or "hidden" in attrs or attrs.get("role", "").lower() in _ROLES or attrs.get("aria-hidden") == "true"
        node = Node(tag, dropped or (tag not in ("html", "body", "main", "article") and _marked(marked)))
        stack[-1].children.append(node)
        if tag in VOID or raw.endswith("/>"):
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find(f"</{tag}", at) if len(low) == len(page) else -1
            if end < 0:
                found = re.compile(f"</{tag}", re.I).search(page, at)
                end = found.start() if found else len(page)
            node.children.append(page[at:end])
            close = page.find(">", end)
            at = len(page) if close < 0 else close + 1
            continue
        stack.append(node)
    return root


def _sign(node: Node) -> None:
    """Equal signs: equal trees and texts, without what is dropped.  Iterative, as trees may be very deep."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node) and not c.dropped)
    for n in reversed(order):
        kids = [c for c in n.children if isinstance(c, Node) and not c.dropped]
        texts = [" ".join(c.split()) for c in n.children if not isinstance(c, Node)]
        # The order of texts and elements counts, the white space between elements does not.
        parts = [c.sign if isinstance(c, Node) else " ".join(c.split()) for c in n.children if not (isinstance(c, Node) and c.dropped)]
        n.sign = f"{n.tag}({xxhash.xxh64_hexdigest(chr(0).join(x for x in parts if x).encode('utf-8', 'replace'))})"
        n.size = 1 + sum(c.size for c in kids)
        n.chars = sum(map(len, texts)) + sum(c.chars for c in kids)
        n.links = n.chars if n.tag == "a" else sum(c.links for c in kids)


def _content_roots(root: Node) -> list[Node]:
    """Article and main elements that are not boilerplate, in page order; else the page."""
    found, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.dropped:
            continue
        if n.tag in ("article", "main"):
            found.append(n)
        else:
            todo.extend(reversed([c for c in n.children if isinstance(c, Node)]))
    return found or [root]


def match(a: Node, b: Node, out: dict[int, Node]) -> int:
    """Simple tree matching: the most nodes in an order-keeping mapping; ``out`` maps ids of a's nodes to b's.

    Scores of all pairs of nodes come first, each once and without recursion;
    then the mapping is traced from the top.  Lists of children are aligned
    whole, whatever their length and depth; equal heads and tails at once.
    """
    kids: dict[int, list[Node]] = {}
    scores: dict[tuple[int, int], int] = {}

    def below(n: Node) -> list[Node]:
        if id(n) not in kids:
            kids[id(n)] = [c for c in n.children if isinstance(c, Node) and not c.dropped]
        return kids[id(n)]

    def ends(x: Node, y: Node) -> tuple[list[Node], list[Node], list[tuple[Node, Node]]]:
        xs, ys = below(x), below(y)
        most = min(len(xs), len(ys))
        head = 0
        while head < most and xs[head].sign == ys[head].sign:
            head += 1
        tail = 0
        while tail < most - head and xs[-1 - tail].sign == ys[-1 - tail].sign:
            tail += 1
        equal = [*zip(xs[:head], ys[:head]), *zip(xs[len(xs) - tail :], ys[len(ys) - tail :])]
        return xs[head : len(xs) - tail], ys[head : len(ys) - tail], equal

    def value(p: Node, q: Node) -> int | None:
        """The score of a pair, or None where its children have to be aligned first."""
        if p.tag != q.tag:
            return 0
        if p.sign == q.sign:
            return p.size + 1
        if not below(p) or not below(q):
            return 1
        return scores.get((id(p), id(q)))

    def align(xs: list[Node], ys: list[Node], moves: bytearray | None) -> int:
        row = [0] * (len(ys) + 1)
        for i, p in enumerate(xs):
            new = [0]
            for j, q in enumerate(ys):
                up, left, both = row[j + 1], new[j], row[j] + value(p, q)
                best = max(up, left, both)
                new.append(best)
                if moves is not None:
                    moves[i * len(ys) + j] = 0 if best == up else 1 if best == left else 2
            row = new
        return row[-1]

    todo = [(a, b, False)] if a.tag == b.tag else []
    while todo:
        x, y, ready = todo.pop()
        if (id(x), id(y)) in scores:
            continue
        xs, ys, equal = ends(x, y)
        if not ready:
            todo.append((x, y, True))
            todo.extend((p, q, False) for p in xs for q in ys if value(p, q) is None)
        else:
            scores[id(x), id(y)] = 1 + sum(p.size for p, _ in equal) + (align(xs, ys, None) if xs and ys else 0)
    trace = [(a, b)] if a.tag == b.tag else []
    while trace:
        x, y = trace.pop()
        out[id(x)] = y
        if x.sign == y.sign:
            out.update((id(p), q) for p, q in zip(_nodes(x), _nodes(y)))
            continue
        xs, ys, equal = ends(x, y)
        trace += equal
        if xs and ys:
            moves = bytearray(len(xs) * len(ys))
            align(xs, ys, moves)
            i, j = len(xs), len(ys)
            while i and j:
                move = moves[(i - 1) * len(ys) + j - 1]
                if move == 2:
                    trace.append((xs[i - 1], ys[j - 1]))
                i, j = i - (move != 1), j - (move != 0)
    return scores.get((id(a), id(b)), 0)


def _kids(n: Node) -> list[Node]:
    return [c for c in n.children if isinstance(c, Node) and not c.dropped]


def _way(pivot: Node, maps: list[dict[int, Node]], fixed: set[int], share: float = 0.6) -> list[tuple[Node, Node, set[int]]]:
    """Steps (parent, child) from the top to the main slot, with the slots beside the child that are small against it, or mostly links."""
    out, n = [], pivot
    while True:
        mass, links = {}, {}
        for c in _kids(n):
            found = [] if id(c) in fixed else [m[id(c)] for m in maps if id(c) in m]
            mass[id(c)], links[id(c)] = sum(q.chars - q.links for q in found), sum(q.links for q in found)
        best = max(_kids(n), key=lambda c: mass[id(c)], default=None)
        if best is None or best.tag not in CONTAINERS or not _kids(best) or mass[id(best)] < share * max(1, sum(mass.values())):
            return out
        most = mass[id(best)]
        out.append((n, best, {id(c) for c in _kids(n) if c is not best and c.tag in SLOTS and (10 * mass[id(c)] < most or links[id(c)] > mass[id(c)])}))
        n = best


def _beside(way: list[tuple[Node, Node, set[int]]], found: dict[int, Node]) -> set[int]:
    """Nodes of a page that stand beside the way to its main slot and are no content."""
    out = set()
    for n, best, small in way:
        if id(n) not in found or id(best) not in found:
            break
        main = found[id(best)]
        slots = {id(found[k]): k in small for k in map(id, _kids(n)) if k in found}
        for c in _kids(found[id(n)]):
            # What stands in no slot of the other pages is judged by its own text.
            if c is not main and c.tag in SLOTS and slots.get(id(c), 10 * c.chars < main.chars or 2 * c.links > c.chars):
                out.add(id(c))
    return out


def text_of(roots: list[Node], template: set[int]) -> str:
    """The blocks of content outside dropped and template nodes."""
    blocks: list[str] = []
    line: list[str] = []

    def close() -> None:
        text = " ".join(_html.unescape("".join(line)).split())
        if text:
            blocks.append(text)
        line.clear()

    todo: list[Node | str | None] = [x for r in reversed(roots) for x in (None, r)]
    while todo:
        n = todo.pop()
        if n is None:
            close()
        elif isinstance(n, str):
            line.append(n)
        elif n.dropped or id(n) in template:
            if n.tag in BLOCKS:
                close()
        else:
            if n.tag == "br":
                line.append(" ")
            if n.tag in BLOCKS:
                close()
                todo.append(None)
            todo.extend(reversed(n.children))
    close()
    return "\n\n".join(blocks)


def induce(pages: list[str], least: int = 2, share: float = 0.8, few: int = 5) -> list[str]:
    """Main texts of same-host pages, with the template found by aligning them.

    Pages that are wholly equal in content count once, so copies can't make
    their own text a template; where there are fewer than ``few`` others, nor
    can nodes that hold over half of the text of the page that is aligned to.
    """
    roots = [parse(p) for p in pages]
    mains = [_content_roots(r) for r in roots]
    for r in roots:
        _sign(r)
    keys = [" ".join(m.sign for m in found) for found in mains]
    first: dict[str, int] = {}
    for k, key in enumerate(keys):
        first.setdefault(key, k)
    distinct = list(first.values())
    template: list[set[int]] = [set() for _ in roots]
    if len(distinct) >= least:
        pivot = roots[sorted(distinct, key=lambda k: (roots[k].size, roots[k].sign))[len(distinct) // 2]]
        nodes = {id(n): n for n in _nodes(pivot)}
        same: Counter[int] = Counter()
        maps: dict[int, dict[int, Node]] = {}
        for k, r in enumerate(roots):
            maps[k] = found = {}
            match(pivot, r, found)
            if first[keys[k]] == k:
                same.update(f for f, q in found.items() if nodes[f].sign == q.sign)
        fixed = {f for f, n in same.items() if n >= share * len(distinct) and f != id(pivot)}
        # The tops of what is fixed, and how much of the text they hold.
        tops, chars, todo = set(), 0, [pivot]
        while todo:
            n = todo.pop()
            if id(n) in fixed:
                tops.add(id(n))
                chars += n.chars
            else:
                todo.extend(c for c in n.children if isinstance(c, Node) and not c.dropped)
        if len(distinct) < few and 2 * chars > pivot.chars:
            tops = set()
        way = _way(pivot, [maps[k] for k in distinct], tops)
        for k, found in maps.items():
            template[k] = {id(found[f]) for f in tops if f in found and found[f].sign == nodes[f].sign}
            if mains[k] == [roots[k]] or (way and len(distinct) >= few):
                mains[k] = [roots[k]]  # the wrapper bounds the content
                template[k] |= _beside(way, found)
    return [text_of(m, t) for m, t in zip(mains, template)]


def _nodes(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node) and not c.dropped)
    return out


def extract(pages: DataFrame, group_most: int = 256, hosts_most: int = 65_536) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page.

    Only hosts with more than 1 / ``hosts_most`` of all pages are spread over
    several tasks; there are fewer than ``hosts_most`` of these, which bounds
    the table that is broadcast, so the pages themselves move once.  Within a
    task the pages of a host stream by in groups.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    rows = pages.select("page_id", "url", "html").withColumn("_host", host).withColumn("_key", F.xxhash64("_host"))
    share = max(group_most, -(-pages.count() // hosts_most))
    # Hosts whose keys collide are spread together, which changes no host's pages.
    heavy = rows.groupBy("_key").count().where(F.col("count") > share).select("_key", F.ceil(F.col("count") / share).cast("int").alias("_parts"))
    rows = rows.join(F.broadcast(heavy), "_key", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.col("_parts")), F.lit(0)).cast("int"))
    dealt = rows.select("_host", "_part", "page_id", "url", "html").repartition("_host", "_part").sortWithinPartitions("_host", "_part", "page_id", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None

        def close(n: int) -> pa.RecordBatch:
            group = held[:n]
            del held[:n]
            texts = induce([h or "" for _, _, h in group])
            sizes = np.array([len(t) for t in texts], np.int64)
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in group], pa.int64()), pa.array([r[1] for r in group], pa.string()), pa.array(texts, pa.string()), pa.array(sizes)], names=["page_id", "url", "text", "n_chars"])

        for b in batches:
            for host, part, page_id, url, page in zip(*(c.to_pylist() for c in b.columns)):
                if (host, part) != last:
                    if held:
                        yield close(len(held))
                    last = (host, part)
                held.append((page_id, url, page))
                if len(held) >= 2 * group_most:  # what is left for the last group is no small rest
                    yield close(group_most)
        if held:
            yield close(len(held))

    return dealt.mapInArrow(run, "page_id long, url string, text string, n_chars long")
