"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of block tags and texts.  A wrapper describes the streams of a
host's pages with four things only: a tag pair around a sequence, a text slot, an
optional item and a repeated item or group.  Inference aligns one stream after the
other with the wrapper so far: equal items are aligned in turn; where the two
differ, an item or a run of items that only one of them has becomes optional, a run
of equal neighbours becomes a repeated item (of two or three alternating ones, a
repeated group), and texts leave slots.  Wrappers align with wrappers in the same way.

Inference takes each different stream of a host once, in the order of a hash, and folds
them in levels of FOLD, so a host's wrapper depends on its pages only, not on how they lay or
were dealt.  Then every page is aligned with its host's wrapper, and the slots are counted over all
pages: how many have the slot, its characters and how many of them are link text, and the
pages of each text, all of them exact.  Extraction walks a page beside the wrapper again and
decides each text by its slot.  Texts that stay the same over the host's pages go, slots of mostly
link text go (but a heading that is not repeated stays), and so do repeated articles that are linked
cards beside a larger text.  All other slots are main text, wherever they stand.  Named
menus, headers, footers, sidebars, notices, adverts, forms and comments are left out by fixed words
of tags and classes, as a slot's varying text alone can't tell an advert from a paragraph.

A text is constant if at least CONSTANT pages and half of the pages with its slot have
it: fewer pages say nothing about what varies.  In a repeated slot it goes only if it stands in a part
of the page (a marked container, article or section) with no other text of its own on that page, as
prose may repeat a line.  A page with nothing but constant texts (a copy) keeps them, one with
nothing but links keeps those.  Tags nested deeper than DEEPEST are read as if they
were not there, but what is in a dropped one is dropped.

Two sequences of items are aligned by their longest common subsequence; where it would take
more than DENSE cells, by the labels that both have once, and between those by the nearest equal
label, in time that grows as the length.

Defined results: null and empty pages have the empty text; a page without a host
shares the wrapper of those without one; white space inside a block is one space; pages that repeat
count as pages of their own; a page of any length is read whole; an empty table gives an empty one; other columns stay
(but the html), a column ``text`` is replaced.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from functools import lru_cache
from itertools import count
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, ship

#: Different streams, and counts of texts, that a task holds before it hands them on.
HELD, COUNTS = 512, 200_000
#: Parts of a host that are folded together at once, in each of LEVELS.
FOLD, LEVELS = 64, 3
#: Pages that make a text constant.
CONSTANT = 5
#: Cells of the table by which two sequences are aligned, and how far an equal label may be where there would be more.
DENSE, NEAR = 250_000, 64
#: Open tags of a tree.
DEEPEST = 200

#: Tags by what they do.
DROPPED = frozenset("head title script style noscript template iframe svg canvas object select button textarea form nav footer aside dialog menu".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong
sub sup time tt u var wbr br path""".split())
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {
    "p": frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre
section table ul li dt dd td th tr""".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: Words of class, id and role that name what is not the main text, and what is.
BOILERPLATE = frozenset("""nav navigation navbar menu menubar breadcrumb breadcrumbs sidebar sidenav footer masthead banner ad ads adv advert adverts
advertisement sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup
login share sharing social related recommended recommendations comment comments commentlist reply replies respond disqus search searchbox widget
toolbar pagination pager contentinfo complementary skip""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[/!?a-zA-Z][^<>]*\Z",
                    re.S | re.I)
_MARKS = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    """One tag pair of a page: its label (tag and marks) and its items; a text is a pair (characters, of them linked, text)."""

    __slots__ = ("label", "tag", "items")

    def __init__(self, label: str, tag: str):
        self.label, self.tag, self.items = label, tag, []


def parse(source: str) -> Node:
    """The tree of block tags of a page; inline tags only tell what is linked, unclosed tags are closed as a browser would."""
    root = Node("", "")
    stack, linked, at = [root], 0, 0
    beyond: list[Node] = []  # open tags below the deepest that is kept
    buffer: list[str] = []
    in_link = 0

    def flush() -> None:
        nonlocal buffer, linked
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            if text and not any(is_boilerplate(x.label, True) for x in beyond):
                stack[-1].items.append((len(text), min(len(text), linked), text))
            buffer, linked = [], 0

    for m in _TOKEN.finditer(source):
        if m.start() > at:
            piece = source[at:m.start()]
            buffer.append(piece)
            if in_link:
                linked += len(piece)
        at = m.end()
        tag = m.group(3)
        if not tag:
            continue
        tag, closing = tag.lower(), bool(m.group(2))
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                buffer.append(" ")
            continue
        flush()
        if closing:
            if any(x.tag == tag for x in beyond):
                while beyond.pop().tag != tag:
                    pass
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    beyond.clear()
                    break
            continue
        while beyond and tag in CLOSED_BY.get(beyond[-1].tag, ()):
            beyond.pop()
        while not beyond and len(stack) > 1 and tag in CLOSED_BY.get(stack[-1].tag, ()):
            stack.pop()
        if tag in ("html", "body"):
            continue
        marks = " ".join(" ".join(x) for x in _MARKS.findall(m.group(4))).split() if m.group(4) else []
        # long numbers in marks differ from page to page
        label = ".".join([tag, *sorted({re.sub(r"\d{3,}", "", x) for x in marks})])
        node = Node(label, tag)
        is_open = tag not in VOID and not m.group(4).endswith("/")
        if is_open and len(stack) >= DEEPEST:
            beyond.append(node)
            continue
        stack[-1].items.append(node)
        if is_open:
            stack.append(node)
    if at < len(source):
        buffer.append(source[at:])
        linked += len(source) - at if in_link else 0
    flush()
    return root


# A wrapper item is a list: [label, optional, repeated, items].
# The label "#" is a text slot; a label of several names is a group.
LABEL, OPTIONAL, REPEATED, ITEMS = range(4)


def described(node: Node) -> list:
    """The wrapper of one page."""
    return [node.label, False, False, squared([["#", False, False, []] if isinstance(x, tuple) else described(x) for x in node.items])]


def digest(text: str) -> int:
    """A signed 64-bit number of the whole text."""
    n = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return n - (1 << 64) if n >> 63 else n


def squared(items: list) -> list:
    """Neighbouring repeats of one, two or three items folded into repeated items and groups."""
    for width in (1, 2, 3):
        out, i = [], 0
        while i < len(items):
            block = [x[LABEL] for x in items[i:i + width]]
            j = i + width
            while len(block) == width and len(set(block)) == width and [x[LABEL] for x in items[j:j + width]] == block:
                j += width
            if j > i + width and not (width == 1 and block == ["#"]):
                parts = [items[k:k + width] for k in range(i, j, width)]
                first = parts[0]
                for other in parts[1:]:
                    first = [folded(a, b) for a, b in zip(first, other, strict=True)]
                if width == 1:
                    first[0][REPEATED] = True
                    out.append(first[0])
                else:
                    out.append([" ".join(block), False, True, first])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


def folded(a: list, b: list) -> list:
    """One item that describes what both describe."""
    return [a[LABEL], a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED], aligned(a[ITEMS], b[ITEMS])]


def aligned(a: list, b: list) -> list:
    """Two sequences of items in one: items of a common subsequence are folded, what one side lacks becomes optional."""
    names_a, names_b = [x[LABEL] for x in a], [x[LABEL] for x in b]
    if names_a == names_b:
        return [folded(x, y) for x, y in zip(a, b, strict=True)]
    out, i, j = [], 0, 0
    for p, q in [*common(names_a, names_b), (len(a), len(b))]:
        out += [_optional(x) for x in a[i:p]] + [_optional(x) for x in b[j:q]]
        if p < len(a):
            out.append(folded(a[p], b[q]))
        i, j = p + 1, q + 1
    return squared(out)


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence, ascending in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, end_i, j, end_j = todo.pop()
        while i < end_i and j < end_j and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < end_i and j < end_j and a[end_i - 1] == b[end_j - 1]:
            end_i, end_j = end_i - 1, end_j - 1
            found.append((end_i, end_j))
        if i == end_i or j == end_j:
            continue
        if (end_i - i) * (end_j - j) <= DENSE:
            found += _longest(a, b, i, end_i, j, end_j)
        elif anchors := _anchors(a, b, i, end_i, j, end_j):
            found += anchors
            for p, q in [*anchors, (end_i, end_j)]:
                todo.append((i, p, j, q))
                i, j = p + 1, q + 1
        else:
            for p in range(i, end_i):
                q = next((k for k in range(j, min(j + NEAR, end_j)) if b[k] == a[p]), None)
                if q is not None:
                    found.append((p, q))
                    j = q + 1
    return sorted(found)


def _longest(a: list[str], b: list[str], i: int, end_i: int, j: int, end_j: int) -> list[tuple[int, int]]:
    rows = [[0] * (end_j - j + 1) for _ in range(end_i - i + 1)]
    for p in range(end_i - i - 1, -1, -1):
        row, below, name = rows[p], rows[p + 1], a[i + p]
        for q in range(end_j - j - 1, -1, -1):
            row[q] = below[q + 1] + 1 if name == b[j + q] else max(below[q], row[q + 1])
    out, p, q = [], 0, 0
    while p < end_i - i and q < end_j - j:
        if a[i + p] == b[j + q]:
            out.append((i + p, j + q))
            p, q = p + 1, q + 1
        elif rows[p + 1][q] >= rows[p][q + 1]:
            p += 1
        else:
            q += 1
    return out


def _anchors(a: list[str], b: list[str], i: int, end_i: int, j: int, end_j: int) -> list[tuple[int, int]]:
    """The longest ascending run of labels that stand once in either stretch."""
    once_a, once_b = ({x for x, n in Counter(part).items() if n == 1} for part in (a[i:end_i], b[j:end_j]))
    there = {b[q]: q for q in range(j, end_j) if b[q] in once_b}
    pairs = [(p, there[a[p]]) for p in range(i, end_i) if a[p] in once_a and a[p] in there]
    tops: list[int] = []  # smallest last place in b of an ascending run of each length
    last: list[int] = []  # the pair it ends with
    before: list[int] = []
    for k, (_, q) in enumerate(pairs):
        at = bisect_left(tops, q)
        tops[at:at + 1] = [q]
        last[at:at + 1] = [k]
        before.append(last[at - 1] if at else -1)
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def _optional(item: list) -> list:
    return [item[LABEL], True, *item[2:]]


def expression(item: list) -> str:
    """A wrapper as a regular expression over tags and slots."""
    inner = " ".join(expression(x) for x in item[ITEMS])
    body = "#text" if item[LABEL] == "#" else inner if not item[LABEL] or " " in item[LABEL] else f"<{item[LABEL]}> {inner} </{item[LABEL].split('.')[0]}>"
    return f"({body}){'+' if item[REPEATED] else ''}{'?' if item[OPTIONAL] else ''}" if item[REPEATED] or item[OPTIONAL] else body


@lru_cache(4096)
def is_boilerplate(label: str, in_article: bool = False) -> bool:
    tag, *marks = label.split(".")
    if tag in DROPPED or tag == "header" and not in_article:
        return True
    return any(_words(m) & BOILERPLATE or m.lower() in BOILERPLATE for m in marks) and tag not in ("article", "main")


def _words(mark: str) -> set[str]:
    return {w.lower() for w in _NAMES.findall(mark)}


# A slot of a plan is a list: [label, where the next item may align, number of the slot, repeated, slots of its items].
# A verdict is the same with whether it is main text and the digests of constant texts: [label, next, kept, constant, repeated, verdicts of its items].
NEXT, NUMBER, AGAIN_, INNER_ = 1, 2, 3, 4
KEPT, SAME, AGAIN, INNER = 2, 3, 4, 5
#: Tags of prose, which are no part of a page of their own whatever their marks.
PROSE = frozenset("p li dt dd td th tr pre".split()) | HEADINGS


def plan_of(wrapper: list) -> list:
    """The items of a wrapper with groups dissolved, each with a number."""
    numbers = count()

    def slots(items: list, out: list, repeated: bool, start: int | None = None) -> list:
        for item in items:
            at, again = len(out), repeated or item[REPEATED]
            if " " in item[LABEL]:
                slots(item[ITEMS], out, True, at if start is None else start)
                continue
            after = start if start is not None else at if item[REPEATED] else at + 1
            out.append([item[LABEL], after, next(numbers), again, slots(item[ITEMS], [], again)])
        return out

    return slots(wrapper[ITEMS], [], False)


def placed(items: list, known: list) -> Iterator[tuple]:
    """Each item of a page with the slot or verdict it aligns with, or None."""
    at = 0
    where: dict[str, list[int]] = {}
    for k, slot in enumerate(known):
        where.setdefault(slot[0], []).append(k)
    for item in items:
        own = where.get("#" if isinstance(item, tuple) else item.label)
        if own is None:
            yield item, None
            continue
        k = bisect_left(own, at)
        j = own[k] if k < len(own) else own[0]
        if j >= at:
            at = known[j][NEXT]
        yield item, known[j]


def counted(page: Node, plan: list) -> tuple[dict[int, list[int]], set[tuple[int, int]]]:
    """Characters and linked ones of each slot that a page has, and its (slot, text) pairs."""
    sums: dict[int, list[int]] = {}
    texts: set[tuple[int, int]] = set()

    def walk(node: Node, known: list) -> None:
        for item, slot in placed(node.items, known):
            if slot is None:
                continue
            own = sums.setdefault(slot[NUMBER], [0, 0])
            if isinstance(item, tuple):
                own[0] += item[0]
                own[1] += item[1]
                texts.add((slot[NUMBER], digest(item[2])))
            else:
                walk(item, slot[INNER_])

    walk(page, plan)
    return sums, texts


class Slot(NamedTuple):
    """What all pages of a host say of a slot: pages that have it, characters, linked ones, different texts, and the constant texts."""

    pages: int = 0
    chars: int = 0
    linked: int = 0
    distinct: int = 0
    constant: tuple[int, ...] = ()


def verdicts(plan: list, of: Mapping[int, Slot]) -> list:
    """What extraction needs of a plan: whether each slot is main text."""
    masses: dict[int, float] = {}
    none = Slot()

    def mass(slot: list) -> float:
        """Unlinked characters that vary."""
        if slot[0] == "#":
            s = of.get(slot[NUMBER], none)
            own = 0.0 if s.constant and s.distinct == 1 else float(max(0, s.chars - 2 * s.linked))
        else:
            own = 0.0 if is_boilerplate(slot[0], True) else sum(map(mass, slot[INNER_]))
        masses[slot[NUMBER]] = own
        return own

    def linked(slot: list) -> bool:
        s = of.get(slot[NUMBER], none)
        return slot[0] == "#" and 0 < s.chars <= 2 * s.linked or any(map(linked, slot[INNER_]))

    total = sum(map(mass, plan))

    def judged(slots: list, heading: bool, in_article: bool) -> list:
        out = []
        for slot in slots:
            label, after, number, again, inner = slot
            tag, s = label.split(".")[0], of.get(number, none)
            if label == "#":
                out.append([label, after, not linked(slot) or heading and not again, list(s.constant), again, []])
                continue
            cards = tag == "article" and again and linked(slot) and 2 * masses.get(number, 0.0) < total
            # outside of articles, a site's name is told from a title by being constant, which takes enough pages
            site = tag == "header" and not in_article and s.pages < CONSTANT
            out.append([label, after, not cards and not site, [], again, judged(inner, heading or tag in HEADINGS, in_article or tag in ("article", "main"))])
        return out

    return judged(plan, False, False)


def extract(page: Node, host: list) -> str:
    """The texts of a page whose slots are main text, in page order; ``host`` are the verdicts of its host's wrapper."""

    def take(node: Node, known: list, in_article: bool, only_headings: bool, part: list) -> None:
        """``part`` has the places in ``out`` of the constant texts of this part of the page, and first whether others were met."""
        for item, found in placed(node.items, known):
            if isinstance(item, tuple):
                kept = 2 * item[1] < item[0] if found is None else found[KEPT]
                same = found is not None and found[SAME] and digest(item[2]) in found[SAME]
                if only_headings or not (kept or links):
                    continue
                if same and not copies:
                    if not found[AGAIN]:
                        continue
                    part.append(len(out))
                else:
                    part[0] = True
                out.append(item[2])
            elif is_boilerplate(item.label, True) or found is not None and not found[KEPT] and not links:
                continue
            else:
                inside = in_article or item.tag in ("article", "main")
                # of a header its headings only; a site's header holds no main text where constant texts count too
                if item.tag == "header" and not in_article and (found is None or copies):
                    continue
                title = (only_headings or item.tag == "header") and item.tag not in HEADINGS
                own = item.tag not in PROSE and ("." in item.label or item.tag in ("article", "main", "section"))
                inner = [False] if own else part
                take(item, found[INNER] if found is not None else [], inside, title, inner)
                if own:
                    settle(inner)

    def settle(part: list) -> None:
        if not part[0]:
            for i in part[1:]:
                out[i] = ""

    # a page without main text by its slots is a copy of others, or all links
    for copies, links in ((False, False), (True, False), (True, True)):
        out: list[str] = []
        whole = [False]
        take(page, host, False, False, whole)
        settle(whole)
        out = [x for x in out if x]
        if out:
            break
    return "\n".join(out)


def infer(pages: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` (JSON) of the pages (host, html)."""
    ship(pages.sparkSession)

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[tuple[str, str]] = set()
        for batch in batches:
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.add((host, json.dumps(described(parse(source.as_py() or "")), ensure_ascii=False)))
                if len(held) > HELD:
                    yield _rows(held)
        yield _rows(held)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by host and part, so one wrapper is held at a time."""
        at, whole = None, None
        for batch in batches:
            for host, part, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                one = json.loads(text)
                if (host, part) == at:
                    whole = folded(whole, one)
                else:
                    if whole is not None:
                        yield _part(at, whole)
                    at, whole = (host, part), one
        if whole is not None:
            yield _part(at, whole)

    found = pages.select("host", "html").mapInArrow(streams, "host string, wrapper string").distinct()
    found = found.select("host", F.pmod(F.xxhash64("wrapper"), F.lit(FOLD ** (LEVELS - 1))).alias("part"), "wrapper")
    for level in range(LEVELS):  # parts of a host by the hash of their streams: first each by itself, then FOLD together
        at = found.select("host", F.expr(f"part div {FOLD if level else 1}").alias("part"), "wrapper")
        found = at.repartition("host", "part").sortWithinPartitions("host", "part", "wrapper").mapInArrow(joined, "host string, part bigint, wrapper string")
    return found.select("host", "wrapper")


def _rows(held: set[tuple[str, str]]) -> pa.RecordBatch:
    rows = sorted(held)
    held.clear()
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], names=["host", "wrapper"])


def _part(at: tuple[str, int], wrapper: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.string()), pa.array([at[1]], pa.int64()), pa.array([json.dumps(wrapper, ensure_ascii=False)], pa.string())],
                                      names=["host", "part", "wrapper"])


_COUNTS = pa.schema([("host", pa.string()), ("slot", pa.int32()), ("text", pa.int64()), ("pages", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64())])


def count_slots(pages: DataFrame) -> DataFrame:
    """(host, slot, text, pages, chars, linked) of the pages (host, plan, html), summed in each task; a null text is for the slot itself."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, int | None], list[int]] = {}
        read = lru_cache(64)(json.loads)

        def handed_on() -> pa.RecordBatch:
            rows = [(*k, *v) for k, v in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_COUNTS)], schema=_COUNTS)

        for batch in batches:
            for host, plan, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                sums, texts = counted(parse(source.as_py() or ""), read(plan))
                for slot, (chars, linked) in sums.items():
                    own = held.setdefault((host, slot, None), [0, 0, 0])
                    own[0] += 1
                    own[1] += chars
                    own[2] += linked
                for slot, text in texts:
                    held.setdefault((host, slot, text), [0, 0, 0])[0] += 1
            if len(held) > COUNTS:
                yield handed_on()
        yield handed_on()

    return pages.mapInArrow(counts, "host string, slot int, text bigint, pages bigint, chars bigint, linked bigint")


def host_verdicts(rows: DataFrame, work: Workspace) -> DataFrame:
    """``host`` and ``verdicts`` (JSON), from all pages (host, html)."""
    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plans = [json.dumps(plan_of(json.loads(w)), ensure_ascii=False) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plans, pa.string())], names=["host", "plan"])

    # written first, so that its true size decides whether the pages are shuffled at all
    plans = work.put(infer(rows).mapInArrow(planned, "host string, plan string"), "plans")
    found = count_slots(rows.select("host", "html").join(plans, "host").select("host", "plan", "html"))
    summed = work.put(found.groupBy("host", "slot", "text").agg(*[F.sum(c).alias(c) for c in ("pages", "chars", "linked")]), "counts")
    slots = work.put(summed.filter("text is null").drop("text"), "slots")
    texts = summed.filter("text is not null").select("host", "slot", "text", F.col("pages").alias("n"))
    distinct = texts.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("distinct"))
    # at least half of a slot's pages, so a few texts of each slot
    constant = (texts.filter(F.col("n") >= CONSTANT).join(slots.select("host", "slot", "pages"), ["host", "slot"]).filter(2 * F.col("n") >= F.col("pages"))
                .groupBy("host", "slot").agg(F.sort_array(F.collect_list("text")).alias("constant")))
    known = (slots.join(distinct, ["host", "slot"], "left").join(constant, ["host", "slot"], "left")
             .groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "chars", "linked", F.coalesce("distinct", F.lit(0)).alias("distinct"), "constant")).alias("slots")))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for plan, slots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                of = {s["slot"]: Slot(s["pages"], s["chars"], s["linked"], s["distinct"], tuple(s["constant"] or ())) for s in slots or ()}
                made.append(json.dumps(verdicts(json.loads(plan), of), ensure_ascii=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["host", "verdicts"])

    made = work.put(plans.join(known, "host", "left").mapInArrow(judged, "host string, verdicts string"), "verdicts")
    work.drop("plans", "counts", "slots")
    return made


def main_text(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``pages`` (all columns but the html) with ``text``, the main text of each page; a text column of the input is replaced."""
    ship(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))
    keep = [c for c in pages.columns if c not in (source, "text")]
    rows = pages.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(keep)], F.col(source).alias("html"), host.alias("host"))
    known = host_verdicts(rows, Workspace(pages.sparkSession, "wrappers"))
    beside = rows.join(known, "host", "left").select(*[f"_c{i}" for i in range(len(keep))], "verdicts", "html")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(keep)
        read = lru_cache(64)(lambda w: json.loads(w) if w else [])
        for batch in batches:
            made = [extract(parse(h.as_py()), read(w)) if h.is_valid else "" for w, h in
                    zip(batch.column(n).to_pylist(), batch.column(n + 1), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(made, pa.string())], names=[*batch.schema.names[:n], "text"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in beside.schema if f.name.startswith("_c")]
    return beside.mapInArrow(texts, ", ".join([*fields, "text string"])).toDF(*keep, "text")
