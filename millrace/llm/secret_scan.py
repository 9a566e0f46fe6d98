"""Secrets in texts: fixed shapes and windows of high entropy, by DataFrame functions only.

Base spans are the shapes ``assign``, ``access`` and ``hex``.  Further candidates are of
two sorts, each of at least one window: runs of key characters with a separator
(``+/_=-``) in them, which are ``b64key`` if they have lower and upper letters and digits, and
parts, runs of letters and digits only, of a class each: ``hexkey`` (hexadecimal digits in one
case with a digit), ``hexmixed``, ``b64key`` (lower, upper, digits), ``base36`` (lower, digits),
``base32`` (upper, digits), ``letters`` of both cases and ``onecase`` letters.  A candidate is
scanned by a window of fixed length: the step to the next window takes one character out of the
class's counts and puts one in, and moves the sum of c * log2(c) by just those two
terms, so entropy = log2(W) - sum / W.  The counts are one character each in a text of the
alphabet's length, so a step replaces two characters of it.  The span goes from the first to the last
window at or above the class's threshold.  A candidate is suppressed if it matches the allow
list itself, so an example in a path hides nothing beside it, or lies inside a base span.
The thresholds are those that about one random token of 40 characters in a hundred does not
reach, for ``onecase`` four, as words come near it.

Positions are code points, end exclusive.  They come from the lengths of what stands
between matches (split) and of the matches (extract), as no function gives them, by running
sums.  Running sums and maxima are made in blocks of the root of the length, so a
text with very many matches costs little more than its length.

Defined results: a null text counts as empty and has no spans; spans that share a
start are in the order of KINDS; equal spans appear once; very long texts are read whole; rows that repeat give
equal rows; an empty table gives an empty one; other columns stay, those named ``base_spans`` and ``spans`` are replaced by
``find_spans``, and no column is by ``redact``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "hexkey", "b64key", "hexmixed", "base36", "base32", "letters", "onecase"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
#: Characters in a window, and bits a character at which a window counts, by class.
WINDOW = 24
THRESHOLDS = {"hexkey": 3.0, "b64key": 4.0, "hexmixed": 3.55, "base36": 3.85, "base32": 3.8, "letters": 4.05, "onecase": 3.75}
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: What stands between separators.
PART = f"[A-Za-z0-9]{{{WINDOW},}}"
#: Runs that are no secrets: UUIDs, digits only, counting sequences, marked examples, dashed or underscored rules.
ALLOWED = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[0-9]+$|0123456789|(?i)abcdefghij|example|placeholder|changeme|xxxxxx|dummy"
           r"|[-_=]{4}")
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_ALPHABET = {"hexkey": "0123456789abcdef", "b64key": "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "+/_=-",
             "hexmixed": "0123456789abcdefABCDEF", "base36": "0123456789" + _LOWER, "base32": "0123456789" + _LOWER, "letters": _LOWER + _LOWER.upper(), "onecase": _LOWER}
#: Classes of one case, counted in lower case.
_FOLDED = frozenset(["hexkey", "base32", "onecase"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """What ``combine`` (with 0 as its start) makes of each number and all before it."""
    none = F.array().cast("array<int>")

    def scan(row: Column, start: Column) -> Column:
        return F.aggregate(row, start, lambda done, x: F.concat(done, F.array(combine(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)), x))))

    def joined(rows: Column) -> Column:
        before = scan(F.transform(rows, lambda r: F.element_at(r, -1)), F.array(F.lit(0)))
        return F.flatten(F.zip_with(rows, F.slice(before, 1, F.size(rows)), lambda r, b: F.transform(r, lambda x: combine(x, b))))

    def blocks(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        rows = F.transform(F.sequence(F.lit(1), F.size(v), width), lambda first: scan(F.slice(v, first, width), none))
        return F.when(F.size(v) > 0, _let(rows, joined)).otherwise(none)

    return _let(values, blocks)


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _located(text: Column, pattern: str, quick: str, keep: tuple[int, int] | None = None) -> Column:
    """Array of (start, end, hit) of the leftmost non-overlapping matches.

    ``quick`` is a cheaper pattern that any text with a match has.  ``keep`` is a
    group and the least length of it.
    """
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(keep[0])) if keep else hits
    least = keep[1] if keep else 0
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def placed(steps: Column) -> Column:
        ends = _running(F.transform(steps, lambda x: F.char_length(x["gap"]) + F.coalesce(F.char_length(x["hit"]), F.lit(0))), _plus)
        good = F.filter(F.zip_with(steps, ends, lambda x, end: F.struct(x.alias("x"), end.alias("end"))),
                        lambda s: s["x"]["hit"].isNotNull() & (F.char_length(s["x"]["sized"]) >= least))
        return F.transform(good, lambda s: F.struct((s["end"] - F.char_length(s["x"]["hit"])).alias("start"), s["end"].alias("end"), s["x"]["hit"].alias("hit")))

    found = _let(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), sized.alias("sized")), placed)
    return F.when(text.rlike(quick), found).otherwise(empty)


def _weight(c: Column) -> Column:
    return F.element_at(F.lit([0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]), c + 1)


def _hot_windows(hit: Column, kind: str) -> Column:
    """Start of the first and end of the last window at or above the threshold, in the run; -1 if none."""
    letters = _ALPHABET[kind]
    codes = F.transform(F.split(F.lower(hit) if kind in _FOLDED else hit, ""), lambda c: F.instr(F.lit(letters), c))
    most = WINDOW * (math.log2(WINDOW) - THRESHOLDS[kind]) + 1e-9  # the sum of c * log2(c) may be this high
    zero = ord("A")  # a count is the character so far behind it

    def count(counts: Column, code: Column) -> Column:
        return F.ascii(F.substring(counts, code, F.lit(1))) - zero

    def moved(counts: Column, code: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + zero), code, F.lit(1))

    def step(state: Column, x: Column) -> Column:
        entering, leaving, i = x["entering"], x["leaving"], state["i"] + 1
        counts, same = state["counts"], entering == leaving
        gone = F.when(leaving > 0, count(counts, leaving)).otherwise(0)
        come = count(counts, entering)
        more = F.when(same, F.lit(0.0)).otherwise(
            _weight(come + 1) - _weight(come) + F.when(leaving > 0, _weight(gone - 1) - _weight(gone)).otherwise(0.0))
        total = state["total"] + more
        put = moved(counts, entering, come + 1)
        new = F.when(same, counts).when(leaving > 0, moved(put, leaving, gone - 1)).otherwise(put)
        hot = (i >= WINDOW) & (total <= most)
        return F.struct(i.alias("i"), new.alias("counts"), total.alias("total"),
                        F.when(hot & (state["first"] < 0), i - WINDOW).otherwise(state["first"]).alias("first"),
                        F.when(hot, i).otherwise(state["last"]).alias("last"))

    start = F.struct(F.lit(0).alias("i"), F.lit(chr(zero) * len(letters)).alias("counts"), F.lit(0.0).alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

    def scanned(c: Column) -> Column:
        # each place with the character that leaves the window as it enters, so that a run is read once whatever its length
        behind = F.concat(F.array_repeat(F.lit(0), WINDOW), F.slice(c, 1, F.size(c) - WINDOW))
        return F.aggregate(F.arrays_zip(c.alias("entering"), behind.alias("leaving")), start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return _let(codes, scanned)


def _outside(found: Column, base: Column) -> Column:
    """Those of the located candidates that lie inside no base span: no span that starts before them reaches their end."""
    entry = lambda r, order, reach: F.struct(r["start"].alias("start"), F.lit(order).alias("order"), r["end"].alias("end"), reach.alias("reach"), r["hit"].alias("hit"))
    both = F.array_sort(F.concat(F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("order"), b["end"].alias("end"), b["end"].alias("reach"),
                                                                      F.lit("").alias("hit"))), F.transform(found, lambda r: entry(r, 1, F.lit(0)))))

    def free(sides: Column) -> Column:
        reach = _running(F.transform(sides, lambda s: s["reach"]), _most)
        return F.transform(F.filter(F.zip_with(sides, reach, lambda s, r: F.struct(s.alias("s"), r.alias("r"))), lambda x: (x["s"]["order"] == 1) & (x["s"]["end"] > x["r"])),
                           lambda x: x["s"])

    return F.when(F.size(base) == 0, F.transform(found, lambda r: entry(r, 1, F.lit(0)))).otherwise(_let(both, free))


def _scanned(found: Column, base: Column, class_of: Callable[[Column], Column], kinds: Sequence[str]) -> Column:
    """Spans of the candidates that are neither allowed nor inside a base span, each by its class."""
    classed = F.transform(F.filter(_outside(found, base), lambda r: ~r["hit"].rlike(ALLOWED)),
                          lambda r: F.struct(r["start"].alias("start"), r["hit"].alias("hit"), class_of(r["hit"]).alias("kind")))

    def spans(own: Column, kind: str) -> Column:
        windows = F.transform(F.filter(own, lambda r: r["kind"] == kind), lambda r: F.struct(r["start"].alias("at"), _hot_windows(r["hit"], kind).alias("w")))
        return F.transform(F.filter(windows, lambda s: s["w"]["first"] >= 0), lambda s: _span(kind, s["at"] + s["w"]["first"], s["at"] + s["w"]["last"]))

    return _let(classed, lambda own: F.concat(*[spans(own, k) for k in kinds]))


def run_spans(text: Column, base: Column) -> Column:
    """Spans of the runs with a separator and all of lower, upper and digits."""
    mixed = lambda h: h.rlike("[+/_=-]") & h.rlike("[0-9]") & h.rlike("[a-z]") & h.rlike("[A-Z]")
    return _scanned(_located(text, CANDIDATE, CANDIDATE), base, lambda h: F.when(mixed(h), "b64key"), ["b64key"])


def part_spans(text: Column, base: Column) -> Column:
    """Spans of the parts between separators, of each by its class."""
    def class_of(h: Column) -> Column:
        digit, lower, upper = (h.rlike(p) for p in ("[0-9]", "[a-z]", "[A-Z]"))
        return (F.when(digit & h.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hexkey").when(digit & lower & upper & h.rlike("^[0-9a-fA-F]+$"), "hexmixed")
                .when(digit & lower & upper, "b64key").when(digit & lower, "base36").when(digit & upper, "base32").when(lower & upper, "letters").otherwise("onecase"))

    return _scanned(_located(text, PART, PART), base, class_of, list(THRESHOLDS))


def _once(ordered: Column) -> Column:
    """Without those equal to the one before."""
    return F.filter(ordered, lambda x, i: ~x.eqNullSafe(F.get(ordered, i - 1)))


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("order"), end.alias("end"), F.lit(kind).alias("kind"))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, order, end, kind) by start, then kind; columns of those names are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    named = lambda kind, found: F.transform(found, lambda r: _span(kind, r["start"], r["end"]))
    base = F.array_sort(F.concat(
        named("assign", _located(body, ASSIGN, "(?i:password|passwd|secret|token|api_?key)", (2, 8))),
        named("access", _located(body, ACCESS, ACCESS)),
        named("hex", _located(body, HEX, HEX))))
    rest = docs.drop("base_spans", "spans").withColumn("base_spans", base)
    more = F.when(body.rlike(CANDIDATE), F.concat(run_spans(body, F.col("base_spans")), part_spans(body, F.col("base_spans"))))
    return rest.withColumn("spans", F.when(more.isNull(), F.col("base_spans")).otherwise(_let(F.array_sort(F.concat("base_spans", more)), _once)))


def shown(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


#: Characters in a block of a text that is cut.
_BLOCK = 4096


def _between(blocks: Column, a: Column, b: Column) -> Column:
    """The text from place a to place b, of a text in blocks."""
    first, last = F.floor(a / _BLOCK).cast("int"), F.floor(b / _BLOCK).cast("int")
    block = lambda k: F.coalesce(F.try_element_at(blocks, k + 1), F.lit(""))
    inner = F.concat(F.substring(block(first), a % _BLOCK + 1, F.lit(_BLOCK)), F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                     F.substring(block(last), F.lit(1), b % _BLOCK))
    return F.when(first == last, F.substring(block(first), a % _BLOCK + 1, b - a)).otherwise(inner)


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of overlapping or touching spans replaced by ``mark``; texts without spans and null texts stay as they are."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    found = find_spans(docs.select(*[F.col(f"`{c}`").alias(k) for c, k in names.items()]), names[text])
    body = F.col(names[text])

    def cut(spans: Column) -> Column:
        reach = _running(F.transform(spans, lambda s: s["end"]), _most)
        behind = F.concat(F.array(F.lit(-1)), F.slice(reach, 1, F.size(spans) - 1))
        # a stretch starts where no earlier span reaches; the text before it goes back to where they end
        starts = F.filter(F.zip_with(spans, behind, lambda s, r: F.struct(r.alias("at"), s["start"].alias("start"))), lambda s: s["start"] > s["at"])
        tail = F.element_at(reach, -1)
        return _let(F.regexp_extract_all(body, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)), lambda blocks: F.concat(
            F.array_join(F.transform(starts, lambda s: F.concat(_between(blocks, F.greatest(s["at"], F.lit(0)), s["start"]), F.lit(mark))), ""),
            _between(blocks, tail, F.char_length(body))))

    made = found.withColumn(names[text], F.when(F.size("spans") > 0, _let(F.col("spans"), cut)).otherwise(body))
    return made.select(*[F.col(k).alias(c) for c, k in names.items()])
