"""How far sources differ in their words, by count-level bitmaps.

Each language keeps the terms that enough of its documents hold.  A group is a source in
a language; its share of a term is ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``, and two
groups differ in a term by ``f(p, q) = floor((p - q)^2 / (p + q))``.

Kept terms of a language are numbered by falling frequency and lie in words of 64.  For
each group, word and count one bitset tells which of the 64 terms occur so often in the group;
AND and bit_count of two groups' bitsets give the cells of their joint counts, and each cell adds
its size times f.  Terms of count zero have no bitset: with n(c, d) the joint cells,
|c| and |d| the terms of a count in one group, and p0, q0 the shares of a count of zero,

    sum f = sum n(c, d) (f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)) + sum |c| (f(p, q0) - f(p0, q0)) + sum |d| (f(p0, q) - f(p0, q0)) + V f(p0, q0)

so that the zeros come by complement.  In a word, a group's bitsets are disjoint, so a pair of
groups has at most 64 cells that are not empty, and as neighbours in frequency share words, most
words have few counts.  Numbers of terms are long, shares are divided as decimals: all of it is exact.

Defined results: null text, language and source count as empty text; a group without kept
terms has shares of zero counts (V > 0) or values of 0 (V = 0); rows that repeat are documents
of their own; very long texts are counted in pieces; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, ship, slices
from millrace.llm.terms import LETTERS, term_lists

#: Documents of a language that must hold a term.
LEAST_DOCS = 10
#: Terms that are reported for each group.
TOP = 10
#: Entries that a task holds before it hands them on, and rows in an output batch.
HELD, ROWS = 500_000, 50_000
#: Bytes of text that are read at once.
BATCH = 1 << 20


def tallies(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, summed in each task as far as its memory goes."""
    ship(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "body"))])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for (name, group), (n, own) in held.items():
                terms = list(n)
                for at in range(0, len(terms), ROWS):
                    some = terms[at:at + ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some), pa.string()), pa.array([group] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()),
                         pa.array([n[t] for t in some], pa.int64()), pa.array([own[t] for t in some], pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for whole in parts:
            for part in slices(whole, "body", BATCH):
                for name, group, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    n, own = held.setdefault((name, group), (Counter(), Counter()))
                    before, found = len(n), set()
                    for terms in term_lists(body.as_buffer().to_pybytes(), LETTERS):
                        n.update(terms)
                        found.update(terms)
                    own.update(found)
                    size += len(n) - before
                if size > HELD:
                    yield from handed_on()
                    size = 0
        yield from handed_on()

    return rows.mapInArrow(batches, "lang string, source string, term string, n bigint, docs bigint")


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 vocabulary)), exact for any long."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)")
    return F.call_function("div", above, (total + 2 * vocabulary).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has each other source of the language, part ``term`` the ``top`` terms a group has more of."""
    work = Workspace(docs.sparkSession, "divergence")
    # one row for each kept term, with its count in each source; ids follow the frequency, so that equal counts share words
    summed = tallies(docs, text, lang, source).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = (summed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts"))
            .filter(F.col("docs") >= least_docs).drop("docs"))
    # written before it is dealt by range, as the sample for the ranges would count all terms once more
    terms = work.put(work.put(kept, "kept").repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions("lang", F.desc("total"), "term")
                     .withColumn("id", F.monotonically_increasing_id()), "terms")
    work.drop("kept")

    size = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    counts = terms.select("lang", "term", "id", "total", F.explode("counts").alias("x")).select("lang", "term", "id", "total", "x.source", "x.n")
    names = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    groups = names.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(size, "lang", "left")
    groups = work.put(groups.select("lang", "source", zero("group_n"), zero("lang_n"), zero("v"))
                      .withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0).cast("bigint"), F.col("group_n"), F.col("v")))), "groups")

    # ---- the terms a group has more of than its language
    known = counts.join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("group_n"), F.col("v")), share(F.col("total"), F.col("lang_n"), F.col("v"))
    more = known.select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    most = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # ---- pairs of groups: bitsets by count, written once as both sides of the join read them
    bits = known.select("lang", "source", F.shiftright("id", 6).alias("word"), "n", "p0", p.alias("p"), F.expr("shiftleft(1L, cast(id % 64 as int))").alias("bit"))
    sets = work.put(bits.repartition("lang", "word").groupBy("lang", "word", "source", "n", "p0", "p").agg(F.bit_or("bit").alias("mask")), "bitsets")
    a, b = (sets.select("lang", "word", *[F.col(c).alias(f"{c}_{s}") for c in ("source", "p0", "p", "mask")]) for s in "ab")
    cells = a.join(b, ["lang", "word"]).filter((F.col("source_a") < F.col("source_b")) & (F.col("mask_a").bitwiseAND(F.col("mask_b")) != 0))
    pa_, pb, a0, b0 = (F.col(c) for c in ("p_a", "p_b", "p0_a", "p0_b"))
    joint = cells.groupBy("lang", "source_a", "source_b").agg(F.sum(
        F.bit_count(F.col("mask_a").bitwiseAND(F.col("mask_b"))) * (distance(pa_, pb) - distance(pa_, b0) - distance(a0, pb) + distance(a0, b0))).alias("value"))

    levels = sets.groupBy("lang", "source", "p0", "p").agg(F.sum(F.bit_count("mask")).alias("size"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other0"))
    beside = levels.join(others, "lang").filter(F.col("source") != F.col("other")).groupBy("lang", "source", "other").agg(
        F.sum(F.col("size") * (distance(F.col("p"), F.col("other0")) - distance(F.col("p0"), F.col("other0")))).alias("value"))
    beside = beside.select("lang", F.least("source", "other").alias("source_a"), F.greatest("source", "other").alias("source_b"), "value")

    base = groups.join(others, "lang").filter(F.col("source") < F.col("other")).select(
        "lang", F.col("source").alias("source_a"), F.col("other").alias("source_b"),
        F.when(F.col("v") > 0, F.col("v") * distance(F.col("p0"), F.col("other0"))).otherwise(F.lit(0).cast("bigint")).alias("value"))
    pairs = base.unionByName(joint).unionByName(beside).groupBy("lang", "source_a", "source_b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")), F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    apart = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value").withColumn("rank", F.row_number().over(order))

    columns = lambda part, df: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns("pair", apart).unionByName(columns("term", most))
