"""Compression bands, source divergence and masked search against brute force, and their edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import compression, divergence, masked_search, queries
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, verdict string, n bigint, term string, _body string, item bigint"
LONG = "word other Third " * 200_000
EDGE = [None, "", " \n\t", "a", "A b  C", "word " * 3000, "x" * 5000, "é ✓ 😀 ü", "a\nb\na\n\n\nb\n", LONG]


@pytest.fixture(scope="module")
def edge(spark):
    """Edge texts, a very long one, repeated rows, nulls in every column, extra columns whose names clash."""
    rows = [(i, t, "en", "s", "mine", i, "t", "b", i) for i, t in enumerate(EDGE)]
    return spark.createDataFrame([*rows, rows[4], rows[4], (None, "loose text here", *[None] * 7), (11, None, "en", None, *[None] * 5)], DOCS)


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


# ---- compression bands


def test_quality_by_brute_force(spark):
    got = {r.doc_id: r for r in queries.op11_compression_bands(spark, SMALL).collect()}
    rows = documents(spark)
    assert len(got) == len(rows)
    for key, text in rows:
        want = brute.word_counts(text)
        r = got[key]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and brute.band_verdict((text or "").encode(), compression.BANDS, compression.CHUNK, compression.FIFTH))


@pytest.mark.parametrize("text", ["a b c d e f g h " * 2, "a a a a a a a a a", "a b c d e f g", "x y " * 30 + "end", "", "A a A a A a A a a A a A a A a A a"])
def test_repeated_words(text):
    found = compression.measured([text.encode(), b"a b c d e f g h", text.encode()], zstandard.ZstdCompressor())
    assert found["n_repeat_words"] == [brute.word_counts(text)[4], 0, brute.word_counts(text)[4]]


def test_random_texts_have_the_same_repeats():
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(200)]
    found = compression.measured([t.encode() for t in texts], zstandard.ZstdCompressor())
    assert found["n_repeat_words"] == [brute.word_counts(t)[4] for t in texts]


def test_bands():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("etaoinshrdlucmfw") for _ in range(rng.randint(2, 9)))
    vocabulary = [word() for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).encode()
    noise = rng.randbytes(200_000)
    verdict = lambda data: compression.ratios(data, zstandard.ZstdCompressor(level=compression.LEVEL))[-1]
    assert {verdict(prose(n)) for n in (20, 60, 200, 1000, 5000, 30_000)} == {"ok"}
    assert {verdict(b"the same words again " * n) for n in (20, 100, 1000)} == {"repetitive"}
    assert verdict(noise) == "incompressible" and verdict(prose(6000) + noise[:20_000]).startswith("incompressible")
    # a long prose with a repeated part is told by its chunks
    assert verdict(prose(6000) + b"again and " * 3000).startswith("repetitive")
    assert compression.band(0)[1] == math.inf and compression.band(10**9) == compression.BANDS[-1][1:]


def test_quality_edges(spark, edge):
    found = compression.quality(edge)
    assert set(found.columns) == {*edge.columns, *compression.FIELDS} and len(found.columns) == len(set(found.columns))
    got = found.collect()
    assert len(got) == edge.count()
    by = {r.doc_id: r for r in got}
    assert all(by[k].base_failed and not by[k].kept and by[k].n_words == 0 and by[k].ratio == 0 for k in (0, 1, 11))
    assert by[2].n_words == 0 and by[8].n_dup_lines == 2 and by[7].word_chars == 4
    assert by[9].n_words == 600_000 == by[9].n_repeat_words and by[9].text == LONG and by[9]._body == "b" and by[4].verdict != "mine"
    assert compression.quality(edge.limit(0)).collect() == []
    assert compression.without_poor(edge).columns == edge.columns and compression.without_poor(edge).count() == 0


# ---- divergence


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r.rank) for r in df.collect())


def test_divergence_by_brute_force(spark):
    rng = random.Random(8)
    terms = ["alpha", "beta", "gamma", "delta", "école", "z", "Ω", *(f"t{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}" for i in range(100))]
    rows = [(i, " ".join(rng.choice(terms) * rng.choice([1, 1, 2]) if rng.random() < .1 else rng.choice(terms[:rng.choice([5, 107])]) for _ in range(rng.randint(0, 60))).upper(),
             rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "d", None])) for i in range(300)] + [(300, None, "xx", "one"), (301, "12 3", "xx", "two"), (302, "rare", "yy", "only")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert rows_of(divergence.audit(df)) == brute.divergence(rows)


def test_divergence_edges(spark, edge):
    got = rows_of(divergence.audit(edge))
    assert got == brute.divergence([(r.doc_id, r.text, r.lang, r.source) for r in edge.collect()])
    assert {(r[0], r[1], r[3]) for r in got} == {("en", "s", ""), ("en", "", "s")}  # a lang with one source has no pair, no term is in ten documents
    assert rows_of(divergence.audit(edge, least_docs=1)) == brute.divergence([(r.doc_id, r.text, r.lang, r.source) for r in edge.collect()], least=1)
    assert divergence.audit(edge.limit(0)).collect() == []


def test_divergence_is_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    row = spark.range(1).select(divergence.share(F.lit(big), F.lit(4 * 10**12), F.lit(1000)).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (4 * 10**12 + 2000)


def test_divergence_tallies(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = divergence.tallies(docs, "text", "lang", "source").groupBy("term").sum("n", "docs").collect()
    want, own = Counter(), Counter()
    for _, text in documents(spark):
        terms = brute.terms(text, digits=False)
        want.update(terms)
        own.update(set(terms))
    assert {r[0]: (r[1], r[2]) for r in found} == {t: (n, own[t]) for t, n in want.items()}


# ---- masked search


def test_search_by_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(90)]
    docs = [(i, " ".join(rng.choice(words[:rng.choice([10, 90])]) for _ in range(rng.randint(0, 80))).title()) for i in range(500)]
    docs += [(500 + i, docs[i][1]) for i in range(100)]  # copies: equal scores
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 80, 200])))) for i in range(25)]
    got = masked_search.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(tuple(r) for r in got.collect()) == brute.search(docs, items)


def test_search_in_several_query_blocks_and_document_blocks(spark, monkeypatch):
    monkeypatch.setattr(masked_search, "BLOCK_TERMS", 40)
    docs, items = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    got = masked_search.search(docs, items)
    want = brute.search(documents(spark), [(r.item_id, r.text) for r in items.collect()])
    assert sorted(tuple(r) for r in got.collect()) == want


def test_masks_stop_early():
    """A document with all terms of a query lets the masks of few terms go without being evaluated."""
    import pyarrow as pa
    rng = random.Random(1)
    names = [f"t{i}" for i in range(30)]
    held = [names] * 3 + [rng.sample(names, 4) for _ in range(2000)]
    part = pa.RecordBatch.from_arrays([pa.array(range(len(held))), pa.array([len(h) for h in held]), pa.array(held), pa.array([[1] * len(h) for h in held])], names=["doc_id", "n", "terms", "counts"])
    docs = masked_search.Documents(part, {t: i for i, t in enumerate(names)}, len(held), sum(map(len, held)))
    best = masked_search.Best(3)
    done = docs.search(np.arange(30), np.full(30, 1000), best, np.zeros(30, np.int64))
    assert [r[2] for r in best.rows] == [0, 1, 2] and done < 20


def test_search_edges(spark, edge):
    items = spark.createDataFrame([(1, "word x"), (1, "word x"), (1, "loose"), (None, "TEXT here"), (2, None), (3, ""), (4, "absent"), (5, "word " * 50_000), (6, "😀 é")],
                                  "item_id bigint, text string")
    got = masked_search.search(edge, items).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = brute.search(rows, [(1, "word x"), (1, "loose"), (None, "TEXT here"), (5, "word " * 50_000), (6, "😀 é")])
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key) and {r.item_id for r in got} == {1, None, 5, 6}
    assert masked_search.search(edge.limit(0), items).collect() == [] and masked_search.search(edge, items.limit(0)).collect() == []


def test_terms_match_the_patterns(spark):
    from millrace.llm.terms import LETTERS, LETTERS_AND_DIGITS, count_terms, pieces
    for text in [t for _, t in documents(spark)][:50] + [t for t in EDGE if t] + ["".join(map(chr, range(1, 0x250)))]:
        for kept, digits in ((LETTERS, False), (LETTERS_AND_DIGITS, True)):
            assert {k.decode(): n for k, n in count_terms(text.encode(), kept).items()} == Counter(brute.terms(text, digits))
    assert b"".join(pieces(LONG.encode(), 1000)) == LONG.encode() and max(map(len, pieces(LONG.encode(), 1000))) < 1010
