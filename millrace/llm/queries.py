"""The operators on the generated tables, each over whole tables with its production parameters, and SQL where it can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (bpe_codec, compression, divergence, fingerprints, language, masked_search, mixing, near_dups, secret_scan, token_counts, topk, toxicity,
                          wrappers)
from millrace.llm.runtime import is_held_out, table

CODEC = "byte_bpe_multi_50k.tiktoken"
COUNTED = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = wrappers.main_text(table(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op4_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"))


def op5_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe_codec.encode_digests(docs, public_tokenizers.path(CODEC), public_tokenizers.PATTERN)


def op6_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(COUNTED))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.components(table(spark, folder, "documents"), width=4, percent=80)


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_spans(table(spark, folder, "documents").select("doc_id", "text"))
    counts = [secret_scan.count_of(F.col("base_spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secret_scan.shown(F.col("base_spans")), 256).alias("base_sha256"), secret_scan.shown(F.col("spans")).alias("spans"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.identify(docs, language.train(docs))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    found = compression.quality(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "verdict", "ratio")


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_masked_search(spark: SparkSession, folder: str) -> DataFrame:
    return masked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {q.__name__: q for q in (op1_fingerprints, op2_toxicity, op3_main_text, op4_top_products, op5_bpe_round_trip, op6_temperature_mix,
                                   op7_token_counts, op8_near_dups, op9_secrets, op10_language, op11_compression_bands, op12_source_divergence,
                                   op13_masked_search)}

_TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
     c AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v),
     q AS (SELECT * FROM c WHERE vec_id % 50 = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score FROM q JOIN c USING (i) WHERE q.vec_id <> c.vec_id GROUP BY ALL),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_NEAR = r"""
WITH RECURSIVE w AS (
       SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
     e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
     g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
     r(d, t) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.d, g.b FROM r JOIN g ON g.a = r.t),
     c AS (SELECT d, min(t) AS component_id FROM r GROUP BY d)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c ON d = doc_id LEFT JOIN n USING (doc_id)
"""


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _located_sql(name: str, pattern: str, group: int = 0, least: int = 0) -> str:
    """(doc_id, start, end, hit) of the matches of a pattern, from the lengths of gaps and matches."""
    p = _literal(pattern)
    return f"""
     {name}_m AS (SELECT doc_id, regexp_split_to_array(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS hits, regexp_extract_all(t, {p}, {group}) AS sized
                  FROM d WHERE regexp_matches(t, {p})),
     {name}_x AS (SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(sized) AS sized FROM {name}_m),
     {name}_y AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM {name}_x),
     {name} AS (SELECT doc_id, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop, hit FROM {name}_y WHERE length(sized) >= {least})"""


_SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),{_located_sql('m_assign', secret_scan.ASSIGN, 2, 8)},{_located_sql('m_access', secret_scan.ACCESS)},{
    _located_sql('m_hex', secret_scan.HEX)},{_located_sql('runs', secret_scan.CANDIDATE)},{_located_sql('parts', secret_scan.PART)},
     base AS (SELECT doc_id, start, 0 AS o, stop, 'assign' AS kind FROM m_assign UNION ALL SELECT doc_id, start, 1, stop, 'access' FROM m_access
              UNION ALL SELECT doc_id, start, 2, stop, 'hex' FROM m_hex),
     found AS (SELECT doc_id, start, stop, hit, CASE WHEN regexp_matches(hit, '[+/_=-]') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')
                 THEN 'b64key' END AS kind FROM runs
               UNION ALL SELECT doc_id, start, stop, hit, CASE WHEN regexp_matches(hit, '[0-9]') THEN CASE WHEN regexp_matches(hit, '^([0-9a-f]+|[0-9A-F]+)$') THEN 'hexkey'
                   WHEN regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') THEN CASE WHEN regexp_matches(hit, '^[0-9a-fA-F]+$') THEN 'hexmixed' ELSE 'b64key' END
                   WHEN regexp_matches(hit, '[a-z]') THEN 'base36' WHEN regexp_matches(hit, '[A-Z]') THEN 'base32' ELSE 'onecase' END
                 WHEN regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]') THEN 'letters' ELSE 'onecase' END FROM parts),
     classed AS (SELECT * FROM found r WHERE kind IS NOT NULL AND NOT regexp_matches(hit, {_literal(secret_scan.ALLOWED.replace('(?i)abcdefghij|example|placeholder|changeme|xxxxxx|dummy', '(?i:abcdefghij|example|placeholder|changeme|xxxxxx|dummy)'))})
                 AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start <= r.start AND r.stop <= b.stop)),
     limits(kind, o, bits, folded) AS (VALUES {', '.join(f"('{k}', {secret_scan.KINDS.index(k)}, {v}, {k in secret_scan._FOLDED})" for k, v in secret_scan.THRESHOLDS.items())}),
     windows AS (SELECT doc_id, start, stop, kind, o, bits, i, substring(CASE WHEN folded THEN lower(hit) ELSE hit END, i::INT + 1, {secret_scan.WINDOW}) AS w
                 FROM (SELECT *, unnest(range(length(hit) - {secret_scan.WINDOW - 1})) AS i FROM classed) JOIN limits USING (kind)),
     hot AS (SELECT * FROM windows
             WHERE list_sum(list_transform(list_distinct(string_split(w, '')), lambda c: (length(w) - length(replace(w, c, ''))) * log2(length(w) - length(replace(w, c, '')))))
                   <= {secret_scan.WINDOW} * (log2({secret_scan.WINDOW}) - bits) + 1e-9),
     more AS (SELECT DISTINCT doc_id, first, o, last, kind FROM (SELECT doc_id, start + min(i) AS first, o, start + max(i) + {secret_scan.WINDOW} AS last, kind
              FROM hot GROUP BY doc_id, start, stop, o, kind)),
     shown AS (SELECT doc_id, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) FILTER (o < 3) AS base,
                      string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans,
                      count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex
               FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN shown USING (doc_id)
"""

_DIVERGENCE = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS row,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
           FROM documents),
     x AS (SELECT lang, source, row, unnest(t) AS term FROM d),
     keep AS (SELECT lang, term, count(*) AS total FROM x GROUP BY ALL HAVING count(DISTINCT row) >= 10),
     c AS (SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN keep USING (lang, term) GROUP BY ALL),
     size AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_n FROM keep GROUP BY lang),
     g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS group_n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
     p AS (SELECT g.lang, g.source, keep.term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 2)::HUGEINT) // (group_n + 2 * v) AS p,
                  1 + (1000000000 * (total + 2)::HUGEINT) // (lang_n + 2 * v) AS q
           FROM g JOIN keep USING (lang) JOIN size USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = keep.term),
     more AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
     apart AS (SELECT a.lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term)
               WHERE a.source <> b.source GROUP BY ALL),
     pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.other = b.source),
     r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM (SELECT * FROM more UNION ALL SELECT * FROM pair))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""

_RANKED = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
           FROM documents),
     s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
     x AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d),
     tf AS (SELECT doc_id, n, term, count(*) AS tf FROM x GROUP BY ALL),
     df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
     q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
           FROM benchmark),
     h AS (SELECT item_id, doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                                      * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
           FROM q JOIN df USING (term) JOIN tf USING (term), s GROUP BY ALL),
     r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM h WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""

SQL = {"op4_top_products": _TOP, "op8_near_dups": _NEAR, "op9_secrets": _SECRETS, "op12_source_divergence": _DIVERGENCE, "op13_masked_search": _RANKED}
