"""From raw documents to token ids: toxic documents go, one of each group of near copies stays, secrets are masked, sources are mixed, texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and gives it to the next stage.  All stages but the last
keep the columns of documents.  Rows of the mix may repeat a document, as often as its
source needs.

Defined results: a stage given an empty table returns an empty one; extra columns stay, whatever their
names; a null text counts as empty: it is scored, in no group, has no secrets, no tokens and no ids; rows that
repeat another are judged as that one, and near copies keep the rows of the smallest key; rows without a key stay.
"""

from __future__ import annotations

from itertools import count

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe_codec, mixing, near_dups, secret_scan, toxicity
from millrace.llm.runtime import Workspace, table

CODEC = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is below 0.5, learned from the labelled rows among them that are not held out."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; five-word shingles, similarity 0.8."""
    return near_dups.first_of_each_group(docs, width=5, percent=80)


def _unused(docs: DataFrame, stem: str) -> str:
    return next(name for name in map(f"_{stem}{{}}".format, count()) if name not in docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets replaced by a mark; n_chars follows where a text changed."""
    before = _unused(docs, "text")
    after = secret_scan.redact(docs.withColumn(before, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    kind = docs.schema["n_chars"].dataType
    return after.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))).select(*[f"`{c}`" for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest mix that uses every document and repeats no source more than twice, in the order of the permutation."""
    # columns that the mix would replace go under other names meanwhile
    names = {c: _unused(docs, c) for c in docs.columns if c in ("copy", "n_tokens", "weight", "place")}
    used = mixing.mix(docs.withColumnsRenamed(names), limit=2.0).repartitionByRange("place").sortWithinPartitions("place")
    return used.drop("copy", "n_tokens", "weight", "place").withColumnsRenamed({k: c for c, k in names.items()}).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids_sha256, decoded_sha256 and ids of each row's text."""
    path, pattern = public_tokenizers.path(CODEC), public_tokenizers.PATTERN
    return bpe_codec.encode_all(docs.select("doc_id", "source", "lang", "text"), path, pattern)


STAGES = [("drop_toxic", drop_toxic), ("drop_near_copies", drop_near_copies), ("mask_secrets", mask_secrets), ("mix_sources", mix_sources),
          ("encode", encode)]

#: The trees of the first stage can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = work.put(stage(spark, docs, sf_dir), name)
        if i:
            work.drop(STAGES[i - 1][0])
    return docs
