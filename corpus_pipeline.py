"""A corpus pipeline of the operators in lattica.llm: documents in, tokenized mix out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lattica.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from lattica.llm.common import release, small_batches, stage, staged, table
from lattica.llm.queries import vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language can be told: null texts and texts without a letter.

    The others stay, also where no language could be learned (no labels, say).
    """
    small_batches(spark)
    model = language_id.fit(docs, language_id.bucket("doc_id", 5) != 0)
    found = language_id.predict(docs, model, carry=tuple(docs.columns), lettered=True)
    return found.select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest identifier stays."""
    small_batches(spark)
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8 the one with the smallest identifier stays."""
    small_batches(spark)
    return near_dedup.drop_near_copies(docs, percent=80, width=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source as often as its weight asks, up to twice; a document taken twice is two rows. A table has no order, so none is made."""
    return mixing.mix(docs, ordered=False)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document that the mix has, with its token ids, their digest and that of what they decode to, instead of its text."""
    small_batches(spark)
    return byte_bpe.round_trip(docs, vocabulary("byte_bpe_50k.json"), carry=("lang", "source"), ids=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("byte_bpe", tokenize),
]

#: Near-duplicate links and byte-pair encoding have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before it wrote. Rows: doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256, ids.

    Null columns and identifiers, repeated rows and further columns are
    treated as each stage's docstring says; an empty table gives an empty result. Of the tables written on the way only
    the last is left.
    """
    docs, mine = table(spark, sf_dir, "documents"), staged()
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
        release(spark, docs, mine)
    return docs
