"""Corpus pipeline: toxicity, language, near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; its
result is written as Parquet and read again as the next one's docs.  All but the last return
the columns of ``documents``.

Defined results: rows with null text count as empty: they are not toxic, have no language and
so go with the second stage; rows that repeat a document, id and text, are reduced to one by the third, and different texts
under one id stay as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane.llm import language_id, near_dedup, queries, substring_dedup, toxicity
from regivane.llm.common import documents, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half."""
    scored = toxicity.score(docs, queries.toxicity_model(spark, sf_dir, docs), out="__toxicity")
    return scored.where("__toxicity < 0.5").select(docs.columns)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; models learn from the documents at hand."""
    models = language_id.train(docs, queries.crc_mod("doc_id", 4) != 2)
    return language_id.identify(docs, models, prefix="__").where("NOT __rejected").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return near_dedup.keep_one(docs).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text.

    Different texts under one id are documents of their own, as in the stage before.
    """
    if near_dedup.has_repeated_ids(docs):
        rows = materialise(near_dedup.numbered_texts(docs), "numbered-texts")
        cut = substring_dedup.remove(rows, substring_dedup.removals(rows, doc_id="__row"), doc_id="__row")
    else:
        cut = substring_dedup.remove(docs, substring_dedup.removals(docs))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences."""
    return queries.packed_pieces(docs)


STAGES = [
    ("toxicity", queries.application(drop_toxic)),
    ("language_id", queries.application(drop_unidentified)),
    ("near_dedup", queries.application(drop_near_duplicates)),
    ("substring_dedup", queries.application(cut_repeats)),
    ("packing", queries.application(pack_tokens)),
]

#: No stage can be expressed in SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
