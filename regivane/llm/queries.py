"""Queries opN_<name> over the driver tables, with production parameters, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regivane.llm import ann, bpe_codec, conversation_repair, embedding_dedup, html_text, language_id, media, near_dedup, packing, ranked_search, substring_dedup, token_counts, toxicity
from regivane.llm.common import documents, text_or_empty


def tokenizer_source(name: str) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


#: Rows and bytes that Spark hands to Python at once in these queries; operators bound what they make of them by themselves.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1024"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "2m")}


def application(query: Callable) -> Callable:
    """``query`` in a session whose Arrow batches are smaller, unless the session says otherwise than Spark.

    The operators never change a session; these queries are the application and own theirs.
    """

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        for key, (usual, few) in ARROW_LIMITS.items():
            if spark.conf.get(key) == usual:
                spark.conf.set(key, few)
        return query(spark, *args)

    return run


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each whose vec_id is divisible by 20, by inner product; unusable vectors take no part."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ann.search(table, F.col("vec_id") % 20 == 0)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every whole text and their decoding, as digests; null texts count as empty."""
    source = tokenizer_source("byte_bpe_50k.json")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    lexicon = bpe_codec.build_lexicon(docs, source)
    ids = bpe_codec.encode(docs, source, lexicon).select("doc_id", "ids")
    both = bpe_codec.decode(ids, source)
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of words that repeat an earlier document, of every whole text; rows without a doc_id take no part."""
    return substring_dedup.removals(documents(spark, sf_dir).select("doc_id", "text"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy tokens of every whole text; null texts have none."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer_source("byte_bpe_50k.json")).select("doc_id", "n_words", "n_tokens")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null pages have the empty text."""
    found = html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_lines", "n_shared")


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of all texts stored in archives as media, read back, with digests; null texts count as empty."""
    stored = media.store_and_read(documents(spark, sf_dir))
    # UTF-8 has no byte 255, so the filling can be told from the text
    hexed = F.regexp_replace(F.hex(F.substring("payload", -576, 576)), "(FF)*$", "")
    return stored.select(
        "doc_id",
        (F.length("payload") - F.least(F.length("payload"), F.lit(576)) + F.length(hexed) / 2).cast("bigint").alias("n_bytes"),
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"),
        F.length("media").cast("bigint").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
        "error",
    )


def crc_mod(column: str, n: int):
    """crc32 of a number's decimal text, modulo ``n``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def toxic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from; one row a document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod("doc_id", 5) != 0)
    return labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs.select("doc_id", "text").join(toxic_labels(spark, sf_dir), "doc_id"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from labelled rows that are not held out; empty texts too."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, sf_dir, docs))
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from rows that are not held out; ``und`` without a letter."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    models = language_id.train(docs, crc_mod("doc_id", 4) != 2)
    found = language_id.identify(docs.select("doc_id", "text"), models)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, tokenizer_source("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of 2048-token sequences of all documents; null texts count as empty, rows without a doc_id stay."""
    return packed_pieces(documents(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document; rows without a doc_id have none."""
    return near_dedup.classes(documents(spark, sf_dir).select("doc_id", "text"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of ``embeddings`` linked by a cosine of 0.93 inside their label: links, component and whether kept.

    Rows without a usable vector or a label come back with no link and as their own component.
    """
    return embedding_dedup.classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of each ``benchmark`` item, by exact integer scores, equal ones by doc_id.

    Items and documents without a term find and are nothing; null texts have none.
    """
    index = ranked_search.build_index(documents(spark, sf_dir))
    return ranked_search.search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every damaged conversation of ``conversations``.

    Nulls count as one space; conversations without a row after the damage give zeros.
    """
    return conversation_repair.damage_and_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


EMBEDDING_DEDUP_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), usable AS (
    SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS length FROM vectors
    WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE a.length > 0 AND b.length > 0 AND list_inner_product(a.v, b.v) / (a.length * b.length) >= 0.93
), reached AS (
    SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), counted AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
), least AS (
    SELECT a AS vec_id, min(b) AS least FROM reached GROUP BY a
)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id <= coalesce(least, vec_id) AS kept
FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN least USING (vec_id)
"""

_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH_SQL = f"""
WITH tokens AS (
    SELECT doc_id, unnest({_TERMS}) AS term FROM documents
), postings AS (
    SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY doc_id, term
), lengths AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id
), totals AS (
    SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM lengths
), relative AS (
    SELECT doc_id, 100 - 90 + (90 * n * documents) // tokens AS m FROM lengths, totals
), asked AS (
    SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
), weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * documents + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, documents
), scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN relative USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

_ALL = [op1_ann, op2_bpe_codec, op3_substring_dedup, op4_token_counts, op5_html_text, op6_toxicity, op7_media, op8_language_id, op9_packing, op10_near_dedup, op11_embedding_dedup, op12_ranked_search, op13_conversation_repair]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.__name__: application(q) for q in _ALL}

ORACLES: dict[str, str] = {"op11_embedding_dedup": EMBEDDING_DEDUP_SQL, "op12_ranked_search": RANKED_SEARCH_SQL}
