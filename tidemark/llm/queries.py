"""One query for each operator, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, imatch, impact_search, langid, mixing, ngram_join, pii, quality_rules, ranked_search, repeats, spelling, toxicity, warc,
)
from tidemark.llm.common import crc32_mod, table
from tidemark.session import scratch_path

#: The tokenizer file of the encoding queries.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), n=3, percent=90)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER, keep=["doc_id"])


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents"), length=400, keep=["doc_id"], digest=True)


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_edited(table(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(F.col("doc_id"), 4, 2)
    network = langid.train(docs.where(~held_out))
    found = langid.identify(docs, network, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.resolved(warc.records(spark, path))
    return found.select(
        "page_id",
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        "refers_to",
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"), ["doc_id"], everywhere=True)


#: Slots of each source in a round: the largest source is held to a tenth, the curated ones count double.
MIXTURE = {"src0": 3, **{f"src{i}": 2 for i in range(1, 9)}, **{f"src{i}": 1 for i in range(9, 20)}}


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"), MIXTURE)


def _held_out(doc_id: Column, n: int, fold: int) -> Column:
    return F.coalesce(crc32_mod(doc_id, n) == fold, F.lit(False))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, forest, keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept", "anomaly")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Labels of two folds of three; the other one is held out."""
    labels = table(spark, sf_dir, "labels").where(~_held_out(F.col("doc_id"), 3, 1))
    return toxicity.train(table(spark, sf_dir, "documents"), labels)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir), keep=["doc_id"])
    return scored.select(
        "doc_id",
        _held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op12_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return impact_search.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents"), least_length=6, least=5, slips=199), times=5)


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_repeats": op5_repeats,
    "op6_imatch": op6_imatch,
    "op7_langid": op7_langid,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_search": op11_ranked_search,
    "op12_impact_search": op12_impact_search,
    "op13_spelling": op13_spelling,
}

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

#: SQL that DuckDB can run for the same rows; the other queries are tested against brute force.
ORACLES: dict[str, str] = {
    "op8_warc": """
        WITH p AS (
            SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), m AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original > page_id OR (original IS NOT NULL AND page_id IS NULL)
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original > page_id OR page_id IS NULL THEN original END AS refers_to
        FROM m
    """,
    "op11_ranked_search": f"""
        WITH words AS (
            SELECT doc_id, unnest({_TERMS}) AS term
            FROM documents
        ), lengths AS (
            SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
        ), total AS (
            SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM lengths
        ), asked AS (
            SELECT item_id, term, count(*) AS q FROM (
                SELECT item_id, unnest({_TERMS}) AS term
                FROM benchmark
            ) GROUP BY ALL
        ), postings AS (
            SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, total GROUP BY term
        ), gains AS (
            SELECT p.doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))) AS gain
            FROM postings p JOIN weights USING (term) JOIN lengths USING (doc_id), total
        ), scores AS (
            SELECT item_id, doc_id, CAST(sum(q * gain) AS BIGINT) AS score
            FROM asked JOIN gains USING (term) GROUP BY ALL
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scores WHERE score > 0
        QUALIFY rank <= 20
    """,
    "op12_impact_search": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM scores
        QUALIFY rank <= 20
    """,
}
