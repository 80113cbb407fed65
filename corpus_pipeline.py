"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; its result is
written and read again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexitally.llm import langid, linededup, minhash, packing
from lexitally.llm.shared import fresh, settle, table

# A document stays from this score of its language on.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: not those without a letter, nor those whose best
    language has less than LEAST_SCORE. The label is never an input of the decision. Null and empty
    texts go, rows that repeat are decided alike; no documents, no
    result."""
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    lang, score = fresh(docs, "_lang"), fresh(docs, "_score")
    found = langid.predict(docs, model, predicted=lang, score=score)
    return found.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; those left blank go. `n_chars` is
    that of the new text."""
    return linededup.without_repeated_lines(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(
        *docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id. Rows that
    repeat id and text are one document, of which the row stays whose other columns are
    the smallest as JSON; those that repeat the id alone are told apart. Null and blank texts are near nothing; no
    documents, no result."""
    key, rest = fresh(docs, "_key"), [c for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.withColumn(key, F.struct("doc_id", F.xxhash64("text").alias("h")))
    kept = settle(minhash.near_duplicates(keyed, key).where("kept").select(key).distinct(), "kept")
    first = keyed.join(kept, key, "left_semi").groupBy(key).agg(
        F.any_value("text").alias("text"), F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("rest"))
    return first.select(F.col(f"{key}.doc_id").alias("doc_id"), "text", *[F.col("rest")[c].alias(c) for c in rest]).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: bin, place in it and first word. A null text is a
    document of no words, rows that repeat are packed each; no documents, no pieces."""
    text = F.col("text")
    return packing.pack(docs, "doc_id", packing.n_words(text), F.col("source"), packing.copies(text))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("packed", packed)]

# SQL can express neither the learned model nor the packing; tests hold both against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
