"""From original documents to a normalised, repeated corpus with its manifest and answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import utc_text
from ..functions.text import byte_length, decode_utf8, normalize_text, sha256
from ..operators import corpus
from ..operators.counts import char_count, word_count
from ..operators.extremes import extremes
from ..sources import readers, writers

# The rules of README "Semantics" in short, as a manifest states them.
NORMALIZATION = "one byte-order mark dropped, LF as the only record end, LF at the end"
WORD_RULE = "runs of code points that are no Unicode whitespace, as they are"
CHAR_RULE = "every code point of a record but CR and LF"


@dataclass(frozen=True)
class Prepared:
    texts: DataFrame       # id, title, url, text, bytes, sha256, download_sha256, download_bytes
    copies: int
    files: DataFrame       # name, bytes, sha256, text
    header: DataFrame      # one row
    sources: DataFrame     # id, title, url, download_sha256, download_bytes
    word_counts: DataFrame
    char_counts: DataFrame
    minmax: DataFrame


def measure(documents: DataFrame, marker: str, min_bytes: int, invalid: str = "strict") -> DataFrame:
    """Texts and measures of `documents` (id, title, url and content as bytes). The query fails on
    one that is not what was asked for."""
    decoded = documents.withColumn("text", normalize_text(decode_utf8("content", invalid)))
    ok = F.coalesce(corpus.is_expected("text", "content", marker, min_bytes), F.lit(False))
    reason = F.concat(F.lit("unexpected document: "), F.col("id").cast("string"))
    sound = decoded.where(F.when(ok, True).otherwise(F.raise_error(reason).cast("boolean")))
    return sound.select(
        "id", "title", "url", "text", byte_length("text").alias("bytes"), sha256("text").alias("sha256"),
        sha256("content").alias("download_sha256"), byte_length("content").alias("download_bytes"))


def prepare(documents: DataFrame, marker: str, min_bytes: int, minimum_bytes: int, path: str,
            template: str = "doc%d-copy%03d.txt", invalid: str = "strict") -> Prepared:
    """The originals are read, checked and measured once, into `originals/` below `path`; all the
    rest comes from there. Answers are counted on the single copies and scaled."""
    measure(documents, marker, min_bytes, invalid).write.mode(writers.KEEP).parquet(f"{path}/originals")
    texts = documents.sparkSession.read.parquet(f"{path}/originals")
    k = int(corpus.copies_for(texts, minimum_bytes).first().copies)
    files = corpus.replicate(texts.select("id", "text", "bytes", "sha256"), k, "id", template).select(
        "name", "bytes", "sha256", "text")
    header = texts.agg(F.count(F.lit(1)).cast("int").alias("unique_books"),
                       F.sum("bytes").alias("bytes")).select(
        utc_text(F.current_timestamp()).alias("created_utc"), "unique_books",
        F.lit(k).cast("bigint").alias("copies_per_book"), (F.col("bytes") * k).alias("total_bytes"),
        F.lit(NORMALIZATION).alias("normalization"), F.lit(WORD_RULE).alias("word_rule"),
        F.lit(CHAR_RULE).alias("char_rule"))
    sources = texts.select("id", "title", "url", "download_sha256", "download_bytes")
    words = word_count(texts).select(F.col("word").alias("key"), (F.col("n") * k).alias("n"))
    chars = char_count(texts).select(F.col("ch").alias("key"), (F.col("n") * k).alias("n"))
    ends = extremes(words.withColumnRenamed("key", "word"))
    return Prepared(texts, k, files, header, sources, words, chars, ends)


def write(prepared: Prepared, path: str) -> None:
    """`corpus/` (parquet rows name, text), `manifest/` and `expected/` below `path`."""
    prepared.files.select("name", "text").write.mode(writers.KEEP).parquet(f"{path}/corpus")
    writers.write_manifest(prepared.header, prepared.sources, prepared.files, f"{path}/manifest")
    writers.write_answers(prepared.word_counts, f"{path}/expected/wordcount")
    writers.write_answers(prepared.char_counts, f"{path}/expected/charcount")
    # From the written counts, which saves counting the corpus a second time.
    spark = prepared.word_counts.sparkSession
    words = readers.read_answers(spark, f"{path}/expected/wordcount")
    writers.write_answers(extremes(words.withColumnRenamed("key", "word")), f"{path}/expected/minmax")
