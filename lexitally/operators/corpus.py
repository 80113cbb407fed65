"""Corpora: checks on documents, manifests, copies and shards.

A manifest is a table with one row per file: `name`, `bytes BIGINT`, `sha256`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import ceil_div
from ..functions.text import byte_length, column, sha256
from .ranks import row_index

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def is_expected(text: Column | str, content: Column | str, marker: str, min_bytes: int) -> Column:
    """Whether a document holds `marker` in any letter case and has at least `min_bytes`."""
    return F.contains(F.upper(column(text)), F.lit(marker)) & (byte_length(content) >= min_bytes)


def valid_documents(df: DataFrame, marker: str, min_bytes: int, text: str = "text",
                    content: str | None = None) -> DataFrame:
    return df.where(is_expected(text, content or text, marker, min_bytes))


def unexpected_documents(df: DataFrame, marker: str, min_bytes: int, text: str = "text",
                         content: str | None = None) -> DataFrame:
    ok = is_expected(text, content or text, marker, min_bytes)
    return df.where(~F.coalesce(ok, F.lit(False)))


def manifest(df: DataFrame, name: Column | str = "name", content: Column | str = "text") -> DataFrame:
    """name, bytes, sha256 of each row's text or bytes. A projection: nothing is shuffled."""
    return df.select(
        column(name).alias("name"),
        byte_length(content).alias("bytes"),
        sha256(content).alias("sha256"),
    )


def corpus_totals(files: DataFrame) -> DataFrame:
    """n_files, total_bytes"""
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
    )


def fingerprint(files: DataFrame) -> DataFrame:
    """total_bytes, n_files and the first 16 digits of the smallest hash, in one row."""
    return files.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.count(F.lit(1)).alias("n_files"),
        F.substring(F.min("sha256"), 1, 16).alias("least_hash"),
    )


def fingerprint_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both fingerprints side by side and whether they are equal."""
    fields = ["total_bytes", "n_files", "least_hash"]
    a = left.select(F.lit("left").alias("side"), F.struct(*fields).alias("f"))
    b = right.select(F.lit("right").alias("side"), F.struct(*fields).alias("f"))
    # Two rows in all, so one aggregate takes the place of a join.
    sides = a.unionByName(b).agg(
        F.max(F.when(F.col("side") == "left", F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == "right", F.col("f"))).alias("r"),
    )
    return sides.select(
        F.col("l").eqNullSafe(F.col("r")).alias("equal"),
        *[F.col(f"l.{f}").alias(f"left_{f}") for f in fields],
        *[F.col(f"r.{f}").alias(f"right_{f}") for f in fields],
    )


def copies_for(files: DataFrame, minimum_bytes: int) -> DataFrame:
    """One row, `copies`: how often the files must be repeated to reach `minimum_bytes`. The query
    fails if there is nothing to repeat."""
    if minimum_bytes < 1:
        raise ValueError("minimum_bytes must be positive")
    total = F.when(F.sum("bytes") > 0, F.sum("bytes")).otherwise(
        F.raise_error(F.lit("no bytes to repeat")).cast("bigint"))
    return files.agg(ceil_div(F.lit(minimum_bytes).cast("bigint"), total).alias("copies"))


def replicate(df: DataFrame, copies: DataFrame | int, ident: str,
              template: str = "doc%d-copy%03d.txt") -> DataFrame:
    """Every row `copies` times, with `copy` from 0 and `name` made of `ident` and the copy.

    `copies` is a number or the one-row result of `copies_for`. A few rows may grow into a very
    large table, so k copies are made in two steps of about sqrt(k): the first step's rows are
    dealt out to all tasks, and each task makes the second step's rows where it writes them.
    """
    if isinstance(copies, int):
        if copies < 1:
            raise ValueError("copies must be at least 1")
        k = F.lit(copies).cast("bigint")
    else:
        k = copies.scalar().cast("bigint")
    step = F.ceil(F.sqrt(k))
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    started = df.withColumn("_first", F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1, step)))
    # An explicit number of tasks: adaptive execution would size them by the rows that come in,
    # not by the copies that go out.
    dealt = started.repartition(tasks, ident, "_first")
    last = F.least(F.col("_first") + step, k) - 1
    copied = dealt.withColumn("copy", F.explode(F.sequence(F.col("_first"), last)))
    named = copied.withColumn("name", F.format_string(template, ident, "copy"))
    return named.select(*df.columns, "copy", "name")


def with_shard(files: DataFrame, shards: int, order: Sequence[str] = ("name",),
               blocks: int | None = None) -> DataFrame:
    """`files` with `idx`, the position in the order given, and `shard` = idx mod shards."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    indexed = row_index(files, list(order), "idx", blocks)
    return indexed.withColumn("shard", F.pmod(F.col("idx"), F.lit(shards)).cast("int"))


def shard(files: DataFrame, shards: int, index: int, order: Sequence[str] = ("name",),
          blocks: int | None = None) -> DataFrame:
    """The files of one shard; all shards together hold each file once."""
    if not 0 <= index < shards:
        raise ValueError(f"index {index} names none of the {shards} shards")
    return with_shard(files, shards, order, blocks).where(F.col("shard") == index)
