"""The three counting jobs, from a folder of texts to a folder of results.

    python -m lexitally.plans.jobs wordcount --input IN --output OUT
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import session
from ..operators.compare import verify_summary
from ..operators.counts import char_count, word_count
from ..functions.text import decode_utf8
from ..operators.extremes import extremes
from ..sources import readers, schemas, writers

JOBS = ("wordcount", "charcount", "minmax")
FORMS = ("text", "parquet")
INVALID = ("strict", "replace")
CONTEXT_MARKER = "RUN_CONTEXT "


def check_job(job: str) -> None:
    if job not in JOBS:
        raise ValueError(f"job must be one of {', '.join(JOBS)}, not {job!r}")


def result(job: str, texts: DataFrame, text: str = "text") -> DataFrame:
    """key, n for the counts; which, word, n for minmax."""
    check_job(job)
    if job == "charcount":
        return char_count(texts, text).withColumnRenamed("ch", "key")
    counts = word_count(texts, text)
    return extremes(counts) if job == "minmax" else counts.withColumnRenamed("word", "key")


def run(spark: SparkSession, job: str, source: str, target: str,
        partitions: int | None = None, form: str = "text", invalid: str = "strict",
        spread: int | None = None) -> None:
    """Read, count and write one job. `partitions` is the number of output files; rows are dealt
    to them after the final aggregate, which stays as wide as adaptive execution makes it. `form`
    is text, or parquet with a `text` column as `prepare.write` leaves it. Bytes that are no UTF-8
    fail the job, or become U+FFFD with `invalid` = replace. `spread` deals the input to so many
    tasks before counting, for a few files that cannot be split."""
    check_job(job)
    if form not in FORMS:
        raise ValueError(f"form must be text or parquet, not {form!r}")
    if invalid not in INVALID:
        raise ValueError(f"invalid must be strict or replace, not {invalid!r}")
    if partitions is not None and partitions < 1:
        raise ValueError("partitions must be at least 1")
    # Text splits at any record; parquet only between row groups.
    texts = (readers.read_lines(spark, source) if form == "text"
             else spark.read.parquet(source).select("text"))
    texts = session.spread(texts, spread)
    found = result(job, texts.select(decode_utf8("text", invalid).alias("text")))
    if job == "minmax":
        writers.write_extremes(found, target)
    else:
        writers.write_counts(found.repartition(partitions) if partitions else found, target, "key")


def verify(spark: SparkSession, job: str, output: str, expected: DataFrame) -> DataFrame:
    """`verify_summary` of a job's written output; lines that do not parse are violations."""
    check_job(job)
    if job == "minmax":
        got, key, values = readers.read_extremes(spark, output), ("which",), ("word", "n")
    else:
        got, key, values = readers.read_counts(spark, output), ("key",), ("n",)
    got = got.withColumn("malformed", got["problem"].isNotNull())
    return verify_summary(got, expected, key, values, malformed="malformed")


def context_line(spark: SparkSession) -> str:
    sc = spark.sparkContext
    found = (sc.applicationId, sc.master, sc.defaultParallelism)
    return CONTEXT_MARKER + json.dumps(dict(zip(schemas.names(schemas.CONTEXT), found, strict=True)))


def main(argv: Sequence[str]) -> None:
    parser = argparse.ArgumentParser(description="count words, characters or extremes")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--form", choices=FORMS, default="text")
    parser.add_argument("--invalid", choices=INVALID, default="strict")
    parser.add_argument("--spread", type=int)
    a = parser.parse_args(argv)
    spark = session.start(f"lexitally-{a.job}")
    print(context_line(spark), flush=True)
    run(spark, a.job, a.input, a.output, a.partitions, a.form, a.invalid, a.spread)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
