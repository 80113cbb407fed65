"""A measured suite around the jobs: loading, checks before, report after.

Starting and timing the jobs is the scheduler's work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compare, corpus, measures, participation
from ..sources import readers, writers


def load_shard(manifest: DataFrame, contents: DataFrame, shards: int, index: int, target: str,
               order: Sequence[str] = ("name",)) -> int:
    """Write the rows of `contents` that belong to one shard of the manifest, and return how many
    files that is. An empty shard, a missing file or a shard loaded before is an error."""
    chosen = corpus.shard(manifest, shards, index, order)
    n = chosen.count()
    if n == 0 or not compare.missing_files(chosen, contents).isEmpty():
        raise ValueError(f"files of shard {index} of {shards} are missing")
    rows = contents.join(chosen.select("name"), "name", "left_semi")
    rows.write.mode(writers.KEEP).parquet(f"{target}/shard={index}")
    return n


def preflight(files: DataFrame, declared: DataFrame, workers: DataFrame, nodes: int,
              live: str = participation.ALIVE) -> DataFrame:
    """problem, detail: everything that speaks against starting. No rows means ready.

    `files` and `declared` are manifests of what is there and of what should be.
    """
    # Names and contents in one comparison, so that the files are read and hashed once.
    found = compare.violations(files, declared, ["name"], ["bytes", "sha256"])
    inputs = found.select(F.col("kind").alias("problem"), F.col("name").alias("detail"))
    hosts = participation.live_hosts(workers, nodes, live=live).where(~F.col("complete")).select(
        F.lit("workers").alias("problem"),
        F.format_string("%d live, %d expected", "hosts", "expected").alias("detail"))
    return inputs.unionByName(hosts)


def took_part(logs: DataFrame, attempts: DataFrame, hosts: DataFrame, target: str) -> None:
    """Write who took part. A log that names no id, or whose jobs have no host, is an error and
    leaves no result; `attempts`, as they were read, are written beside it."""
    ids = participation.required(logs, participation.job_ids(logs), "job id")
    found = participation.required(ids, participation.by_run(ids, hosts), "host")
    writers.write_participation(found, ids, attempts, target)


def report(spark: SparkSession, paths: Sequence[str], expected: Mapping[str, Sequence] | None = None,
           repetitions: int = 3) -> DataFrame:
    """`timing_summary` with error bars over timing files. An unverified run fails the report, and
    so does, when `expected` names the groups, any group without exactly `repetitions` runs."""
    runs = measures.require_verified(readers.read_timings(spark, paths))
    if expected is not None:
        gaps = measures.completeness(runs, expected, repetitions).count()
        if gaps:
            raise ValueError(f"{gaps} groups do not have exactly {repetitions} verified runs")
    return measures.with_error_bars(measures.timing_summary(runs))
