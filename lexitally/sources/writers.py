"""Writers. Existing output is an error everywhere, except for the growing timing table."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import tsv_line
from . import readers, schemas

KEEP = "errorifexists"

# What tells one run of a suite from another.
_RUN = ("framework", "nodes", "job", "repetition")


def format_counts(counts: DataFrame, key: str = "word") -> DataFrame:
    """value: `key<TAB>n`"""
    return counts.select(tsv_line(key, "n").alias("value"))


def format_extremes(ends: DataFrame, key: str = "word") -> DataFrame:
    return ends.select(tsv_line("which", key, "n").alias("value"))


def write_counts(counts: DataFrame, path: str, key: str = "word") -> None:
    """Text files, one per partition; words are written as they are, without quoting."""
    format_counts(counts, key).write.mode(KEEP).text(path)


def write_extremes(ends: DataFrame, path: str, key: str = "word") -> None:
    """One text file of at most two lines."""
    format_extremes(ends, key).coalesce(1).write.mode(KEEP).text(path)


def write_answers(answers: DataFrame, path: str) -> None:
    """Expected answers as JSON rows: a table, since one object for all keys would have to pass
    through one task."""
    answers.write.mode(KEEP).json(path)


def write_manifest(header: DataFrame, sources: DataFrame, files: DataFrame, path: str) -> None:
    """`header/`, `sources/` and `files/` as JSON rows below `path`."""
    parts = (("header", header, schemas.HEADER), ("sources", sources, schemas.ORIGINS),
             ("files", files, schemas.FILES))
    for name, df, ddl in parts:
        df.select(*schemas.names(ddl)).write.mode(KEEP).json(f"{path}/{name}")


def append_timings(runs: DataFrame, path: str, run_id: str | None = None) -> None:
    """Adds runs to a CSV folder, each file with its header.

    With the id of the suite they belong to, the append may be repeated: runs that the folder has
    under that id (by framework, nodes, job and repetition) are left out, the rest is written beside
    the folder's runs under a name that readers pass over, and takes its place in `run=<id>/` by one
    rename. A run that comes twice in one append is one run. An append that is cut short leaves nothing
    that is read. Appends under one id must follow
    each other; on stores without an atomic rename the last step is as safe as their rename.
    """
    rows = runs.select(*schemas.names(schemas.TIMINGS))
    if run_id is None:
        rows.write.mode("append").option("header", True).option("escape", '"').csv(path)
        return
    if not re.fullmatch(r"[\w.+-]+", run_id):
        raise ValueError(f"a run id is made of letters, digits and . + - _, unlike {run_id!r}")
    spark = runs.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    commit = uuid.uuid4().hex
    place, staged = hadoop.Path(f"{path}/run={run_id}"), hadoop.Path(f"{path}/_staged-{commit}")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(place):
        known = readers.read_timings(spark, f"{path}/run={run_id}").select(*_RUN).distinct()
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"k.{c}")) for c in _RUN]
        rows = rows.alias("r").join(known.alias("k"), reduce(Column.__and__, same), "left_anti")
    rows.dropDuplicates(list(_RUN)).write.option("header", True).option("escape", '"').csv(staged.toString())
    system.mkdirs(place)
    if not system.rename(staged, hadoop.Path(place, commit)):
        raise OSError(f"{staged.toString()} could not be renamed")


def write_participation(hosts: DataFrame, ids: DataFrame, attempts: DataFrame, path: str) -> None:
    """`hosts/` (log, host, tasks), `ids/` (log, id) and the evidence, `attempts/` (the events or
    answers as they were read), as JSON rows below `path`."""
    hosts.write.mode(KEEP).json(f"{path}/hosts")
    ids.write.mode(KEEP).json(f"{path}/ids")
    attempts.write.mode(KEEP).json(f"{path}/attempts")


def write_shards(files: DataFrame, path: str) -> None:
    """Rows of `with_shard` and their content, one folder per shard."""
    files.write.mode(KEEP).partitionBy("shard").parquet(path)
