"""Who took part: tasks, attempts, jobs and workers found in logs and snapshots.

All results are long: one row per (log, host) or (log, id). A log with very many entries is
folded by partial aggregates and never gathered into an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fields import JOB_ID, after_marker, all_ids, host_of

# What the engines write.
TASK_END, SUCCESS, SUCCEEDED, ALIVE = "SparkListenerTaskEnd", "Success", "SUCCEEDED", "ALIVE"


def task_participation(events: DataFrame, log: str = "log") -> DataFrame:
    """log, host, tasks: successful task ends of each event log"""
    ended = events.where(
        (F.col("Event") == TASK_END) & (F.col("`Task End Reason`.Reason") == SUCCESS))
    return ended.groupBy(log, F.col("`Task Info`.Host").alias("host")).agg(
        F.count(F.lit(1)).alias("tasks"))


def attempt_hosts(attempts: DataFrame, log: str = "log", field: str = "taskAttempts") -> DataFrame:
    """log, host, tasks: succeeded attempts of each job-history answer"""
    each = attempts.select(log, F.explode(f"{field}.taskAttempt").alias("a"))
    return (each.where(F.col("a.state") == SUCCEEDED)
            .groupBy(log, host_of("a.nodeHttpAddress").alias("host"))
            .agg(F.count(F.lit(1)).alias("tasks")))


def job_ids(logs: DataFrame, log: str = "log", line: str = "value",
            pattern: str = JOB_ID) -> DataFrame:
    """log, id: the distinct ids in each log"""
    return logs.select(log, F.explode(all_ids(line, pattern)).alias("id")).distinct()


def logs_without(logs: DataFrame, found: DataFrame, log: str = "log") -> DataFrame:
    """Logs for which a result (hosts, ids, context) has no row."""
    return logs.select(log).distinct().join(found.select(log).distinct(), log, "left_anti")


def required(logs: DataFrame, found: DataFrame, what: str, log: str = "log") -> DataFrame:
    """`found`; the query that reads it fails if any of `logs` has no row there."""
    reason = F.concat(F.lit(f"no {what} in "), F.col(log).cast("string"))
    # The failure depends on the joined side, so it cannot be moved before the join.
    marked = logs.select(log).distinct().join(
        found.select(log).distinct().withColumn("_found", F.lit(True)), log, "left")
    missing = marked.where(F.when(F.col("_found").isNull(), F.raise_error(reason).cast("boolean")).otherwise(False))
    return found.unionByName(missing.select(log), allowMissingColumns=True)


def log_context(logs: DataFrame, marker: str, schema: str, log: str = "log",
                line: str = "value", order: Sequence[str] = ("block", "at")) -> DataFrame:
    """log and the fields of the JSON after the first `marker` of each log.

    `logs` holds lines; `order` gives their order within a log. Only marked lines are grouped.
    """
    payload = after_marker(line, marker)
    marked = logs.select(log, *order, payload.alias("payload")).where(F.col("payload").isNotNull())
    first = marked.groupBy(log).agg(F.min_by("payload", F.struct(*order)).alias("payload"))
    return first.select(log, F.from_json("payload", schema).alias("c")).select(log, "c.*")


def by_run(ids: DataFrame, hosts: DataFrame) -> DataFrame:
    """log, host, tasks of each run, from its (log, id) and the hosts found for those ids."""
    named = hosts.select(F.col("log").alias("id"), "host", "tasks")
    return ids.join(named, "id").groupBy("log", "host").agg(F.sum("tasks").alias("tasks"))


def live_hosts(workers: DataFrame, expected: int, state: str = "state", host: str = "host",
               live: str = ALIVE) -> DataFrame:
    """hosts, expected, complete: distinct hosts of the live workers of one snapshot"""
    alive = workers.where(F.col(state) == live)
    return alive.agg(F.count_distinct(host).alias("hosts")).select(
        "hosts", F.lit(expected).cast("bigint").alias("expected"),
        (F.col("hosts") == expected).alias("complete"))
