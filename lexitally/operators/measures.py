"""Timings: gate, summary, completeness and derived measures.

A timing table has one row per run; columns are named by the caller, so any table with a group
and a duration will do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import group_spread

GROUP = ("framework", "nodes", "job")


def is_verified(exit_code: str = "exit_code", verified: str = "verified") -> Column:
    return F.coalesce((F.col(exit_code) == 0) & F.col(verified), F.lit(False))


def unverified_runs(runs: DataFrame, ok: Column | None = None) -> DataFrame:
    """Runs that failed or whose output was not verified."""
    return runs.where(~(is_verified() if ok is None else ok))


def require_verified(runs: DataFrame, ok: Column | None = None) -> DataFrame:
    """The same runs; the query that reads them fails on the first unverified one."""
    passed = is_verified() if ok is None else ok
    return runs.where(F.when(passed, True).otherwise(
        F.raise_error(F.lit("unverified run")).cast("boolean")))


def timing_summary(runs: DataFrame, group: Sequence[str] = GROUP, seconds: str = "seconds",
                   digits: int = 6) -> DataFrame:
    """group, runs, median, min, max, in the order of the group."""
    found = group_spread(runs, group, seconds)
    return found.select(
        *group, "runs", *[F.round(c, digits).alias(c) for c in ("median", "min", "max")],
    ).orderBy(*group)


def error_bars(summary: DataFrame, group: Sequence[str] = GROUP, digits: int = 6) -> DataFrame:
    """group, median, below (median - min), above (max - median)"""
    return with_error_bars(summary, digits).select(*group, "median", "below", "above")


def with_error_bars(summary: DataFrame, digits: int = 6) -> DataFrame:
    return summary.select(
        "*", F.round(F.col("median") - F.col("min"), digits).alias("below"),
        F.round(F.col("max") - F.col("median"), digits).alias("above"))


def completeness(runs: DataFrame, expected: Mapping[str, Sequence], repetitions: int) -> DataFrame:
    """Groups that do not have exactly `repetitions` runs, and groups outside `expected`.

    `expected` maps each dimension to its values. The grid is written out from these literals
    and stacked on the runs, so one aggregate finds both kinds.
    """
    dims = list(expected)
    types = {f.name: f.dataType for f in runs.schema.fields}
    grid = runs.sparkSession.range(1).select(F.lit(0).alias("run"), F.lit(1).alias("due"))
    for d in dims:
        values = F.array(*[F.lit(v).cast(types[d]) for v in expected[d]])
        grid = grid.withColumn(d, F.explode(values))
    marked = runs.select(*dims, F.lit(1).alias("run"), F.lit(0).alias("due")).unionByName(grid)
    counted = marked.groupBy(*dims).agg(
        F.sum("run").alias("n"), (F.max("due") == 1).alias("expected"))
    return counted.where((F.col("n") != repetitions) | ~F.col("expected"))


def _pair(summary: DataFrame, over: str, group: Sequence[str], base, other) -> DataFrame:
    rest = [g for g in group if g != over]
    median = F.col("median")
    return summary.groupBy(*rest).agg(
        F.max(F.when(F.col(over) == base, median)).alias("base"),
        F.max(F.when(F.col(over) == other, median)).alias("other"),
    ).where(F.col("base").isNotNull() & F.col("other").isNotNull())


def speedup(summary: DataFrame, over: str, base, other, group: Sequence[str] = GROUP,
            digits: int = 6) -> DataFrame:
    """Median at `base` over median at `other`, for each remaining group."""
    ratio = F.try_divide("base", "other")
    return _pair(summary, over, group, base, other).withColumn("speedup", F.round(ratio, digits))


def step_cost(summary: DataFrame, over: str, base, other, group: Sequence[str] = GROUP,
              digits: int = 6) -> DataFrame:
    """Median at `other` minus median at `base`: what the extra step costs."""
    cost = F.col("other") - F.col("base")
    return _pair(summary, over, group, base, other).withColumn("cost", F.round(cost, digits))


def scaling_fit(runs: DataFrame, group: Sequence[str], size: str, seconds: str,
                digits: int = 6) -> DataFrame:
    """Least squares of seconds = fixed + size / throughput, per group."""
    x, y = F.col(size).cast("double"), F.col(seconds)
    fit = runs.groupBy(*group).agg(
        F.regr_count(y, x).alias("runs"),
        F.regr_intercept(y, x).alias("fixed"),
        F.regr_slope(y, x).alias("slope"),
    )
    throughput = F.try_divide(F.lit(1.0), F.col("slope"))
    return fit.select(*group, "runs", F.round("fixed", digits).alias("fixed"),
                      F.round(throughput, digits).alias("throughput"))
