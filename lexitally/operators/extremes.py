"""Least and most frequent key of a count table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def extremes(counts: DataFrame, key: str = "word", by: Sequence[str] = ()) -> DataFrame:
    """by, which (MIN, MAX), key, n; equal counts go to the smallest key in code point order.

    Both ends come from one pass: MAX is the minimum of (-n, key), since the maximum of (n, key)
    would take the largest key among equals. With `by`, a pair for each of its values. No rows for
    an empty table.
    """
    low = F.min(F.struct(F.col("n").alias("rank"), F.col(key).alias("key")))
    high = F.min(F.struct((-F.col("n")).alias("rank"), F.col(key).alias("key")))
    ends = counts.groupBy(*by).agg(low.alias("low"), high.alias("high")).where(F.col("low").isNotNull())

    def row(which, end, n):
        return F.struct(F.lit(which).alias("which"), F.col(f"{end}.key").alias(key), n.alias("n"))

    return ends.select(*by, F.inline(F.array(
        row("MIN", "low", F.col("low.rank")),
        row("MAX", "high", -F.col("high.rank")),
    )))


def merge_extremes(first: DataFrame, *others: DataFrame, key: str = "word") -> DataFrame:
    """Extremes of count tables with disjoint keys from the extremes of each, given as one table
    for each or stacked in one (`extremes` with `by`)."""
    parts = [part.select(key, "n") for part in (first, *others)]
    return extremes(reduce(DataFrame.unionByName, parts), key)
