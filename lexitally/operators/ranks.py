"""Positions in a total order and exact medians, without a one-task sort and without a job of
their own: the plans run when their result is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_OFFSET_BITS = 33  # fixed value: monotonically_increasing_id keeps the row offset in 33 bits

_DIGIT = 16  # bits of a value that one pass of a selection settles


def row_index(df: DataFrame, order: Sequence[str], name: str = "idx",
              blocks: int | None = None) -> DataFrame:
    """Zero-based position of each row in the order of `order`, which must be unique.

    Rows are range-partitioned and sorted within their partitions ("blocks"), and the counts per
    block give every block's starting position. Rows and counts read the same exchange. Its number
    of partitions is given, which keeps adaptive execution from merging them differently for the
    two; were they cut differently all the same, a row outside its block fails the query.
    """
    n = blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order)
    place = F.monotonically_increasing_id()
    cut = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", place).select(
        *df.columns, F.shiftright("_at", _OFFSET_BITS).alias("_block"),
        F.col("_at").bitwiseAND((1 << _OFFSET_BITS) - 1).alias("_at"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counted = cut.groupBy("_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_least"), F.max(key).alias("_most"),
        # Without a use for every column here, each side would get an exchange of its own.
        F.max(F.xxhash64(*df.columns)).alias("_any"))
    starts = counted.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # One row per range partition: the window above and this broadcast stay that small.
    found = cut.join(F.broadcast(starts), "_block")
    inside = (F.col("_at") < F.col("_n")) & (key >= F.col("_least")) & (key <= F.col("_most")) & F.col("_any").isNotNull()
    index = F.when(inside, F.col("_start") + F.col("_at")).otherwise(
        F.raise_error(F.lit("blocks were cut twice")).cast("bigint"))
    return found.select(*df.columns, index.alias(name))


def ordered_bits(value: Column | str) -> Column:
    """BIGINT that sorts as the doubles do: negative ones before zero, which has no sign here, and NaN
    last. NULL stays."""
    v = F.col(value) if isinstance(value, str) else value
    # The method takes no NULL. Adding zero takes the sign from it.
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(v, F.lit(0.0)) + F.lit(0.0))
    key = bits.cast("bigint")
    flipped = key.bitwiseXOR(F.lit((1 << 63) - 1))
    return F.when(v >= 0, key).when(v < 0, flipped).when(v.isNotNull(), key)


def _picked(digits: Column | str, rank: Column | str) -> Column:
    """struct(left, digit, v) of the array entry (digit, n, v) that `rank` falls into, and how far; no
    digit in an array that does not reach so far."""
    start = F.struct(F.col(rank).alias("left"), F.lit(None).cast("bigint").alias("digit"), F.lit(None).cast("double").alias("v"))

    def step(found, entry):
        inside = F.struct(found["left"].alias("left"), entry["digit"].alias("digit"), entry["v"].alias("v"))
        past = F.struct((found["left"] - entry["n"]).alias("left"), found["digit"].alias("digit"), found["v"].alias("v"))
        return F.when(found["digit"].isNotNull(), found).when(found["left"] < entry["n"], inside).otherwise(past)

    return F.aggregate(F.array_sort(digits), start, step)


def group_spread(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Per group: runs (values that are not NULL), exact median, least and greatest `value`. A
    group without values has 0 runs and no more.

    The built-in exact median holds all distinct values of a group in one task. Here values are
    folded to distinct ones with a count, and the two middle ones are selected by their bits, 16 in a
    pass from the highest on: a pass counts, by partial aggregates, how many of the values that begin
    like the one looked for go on with each of 65,536 digits, and follows the digit that holds the
    rank. Four passes read the same exchange. No group is sorted, and none held but for its digits.
    """
    at = ["group", "target"]
    values = df.select(F.struct(*group).alias("group"), F.col(value).cast("double").alias("v"))
    keyed = values.select("group", "v", ordered_bits("v").alias("key")).groupBy("group", "key").agg(
        F.count("v").alias("w"), F.max("v").alias("v"))
    totals = keyed.groupBy("group").agg(F.sum("w").alias("runs"), F.min("v").alias("min"), F.max("v").alias("max"))

    first = keyed.where("w > 0").groupBy("group", F.shiftright("key", 64 - _DIGIT).alias("digit")).agg(
        F.sum("w").alias("n"), F.max("v").alias("v"))
    found = first.groupBy("group").agg(F.sum("n").alias("runs"), F.collect_list(F.struct("digit", "n", "v")).alias("digits"))
    ranks = F.array(*[F.struct(F.lit(t).alias("target"), F.expr(r).alias("rank")) for t, r in (
        ("low", "(runs - 1) div 2"), ("high", "runs div 2"))])
    state = found.select("group", "digits", F.inline(ranks)).select(*at, _picked("digits", "rank").alias("p"))
    for shift in range(64 - 2 * _DIGIT, -1, -_DIGIT):
        looked = state.select(F.col("group").alias("of"), "target", F.col("p.left").alias("rank"), F.col("p.digit").alias("prefix"))
        # The beginning of the value is a part of the key, so a hot group is spread over its values.
        same = (F.col("of") == F.col("group")) & (F.shiftright("key", shift + _DIGIT) == F.col("prefix"))
        begins = keyed.where("w > 0").join(looked, same)
        counts = begins.groupBy("group", "target", "rank", F.shiftright("key", shift).alias("digit")).agg(
            F.sum("w").alias("n"), F.max("v").alias("v"))
        state = counts.groupBy(*at, "rank").agg(F.collect_list(F.struct("digit", "n", "v")).alias("digits")).select(
            *at, _picked("digits", "rank").alias("p"))
    ends = state.groupBy("group").agg(
        F.max(F.when(F.col("target") == "low", F.col("p.v"))).alias("low"),
        F.max(F.when(F.col("target") == "high", F.col("p.v"))).alias("high"))
    both = totals.join(ends.withColumnRenamed("group", "of"), F.col("group") == F.col("of"), "left")
    return both.select("group.*", "runs", ((F.col("low") + F.col("high")) / 2).alias("median"), "min", "max")
