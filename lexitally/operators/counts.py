"""Words and characters: from texts to count tables.

A count table has one row per key: the key and `n BIGINT`. Counting is a partial aggregate in
the scan stage, one hash exchange of the partial counts and a final aggregate. A key that makes
up a third of the corpus therefore reaches its reducer as one row per map task.

Texts must be valid UTF-8: the query fails on one that is not, instead of counting something
else. `functions.text.decode_utf8` repairs or sorts out such texts beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import RECORD_ENDS, code_point_key, line_pieces, pieces, split_code_points, split_lines, split_words


def lines(df: DataFrame, text: str = "text", keep: Sequence[str] = (), size: int | None = None) -> DataFrame:
    """One row per record of each text, numbered from 0 in `line_no`.

    A text is cut into pieces of whole records, of about `size` characters or one record, and each
    piece is numbered on from those before it; so no array holds all records of a text.
    """
    cut = df.select(*keep, line_pieces(F.validate_utf8(text), size).alias("_pieces"))
    counts = F.transform("_pieces", lambda p: F.size(split_lines(p)))
    earlier = F.aggregate(counts, F.array(F.lit(0)), lambda sums, n: F.array_append(sums, F.element_at(sums, -1) + n))
    both = F.zip_with("_pieces", earlier, lambda p, first: F.struct(p.alias("piece"), first.alias("first")))
    alone = F.array(F.struct(F.get("_pieces", F.lit(0)).alias("piece"), F.lit(0).alias("first")))
    # The outer form, since the other one would cut every text a second time to see if it has pieces.
    dealt = cut.select(*keep, F.explode_outer(F.when(F.size("_pieces") > 1, both).otherwise(alone)).alias("_part"))
    each = dealt.select(*keep, F.col("_part.first").alias("_first"), F.posexplode(split_lines("_part.piece")).alias("_no", "line"))
    return each.select(*keep, (F.col("_first") + F.col("_no")).alias("line_no"), "line").where(F.col("line").isNotNull())


def _pieces(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Every text in bounded pieces, in `_piece`, none of which cuts a word; so no array holds all
    words or all characters of a text, with record ends or without."""
    return df.select(*keep, F.explode(pieces(F.validate_utf8(text))).alias("_piece"))


def tokens(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per word occurrence."""
    exploded = _pieces(df, text, keep).select(*keep, F.explode(split_words("_piece")).alias("word"))
    return exploded.where(F.col("word") != "")


def chars(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per code point occurrence, record ends left out."""
    exploded = _pieces(df, text, keep).select(*keep, F.explode(split_code_points("_piece")).alias("c"))
    return exploded.where(~F.col("c").isin("", *RECORD_ENDS))


def char_pairs(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """keep, ch, n: characters counted for each value of `keep`, for each record if that
    identifies one."""
    counted = chars(df, text, keep).groupBy(*keep, "c").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keep, code_point_key("c").alias("ch"), "n")


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """word, n"""
    return tokens(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def char_count(df: DataFrame, text: str = "text") -> DataFrame:
    """ch (`U+XXXX`), n

    Code points are grouped as they are, so the key is only formatted for the few distinct ones.
    """
    counted = chars(df, text).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(code_point_key("c").alias("ch"), "n")


def merge_counts(first: DataFrame, *others: DataFrame, key: str = "word") -> DataFrame:
    """Sum of partial counts per key; counts of a whole follow from counts of its parts."""
    together = reduce(DataFrame.unionByName, others, first)
    return together.groupBy(key).agg(F.sum("n").alias("n"))


def scale_counts(counts: DataFrame, copies: int, key: str = "word") -> DataFrame:
    """Counts of a corpus repeated `copies` times, without reading the copies."""
    if copies < 1:
        raise ValueError("copies must be at least 1")
    return counts.select(key, (F.col("n") * F.lit(copies)).alias("n"))
