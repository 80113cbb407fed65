"""Best-fit packing of documents into bins of a fixed capacity, under conflicts.

A bin holds at most one document of a source and one of a cluster of duplicates, so no training
sequence repeats itself. Open bins are kept in the order of what they have left, each with a
bitmap of its sources and one of its clusters. A document goes to the tightest bin that fits and is
compatible: the search starts at the smallest sufficient residual and goes on to its successors.
Documents come longest first, and those longer than a bin are cut.

Rows are dealt by hash to shards of about SHARD rows, so a hot source or cluster is spread over
all of them, and each shard is packed on its own.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Hashable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import minhash, shared

SHARD = 4096
CAPACITY = 2048


def n_words(text: Column) -> Column:
    """Words of a text and one for its end; a null text is the empty one."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) + 1


def copies(text: Column) -> Column:
    """Cluster of texts that are equal but for the case of letters and ASCII white space around
    them; none for null."""
    return F.when(text.isNotNull(), F.xxhash64(F.lower(F.trim(text, F.lit(" \t\n\x0b\f\r")))))


def near_copies(df: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """key, others, size in words, cluster of every row: near copies, the case of letters aside, and
    what they link have one cluster. Texts without words, null ones included, have one for each key and
    text. Rows that repeat are there each, in one cluster; no rows, no result; a text is held as a whole.
    `others` may not hold `size` or `cluster`."""
    if {c.lower() for c in others} & {"size", "cluster"}:
        raise ValueError("size and cluster are names of the result")
    low = F.lower(F.col(text))
    rows = df.select(F.struct(F.col(key).alias("id"), F.xxhash64(low).alias("h")).alias("row"), low.alias("text"),
                     F.struct(*others).alias("others"))
    found = minhash.labelled(rows, "row", "text", "others")
    return shared.settle(found.select(
        F.col("key.id").alias(key), *[F.col("others")[c].alias(c) for c in others],
        (F.col("words") + 1).cast("int").alias("size"), F.xxhash64("component_id").alias("cluster")), "rows")


class Packer:
    """Bins of one shard."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []  # (residual, bin), in order
        self.sources: list[int] = []           # bitmap of each bin
        self.clusters: list[int] = []
        self.held: list[int] = []              # rows of each bin
        self.bits: dict[Hashable, int] = {}

    def _bit(self, kind: str, value) -> int:
        """A bit for each value; none for null, which is in conflict with nothing."""
        return 0 if value is None else 1 << self.bits.setdefault((kind, value), len(self.bits))

    def place(self, size: int, source, cluster) -> tuple[int, int, int]:
        """Bin, place in it and where the row starts."""
        source, cluster = self._bit("source", source), self._bit("cluster", cluster)
        i = bisect_left(self.open, (size, -1))
        while i < len(self.open):
            left, number = self.open[i]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.open[i]
                break
            i += 1
        else:
            left, number = self.capacity, len(self.held)
            self.sources.append(0)
            self.clusters.append(0)
            self.held.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        self.held[number] += 1
        if left > size:
            insort(self.open, (left - size, number))
        return number, self.held[number] - 1, self.capacity - left


def pack(df: DataFrame, key: str, size: Column, source: Column, cluster: Column, capacity: int = CAPACITY,
         shard: int = SHARD) -> DataFrame:
    """key, piece, size, source, cluster, bin_id, place, start of every piece of every row.

    Rows of a size above the capacity are cut into pieces that fill a bin each, and a last one.
    A null size or one below 1 counts as 1; a null source or cluster is in conflict with nothing;
    rows that repeat are packed each. `bin_id` counts bins within shards, 2^32 apart. Empty in,
    empty out. Other columns are not read.
    """
    own = F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)).cast("bigint")
    rows = df.select(F.col(key).alias("key"), own.alias("whole"), source.alias("source"), cluster.alias("cluster"))
    last = F.floor((F.col("whole") - 1) / capacity)
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).select(
        "key", "piece", F.least(F.lit(capacity), F.col("whole") - F.col("piece") * capacity).alias("size"),
        "source", "cluster")
    shards = max(1, math.ceil(df.count() / shard))
    by_shard = pieces.withColumn("shard", F.pmod(F.xxhash64("key", "piece", "source", "cluster"), F.lit(shards)))
    ordered = by_shard.repartition("shard").sortWithinPartitions(
        "shard", F.desc("size"), "key", "piece", "source", "cluster")

    def step(batches):
        packer, current = None, None
        for batch in batches:
            names = batch.schema.names
            made = []
            for shard_, size_, source_, cluster_ in zip(
                    *(batch.column(names.index(n)).to_pylist() for n in ("shard", "size", "source", "cluster")),
                    strict=True):
                if shard_ != current:
                    packer, current = Packer(capacity), shard_
                number, place, start = packer.place(size_, source_, cluster_)
                made.append(((shard_ << 32) + number, place, start))
            columns = zip(*made, strict=True) if made else ((), (), ())
            kinds = (pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                [*names[:5], "bin_id", "place", "start"])

    kinds = {f.name: f.dataType.simpleString() for f in by_shard.schema}
    shape = ", ".join(f"{n} {kinds[n]}" for n in ("key", "piece", "size", "source", "cluster"))
    packed = shared.arrow(ordered, step, f"{shape}, bin_id bigint, place int, start bigint")
    return packed.withColumnRenamed("key", key)
