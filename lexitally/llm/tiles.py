"""Blocks of vectors, the grid on which query blocks meet candidate blocks, and the merge of what
the tiles found."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

QUERIES, CANDIDATES = 512, 4096  # vectors in a block
WAVES = 8                        # tiles for each core at most
HELD = 64                        # query blocks whose best a task holds before it sends them on


def one_row_an_id(df: DataFrame, key: str, vector: str, useful) -> DataFrame:
    """id, v: useful vectors; of rows that repeat an id the smallest vector counts."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("v")).where("id is not null and v is not null")
    return rows.where(useful(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def finite(v) -> F.Column:
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def blocks(vectors: DataFrame, size: int, packed: Callable[[np.ndarray, np.ndarray], dict], shape: str,
           name: str) -> tuple[DataFrame, int]:
    """Vectors dealt to blocks of about `size` of one dimension each, settled, and how many rows
    were dealt. `packed` turns ids and matrix into the binary columns of a block."""
    with shared.shuffles_removed(vectors.sparkSession):
        n = vectors.count()

    def step(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for own, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = v.values.to_numpy(zero_copy_only=False)
                found.setdefault(len(values), []).append((own, values))
        for dim, rows in found.items():
            made = packed(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), *(pa.array([c], pa.binary()) for c in made.values())],
                ["dim", *made])

    dealt = vectors.select("id", "v").repartition(max(1, math.ceil(n / size)))
    made = shared.arrow(dealt, step, f"dim int, {shape}").withColumn("block", F.monotonically_increasing_id())
    return shared.settle(made, name), n


def grid(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every query block beside every candidate block of its dimension: columns q_* and c_*.

    Both sides are cut into stripes, and a tile is a query stripe and a candidate stripe. Blocks
    go once to each tile of their stripe, so about as few bytes move as for that many tasks can. No
    side is broadcast: the files of blocks are smaller than blocks, and their copies for all stripes
    would meet in the driver. There are no more tiles than keep the cores busy, as bytes moved grow
    with the root of their number.
    """
    nq, nc = queries.count(), candidates.count()
    spark = queries.sparkSession
    tasks = min(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), WAVES * spark.sparkContext.defaultParallelism)
    columns = max(1, min(nq, round(math.sqrt(tasks * nq * QUERIES / max(1, nc * CANDIDATES)))))
    rows = max(1, min(nc, math.ceil(tasks / columns)))
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    c = candidates.select(*[F.col(x).alias(f"c_{x}") for x in candidates.columns])
    q = q.withColumn("column", F.pmod(F.xxhash64("q_block"), F.lit(columns)).cast("int")).withColumn(
        "row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    c = c.withColumn("row", F.pmod(F.xxhash64("c_block"), F.lit(rows)).cast("int")).withColumn(
        "column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    return q.hint("merge").join(c.hint("merge"), (F.col("q_dim") == F.col("c_dim")) & (q["row"] == c["row"]) & (q["column"] == c["column"])).drop(
        "row", "column")


class Best:
    """The k best of each query of a block so far: highest score first, ties to the smaller id."""

    def __init__(self, n: int, k: int, dtype):
        self.k = k
        self.row, self.id, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, dtype))
        self.least = np.full(n, -np.inf)  # score of the k-th

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = (np.concatenate(x) for x in (
            (self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row))
        row = row[order]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(start, np.diff(start, append=len(row)))
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.row, self.id, self.score = row[place < self.k], ids[kept], score[kept]
        self.least[row[place == self.k - 1]] = score[last]

    def rows(self, query_ids: np.ndarray, scores: pa.DataType) -> pa.RecordBatch:
        start = np.flatnonzero(np.diff(self.row, prepend=-1))
        ends = pa.array(np.append(start, len(self.row)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(query_ids[self.row[start]]), pa.ListArray.from_arrays(ends, pa.array(self.id)),
             pa.ListArray.from_arrays(ends, pa.array(self.score, scores))], ["query_id", "ids", "scores"])


def search(pairs: DataFrame, k: int, score: str, prepared: Callable, tile: Callable) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query over all tiles.

    `prepared(row, side)` unpacks a block; `tile(q, c, best)` gives row, column and exact score
    of every pair that may belong to the k best, given what is best so far.
    """
    exact = {"double": (np.float64, pa.float64()), "bigint": (np.int64, pa.int64())}[score]

    def step(batches):
        held: dict[int, tuple] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                line = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
                name = line["q_block"]
                if name not in held:
                    if len(held) == HELD:
                        _, (q, best) = held.popitem()
                        yield best.rows(q["ids"], exact[1])
                    q = prepared(line, "q_")
                    held[name] = (q, Best(len(q["ids"]), k, exact[0]))
                q, best = held[name]
                c = prepared(line, "c_")
                row, column, found = tile(q, c, best)
                best.add(row, c["ids"][column], found)
        for q, best in held.values():
            yield best.rows(q["ids"], exact[1])

    partial = shared.arrow(pairs, step, f"query_id bigint, ids array<bigint>, scores array<{score}>")
    by_query = partial.repartition("query_id").sortWithinPartitions("query_id")

    def merge(batches):
        for query, lists in _by_query(batches):
            top = list(islice(heapq.merge(*lists), k))
            yield pa.RecordBatch.from_arrays(
                [pa.array([query] * len(top), pa.int64()), pa.array(range(1, len(top) + 1), pa.int32()),
                 pa.array([i for _, i in top], pa.int64()), pa.array([-s for s, _ in top], exact[1])],
                ["query_id", "rank", "vec_id", "score"])

    return shared.arrow(by_query, merge, f"query_id bigint, rank int, vec_id bigint, score {score}")


def _by_query(batches) -> Iterator[tuple[int, list]]:
    current, lists = None, []
    for batch in batches:
        for query, ids, scores in zip(*(batch.column(i) for i in range(3)), strict=True):
            if (query := query.as_py()) != current:
                if lists:
                    yield current, lists
                current, lists = query, []
            lists.append([(-s, i) for s, i in zip(scores.as_py(), ids.as_py(), strict=True)])
    if lists:
        yield current, lists


def sequential(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up from the first component to the last."""
    total = np.zeros(len(q), q.dtype)
    for d in range(q.shape[1]):
        total += q[:, d] * c[:, d]
    return total


def survivors(low: np.ndarray, high: np.ndarray, best: Best) -> np.ndarray:
    """Pairs that may belong to the k best: their upper bound reaches the k-th lower bound of the
    row and the k-th best so far."""
    floor = best.least
    if low.shape[1] >= best.k:
        floor = np.maximum(floor, np.partition(low, -best.k, axis=1)[:, -best.k])
    return high >= floor[:, None]
