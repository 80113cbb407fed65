"""Hashes of contents that come in pieces: one hash state is carried over a content's ordered pieces."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship

_ROWS = 4096  # results sent on at once


def sha256_of_pieces(pieces: DataFrame, key: str, order: str, piece: str, between: bytes = b"") -> DataFrame:
    """key, bytes, sha256 of the pieces of each key, joined by `between` in ascending order.

    The pieces (text or binary) are sorted within the partition that their key falls to, which
    spills where it must, and go through the task's hash one batch of Arrow after another. A key is
    worked on by one task, as a hash is computed from front to back, but never held by it. A null
    piece is an empty one; a key is never null. Equal places in the order give no defined result.
    """
    ship(pieces.sparkSession)
    kind = pieces.schema[key].dataType.simpleString()

    def step(batches: Iterable) -> Iterator:
        import pyarrow as pa

        names, done = ["key", "bytes", "sha256"], []
        now, state, size = None, None, 0

        def rows(found: Sequence[tuple]):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in found], kinds[0]), pa.array([r[1] for r in found], pa.int64()),
                 pa.array([r[2] for r in found], pa.string())], names)

        kinds: list = []
        for batch in batches:
            kinds = [batch.schema.field(0).type]
            for own, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = part.as_py() if part.is_valid else b""
                raw = raw.encode() if isinstance(raw, str) else raw
                if state is None or own != now:
                    if state is not None:
                        done.append((now, size, state.hexdigest()))
                    now, state, size = own, hashlib.sha256(), 0
                else:
                    state.update(between)
                    size += len(between)
                state.update(raw)
                size += len(raw)
                if len(done) >= _ROWS:
                    yield rows(done)
                    done = []
        if state is not None:
            done.append((now, size, state.hexdigest()))
        if done:
            yield rows(done)

    ordered = pieces.select(key, order, piece).repartition(F.col(key)).sortWithinPartitions(key, order)
    found = ordered.select(key, piece).mapInArrow(step, f"key {kind}, bytes bigint, sha256 string")
    return found.withColumnRenamed("key", key)
