"""The character counts of `counts` with numpy over Arrow batches: the same results, asked for by
name. Each task folds its rows before the exchange; the code goes to the executors with the job."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import RECORD_ENDS
from ..session import ship

_ROWS = 256      # rows taken at a time
_CHARS = 1 << 20  # characters of them taken at a time


def _counted(batch) -> Iterator[tuple]:
    """Row, code point and count, for some characters of some rows after another."""
    import numpy as np

    for start in range(0, batch.num_rows, _ROWS):
        texts = [t or "" for t in batch.column(batch.num_columns - 1).slice(start, _ROWS).to_pylist()]
        whole, ends = "".join(texts), np.cumsum([len(t) for t in texts])
        for at in range(0, len(whole), _CHARS):
            codes = np.frombuffer(whole[at:at + _CHARS].encode("utf-32-le"), np.uint32).astype(np.int64)
            if not len(codes):
                continue
            # A table of rows by the code points that occur, counted without sorting.
            found = np.flatnonzero(np.bincount(codes))
            place = np.zeros(found[-1] + 1, np.int64)
            place[found] = np.arange(len(found))
            first = int(np.searchsorted(ends, at, "right"))
            cuts = np.clip(ends[first:] - at, 0, len(codes))
            row = np.repeat(np.arange(len(cuts)), np.diff(cuts, prepend=0))
            table = np.bincount(row * len(found) + place[codes], minlength=len(cuts) * len(found)).reshape(-1, len(found))
            table[:, np.isin(found, [ord(c) for c in RECORD_ENDS])] = 0
            row, column = np.nonzero(table)
            yield start + first + row, found[column], table[row, column]


def _pairs(batches: Iterable) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for row, code, n in _counted(batch):
            at = pa.array(row)
            kept = [c.take(at) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(code, pa.int32()), pa.array(n, pa.int64())], [*batch.schema.names[:-1], "code", "n"])


def char_pairs(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """keep, ch, n: as `counts.char_pairs`, for any `keep`."""
    ship(df.sparkSession)
    kept = df.select(*keep, F.validate_utf8(text).alias("_text"))
    schema = T.StructType([f for f in kept.schema if f.name != "_text"])
    schema = schema.add("code", T.IntegerType()).add("n", T.LongType())
    counted = kept.mapInArrow(_pairs, schema).groupBy(*keep, "code").agg(F.sum("n").alias("n"))
    return counted.select(*keep, F.format_string("U+%04X", "code").alias("ch"), "n")


def char_count(df: DataFrame, text: str = "text") -> DataFrame:
    """ch (`U+XXXX`), n: as `counts.char_count`."""
    return char_pairs(df, text)
