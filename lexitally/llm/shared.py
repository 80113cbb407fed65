"""What the operators share: tables, shipping of the code, and results kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, ship, spread

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the given folder; `spark.lexitally.spread`, unset by default, deals its rows to so
    many tasks first."""
    tasks = spark.conf.get("spark.lexitally.spread", None)
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"), tasks and int(tasks))


def arrow(df: DataFrame, step: Callable[[Iterable], Iterable], schema: str) -> DataFrame:
    """`mapInArrow` with the code at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(step, schema)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go as soon as it has ended. Left to itself Spark keeps them until
    the driver happens to collect its garbage, and those of all steps of an operator add up."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def settle(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here, a lost executor costs
    nothing that came before, and a join of the result can split skewed partitions on both sides."""
    return _written(df, name)[0]


class Intermediates:
    """What an operator settles on its way. Each result is deleted once those that follow from it are
    settled too: nothing reads it again, also not to make good for a lost executor."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        found, path = _written(df, name)
        self.paths.setdefault(name, []).append(path)
        return found

    def done(self, *names: str) -> None:
        """Delete the results of these names, of all without one."""
        for name in names or list(self.paths):
            for path in self.paths.pop(name, []):
                place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def unit_hash(*columns: str) -> F.Column:
    """Number in [0, 1) from the hash of the columns, the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def portions(batch: pa.RecordBatch, column: int, size: int = 1 << 20, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices of about `size` bytes of text in a column and `rows` rows at most, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, end - at)
        at = end
