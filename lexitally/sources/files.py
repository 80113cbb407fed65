"""Whole files as they lie in folders: every name, also of files without a byte, and contents of any size.

Folders are listed by a data source whose partitions are folders, and contents are read from front to
back, in pieces of a fixed size, so neither names nor contents are ever held in one place. Paths are
opened by Arrow's file systems (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator, Sequence
from functools import partial
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

PIECE = 1 << 20   # bytes of a piece
SPAN = 64 << 20   # bytes of a file that one row of the plan of `pieces` stands for

LISTING = "path STRING, name STRING, bytes BIGINT"


def _opened(uri: str):
    """File system and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _entries(uri: str) -> Iterator:
    """What lies directly in a folder, names with a leading `_` or `.` left out, as everywhere in Spark."""
    from pyarrow import fs

    system, path = _opened(uri)
    if system.get_file_info(path).type != fs.FileType.Directory:
        return
    for found in system.get_file_info(fs.FileSelector(path)):
        if not found.base_name.startswith(("_", ".")):
            yield found


def _joined(uri: str, name: str) -> str:
    return uri.rstrip("/") + "/" + quote(name, safe="=")


class Folder(InputPartition):
    def __init__(self, uri: str):
        self.uri = uri


class ListingReader(DataSourceReader):
    def __init__(self, roots: Sequence[str]):
        self.roots = roots

    def partitions(self) -> Sequence[InputPartition]:
        """The folders below the roots. Only their names are kept here."""
        from pyarrow import fs

        found, waiting = [], list(self.roots)
        while waiting:
            uri = waiting.pop()
            found.append(Folder(uri))
            waiting += [_joined(uri, e.base_name) for e in _entries(uri) if e.type == fs.FileType.Directory]
        return found

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs

        system, path = _opened(partition.uri)
        alone = system.get_file_info(path)
        if alone.type == fs.FileType.File:
            yield partition.uri, alone.base_name, alone.size
            return
        for e in _entries(partition.uri):
            if e.type == fs.FileType.File:
                yield _joined(partition.uri, e.base_name), e.base_name, e.size


class Listing(DataSource):
    """All files in some folders and the folders in them."""

    @classmethod
    def name(cls) -> str:
        return "lexitally_listing"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(json.loads(self.options["roots"]))


def _roots(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """URIs of the folders or files that `path` names; patterns are resolved as `spark.read` does."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for one in [path] if isinstance(path, str) else path:
        place = jvm.org.apache.hadoop.fs.Path(one)
        matches = place.getFileSystem(conf).globStatus(place)
        if not matches:
            raise FileNotFoundError(one)
        found += [m.getPath().toUri().toString() for m in matches]
    return [f"file://{u[5:]}" if u.startswith("file:/") and not u.startswith("file://") else u for u in found]


def listing(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """path, name, bytes of every file in `path` (folders, files or patterns) and the folders below.

    Files without a byte are there like all others. The driver learns the names of folders, each of
    which is listed again by a task of its own.
    """
    ship(spark)
    spark.dataSource.register(Listing)
    return spark.read.format(Listing.name()).option("roots", json.dumps(_roots(spark, path))).load()


def _hashed(batches: Iterable, size: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            state, total = hashlib.sha256(), 0
            for _, piece in _read(path, 0, None, size):
                state.update(piece)
                total += len(piece)
            yield pa.RecordBatch.from_pylist([{"path": path, "name": name, "bytes": total, "sha256": state.hexdigest()}])


def _read(path: str, start: int, end: int | None, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, piece) of a part of a file; an empty file is one empty piece."""
    system, place = _opened(path)
    with system.open_input_file(place) as f:
        end = f.size() if end is None else end
        if not end:
            yield 0, b""
        f.seek(start)
        while start < end:
            piece = f.read(min(size, end - start))
            if not piece:
                raise OSError(f"{path} has become shorter")
            yield start, piece
            start += len(piece)


def hashes(listed: DataFrame, size: int = PIECE) -> DataFrame:
    """path, name, bytes, sha256 of the contents of `listed` files (path, name).

    A hash runs from a file's front to its back, so a file is read by one task, with one piece in
    memory and nothing shuffled but names.
    """
    ship(listed.sparkSession)
    dealt = listed.select("path", "name").repartition(F.col("path"))
    return dealt.mapInArrow(partial(_hashed, size=size), "path string, name string, bytes bigint, sha256 string")


def _pieces(batches: Iterable, size: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for path, start, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            for offset, piece in _read(path, start, end, size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([offset]), pa.array([piece], pa.binary())], ["path", "offset", "piece"])


def pieces(listed: DataFrame, size: int = PIECE, span: int = SPAN) -> DataFrame:
    """path, offset, piece: the contents of `listed` files (path, bytes) in rows of at most `size` bytes.

    Spans of a file are read side by side, so one file of any size keeps many tasks busy; its hash
    follows from `sequential.sha256_of_pieces`. A file without a byte is one empty piece.
    """
    if not 0 < size <= span:
        raise ValueError("size must be positive and no more than span")
    ship(listed.sparkSession)
    last = F.greatest(F.col("bytes") - 1, F.lit(0))
    starts = listed.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(span).cast("bigint"))).alias("start"))
    dealt = starts.select("path", "start", F.least(F.col("start") + span, "bytes").alias("end")).repartition("path", "start")
    return dealt.mapInArrow(partial(_pieces, size=size), "path string, offset bigint, piece binary")
