"""Readers. Paths may be directories, globs or lists, as in `spark.read`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fields import base_name, decoded, to_integer
from ..functions.text import column
from ..operators.compare import parse_counts, parse_extremes
from . import files, json_items, schemas

Paths = str | Sequence[str]


def read_lines(spark: SparkSession, path: Paths, partitions: int | None = None) -> DataFrame:
    """`text`, one row per record. LF, CRLF and CR end a record; files split at any record, so
    `partitions` (a least number, by a shuffle) is only for a few files that cannot be split."""
    found = spark.read.text(path).withColumnRenamed("value", "text")
    return found.repartition(partitions) if partitions else found


def read_counts(spark: SparkSession, path: Paths, key: str = "key") -> DataFrame:
    """key, n, problem (see `parse_counts`). Split at the tab, not by the CSV reader, whose
    quoting would change keys that hold quotes or backslashes."""
    return parse_counts(spark.read.text(path), "value", key)


def read_extremes(spark: SparkSession, path: Paths, key: str = "word") -> DataFrame:
    return parse_extremes(spark.read.text(path), "value", key)


def read_documents(spark: SparkSession, path: Paths) -> DataFrame:
    """name, content of whole files of at most 2 GB; Spark leaves those of zero bytes out. `read_files`
    and `files.pieces` have neither limit."""
    return (spark.read.format("binaryFile").load(path)
            .select(base_name("path").alias("name"), "content"))


def read_listing(spark: SparkSession, path: Paths, declared: DataFrame | None = None) -> DataFrame:
    """name, bytes of every file, also of those without a byte. What is `declared` plays no part."""
    return files.listing(spark, path).select("name", "bytes")


def read_files(spark: SparkSession, path: Paths, declared: DataFrame | None = None) -> DataFrame:
    """name, bytes, sha256 of every file, of any size. What is `declared` plays no part."""
    return files.hashes(files.listing(spark, path)).select("name", "bytes", "sha256")


def read_manifest(spark: SparkSession, path: Paths) -> DataFrame:
    """The manifest object, one row: for a small foreign file, which is one value here. For others
    there are `read_manifest_files` and `read_manifest_sources`."""
    return spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path)


def manifest_files(manifest: DataFrame) -> DataFrame:
    """idx, name, bytes, sha256: the array holds the order, so no sort is needed."""
    return manifest.select(F.posexplode("files").alias("idx", "f")).select(
        F.col("idx").cast("bigint").alias("idx"), "f.*")


def manifest_sources(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("sources").alias("s")).select("s.*")


def _entries(spark: SparkSession, path: Paths, member: str, ddl: str) -> DataFrame:
    """idx and the fields of the objects in a list that is a member of a JSON object of any size."""
    found = json_items.items(files.listing(spark, path))
    steps = F.col("path")
    fields = found.where((F.size(steps) == 3) & (F.get(steps, F.lit(0)) == member)).select(
        "file", "at", F.get(steps, F.lit(1)).cast("bigint").alias("idx"), F.get(steps, F.lit(2)).alias("field"), "value")

    def last(name: str, kind: str) -> Column:
        return F.max_by("value", F.when(F.col("field") == name, F.col("at"))).cast(kind).alias(name)

    # The last of several members of one name, as in most readers.
    columns = [last(*f.split()) for f in ddl.split(", ")]
    return fields.groupBy("file", "idx").agg(*columns).drop("file")


def read_manifest_files(spark: SparkSession, path: Paths) -> DataFrame:
    """idx, name, bytes, sha256 of a manifest object with any number of files."""
    return _entries(spark, path, "files", schemas.FILES)


def read_manifest_sources(spark: SparkSession, path: Paths) -> DataFrame:
    """idx, id, title, url, download_sha256, download_bytes of the same."""
    return _entries(spark, path, "sources", schemas.ORIGINS)


def read_expected(spark: SparkSession, path: Paths, job: str) -> DataFrame:
    """Expected answers of one job out of a single-object file with any number of keys: key, n, or
    which, word, n for minmax.

    Keys become rows as they are read. Of a key that occurs more than once the last value counts; the
    order of keys means nothing. A count that is no integer fails the query.
    """
    if job not in ("wordcount", "charcount", "minmax"):
        raise ValueError(f"unknown job {job!r}")
    found = json_items.items(files.listing(spark, path))
    step = lambda i: F.get("path", F.lit(i))
    own = found.where(step(0) == job)
    if job == "minmax":
        # The word and its count are the two elements of a list.
        ends = own.where(F.size("path") == 3).groupBy(step(1).alias("which")).agg(*[
            F.max_by("value", F.when(step(2) == place, F.col("at"))).alias(name) for place, name in (("0", "word"), ("1", "n"))])
        return ends.select("which", "word", _count(F.col("n"), F.col("word")).alias("n"))
    last = own.where(F.size("path") == 2).groupBy(step(1).alias("key")).agg(F.max_by("value", "at").alias("n"))
    return last.select("key", _count(F.col("n"), F.col("key")).alias("n"))


def _count(text: Column, key: Column) -> Column:
    n = to_integer(text)
    return F.when(n.isNotNull(), n).otherwise(F.raise_error(F.concat(F.lit("no count of "), key)).cast("bigint"))


def read_answers(spark: SparkSession, path: Paths, schema: str = schemas.COUNTS) -> DataFrame:
    """Expected answers written by `write_answers`, one JSON object per row."""
    return spark.read.schema(schema).json(path)


def _file_name() -> Column:
    return decoded("_metadata.file_name")


def _stem() -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(_file_name(), r"(?<=.)\.[^.]*\z", "")


def numbered_lines(spark: SparkSession, path: Paths) -> DataFrame:
    """file (its whole path), line (from 1) and value of every line, folders below `path` included.

    Files may be split anywhere between lines: a line's number is its place in its split and the
    number of lines in the splits before, which one row for each split supplies.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        decoded("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return lines.join(starts, ["file", "block"]).select(
        "file", (F.col("base") + F.col("at") + 1).alias("line"), "value")


def _checked(rows: DataFrame, invalid: str, kept: Sequence[str]) -> DataFrame:
    """`rows` with a `problem`, or, when strict, those columns of it that are kept; the query that
    reads them fails on the first problem and says where it is."""
    if invalid == "report":
        return rows
    if invalid != "strict":
        raise ValueError(f"invalid must be strict or report, not {invalid!r}")
    place = F.concat_ws(":", F.col("file"), F.col("line").cast("string"))
    reason = F.concat(place, F.lit(": "), F.col("problem"))
    sound = F.when(F.col("problem").isNull(), True).otherwise(F.raise_error(reason).cast("boolean"))
    return rows.where(sound).select(*kept)


def read_timings(spark: SparkSession, paths: Paths, invalid: str = "strict") -> DataFrame:
    """All runs of several timing files or folders of them.

    A file whose first line is not the header, a line without exactly its fields, and a value that is
    not what its column holds are problems. `strict` fails on the first; `report` gives every line as
    file, line, value, its fields as far as they can be read, and the `problem`, NULL for sound ones.
    Lines without a character are no runs.
    """
    lines = numbered_lines(spark, paths)
    header = ",".join(schemas.names(schemas.TIMINGS))
    first = F.col("line") == 1
    # Left out by a generator and not by a condition: conditions on the fields, which may fail a query,
    # can be put before another condition, but never before what generates the fields.
    skipped = (first & (F.col("value") == header)) | (F.col("value") == "")
    kept = F.when(skipped, F.array().cast("array<string>")).otherwise(F.array("value"))
    told = lines.select("file", "line", F.explode(kept).alias("value"))
    parsed = parse_timings(told, "value", ["file", "line", "value"])
    problem = F.when(first, f"CSV header does not conform to {header}").otherwise(F.col("problem"))
    return _checked(parsed.withColumn("problem", problem), invalid, schemas.names(schemas.TIMINGS))


def parse_timings(df: DataFrame, line: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """keep, the fields of a timing line, and `problem`: NULL, 'fields' where their number is wrong,
    or the names of the columns whose value cannot be read. An empty value of a column that holds text
    is NULL, any other empty value cannot be read."""
    kinds = {f.split()[0]: f.split()[1] for f in schemas.TIMINGS.split(", ")}
    shape = ", ".join(f"{name} STRING" for name in kinds)
    # The parser would turn a value it cannot read into NULL, so it is only asked for text.
    row = F.from_csv(F.col(line), f"{shape}, _bad STRING", {"columnNameOfCorruptRecord": "_bad", "escape": '"'})
    split = df.select(*keep, row.alias("_row"))
    values = {name: _typed(F.col(f"_row.{name}"), kind) for name, kind in kinds.items()}
    wrong = [F.when(value.isNull(), name) for name, value in values.items() if kinds[name] != "STRING"]
    bad = F.concat_ws(", ", *wrong)
    problem = F.when(F.col("_row").isNull() | F.col("_row._bad").isNotNull(), "fields").when(bad != "", bad)
    return split.select(*keep, *[v.alias(name) for name, v in values.items()], problem.alias("problem"))


def _typed(text: Column, kind: str) -> Column:
    if kind == "STRING":
        return text
    if kind == "INT":
        return to_integer(text).try_cast("int")
    if kind == "BOOLEAN":
        # How the truth values are written.
        return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)
    # Fixed value: a decimal number, with a point and an exponent or without.
    number = text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    return F.when(number, F.trim(text).try_cast(kind))


def read_event_log(spark: SparkSession, path: Paths, invalid: str = "strict") -> DataFrame:
    """log (the file name, which is the application id) and the event fields.

    A line that is not one JSON object, or has something else where a field should be, is a problem.
    `strict` fails on the first; `report` gives every line as file, line, value, log, the fields as far
    as they can be read, and the `problem`, NULL for sound ones.
    """
    if invalid == "strict":  # which needs no numbers, so nothing is joined to the lines
        lines = spark.read.text(path).select(decoded("_metadata.file_path").alias("file"), F.lit(None).alias("line"), "value")
    else:
        lines = numbered_lines(spark, path)
    lines = lines.withColumn("log", base_name("file"))
    return _checked(parse_events(lines, "value", "log", ["file", "line", "value"]), invalid, ["log", *_EVENT_FIELDS])


_EVENT_FIELDS = ["Event", "`Stage ID`", "`Task Info`", "`Task End Reason`"]


def parse_events(df: DataFrame, json: Column | str, log: Column | str, keep: Sequence[str] | None = None) -> DataFrame:
    """Like `read_event_log` for events held in a column: log and the fields, and with `keep`, even an
    empty one, those columns and `problem` (NULL, or 'event')."""
    if keep is None:
        event = F.from_json(column(json), schemas.EVENT).alias("e")
        return df.select(column(log).alias("log"), event).select("log", "e.*")
    shape = f"{schemas.EVENT}, _bad STRING"
    event = F.from_json(column(json), shape, {"columnNameOfCorruptRecord": "_bad"}).alias("e")
    # The reader of fields stops after the first object: as a list, it must be the only element.
    listed = F.try_parse_json(F.concat(F.lit("["), column(json), F.lit("]")))
    whole = listed.isNotNull() & F.try_variant_get(listed, "$[1]", "string").isNull() & F.ltrim(column(json)).startswith("{")
    found = df.select(*keep, column(log).alias("log"), event, whole.alias("whole"))
    problem = F.when(F.col("e").isNull() | F.col("e._bad").isNotNull() | ~F.coalesce("whole", F.lit(False)), "event")
    return found.select(*keep, "log", *[F.col(f"e.{f}") for f in _EVENT_FIELDS], problem.alias("problem"))


def rejects(report: DataFrame) -> DataFrame:
    """file, line, problem, value of the lines that a report finds fault with."""
    return report.where(F.col("problem").isNotNull()).select("file", "line", "problem", "value")


def read_run_logs(spark: SparkSession, path: Paths) -> DataFrame:
    """log (file name without suffix), value (one line), block and at.

    `block` is where the line's split starts in the file and `at` grows along a split, so
    (block, at) is the order of lines in a log however the file was split.
    """
    return spark.read.text(path).select(
        _stem().alias("log"), "value",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def read_attempts(spark: SparkSession, path: Paths) -> DataFrame:
    """log and the attempts of saved job-history answers."""
    return spark.read.schema(schemas.ATTEMPTS).option("multiLine", True).json(path).select(
        _stem().alias("log"), "*")


def read_workers(spark: SparkSession, path: Paths, framework: str) -> DataFrame:
    """state, host of each worker in a saved cluster state; none is no row."""
    shape = {"spark": schemas.STANDALONE_WORKERS, "hadoop": schemas.YARN_NODES}
    if framework not in shape:
        raise ValueError(f"framework must be spark or hadoop, not {framework!r}")
    found = spark.read.schema(shape[framework]).option("multiLine", True).json(path)
    if framework == "spark":
        return found.select(F.inline("workers"))
    return found.select(F.inline("nodes.node")).withColumnRenamed("nodeHostName", "host")
