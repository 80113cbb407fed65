"""One query per operator over the test tables.

The tables stand in for the files of a counting suite: a document for a corpus file, an event
for a measured run or a finished task, a page for a log. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import session
from .functions import fields, text
from .operators import compare, corpus, counts, counts_arrow, extremes, measures, participation, sequential
from .sources import files as stored
from .sources import readers, schemas, writers

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    """A table whose rows are about to be exploded or parsed. `spark.lexitally.spread`, unset by
    default, deals them to so many tasks first."""
    tasks = spark.conf.get("spark.lexitally.spread", None)
    return session.spread(table(spark, sf, name), tasks and int(tasks))


def file_name(ident: str = "doc_id"):
    return F.concat(F.lit("doc"), F.col(ident).cast("string"), F.lit(".txt"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.manifest(table(spark, sf, "documents"), file_name())


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as timed runs; an `error` event is a run that failed."""
    failed = F.col("event_type") == "error"
    return table(spark, sf, "events").select(
        F.when(F.col("user_id") % 2 == 0, "hadoop").otherwise("spark").alias("framework"),
        F.when(F.col("user_id") % 3 == 0, 1).otherwise(2).alias("nodes"),
        F.col("event_type").alias("job"),
        F.col("event_id").alias("repetition"),
        F.col("value").alias("seconds"),
        F.when(failed, 1).otherwise(0).alias("exit_code"),
        (~failed).alias("verified"),
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return measures.timing_summary(runs(spark, sf).where(measures.is_verified()))


def words_of(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    return counts.word_count(texts(spark, sf, name))


# --- words and characters ---------------------------------------------------------------------

def lines(spark, sf):
    return counts.lines(texts(spark, sf), keep=["doc_id"])


def tokens(spark, sf):
    return counts.tokens(texts(spark, sf), keep=["doc_id"])


def chars(spark, sf):
    return counts.char_pairs(texts(spark, sf), keep=["doc_id"])


def chars_arrow(spark, sf):
    return counts_arrow.char_pairs(texts(spark, sf), keep=["doc_id"])


def word_count(spark, sf):
    return words_of(spark, sf)


def char_count(spark, sf):
    return counts.char_count(texts(spark, sf))


def char_count_arrow(spark, sf):
    return counts_arrow.char_count(texts(spark, sf))


def minmax(spark, sf):
    return extremes.extremes(words_of(spark, sf))


def merge_counts(spark, sf):
    parts = [words_of(spark, sf, t) for t in ("documents", "benchmark", "conversations")]
    return counts.merge_counts(*parts)


def merge_extremes(spark, sf):
    # Halves of one table by a hash of the word have no key in common.
    half = F.pmod(F.xxhash64("word"), F.lit(2))
    found = words_of(spark, sf).withColumn("half", half)
    return extremes.merge_extremes(extremes.extremes(found, by=["half"]))


def scaled_counts(spark, sf):
    return counts.scale_counts(words_of(spark, sf, "benchmark"), 14)


def strip_eol(spark, sf):
    ended = F.concat("text", F.lit("\r\n"))
    return table(spark, sf, "documents").select(
        "doc_id", text.strip_record_end(ended).alias("text"))


def normalize_text(spark, sf):
    # Documents as they might arrive: byte-order mark, CRLF or lone CR.
    end = F.when(F.col("doc_id") % 2 == 0, "\r\n").otherwise("\r")
    raw = F.concat(F.lit(text.BYTE_ORDER_MARK), F.replace("text", F.lit("\n"), end))
    return table(spark, sf, "documents").select("doc_id", text.normalize_text(raw).alias("text"))


def valid_documents(spark, sf):
    found = corpus.valid_documents(table(spark, sf, "documents"), "LICENSE", 1000)
    return found.select("doc_id", text.byte_length("text").alias("bytes"))


# --- result files -----------------------------------------------------------------------------

def format_counts(spark, sf):
    return writers.format_counts(words_of(spark, sf))


def parse_counts(spark, sf):
    # Every kind of bad line next to the good ones.
    n = F.col("n")
    line = (F.when(n % 5 == 0, F.col("word"))
            .when(n % 5 == 1, fields.tsv_line("word", "n", F.lit("x")))
            .when(n % 5 == 2, fields.tsv_line("word", F.lit("z")))
            .when(n % 5 == 3, F.concat(fields.tsv_line("word", "n"), F.lit(" ")))
            .otherwise(fields.tsv_line("word", "n")))
    return compare.parse_counts(words_of(spark, sf).select(line.alias("value")))


def _written(spark, sf):
    path = session.new_path(spark, "counts")
    writers.write_counts(words_of(spark, sf), path)
    return path


def write_counts(spark, sf):
    return spark.read.text(_written(spark, sf))


def read_counts(spark, sf):
    return readers.read_counts(spark, _written(spark, sf), "word").drop("problem")


def expected_answers_arrow(spark, sf):
    # Objects of the words with a hash in common, more of them for more documents, written line by
    # line; '' stands before the first word.
    path = session.new_path(spark, "expected")
    objects = table(spark, sf, "documents").count() // 1000 + 1
    bucket = F.pmod(F.xxhash64("word"), F.lit(objects))
    name = F.to_json(F.array("word"))
    counted = words_of(spark, sf).select(
        bucket.alias("bucket"), F.lit(1).alias("at"),
        F.concat(F.lit(", "), F.substr(name, F.lit(2), F.char_length(name) - 2), F.lit(": "), F.col("n").cast("string")).alias("value"))
    ends = spark.range(objects).select(F.col("id").alias("bucket"), F.inline(F.array(
        F.struct(F.lit(0).alias("at"), F.lit('{"wordcount": {"": 0').alias("value")),
        F.struct(F.lit(2).alias("at"), F.lit('}, "charcount": {"U+0061": 1}}').alias("value")))))
    _write_buckets(counted.unionByName(ends), ["at"], path)
    found = readers.read_expected(spark, path, "wordcount")
    return found.where(F.col("key") != "").withColumnRenamed("key", "word")


def _write_buckets(rows, order, path):
    """`value` of the rows as lines, a folder and a file for each bucket."""
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", *order)
    dealt.select("bucket", "value").write.partitionBy("bucket").text(path)


def _bucket(path="path"):
    return F.regexp_extract(path, "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")


# --- corpus -----------------------------------------------------------------------------------

def manifest(spark, sf):
    return files(spark, sf)


def corpus_totals(spark, sf):
    return corpus.corpus_totals(files(spark, sf))


def fingerprint(spark, sf):
    return corpus.fingerprint(files(spark, sf))


def fingerprint_diff(spark, sf):
    other = table(spark, sf, "documents").withColumn("text", text.normalize_text("text"))
    return corpus.fingerprint_diff(
        corpus.fingerprint(files(spark, sf)),
        corpus.fingerprint(corpus.manifest(other, file_name())))


def replicate(spark, sf):
    books = table(spark, sf, "benchmark").select(
        "item_id", text.byte_length("text").alias("bytes"), text.sha256("text").alias("sha256"))
    copied = corpus.replicate(books, corpus.copies_for(books, 1 << 20), "item_id")
    return copied.select("name", "copy", "item_id", "bytes", "sha256")


def shards(spark, sf):
    named = table(spark, sf, "documents").select("doc_id", text.byte_length("text").alias("bytes"))
    return corpus.with_shard(named, 2, ["doc_id"])


def _labelled(spark, sf):
    suffix = F.when(F.col("toxic") == 1, ".bak").otherwise(".txt")
    name = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), suffix)
    return table(spark, sf, "labels").select(name.alias("name"))


def listing_diff(spark, sf):
    return compare.listing_diff(_labelled(spark, sf), files(spark, sf))


def missing_files(spark, sf):
    return compare.missing_files(_labelled(spark, sf), files(spark, sf))


def content_diff(spark, sf):
    edited = F.replace("text", F.lit("License"), F.lit("Licence"))
    declared = table(spark, sf, "documents").withColumn("text", edited)
    return compare.content_diff(files(spark, sf), corpus.manifest(declared, file_name()))


def duplicate_keys(spark, sf):
    return compare.duplicate_keys(files(spark, sf), "sha256")


def _written_documents(spark, sf):
    """Documents as the lines of files of up to a thousand each."""
    path = session.new_path(spark, "corpus")
    docs = table(spark, sf, "documents").select(
        F.expr("doc_id div 1000").alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("value"))
    _write_buckets(docs, ["doc_id"], path)
    return stored.listing(spark, path)


def file_listing_arrow(spark, sf):
    return _written_documents(spark, sf).select(_bucket(), "bytes")


def file_hashes_arrow(spark, sf):
    return stored.hashes(_written_documents(spark, sf)).select(_bucket(), "bytes", "sha256")


def file_pieces_arrow(spark, sf):
    pieces = stored.pieces(_written_documents(spark, sf))
    return sequential.sha256_of_pieces(pieces, "path", "offset", "piece").select(_bucket(), "bytes", "sha256")


# --- verification -----------------------------------------------------------------------------

def verify_counts(spark, sf):
    actual = words_of(spark, sf)
    n = F.col("n")
    expected = actual.where(n != 3).select(
        F.when(n == 7, F.concat(F.lit("x-"), "word")).otherwise(F.col("word")).alias("word"),
        F.when(n == 5, n + 1).otherwise(n).alias("n"))
    return compare.verify_counts(actual, expected)


def verify_summary(spark, sf):
    docs = texts(spark, sf)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    halves = counts.tokens(docs.withColumn("english", english), keep=["english"]).groupBy("english", "word").agg(
        F.count(F.lit(1)).alias("n"))
    return compare.verify_summary(counts.merge_counts(halves), counts.word_count(docs))


def canonical_digest(spark, sf):
    return compare.canonical_digest(words_of(spark, sf), ["word", "n"])


def digest_tree(spark, sf):
    return compare.digest_tree(words_of(spark, sf), ["word"], ["word", "n"], 2)


def _nearly(counts):
    """The same counts, of the words that begin with a Z some changed and some left out."""
    z, n = F.startswith("word", F.lit("Z")), F.col("n")
    return counts.where(~z | (n != 2)).select("word", F.when(z & (n == 1), n + 1).otherwise(n).alias("n"))


def digest_tree_diff(spark, sf):
    actual = words_of(spark, sf)
    trees = [compare.digest_tree(counted, ["word"], ["word", "n"], 3) for counted in (actual, _nearly(actual))]
    return compare.digest_tree_diff(*trees)


def branch_violations(spark, sf):
    actual = words_of(spark, sf)
    return compare.branch_violations(actual, _nearly(actual), ["word"], ["n"], 3)


# --- measurements -----------------------------------------------------------------------------

def timing_summary(spark, sf):
    return summary(spark, sf)


def error_bars(spark, sf):
    return measures.error_bars(summary(spark, sf))


def unverified_runs(spark, sf):
    return measures.unverified_runs(runs(spark, sf))


def speedup(spark, sf):
    return measures.speedup(summary(spark, sf), "nodes", 1, 2)


def step_cost(spark, sf):
    return measures.step_cost(summary(spark, sf), "job", "view", "purchase")


def scaling_fit(spark, sf):
    size = F.col("repetition")
    timed = runs(spark, sf).where(measures.is_verified()).withColumn("mib", size).withColumn(
        "seconds", 5 + size * 0.01 + F.col("seconds") / 100)
    return measures.scaling_fit(timed, ["framework", "nodes"], "mib", "seconds")


def completeness(spark, sf):
    grid = {"lang": ["de", "en", "es", "it"], "source": [f"src{i}" for i in range(20)]}
    return measures.completeness(table(spark, sf, "documents"), grid, 12)


def _timing_lines(spark, sf):
    """Timing files, one for the runs of a hundred users or so, in which some lines are broken."""
    path = session.new_path(spark, "timings")
    told = [F.col(c).cast("string") for c in ("framework", "nodes", "job", "repetition")]
    k = F.col("repetition") % 10
    seconds = F.when(k == 1, "oops").otherwise(F.col("repetition").cast("string"))
    verified = F.when(k == 2, "maybe").otherwise(F.col("verified").cast("string"))
    whole = F.concat_ws(",", *told, seconds, F.col("exit_code").cast("string"), verified, F.lit(""), F.lit(""))
    line = F.when(k == 3, F.concat_ws(",", *told)).when(k == 4, F.concat(whole, F.lit(",more"))).otherwise(whole)
    rows = runs(spark, sf).select(F.expr("repetition div 1000").alias("bucket"), F.col("repetition").alias("at"), line.alias("value"))
    heads = rows.select("bucket").distinct().select(
        "bucket", F.lit(-1).cast("bigint").alias("at"), F.lit(",".join(schemas.names(schemas.TIMINGS))).alias("value"))
    _write_buckets(rows.unionByName(heads), ["at"], path)
    return path


def timing_rejects(spark, sf):
    found = readers.rejects(readers.read_timings(spark, _timing_lines(spark, sf), "report"))
    return found.select(_bucket("file"), "line", "problem", "value")


def event_rejects(spark, sf):
    # Every third event is cut short, every fifth is followed by another.
    path = session.new_path(spark, "events")
    event = F.to_json(F.struct(F.lit(participation.TASK_END).alias("Event"), F.col("event_id").alias("Stage ID")))
    ident = F.col("event_id")
    line = F.when(ident % 3 == 0, F.substr(event, F.lit(1), F.char_length(event) - 1)).when(
        ident % 5 == 0, F.concat(event, F.lit(" "), event)).otherwise(event)
    rows = table(spark, sf, "events").select(F.expr("event_id div 1000").alias("bucket"), F.col("event_id").alias("at"), line.alias("value"))
    _write_buckets(rows, ["at"], path)
    found = readers.rejects(readers.read_event_log(spark, path, "report"))
    return found.select(_bucket("file"), "line", "problem", "value")


def timings_appended(spark, sf):
    # The second time adds nothing.
    path = session.new_path(spark, "timings")
    rows = runs(spark, sf).withColumns({"output_sha256": F.lit("d"), "output_uri": F.lit("u")})
    rows = rows.withColumn("repetition", F.col("repetition").cast("int"))
    for _ in range(2):
        writers.append_timings(rows, path, "suite-1")
    return readers.read_timings(spark, path).drop("output_sha256", "output_uri")


def run_ids(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fields.run_id("ts", "event_type", "user_id").alias("run_id"))


# --- participation ----------------------------------------------------------------------------

def _event_lines(spark, sf):
    """Events as lines of an event log, in the engine's own nested form."""
    k = F.from_json("props", "k INT")["k"]
    host = F.concat(F.lit("node"), k.cast("string"))
    kind = F.when(F.col("event_type") == "view", "SparkListenerTaskStart").otherwise(
        participation.TASK_END)
    reason = F.when(F.col("event_type") == "error", F.lit("ExceptionFailure")).when(
        F.col("event_type") != "signup", participation.SUCCESS)
    event = F.to_json(F.struct(
        kind.alias("Event"), F.lit(0).alias("Stage ID"), F.struct(host.alias("Host")).alias("Task Info"),
        F.struct(reason.alias("Reason")).alias("Task End Reason")))
    log = F.concat(F.lit("app-"), F.col("user_id").cast("string"))
    return texts(spark, sf, "events").select(log.alias("log"), event.alias("value"))


def task_participation(spark, sf):
    events = readers.parse_events(_event_lines(spark, sf), "value", "log")
    return participation.task_participation(events)


_HOST = r"^https?://([^/]+)/"


def _page_logs(spark, sf):
    return table(spark, sf, "pages").select(
        F.regexp_extract("url", _HOST, 1).alias("log"), F.col("url").alias("value"))


def job_ids(spark, sf):
    return participation.job_ids(_page_logs(spark, sf), pattern=r"\b[a-z]+/\d+\b")


def attempt_hosts(spark, sf):
    # Each page is a job-history answer with two attempts, the first of which may have failed.
    host = F.concat(F.regexp_extract("url", _HOST, 1), F.lit(":8042"))
    state = F.when(F.startswith("url", F.lit("https")), participation.SUCCEEDED).otherwise("FAILED")
    answer = F.to_json(F.struct(F.struct(F.array(
        F.struct(state.alias("state"), host.alias("nodeHttpAddress")),
        F.struct(F.lit(participation.SUCCEEDED).alias("state"), host.alias("nodeHttpAddress")),
    ).alias("taskAttempt")).alias("taskAttempts")))
    job = F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1)
    attempts = table(spark, sf, "pages").select(
        job.alias("log"), F.from_json(answer, schemas.ATTEMPTS).alias("a")).select("log", "a.*")
    return participation.attempt_hosts(attempts)


def log_context(spark, sf):
    marker = "RUN_CONTEXT "
    log = F.concat(F.lit("starting\nat "), F.lit(marker), "props",
                   F.lit("\n" + marker + '{"k": -1}\ndone\n'))
    logs = texts(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("log"), log.alias("value"))
    return participation.log_context(
        counts.lines(logs, "value", keep=["log"]), marker, "k INT", line="line", order=["line_no"])


def live_hosts(spark, sf):
    workers = table(spark, sf, "events").select(
        F.col("event_type").alias("state"), F.col("user_id").alias("host"))
    return participation.live_hosts(workers, 150, live="click")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    lines, tokens, chars, chars_arrow, word_count, char_count, char_count_arrow, minmax, merge_counts, merge_extremes,
    scaled_counts, strip_eol, normalize_text, valid_documents, format_counts,
    parse_counts, write_counts, read_counts, manifest, corpus_totals, fingerprint,
    fingerprint_diff, replicate, shards, listing_diff, missing_files, content_diff,
    duplicate_keys, verify_counts, verify_summary, canonical_digest, timing_summary, error_bars,
    unverified_runs, speedup, step_cost, scaling_fit, completeness, run_ids, task_participation,
    job_ids, attempt_hosts, log_context, live_hosts, expected_answers_arrow, file_listing_arrow, file_hashes_arrow,
    file_pieces_arrow, digest_tree, digest_tree_diff, branch_violations, timing_rejects, event_rejects, timings_appended,
)}
