"""Files: round trips, odd inputs, refusal to overwrite, logs and snapshots."""

import hashlib
import json

import pytest
from pyspark.errors import PySparkException

from lexitally import session
from lexitally.operators import compare, participation
from lexitally.plans import jobs
from lexitally.sources import readers, schemas, writers


def counts(spark, pairs):
    return spark.createDataFrame(pairs, "word STRING, n BIGINT")


def test_counts_round_trip(spark, tmp_path):
    pairs = [('"q"', 1), ("a,b\\", 2), ("'", 3), ("世界🙂", 4), ("\\t", 5), ("#x", 6), ("\x00", 7)]
    path = str(tmp_path / "out")
    writers.write_counts(counts(spark, pairs), path)
    found = readers.read_counts(spark, path, "word")
    assert sorted(map(tuple, found.collect())) == sorted((*p, None) for p in pairs)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        writers.write_counts(counts(spark, pairs), path)


def test_bad_lines(spark, tmp_path):
    (tmp_path / "part-0").write_text("a\na\t1\tx\na\tz\nb\t 2 \n\n")
    rows = readers.read_counts(spark, str(tmp_path / "part-*")).collect()
    assert [(r.key, r.n, r.problem) for r in rows] == [
        ("a", None, "arity"), ("a", None, "arity"), ("a", None, "integer"), ("b", 2, None),
        ("", None, "arity")]


def test_lines_of_a_file(spark, tmp_path):
    raw = "﻿A b\r\nc\rd\n\ne\x0bf\x85g h\n"
    (tmp_path / "a.txt").write_bytes(raw.encode())
    (tmp_path / "empty.txt").write_bytes(b"")
    rows = [r.text for r in readers.read_lines(spark, str(tmp_path)).collect()]
    assert sorted(rows) == sorted(["A b", "c", "d", "", "e\x0bf\x85g h"])


def test_files_include_empty_ones(spark, tmp_path):
    contents = {"a.txt": b"abc", "empty.txt": b"", "with space+%41.txt": "ü".encode()}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    declared = spark.createDataFrame([("a.txt", 3), ("gone.txt", 2), ("empty.txt", 0)], "name STRING, bytes BIGINT")
    found = {r.name: (r.bytes, r.sha256) for r in readers.read_files(spark, str(tmp_path), declared).collect()}
    assert found == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    listed = readers.read_listing(spark, str(tmp_path), declared)
    assert {r.name for r in listed.collect()} == set(contents)
    kinds = {(r.kind, r.name) for r in compare.listing_diff(listed, declared).collect()}
    assert kinds == {("unlisted", "gone.txt"), ("undeclared", "with space+%41.txt")}


def test_manifest_and_answers_as_one_object(spark, tmp_path):
    told = {"created_utc": "2026-09-24T00:00:00Z", "unique_books": 1, "copies_per_book": 2,
            "total_bytes": 6, "sources": [{"id": 7, "title": "t", "url": "u",
                                           "download_sha256": "s", "download_bytes": 3}],
            "files": [{"name": "b", "bytes": 3, "sha256": "x"}, {"name": "a", "bytes": 3, "sha256": "x"}],
            "normalization": "n", "word_rule": "w", "char_rule": "c"}
    (tmp_path / "manifest.json").write_text(json.dumps(told, indent=2))
    found = readers.read_manifest(spark, str(tmp_path / "manifest.json"))
    files = sorted(map(tuple, readers.manifest_files(found).collect()))
    assert files == [(0, "b", 3, "x"), (1, "a", 3, "x")]
    assert readers.manifest_sources(found).first().id == 7

    answers = {"wordcount": {"a": 2, '"': 1}, "charcount": {"U+0061": 2},
               "minmax": {"MIN": ['"', 1], "MAX": ["a", 2]}}
    (tmp_path / "expected.json").write_text(json.dumps(answers))
    path = str(tmp_path / "expected.json")
    assert {r.key: r.n for r in readers.read_expected(spark, path, "wordcount").collect()} == answers["wordcount"]
    assert {r.key: r.n for r in readers.read_expected(spark, path, "charcount").collect()} == answers["charcount"]
    ends = readers.read_expected(spark, path, "minmax").collect()
    assert {r.which: [r.word, r.n] for r in ends} == answers["minmax"]


def test_timings(spark, tmp_path):
    path = str(tmp_path / "timings")
    row = ("spark", 1, "minmax", 1, 21.5, 0, True, "d", "u")
    for i in (1, 2):
        writers.append_timings(spark.createDataFrame([row], schemas.TIMINGS), path)
    (tmp_path / "more.csv").write_text(
        ",".join(schemas.names(schemas.TIMINGS)) + "\nhadoop,2,wordcount,3,1.25,1,False,,u\n")
    found = readers.read_timings(spark, [path, str(tmp_path / "more.csv")]).collect()
    assert sorted(map(tuple, found)) == [
        ("hadoop", 2, "wordcount", 3, 1.25, 1, False, None, "u"), row, row]


def test_event_log(spark, tmp_path):
    end = lambda host, **r: {"Event": "SparkListenerTaskEnd", "Stage ID": 0,
                             "Task Info": {"Host": host, "Task ID": 1}, "Task End Reason": r}
    events = [{"Event": "SparkListenerLogStart", "Spark Version": "x"}, end("h1", Reason="Success"),
              end("h1", Reason="Success"), end("h2", Reason="ExceptionFailure"), end("h2"),
              end("h3", Reason="Success")]
    (tmp_path / "app-1").write_text("\n".join(map(json.dumps, events)))
    (tmp_path / "app-2").write_text(json.dumps(events[3]))
    found = participation.task_participation(readers.read_event_log(spark, str(tmp_path)))
    assert {tuple(r) for r in found.collect()} == {("app-1", "h1", 2), ("app-1", "h3", 1)}
    logs = spark.createDataFrame([("app-1",), ("app-2",)], "log STRING")
    assert [r.log for r in participation.logs_without(logs, found).collect()] == ["app-2"]


def test_run_logs(spark, tmp_path):
    (tmp_path / "wordcount-1.log").write_text(
        "x job_12_0001 job_12_0001\nmyjob_9_9 job_3_4x job_12_0002\n")
    (tmp_path / "min max+%41-1.log").write_text(
        'noise\nat CTX {"application_id": "app-1", "master": "m", "default_parallelism": 4}\n'
        'CTX {"application_id": "app-2", "master": "m", "default_parallelism": 4}\n')
    logs = readers.read_run_logs(spark, str(tmp_path / "*.log"))
    ids = participation.job_ids(logs)
    assert {tuple(r) for r in ids.collect()} == {("wordcount-1", "job_12_0001"), ("wordcount-1", "job_12_0002")}
    assert [r.log for r in participation.logs_without(logs, ids).collect()] == ["min max+%41-1"]
    context = participation.log_context(logs, "CTX ", schemas.CONTEXT)
    assert [tuple(r) for r in context.collect()] == [("min max+%41-1", "app-1", "m", 4)]


def test_first_context_of_a_log_in_many_splits(spark, tmp_path):
    lines = ["noise " * 20] * 3000
    for i in (700, 1500, 2900):
        lines[i] = f'CTX {{"k": {i}}}'
    (tmp_path / "long.log").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        logs = readers.read_run_logs(spark, str(tmp_path))
        assert logs.rdd.getNumPartitions() > 3
        found = participation.log_context(logs, "CTX ", "k INT").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [tuple(r) for r in found] == [("long", 700)]


def test_attempts(spark, tmp_path):
    told = {"taskAttempts": {"taskAttempt": [
        {"state": "SUCCEEDED", "nodeHttpAddress": "h1:8042", "id": "x"},
        {"state": "FAILED", "nodeHttpAddress": "h2:8042"},
        {"state": "SUCCEEDED", "nodeHttpAddress": "fe80::1:8042"}]}}
    (tmp_path / "job_1.json").write_text(json.dumps(told, indent=1))
    found = participation.attempt_hosts(readers.read_attempts(spark, str(tmp_path)))
    assert {tuple(r) for r in found.collect()} == {("job_1", "h1", 1), ("job_1", "fe80::1", 1)}
    raw = readers.read_attempts(spark, str(tmp_path / "job_1.json"))
    writers.write_participation(found, found.selectExpr("log", "'i' id"), raw, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/hosts")).count() == 2
    kept = spark.read.schema(raw.schema).json(str(tmp_path / "out/attempts"))
    assert kept.collect() == raw.collect()


def test_workers(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"workers": [
        {"state": "ALIVE", "host": "a"}, {"state": "ALIVE", "host": "a"}, {"state": "DEAD", "host": "b"}]}))
    (tmp_path / "y.json").write_text(json.dumps({"nodes": {"node": [
        {"state": "RUNNING", "nodeHostName": "a"}, {"state": "RUNNING", "nodeHostName": "b"}]}}))
    (tmp_path / "n.json").write_text(json.dumps({"nodes": None}))
    read = lambda name, framework: readers.read_workers(spark, str(tmp_path / name), framework)
    assert tuple(participation.live_hosts(read("s.json", "spark"), 1).first()) == (1, 1, True)
    yarn = participation.live_hosts(read("y.json", "hadoop"), 1, live="RUNNING")
    assert tuple(yarn.first()) == (2, 1, False)
    assert tuple(participation.live_hosts(read("n.json", "hadoop"), 1, live="RUNNING").first()) == (0, 1, False)
    with pytest.raises(ValueError):
        read("s.json", "other")


def test_shards_are_written_apart(spark, tmp_path):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "name STRING, shard INT")
    path = str(tmp_path / "shards")
    writers.write_shards(df, path)
    assert [r.name for r in spark.read.parquet(f"{path}/shard=1").collect()] == ["b"]
    with pytest.raises(PySparkException):
        writers.write_shards(df, path)


@pytest.mark.parametrize("job", jobs.JOBS)
def test_job_from_files_to_verified_output(spark, tmp_path, job):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("the cat the dog\n", encoding="utf-8")
    (tmp_path / "in/b.txt").write_text("世界 the\r\n", encoding="utf-8")
    out = str(tmp_path / "out")
    jobs.run(spark, job, str(tmp_path / "in"), out, partitions=2)
    texts = spark.createDataFrame([("the cat the dog\n世界 the",)], "text STRING")
    expected = jobs.result(job, texts)
    summary = jobs.verify(spark, job, out, expected).first()
    assert summary.verified and summary.n_actual == expected.count()
    assert len(list((tmp_path / "out").glob("part-*"))) <= (1 if job == "minmax" else 2)
    wrong = jobs.result(job, texts.selectExpr("concat(text, ' the zzz zzz zzz zzz zzz') text"))
    assert not jobs.verify(spark, job, out, wrong).first().verified
    with pytest.raises(PySparkException):
        jobs.run(spark, job, str(tmp_path / "in"), out)


@pytest.mark.parametrize("job", jobs.JOBS)
def test_job_on_an_empty_corpus(spark, tmp_path, job):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("")
    out = str(tmp_path / "out")
    jobs.run(spark, job, str(tmp_path / "in"), out)
    assert spark.read.text(out).isEmpty()
    assert jobs.verify(spark, job, out, jobs.result(job, spark.createDataFrame([], "text STRING"))).first().verified


def test_job_on_invalid_bytes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_bytes(b"a\xffb c\n")
    with pytest.raises(PySparkException):
        jobs.run(spark, "wordcount", str(tmp_path / "in"), str(tmp_path / "strict"))
    jobs.run(spark, "wordcount", str(tmp_path / "in"), str(tmp_path / "out"), invalid="replace", spread=2)
    assert {r.value for r in spark.read.text(str(tmp_path / "out")).collect()} == {"a\ufffdb\t1", "c\t1"}


def test_arguments_are_checked_before_any_job(spark):
    for call in (lambda: jobs.run(spark, "sum", "in", "out"),
                 lambda: jobs.run(spark, "wordcount", "in", "out", partitions=0),
                 lambda: jobs.run(spark, "wordcount", "in", "out", form="orc"),
                 lambda: jobs.run(spark, "wordcount", "in", "out", invalid="ignore"),
                 lambda: readers.read_expected(spark, "/root/testdata", "sum")):
        with pytest.raises(ValueError):
            call()
    found = jobs.context_line(spark).removeprefix(jobs.CONTEXT_MARKER)
    assert json.loads(found)["application_id"] == spark.sparkContext.applicationId


def test_shared_folder_is_the_configured_one(spark):
    assert session.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
