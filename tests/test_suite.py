"""Loading, checks before a suite and the report after it."""

import pytest
from pyspark.errors import PySparkException

from lexitally.operators import corpus, participation
from lexitally.plans import suite
from lexitally.sources import schemas

RUNS = [(f, n, j, r, 10.0 * n + r, 0, True, "d", "u")
        for f in ("hadoop", "spark") for n in (1, 2) for j in ("wordcount", "minmax") for r in (1, 2, 3)]
GRID = {"framework": ["hadoop", "spark"], "nodes": [1, 2], "job": ["wordcount", "minmax"]}


def contents(spark, n):
    return spark.createDataFrame([(f"f{i}", f"text {i}") for i in range(n)], "name STRING, text STRING")


def test_shards_are_loaded_once_and_whole(spark, tmp_path):
    texts = contents(spark, 5)
    files, target = corpus.manifest(texts), str(tmp_path / "in")
    assert [suite.load_shard(files, texts, 2, i, target) for i in range(2)] == [3, 2]
    loaded = spark.read.parquet(target)
    assert {(r.name, r.text, r.shard) for r in loaded.collect()} == {
        (f"f{i}", f"text {i}", i % 2) for i in range(5)}
    with pytest.raises(PySparkException):
        suite.load_shard(files, texts, 2, 1, target)
    with pytest.raises(ValueError, match="missing"):
        suite.load_shard(files, texts.where("name <> 'f2'"), 1, 0, str(tmp_path / "other"))
    with pytest.raises(ValueError, match="missing"):
        suite.load_shard(files.where("name = 'f0'"), texts, 2, 1, str(tmp_path / "other"))


def test_preflight(spark):
    texts = contents(spark, 3)
    files = corpus.manifest(texts)
    workers = spark.createDataFrame([("ALIVE", "a"), ("DEAD", "b")], "state STRING, host STRING")
    assert suite.preflight(files, files, workers, 1).isEmpty()
    told = corpus.manifest(texts.selectExpr("replace(name, 'f2', 'f9') name", "replace(text, '1', '7') text"))
    found = suite.preflight(files, told, workers, 2)
    assert {tuple(r) for r in found.collect()} == {
        ("extra", "f2"), ("missing", "f9"), ("wrong", "f1"), ("workers", "1 live, 2 expected")}


def write(spark, rows, path):
    spark.createDataFrame(rows, schemas.TIMINGS).write.option("header", True).csv(str(path))
    return str(path)


def test_report(spark, tmp_path):
    paths = [write(spark, [r for r in RUNS if r[0] == f], tmp_path / f) for f in GRID["framework"]]
    rows = suite.report(spark, paths, GRID).collect()
    assert [(r.framework, r.nodes, r.job) for r in rows] == sorted({r[:3] for r in RUNS})
    assert all((r.runs, r.median, r.below, r.above) == (3, 10.0 * r.nodes + 2, 1, 1) for r in rows)
    with pytest.raises(ValueError, match="groups"):
        suite.report(spark, paths[:1], GRID)
    bad = write(spark, [(*RUNS[0][:6], False, "d", "u")], tmp_path / "bad")
    with pytest.raises(Exception, match="unverified run"):
        suite.report(spark, [*paths, bad]).collect()


def test_report_refuses_another_header(spark, tmp_path):
    names = schemas.names(schemas.TIMINGS)
    (tmp_path / "t.csv").write_text(",".join([names[1], names[0], *names[2:]]) + "\n1,spark,minmax,1,1.0,0,True,d,u\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        suite.report(spark, [str(tmp_path / "t.csv")]).collect()


def test_hosts_by_run(spark):
    ids = spark.createDataFrame([("run-1", "job_1"), ("run-1", "job_2"), ("run-2", "job_3")], "log STRING, id STRING")
    hosts = spark.createDataFrame([("job_1", "a", 2), ("job_2", "a", 3), ("job_2", "b", 1)],
                                  "log STRING, host STRING, tasks BIGINT")
    found = participation.by_run(ids, hosts)
    assert {tuple(r) for r in found.collect()} == {("run-1", "a", 5), ("run-1", "b", 1)}
    assert [r.log for r in participation.logs_without(ids, found).collect()] == ["run-2"]


def test_who_took_part(spark, tmp_path):
    logs = spark.createDataFrame([("run-1", "job_1_1 and job_1_2"), ("run-2", "job_2_1")], "log STRING, value STRING")
    hosts = spark.createDataFrame([("job_1_1", "a", 2), ("job_1_2", "b", 3), ("job_2_1", "a", 1)],
                                  "log STRING, host STRING, tasks BIGINT")
    raw = spark.createDataFrame([("job_1_1", "SUCCEEDED")], "log STRING, state STRING")
    suite.took_part(logs, raw, hosts, str(tmp_path / "out"))
    found = spark.read.json(str(tmp_path / "out/hosts"))
    assert {(r.log, r.host, r.tasks) for r in found.collect()} == {("run-1", "a", 2), ("run-1", "b", 3), ("run-2", "a", 1)}
    assert spark.read.json(str(tmp_path / "out/attempts")).count() == 1
    silent = logs.unionByName(spark.createDataFrame([("run-3", "none")], "log STRING, value STRING"))
    with pytest.raises(PySparkException, match="no job id in run-3"):
        suite.took_part(silent, raw, hosts, str(tmp_path / "ids"))
    with pytest.raises(PySparkException, match="no host in run-2"):
        suite.took_part(logs, raw, hosts.where("log <> 'job_2_1'"), str(tmp_path / "hosts"))
