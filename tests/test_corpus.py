"""Manifests, copies, shards and fingerprints."""

import hashlib
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexitally.operators import corpus, ranks
from lexitally.plans import jobs, prepare
from lexitally.sources import readers, schemas


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")


def test_manifest_totals_and_fingerprint(spark):
    texts = ["", "ü\n", "abc"]
    files = corpus.manifest(docs(spark, texts), F.col("id"))
    got = {r.name: (r.bytes, r.sha256) for r in files.collect()}
    hashes = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert got == {i: (len(t.encode()), h) for i, (t, h) in enumerate(zip(texts, hashes))}
    assert tuple(corpus.corpus_totals(files).first()) == (3, 6)
    assert tuple(corpus.fingerprint(files).first()) == (6, 3, min(hashes)[:16])
    none = files.where("false")
    assert tuple(corpus.corpus_totals(none).first()) == (0, 0)
    assert corpus.fingerprint_diff(corpus.fingerprint(files), corpus.fingerprint(files)).first().equal
    assert not corpus.fingerprint_diff(corpus.fingerprint(files), corpus.fingerprint(none)).first().equal
    assert corpus.fingerprint_diff(corpus.fingerprint(none), corpus.fingerprint(none)).first().equal


@pytest.mark.parametrize("copies", [1, 2, 3, 4, 15, 16, 17, 50])
def test_replicate_makes_every_copy_once(spark, copies):
    rows = corpus.replicate(docs(spark, ["a", "b", "c"]), copies, "id").collect()
    assert sorted((r.id, r.copy) for r in rows) == [(i, c) for i in range(3) for c in range(copies)]
    assert {r.name for r in rows} == {f"doc{i}-copy{c:03d}.txt" for i in range(3) for c in range(copies)}


def test_copies_reach_the_minimum(spark):
    files = corpus.manifest(docs(spark, ["abc", "defg"]), F.col("id"))
    for least, want in ((1, 1), (7, 1), (8, 2), (14, 2), (15, 3), (700, 100)):
        assert corpus.copies_for(files, least).first().copies == want
    assert corpus.replicate(files, corpus.copies_for(files, 15), "name").count() == 6
    for nothing in (files.where("false"), files.where("false").unionByName(files.limit(1).withColumn("bytes", F.lit(0)))):
        with pytest.raises(PySparkException, match="no bytes to repeat"):
            corpus.copies_for(nothing, 5).collect()
    for bad in (0, -1):
        with pytest.raises(ValueError):
            corpus.copies_for(files, bad)
        with pytest.raises(ValueError):
            corpus.replicate(files, bad, "name")


@pytest.mark.parametrize("blocks", [None, 1, 7])
def test_row_index_follows_the_order(spark, blocks):
    names = [f"n{random.Random(i).random()}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "name STRING").repartition(5)
    got = {r.name: r.idx for r in ranks.row_index(df, ["name"], blocks=blocks).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names))}


def test_shards_are_disjoint_and_whole(spark):
    df = spark.createDataFrame([(f"f{i:03d}",) for i in range(11)], "name STRING")
    parts = [[r.name for r in corpus.shard(df, 2, i).collect()] for i in range(2)]
    assert sorted(parts[0]) == [f"f{i:03d}" for i in range(0, 11, 2)]
    assert sorted(parts[0] + parts[1]) == [f"f{i:03d}" for i in range(11)]
    for shards, index in ((2, 2), (1, -1)):
        with pytest.raises(ValueError):
            corpus.shard(df, shards, index)
    with pytest.raises(ValueError):
        corpus.with_shard(df, 0)


def test_expected_documents(spark):
    df = spark.createDataFrame([(1, "say The Marker here"), (2, "marker"), (3, "none of it at all"),
                                (4, None)], "id INT, text STRING")
    assert [r.id for r in corpus.valid_documents(df, "MARKER", 10).collect()] == [1]
    assert [r.id for r in corpus.unexpected_documents(df, "MARKER", 10).collect()] == [2, 3, 4]


def originals(spark):
    rows = [(1, "one", "u1", bytearray("﻿The Book\r\na b\rb".encode())),
            (2, "two", "u2", bytearray("the book 世界 b\n".encode()))]
    return spark.createDataFrame(rows, "id INT, title STRING, url STRING, content BINARY")


def test_prepare(spark, tmp_path):
    path = str(tmp_path / "corpus")
    done = prepare.prepare(originals(spark), "THE BOOK", 10, 100, path)
    normal = ["The Book\na b\nb\n", "the book 世界 b\n"]
    size = sum(len(t.encode()) for t in normal)
    k = -(-100 // size)
    files = {r.name: (r.bytes, r.sha256) for r in done.files.collect()}
    assert files == {
        f"doc{i}-copy{c:03d}.txt": (len(t.encode()), hashlib.sha256(t.encode()).hexdigest())
        for i, t in enumerate(normal, 1) for c in range(k)}
    header = done.header.first()
    assert (header.unique_books, header.copies_per_book, header.total_bytes) == (2, k, k * size)
    assert {r.key: r.n for r in done.word_counts.collect()}["b"] == 3 * k
    prepare.write(done, path)
    assert readers.read_answers(spark, f"{path}/expected/wordcount").count() == 7
    ends = readers.read_answers(spark, f"{path}/expected/minmax", schemas.EXTREMES)
    assert {tuple(r) for r in ends.collect()} == {tuple(r) for r in done.minmax.collect()}
    assert spark.read.parquet(f"{path}/corpus").count() == 2 * k
    # The jobs over the copies give the answers counted on the single documents.
    for job in jobs.JOBS:
        out = str(tmp_path / job)
        jobs.run(spark, job, f"{path}/corpus", out, form="parquet")
        schema = schemas.EXTREMES if job == "minmax" else schemas.COUNTS
        expected = readers.read_answers(spark, f"{path}/expected/{job}", schema)
        assert jobs.verify(spark, job, out, expected).first().verified
    with pytest.raises(PySparkException):
        prepare.write(done, path)


def test_prepare_refuses_unexpected_documents(spark, tmp_path):
    for marker, least in (("ANOTHER BOOK", 10), ("THE BOOK", 10_000)):
        with pytest.raises(PySparkException, match="unexpected document"):
            prepare.prepare(originals(spark), marker, least, 100, str(tmp_path / f"{marker}{least}"))
    with pytest.raises(PySparkException, match="no bytes to repeat"):
        prepare.prepare(originals(spark).where("false"), "THE BOOK", 10, 100, str(tmp_path / "none"))
