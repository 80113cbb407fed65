"""Listings, contents of any size, JSON of any size, malformed lines and repeated appends."""

import hashlib
import json
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexitally.operators import compare, measures, sequential
from lexitally.sources import files, readers, schemas, writers
from lexitally.sources.json_items import Reader, items

HEADER = ",".join(schemas.names(schemas.TIMINGS))


@pytest.fixture
def folder(tmp_path):
    contents = {"a.txt": b"abc" * 5000, "empty.txt": b"", "with space+%41=.txt": "ü".encode(), "below/e2": b"", "below/k=1/x": b"\n"}
    for name, content in contents.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    (tmp_path / "in/_SUCCESS").write_bytes(b"")
    return str(tmp_path / "in"), {os.path.basename(n): c for n, c in contents.items()}


def test_listing_finds_what_nobody_declared(spark, folder):
    path, contents = folder
    listed = readers.read_listing(spark, path)
    assert {r.name: r.bytes for r in listed.collect()} == {n: len(c) for n, c in contents.items()}
    declared = spark.createDataFrame([(n,) for n in contents if n != "empty.txt"], "name STRING")
    assert [tuple(r) for r in compare.listing_diff(listed, declared).collect()] == [("undeclared", "empty.txt")]
    assert files.listing(spark, path).rdd.getNumPartitions() == 3  # a folder each
    assert {r.name for r in files.listing(spark, f"{path}/*.txt").collect()} == {n for n in contents if n.endswith(".txt")}
    with pytest.raises(FileNotFoundError):
        files.listing(spark, f"{path}/none")


def test_hashes_of_files_and_of_their_pieces(spark, folder):
    path, contents = folder
    want = {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}
    assert {r.name: (r.bytes, r.sha256) for r in readers.read_files(spark, path).collect()} == want
    pieces = files.pieces(files.listing(spark, path), 1024, 4096)
    assert pieces.agg(F.max(F.length("piece"))).first()[0] == 1024 and pieces.count() == 15 + 4
    found = sequential.sha256_of_pieces(pieces, "path", "offset", "piece").collect()
    assert {(r.bytes, r.sha256) for r in found} == set(want.values())
    with pytest.raises(ValueError):
        files.pieces(files.listing(spark, path), 8, 4)


def test_a_file_of_more_than_two_gigabytes(spark, tmp_path):
    size = (2 << 30) + 5
    with open(tmp_path / "large", "wb") as f:
        f.truncate(size)  # takes no room
        f.seek(size - 3)
        f.write(b"end")
    plain = hashlib.sha256()
    with open(tmp_path / "large", "rb") as f:
        while block := f.read(1 << 24):
            plain.update(block)
    assert tuple(readers.read_files(spark, str(tmp_path)).first()) == ("large", size, plain.hexdigest())


def test_pieces_are_joined_in_order(spark):
    rows = [(k, i, None if i == 3 else f"{k}{i}") for k in ("a", "b", "c") for i in (9, 3, 1, 20)]
    df = spark.createDataFrame(rows, "k STRING, i INT, piece STRING").repartition(3)
    found = {r.k: (r.bytes, r.sha256) for r in sequential.sha256_of_pieces(df, "k", "i", "piece", b", ").collect()}
    whole = {k: f"{k}1, , {k}9, {k}20".encode() for k in ("a", "b", "c")}
    assert found == {k: (len(w), hashlib.sha256(w).hexdigest()) for k, w in whole.items()}
    assert sequential.sha256_of_pieces(df.where("false"), "k", "i", "piece").isEmpty()


# --- malformed lines --------------------------------------------------------------------------

GOOD = "spark,1,minmax,1,2.5,0,True,d,u"
BROKEN = {"spark,1,minmax,2,oops,0,True,d,u": "seconds", "spark,1,minmax,3,1,0,True": "fields", f"{GOOD},more": "fields",
          "spark,x,minmax,4,1e1,,maybe,,": "nodes, exit_code, verified", "spark,1,minmax,1,NaN,0,True,,": "seconds",
          "spark,99999999999,minmax,1,1,0,True,,": "nodes", '"open': "nodes, repetition, seconds, exit_code, verified"}


def test_broken_timings_are_reported_or_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, GOOD, "", *BROKEN, '"a,b",1,x,5,1,0,false,,"q""x"']) + "\n")
    (tmp_path / "b.csv").write_text(f"nodes,framework\r\n{GOOD}\r\n")
    (tmp_path / "none.csv").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "60")  # many splits, which the numbers go across
        report = readers.read_timings(spark, str(tmp_path), "report")
        found = {(os.path.basename(r.file), r.line): r for r in readers.rejects(report).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.pop(("b.csv", 1)).problem == f"CSV header does not conform to {HEADER}"
    assert {k: r.value for k, r in found.items()} == {("a.csv", i + 4): v for i, v in enumerate(BROKEN)}
    kinds = {r.value: r.problem for r in found.values()}
    assert {v: p for v, p in kinds.items() if v != '"open'} == {v: p for v, p in BROKEN.items() if v != '"open'}
    assert kinds['"open'] in ("fields", BROKEN['"open'])
    sound = [tuple(r) for r in report.where("problem IS NULL").select("framework", "seconds", "verified", "output_uri").collect()]
    assert sorted(sound) == sorted([("spark", 2.5, True, "u"), ("spark", 2.5, True, "u"), ("a,b", 1.0, False, 'q"x')])
    with pytest.raises(PySparkException, match=r"csv:\d+: "):
        readers.read_timings(spark, str(tmp_path)).collect()
    # A summary cannot lose the run either.
    with pytest.raises(Exception, match="a.csv:4: seconds"):
        measures.timing_summary(readers.read_timings(spark, str(tmp_path / "a.csv"))).collect()
    with pytest.raises(ValueError):
        readers.read_timings(spark, str(tmp_path), "ignore")


def test_broken_events_are_reported_or_fail(spark, tmp_path):
    good = '{"Event": "SparkListenerTaskEnd", "Stage ID": 1, "more": [1, {"a": 2}]}'
    broken = [good[:-1], "", "[1]", '"s"', "null", f"{good} {good}", '{"Stage ID": "x"}', '{"Task Info": 5}', "{'Event': 1}"]
    (tmp_path / "app-1").write_text("\n".join([good, *broken, f" {good} ", "{}"]) + "\n")
    found = readers.rejects(readers.read_event_log(spark, str(tmp_path), "report")).orderBy("line").collect()
    assert [(r.line, r.problem, r.value) for r in found] == [(i + 2, "event", v) for i, v in enumerate(broken)]
    with pytest.raises(PySparkException, match="app-1: event"):
        readers.read_event_log(spark, str(tmp_path)).collect()
    (tmp_path / "app-1").write_text(f"{good}\n")
    assert [(r.log, r["Stage ID"]) for r in readers.read_event_log(spark, str(tmp_path)).collect()] == [("app-1", 1)]


# --- appends ----------------------------------------------------------------------------------

def test_an_append_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "timings")
    rows = [("spark", 1, "minmax", i, 21.5, 0, True, None, 'u"q') for i in (1, 2)]
    runs = spark.createDataFrame(rows, schemas.TIMINGS)
    for _ in range(2):
        writers.append_timings(runs, path, "20260101T000000Z-spark-1n")
    assert sorted(map(tuple, readers.read_timings(spark, path).collect())) == rows
    # One run more, and one that is new only under another id.
    more = spark.createDataFrame([rows[0], ("spark", 1, "minmax", 3, 1.0, 1, False, "d", None)], schemas.TIMINGS)
    writers.append_timings(more, path, "20260101T000000Z-spark-1n")
    assert readers.read_timings(spark, path).count() == 3
    writers.append_timings(runs, path, "another")
    assert readers.read_timings(spark, path).count() == 5
    with pytest.raises(ValueError):
        writers.append_timings(runs, path, "a/b")


def test_a_torn_append_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path / "timings")
    rows = spark.createDataFrame([("spark", 1, "minmax", 1, 1.0, 0, True, "d", "u")], schemas.TIMINGS)
    writers.append_timings(rows, path, "r1")
    bad = rows.withColumn("repetition", F.lit(9)).withColumn("seconds", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(PySparkException):
        writers.append_timings(bad, path, "r1")
    (tmp_path / "timings/_staged-0").mkdir()
    (tmp_path / "timings/_staged-0/part-0.csv").write_text("half a li")
    assert readers.read_timings(spark, path).collect() == rows.collect()
    writers.append_timings(rows.withColumn("repetition", F.lit(2)), path, "r1")
    assert readers.read_timings(spark, path).count() == 2


# --- JSON -------------------------------------------------------------------------------------

def flat(value, path=()):
    if isinstance(value, dict):
        for k, v in value.items():
            yield from flat(v, (*path, k))
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from flat(v, (*path, str(i)))
    elif isinstance(value, str):
        yield list(path), "string", value
    elif value is None or isinstance(value, bool):
        yield list(path), json.dumps(value), None
    else:
        yield list(path), "number", json.dumps(value)


def blocks(text, n):
    return iter([text[i:i + n] for i in range(0, len(text), n)])


def test_reader_against_the_standard_one():
    rng = random.Random(1)

    def some(depth):
        kind = rng.randrange(8 if depth else 6)
        if kind == 6:
            return [some(depth - 1) for _ in range(rng.randrange(4))]
        if kind == 7:
            return {rng.choice("abc\"\\é") + str(i): some(depth - 1) for i in range(rng.randrange(5))}
        return rng.choice(["", 'q"\\', "é 🙂", "\n", "x" * 40, 0, -1, 12345, 1.5, -2e-7, 1e300, True, False, None])

    for _ in range(500):
        value = some(4)
        text = json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        for n in (1, 3, 1000):
            assert list(Reader(blocks(text, n))) == list(flat(value))


@pytest.mark.parametrize("text", ['', '{', '{"a"', '{"a":', '{"a":1', '{"a":1,', '{"a":1,}', '[1,]', '[1 2]', '{"a" 1}', '{1:2}',
                                  'tru', 'truex', '"abc', '01', '1 2', '{} {}', '[}', '{]', '-', '[1]]', '{"a":1 "b":2}', ',', '{"a":1},',
                                  '"\x01"', '[,1]', '{,}', ':', '[1}', '{"a":[1}'])
def test_what_is_no_document(text):
    for n in (1, 100):
        with pytest.raises(ValueError):
            list(Reader(blocks(text, n)))


def test_expected_answers_of_many_keys(spark, tmp_path):
    counts = {f'w{i}"é': i for i in range(20000)}
    told = json.dumps({"charcount": {"U+0061": 3}, "wordcount": counts, "minmax": {"MIN": ["a", 1], "MAX": ["b", 2]}})
    (tmp_path / "e.json").write_text(told[:-1] + ', "more": {"wordcount": {"no": 1}}}')
    found = readers.read_expected(spark, str(tmp_path), "wordcount")
    assert {r.key: r.n for r in found.collect()} == counts
    assert sorted(map(tuple, readers.read_expected(spark, str(tmp_path), "minmax").collect())) == [("MAX", "b", 2), ("MIN", "a", 1)]
    (tmp_path / "e.json").write_text('{"wordcount": {"a": 1, "b": 5, "a": 2}}')
    assert sorted(map(tuple, readers.read_expected(spark, str(tmp_path), "wordcount").collect())) == [("a", 2), ("b", 5)]
    assert readers.read_expected(spark, str(tmp_path), "minmax").isEmpty()
    for wrong in ('{"wordcount": {"a": 1.5}}', '{"wordcount": {"a": 1'):
        (tmp_path / "e.json").write_text(wrong)
        with pytest.raises(PySparkException):
            readers.read_expected(spark, str(tmp_path), "wordcount").collect()


def test_manifest_of_many_files(spark, tmp_path):
    listed = [{"name": f"f{i}", "bytes": i, "sha256": "x", "other": [1]} for i in range(3000)]
    told = {"unique_books": 1, "files": listed, "sources": [{"id": 7, "title": None, "url": "u"}]}
    (tmp_path / "manifest.json").write_text(json.dumps(told, indent=1))
    found = readers.read_manifest_files(spark, str(tmp_path)).orderBy("idx").collect()
    assert [tuple(r) for r in found] == [(i, f["name"], f["bytes"], "x") for i, f in enumerate(listed)]
    assert [tuple(r) for r in readers.read_manifest_sources(spark, str(tmp_path)).collect()] == [(0, 7, None, "u", None, None)]


def test_items_of_several_files_and_small_blocks(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"é": [i, {"x": "🙂"}], "none": {}}, ensure_ascii=False), encoding="utf-8")
    found = items(files.listing(spark, str(tmp_path)), 3).orderBy("file", "at").collect()
    assert [(r.at, r.path, r.kind, r.value) for r in found][:2] == [(0, ["é", "0"], "number", "0"), (1, ["é", "1", "x"], "string", "🙂")]
    assert len(found) == 6
