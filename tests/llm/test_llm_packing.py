import random
from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from lexitally.llm import packing, queries


def check(rows, sizes, capacity):
    """Every piece once, bins within bounds, no gap and no conflict."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.size))
        bins[r.bin_id].append(r)
    assert {k: sum(s for _, s in sorted(v)) for k, v in pieces.items()} == sizes
    assert all([p for p, _ in sorted(v)] == list(range(len(v))) for v in pieces.values())
    for held in bins.values():
        held.sort(key=lambda r: r.place)
        at = 0
        for i, r in enumerate(held):
            assert (r.place, r.start) == (i, at)
            at += r.size
        assert at <= capacity
        for column in ("source", "cluster"):
            values = [r[column] for r in held if r[column] is not None]
            assert len(values) == len(set(values))


def plain(rows, capacity):
    """Best fit by looking at every bin: bin and start of each (size, source, cluster)."""
    bins, out = [], []
    for size, source, cluster in rows:
        able = [b for b in range(len(bins)) if bins[b][0] >= size and source not in bins[b][1] and cluster not in bins[b][2]]
        best = min(able, key=lambda b: (bins[b][0], b)) if able else len(bins)
        if not able:
            bins.append([capacity, set(), set()])
        out.append((best, capacity - bins[best][0]))
        bins[best][0] -= size
        bins[best][1] |= {source} - {None}
        bins[best][2] |= {cluster} - {None}
    return out


def test_tightest_compatible_bin():
    r = random.Random(5)
    rows = [(r.randrange(1, 100), r.choice([None, *"abcd"]), r.choice([None, *range(40)])) for _ in range(400)]
    packer = packing.Packer(100)
    assert [(b, s) for b, _, s in (packer.place(*row) for row in rows)] == plain(rows, 100)


def test_odd_rows(spark):
    rows = [(1, 250, "a", 1), (2, 100, "a", 2), (3, None, None, None), (4, 0, None, None), (5, -3, "b", 3), (None, 7, "c", 4),
            (6, 100, "c", 4), (7, 101, "d", None)] + [(10 + i, 10, "hot", 9) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, n INT, source STRING, cluster INT").selectExpr("*", "1 AS piece", "2 AS shard")
    found = packing.pack(df, "doc_id", F.col("n"), F.col("source"), F.col("cluster"), 100, 16).collect()
    check(found, {k: max(1, n or 1) for k, n, _, _ in rows}, 100)
    again = packing.pack(df, "doc_id", F.col("n"), F.col("source"), F.col("cluster"), 100, 16).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert packing.pack(df.where("false"), "doc_id", F.col("n"), F.col("source"), F.col("cluster")).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, 5, "a", 1)] * 4, "doc_id BIGINT, n INT, source STRING, cluster INT")
    found = packing.pack(df, "doc_id", F.col("n"), F.col("source"), F.col("cluster"), 100).collect()
    assert len({r.bin_id for r in found}) == 4


def test_query(spark, sf):
    sizes = {d: len((t or "").split()) + 1 for d, t in brute.rows(sf, "SELECT doc_id, text FROM documents")}
    rows = queries.op5_packing(spark, sf).collect()
    check(rows, sizes, packing.CAPACITY)
    order = sorted(rows, key=lambda r: (-r.size, r.doc_id, r.piece, r.source, r.cluster))  # one shard at this size
    assert [(r.bin_id, r.start) for r in order] == plain([(r.size, r.source, r.cluster) for r in order], packing.CAPACITY)


def test_near_copies_share_no_bin(spark, sf):
    found = {r.doc_id: r.cluster for r in queries.op5_packing(spark, sf).collect()}
    docs = brute.rows(sf, "SELECT doc_id, lower(text) FROM documents")
    known = {d: c for d, (n, c, _) in brute.components(docs).items() if n}
    groups = defaultdict(set)
    for d, c in known.items():
        groups[c].add(found[d])
    assert len(groups) < len(known) and all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_clusters_of_odd_rows(spark):
    same = " ".join(f"w{i}" for i in range(100))
    rows = [(1, same, "a"), (2, f"\t{same.upper()}\r\n", "b"), (3, f"{same} more", "c"), (3, "other", "c"), (None, same, "d"),
            (None, same, "d"), (4, None, "e"), (5, None, "f"), (6, " ", "g")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")
    clusters = defaultdict(list)
    for r in packing.near_copies(df, "doc_id", "text", "source").collect():
        clusters[r.cluster].append((r.source, r.size))
    assert sorted(map(sorted, clusters.values())) == [
        [("a", 101), ("b", 101), ("c", 102), ("d", 101), ("d", 101)], [("c", 2)], [("e", 1)], [("f", 1)], [("g", 1)]]
    exact = [r.c for r in df.select(packing.copies(F.col("text")).alias("c")).collect()]
    assert exact[0] == exact[1] != exact[2] and exact[6] is exact[7] is None


def test_near_copies_take_up_each_text_once(spark, monkeypatch):
    """Sizes and clusters come from one pass over the texts, without a regular expression in each."""
    def never(*_):
        raise AssertionError("words counted apart")

    monkeypatch.setattr(packing, "n_words", never)
    df = spark.createDataFrame([(1, "a b\tc", "s"), (1, "a b\tc", "s"), (2, "\u0130stanbul\u00a0x y", None), (None, None, "s")],
                               "doc_id BIGINT, text STRING, source STRING")
    found = packing.near_copies(df, "doc_id", "text", "source")
    assert sorted((r.doc_id or 0, r.source or "", r.size) for r in found.collect()) == [
        (0, "s", 1), (1, "s", 4), (1, "s", 4), (2, "", 3)]
    assert found.schema["size"].dataType.simpleString() == "int"


def test_near_copies_of_odd_rows(spark):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(1, same, "a", 7), (1, same, "a", 7), (2, f"{same} more", "b", 7), (3, None, None, 7), (4, "", "a", 7), (4, "", "a", 7),
            (None, same, "c", 7), (5, "long " * 100_000, "a", 7)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, size INT")
    found = packing.near_copies(df, "doc_id", "text", "source")
    assert found.columns == ["doc_id", "source", "size", "cluster"] and found.count() == len(rows)
    by = {(r.doc_id, r.size): r.cluster for r in found.collect()}
    assert by[1, 31] == by[2, 32] and len({by[k] for k in ((1, 31), (3, 1), (4, 1), (5, 100_001))}) == 4
    assert packing.near_copies(df.where("false"), "doc_id", "text", "source").collect() == []
    with pytest.raises(ValueError):
        packing.near_copies(df, "doc_id", "text", "size")
