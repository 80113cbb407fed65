"""Merkle manifest against plain Python, with spans of three leaves up to all of them."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from lexitally.llm import merkle

SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING"
HEAD = ["doc_id", "source", "lang", "n_chars"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Root, and for each leaf the siblings (before, behind) on its way up."""
    ways, held = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, below = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i:i + 3]
            for k, leaves in enumerate(held[i:i + 3]):
                for leaf in leaves:
                    ways[leaf].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(h(*run))
            below.append(sum(held[i:i + 3], []))
        nodes, held = above, below
    return nodes[0], ways


def brute(docs):
    groups = {}
    for d in docs:
        groups.setdefault(d[1], []).append(d)
    made = []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        rows = sorted(groups[source], key=lambda d: (d[0] is not None, d[0] or 0, h(*map(field, d))))
        leaves = [h(*map(field, d)) for d in rows]
        made.append((rows, leaves, *tree(leaves)))
    out = []
    root, tops = tree([m[2] for m in made]) if made else (None, [])
    for (rows, leaves, subroot, ways), top in zip(made, tops, strict=True):
        for d, leaf, way in zip(rows, leaves, ways, strict=True):
            cut = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0 and d[4] is not None
            x = h(*map(field, (*d[:4], d[4].replace("\n", "") if cut else d[4])))
            for before, behind in way + top:
                x = h(before, x, behind)
            out.append((d[0], leaf, subroot, root, h(*(a + b for a, b in way + top)), x, x == root))
    return sorted(out, key=str)


def made(spark, docs):
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    bare = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(spark.createDataFrame(docs, SCHEMA), "doc_id", "source", [*HEAD, "text"], [*HEAD, bare])


def odd_docs():
    rng = random.Random(3)
    docs = [(i, rng.choice([None, "", "a", "é", "b", *["hot"] * 5]), rng.choice([None, "en"]), rng.choice([None, 3]),
             rng.choice([None, "", "x\ny", "plain", "é\n", "long " * 5000])) for i in range(300)]
    # Repeated rows, an id twice with different texts, null ids, a source of one row.
    return docs + [docs[0], docs[0], (None, "a", None, None, None), (5, "a", "xx", 1, "again"),
                   (None, "zz", None, None, "one\nleaf")]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 3 ** levels)
    docs = odd_docs()
    assert sorted(map(tuple, made(spark, docs).collect()), key=str) == brute(docs)


def test_nothing_one_and_one_a_group(spark):
    assert made(spark, []).collect() == []
    for docs in ([(1, None, None, None, None)], [(i, str(i), None, 1, "\n") for i in range(5)]):
        assert sorted(map(tuple, made(spark, docs).collect()), key=str) == brute(docs)


def test_names_that_clash(spark):
    df = spark.createDataFrame([(i, i % 2, "t") for i in range(9)], "tree BIGINT, pos INT, h0 STRING")
    found = merkle.manifest(df, "tree", "pos", ["h0"], ["h0"]).collect()
    assert {r.tree for r in found} == set(range(9)) and all(r.verified for r in found)


def test_texts_do_not_move_and_spans_bound_the_windows(spark, sf):
    df = merkle.manifest(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "source", [*HEAD, "text"], [*HEAD, "text"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "text#" not in plan and "SinglePartition" not in plan
    windows = re.findall(r"windowspecdefinition\((\w+)#\d+L?, (\w+)#", plan)
    assert windows and set(windows) == {("tree", "span")}
