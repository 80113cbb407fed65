"""Timings: gate, exact medians, completeness, derived measures."""

import random
import statistics
from collections import defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lexitally.operators import measures, ranks

COLUMNS = ("framework STRING, nodes INT, job STRING, repetition INT, seconds DOUBLE, "
           "exit_code INT, verified BOOLEAN")
JOBS = ("wordcount", "charcount", "minmax")


def suite():
    rng = random.Random(3)
    return [(f, n, j, r, round(rng.uniform(10, 200), 6), 0, True)
            for f in ("hadoop", "spark") for n in (1, 2) for j in JOBS for r in (1, 2, 3)]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(suite(), COLUMNS)


def test_summary(runs):
    groups = defaultdict(list)
    for f, n, j, _, s, *_ in suite():
        groups[f, n, j].append(s)
    rows = measures.timing_summary(runs).collect()
    assert [tuple(r) for r in rows] == [
        (*k, 3, statistics.median(v), min(v), max(v)) for k, v in sorted(groups.items())]


@pytest.mark.parametrize("partitions", [1, 3])
def test_median_is_exact_for_any_group(spark, partitions):
    rng = random.Random(11)
    rows = [("hot", float(rng.randrange(1000)) / 4) for _ in range(3000)]
    rows += [("same", 7.5)] * 500 + [("one", 3.0), ("two", 1.0), ("two", 2.0), (None, 4.0), (None, 6.0)]
    rows += [(f"g{i % 40}", rng.gauss(0, 5)) for i in range(1001)] + [("two", None), ("none", None)]
    rng.shuffle(rows)
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(partitions)
    got = {r.g: (r.runs, r.median, r.min, r.max) for r in ranks.group_spread(df, ["g"], "v").collect()}
    want = {g: (len(v), statistics.median(v), min(v), max(v)) for g, v in groups.items()}
    assert got == {**want, "none": (0, None, None, None)}


def test_gate(spark, runs):
    assert measures.unverified_runs(runs).isEmpty()
    assert measures.require_verified(runs).count() == 36
    for bad in ((1, True), (0, False), (0, None), (None, True)):
        extra = spark.createDataFrame([("spark", 1, "minmax", 4, 1.0, *bad)], COLUMNS)
        mixed = runs.unionByName(extra)
        assert measures.unverified_runs(mixed).count() == 1
        with pytest.raises(PySparkException, match="unverified run"):
            measures.require_verified(mixed).groupBy("job").agg(F.max("seconds")).collect()


def test_completeness(spark, runs):
    grid = {"framework": ["hadoop", "spark"], "nodes": [1, 2], "job": list(JOBS)}
    assert measures.completeness(runs, grid, 3).isEmpty()
    fewer = runs.where("not (framework = 'spark' and job = 'minmax' and repetition = 2 and nodes = 1)")
    extra = spark.createDataFrame([("spark", 3, "minmax", r, 1.0, 0, True) for r in (1, 2, 3)], COLUMNS)
    gone = fewer.where("not (framework = 'hadoop' and nodes = 2 and job = 'charcount')")
    found = measures.completeness(gone.unionByName(extra), grid, 3).collect()
    assert {(r.framework, r.nodes, r.job, r.n, r.expected) for r in found} == {
        ("spark", 1, "minmax", 2, True), ("spark", 3, "minmax", 3, False),
        ("hadoop", 2, "charcount", 0, True)}


def test_derived(runs):
    summary = measures.timing_summary(runs)
    table = {(r.framework, r.nodes, r.job): r for r in summary.collect()}
    for r in measures.error_bars(summary).collect():
        s = table[r.framework, r.nodes, r.job]
        assert (r.below, r.above) == (round(s.median - s.min, 6), round(s.max - s.median, 6))
    rows = measures.speedup(summary, "nodes", 1, 2).collect()
    assert len(rows) == 6
    for r in rows:
        base, other = (table[r.framework, n, r.job].median for n in (1, 2))
        assert r.speedup == round(base / other, 6)
    rows = measures.speedup(summary, "framework", "hadoop", "spark").collect()
    assert len(rows) == 6
    for r in measures.step_cost(summary, "job", "wordcount", "minmax").collect():
        a, b = (table[r.framework, r.nodes, j].median for j in ("wordcount", "minmax"))
        assert r.cost == round(b - a, 6)


def test_published_ratios(spark):
    medians = [("hadoop", 1, 201.645), ("hadoop", 2, 144.840), ("spark", 1, 21.961), ("spark", 2, 16.882)]
    df = spark.createDataFrame([(f, n, "wordcount", m) for f, n, m in medians],
                               "framework STRING, nodes INT, job STRING, median DOUBLE")
    by_nodes = measures.speedup(df, "nodes", 1, 2, digits=2).collect()
    assert {r.framework: r.speedup for r in by_nodes} == {"hadoop": 1.39, "spark": 1.3}
    by_framework = measures.speedup(df, "framework", "hadoop", "spark", digits=2).collect()
    assert {r.nodes: r.speedup for r in by_framework} == {1: 9.18, 2: 8.58}


def test_fit(spark):
    rows = [("a", float(m), 5 + 0.1 * m) for m in (32, 256, 1024)] + [("flat", 1.0, 2.0), ("flat", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "g STRING, mib DOUBLE, seconds DOUBLE")
    found = {r.g: (r.runs, r.fixed, r.throughput)
             for r in measures.scaling_fit(df, ["g"], "mib", "seconds").collect()}
    assert found == {"a": (3, 5.0, 10.0), "flat": (2, 2.0, None)}


def test_exact_medians_of_odd_values(spark):
    rng = random.Random(1)
    odd = [5e-324, -5e-324, 0.0, -0.0, 1.0, 2.0, None, 1e300, -1e300, float("inf")]
    rows = [(g, h, rng.choice([rng.gauss(0, 1), rng.choice(odd)])) for g in (None, "a", "b", "c") for h in (1, None)
            for _ in range(rng.randrange(1, 40))]
    rows += [("nan", 1, float("nan")), ("nan", 1, 1.0), ("nan", 1, 2.0), ("none", 1, None), ("one", 1, 7.5)]
    rows += [("hot", 1, float(i % 1000) / 7) for i in range(4001)]
    df = spark.createDataFrame(rows, "g STRING, h INT, v DOUBLE")
    found = ranks.group_spread(df, ["g", "h"], "v")
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString()
    groups = {}
    for g, h, v in rows:
        groups.setdefault((g, h), []).append(v)
    got = {(r.g, r.h): r for r in found.collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        x, r = sorted([v for v in values if v is not None], key=lambda v: (v != v, v)), got[key]
        assert r.runs == len(x)
        if x:
            middle = (x[(len(x) - 1) // 2] + x[len(x) // 2]) / 2
            assert (r.median, r.min) == (middle, x[0]) or middle != middle and r.median != r.median
        else:
            assert (r.median, r.min, r.max) == (None, None, None)
