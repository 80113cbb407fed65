import brute
import corpus_pipeline
import pytest

from lexitally.llm import packing

SHAPE = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="module")
def docs(sf):
    return brute.rows(sf, "SELECT doc_id, text FROM documents ORDER BY doc_id")


def cleaned(docs):
    gone = brute.repeated_lines(docs)
    out = []
    for d, t in docs:
        if d in gone:
            t = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(gone[d]))
            if not t.strip():
                continue
        out.append((d, t))
    kept = brute.components(out)
    return {d: t for d, t in out if kept[d][2]}


def test_run_like_brute_force(spark, sf, docs):
    """All documents of the tables have letters, so the first stage keeps them."""
    rows = corpus_pipeline.run(spark, sf).collect()
    want = cleaned(docs)
    sizes = {}
    for r in rows:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.size
    assert sizes == {d: len(t.split()) + 1 for d, t in want.items()}
    assert all(r.size <= packing.CAPACITY for r in rows)


def test_stages_on_odd_rows(spark, sf):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(1, "the cat sat on the mat", "en", "a", 22), (2, None, "en", "a", None), (3, "", None, None, 0), (4, "123 456", "en", "b", 7),
            (None, same, "en", "b", 1), (5, same, "en", "c", 1), (5, same, "en", "c", 1), (6, f"{same}\nthe end", "en", "c", 1)]
    docs = spark.createDataFrame(rows, SHAPE).selectExpr("*", "'x' AS removed", "1 AS _lang", "2 AS score", "3 AS _key")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language"](spark, docs, sf)
    assert first.columns == docs.columns
    assert {(r.removed, r._lang, r.score, r._key) for r in first.collect()} == {("x", 1, 2, 3)}
    assert sorted(str(r.doc_id) for r in first.collect()) == ["1", "5", "5", "6", "None"]
    second = stages["lines"](spark, docs, sf)
    assert second.columns == docs.columns
    assert sorted((str(r.doc_id), r.text, r.n_chars) for r in second.collect() if r.doc_id in (None, 5, 6)) == [
        ("6", "the end", 7), ("None", same, len(same))]
    third = stages["near_duplicates"](spark, docs, sf)
    assert third.columns == docs.columns
    assert sorted(str(r.doc_id) for r in third.collect()) == ["1", "2", "3", "4", "None"]
    assert stages["packed"](spark, docs, sf).count() == len(rows)
    for stage in stages.values():
        assert stage(spark, docs.where("false"), sf).collect() == []


def test_ties_of_near_duplicates(spark, sf):
    same = " ".join(f"w{i}" for i in range(30))
    rows = [(7, same, "en", s, n) for s, n in (("c", 1), ("a", 2), ("a", 1), (None, 5))]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    found = {tuple(stage(spark, spark.createDataFrame(order, SHAPE).repartition(3), sf).first()) for order in (rows, rows[::-1])}
    assert found == {(7, same, "en", None, 5)}  # whose JSON goes on with n_chars
