"""Verification of outputs: violations, summaries, digests, listings."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lexitally.operators import compare


def table(spark, pairs):
    return spark.createDataFrame(pairs, "word STRING, n BIGINT")


def lines(spark, content):
    return spark.createDataFrame([(v,) for v in content.splitlines()], "value STRING")


EXPECTED = [("a", 2), ("b", 1)]


@pytest.mark.parametrize("content, kinds", [
    ("a\t2\n", {"b": "missing"}),
    ("a\t3\nb\t1\n", {"a": "wrong"}),
    ("a\t2\na\t2\nb\t1\n", {"a": "duplicate"}),
    ("a\t2\nb\t1\nc\t9\n", {"c": "extra"}),
    ("a\t2\nb\n", {"b": "malformed"}),
    ("a\t2\nb\t1\tx\n", {"b": "malformed"}),
    ("a\t2\nb\tz\n", {"b": "malformed"}),
    ("", {"a": "missing", "b": "missing"}),
    ("b\t1\na\t2\n", {}),
])
def test_every_kind_of_violation(spark, content, kinds):
    actual = compare.parse_counts(lines(spark, content), key="word")
    actual = actual.withColumn("bad", actual["problem"].isNotNull())
    expected = table(spark, EXPECTED)
    found = compare.violations(actual, expected, ["word"], ["n"], "bad").collect()
    assert {r.word: r.kind for r in found} == kinds
    summary = compare.verify_summary(actual, expected, malformed="bad").first()
    assert summary.verified == (not kinds) and summary.n_violations == len(kinds)
    assert (summary.digest is None) == bool(kinds) and summary.n_expected == 2
    if kinds:
        with pytest.raises(ValueError, match="mismatch"):
            compare.assert_equal(actual, expected, malformed="bad")
    else:
        assert compare.assert_equal(actual, expected, malformed="bad") == summary.digest


def test_expected_must_be_unambiguous_and_null_is_a_value(spark):
    found = compare.verify_counts(table(spark, [("a", 2)]), table(spark, [("a", 2), ("a", 2)])).first()
    assert found.kind == "ambiguous"
    assert compare.verify_counts(table(spark, [("a", None)]), table(spark, [("a", None)])).isEmpty()
    assert compare.verify_counts(table(spark, [("a", None)]), table(spark, [("a", 1)])).first().kind == "wrong"


def test_hot_duplicate_key(spark):
    # A broken output that repeats one key very often must not multiply.
    actual = spark.range(200_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) word", "1L n")
    expected = spark.range(200_000).where("id % 3 <> 0").selectExpr("concat('k', id) word", "1L n")
    found = compare.verify_counts(actual, expected).collect()
    assert [(r.word, r.kind) for r in found] == [("hot", "duplicate")]


def test_extremes_are_verified_on_both_values(spark):
    schema = "which STRING, word STRING, n BIGINT"
    want = spark.createDataFrame([("MIN", "b", 1), ("MAX", "a", 2)], schema)
    parsed = compare.parse_extremes(lines(spark, "MAX\ta\t2\nMIN\tb\t1\n"))
    assert parsed.where("problem is not null").isEmpty()
    assert compare.assert_equal(parsed, want, ["which"], ["word", "n"])
    other = compare.parse_extremes(lines(spark, "MAX\tc\t2\nMIN\tb\t1\n"))
    found = compare.violations(other, want, ["which"], ["word", "n"]).collect()
    assert [(r.which, r.kind, r.actual_word, r.expected_word) for r in found] == [("MAX", "wrong", "c", "a")]
    bad = compare.parse_extremes(lines(spark, "MAX\ta\nMIN\tb\tx\n")).collect()
    assert [r.problem for r in bad] == ["arity", "integer"]


def test_digest(spark):
    rows = [("a", 2), ("b", 1), ("a", 2), ("c", None)]
    digest = lambda r, p=1: compare.canonical_digest(
        table(spark, r).repartition(p), ["word", "n"]).first()
    base = digest(rows)
    assert base.n_rows == 4 and len(base.digest) == 64
    assert digest(rows[::-1], 3) == base
    others = [rows[:3], rows[:2] + rows[3:], [("a", 1), ("b", 2), *rows[2:]], rows + [("a", 2)],
              [("a", 2), ("b", 1), ("a", 2), ("c", 0)], [("a,", 2), *rows[1:]], []]
    found = [digest(o).digest for o in others] + [base.digest]
    assert len(set(found)) == len(found)


def test_digest_fields_do_not_run_together(spark):
    def digest(*row):
        df = spark.createDataFrame([row], "a STRING, b STRING")
        return compare.canonical_digest(df, ["a", "b"]).first().digest

    assert len({digest("x", "y"), digest("xy", ""), digest("", "xy"), digest("x,1:y", ""),
                digest(None, "-"), digest("-", None), digest(None, None)}) == 7


def test_duplicates(spark):
    found = compare.duplicate_keys(table(spark, [("a", 1), ("a", 2), ("b", 1)]), "word").collect()
    assert [(r.word, r.n) for r in found] == [("a", 2)]


def test_listings(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name STRING")
    found = compare.listing_diff(names("a", "b", "b"), names("b", "c")).collect()
    assert {(r.kind, r.name) for r in found} == {("undeclared", "a"), ("unlisted", "c")}
    assert compare.listing_diff(names("a"), names("a")).isEmpty()
    missing = compare.missing_files(names("a", "c", "c"), names("a", "b")).collect()
    assert [r.name for r in missing] == ["c"]


def test_contents(spark):
    schema = "name STRING, bytes BIGINT, sha256 STRING"
    files = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z"), ("d", 4, "w")], schema)
    told = spark.createDataFrame([("a", 1, "x"), ("b", 9, "y"), ("c", 3, "q"), ("e", 4, "w")], schema)
    assert {r.name for r in compare.content_diff(files, told).collect()} == {"b", "c"}


def test_tree_of_digests(spark):
    rows = [(f"w{i}", i) for i in range(500)]
    left = table(spark, rows)
    changed = [("w3", 4) if w == "w3" else (w, n) for w, n in rows if w != "w7"] + [("new", 1)]
    right = table(spark, changed)
    tree, other = (compare.digest_tree(df, ["word"], ["word", "n"], 3) for df in (left, right))
    root = tree.where("depth = 0").first()
    assert (root.prefix, root.n_rows, root.digest) == ("", 500, compare.canonical_digest(left, ["word", "n"]).first().digest)
    assert tree.groupBy("depth").agg(F.sum("n_rows").alias("n")).where("n <> 500").isEmpty()
    hashes = [hashlib.sha256(f"{len(w)}:{w}".encode()).hexdigest()[:3] for w in ("w3", "w7", "new")]
    want = {h[:d] for h in hashes for d in range(4)}
    assert {r.prefix for r in compare.digest_tree_diff(tree, other).collect()} == want
    assert compare.digest_tree_diff(tree, compare.digest_tree(left.repartition(3), ["word"], ["word", "n"], 3)).isEmpty()
    found = sorted(map(tuple, compare.branch_violations(left, right, ["word"], ["n"], 3).collect()), key=str)
    assert found == sorted(map(tuple, compare.verify_counts(left, right).collect()), key=str) and len(found) == 3
    none = left.where("false")
    assert compare.digest_tree(none, ["word"], ["n"]).isEmpty()
    assert compare.digest_tree_diff(compare.digest_tree(none, ["word"], ["word", "n"], 3), tree).count() == tree.count()
    with pytest.raises(ValueError):
        compare.digest_tree(left, ["word"], ["n"], 0)
