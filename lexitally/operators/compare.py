"""Full comparison of tables by key, and order-insensitive digests.

Both sides are stacked and grouped by key: one hash exchange instead of a full outer join. Keys
that occur many times on one side, as in a broken output, are folded before the exchange and
cannot multiply. With numeric values everything stays in hash aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import to_integer, tsv_fields

# Kinds of violation, in order of precedence.
MALFORMED, DUPLICATE, AMBIGUOUS, EXTRA, MISSING, WRONG = (
    "malformed", "duplicate", "ambiguous", "extra", "missing", "wrong")

# A digest adds up 240 bits of each row's hash, read as four numbers of 15 hex
# digits and summed in pieces of 20 bits.
_NUMBERS, _DIGITS, _PIECES, _BITS = 4, 15, 3, 20


def _by_key(actual: DataFrame, expected: DataFrame, key: Sequence[str], values: Sequence[str],
            malformed: str | None = None) -> DataFrame:
    """One row per key of either side, with both sides' values and `kind` (NULL when equal)."""
    bad = F.col(malformed) if malformed else F.lit(False)
    got = actual.select(*key, *values, F.lit(True).alias("got"), bad.alias("bad"))
    want = expected.select(*key, *values, F.lit(False).alias("got"), F.lit(False).alias("bad"))
    mine, theirs = F.col("got"), ~F.col("got")
    grouped = got.unionByName(want).groupBy(*key).agg(
        F.count_if(mine).alias("n_actual"),
        F.count_if(theirs).alias("n_expected"),
        F.count_if(F.col("bad")).alias("n_bad"),
        *[F.min(F.when(mine, F.col(v))).alias(f"actual_{v}") for v in values],
        *[F.min(F.when(theirs, F.col(v))).alias(f"expected_{v}") for v in values],
    )
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(f"actual_{v}").eqNullSafe(F.col(f"expected_{v}"))
    kind = (
        F.when(F.col("n_bad") > 0, MALFORMED)
        .when(F.col("n_actual") > 1, DUPLICATE)
        .when(F.col("n_expected") > 1, AMBIGUOUS)
        .when(F.col("n_expected") == 0, EXTRA)
        .when(F.col("n_actual") == 0, MISSING)
        .when(differs, WRONG)
    )
    return grouped.withColumn("kind", kind)


def violations(actual: DataFrame, expected: DataFrame, key: Sequence[str], values: Sequence[str],
               malformed: str | None = None) -> DataFrame:
    """kind, key, actual_*, expected_*: every key on which the two tables do not agree."""
    found = _by_key(actual, expected, key, values, malformed).where(F.col("kind").isNotNull())
    return found.select(
        "kind", *key, *[f"actual_{v}" for v in values], *[f"expected_{v}" for v in values])


def verify_counts(actual: DataFrame, expected: DataFrame, key: str = "word") -> DataFrame:
    return violations(actual, expected, [key], ["n"])


def verify_summary(actual: DataFrame, expected: DataFrame, key: Sequence[str] = ("word",),
                   values: Sequence[str] = ("n",), malformed: str | None = None) -> DataFrame:
    """One row: verified, n_actual and n_expected keys, n_violations, digest of the actual rows.

    Equality, sizes and digest come from the same pass. The digest is NULL unless verified.
    """
    keys = _by_key(actual, expected, key, values, malformed)
    present = F.col("n_actual") > 0
    row = _row_hash([F.col(k) for k in key] + [F.col(f"actual_{v}") for v in values])
    marked = keys.select(
        present.alias("present"), (F.col("n_expected") > 0).alias("due"),
        F.col("kind").isNotNull().alias("bad"), F.when(present, row).alias("h"))
    totals = _numbers(marked).agg(
        F.count_if("present").alias("n_actual"),
        F.count_if("due").alias("n_expected"),
        F.count_if("bad").alias("n_violations"),
        *_sums(),
    )
    ok = F.col("n_violations") == 0
    return totals.select(
        ok.alias("verified"), "n_actual", "n_expected", "n_violations",
        F.when(ok, _digest("n_actual")).alias("digest"),
    )


def assert_equal(actual: DataFrame, expected: DataFrame, key: Sequence[str] = ("word",),
                 values: Sequence[str] = ("n",), malformed: str | None = None) -> str:
    """Digest of `actual`; raises ValueError when the tables differ. Runs a job."""
    found = verify_summary(actual, expected, key, values, malformed).first()
    if not found.verified:
        raise ValueError(f"mismatch on {found.n_violations} keys; {found.n_actual} were counted where "
                         f"{found.n_expected} are due")
    return found.digest


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """key, n for keys that occur more than once"""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def canonical_digest(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, n_rows and digest: equal for equal multisets of rows, whatever order or split.

    Every row is hashed with SHA-256, and the hashes are added up piece by piece. Sums merge in
    any order, so each task sends one row and nothing is sorted or collected; a piece's sum stays
    within BIGINT for 2^43 rows and fails beyond. This guards against errors, not against an
    attacker who can choose rows; `violations` is the exact comparison.
    """
    hashed = df.select(_row_hash([F.col(c) for c in columns]).alias("h"))
    sums = _numbers(hashed).agg(F.count(F.lit(1)).alias("n_rows"), *_sums())
    return sums.select("n_rows", _digest("n_rows").alias("digest"))


def digest_tree(df: DataFrame, key: Sequence[str], columns: Sequence[str], digits: int = 4) -> DataFrame:
    """prefix, depth, n_rows, digest: which digest the rows have below each prefix of their key's hash.

    The hash of a row's `key` is its place in a tree of 16 branches a level and `digits` levels below
    the root, whose prefix is empty; a node without rows is not there. A node's digest is that of
    `canonical_digest` over its rows, so the root's is the whole table's. Rows are folded to at most
    16^digits leaves by a partial aggregate, and only those are folded again for the nodes above.
    """
    if not 1 <= digits <= 8:
        raise ValueError("digits must be from 1 to 8")
    hashed = df.select(_branch(key, digits).alias("leaf"), _row_hash([F.col(c) for c in columns]).alias("h"))
    leaves = _numbers(hashed).groupBy("leaf").agg(F.count(F.lit(1)).alias("n_rows"), *_sums())
    names = ["n_rows", *[f"s{k}" for k in range(_NUMBERS * _PIECES)]]
    depths = F.explode(F.sequence(F.lit(0), F.lit(digits)))
    nodes = leaves.select("leaf", *names, depths.alias("depth")).groupBy(
        F.substring(F.col("leaf"), F.lit(1), F.col("depth")).alias("prefix"), "depth").agg(*[F.sum(n).alias(n) for n in names])
    return nodes.select("prefix", "depth", "n_rows", _digest("n_rows").alias("digest"))


def _branch(key: Sequence[str], digits: int) -> Column:
    return F.substring(_row_hash([F.col(k) for k in key]), 1, digits)


def digest_tree_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """prefix, depth, left_rows, right_rows of the nodes in which two trees differ, a node that one of
    them does not have counted as 0 rows. No row: equal tables. Trees may have been written earlier,
    and far apart; the tables are not needed."""
    sides = left.withColumn("l", F.lit(True)).unionByName(right.withColumn("l", F.lit(False)))
    mine = F.col("l")
    met = sides.groupBy("prefix", "depth").agg(
        F.coalesce(F.max(F.when(mine, F.col("n_rows"))), F.lit(0)).alias("left_rows"),
        F.coalesce(F.max(F.when(~mine, F.col("n_rows"))), F.lit(0)).alias("right_rows"),
        F.max(F.when(mine, F.col("digest"))).alias("a"), F.max(F.when(~mine, F.col("digest"))).alias("b"))
    return met.where(~F.col("a").eqNullSafe(F.col("b"))).drop("a", "b")


def branch_violations(actual: DataFrame, expected: DataFrame, key: Sequence[str], values: Sequence[str],
                      digits: int = 4) -> DataFrame:
    """`violations`, of which only the rows of differing leaves are compared one by one: for tables
    that are nearly equal, where the comparison itself would move all rows."""
    columns = [*key, *values]
    differ = digest_tree_diff(digest_tree(actual, key, columns, digits), digest_tree(expected, key, columns, digits))
    leaves = differ.where(F.col("depth") == digits).select(F.col("prefix").alias("_leaf"))
    opened = [df.withColumn("_leaf", _branch(key, digits)).join(leaves, "_leaf", "left_semi").drop("_leaf")
              for df in (actual, expected)]
    return violations(*opened, key, values)


def _row_hash(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each led by its byte length so that no two rows read alike."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in texts]
    return F.sha2(F.concat_ws(",", *parts), 256)


def _numbers(hashed: DataFrame) -> DataFrame:
    """The hash `h` as numbers. Each is a column of its own, so that hash and conversion run
    once per row and not once per sum."""
    parts = [F.conv(F.substring("h", _DIGITS * i + 1, _DIGITS), 16, 10).cast("bigint").alias(f"x{i}")
             for i in range(_NUMBERS)]
    return hashed.select(*[c for c in hashed.columns if c != "h"], *parts)


def _sums() -> list[Column]:
    pieces = [F.shiftright(f"x{i}", _BITS * j).bitwiseAND((1 << _BITS) - 1)
              for i in range(_NUMBERS) for j in range(_PIECES)]
    return [F.coalesce(F.sum(p), F.lit(0)).alias(f"s{k}") for k, p in enumerate(pieces)]


def _digest(count: str) -> Column:
    return F.sha2(F.concat_ws(",", count, *[f"s{k}" for k in range(_NUMBERS * _PIECES)]), 256)


def parse_counts(df: DataFrame, line: str = "value", key: str = "key") -> DataFrame:
    """key, n, problem from `key<TAB>n` lines; `problem` is NULL, 'arity' or 'integer'."""
    fields = tsv_fields(line)
    two = F.size(fields) == 2
    n = F.when(two, to_integer(fields[1]))
    problem = F.when(~two, "arity").when(n.isNull(), "integer")
    return df.select(fields[0].alias(key), n.alias("n"), problem.alias("problem"))


def parse_extremes(df: DataFrame, line: str = "value", key: str = "word") -> DataFrame:
    """which, key, n, problem from `which<TAB>key<TAB>n` lines"""
    fields = tsv_fields(line)
    three = F.size(fields) == 3
    n = F.when(three, to_integer(F.try_element_at(fields, F.lit(3))))
    problem = F.when(~three, "arity").when(n.isNull(), "integer")
    word = F.when(three, F.try_element_at(fields, F.lit(2)))
    return df.select(fields[0].alias("which"), word.alias(key), n.alias("n"), problem.alias("problem"))


def listing_diff(listed: DataFrame, declared: DataFrame, name: str = "name") -> DataFrame:
    """kind, name: 'unlisted' for declared names not found, 'undeclared' for the reverse."""
    sides = listed.select(name, F.lit(1).alias("l"), F.lit(0).alias("d")).unionByName(
        declared.select(name, F.lit(0).alias("l"), F.lit(1).alias("d")))
    seen = sides.groupBy(name).agg(F.max("l").alias("l"), F.max("d").alias("d"))
    kind = F.when(F.col("l") == 0, "unlisted").when(F.col("d") == 0, "undeclared")
    return seen.select(kind.alias("kind"), name).where(F.col("kind").isNotNull())


def missing_files(required: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Names that are required but not present, once each."""
    return listing_diff(present, required, name).where(F.col("kind") == "unlisted").select(name)


def content_diff(files: DataFrame, declared: DataFrame) -> DataFrame:
    """Files on both sides whose byte length or hash differs."""
    found = violations(files, declared, ["name"], ["bytes", "sha256"])
    return found.where(F.col("kind") == WRONG).drop("kind")
