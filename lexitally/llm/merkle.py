"""Merkle manifest of a dataset: a hash tree for each group of rows and one over the groups.

A tree of `n` leaves has levels of n, ceil(n / 3), ... nodes; every three consecutive nodes of a level
become one of the next, until one remains. Leaves lie in the order of their positions, and a node
lies in the row of its first leaf: one level's nodes are a fixed number of rows apart, so lag and
lead with a fixed offset, masked by the node's slot in its run and the run's length, supply its
siblings, and the row of a run's first child hashes the parent.

Rows are dealt by spans of 3^LEVELS positions, each of which is a whole subtree, so a group of any
size is worked on by many tasks, and a window never holds more than a span. The roots of the spans
are the leaves of the next, far smaller round. On the way back each row gets the siblings above its
span, and recomputes those below it by the same windows: no row with siblings is ever written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settle

ARITY = 3
LEVELS = 7  # of a span
SPAN = ARITY ** LEVELS

_OFFSET_BITS = 33  # fixed value: monotonically_increasing_id keeps the row offset in 33 bits

# The siblings of a node, those before it and those behind it, their digests joined.
_STEP = "struct<before: string, behind: string>"


def field(value: Column | str) -> Column:
    """A value as it enters a hash: its length in bytes, a colon and itself; `-` for null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column | str]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def group_key(group: Column | str) -> Column:
    """Text that is never null and sorts as the group does, null first."""
    text = (F.col(group) if isinstance(group, str) else group).cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))


def placed(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` (tree, ...) with `pos`, the position in its tree, and `n`, the tree's size.

    Rows are range-partitioned by tree and order and written sorted; where a tree begins in each
    written block follows from one row for each of them. A tree may fill any number of blocks.
    """
    at = F.monotonically_increasing_id()
    ordered = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    cut = settle(ordered.select("*", F.shiftright(at, _OFFSET_BITS).alias("block"),
                                at.bitwiseAND((1 << _OFFSET_BITS) - 1).alias("at")), "ordered")
    parts = cut.groupBy("tree", "block").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "tree", "block", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("rows").over(whole).alias("n"))
    return cut.join(settle(starts, "starts"), ["tree", "block"]).select(
        *leaves.columns, (F.col("base") + F.col("at")).alias("pos"), "n")


def _div(a: Column | str, b: int) -> Column:
    return F.call_function("div", F.col(a) if isinstance(a, str) else a, F.lit(b).cast("bigint"))


def _size(level: int) -> Column:
    """Nodes that the tree has at a level."""
    return _div(F.col("n") + (ARITY ** level - 1), ARITY ** level)


def _climbed(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, pos, n, h0, ...) with `span`, h1, h2, ... in the rows of first leaves, and the
    siblings s0, s1, ... of those nodes, null where a level is the root's."""
    inside = Window.partitionBy("tree", "span").orderBy("pos")
    out = nodes.withColumn("span", _div("pos", SPAN))
    for level in range(LEVELS):
        width = ARITY ** level
        h = f"h{level}"
        near = {f"{side}{k}": shift(h, k * width).over(inside)
                for side, shift in (("before", F.lag), ("behind", F.lead)) for k in range(1, ARITY)}
        out = out.select("*", *[c.alias(name) for name, c in near.items()])
        node = _div("pos", width)
        slot, size = node % ARITY, _size(level)
        run = F.least(F.lit(ARITY), size - (node - slot))
        first, merged = F.col("pos") % width == 0, size > 1
        before = F.concat(*[F.when(slot >= k, F.col(f"before{k}")).otherwise("") for k in reversed(range(1, ARITY))])
        behind = F.concat(*[F.when(slot + k < run, F.col(f"behind{k}")).otherwise("") for k in range(1, ARITY)])
        siblings = F.struct(before.alias("before"), behind.alias("behind"))
        out = out.select(
            *[c for c in out.columns if c not in near], F.when(first & merged, siblings).alias(f"s{level}"))
        parent = F.when(merged, F.sha2(F.concat(F.col(h), f"s{level}.behind"), 256)).otherwise(F.col(h))
        out = out.withColumn(f"h{level + 1}", F.when(F.col("pos") % (width * ARITY) == 0, parent))
    return out


def rounds_of(leaves: DataFrame) -> list[DataFrame]:
    """`leaves` (tree, pos, n, h0, ...), the roots of their spans, the roots of those, and so on until
    every tree has one. The driver learns one number, the size of the largest tree."""
    rounds = [leaves]
    largest = leaves.agg(F.max("n").alias("n")).first().n or 0
    while largest > 1:
        roots = _climbed(rounds[-1]).where(F.col("pos") % SPAN == 0).select(
            "tree", F.col("span").alias("pos"), _size(LEVELS).alias("n"), F.col(f"h{LEVELS}").alias("h0"))
        rounds.append(settle(roots, "roots"))
        largest = -(-largest // SPAN)
    return rounds


def ways_up(rounds: Sequence[DataFrame], crown: DataFrame) -> DataFrame:
    """The leaves of `rounds` with the columns of `crown` (tree, path, ...), which has the way up from
    each tree's root; their own ways are put before it."""
    kept = [c for c in crown.columns if c not in ("tree", "path")]
    up_to = Window.partitionBy("tree", "span").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The last node of a level to begin at or before a row is the one above it.
    own = [F.last(f"s{level}", ignorenulls=True).over(up_to) for level in range(LEVELS)]
    path = F.concat(F.filter(F.array(*own), lambda s: s.isNotNull()), F.col("upper"))
    above = rounds[-1].join(crown, "tree")  # one row for each tree on either side
    for nodes in reversed(rounds[:-1]):
        spans = settle(above.select("tree", F.col("pos").alias("span"), F.col("path").alias("upper"), *kept), "ways")
        # A span has at most SPAN rows, so no key of this join is hot.
        joined = nodes.withColumn("span", _div("pos", SPAN)).join(spans, ["tree", "span"])
        above = _climbed(joined).select(*nodes.columns, *kept, path.alias("path"))
    return above


def folded(start: Column | str, path: Column | str) -> Column:
    """The root that a leaf and the siblings on its way up make."""
    start, path = (F.col(c) if isinstance(c, str) else c for c in (start, path))
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["behind"]), 256))


def manifest(rows: DataFrame, key: str, group: str, values: Sequence[Column | str],
             tampered: Sequence[Column | str]) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified, for each row of `rows`.

    A row's leaf is the hash of `values`. Leaves of one `group` ascend by `key` (null first; rows of
    one key by their leaves, so equal rows take any order without a difference) and make a tree; its
    root is a leaf of the tree over all groups, null first and then in the order of their bytes. The
    proof of a row are its siblings on the way to the root. `folded_root` comes from `tampered`,
    values that take the place of `values`, and that proof.

    Every row has its result, repeated ones too; no rows, no result. Texts are hashed in the scan and
    go no further, whatever their length; columns that are not named are not read.
    """
    hashed = settle(rows.select(
        F.col(key).alias("key"), group_key(group).alias("tree"), leaf(values).alias("h0"),
        leaf(tampered).alias("other")), "leaves")
    leaves = settle(placed(hashed, ["key", "h0"]), "placed")

    rounds = rounds_of(leaves)
    groups = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h0")
    top = rounds_of(settle(placed(groups, ["of"]), "groups"))
    roots = top[-1].select("tree", F.col("h0").alias("root"), F.array().cast(f"array<{_STEP}>").alias("path"))
    crown = ways_up(top, roots).select(F.col("of").alias("tree"), F.col("h0").alias("subroot"), "root", "path")
    found = ways_up(rounds, settle(crown, "crown"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["behind"])), "")
    result = found.select(
        F.col("key").alias(key), F.col("h0").alias("leaf"), "subroot", "root",
        F.sha2(siblings, 256).alias("proof_sha256"), folded("other", "path").alias("folded_root"))
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
