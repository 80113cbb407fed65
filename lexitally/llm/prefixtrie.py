"""Trie of the turns that conversations begin with.

A conversation is a path of symbols, one for each turn, and the distinct paths are sorted over all
tasks. Each task cuts its range of them into shards; a shard's turns are encoded by its own
dictionary, in order, and its paths put into a ternary search tree, the median first, which keeps it
balanced. An iterative traversal of the tree accumulates members, leaves and savings.

Nodes on the first and the last path of a shard may go on in its neighbours. They are merged by an
identifier that follows from the path: members and children add up, what hangs below them is handed
up along the shards' border paths, each such node counted on one of the paths that it lies on.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequential import sha256_of_pieces
from . import shared
from .shared import settle

SHARD = 1 << 19   # turns of a shard, one path at least
SYMBOL = 24       # bytes of a symbol: 16 of the turn's hash, 8 of its text's length
BLOCK_BITS = 12   # conversations that are listed together are alike but for so many bits

_NOBODY = hashlib.sha256(b"").hexdigest()
_ROOT = bytes(16)

_FIELDS = ("shard string, id binary, parent binary, path string, depth bigint, conv_id bigint, parent_conv_id bigint, "
           "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, chars bigint, ends_sha256 string")
_KINDS = [pa.string(), pa.binary(), pa.binary(), pa.string(), *[pa.int64()] * 8, pa.string()]
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


# --- paths ------------------------------------------------------------------------------------

def paths(turns: DataFrame) -> DataFrame:
    """conv_id, path of `turns` (conv_id, turn, role, text).

    Turns are ordered by `turn`, null first, those of one number by their symbols. A null role or
    text is an empty one. Rows without a conv_id belong to no conversation and are left out.
    Symbols are equal for equal turns, and for no others unless 128 bits of SHA-256 collide.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    symbol = F.unhex(F.concat(F.substring(F.sha2(told, 256), 1, 32), F.lpad(F.hex(F.char_length(text)), 16, "0")))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", symbol.alias("symbol"))
    return rows.groupBy("conv_id").agg(
        F.expr("listagg(symbol) WITHIN GROUP (ORDER BY turn NULLS FIRST, symbol)").alias("path"))


def with_heads(own: DataFrame, head: Column, taken: Column) -> DataFrame:
    """conv_id, path: of each path of `own` the first `taken` turns give way to as many of the
    conversation `head`, or to those it has."""
    cut = own.select("conv_id", "path", head.alias("head"), (taken * SYMBOL).cast("int").alias("cut"))
    # A head is the head of few, so no key of this join is hot.
    heads = own.select(F.col("conv_id").alias("head"), F.col("path").alias("lead"))
    lead = F.coalesce(F.expr("substring(lead, 1, cut)"), F.lit(b""))
    return cut.join(heads, "head", "left").select(
        "conv_id", F.concat(lead, F.expr("substring(path, cut + 1)")).alias("path"))


def distinct_paths(found: DataFrame) -> DataFrame:
    """path, n, conv_id (the least), ends_sha256 (of all) of each distinct path."""
    keyed = settle(found.select("conv_id", "path", F.sha2("path", 256).alias("key")), "paths")
    # An array holds the conversations of one block, and so no more than 2^BLOCK_BITS.
    block = F.shiftright("conv_id", BLOCK_BITS)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = keyed.groupBy("key", block.alias("block")).agg(listed.alias("ids"))
    ends = sha256_of_pieces(blocks, "key", "block", "ids", b",").select("key", F.col("sha256").alias("ends_sha256"))
    folded = keyed.groupBy("key").agg(
        F.any_value("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    return folded.join(ends, "key").select("path", "n", "conv_id", "ends_sha256")


# --- a shard ----------------------------------------------------------------------------------

def by_medians(n: int) -> Iterator[int]:
    """0 to n - 1, the median of each range before the halves beside it."""
    ranges = [(0, n)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(low, middle), (middle + 1, high)]


def encoded(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the symbols, in their order, and the text's length of each code."""
    parts = np.frombuffer(raw, ">u8").reshape(-1, 3).astype(np.uint64)
    order = np.lexsort(parts.T[::-1])
    new = np.ones(len(order), bool)
    new[1:] = (parts[order[1:]] != parts[order[:-1]]).any(1)
    codes = np.empty(len(order), np.int64)
    codes[order] = np.cumsum(new) - 1
    return codes, parts[order[new], 2].astype(np.int64)


class SearchTree:
    """Ternary search tree. Node 0 is the root of the trie, which no link leads to, so 0 is no link."""

    def __init__(self):
        self.code, self.low, self.equal, self.high, self.up = (array("q", [0]) for _ in range(5))

    def add(self, codes: list[int]) -> int:
        """The node of the path."""
        code, low, equal, high, up = self.code, self.low, self.equal, self.high, self.up
        at = 0
        for place, c in enumerate(codes):
            links, node = equal, at
            while links[node]:
                node = links[node]
                if code[node] == c:
                    break
                links = low if c < code[node] else high
            else:
                # Nothing lies below a new node: the rest of the path is a chain.
                new, more = len(code), len(codes) - place
                links[node] = new
                code.extend(codes[place:])
                up.append(at)
                up.extend(range(new, new + more - 1))
                equal.extend(range(new + 1, new + more))
                equal.append(0)
                low.extend([0] * more)
                high.extend([0] * more)
                return new + more - 1
            at = node
        return at

    def order(self) -> Iterator[int]:
        """All nodes but the root, each before those below it."""
        low, equal, high = self.low, self.equal, self.high
        waiting = [equal[0]] if equal[0] else []
        while waiting:
            node = waiting.pop()
            yield node
            waiting += [n for n in (low[node], high[node], equal[node]) if n]


def _shard(name: str, rows: list[tuple]) -> pa.RecordBatch:
    """What the nodes of a shard are known to be. Those that may go on elsewhere have an id, and
    count what hangs below them besides others of their kind."""
    size = np.array([len(r[0]) // SYMBOL for r in rows])
    ends = np.cumsum(size)
    raw = b"".join([r[0] for r in rows])
    codes, lengths = encoded(raw)
    codes = codes.tolist()
    tree = SearchTree()
    terminal = [0] * len(rows)
    for i in by_medians(len(rows)):
        terminal[i] = tree.add(codes[ends[i] - size[i]:ends[i]])
    n = len(tree.code)
    up = tree.up
    chars = [0, *lengths[np.frombuffer(tree.code, np.int64)[1:]].tolist()]

    depth, order = [0] * n, list(tree.order())
    for node in order:
        depth[node] = depth[up[node]] + 1
    ids: dict[int, bytes] = {0: _ROOT}
    borders = []
    for i in {0, len(rows) - 1}:
        chain = [terminal[i]]
        while chain[-1]:
            chain.append(up[chain[-1]])
        chain.reverse()
        borders.append(chain)
        first = ends[i] - size[i]
        for d, node in enumerate(chain[1:]):
            turn = raw[(first + d) * SYMBOL:(first + d + 1) * SYMBOL]
            ids[node] = hashlib.blake2b(ids[chain[d]] + turn, digest_size=16).digest()

    members, children, leaves, saved = ([0] * n for _ in range(4))
    least: list[int | None] = [None] * n
    told: list[str | None] = [None] * n
    for (_, count, conv, digest), node in zip(rows, terminal, strict=True):
        members[node], least[node], told[node] = count, conv, digest
    for node in reversed(order):
        above = up[node]
        members[above] += members[node]
        if least[above] is None or least[node] < least[above]:
            least[above] = least[node]
        if node in ids:
            continue
        children[above] += 1
        leaves[node] = leaves[node] or 1
        saved[node] += (members[node] - 1) * chars[node]
        leaves[above] += leaves[node]
        saved[above] += saved[node]

    inner = [node for node in order if node not in ids]
    above = [up[node] for node in inner]
    columns = [[name] * len(inner), [None] * len(inner), [ids.get(a) for a in above], [None] * len(inner),
               [depth[i] for i in inner], [least[i] for i in inner],
               [None if a in ids else least[a] for a in above], *[[kind[i] for i in inner] for kind in (
                   members, children, leaves, saved, chars)], [told[i] for i in inner]]
    counted: set[int] = set()
    for number, chain in enumerate(borders):
        for node in chain:
            # A node of both paths brings what it has to the first of them.
            new = node not in counted
            counted.add(node)
            values = (name, ids[node], ids[up[node]] if node else None, f"{name}/{number}", depth[node], least[node], None,
                      *[kind[node] * new for kind in (members, children, leaves, saved)], chars[node], told[node])
            for column, value in zip(columns, values, strict=True):
                column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def _shards(batches: Iterable[pa.RecordBatch], turns: int) -> Iterator[pa.RecordBatch]:
    part, number, rows, size = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for path, n, conv, digest in zip(*(batch.column(i) for i in range(4)), strict=True):
            rows.append((path.as_py(), n.as_py(), conv.as_py(), digest.as_py()))
            size += len(rows[-1][0])
            if size >= turns * SYMBOL:
                yield _shard(f"{part}-{number}", rows)
                number, rows, size = number + 1, [], 0
    if rows:
        yield _shard(f"{part}-{number}", rows)


# --- the trie ---------------------------------------------------------------------------------

def _merged(border: DataFrame) -> DataFrame:
    """The border nodes, whole: id, parent, depth, conv_id, n_convs, n_children, n_leaves, saved, ends_sha256."""
    met = settle(border.groupBy("id").agg(
        F.any_value("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("hung_leaves"),
        F.sum("saved").alias("hung_saved"), F.max("chars").alias("chars"), F.max("ends_sha256").alias("ends_sha256"),
        F.min("path").alias("owner")), "border")
    children = met.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("outer"))
    known = settle(met.join(children, "id", "left").withColumn(
        "n_children", F.col("inner") + F.coalesce("outer", F.lit(0))).drop("inner", "outer"), "border")
    # Each node's own part counts once, on the path that owns it, for all nodes above it there.
    own = known.select(
        "id", "owner", (F.col("hung_leaves") + (F.col("n_children") == 0).cast("bigint")).alias("own_leaves"),
        (F.col("hung_saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"))
    below = Window.partitionBy("path").orderBy(F.desc("depth"))
    here = F.col("path") == F.col("owner")
    handed = border.select("id", "path", "depth").join(own, "id").select(
        "id", F.sum(F.when(here, F.col("own_leaves")).otherwise(0)).over(below).alias("n_leaves"),
        F.sum(F.when(here, F.col("own_saved")).otherwise(0)).over(below).alias("saved"))
    sums = handed.groupBy("id").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    return known.select("id", "parent", "depth", "conv_id", "n_convs", "n_children", "ends_sha256").join(sums, "id")


def trie(found: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of all paths of `found` (conv_id, path), one row each: conv_id (the least
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct beginning of paths, the root is the empty one; an empty path is a member of
    the root alone. Equal paths are one path of more members. No conversations: no nodes, not even
    a root. A task holds one shard, and so `shard` turns or the longest path.
    """
    rows = distinct_paths(found)
    ordered = rows.repartitionByRange("path").sortWithinPartitions("path")
    parts = settle(shared.arrow(ordered, partial(_shards, turns=shard), _FIELDS), "shards")
    border = parts.where("path IS NOT NULL")
    merged = settle(_merged(border), "border")
    named = merged.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    edge = merged.join(named, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    inner = parts.where("path IS NULL")
    # By shard, since a node of the border may have any number of children.
    local = border.select("shard", F.col("id").alias("parent")).distinct().join(named, "parent")
    hung = inner.where("parent IS NOT NULL").join(local, ["shard", "parent"]).withColumn("parent_conv_id", F.col("above"))
    kept = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    nodes = inner.where("parent IS NULL").select(kept).unionByName(hung.select(kept)).unionByName(edge.select(kept))
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NOBODY))).withColumnRenamed("saved", "saved_tokens")
