"""Prefix trie against plain Python, with shards of one path up to all of them."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lexitally.llm import prefixtrie

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def symbol(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(turns):
    own = {}
    for c, n, r, t in turns:
        if c is not None:
            own.setdefault(c, []).append((n is not None, n or 0, symbol(r or "", t or ""), (r or "", t or "")))
    own = {c: [x[-1] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:])
    members = {}
    for c, p in built.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    children = {k: [j for j in members if len(j) == len(k) + 1 and j[:-1] == k] for k in members}
    out = []
    for k, m in members.items():
        below = [j for j in members if j[:len(k)] == k]
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children[k]),
                    sum(not children[j] for j in below), sum((len(members[j]) - 1) * len(j[-1][1]) for j in below if j),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(spark, turns, shard=1 << 19):
    conv = F.col("conv_id")
    own = prefixtrie.paths(spark.createDataFrame(turns, SCHEMA))
    found = prefixtrie.with_heads(own, conv - conv % 100, F.crc32(conv.cast("string")) % 6)
    return sorted(map(tuple, prefixtrie.trie(found, shard).collect()), key=str)


def odd_turns():
    rng = random.Random(5)
    out = [(c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["", "a", "bé", "c👍c", None]))
           for c in [*range(40), 100, 101, 102, 250, 251, -3, -103, -100] for t in range(rng.randrange(7))]
    # Rows without a conversation, repeated ones, copies of one conversation, and a long one.
    out += [(None, 1, "user", "x"), out[0], out[0], *[(300, t, "u", str(t % 3)) for t in range(500)]]
    return out + [(c, t, "u", "same") for c in range(100, 140) for t in range(3)]


@pytest.mark.parametrize("shard", [1, 7, 1 << 19])
def test_against_brute_force(spark, shard):
    turns = odd_turns()
    assert nodes(spark, turns, shard) == brute(turns)


def test_shards_of_any_size_make_one_trie(monkeypatch):
    monkeypatch.setattr(prefixtrie.TaskContext, "get", staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})()))
    turns = [bytes([i]) * 16 + (i).to_bytes(8, "big") for i in range(3)]
    paths = sorted({b"".join(turns[(i >> j) % 3] for j in range(0, n)) for i in range(30) for n in range(5)})
    rows = [(p, 1, i, "x") for i, p in enumerate(paths)]
    batch = prefixtrie.pa.RecordBatch.from_arrays(
        [prefixtrie.pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (
            prefixtrie.pa.binary(), prefixtrie.pa.int64(), prefixtrie.pa.int64(), prefixtrie.pa.string()), strict=True)],
        ["path", "n", "conv_id", "ends"])
    found = [b for b in prefixtrie._shards([batch], 4)]
    assert len(found) > 5
    ids = {i for b in found for i in b.column(1).to_pylist() if i is not None}
    inner = sum(b.column(1).null_count for b in found)
    assert inner + len(ids) == len({p[:24 * d] for p in paths for d in range(len(p) // 24 + 1)})


def test_nothing_and_little(spark):
    assert nodes(spark, []) == []
    for turns in ([(1, None, None, None)], [(7, 1, "user", "x")], [(None, 1, "user", "x")],
                  [(0, 0, "a", "b"), (1, 0, "a", "b"), (1, 1, "a", "c")]):
        assert nodes(spark, turns) == brute(turns)


def test_tree_is_balanced():
    tree = prefixtrie.SearchTree()
    for i in prefixtrie.by_medians(1023):
        tree.add([i])
    depth, deepest = {0: 0}, 0
    for node in tree.order():
        for below in (tree.low[node], tree.high[node]):
            depth[below] = depth.get(node, 1) + 1
            deepest = max(deepest, depth[below] if below else 0)
    assert deepest <= 10 and sorted(prefixtrie.by_medians(9)) == list(range(9))


def test_other_columns_do_not_matter(spark):
    turns = odd_turns()[:50]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA + ", path STRING, symbol INT")
    assert prefixtrie.paths(df).orderBy("conv_id").collect() == prefixtrie.paths(
        spark.createDataFrame(turns, SCHEMA)).orderBy("conv_id").collect()
