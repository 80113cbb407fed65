"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of a universe make all signature coordinates: the first scatters the shingles,
the second, shifted by k places, orders them for coordinate k. The coordinates of one shingle are
thus a run of the second permutation. Equal sets count as one from the start. In each bucket of a
band every member is compared with one, the pivot: that which meets the most others over all its
buckets, so in a group of edited copies most likely the original. Where that leaves members in
other components of links, they are compared with the rest of the bucket, unless a bound proves
that two sets are no link: the triangle inequality over the distances to the pivot, or the count
of what two members can share, in the pivot by sketches of what each lacks of it, and outside of it
by what each has in common with any other member.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .components import components
from .shared import portions

WORDS = 5             # words of a shingle
SHARE = 75            # a link has a Jaccard similarity of at least this many hundredths
BANDS, ROWS = 32, 4   # a pair at 0.75 misses all bands five times in a million
UNIVERSE = 1 << 20    # places of the two permutations
GONE = 512            # bits of the sketch of what a set lacks of its pivot
LONG = 32             # bytes of a word that are hashed by place; what is longer goes on at once
SEED = 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                     0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits in which every bit of x has its say; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _FACTORS[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _FACTORS[1]
    return x ^ (x >> np.uint64(31))


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a buffer that ends in white space, and where they start."""
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    starts = edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    length = edges[1::2] - starts
    power = np.ones(int(length.max()), np.uint64)
    power[1:] = _BASE
    power = np.multiply.accumulate(power)
    # Longest first: those that have a place j are at the front.
    order = np.argsort(LONG - np.minimum(length, LONG).astype(np.uint8), kind="stable")
    having = len(starts) - np.cumsum(np.bincount(np.minimum(length, LONG)))
    at, sums = starts[order], np.zeros(len(starts), np.uint64)
    for j, k in enumerate(having[:LONG].tolist()):
        sums[:k] += (raw[at[:k] + j].astype(np.uint64) + np.uint64(1)) * power[min(j, len(power) - 1)]
    value = np.empty_like(sums)
    value[order] = sums
    left = np.flatnonzero(length > LONG)
    if len(left):
        rest = length[left] - LONG
        first = np.cumsum(rest) - rest
        place = np.arange(LONG, LONG + first[-1] + rest[-1]) - np.repeat(first, rest)
        more = (raw[np.repeat(starts[left], rest) + place].astype(np.uint64) + np.uint64(1)) * power[place]
        value[left] += np.add.reduceat(more, first)
    return mixed(value), starts


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; some there must be."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted hashes of each text's distinct shingles. Fewer words than a shingle has make one
    shingle, none make none."""
    return _counted_sets(texts)[0]


def _counted_sets(texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
    """The shingle sets of texts, and how many words each text has."""
    raws = [(t or "").encode().lower() + b"\n" for t in texts]
    raw = np.frombuffer(b"".join(raws), np.uint8)
    h, starts = _word_hashes(raw)
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    cut = np.searchsorted(starts, bounds)
    full = max(len(h) - WORDS + 1, 0)
    s = np.zeros(full, np.uint64)
    for j in range(WORDS):
        s += h[j:j + full] * _FACTORS[j]
    s = mixed(s)
    out = []
    for a, b in zip(cut, cut[1:], strict=False):
        if b - a >= WORDS:
            out.append(_distinct(s[a:b - WORDS + 1]))
        elif b > a:
            whole = np.append(h[a:b], np.uint64(b - a)) * _FACTORS[:b - a + 1]
            out.append(mixed(whole.sum(keepdims=True, dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out, np.diff(cut)


@lru_cache(1)
def _permutations(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and all circular runs of the second."""
    random = np.random.default_rng(seed)
    scatter = random.permutation(UNIVERSE).astype(np.int64)
    order = random.permutation(UNIVERSE).astype(np.uint32)
    k = BANDS * ROWS
    runs = np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:k - 1]]), k)
    return scatter, runs


def signature(shingles: np.ndarray) -> np.ndarray:
    scatter, runs = _permutations(SEED)
    at = scatter[(shingles & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    least = runs[at[0]].copy()
    for i in range(0, len(at), 4096):
        np.minimum(least, runs[at[i:i + 4096]].min(0), out=least)
    return least


def bands(signs: np.ndarray) -> np.ndarray:
    """A bucket key for each band of each signature."""
    rows = signs.reshape(*signs.shape[:-1], BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * _BASE + rows[..., j])
    return key.view(np.int64)


def _sums(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums, modulo 2^64, of so many values each in turn."""
    out = np.zeros(len(size), np.uint64)
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(x, (np.cumsum(size) - size)[some])
    return out.view(np.int64)


def sketches(df: DataFrame, key: str = "doc_id", text: str = "text", carried: str | None = None) -> DataFrame:
    """key, h (hash of the text), n (size of the set), f1, f2 (sums that tell sets apart), bands
    (null for no set), words (their number in the text), and the column `carried`, if any."""
    def step(batches):
        for batch in batches:
            for some in portions(batch, 2):
                sets, words = _counted_sets(some.column(2).to_pylist())
                size, every = np.array([len(s) for s in sets]), np.concatenate(sets)
                signs = [signature(s) for s in sets if len(s)]
                keys = bands(np.array(signs)).ravel() if signs else np.zeros(0, np.int64)
                found = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(BANDS * (size > 0))), pa.int32()), pa.array(keys), mask=pa.array(size == 0))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(size, pa.int64()), pa.array(_sums(mixed(every), size)),
                     pa.array(_sums(mixed(every ^ _BASE), size)), found, pa.array(words, pa.int64()), *some.columns[3:]],
                    ["key", "h", "n", "f1", "f2", "bands", "words", *some.schema.names[3:]])

    more = [carried] if carried else []
    rows = df.select(key, F.xxhash64(text), text, *more)
    kind = df.schema[key].dataType.simpleString()
    last = f", {carried} {rows.schema[carried].dataType.simpleString()}" if carried else ""
    return shared.arrow(rows, step, f"key {kind}, h bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>, words bigint{last}")


def _bitmap(shingles: np.ndarray) -> np.ndarray:
    """GONE bits, of which each shingle sets one."""
    bits = np.zeros(GONE, np.uint8)
    bits[(shingles % np.uint64(GONE)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, common, na, nb, rest, gone: exact intersections of the shingle sets of each pair, the
    shingles of a that b lacks, and a bitmap of those of b that a lacks, by GONE of their bits."""
    first = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def step(batches):
        last: tuple[str, np.ndarray] = ("", np.zeros(0, np.uint64))
        for batch in batches:
            for some in portions(batch, 2):
                sets = shingle_sets(some.column(2).to_pylist())
                common, na, nb, rest, gone = [], [], [], [], []
                for mine, text in zip(sets, some.column(3).to_pylist(), strict=True):
                    if text != last[0]:
                        last = (text, shingle_sets([text])[0])
                    other = last[1]
                    at = np.minimum(np.searchsorted(other, mine), len(other) - 1)
                    both = other[at] == mine
                    common.append(int(both.sum()))
                    rest.append(mine[~both].view(np.int64))
                    lacked = np.ones(len(other), bool)
                    lacked[at[both]] = False
                    gone.append(_bitmap(other[lacked]))
                    na.append(len(mine))
                    nb.append(len(other))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(common, pa.int64()), pa.array(na, pa.int64()),
                     pa.array(nb, pa.int64()), pa.array(rest, pa.list_(pa.int64())),
                     pa.array(gone, pa.list_(pa.int64()))], ["a", "b", "common", "na", "nb", "rest", "gone"])

    kind = pairs.schema["a"].dataType.simpleString()  # a set's name: f1 and f2
    return shared.arrow(both, step, f"a {kind}, b {kind}, common bigint, na bigint, nb bigint, rest array<bigint>, gone array<bigint>")


def _links(found: DataFrame) -> DataFrame:
    return found.where(F.expr(f"100 * common >= {SHARE} * (na + nb - common)")).select("a", "b")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_shingles, component_id, kept for every row.

    Words are runs of other than ASCII white space with A-Z in lower case, a set is that of the
    distinct runs of WORDS words, and documents are linked from a Jaccard similarity of SHARE
    hundredths. `component_id` is the smallest key reachable, `kept` whether that is the row's own.
    A null or blank text has no shingles and no links. Rows that repeat a key are documents of
    their own. A row without a key has no links, a null component and is kept. Equal sets and
    large groups are never spelled out as pairs. No rows, no result. A text is held as a whole with
    eight bytes for each of its words, however long. Other columns are not read.
    """
    component = F.when(F.col("key").isNotNull(), F.col("component_id"))
    return labelled(df, key, text).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))


def labelled(df: DataFrame, key: str, text: str, carried: str | None = None) -> DataFrame:
    """key, n (size of the set), words, component_id as `near_duplicates` finds it, and the column
    `carried`, if any, for every row."""
    more = [F.col(carried).alias("carried")] if carried else []
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), *more)
    sets = shared.settle(sketches(rows, "key", "text", "carried" if carried else None), "sketches")
    named, equal = sets.where("n > 0 and key is not null"), ["n", "f1", "f2"]
    first = shared.settle(named.groupBy(*equal).agg(
        F.min("key").alias("rep"), F.min(F.struct("key", "h")).alias("row"),
        F.count(F.lit(1)).alias("copies")), "sets")
    sid = F.struct("f1", "f2").alias("sid")
    chosen = named.join(first, equal).where(F.struct("key", "h") == F.col("row"))
    posted = shared.settle(chosen.select(sid, "n", "copies", F.explode("bands").alias("bucket")).distinct(), "postings")
    sizes = shared.settle(posted.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    met = shared.settle(posted.join(sizes, "bucket"), "met")
    weights = met.groupBy("sid").agg(F.sum("size").alias("weight"))
    pivots = shared.settle(met.join(weights, "sid").groupBy("bucket").agg(
        F.max(F.struct("weight", "copies", "sid"))["sid"].alias("pivot")), "pivots")
    inside = shared.settle(met.select("bucket", "sid", "n").join(pivots, "bucket"), "bucket-members")

    pairs = shared.settle(inside.where("sid <> pivot").select(
        F.col("sid").alias("a"), F.col("pivot").alias("b")).distinct(), "pairs")
    needed = first.select(sid, "row.key", "row.h").join(inside.select("sid").distinct(), "sid", "left_semi")
    texts = shared.settle(rows.withColumn("h", F.xxhash64("text")).join(needed, ["key", "h"]).groupBy("sid").agg(
        F.any_value("text").alias("text")), "texts")
    found = shared.settle(_verified(pairs, texts), "verified")
    groups = shared.settle(components(_links(found)), "components")
    more = shared.settle(_across(inside, found, groups), "pairs")
    if not more.isEmpty():
        known = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = shared.settle(components(known.unionByName(_links(_verified(more, texts)))), "components")

    reps = groups.join(first.select(sid.alias("node"), "rep"), "node")
    lowest = shared.settle(reps.groupBy("component").agg(F.min("rep").alias("component_id")), "lowest")
    labels = groups.join(lowest, "component").select("node", "component_id")
    named_sets = shared.settle(first.withColumn("node", sid).join(labels, "node", "left").select(
        *equal, F.coalesce("component_id", "rep").alias("component_id")), "labels")
    return sets.join(named_sets, equal, "left").select(
        "key", "n", "words", F.coalesce("component_id", "key").alias("component_id"),
        *([F.col("carried").alias(carried)] if carried else []))


def _across(inside: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """a, b: pairs of a bucket in different components that no bound rules out."""
    distance = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
    # What two members of a bucket share lies in its pivot or in what both have besides.
    rest = found.select("a", "b", F.explode("rest").alias("g"))
    again = rest.groupBy("b", "g").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("b", "g")
    besides = rest.join(again, ["b", "g"]).groupBy("a", "b").agg(F.count(F.lit(1)).alias("besides"))
    to_pivot = found.drop("rest").join(besides, ["a", "b"], "left").select(
        F.col("a").alias("sid"), F.col("b").alias("pivot"), distance.alias("d"), "common", F.col("nb").alias("pn"), "gone",
        F.coalesce("besides", F.lit(0)).alias("besides"))
    of_pivot = groups.select(F.col("node").alias("pivot"), F.col("component").alias("pc"))
    placed = shared.settle(inside.where("sid <> pivot").join(to_pivot, ["sid", "pivot"]).join(
        groups.withColumnRenamed("node", "sid"), "sid", "left").join(of_pivot, "pivot", "left").select(
        "bucket", "sid", "n", "pn", "d", "common", "besides", "gone", F.coalesce("component", "sid").alias("c"),
        F.coalesce("pc", "pivot").alias("pc")), "placed")
    strays = placed.where("c <> pc").select(
        "bucket", *[F.col(c).alias(f"x_{c}") for c in ("sid", "n", "d", "common", "besides", "gone", "c")])
    lacked = sum((F.bit_count(F.col("gone")[i].bitwiseOR(F.col("x_gone")[i])) for i in range(GONE // 64)), F.lit(0))
    inner = F.least("x_common", "common", F.col("pn") - lacked)
    overlap = F.least(inner + F.least("x_besides", "besides"), "x_n", "n")
    near = strays.join(placed, "bucket").where(
        (F.col("x_c") != F.col("c")) & (F.abs(F.col("x_d") - F.col("d")) <= (100 - SHARE) / 100 + 1e-9)
        & (100 * overlap >= SHARE * (F.col("x_n") + F.col("n") - overlap)))
    return near.select(F.greatest("x_sid", "sid").alias("a"), F.least("x_sid", "sid").alias("b")).distinct()
