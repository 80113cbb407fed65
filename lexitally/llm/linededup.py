"""Removal of lines that repeat earlier ones, by an exact set-similarity join in DataFrame functions.

A line is the set of its runs of five words, one of fewer words that of its whole sequence. The runs are ordered from rare to frequent, by counts
over all lines, and two sets with a Jaccard similarity of 0.75 must share one among their first few.
Sets that do are compared if their lengths and the places of the shared run allow the similarity at
all. Equal lines count as one from the start. In a posting list every set is compared with the
earliest and with the most frequent one; only sets that stay without an earlier match are compared
with all that are earlier, so a large group of near copies is not spelled out as pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

WORDS = 5            # words of a run; fewer words in a line are one run, no word is none
SHARE = 3, 4         # least similarity, as a fraction
SLOTS = 1 << 16      # counts of runs by hash: a table of this size whatever the input
WORDS_OF_BITS = 1 << 15
BITS = 40            # of a run's hash in postings: runs that share them by chance stay few in 10^9

_BLANK = r"[\x20\x09-\x0D]+"
_RARE = "\t\x0b\f\r"  # white space in lines other than a blank; where there is none, no pattern is needed
ORDER = ("doc", "h", "line")
NAME = ("a", "b")    # of equal lines; two columns, since a pair is compared field by field when sorted
PARITY = ("p", "q")  # of a set's runs: the first of all, the second of those whose seventh bit is set


def _documents(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("doc"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))


def _worded(docs: DataFrame, wanted: Column | None = None) -> DataFrame:
    """doc, h, line, w: the words of every line, or of those lines for which `wanted` holds. Nothing is
    filtered by what is computed here, nor exploded but by the outer form: either would compute it
    twice."""
    lines = docs.select("doc", "h", F.posexplode_outer(F.split("text", "\n")).alias("line", "value"))
    if wanted is not None:
        lines = lines.where(wanted)
    low = lines.select(*ORDER, F.lower("value").alias("low"))
    rare = reduce(or_, (F.contains(F.col("low"), F.lit(c)) for c in _RARE))
    words = F.when(rare, F.split("low", _BLANK)).otherwise(F.split("low", " "))
    return low.select(*ORDER, F.array_remove(words, "").alias("w"))


def _runs(worded: DataFrame, *more: Column) -> DataFrame:
    """doc, h, line, more, set: 64-bit hashes of the distinct runs of every line, none without words.
    A word is hashed once, a run is the hash of its words' hashes."""
    n = F.greatest(F.size("w") - (WORDS - 1), F.lit(0))
    runs = worded.select(*ORDER, *more, "w", F.transform("w", lambda x: F.xxhash64(x)).alias("words"))
    short = F.filter(F.array(F.when((F.size("w") > 0) & (F.size("w") < WORDS), F.xxhash64("w"))), lambda r: r.isNotNull())
    long = F.array_distinct(F.transform(F.slice("words", 1, n), lambda x, i: F.xxhash64(
        x, *[F.get(F.col("words"), i + j) for j in range(1, WORDS)])))
    return runs.select(*ORDER, *[c for c in runs.columns if c not in (*ORDER, "w", "words")],
                       F.when(F.size("w") < WORDS, short).otherwise(long).alias("set"))


def _literal(values: list[int], kind: str) -> Column:
    """A constant array, folded once when the query is planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _low(x: Column) -> Column:
    """The lower BITS bits."""
    return x.bitwiseAND(F.lit((1 << BITS) - 1))


def _lines(docs: DataFrame, own: shared.Intermediates) -> DataFrame:
    """doc, h, line, NAME (128 bits that tell the line's words from others), runs (BITS bits of each
    run's hash, one for each distinct run) of the lines that have words."""
    name = F.xxhash64("w").alias("a"), F.xxhash64(F.lit(1), "w").alias("b")
    made = _runs(_worded(docs), *name).select(*ORDER, *NAME, F.transform(F.sort_array("set"), _low).alias("runs"))
    return own.settle(made, "lines").where(F.size("runs") > 0)


def _rarity(lines: DataFrame) -> Column:
    """By slot, how far the runs with the same slot count above the usual slot, as the number of bits of its
    multiple of the usual distance. The usual count grows with the input, and would hide frequent runs if it
    were not taken off."""
    slot = F.pmod("r", F.lit(SLOTS)).alias("slot")
    counts = lines.select(F.explode_outer("runs").alias("r")).groupBy(slot).count().collect()
    count = [0] * SLOTS
    for r in counts:
        count[r.slot] = r["count"]
    ranked = sorted(count)
    usual, high = ranked[SLOTS // 2], ranked[SLOTS * 3 // 4]
    return _literal([(max(c - usual, 0) // max(high - usual, 1)).bit_length() for c in count], "bigint")


def _parities(runs: Column) -> list[Column]:
    """128 bits in two words, of which every run turns one."""
    def turned(start: Callable[[Column], Column]) -> Column:
        turn = lambda x: F.call_function("shiftleft", start(x), x.bitwiseAND(F.lit(63)).cast("int"))
        return F.aggregate(runs, F.lit(0).cast("bigint"), lambda bits, x: bits.bitwiseXOR(turn(x)))

    both = turned(lambda x: F.lit(1).cast("bigint"))
    second = turned(lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(1).cast("bigint")))
    return [both.alias(PARITY[0]), second.alias(PARITY[1])]


def _prefixes(lines: DataFrame, rarity: Column) -> DataFrame:
    """doc, h, line, NAME, n (size of the set), PARITY, prefix: its first runs, rare ones first, each with
    its class of rarity in the bits above BITS. That follows from the run, so they are equal if the runs are."""
    ranked = F.sort_array(F.transform("runs", lambda x: F.shiftleft(
        F.get(rarity, F.pmod(x, F.lit(SLOTS)).cast("int")), BITS).bitwiseOR(x)))
    n = F.size("runs")
    length = n - F.ceil(n * SHARE[0] / SHARE[1]).cast("int") + 1
    return lines.select(*ORDER, *NAME, n.alias("n"), *_parities(F.col("runs")), F.slice(ranked, F.lit(1), length).alias("prefix"))


def _possible(xn: Column, xi: Column, yn: Column, yi: Column) -> Column:
    """Length filter, and positional filter for the first shared run: similarity a/b needs an
    overlap of a / (a + b) times both sizes."""
    a, b = SHARE
    reach = 1 + F.least(xn - 1 - xi, yn - 1 - yi)
    return (b * F.least(xn, yn) >= a * F.greatest(xn, yn)) & ((a + b) * reach >= a * (xn + yn))


def _alike(xn: Column, x: list[Column], yn: Column, y: list[Column]) -> Column:
    """Whether the parities allow the similarity. What two sets share turns the same bits in both, so no
    more bits differ than there are runs in one of them alone, and a similarity a/b leaves
    (b - a) / (a + b) of both sizes for those. Without this, pairs to compare grow with the square of the input."""
    a, b = SHARE
    both, second = (p.bitwiseXOR(q) for p, q in zip(x, y, strict=True))
    return (a + b) * (F.bit_count(both.bitwiseXOR(second)) + F.bit_count(second)) <= (b - a) * (xn + yn)


def _some_lines(wanted: DataFrame) -> Column:
    """Holds for the wanted (doc, h, line) and a few more: a filter of fixed size, so that few
    lines besides are taken up before the exact join."""
    bit = F.pmod(F.xxhash64(*ORDER), F.lit(64 * WORDS_OF_BITS))
    found = wanted.select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).collect()
    words = [0] * WORDS_OF_BITS
    for r in found:
        words[r.word] = r.bits
    word = F.get(_literal(words, "bigint"), F.shiftright(bit, 6).cast("int"))
    return F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1


def _full(docs: DataFrame, pairs: DataFrame, sets: DataFrame, own: shared.Intermediates) -> DataFrame:
    """s, set: all runs of the sets in the pairs, taken from the first line of each."""
    named = pairs.select(F.explode(F.array("early", "late")).alias("s")).distinct()
    wanted = own.settle(sets.select("s", "first.*").join(named, "s", "left_semi"), "wanted")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ORDER]
    found = _runs(_worded(docs, _some_lines(wanted))).alias("f").join(wanted.alias("w"), same)
    return own.settle(found.select("w.s", "f.set").dropDuplicates(["s"]), "full-sets")


def _similar(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """s: the later set of each pair (early, late) that is similar indeed."""
    a, b = SHARE
    both = pairs.join(full.select(F.col("s").alias("early"), F.col("set").alias("x")), "early").join(
        full.select(F.col("s").alias("late"), F.col("set").alias("y")), "late")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(b * common >= a * (F.size("x") + F.size("y") - common)).select(F.col("late").alias("s")).distinct()


def repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, h (hash of the text), removed: numbers, from 0, of the lines that match an earlier one.

    Lines end at LF, words are runs of other than ASCII white space in lower case. A line comes
    after those of documents with smaller keys, and of equal keys smaller h, and after those
    above it; it is removed if any line before it, removed itself or not, has a similarity of at
    least SHARE. Lines of fewer than WORDS words are alike if their words are; lines without a word
    match nothing. Null texts and empty tables have no lines; rows without a key come first; rows that
    repeat key and text are one document, whose lines stay or go in all of them. A text is taken up
    whole, however long, and one line's runs are one array. Runs are told apart by 64-bit hashes,
    and equal lines by 128 bits of their words. Columns that are not named are not read.
    """
    own = shared.Intermediates(df.sparkSession)
    docs = _documents(df, key, text)
    lines = _lines(docs, own)
    place = F.struct(*ORDER)
    # Different lines are numbered while they are written: a number is half as long as a name, and
    # numbers stay as they are once they are settled.
    sets = own.settle(_prefixes(lines, _rarity(lines)).groupBy(*NAME).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"),
        *[F.any_value(c).alias(c) for c in (*PARITY, "prefix")]).withColumn("s", F.monotonically_increasing_id()), "sets")
    # From here on a line is its name; the runs of all lines make room.
    named = own.settle(lines.select(*ORDER, *NAME), "names")
    own.done("lines")

    posted = sets.select("s", F.posexplode_outer("prefix").alias("i", "run"))
    # A run of one set alone leads nowhere. Counted by partial aggregates, whatever its number.
    again = own.settle(posted.groupBy("run").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("run"), "again")
    listed = own.settle(posted.join(again, "run", "left_semi"), "listed")
    inside = own.settle(listed.join(sets.select("s", "n", "first", "copies", *PARITY), "s"), "postings")
    own.done("again", "listed")
    row = F.struct("first", "s", "n", "i", *PARITY)
    parity, of_pivot = [F.col(p) for p in PARITY], [F.col(f"pivot.{p}") for p in PARITY]
    pivots = own.settle(inside.groupBy("run").agg(
        F.min(row).alias("earliest"), F.max(F.struct("copies", row.alias("row")))["row"].alias("commonest")), "pivots")
    beside = inside.join(pivots, "run").withColumn("pivot", F.explode(F.array("earliest", "commonest"))).where(
        (F.col("s") != F.col("pivot.s")) & _possible(F.col("n"), F.col("i"), F.col("pivot.n"), F.col("pivot.i"))
        & _alike(F.col("n"), parity, F.col("pivot.n"), of_pivot))
    before = F.col("first") < F.col("pivot.first")
    star = own.settle(beside.select(
        F.when(before, F.col("s")).otherwise(F.col("pivot.s")).alias("early"),
        F.when(before, F.col("pivot.s")).otherwise(F.col("s")).alias("late")).distinct(), "pairs")
    matched = own.settle(_similar(star, _full(docs, star, sets, own)), "matched")
    own.done("pivots", "wanted", "full-sets")

    left = inside.join(matched, "s", "left_anti").select(
        "run", F.col("s").alias("late"), F.col("first").alias("late_first"), F.col("n").alias("xn"), F.col("i").alias("xi"),
        *[F.col(p).alias(f"x{p}") for p in PARITY])
    rest = own.settle(left.join(inside, "run").where(
        (F.col("first") < F.col("late_first")) & _possible(F.col("xn"), F.col("xi"), F.col("n"), F.col("i"))
        & _alike(F.col("xn"), [F.col(f"x{p}") for p in PARITY], F.col("n"), parity)).select(
        F.col("s").alias("early"), "late").distinct().join(star, ["early", "late"], "left_anti"), "rest")
    own.done("postings", "pairs")
    found = matched
    if not rest.isEmpty():
        found = matched.unionByName(_similar(rest, _full(docs, rest, sets, own))).distinct()

    decided = own.settle(sets.select("s", *NAME, "first").join(
        found.withColumn("near", F.lit(True)), "s", "left").drop("s"), "decided")
    gone = named.join(decided, list(NAME)).where(F.coalesce("near", F.lit(False)) | ~place.eqNullSafe(F.col("first")))
    removed = shared.settle(gone.groupBy("doc", "h").agg(F.sort_array(F.collect_set("line")).alias("removed")), "removed")
    own.done()
    return removed


def _beside(df: DataFrame, h: str, removed: DataFrame, key: str) -> tuple[DataFrame, str]:
    """`df`, with the texts' hashes in the column `h`, beside the numbers of lines to remove, and the name
    of the column that holds those."""
    name = shared.fresh(df, "_removed")
    gone = removed.select(
        F.col("doc").alias("doc"), F.col("h").alias("g_h"), F.col("removed").alias("g_removed")).alias("g")
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("g.doc")) & (F.col(f"d.`{h}`") == F.col("g.g_h"))
    found = df.alias("d").join(gone, same, "left")
    return found.select(*[F.col(f"d.`{c}`") for c in df.columns if c != h], F.col("g.g_removed").alias(name)), name


def line_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_lines, removed: for every row how many lines it has and which of them go."""
    h, n = shared.fresh(df, "_h"), shared.fresh(df, "_n")
    # Texts are not moved for a number.
    rows = df.select(key, F.xxhash64(text).alias(h), F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias(n))
    found, name = _beside(rows, h, repeated_lines(df.select(key, text), key, text), key)
    return found.select(key, F.col(n).alias("n_lines"), F.coalesce(name, F.array().cast("array<int>")).alias("removed"))


def without_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` without repeated lines, all columns kept. Rows of which only white space is
    left go; rows that lose nothing stay as they are, null and empty texts included."""
    h = shared.fresh(df, "_h")
    found, name = _beside(df.withColumn(h, F.xxhash64(text)), h, repeated_lines(df, key, text), key)
    new = shared.fresh(found, "_new")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(name))
    rest = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    shorter = found.withColumn(new, F.when(F.col(name).isNotNull(), rest)).where(
        F.col(new).isNull() | F.col(new).rlike(r"[^\x20\x09-\x0D]"))
    return shorter.withColumn(text, F.coalesce(new, text)).select(*df.columns)
