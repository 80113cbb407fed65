import random
import re
import time

import brute
import pytest
from pyspark.sql import functions as F

from lexitally.llm import linededup

SHAPE = "doc_id BIGINT, text STRING, removed STRING, h INT, line INT"


def table(spark, rows):
    return spark.createDataFrame([(*r, "kept", 1, 2) for r in rows], SHAPE)


def removed(df):
    return {r.doc_id: r.removed for r in linededup.line_report(df).collect() if r.removed}


@pytest.fixture(scope="module")
def corpus():
    """Near copies in plenty: lines of a few bases with some words changed, and very common words."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    bases = [[word() for _ in range(r.randrange(5, 60))] for _ in range(6)]
    docs = []
    for d in range(120):
        lines = []
        for _ in range(r.randrange(0, 6)):
            line = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
                line[r.randrange(len(line))] = word()
            lines.append(" ".join(line))
        lines += [" ".join(r.choice(["the", "of", "and"]) for _ in range(r.randrange(1, 9))) for _ in range(2)]
        docs.append((d, "\n".join(lines)))
    return docs


def test_different_runs_are_told_apart(spark):
    """Of 300,000 runs about ten pairs have 32 bits in common, which joined their lines as if alike."""
    runs = spark.range(300_000, numPartitions=4).select(linededup._low(F.xxhash64("id")).alias("r"))
    assert runs.distinct().count() == 300_000


def test_words_are_cut_at_any_white_space(spark):
    values = ["A b\tC", " a  b ", "a\x0bb\x0cc\rd", "a\u00a0b c", "", " \t", "\x1fa", None]
    docs = spark.createDataFrame([(i, i, v) for i, v in enumerate(values)], "doc INT, h BIGINT, text STRING")
    found = {r.doc: r.w for r in linededup._worded(docs).collect()}
    assert found == {
        0: ["a", "b", "c"], 1: ["a", "b"], 2: ["a", "b", "c", "d"], 3: ["a\u00a0b", "c"], 4: [], 5: [], 6: ["\x1fa"], 7: None}


def test_like_brute_force(spark, corpus):
    assert removed(table(spark, corpus)) == brute.repeated_lines(corpus)


def test_chain_of_changes(spark):
    """Each line is like the one before it alone: all but the first go, though most have no match
    among the earliest and the most frequent."""
    words = [f"w{i}" for i in range(40)]
    docs = []
    for d in range(30):
        docs.append((d, " ".join(words)))
        words[(7 * d) % 40] = f"x{d}"
    assert removed(table(spark, docs)) == brute.repeated_lines(docs)


def test_odd_rows(spark):
    same = "one two three four five six"
    rows = [(None, same), (5, f"{same}\nfive words are enough here\nno"), (5, f"x\n{same}"), (7, None), (8, ""), (9, " \n\n"),
            (11, f"  ONE two\tthree four five  six \r\n{same}\n{'word ' * 200_000}"), (12, same), (12, same)]
    df = table(spark, rows)
    report = {(r.doc_id, r.n_lines): r.removed for r in linededup.line_report(df).collect()}
    assert report == {(None, 1): [], (5, 3): [0], (5, 2): [1], (7, 0): [], (8, 1): [], (9, 3): [], (11, 3): [0, 1], (12, 1): [0]}
    clean = linededup.without_repeated_lines(df)
    assert clean.columns == df.columns
    found = {(r.doc_id, r.text) for r in clean.collect()}
    assert found == {(None, same), (5, "five words are enough here\nno"), (5, "x"), (7, None), (8, ""), (9, " \n\n"),
                     (11, "word " * 200_000)}
    assert linededup.line_report(df.where("false")).collect() == []
    assert linededup.without_repeated_lines(df.where("doc_id = 7")).count() == 1


def test_report_moves_no_texts(spark, corpus, capsys):
    """Texts were shuffled and sorted to count their lines beside the removed ones."""
    report, key = linededup.line_report(table(spark, corpus)), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        report.explain("formatted")
    finally:
        spark.conf.set(key, before)
    moved = re.findall(r"\) Exchange\nInput.*", capsys.readouterr().out)
    assert moved and not any("text#" in m for m in moved)


def test_postings_hold_numbers(spark, corpus, monkeypatch):
    """Different lines have different numbers, and no posting holds a name of 128 bits."""
    kinds, settle = {}, linededup.shared.Intermediates.settle

    def seen(own, df, name):
        found = settle(own, df, name)
        kinds[name] = dict(found.dtypes)
        if name == "sets":
            assert found.select("s").distinct().count() == found.select("a", "b").distinct().count() == found.count()
        return found

    monkeypatch.setattr(linededup.shared.Intermediates, "settle", seen)
    assert removed(table(spark, corpus)) == brute.repeated_lines(corpus)
    assert {kinds[k]["s"] for k in ("listed", "postings")} == {"bigint"} == set(kinds["pairs"].values())


def test_lines_that_share_half_are_no_pairs(spark, monkeypatch):
    """Each line shares half of its words with the next one, and their first runs. They were compared run by
    run, and such pairs grow with the square of the input."""
    sizes, settle = {}, linededup.shared.Intermediates.settle

    def seen(own, df, name):
        found = settle(own, df, name)
        sizes[name] = found.count()
        return found

    monkeypatch.setattr(linededup.shared.Intermediates, "settle", seen)
    half = lambda d: " ".join(f"w{d % 40}x{j}" for j in range(52))
    assert removed(table(spark, [(d, f"{half(d)} {half(d + 1)}") for d in range(40)])) == {}
    assert sizes["postings"] > 0 == sizes["pairs"] == sizes["rest"]


def test_long_lines_near_the_least_similarity(spark):
    """Parities rule out no pair that is similar, whatever the length."""
    r, docs = random.Random(12), []
    for b in range(60):
        words = [f"w{r.randrange(10 ** 6)}" for _ in range(r.randrange(20, 600))]
        docs.append((len(docs), " ".join(words)))
        for share in (0.72, 0.75, 0.78):  # of the runs both have, by words replaced at the end
            kept = round((len(words) - 4) * 2 * share / (1 + share)) + 4
            docs.append((len(docs), " ".join(words[:kept] + [f"y{b}x{len(docs)}x{j}" for j in range(len(words) - kept)])))
    found = removed(table(spark, docs))
    assert found == brute.repeated_lines(docs)
    assert 60 <= len(found) < 180


def test_frequent_runs_are_told_apart_in_full_slots(spark, monkeypatch):
    """Counts of a full slot and of one with a frequent run besides had the same number of bits."""
    monkeypatch.setattr(linededup, "SLOTS", 32)
    runs = [hash_ * 32 + slot for slot in range(32) for hash_ in range(1100)] + [7] * 600
    lines = spark.createDataFrame([(runs[i:i + 50],) for i in range(0, len(runs), 50)], "runs ARRAY<BIGINT>")
    found = spark.range(32).select("id", F.get(linededup._rarity(lines), F.col("id").cast("int")).alias("bits")).collect()
    assert max(found, key=lambda x: x.bits).id == 7 and sorted(x.bits for x in found)[-2] < found[7].bits


def test_shuffles_go_when_a_result_is_settled(spark):
    """They stayed until the driver happened to collect its garbage, and those of all steps added up."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    key, own = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", linededup.shared.Intermediates(spark)
    shuffles = lambda: {x for x in map(str, disk.getAllFiles().mkString("|").split("|")) if "/shuffle_" in x}
    before, setting = shuffles(), spark.conf.get(key, None)
    rows = spark.range(20_000, numPartitions=4).groupBy((F.col("id") % 5000).alias("k")).count()
    found = own.settle(rows, "a"), linededup.shared.settle(rows, "b")
    for _ in range(100):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key, None) == setting
    assert [x.count() for x in found] == [5000, 5000]
    own.done()


def test_no_python_in_the_plan(spark, sf, capsys):
    linededup.line_report(spark.read.parquet(f"{sf}/documents.parquet")).explain("extended")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
