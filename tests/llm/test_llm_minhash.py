import random

import brute
import numpy as np
import pytest

from lexitally.llm import minhash
from lexitally.llm.components import components

SHAPE = "doc_id BIGINT, text STRING, key STRING, n INT, bands INT"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE)


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_sets():
    for text in ["", " \t\n\x0b\x0c\r", "one", "A b", "a b c d e", "a b c d e f a b c d e", "É é x \x1c y z w v", "x" * 100_000]:
        words = [w for w in __import__("re").findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())]
        assert len(minhash.shingle_sets([text])[0]) == len(brute.runs(words))
    a, b = minhash.shingle_sets(["a b c d", "a b c d e"])
    assert not set(a.tolist()) & set(b.tolist())


def test_words_of_any_length_have_their_own_hash():
    for n in (1, 2, 31, 32, 33, 34, 64, 1000):
        texts = ["q" * n, "q" * (n + 1), "q" * (n - 1) + "r", "r" + "q" * (n - 1), "x " + "q" * n]
        raw = np.frombuffer("".join(f"{t}\n" for t in texts).encode(), np.uint8)
        h, starts = minhash._word_hashes(raw)
        assert len(set(h.tolist())) == 4 + (n > 1) and h[0] == h[-1] and len(starts) == 6  # one byte: "r" twice
        alone, _ = minhash._word_hashes(np.frombuffer(f"{texts[1]}\n".encode(), np.uint8))
        assert alone[0] == h[1]
    sets, words = minhash._counted_sets(["a b c d e f", None, " ", "a", "a b c d e f a b c d e f"])
    assert list(words) == [6, 0, 0, 1, 12] and [len(s) for s in sets] == [2, 0, 0, 1, 6]


def test_signatures_estimate_similarity():
    r = np.random.default_rng(7)
    shared_, a, b = (r.integers(0, 1 << 63, n, np.uint64) for n in (6000, 1000, 1000))
    x = minhash.signature(np.concatenate([shared_, a]))
    y = minhash.signature(np.concatenate([shared_, b]))
    assert abs((x == y).mean() - 0.75) < 0.12
    scatter, runs = minhash._permutations(minhash.SEED)
    assert len(np.unique(scatter)) == minhash.UNIVERSE and runs[5, 3] == runs[8, 0] and runs[-1, 1] == runs[0, 0]


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    bases = [[word() for _ in range(n)] for n in (3, 5, 8, 60, 200, 400)]
    docs = []
    for d in range(250):
        text = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 0, 1, 1, 2, 3, 6])):
            text[r.randrange(len(text))] = word()
        docs.append((1000 - d, r.choice([" ", "\n", "  "]).join(text)))
    return docs


def test_like_brute_force(spark, corpus):
    assert found(minhash.near_duplicates(table(spark, corpus))) == brute.components(corpus)


def test_chain(spark):
    words = [f"w{i}" for i in range(120)]
    docs = []
    for d in range(25):
        docs.append((d, " ".join(words)))
        words[(11 * d) % 120], words[(11 * d + 50) % 120] = f"x{d}", f"y{d}"
    want = brute.components(docs)
    assert {c for _, c, _ in want.values()} == {0}
    assert found(minhash.near_duplicates(table(spark, docs))) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "a b c d e"), (7, "a b c d e"),
            (8, "A B C D E"), (9, "word " * 200_000), (10, "word word word word word"), (None, "a b c d e"), (11, "k l m n o"), (11, "a b c d e")]
    df = table(spark, rows)
    rows_ = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minhash.near_duplicates(df).collect())
    assert rows_ == sorted([
        ("1", 0, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 1, "4", True), ("5", 1, "4", False), ("6", 1, "6", True),
        ("7", 1, "7", True), ("7", 1, "7", True), ("8", 1, "7", False), ("9", 1, "9", True), ("10", 1, "9", False),
        ("None", 1, "None", True), ("11", 1, "11", True), ("11", 1, "7", False)])
    assert minhash.near_duplicates(df.where("false")).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (7, 3), (200, 201), (202, 201), (202, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200, 202: 200}
