"""Rank BPE against the tiktoken library: odd texts, whole tables, and ranks that no training would give."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from lexitally.llm import queries, rankbpe

from brute import rows

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id BIGINT, text STRING"


def library(ranks, pattern=PATTERN):
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(PATH) as f:
        return library({base64.b64decode(a): int(b) for a, b in map(str.split, f)})


def split(found):
    ids, count = found
    at = 0
    for n in count:
        yield ids[at:at + n].tolist()
        at += n


TEXTS = ["", " ", "  \n\n x  ", "a", "don't we'll 'S 's", "<|endoftext|> hi", "\x00\x01\x7f", "a\x1cb \x1c c\x85 d",
         "日本語テキスト" * 50, "ab²½٣Ⅷ x_y-z", "👩‍👩‍👧 é é ﬁ İ", "a" * 3000, "ab" * 5000, " " * 700 + "x", "\n " * 300,
         "\U00011de0 \U0001e900 ՘ ꟎1 x꟎y"]


def test_odd_texts(own):
    rng = random.Random(1)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = TEXTS + ["".join(chr(rng.choice(points)) for _ in range(200)) for _ in range(50)]
    texts += ["".join(rng.choice("abcdeth \n'sé1") for _ in range(rng.randrange(300))) for _ in range(200)]
    with open(PATH) as f:
        encoder = rankbpe.Encoder(f.read(), PATTERN)
    for text, ids in zip(texts, split(encoder(texts)), strict=True):
        assert ids == own.encode_ordinary(text)
        assert encoder.decode(rankbpe.np.array(ids, int)) == text.encode()


@pytest.mark.parametrize("seed", range(40))
def test_ranks_in_any_order(seed):
    # Merges that make a pair of lower rank than their own, and equal ranks that overlap.
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abc"
    tokens = {"".join(rng.choice(letters) for _ in range(rng.randrange(2, 6))) for _ in range(12)}
    order = [bytes([i]) for i in range(256)] + sorted(t.encode() for t in tokens)
    rng.shuffle(order)
    told = "\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(order))
    pattern = r"\p{L}+|\P{L}+"
    theirs = library({t: i for i, t in enumerate(order)}, pattern)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(50)]
    texts.append("".join(rng.choice(letters) for _ in range(3000)))
    found = split(rankbpe.Encoder(told, pattern)(texts))
    assert list(found) == [theirs.encode_ordinary(t) for t in texts]


def test_queue_gives_the_least_rank_first():
    queue = rankbpe.RankQueue(70_000)
    queue.fill(rankbpe.np.array([69_999, -1, 3, 3, 300]))
    assert queue.first(5) == 3 and queue.take(3) == [3, 2]
    assert queue.first(300) == 300 and queue.first(70_000) == 300 and queue.take(300) == [4]
    assert queue.first(70_000) == 69_999 and queue.take(69_999) == [0]
    assert queue.first(70_000) == 70_000 and queue.first(7) == 7


def test_a_long_pre_token_of_many_kinds():
    with open(PATH) as f:
        encoder = rankbpe.Encoder(f.read(), PATTERN)
    text = "xy" * 100_000 + "thequickbrown" * 10_000
    (ids,) = split(encoder([text]))
    assert encoder.decode(rankbpe.np.array(ids)) == text.encode() and len(ids) < 150_000


def test_rows_nulls_and_clashes(spark, own):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (2, None, None), (None, "c", None)],
                               SCHEMA + ", ids STRING")
    coded = rankbpe.encode(df, PATH, PATTERN)
    assert sorted(map(str, coded.collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(1, own.encode_ordinary("a b"))] * 2 + [(2, []), (None, own.encode_ordinary("c"))], "doc_id BIGINT, ids ARRAY<INT>").collect())
    back = rankbpe.decode(coded.withColumn("decoded", rankbpe.F.lit(1)), PATH, PATTERN, into="raw")
    assert sorted(bytes(r.raw) for r in back.collect()) == [b"", b"a b", b"a b", b"c"]
    both = rankbpe.round_trip(df, PATH, PATTERN)
    assert sorted(map(str, both.drop("decoded").collect())) == sorted(map(str, coded.collect()))
    assert sorted(bytes(r.decoded) for r in both.collect()) == [b"", b"a b", b"a b", b"c"]
    none = spark.createDataFrame([(1, None)], "doc_id BIGINT, ids ARRAY<INT>")
    assert rankbpe.decode(none, PATH, PATTERN).first().decoded == b""
    assert rankbpe.encode(spark.createDataFrame([], SCHEMA), PATH, PATTERN).isEmpty()


def test_query(spark, sf, own):
    found = {r.doc_id: tuple(r)[1:] for r in queries.op11_rankbpe(spark, sf).collect()}
    want = {}
    for i, text in rows(sf, "SELECT doc_id, text FROM documents"):
        ids = own.encode_ordinary(text or "")
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256((text or "").encode()).hexdigest())
    assert found == want
