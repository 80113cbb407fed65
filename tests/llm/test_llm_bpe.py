import hashlib
import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexitally.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b\n\n c ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "a" * 700, "abab" * 300,
       "世界 🙂 é \x1c\x1d a\x85b 　x", "don't we'll 'S 's", "x" * 3000, "\x00\x01", "²³ ½ ª º µ ǅ",
       "word " * 300_000, "ΔΣ ΣΑΣ", "a᠎b ​ ﻿"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(bpe.read_spec(PATH))


def test_like_the_library(library, own):
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("abc 'st\n<|>🙂é世́ \x1c1²") for _ in range(200)) for _ in range(200)]
    texts += ["".join(chr(r.randrange(0xD800)) for _ in range(40)) for _ in range(200)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    found = list(own(texts))
    assert [i.tolist() for i in found] == want
    assert [bpe.decoded(own.vocabulary, i).decode() for i in found] == [
        library.decode(i, skip_special_tokens=False) for i in want]


def test_merging_all_at_once_and_by_heap_agree(own):
    r = random.Random(2)
    words = ["".join(r.choice("theration s") for _ in range(r.randrange(1, 40))).encode() for _ in range(500)]
    for word, ids in zip(words, own.vocabulary.merged(words), strict=True):
        assert ids.tolist() == own.vocabulary._merged_by_heap(word).tolist()


def test_compatible_pairs_are_those_that_encode_to_themselves(own):
    v = own.vocabulary
    r = np.random.default_rng(3)
    a, b = r.integers(0, 3000, 3000), r.integers(0, 3000, 3000)
    whole = [v.merged([v.bytes[t]])[0].tolist() == [t] for t in range(3000)]
    for x, y, fits in zip(a.tolist(), b.tolist(), v.compatible(a, b).tolist(), strict=True):
        if whole[x] and whole[y]:
            assert fits == (v.merged([v.bytes[x] + v.bytes[y]])[0].tolist() == [x, y])


def test_tokens_that_are_no_utf8_decode_with_replacement(library, own):
    ids = library.encode("🙂世", add_special_tokens=False).ids[:-1]
    assert bpe.decoded(own.vocabulary, np.array(ids)).decode() == library.decode(ids, skip_special_tokens=False)


def test_rows(spark, library):
    data = [(1, "one two", "x"), (2, None, "y"), (None, "", "z"), (1, "one two", "x")]
    df = spark.createDataFrame(data, "doc_id BIGINT, text STRING, ids STRING").selectExpr("*", "1 AS decoded", "2 AS key")
    found = bpe.round_trip(df, PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    ids = library.encode("one two", add_special_tokens=False).ids
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, ids, "one two"), (2, [], ""), (None, [], ""), (1, ids, "one two")], key=str)
    coded = bpe.encode(df, PATH)
    assert sorted((r.decoded for r in bpe.decode(coded, PATH).collect())) == ["", "", "one two", "one two"]
    assert bpe.round_trip(df.limit(0), PATH).collect() == []


def test_query(spark, sf, library):
    want = {}
    for d, t in brute.rows(sf, "SELECT doc_id, text FROM documents"):
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(text.encode()).hexdigest())
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op1_bpe(spark, sf).collect()}
    assert found == want
