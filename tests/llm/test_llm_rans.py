import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lexitally.llm import queries, rans, shared

PATH = public_tokenizers.path("word_bpe_49k.json")
SHAPE = "doc_id BIGINT, text STRING, ids STRING, key INT, start INT"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def coder(ids, bits=rans.BITS):
    return rans.Coder(rans.quantise(np.bincount(ids, minlength=1), bits), bits)


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 65_535, 65_536, 65_537, 200_000])
def test_frames(n):
    ids = np.minimum(np.random.default_rng(n).geometric(0.001, n) - 1, 49_000).astype(np.uint32)
    own = coder(ids)
    frame = own.encode(ids)
    assert (own.decode(frame) == ids).all()
    if n > 100_000:
        p = np.bincount(ids) / n
        entropy = -n * (p[p > 0] * np.log2(p[p > 0])).sum() / 8
        assert len(frame) < 1.05 * entropy + 10_000


def test_one_symbol_and_the_largest():
    ids = np.full(1000, 49_407, np.uint32)
    assert (coder(ids).decode(coder(ids).encode(ids)) == ids).all()


def test_damage_is_found():
    ids = np.arange(1000, dtype=np.uint32) % 50
    own = coder(ids)
    frame = bytearray(own.encode(ids))
    frame[-1] ^= 1
    with pytest.raises(ValueError):
        own.decode(bytes(frame))


def test_frequencies():
    freq = rans.quantise(np.array([0, 1, 10**15, 3]), 18)
    assert freq.sum() == 1 << 18 and freq[0] == 0 and (freq[1:] > 0).all()


def test_texts_like_the_library(library):
    texts = ["", " ", "Hello, WORLD!  it's\x0b1234", "İΣ é ́x \x1c\x1d\x85　y", "<|endoftext|> a<|startoftext|>b",
             "a" * 3000, "don't 'S 's", "🙂世界", "x" * 100 + " y" * 2_000_000]
    own = rans.WordEncoder(rans.read_spec(PATH))
    r = random.Random(9)
    texts += ["".join(r.choice("aBz'stm é\u00c9ß×½µ19!<|>\n\u0301ÿŸ") for _ in range(80)) for _ in range(300)]
    texts += [f"x{chr(c)}y {chr(c)}{chr(c)}'S" for c in range(0x300)]
    assert [i.tolist() for i in own(pa.array(texts))] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_files(spark, library, monkeypatch):
    rows = [(5, "five words are in here"), (1, None), (3, ""), (None, "no key"), (5, "again"), (5, "again"), (9, "long " * 50_000)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SHAPE)
    path = shared.new_path(spark, "coded")
    rans.write(df, path, PATH, end=1)
    found = sorted(rans.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, 1, 3, 5, 5, 5, 9]
    assert [r.start for r in found] == [sum(x.n_tokens for x in found[:i]) for i in range(len(found))]
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids + [1]
    assert sorted((str(r.doc_id), r.ids) for r in found) == sorted((str(d), ids(t)) for d, t in rows)
    assert all(r.n_tokens == len(r.ids) for r in found)
    sums = {(r.start, r.ids_crc32) for r in rans.checksums(spark, path).collect()}
    assert sums == {(r.start, brute.crc(r.ids)) for r in found}


def test_nothing(spark):
    path = shared.new_path(spark, "coded")
    rans.write(spark.createDataFrame([], SHAPE), path, PATH, end=1)
    assert rans.read(spark, path).collect() == []


def test_query(spark, sf, library):
    want, at = {}, 0
    for d, t in brute.rows(sf, "SELECT doc_id, text FROM documents ORDER BY doc_id"):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want[d] = (at, len(ids), brute.crc(ids))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op9_rans(spark, sf).collect()} == want
