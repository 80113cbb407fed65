"""Archives and coded files of more than one piece."""

import random

import brute
import numpy as np
import public_tokenizers

from lexitally.llm import rans, shared, warc


def test_pages_of_several_archives(spark):
    rng = random.Random(2)
    rows = [(i, f"http://a/{i}", "".join(rng.choices("abcdefgh <>", k=1 << 12)) * 150) for i in range(60)]
    rows += [(100 + i, "http://b/", rows[i][2]) for i in range(5)]
    path = shared.new_path(spark, "archives")
    warc.write(spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").coalesce(1), path)
    files = spark.read.format("binaryFile").load(path)
    assert files.count() > 1
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(spark, path).collect()}
    assert found == brute.archive([(i, h) for i, _, h in rows])


def test_documents_of_several_blocks_in_a_part(spark):
    # Three long documents in one part: its second block begins where the first one ends.
    rows = [(i, f"{word} " * 700_000) for i, word in enumerate(("cat", "dog", "house"))]
    path, before = shared.new_path(spark, "coded"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        rans.write(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    blocks = spark.read.parquet(f"{path}/blocks").orderBy("part", "block").collect()
    assert [(b.part, b.block, b.before, b.docs) for b in blocks] == [(0, 0, 0, [0, 1]), (0, 1, 1_400_002, [2])]
    found = sorted(map(tuple, rans.checksums(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    ids = [[r.ids[0]] * 700_000 + [1] for r in rans.read(spark, path).orderBy("doc_id").collect()]
    assert found == [(i, i * 700_001, 700_001, brute.crc(x)) for i, x in enumerate(ids)]


def test_one_segment_alone():
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.geometric(0.05, 3 * rans.LANES * rans.STEPS + 1234) - 1, 99)
    coder = rans.Coder(rans.quantise(np.bincount(ids, minlength=100), rans.BITS), rans.BITS)
    frame = coder.encode(ids)
    size = rans.LANES * rans.STEPS
    for i in (3, 0, 2):
        assert (coder.segment(frame, i) == ids[i * size:(i + 1) * size]).all()
    assert (np.concatenate([coder.segment(frame, i) for i in range(4)]) == coder.decode(frame)).all()
