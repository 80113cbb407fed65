"""One query per operator, with its production parameters, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from . import ann, bpe, htmltext, impact, langid, linededup, merkle, minhash, packing, prefixtrie, rankbpe, rans, warc
from .shared import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.round_trip(table(spark, sf, "documents"), path))


def op2_ann(spark, sf):
    return ann.nearest(table(spark, sf, "embeddings"), F.col("id") % 20 == 0)


def op3_warc(spark, sf):
    path = new_path(spark, "archives")
    warc.write(table(spark, sf, "pages"), path)
    return warc.read(spark, path).drop("url")


def op4_htmltext(spark, sf):
    return htmltext.main_text(table(spark, sf, "pages"))


def op5_packing(spark, sf):
    docs = packing.near_copies(table(spark, sf, "documents"), "doc_id", "text", "source")
    return packing.pack(docs, "doc_id", F.col("size"), F.col("source"), F.col("cluster"))


def op6_langid(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out("doc_id")))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op7_impact(spark, sf):
    return impact.top(table(spark, sf, "embeddings"), F.col("id") % 20 == 0)


def op8_linededup(spark, sf):
    found = linededup.line_report(table(spark, sf, "documents"))
    return found.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op9_rans(spark, sf):
    path = new_path(spark, "coded")
    rans.write(table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return rans.checksums(spark, path)


def op10_minhash(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op11_rankbpe(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return rankbpe.digests(rankbpe.round_trip(table(spark, sf, "documents"), path, public_tokenizers.PATTERN))


def op12_prefixtrie(spark, sf):
    conv = F.col("conv_id")
    own = prefixtrie.paths(table(spark, sf, "conversations"))
    taken = F.crc32(conv.cast("string")) % 6
    found = prefixtrie.with_heads(own, conv - conv % 100, taken)
    return prefixtrie.trie(found)


def op13_merkle(spark, sf):
    docs = table(spark, sf, "documents")
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    bare = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    values = ["doc_id", "source", "lang", "n_chars"]
    return merkle.manifest(docs, "doc_id", "source", [*values, "text"], [*values, bare])


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_bpe, op2_ann, op3_warc, op4_htmltext, op5_packing, op6_langid, op7_impact, op8_linededup,
    op9_rans, op10_minhash, op11_rankbpe, op12_prefixtrie, op13_merkle,
)}
