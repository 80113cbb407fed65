"""Token ids in files, coded by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves every block. A block holds whole documents
in ascending order and is coded on its own: its ids are dealt to segments of LANES x STEPS, each
lane keeps a coder state of 64 bits, and the words the lanes emit are interleaved in one stream
for each segment. A checkpoint (place in the stream and all lane states) opens every segment, so
segments decode side by side, or alone. Checksums cover the coded bytes and the ids.

On disk: `table/` (id, freq; they add up to 2^BITS) and `blocks/`, Parquet files of rows
(part, block, before, docs, lengths, frame). `part` ascends with the documents, `before` counts
the ids of the blocks before in the same part.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared
from .bpe import Known, read_spec
from .shared import portions

LANES, STEPS = 256, 256
BLOCK = 1 << 20       # ids at least in a block, unless its part ends
BITS = 18             # the frequencies add up to 2^18, or more for very large vocabularies
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LINE = 256            # words that the library is given in a line
END_OF_WORD = "</w>"  # fixed value: what the tokenizer marks a word's last token with
PIECE = 4 << 20       # bytes of text worked on at once, one text at least
REMEMBERED = 500_000  # words a worker remembers before it starts anew

_HEADER = struct.Struct("<4sBBHIIQII")  # magic, version, bits, lanes, steps, segments, ids, crcs
_MAGIC = b"RANS"
# What is not cut here, and the tokenizer's pattern on the rest in lower case.
_ODD = r"[^\t\n\r -~À-ÿ]|<\|"
_ONE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]")
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+"


# --- token ids --------------------------------------------------------------------------------

class WordEncoder:
    """The tokenizers library, asked once for each word.

    For the tokenizer of `word_bpe_49k.json`: it drops white space, so no token and no normalisation
    spans it, and cuts the rest by the pattern below, in lower case. Texts of ASCII and of the
    letters of Latin-1 are cut here; in others, and near its special tokens, the library itself
    cuts what stands between ASCII white space.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has given every core a task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        vocabulary = self.library.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith(END_OF_WORD)]] = True
        self.words = Known()

    def _learn(self, words: list[str]) -> None:
        ids = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        self.words.add(words, np.fromiter(chain.from_iterable(ids), np.int32), np.array(list(map(len, ids)), np.int64))

    def _learn_lines(self, words: list[str]) -> None:
        """The same for words of one piece each, many in a line: a word's last token says so."""
        lines = [" ".join(words[i:i + LINE]) for i in range(0, len(words), LINE)]
        for i, found in enumerate(self.library.encode_batch_fast(lines, add_special_tokens=False)):
            part, ids = words[i * LINE:(i + 1) * LINE], np.array(found.ids, np.int32)
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) == len(part):
                self.words.add(part, ids, np.diff(ends, prepend=0))
            else:
                self._learn(part)

    def _codes(self, words: pa.StringArray) -> np.ndarray:
        """Codes of words in `self.words`, new ones learned."""
        found = words.dictionary_encode()
        distinct = found.dictionary.to_pylist()
        if len(self.words.code) > REMEMBERED:
            self.words = Known()
        new = [w for w in distinct if w not in self.words.code]
        alone = list(filter(_ONE.fullmatch, new))
        self._learn_lines(alone)
        if len(alone) < len(new):
            self._learn([w for w in new if not _ONE.fullmatch(w)])
        return self.words.codes(distinct)[found.indices.to_numpy()]

    def __call__(self, texts: pa.StringArray) -> Iterator[np.ndarray]:
        """The ids of each text; none for null."""
        plain = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False) != True  # noqa: E712
        spaced = pc.replace_substring_regex(pc.utf8_lower(texts), _WORDS, r"\0 ")
        cut = pc.ascii_split_whitespace(pc.fill_null(pc.if_else(pa.array(plain), spaced, texts), ""))
        codes = self._codes(cut.flatten())
        count = np.concatenate([[0], np.cumsum(self.words.count[codes])])
        ids = self.words.ids(codes)
        ends = count[cut.offsets.to_numpy() - cut.offsets[0].as_py()]
        for a, b in zip(ends, ends[1:], strict=False):
            yield ids[a:b]


@lru_cache(2)
def _encoder(spec: str) -> WordEncoder:
    return WordEncoder(spec)


def token_ids(df: DataFrame, path: str, end: int, key: str, text: str) -> DataFrame:
    """key, ids (binary, little-endian, of the width of `_kind`): the ids of each text and the end id."""
    spec = read_spec(path)
    kind_ = _kind(spec, end)

    def step(batches):
        own = _encoder(spec)
        for batch in batches:
            for some in portions(batch, 1, PIECE):
                ids = [np.append(i, end).astype(kind_).tobytes() for i in own(some.column(1))]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(ids, pa.binary())], ["key", "ids"])

    kind = df.schema[key].dataType.simpleString()
    return shared.arrow(df.select(key, text), step, f"key {kind}, ids binary")


def _kind(spec: str, end: int) -> str:
    """Type in which ids are kept on their way to the files."""
    made = json.loads(spec)
    most = max([end, *made["model"]["vocab"].values(), *(t["id"] for t in made["added_tokens"])])
    return "<u2" if most < 1 << 16 else "<u4"


# --- the coder --------------------------------------------------------------------------------

def quantise(count: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies that add up to 2^bits, at least 1 for every id that occurs."""
    present = count > 0
    if not present.any():
        return np.zeros(len(count), np.int64)
    spare = (1 << bits) - int(present.sum())
    freq = present + (count.astype(object) * spare // int(count.sum())).astype(np.int64)
    freq[np.argmax(freq)] += (1 << bits) - int(freq.sum())
    return freq


class Coder:
    def __init__(self, freq: np.ndarray, bits: int):
        self.bits = np.uint64(bits)
        # One symbol more, which fills the range and so changes no state: padding.
        self.freq = np.append(freq, 1 << bits).astype(np.uint64)
        self.base = np.append(np.cumsum(freq) - freq, 0).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        """One frame."""
        n = len(ids)
        segments = max(1, -(-n // (LANES * STEPS)))
        steps = STEPS if segments > 1 else max(1, -(-n // LANES))
        padded = np.full(segments * LANES * steps, len(self.freq) - 1, np.int64)
        padded[:n] = ids
        grid = padded.reshape(segments, steps, LANES)
        state = np.full((segments, LANES), LOW, np.uint64)
        shift = np.uint64(63) - self.bits
        words, owners = [], []
        for t in range(steps - 1, -1, -1):
            s = grid[:, t]
            f = self.freq[s]
            full = state >= (f << shift)
            words.append(state[full].astype(np.uint32))
            owners.append(full.sum(1))
            state[full] >>= WORD
            q = state // f
            state = (q << self.bits) + (state - q * f) + self.base[s]
        # Streams hold the words of the first step first.
        count = np.array(owners[::-1], np.int64).reshape(steps, segments)
        owner = np.repeat(np.tile(np.arange(segments), steps), count.ravel())
        stream = np.concatenate(words[::-1])[np.argsort(owner, kind="stable")]
        place = np.cumsum(count.sum(0)) - count.sum(0)
        body = place.astype("<u8").tobytes() + state.astype("<u8").tobytes() + stream.astype("<u4").tobytes()
        head = _HEADER.pack(_MAGIC, 1, int(self.bits), LANES, steps, segments, n,
                            zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body))
        return head + body

    def decode(self, frame: bytes) -> np.ndarray:
        """The ids of one frame; raises ValueError if a checksum is wrong."""
        magic, version, bits, lanes, steps, segments, n, ids_crc, body_crc = _HEADER.unpack_from(frame)
        body = memoryview(frame)[_HEADER.size:]
        if magic != _MAGIC or version != 1 or bits != self.bits or zlib.crc32(body) != body_crc:
            raise ValueError("damaged block")
        place = np.frombuffer(body, "<u8", segments).astype(np.int64)
        state = np.frombuffer(body, "<u8", segments * lanes, 8 * segments).reshape(segments, lanes).copy()
        stream = np.frombuffer(body, "<u4", -1, 8 * segments * (1 + lanes))
        out = np.zeros((segments, steps, lanes), np.uint32)
        mask = np.uint64((1 << bits) - 1)
        index = (np.arange(segments) * steps * lanes)[:, None] + np.arange(lanes)
        for t in range(steps):
            slot = state & mask
            s = self.symbol[slot]
            moved = self.freq[s] * (state >> self.bits) + slot - self.base[s]
            if index[-1, -1] + t * lanes >= n:
                live = index + t * lanes < n
                s, moved = np.where(live, s, 0), np.where(live, moved, state)
            out[:, t] = s
            state = moved
            short = state < LOW
            taken = np.cumsum(short, 1)
            at = (place[:, None] + taken - 1)[short]
            state[short] = (state[short] << WORD) | stream[at].astype(np.uint64)
            place += taken[:, -1]
        ids = out.reshape(-1)[:n]
        if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
            raise ValueError("damaged ids")
        return ids


    def segment(self, frame: bytes, number: int) -> np.ndarray:
        """The ids of one segment of a frame, from its checkpoint on; nothing else of the frame is
        decoded, so the checksums, which cover all of it, are not asked."""
        magic, version, bits, lanes, steps, segments, n, _, _ = _HEADER.unpack_from(frame)
        if magic != _MAGIC or version != 1 or bits != self.bits or not 0 <= number < segments:
            raise ValueError("no such segment")
        at = _HEADER.size
        place = int(np.frombuffer(frame, "<u8", 1, at + 8 * number)[0])
        state = np.frombuffer(frame, "<u8", lanes, at + 8 * (segments + number * lanes)).copy()
        stream = np.frombuffer(frame, "<u4", -1, at + 8 * segments * (1 + lanes))
        size = min(steps * lanes, n - number * steps * lanes)
        out = np.zeros((steps, lanes), np.uint32)
        mask = np.uint64((1 << bits) - 1)
        for t in range(-(-size // lanes)):
            live = np.arange(t * lanes, (t + 1) * lanes) < size
            slot = state & mask
            s = self.symbol[slot]
            out[t] = s
            state = np.where(live, self.freq[s] * (state >> self.bits) + slot - self.base[s], state)
            short = np.flatnonzero(state < LOW)
            state[short] = (state[short] << WORD) | stream[place:place + len(short)].astype(np.uint64)
            place += len(short)
        return out.reshape(-1)[:size]


# --- files ------------------------------------------------------------------------------------

def _counts(ids: DataFrame, kind: str) -> DataFrame:
    """id, n over all documents; a task sends a row for each id it met."""
    def step(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in batch.column(0):
                found = np.bincount(np.frombuffer(part.as_py(), kind))
                if len(found) > len(total):
                    total = np.concatenate([total, np.zeros(len(found) - len(total), np.int64)])
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = shared.arrow(ids.select("ids"), step, "id bigint, n bigint")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def _frequencies(count: list) -> tuple[np.ndarray, int]:
    size = max((r.id for r in count), default=0) + 1
    bits = max(BITS, int(size).bit_length() + 2)
    found = np.zeros(size, np.int64)
    for r in count:
        found[r.id] = r.n
    return quantise(found, bits), bits


def write(df: DataFrame, path: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode the texts of `df` and write them below `path`, in ascending order of `key`.

    A null text is the empty one, of which the end id remains. Null keys come first, rows with
    the same key in the order of a hash of their ids; all rows are written. No rows: no blocks. A
    document's ids are one value, however long, and never cut between blocks; other columns are not read.
    The counts on the driver are as many as the vocabulary has ids at most.
    """
    spark = df.sparkSession
    ids = shared.settle(token_ids(df, tokenizer, end, key, text).withColumn("tie", F.xxhash64("ids")), "token-ids")
    freq, bits = _frequencies(_counts(ids, kind_ := _kind(read_spec(tokenizer), end)).collect())
    rows = [(int(i), int(freq[i]), bits) for i in np.flatnonzero(freq)]
    spark.createDataFrame(rows, "id bigint, freq bigint, bits int").coalesce(1).write.parquet(f"{path}/table")

    def step(batches):
        coder = Coder(freq, bits)
        part, block, before = TaskContext.get().partitionId(), 0, 0
        keys, texts, size = [], [], 0

        def frame():
            whole = np.frombuffer(b"".join(texts), kind_)
            lengths = [len(t) // whole.itemsize for t in texts]
            values = [[part], [block], [before], [keys], [lengths], [coder.encode(whole)]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names)

        kinds = names = None
        for batch in batches:
            if kinds is None:
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(batch.schema.field(0).type),
                         pa.list_(pa.int64()), pa.binary()]
                names = ["part", "block", "before", "docs", "lengths", "frame"]
            for own, raw in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(own.as_py())
                texts.append(raw.as_py())
                size += len(texts[-1]) // np.dtype(kind_).itemsize
                if size >= BLOCK:
                    yield frame()
                    block, before = block + 1, before + size
                    keys, texts, size = [], [], 0
        if keys:
            yield frame()

    kind = ids.schema["key"].dataType.simpleString()
    schema = (f"part int, block int, before bigint, docs array<{kind}>, lengths array<bigint>, frame binary")
    ordered = ids.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "ids")
    shared.arrow(ordered, step, schema).write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _documents(coder: Coder, batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each block: keys, starts, lengths and all ids."""
    for base, docs, lengths, frame in zip(*(batch.column(i) for i in range(4)), strict=True):
        length = np.array(lengths.as_py(), np.int64)
        yield docs.as_py(), base.as_py() + np.cumsum(length) - length, length, coder.decode(frame.as_py())


def _read(spark: SparkSession, path: str, values, column: str, key: str) -> DataFrame:
    """`values` turns the ids of a block and the documents' ends into the column."""
    found = spark.read.parquet(f"{path}/table").collect()
    bits = found[0].bits if found else BITS
    freq = np.zeros(max((r.id for r in found), default=0) + 1, np.int64)
    for r in found:
        freq[r.id] = r.freq
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row for each part, of which there are as many as tasks wrote.
    parts = blocks.groupBy("part").agg((F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b))).alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    placed = blocks.join(F.broadcast(bases), "part").select(
        (F.col("base") + F.col("before")).alias("base"), "docs", "lengths", "frame")

    def step(batches):
        coder = Coder(freq, bits)
        for batch in batches:
            kind = batch.schema.field(1).type.value_type
            for docs, starts, length, ids in _documents(coder, batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, kind), pa.array(starts), pa.array(length), values(ids, np.cumsum(length))],
                    ["key", "start", "n_tokens", "value"])

    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    shape = f"key {kind}, start bigint, n_tokens bigint, value {column}"
    return shared.arrow(placed, step, shape).withColumnRenamed("key", key)


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids of every document; `start` counts the ids of all before it."""
    def values(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))

    return _read(spark, path, values, "array<int>", key).withColumnRenamed("value", "ids")


def checksums(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids_crc32: the same from the files, the ids as their checksum."""
    def values(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        raw = memoryview(ids.astype("<u4").tobytes())
        cuts = [0, *(4 * ends).tolist()]
        return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64())

    return _read(spark, path, values, "bigint", key).withColumnRenamed("value", "ids_crc32")
