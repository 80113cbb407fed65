"""Byte-level BPE from a file of ranks, with a rank queue in a hierarchical bitmap.

The bytes of the pre-tokens to be merged are a linked list. Every pair of neighbours that makes up a
token waits in the bucket of its rank; a bitmap of the buckets that hold anything, with a bitmap of
its words above it, gives the next rank by find-first-set, and its bucket is emptied from the left. A
merge only files the two pairs it makes; those it breaks stay where they are and are skipped as stale.
Nothing is scanned again, so a pre-token of n bytes takes about n log n steps, however long it is; and
since no pair spans two pre-tokens, any number of them share one list and one queue.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import insort
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import neg

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .bpe import Known, read_spec
from .shared import portions

WORD = 256            # bits of a word of the bitmap
WORDS = 800_000       # pre-tokens a worker remembers before it starts anew
CHUNKS = 200_000      # the same for what stands between single spaces, which is cheaper to learn again
LONG = 1 << 22        # bytes to be merged that are better kept small
PIECE = 1 << 20       # bytes of text worked on at once, one text at least

# A space between two other characters begins a pre-token whatever surrounds them.
_CUT = re.compile(r"(?<=\S) (?=\S)")

# Where the classes of characters have been the same for many versions of Unicode.
_SETTLED = 0x250


class RankQueue:
    """Places filed by rank, and a bitmap of the ranks that have any."""

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.levels = [[0] * -(-ranks // WORD)]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * -(-len(self.levels[-1]) // WORD))

    def fill(self, ranks: np.ndarray) -> None:
        """File the places 0, 1, ... by their ranks, all at once; below 0 is no rank."""
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0):]
        found, first = np.unique(ranks[order], return_index=True)
        for rank, places in zip(found.tolist(), np.split(order, first[1:]), strict=False):
            self.mark(rank)
            self.buckets[rank] = places.tolist()

    def mark(self, rank: int) -> None:
        for level in self.levels:
            rank, bit = divmod(rank, WORD)
            level[rank] |= 1 << bit

    def first(self, limit: int) -> int:
        """The least rank that has places, `limit` if none below it has."""
        rank = 0
        for level in reversed(self.levels):
            held = level[rank]
            if not held:
                return limit
            rank = rank * WORD + (held & -held).bit_length() - 1
        return min(rank, limit)

    def take(self, rank: int) -> list[int]:
        """The places of a rank, the least last; they leave the queue."""
        places, self.buckets[rank] = self.buckets[rank], []
        places.sort(reverse=True)
        for level in self.levels:
            rank, bit = divmod(rank, WORD)
            level[rank] &= ~(1 << bit)
            if level[rank]:
                break
        return places


class Classes:
    """Pre-tokens cut as the tiktoken library cuts them.

    The pattern is matched by another engine, whose tables of letters and digits may be of another
    version of Unicode. A character that could differ is looked up in the library once, and stood in
    for by one of its class where the two disagree.
    """

    STANDING = {(True, False): "ª", (False, True): "²", (False, False): "¬"}  # a letter, a digit, neither

    def __init__(self, pattern: str):
        self.pattern = regex.compile(pattern)
        self.letter, self.digit = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
        self.asked: set[str] = set()
        self.instead: dict[int, str] = {}

    def _ask(self, chars: list[str]) -> None:
        import tiktoken

        pairs = [("A" + c).encode() for c in chars]
        ranks = {bytes([i]): i for i in range(256)} | {p: 256 + i for i, p in enumerate(pairs)}
        found = []
        for kind in (r"\p{L}+|\P{L}+", r"[A\p{N}]+|[^A\p{N}]+"):
            # A pre-token that is a token is not cut, so a pair of one class is one token.
            library = tiktoken.Encoding("classes", pat_str=kind, mergeable_ranks=ranks, special_tokens={})
            found.append([len(library.encode_ordinary("A" + c)) == 1 for c in chars])
        for c, letter, digit in zip(chars, *found, strict=True):
            if (letter, digit) != (bool(self.letter.match(c)), bool(self.digit.match(c))):
                self.instead[ord(c)] = self.STANDING[letter, digit]

    def look_at(self, texts: list[str]) -> None:
        """Ask about the characters of texts that are about to be cut."""
        met = set().union(*[t for t in texts if not t.isascii()]) - self.asked
        if new := [c for c in met if ord(c) >= _SETTLED and not c.isspace()]:
            self._ask(new)
        self.asked |= met

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text that has been looked at."""
        if not self.instead:
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.instead))]


class Encoder:
    """Encodes texts, remembering the pre-tokens, and the chunks between single spaces, it has met."""

    def __init__(self, ranks: str, pattern: str):
        rows = [line.split() for line in ranks.splitlines() if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in rows}
        size = max(self.ranks.values()) + 1
        self.longest = max(map(len, self.ranks))
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        self.double = np.array([self.ranks.get(bytes([i, j]), -1) for i in range(256) for j in range(256)], np.int64)
        self.queue = RankQueue(size)
        self.classes = Classes(pattern)
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank] = token
        self.length = np.array(list(map(len, by_id)), np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.words, self.chunks = Known(), Known()

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens in a row, and how many each has: always the pair of least rank,
        the first of equals. No pre-token is empty."""
        ranks, queue, longest = self.ranks.get, self.queue, self.longest
        buckets, mark = queue.buckets, queue.mark
        line = b"\0".join(words) + b"\0"  # one place between two, which no pair may span
        code = np.frombuffer(line, np.uint8).astype(np.int64)
        n = len(code)
        borders = np.cumsum([len(w) + 1 for w in words]) - 1
        first = np.append(0, borders[:-1] + 1)

        pair = np.append(self.double[code[:-1] * 256 + code[1:]], -1)
        pair[borders] = pair[borders - 1] = -1
        queue.fill(pair)
        link = np.arange(1, n + 1)
        link[borders] = n + 2 * longest + 1  # too far off to make a token with
        back = np.arange(-1, n - 1)
        back[first] = -1
        # Lists are quicker, arrays smaller.
        held = (pair, link, back, self.single[code])
        filed, after, before, ids = (x.tolist() if n < LONG else array("q", x.tobytes()) for x in held)
        alive = bytearray(b"\1") * n
        for i in borders.tolist():
            alive[i] = 0

        def empty(limit: int) -> None:
            """Merge until no rank below `limit` has places."""
            while (rank := queue.first(limit)) < limit:
                places = queue.take(rank)
                while places:
                    i = places.pop()
                    if filed[i] != rank:
                        continue
                    j = after[i]
                    k = after[i] = after[j]
                    before[k] = i
                    ids[i] = rank
                    filed[j], alive[j] = -1, 0
                    least = rank
                    end = after[k]
                    found = filed[i] = ranks(line[i:end], -1) if end - i <= longest else -1
                    if found >= 0:
                        bucket = buckets[found]
                        if not bucket:
                            mark(found)
                        bucket.append(i)
                        if found < least:
                            least = found
                    h = before[i]
                    if h >= 0:
                        found = filed[h] = ranks(line[h:k], -1) if k - h <= longest else -1
                        if found >= 0:
                            bucket = buckets[found]
                            if not bucket:
                                mark(found)
                            bucket.append(h)
                            if found < least:
                                least = found
                    if least < rank:
                        # A pair now comes before the rest of this bucket, which may grow meanwhile.
                        empty(rank)
                        if buckets[rank]:
                            for place in queue.take(rank):
                                insort(places, place, key=neg)

        empty(len(buckets))
        kept = np.frombuffer(alive, bool)
        return np.array(ids, np.int64)[kept], np.add.reduceat(kept, first, dtype=np.int64)

    def _learn_words(self, words: list[str]) -> None:
        new = list({w for w in words if w not in self.words.code})
        raw = [w.encode() for w in new]
        whole = [self.ranks.get(r, -1) for r in raw]
        kept = [w for w, i in zip(new, whole, strict=True) if i >= 0]
        if kept:
            self.words.add(kept, np.array([i for i in whole if i >= 0], np.int32), np.ones(len(kept), np.int64))
        if len(kept) < len(new):
            rest = [i for i, rank in enumerate(whole) if rank < 0]
            self.words.add([new[i] for i in rest], *self.merged([raw[i] for i in rest]))

    def _learn(self, chunks: list[str]) -> None:
        new = [c for c in set(chunks) if c not in self.chunks.code]
        if not new:
            return
        # In a line of chunks that hold no white space but the space before them, words that begin
        # with a space begin one; all others are cut alone.
        plain = [c for c in new if c[:1] == " " and not c[1:2].isspace() and not c[-1].isspace() and len(c.split()) == 1]
        words = self.classes.cut("".join(plain))
        count = np.diff(np.flatnonzero(np.fromiter([w[0] == " " for w in words], bool, len(words))), append=len(words))
        if len(plain) < len(new):
            known = set(plain)
            rest = [c for c in new if c not in known]
            cut = list(map(self.classes.cut, rest))
            plain += rest
            words += chain.from_iterable(cut)
            count = np.append(count, list(map(len, cut)))
        self._learn_words(words)
        codes = self.words.codes(words)
        ends = np.concatenate([[0], np.cumsum(self.words.count[codes])])[np.append(0, np.cumsum(count))]
        self.chunks.add(plain, self.words.ids(codes), np.diff(ends))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        if len(self.words.code) > WORDS:
            self.words = Known()
        if len(self.chunks.code) > CHUNKS:
            self.chunks = Known()
        self.classes.look_at(texts)
        cut = [_CUT.sub("\0 ", t).split("\0") if "\0" not in t else [t] for t in texts]
        chunks = list(chain.from_iterable(cut))
        self._learn(chunks)
        codes = self.chunks.codes(chunks)
        ends = np.concatenate([[0], np.cumsum(self.chunks.count[codes])])[np.cumsum([0, *map(len, cut)])]
        return self.chunks.ids(codes), np.diff(ends)

    def decode(self, ids: np.ndarray) -> bytes:
        count = self.length[ids]
        into = np.repeat(self.offset[ids] - np.cumsum(count) + count, count)
        return self.flat[into + np.arange(len(into))].tobytes()


@lru_cache(2)
def _encoder(ranks: str, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def _listed(ids: np.ndarray, count: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: the token ids of each text by the ranks in the file `path`, each match of `pattern`
    on its own.

    A row for each row, repeated ones and null keys too. A null text is the empty one, whose ids are
    none; empty in, empty out. Other columns are not read, whatever they are called. Of texts however
    long one is held at a time, with about 50 bytes for each byte that is to be merged.
    """
    return _coded(df, path, pattern, key, text, False)


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, decoded: `encode`, and the bytes decoded from those ids, in one pass."""
    return _coded(df, path, pattern, key, text, True)


def _coded(df: DataFrame, path: str, pattern: str, key: str, text: str, back: bool) -> DataFrame:
    ranks = read_spec(path)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(ranks, pattern)
        for batch in batches:
            for some in portions(batch, 1, PIECE):
                ids, count = own([t or "" for t in some.column(1).to_pylist()])
                columns = [some.column(0), _listed(ids, count)]
                if back:
                    columns.append(_cut_up(own.decode(ids), np.add.reduceat(
                        np.append(own.length[ids], 0), np.cumsum(count) - count) * (count > 0)))
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][:len(columns)])

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, ids array<int>" + ", decoded binary" * back
    return shared.arrow(df.select(key, text), step, schema).withColumnRenamed("key", key)


def _cut_up(raw: bytes, length: np.ndarray) -> pa.Array:
    """The values of these lengths that make up `raw`."""
    ends = np.cumsum(length).tolist()
    return pa.array([raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], pa.binary())


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`df` and the bytes of each id array; null ids are none. Ids that the file does not have fail."""
    ranks = read_spec(path)
    place = df.columns.index(ids)

    def step(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(ranks, pattern)
        for batch in batches:
            held = batch.column(place)
            raw = [own.decode(np.array(i.as_py() or [], np.int64) if not i.is_valid else i.values.to_numpy())
                   for i in held]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, into])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return shared.arrow(df, step, f"{fields}, {into} binary")


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of `round_trip`."""
    listed = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        key, F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
