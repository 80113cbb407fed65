"""Byte-level BPE by speculation and verification.

A greedy longest match proposes the tokens of every distinct word at once. A proposal is the
word's encoding exactly if no merge across any adjacent pair of its tokens would have come first,
which is checked for all pairs together in numpy. Only words with a failing pair are merged one
merge at a time. Tokens that do not encode to themselves are never proposed.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

# The word pattern of byte-level BPE.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Characters whose classes are the same in every Unicode version that could be installed. A text
# with any other character is cut into words by the tokenizers library itself.
_UNSETTLED = re.compile("[^\x00-ɏ‐-‧‰-⁞]")

# A place where a text may be cut without cutting or joining words.
_CUT = re.compile(r"(?<=\S) (?=\S)")

# A space with another white space, or an end of the text, at its side.
_UNEVEN = re.compile(r" (?!\S)|\s ")

NEVER = np.int64(1) << 40
PIECE = 1 << 20       # characters worked on at once
REMEMBERED = 500_000  # words and chunks a worker remembers before it starts anew


def byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte: itself where Latin-1 prints it, else the next
    character from U+0100 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and the checks between them, from the JSON of a tokenizer."""

    def __init__(self, spec: str):
        made = json.loads(spec)
        model, to_byte = made["model"], byte_of_char()
        raw = {i: bytes(to_byte[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in made["added_tokens"]}
        size = max([*raw, *self.special.values()]) + 1
        self.size = size
        self.bytes = [raw.get(i, b"") for i in range(size)]
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)

        ids = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            whole = ids[a + b]
            self.merge[ids[a], ids[b]] = (rank, whole)
            self.rank[whole], self.left[whole], self.right[whole] = rank, ids[a], ids[b]
        self.whole = np.array([w for _, w in self.merge.values()], np.int64)
        self._index_pairs(np.array([a * size + b for a, b in self.merge], np.int64))
        self.single = np.zeros(256, np.int64)
        for i, b in raw.items():
            if len(b) == 1:
                self.single[b[0]] = i

        made_ids = np.flatnonzero(self.rank >= 0)
        itself = np.ones(size, bool)
        itself[made_ids] = self.compatible(
            self.left[made_ids], self.right[made_ids], self.rank[made_ids])
        for i in made_ids[np.argsort(self.rank[made_ids])]:
            itself[i] &= itself[self.left[i]] and itself[self.right[i]]
        self.matcher = ahocorasick.Automaton()
        for i, b in raw.items():
            if itself[i]:
                self.matcher.add_word(b.decode("latin-1"), i)
        self.matcher.make_automaton()

    def _index_pairs(self, pairs: np.ndarray) -> None:
        """Ranks by a slot of the pair's hash; pairs that share a slot go to a sorted list."""
        slot = self._slot(pairs)
        self.slot_pair = np.full(1 << 19, -1, np.int64)
        self.slot_rank = np.full(1 << 19, NEVER)
        self.slot_pair[slot] = pairs
        self.slot_rank[slot] = np.arange(len(pairs))
        lost = np.flatnonzero(self.slot_pair[slot] != pairs)
        self.crowded = np.zeros(1 << 19, bool)
        self.crowded[slot[lost]] = True
        lost = lost[np.argsort(pairs[lost])]
        self.rest_pair = np.append(pairs[lost], np.iinfo(np.int64).max)
        self.rest_rank = np.append(lost, NEVER)

    @staticmethod
    def _slot(pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(45)).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each a with its b, NEVER where there is none."""
        pair = a * self.size + b
        slot = self._slot(pair)
        found = np.where(self.slot_pair[slot] == pair, self.slot_rank[slot], NEVER)
        if len(more := np.flatnonzero(self.crowded[slot] & (found == NEVER))):
            i = np.searchsorted(self.rest_pair, pair[more])
            found[more] = np.where(self.rest_pair[i] == pair[more], self.rest_rank[i], NEVER)
        return found

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b can end up side by side: going back through the merges that
        made them, the latest first, no pair across their border may merge before `limit`, the
        merge undone last. Of two equal merges the left one comes first."""
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NEVER) if limit is None else limit.copy()
        good = np.ones(len(a), bool)
        at = np.arange(len(a))
        while len(at):
            clash = self.ranks(a, b) < limit
            good[at[clash]] = False
            ra, rb = self.rank[a], self.rank[b]
            on = ~clash & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)[on]
            a, b = np.where(undo_a, self.right[a], a)[on], np.where(undo_a, b, self.left[b])[on]
            at = at[on]
        return good

    def merged(self, words: list[bytes]) -> list[np.ndarray]:
        """Exact encoding: always the earliest merge, the leftmost of equals. One merge in each
        unfinished word a round; the rare long words go their own way."""
        out: list[np.ndarray] = [self._merged_by_heap(w) if len(w) > 64 else None for w in words]
        short = [i for i, w in enumerate(words) if len(w) <= 64]
        ids = self.single[np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
        word = np.repeat(short, [len(words[i]) for i in short])
        rank = self._neighbours(ids, word, np.arange(len(ids)))
        while len(ids):
            start = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, start), np.diff(start, append=len(ids)))
            done = best == NEVER
            if done.any():
                ended = ids[done]
                of, first = np.unique(word[done], return_index=True)
                for w, part in zip(of.tolist(), np.split(ended, first[1:]), strict=True):
                    out[w] = part
                ids, word, rank, best = ids[~done], word[~done], rank[~done], best[~done]
            at = np.flatnonzero(rank == best)
            at = at[np.diff(word[at], prepend=-1) != 0]
            ids[at] = self.whole[rank[at]]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, word, rank = ids[kept], word[kept], rank[kept]
            at -= np.arange(len(at))
            rank[at] = self._neighbours(ids, word, at)
            at = at[at > 0] - 1
            rank[at] = self._neighbours(ids, word, at)
        return out

    def _neighbours(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the places `at`, NEVER at the ends of words."""
        after = np.minimum(at + 1, max(len(ids) - 1, 0))
        inside = (after > at) & (word[after] == word[at])
        return np.where(inside, self.ranks(ids[at], ids[after]), NEVER)

    def _merged_by_heap(self, text: bytes) -> np.ndarray:
        """The same for one word, in n log n steps."""
        ids = self.single[np.frombuffer(text, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := self.merge.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = whole, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([i for i in ids if i >= 0], np.int64)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in a row, and how many each word has."""
        # Latin-1 shows each byte as one character; U+0100 stands between words.
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths + 1) - lengths - 1
        line = "Ā".join([w.decode("latin-1") for w in words])
        found = np.array(list(self.matcher.iter_long(line)), np.int64).reshape(-1, 2)
        end, ids = found[:, 0] + 1, found[:, 1]
        begin = end - self.length[ids]
        word = np.searchsorted(starts, begin, "right") - 1
        count = np.bincount(word, minlength=len(words))
        covered = np.bincount(word, self.length[ids], len(words)).astype(np.int64) == lengths

        inner = np.flatnonzero(word[1:] == word[:-1])
        code, back = np.unique(ids[inner] * self.size + ids[inner + 1], return_inverse=True)
        fits = self.compatible(code // self.size, code % self.size)[back]
        sound = covered.copy()
        sound[word[inner[~fits]]] = False
        wrong = np.flatnonzero(~sound)
        if not len(wrong):
            return ids, count
        parts, at = [], 0
        first = np.concatenate([[0], np.cumsum(count)])
        wrong = wrong.tolist()
        for w, exact in zip(wrong, self.merged([words[w] for w in wrong]), strict=True):
            parts += [ids[at:first[w]], exact]
            at = first[w + 1]
            count[w] = len(exact)
        return np.concatenate([*parts, ids[at:]]), count


class Known:
    """Keys with their token ids, the ids of all keys in one array."""

    def __init__(self):
        self.code: dict[str, int] = {}
        self.flat = np.zeros(1 << 12, np.int32)
        self.first = np.zeros(1 << 10, np.int64)
        self.count = np.zeros(1 << 10, np.int64)
        self.used = 0

    def add(self, keys: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        base, n = len(self.code), len(keys)
        if self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + len(ids)))
        if base + n > len(self.first):
            self.first = np.resize(self.first, 2 * (base + n))
            self.count = np.resize(self.count, 2 * (base + n))
        self.flat[self.used:self.used + len(ids)] = ids
        self.first[base:base + n] = self.used + np.cumsum(count) - count
        self.count[base:base + n] = count
        self.used += len(ids)
        self.code.update(zip(keys, range(base, base + n), strict=True))

    def codes(self, keys: list[str]) -> np.ndarray:
        return np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys))

    def ids(self, codes: np.ndarray) -> np.ndarray:
        count = self.count[codes]
        into = np.repeat(self.first[codes] - np.cumsum(count) + count, count)
        return self.flat[into + np.arange(len(into))]


class Encoder:
    """Encodes texts, remembering the words and the chunks between spaces it has met."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(spec)
        self.pattern = regex.compile(WORDS)
        self.exact_words = Tokenizer.from_str(spec).pre_tokenizer
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self._to_byte = byte_of_char()
        self.forget()

    def forget(self) -> None:
        self.words, self.chunks = Known(), Known()

    def split(self, text: str) -> list[str]:
        if not _UNSETTLED.search(text):
            return self.pattern.findall(text)
        return [bytes(self._to_byte[c] for c in w).decode()
                for w, _ in self.exact_words.pre_tokenize_str(text)]

    def pieces(self, text: str) -> Iterator[str | int]:
        """Parts of a text that encode on their own, and ids of special tokens."""
        for part in self.special.split(text) if self.special else [text]:
            if self.special and part in self.vocabulary.special:
                yield self.vocabulary.special[part]
                continue
            at = 0
            while len(part) - at > PIECE and (cut := _CUT.search(part, at + PIECE)):
                yield part[at:cut.start()]
                at = cut.start()
            if at < len(part):
                yield part[at:]

    def _word_codes(self, words: list[str]) -> np.ndarray:
        if new := list({w for w in words if w not in self.words.code}):
            self.words.add(new, *self.vocabulary.encode_words([w.encode() for w in new]))
        return self.words.codes(words)

    def _learn_chunks(self, chunks: Iterable[str]) -> None:
        """Tokens of " " + chunk. In a line of chunks, words that begin with a space begin one."""
        known = self.chunks.code
        new = [c for c in chunks if c not in known]
        if not new:
            return
        line = " " + " ".join(new)
        if _UNSETTLED.search(line):
            words = [w for c in new for w in self.split(" " + c)]
        else:
            words = self.pattern.findall(line)
        codes = self._word_codes(words)
        begins = np.flatnonzero(np.fromiter([w[0] == " " for w in words], bool, len(words)))
        count = np.add.reduceat(self.words.count[codes], begins)
        self.chunks.add(new, self.words.ids(codes), count)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        waiting: list[tuple[int, str | int]] = []
        size, begun = 0, 0
        for n, text in enumerate(texts):
            waiting += [(n, piece) for piece in self.pieces(text)]
            size += len(text)
            if size >= PIECE:
                yield from self._flush(waiting, begun, n + 1)
                waiting, size, begun = [], 0, n + 1
        yield from self._flush(waiting, begun, len(texts))

    def _flush(self, waiting: list[tuple[int, str | int]], begun: int, ended: int) -> Iterator[np.ndarray]:
        if len(self.words.code) + len(self.chunks.code) > REMEMBERED:
            self.forget()
        cut = [[p] if isinstance(p, int) or _UNEVEN.search(p) or p[0].isspace() else p.split(" ")
               for _, p in waiting]
        self._learn_chunks(set().union(*[c[1:] for c in cut]))
        heads = [c[0] if isinstance(c[0], int) else self.split(c[0]) for c in cut]
        self._word_codes([w for h in heads if not isinstance(h, int) for w in h])
        found: list[list[np.ndarray]] = [[] for _ in range(ended - begun)]
        for (n, _), head, chunks in zip(waiting, heads, cut, strict=True):
            if isinstance(head, int):
                found[n - begun].append(np.array([head], np.int32))
                continue
            found[n - begun].append(self.words.ids(self.words.codes(head)))
            found[n - begun].append(self.chunks.ids(self.chunks.codes(chunks[1:])))
        for parts in found:
            yield np.concatenate(parts) if parts else np.zeros(0, np.int32)


@lru_cache(2)
def encoder(spec: str) -> Encoder:
    return Encoder(spec)


def decoded(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """UTF-8 of the tokens; bytes that are no UTF-8 become U+FFFD."""
    count = vocabulary.length[ids]
    into = np.repeat(vocabulary.offset[ids] - np.cumsum(count) + count, count)
    return vocabulary.flat[into + np.arange(len(into))].tobytes().decode("utf-8", "replace").encode()


def read_spec(path: str) -> str:
    """The tokenizer's JSON, read on the driver; it goes to the tasks with the code."""
    return Path(path).read_text(encoding="utf-8")


def _id_type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _arrays(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _portions(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids: the token ids of each text. A null text is the empty one and has no ids; repeated
    rows are encoded each; other columns are not read. Empty in, empty out. A long text is worked on in
    pieces of PIECE characters or one word, and held with its ids as a whole."""
    return _coded(df, path, key, text, False)


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, decoded: `encode`, and the text decoded from those ids, in one pass."""
    return _coded(df, path, key, text, True)


def _coded(df: DataFrame, path: str, key: str, text: str, back: bool) -> DataFrame:
    spec = read_spec(path)

    def step(batches):
        own = encoder(spec)
        for batch in _portions(batches):
            ids = list(own([t or "" for t in batch.column(1).to_pylist()]))
            columns = [batch.column(0), _arrays(ids)]
            if back:
                columns.append(pa.array([decoded(own.vocabulary, i) for i in ids], pa.binary()).cast(
                    pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][:len(columns)])

    schema = f"key {_id_type(df, key)}, ids array<int>" + ", decoded string" * back
    return shared.arrow(df.select(key, text), step, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, decoded: the text of each id array, special tokens included; null ids give ''."""
    spec = read_spec(path)

    def step(batches):
        own = encoder(spec).vocabulary
        for batch in _portions(batches):
            texts = [decoded(own, np.array(i or [], np.int64)) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["key", "decoded"])

    schema = f"key {_id_type(df, key)}, decoded string"
    return shared.arrow(df.select(key, ids), step, schema).withColumnRenamed("key", key)


def digests(coded: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of `round_trip`."""
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        key, F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
