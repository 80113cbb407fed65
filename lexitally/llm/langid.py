"""Language identification: words first, shorter and shorter character n-grams after.

A word that the model knows counts with its log frequency in each language. An unseen word falls
back to its n-grams of the greatest length of which the model knows any, down to single characters.
A text's language is that with the best mean over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

UNKNOWN = "und"
LONGEST = 4           # characters of the longest n-gram
SAMPLE = 3000         # documents of a language that the model is fitted on, about
WORDS = 20_000        # words kept of each language, the most frequent
GRAMS = 5_000         # n-grams kept of each language and length
PENALTY = 7.0         # minus log10 of the frequency of what a language lacks
PIECE = 1 << 20       # characters worked on at once
REMEMBERED = 300_000  # words whose scores a task remembers before it starts anew

_WORD = re.compile(r"[^\W\d_]+")
_BLANK = re.compile(r"\s")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    known: tuple[dict[str, int], ...]  # row of each n-gram by its length; of words at 0
    scores: tuple[np.ndarray, ...]     # rows x languages: minus log10 of the relative frequency


def words(text: str) -> Iterator[list[str]]:
    """Lower-case words of the whole text, in portions."""
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word between two spaces; single characters are those of the word alone."""
    if n == 1:
        return list(word)
    framed = f" {word} "
    return [framed[i:i + n] for i in range(len(framed) - n + 1)]


def bucket(key: str) -> Column:
    """crc32 of the key as text, modulo 5."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def held_out(key: str) -> Column:
    """Whether a document is never learned from: bucket 0, or no key."""
    return F.coalesce(bucket(key) == 0, F.lit(True))


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = SAMPLE) -> Model:
    """Model of the labelled documents; rows without text or language teach nothing.

    Fitted on about `sample` documents of each language, all of them where there are fewer, chosen
    by a hash of the key: that and the numbers of words and n-grams kept bound the model, which
    has a column for each language and goes to every task. No rows: no languages.
    """
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "text is not null and lang is not null")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), ({},) * (LONGEST + 1), (np.zeros((0, 0)),) * (LONGEST + 1))
    share = F.element_at(F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample / sizes[k]))]), F.col("lang"))
    chosen = rows.where(shared.unit_hash("key") < share).select("lang", "text")

    def count(batches):
        for batch in batches:
            seen: Counter = Counter()
            for lang_, text_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for part in words(text_):
                    seen.update((lang_, w) for w in part)
            found: Counter = Counter()
            for (lang_, w), k in seen.items():
                found[lang_, 0, w] += k
                for n in range(1, LONGEST + 1):
                    for g in grams(w, n):
                        found[lang_, n, g] += k
            lang_, n, gram = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang_, pa.string()), pa.array(n, pa.int32()), pa.array(gram, pa.string()),
                 pa.array(found.values(), pa.int64())], ["lang", "n", "gram", "k"])

    counts = shared.settle(shared.arrow(chosen, count, "lang string, n int, gram string, k bigint").groupBy(
        "lang", "n", "gram").agg(F.sum("k").alias("k")), "gram-counts")
    order = Window.partitionBy("lang", "n").orderBy(F.desc("k"), "gram")
    kept = F.when(F.col("n") == 0, WORDS).otherwise(GRAMS)
    top = counts.withColumn("place", F.row_number().over(order)).where(
        (F.col("place") <= max(WORDS, GRAMS)) & (F.col("place") <= kept)).select("n", "gram").distinct()
    totals = {(r.lang, r.n): r.k for r in counts.groupBy("lang", "n").agg(F.sum("k").alias("k")).collect()}
    column = {k: i for i, k in enumerate(languages)}
    known: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    found = counts.join(top, ["n", "gram"]).orderBy("n", "gram", "lang").collect()
    for r in found:
        known[r.n].setdefault(r.gram, len(known[r.n]))
    scores = [np.full((len(k), len(languages)), PENALTY) for k in known]
    for r in found:
        scores[r.n][known[r.n][r.gram], column[r.lang]] = -np.log10(r.k / totals[r.lang, r.n])
    return Model(languages, tuple(known), tuple(scores))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.code = dict(self.model.known[0])
        self.scores = self.model.scores[0]

    def backoff(self, word: str) -> np.ndarray:
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            rows = self.model.known[n]
            if found := [rows[g] for g in grams(word, n) if g in rows]:
                return self.model.scores[n][found].mean(0)
        return np.full(len(self.model.languages), PENALTY)

    def rows(self, words_: list[str]) -> np.ndarray:
        """Rows of the words in `self.scores`, unseen words added."""
        if len(self.code) > REMEMBERED:
            self.forget()
        if new := [w for w in set(words_) if w not in self.code]:
            self.scores = np.concatenate([self.scores, [self.backoff(w) for w in new]])
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new)), strict=True))
        return np.fromiter(map(self.code.__getitem__, words_), np.int64, len(words_))

    def predict(self, texts: Iterable[str | None]) -> tuple[list[str], list[float]]:
        found, sure = [], []
        waiting: list[list[list[str]]] = []

        def flush() -> None:
            flat = [w for doc in waiting for part in doc for w in part]
            codes, at = self.rows(flat), 0
            for doc in waiting:
                n = sum(map(len, doc))
                mean = self.scores[codes[at:at + n]].mean(0)
                at += n
                chance = np.exp((mean.min() - mean) * np.log(10))
                best = int(np.argmax(chance))
                found.append(self.model.languages[best])
                sure.append(float(chance[best] / chance.sum()))
            waiting.clear()

        size = 0
        for text in texts:
            parts = [p for p in words(text or "") if p]
            if not self.model.languages or not any(c.isalpha() for p in parts for w in p for c in w):
                flush()
                found.append(UNKNOWN)
                sure.append(0.0)
                continue
            waiting.append(parts)
            size += len(text)
            if size >= PIECE:
                flush()
                size = 0
        flush()
        return found, sure


def predict(df: DataFrame, model: Model, text: str = "text", predicted: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """All columns of `df` and the predicted language with its score from 0 to 1.

    A null text, one without a letter, and any text when the model has no languages are `und` with
    score 0. Letters that the model has never seen leave all languages equal. Every row is
    predicted by its own text alone, repeated rows alike; no rows, no result. A long text is worked on
    in portions, and its words held as a whole. Columns of `df` that have the new names give way.
    """
    kept = [c for c in df.columns if c not in (predicted, score)]
    df = df.select(*kept)
    at = kept.index(text)

    def step(batches):
        scorer = Scorer(model)
        for batch in batches:
            found, sure = scorer.predict(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(sure, pa.float64())],
                [*kept, predicted, score])

    shape = T.StructType([*df.schema.fields, T.StructField(predicted, T.StringType()),
                          T.StructField(score, T.DoubleType())])
    return shared.arrow(df, step, shape)
