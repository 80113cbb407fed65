import math
import re
import zlib
from collections import Counter, defaultdict

import brute

from lexitally.llm import langid, queries

SHAPE = "doc_id BIGINT, text STRING, lang STRING, score STRING, lang_pred INT"
EN, DE = "the cat and the dog of the house", "der hund und die katze in dem haus"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SHAPE)


def test_words_first_then_shorter_grams(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    rows += [(100, None, "fr"), (101, "x", None), (None, EN, "en")]
    model = langid.fit(table(spark, rows))
    assert model.languages == ("de", "en")
    scorer = langid.Scorer(model)
    known = model.known[0]
    assert (scorer.scores[known["the"]] == model.scores[0][known["the"]]).all()
    assert model.scores[0][known["the"], 0] == langid.PENALTY
    # "hunde" is unseen: the mean over its known 4-grams; "hxt" has none, nor 3-grams, but "t ".
    rows4 = [model.known[4][g] for g in langid.grams("hunde", 4) if g in model.known[4]]
    assert rows4 and (scorer.backoff("hunde") == model.scores[4][rows4].mean(0)).all()
    assert not any(g in model.known[n] for n in (3, 4) for g in langid.grams("qxt", n))
    assert (scorer.backoff("qxt") == model.scores[2][[model.known[2]["t "]]].mean(0)).all()
    assert (scorer.backoff("яя") == langid.PENALTY).all()


def test_odd_texts(spark):
    model = langid.fit(table(spark, [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]))
    texts = [EN.upper(), DE, None, "", " 12 ½ !? ", "я", "die " * 400_000, "the\n" * 10, "kat" * 50_000, EN.upper()]
    found = langid.predict(table(spark, [(i, t, None) for i, t in enumerate(texts)]), model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert [got[i][0] for i in (0, 1, 6, 7, 9)] == ["en", "de", "de", "en", "en"]
    assert [got[i] for i in (2, 3, 4)] == [("und", 0.0)] * 3
    assert got[5] == ("de", 0.5)
    assert all(0 <= s <= 1 for _, s in got.values())


def test_nothing_to_learn(spark):
    empty = table(spark, [(1, None, "en"), (2, "text", None)])
    model = langid.fit(empty)
    assert model.languages == ()
    assert {(r.lang_pred, r.score) for r in langid.predict(empty, model).collect()} == {("und", 0.0)}
    assert langid.predict(empty.where("false"), model).collect() == []


def test_query(spark, sf):
    lang = dict(brute.rows(sf, "SELECT doc_id, lang FROM documents"))
    rows = queries.op6_langid(spark, sf).collect()
    assert {r.doc_id: r.held_out for r in rows} == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in lang}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_rows_teach_nothing(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    df = table(spark, [(i, EN, "en") for i in ids] + [(1000, None, "en")])
    assert langid.fit(df.where(~langid.held_out("doc_id"))).languages == ()


def _plain_words(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def _plain_grams(word, n):
    framed = word if n == 1 else f" {word} "
    return [framed[i:i + n] for i in range(len(framed) - n + 1)]


def _plain_model(docs):
    """For each length the rows of its n-grams, words at 0, by the definition of the model."""
    counts = defaultdict(Counter)
    for text, lang in docs:
        for w in _plain_words(text):
            counts[lang, 0][w] += 1
            for n in range(1, langid.LONGEST + 1):
                counts[lang, n].update(_plain_grams(w, n))
    languages = sorted({lang for _, lang in docs})
    model = []
    for n in range(langid.LONGEST + 1):
        limit = langid.GRAMS if n else langid.WORDS
        kept = {g for lang in languages for g, _ in sorted(
            counts[lang, n].items(), key=lambda x: (-x[1], x[0].encode()))[:limit]}
        total = {lang: sum(counts[lang, n].values()) for lang in languages}
        model.append({g: [-math.log10(counts[lang, n][g] / total[lang]) if counts[lang, n][g] else langid.PENALTY
                          for lang in languages] for g in kept})
    return languages, model


def _plain_row(word, model, languages):
    if word in model[0]:
        return model[0][word]
    for n in range(langid.LONGEST, 0, -1):
        if rows := [model[n][g] for g in _plain_grams(word, n) if g in model[n]]:
            return [sum(column) / len(rows) for column in zip(*rows, strict=True)]
    return [langid.PENALTY] * len(languages)


def test_query_against_plain_back_off(spark, sf):
    docs = brute.rows(sf, "SELECT doc_id, text, lang FROM documents")
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    languages, model = _plain_model([(t, lang) for d, t, lang in docs if not held(d) and t is not None and lang is not None])
    found = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in queries.op6_langid(spark, sf).collect()}
    assert len(found) == len(docs)
    for d, text, _ in docs:
        rows = [_plain_row(w, model, languages) for w in _plain_words(text)]
        if not rows:
            assert found[d] == (held(d), "und", 0.0)
            continue
        mean = [sum(column) / len(rows) for column in zip(*rows, strict=True)]
        chance = [10 ** (min(mean) - m) for m in mean]
        best = max(range(len(mean)), key=lambda i: chance[i])
        assert found[d][:2] == (held(d), languages[best]) and math.isclose(found[d][2], chance[best] / sum(chance), rel_tol=1e-6)
