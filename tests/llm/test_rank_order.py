import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import rank_order as ro


def plain_grams(text):
    words, word = [], ""
    for c in (text or "").lower() + " ":
        if unicodedata.category(c)[0] in "LM":
            word += c
        elif word:
            words.append(word)
            word = ""
    if not any(unicodedata.category(c)[0] == "L" for w in words for c in w):
        return Counter()
    line = " " + " ".join(words) + " "
    found = Counter(c for c in line if c != " ")
    found.update(line[i : i + 2] for i in range(len(line) - 1))
    found.update(g for g in (line[i : i + 3] for i in range(len(line) - 2)) if g[1] != " ")
    return found


def plain_top(counts, most):
    def code(gram):
        value = 0
        for c in gram:
            value = value << 21 | ord(c)
        return value

    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:most]]


def brute_force(rows, most):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows if i is not None} | {None: True}
    totals = {}
    for i, text, lang in rows:
        if not held[i] and lang is not None and plain_grams(text):
            totals.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {x: {g: n for n, g in enumerate(plain_top(c, most))} for x, c in totals.items()}
    out = []
    for i, text, _ in rows:
        top = plain_top(plain_grams(text), most)
        if not top or not profiles:
            out.append((i, held[i], "und", 0.0))
            continue
        distance = {
            x: sum(abs(p[g] - n) if g in p else most for n, g in enumerate(top)) for x, p in profiles.items()
        }
        best = min(sorted(distance), key=distance.get)
        out.append((i, held[i], best, 1 - distance[best] / (most * len(top))))
    return sorted(out, key=str)


def found(spark, rows, most):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    return sorted(map(tuple, ro.identify(docs.repartition(3), most).collect()), key=str)


SYLLABLES = {"aa": ["the", "ing", "and", "ö"], "bb": ["der", "ung", "ä", "sch"], "cc": ["που", "αι", "σ"], "dd": ["か", "的", "𝒜x"]}


def texts(count):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(count):
        lang = list(SYLLABLES)[i % 4]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(0, 30))]
        rows.append((i, " ".join(words).title() + ". 12", lang))
    return rows


@pytest.mark.parametrize("most", [300, 7])
def test_matches_plain_profiles(spark, most):
    rows = texts(60)
    assert found(spark, rows, most) == brute_force(rows, most)


def test_held_out_accuracy(spark):
    rows = [r for r in texts(200) if len(r[1]) > 10]
    hits = [(p == dict((i, lang) for i, _, lang in rows)[i]) for i, held, p, _ in found(spark, rows, 300) if held]
    assert len(hits) > 10 and np.mean(hits) > 0.95


def test_odd_rows(spark):
    rows = texts(20) + texts(20)[:3] + [
        (100, None, "aa"), (101, "", "aa"), (102, "12 %$ ́", "bb"), (103, "the", None), (None, "the and", "bb"),
        (104, "THE\u0000AND 😀 ding", "aa"), (105, "naïve été", "aa"), (106, "İstanbul ẞ", "bb"),
    ]
    assert found(spark, rows, 50) == brute_force(rows, 50)
    assert found(spark, [], 50) == []
    assert {r[2:] for r in found(spark, [(1, "words", None), (2, None, None)], 50)} == {("und", 0.0)}


def test_long_text_is_counted_in_slices(monkeypatch):
    text = "the quick brown fox. " * 50
    whole = ro.gram_counts(ro.spelled(text))
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(ro, "SLICE", size)
        for a, b in zip(whole, ro.gram_counts(ro.spelled(text))):
            assert a.tolist() == b.tolist()


def test_counts_are_sent_on_in_parts(spark, monkeypatch):
    rows = texts(40)
    monkeypatch.setattr(ro, "HELD_ENTRIES", 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {(r.lang, r.gram): r.n for r in ro.count_by_language(docs).collect()}
    plain = Counter()
    for _, text, lang in rows:
        for gram, n in plain_grams(text).items():
            value = 0
            for c in gram:
                value = value << 21 | ord(c)
            plain[lang, value] += n
    assert counts == dict(plain)


def test_limits_are_told(spark, monkeypatch):
    monkeypatch.setattr(ro, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame(texts(40), "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        ro.fit_profiles(docs, 3)
    with pytest.raises(ValueError, match="score"):
        ro.score_languages(docs.withColumn("score", F.lit(1)), {}, ["doc_id", "score"])
