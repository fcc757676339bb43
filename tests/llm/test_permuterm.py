import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import permuterm as pt


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return counts


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [] for w in counts}
    words = sorted(counts)
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_apart(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[word] = best if best is not None and counts[best] >= 5 * counts[word] else None
    out = []
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, counts[word], len(near[word]), counts[form[word]] if form[word] else None))
    return sorted(out)


def test_words_match_plain_counts(spark):
    rng = np.random.default_rng(4)
    parts = ["ab", "Cde", "É", "é", "ÿ", "×", "zz", "Q"]
    rows = []
    for doc in range(300):
        words = ["".join(rng.choice(parts, rng.integers(1, 7))) for _ in range(40)]
        rows.append((doc, "".join(w + str(rng.choice([" ", "-", "ā", "1", "\n", "日", "ſ"])) for w in words)))
    rows += rows[:5] + [(900, None), (901, ""), (902, "éÉ" * 40_000), (None, "abcabc " * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("id", F.lit(2))
    found = {r.word: r.n for r in pt.word_counts(docs.repartition(3)).collect()}
    plain = plain_words(rows)
    assert found == dict(plain)
    whole = Counter(w for _, t in rows for w in re.findall("[a-zÀ-ÿ]{6,}", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    assert found != dict(whole)  # some runs did lose a letter


@pytest.mark.parametrize("seed,letters", [(1, "ab"), (2, "abé×"), (3, "abcdefgh")])
def test_variants_match_brute_force(spark, seed, letters):
    rng = np.random.default_rng(seed)
    counts = {}
    for _ in range(250):
        word = "".join(rng.choice(list(letters), rng.integers(6, 10)))
        counts[word] = int(5 * 3 ** rng.integers(0, 9)) + int(rng.integers(0, 2))
        for _ in range(2):
            at = int(rng.integers(0, len(word)))
            other = word[:at] + str(rng.choice(["", letters[0], letters[-1] + word[at]])) + word[at + 1 :]
            counts[other] = int(5 * 4 ** rng.integers(0, 5))
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    found = sorted(map(tuple, pt.spelling_variants(words).collect()))
    assert found == plain_variants(counts)
    assert any(f[1] and f[2] != f[1] for f in found)  # chains


def test_small_batches_cut_ranges(spark):
    counts = {"abcde" + c + d: 5 + n for n, (c, d) in enumerate((c, d) for c in "abcdefg" for d in "abcdef")}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, pt.spelling_variants(words).collect())) == plain_variants(counts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_ties_take_the_smallest_word(spark):
    counts = {"aaaaab": 5, "aaaaac": 50, "aaaaad": 50, "aaaaa": 50, "aaaaabb": 50}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r.form for r in pt.spelling_variants(words).collect()}
    assert found["aaaaab"] == "aaaaa"
    assert sorted(map(tuple, pt.spelling_variants(words).collect())) == plain_variants(counts)


def test_documents_to_variants(spark):
    rows = [(i, "Señales señales, senales señaless señales SEÑALES") for i in range(6)] + [(99, "señales " * 300)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = {w: n for w, n in plain_words(rows).items() if n >= 5}
    assert sorted(map(tuple, pt.group_spellings(docs).collect())) == plain_variants(counts)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pt.group_spellings(empty).collect() == []
