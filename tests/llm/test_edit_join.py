import random

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import edit_join
from lakestrata.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, line, edits, letters="abcé𝒳 "):
    line = list(line)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(line))
        if kind == 0:
            line[at] = rng.choice(letters)
        elif kind == 1:
            del line[at]
        else:
            line.insert(at, rng.choice(letters))
    return "".join(line)


def random_lines(seed, count):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        line = "".join(rng.choice("abcé𝒳 ") for _ in range(rng.randint(20, 45)))
        out.append(line)
        out += [changed(rng, line, rng.randint(0, 4)) for _ in range(rng.randint(0, 3))]
    return out


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [(a, changed(rng, a, rng.randint(0, 4))) for a in random_lines(edits, 250)]
    pairs = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= edits]
    df = spark.createDataFrame(pairs, "a string, b string")
    for a, b, found in df.select("a", "b", edit_join.banded_distance(F.col("a"), F.col("b"), edits)).collect():
        wanted = distance(a, b)
        assert found == (wanted if wanted <= edits else None)


@pytest.mark.parametrize("edits", [1, 2])
def test_links_match_brute_force(spark, edits):
    lines = sorted({x for x in random_lines(10 + edits, 60) if len(x) >= edit_join.LEAST_CHARS})
    docs = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "doc_id long, text string")
    names = {r["id"]: r["line"] for r in edit_join.lines(docs, 1).select("line", edit_join.line_id(F.col("line")).alias("id")).collect()}
    found = {frozenset((names[r["a"]], names[r["b"]])): r["distance"] for r in edit_join.links(docs, edits).collect()}
    wanted = {}
    for n, a in enumerate(lines):
        for b in lines[:n]:
            if abs(len(a) - len(b)) <= edits and (d := distance(a, b)) <= edits:
                wanted[frozenset((a, b))] = d
    assert found == wanted and wanted


def test_documents(spark):
    one, near, chain = "the first line of all texts", "the first line of all text", "the first line of all tex"
    rows = [
        (3, f"{one}\nshort\n{near}", 0), (1, f"{chain}\nanother line, long enough", 0), (2, "short\n\nshort", 0),
        (4, None, 0), (5, "", 0), (6, "another line, long enough\nanother line, long enough", 0),
        (7, "x" * 50_000, 0), (8, "x" * 49_999, 0), (None, "a line without a document", 0), (9, "a line without a document", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_no int")
    found = sorted(map(tuple, edit_join.dedup_lines(docs, least=20).collect()), key=str)
    # (doc_id, lines, lines with a near one, removed)
    assert found == sorted([
        (1, 2, 1, 0), (2, 3, 0, 0), (3, 3, 2, 2), (4, 0, 0, 0), (5, 1, 0, 0), (6, 2, 0, 2), (7, 1, 1, 0), (8, 1, 1, 1),
        (None, 1, 0, 0), (9, 1, 0, 1),
    ], key=str)


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "twenty characters or more")] * 2, "doc_id long, text string")
    assert [tuple(r) for r in edit_join.dedup_lines(docs).collect()] == [(1, 2, 0, 1)]
    assert edit_join.dedup_lines(docs.limit(0)).collect() == []


def allowed(length):
    return max(1, min(edit_join.MOST_EDITS, length // edit_join.CHARS_PER_EDIT))


def alike(a, b):
    """Whether letter counts allow five edits."""
    return sum(abs(a.count(x) - b.count(x)) for x in set(a + b)) <= 10


@pytest.mark.parametrize("edits, limits", [
    (None, {}), (3, {}), (5, {}), (None, {"MOST_LINES": 1}), (2, {"MOST_LINES": 1}),
    (None, {"SAMPLE": 1, "LEAST_HEAVY": 2}), (5, {"SAMPLE": 2, "LEAST_HEAVY": 1}),
])
def test_edits_by_length_match_brute_force(spark, monkeypatch, edits, limits):
    """Also with nearly all keys taken for frequent, by the sample or by the exchange."""
    for name, value in limits.items():
        monkeypatch.setattr(edit_join, name, value)
    rng = random.Random(20 + (edits or 0))
    lines = set()
    for length in [20, 29, 30, 31, 39, 41, 50, 52, 60, 79, 80, 88, 128, 130, 257] * 2:
        line = "".join(rng.choice("abcdé𝒳 ") for _ in range(length))
        lines |= {line} | {changed(rng, line, n) for n in range(1, 7)}
    lines = sorted(x for x in lines if len(x) >= edit_join.LEAST_CHARS)
    docs = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "doc_id long, text string")
    names = {r["id"]: r["line"] for r in edit_join.lines(docs, 1).select("line", edit_join.line_id(F.col("line")).alias("id")).collect()}
    found = {frozenset((names[r["a"]], names[r["b"]])): r["distance"] for r in edit_join.links(docs, edits).collect()}
    wanted = {}
    for n, a in enumerate(lines):
        for b in lines[:n]:
            most = edits or allowed(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= most and alike(a, b) and (d := distance(a, b)) <= most:
                wanted[frozenset((a, b))] = d
    assert found == wanted and max(wanted.values()) == (edits or 5)


def test_a_changed_word_in_a_long_line_is_found(spark):
    line = "All rights reserved by the owners of this site, 2019, and its partners"
    docs = spark.createDataFrame([(1, line), (2, line.replace("2019", "1987"))], "doc_id long, text string")
    assert sorted(map(tuple, edit_join.dedup_lines(docs).collect())) == [(1, 1, 1, 0), (2, 1, 1, 1)]


def test_short_lines_that_repeat_are_removed(spark, tmp_path):
    rows = [(1, "Yes.\n\nNo.\nYes."), (2, "Yes.\nYes!\n"), (3, "a line that is long enough\nNo.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op9_segment_edit_join"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == [(1, 4, 0, 1), (2, 3, 0, 1), (3, 2, 0, 1)]


@pytest.mark.parametrize("shared", [60, 120])
def test_lines_of_one_beginning_are_no_candidates(spark, shared):
    rng = random.Random(shared)
    start = "".join(rng.choice("abcdefgh ") for _ in range(shared))
    lines = [start + "".join(rng.choice("abcdefghijklmnop ") for _ in range(120)) for _ in range(3000)]
    lines += [changed(rng, line, 3) for line in lines[:40]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert edit_join.candidates(docs, None).count() < len(lines)
    assert edit_join.links(docs).count() == 40


def test_letters_never_tell_close_lines_apart(spark):
    rng = random.Random(8)
    pairs = []
    for length in [20, 100, 255, 256, 257, 700] * 3:
        line = "".join(rng.choice("aeinorst") for _ in range(length)) + "t" * rng.choice([0, 250, 511])
        pairs += [(line, changed(rng, line, n, "aeinorst "), n) for n in range(6)] + [(line, line + "t" * 300, 300)]
    df = spark.createDataFrame(pairs, "a string, b string, n int")
    apart = edit_join.letters_apart(edit_join.letter_counts(F.col("a")), edit_join.letter_counts(F.col("b")))
    found = df.select("a", "b", "n", apart.alias("apart")).collect()
    plain = [sum(abs(r["a"].count(x) - r["b"].count(x)) for x in edit_join.LETTERS) for r in found]
    assert all(r["apart"] <= 2 * r["n"] for r in found)
    assert all(r["apart"] == p if p < 100 else r["apart"] <= p for r, p in zip(found, plain))


def test_texts_are_joined_only_to_pairs_of_like_letters(spark, monkeypatch):
    written = {}

    def watched(df, name, plain=edit_join.materialize):
        out = plain(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(edit_join, "materialize", watched)
    rng = random.Random(9)
    start = "".join(rng.choice("bcdfgh ") for _ in range(60))
    lines = [start + "".join(rng.choice(rng.choice(["aei", "nor", "st"])) for _ in range(60)) for _ in range(40)]
    lines += [start + x * 60 for x in "aeinorst"] + [start + "a" * 59 + "e"]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert edit_join.links(docs).count() == 1
    assert written["line-likely"] < written["line-candidates"] / 10


def test_lines_of_a_key_that_cannot_be_close_give_no_pairs(spark):
    rng = random.Random(11)
    start = "".join(rng.choice("bcdfgh ") for _ in range(60))
    lines = [start + "".join(rng.choice(rng.choice(["aei", "nor", "st"])) for _ in range(60)) for _ in range(100)]
    lines += [changed(rng, line, 4) for line in lines[:10]]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    # All pairs of 110 lines share the start.
    assert edit_join.candidates(docs, None).count() < 1000
    assert edit_join.links(docs).count() == 10


@pytest.mark.parametrize("edits, rows", [(3, 6), (4, 9), (5, 12)])
def test_long_segments_have_fewer_rows_than_shifts(spark, edits, rows):
    known = spark.createDataFrame([(1, "".join(random.Random(3).choices("abcdefgh", k=110)))], "id long, line string")
    assert edit_join.keyed(known, edits).count() == rows


def test_an_edit_changes_at_most_four_bits_of_a_sketch(spark):
    rng = random.Random(12)
    lines = ["".join(rng.choice("abcé𝒳 ") for _ in range(n)) for n in [20, 60, 300] * 4]
    pairs = [(line, changed(rng, line, n), n) for line in lines for n in range(1, 6)]
    known = spark.createDataFrame([(2 * n + side, p[side]) for n, p in enumerate(pairs) for side in (0, 1)], "id long, line string")
    found = {r["id"]: r[1:] for r in edit_join.sketches(known).collect()}
    mask = (1 << 64) - 1
    for n, (a, b, edits) in enumerate(pairs):
        bits = sum(((x ^ y) & mask).bit_count() for x, y in zip(found[2 * n], found[2 * n + 1]))
        assert bits <= 4 * edits - abs(len(a) - len(b))
    assert any(any(x) for x in found.values())


def test_kept_texts(spark):
    rows = [
        (2, "Yes.\n\nNo.\na line that is long enough\nYes.", 0), (1, "Yes.\na line that was long enough", 1),
        (3, None, 2), (4, "", 3), (None, "No.\n\nNo.", 4), (5, "Yes.", 5), (6, "new\nnew", 6), (6, "new\nnew", 6),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_no int")
    found = edit_join.kept_texts(docs, edit_join.line_classes(docs))
    assert found.columns == ["doc_id", "line_no", "text", "removed"]
    # A null doc_id comes first, and the empty line of a text stays.
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (2, 0, "", [0, 2, 3, 4]), (1, 1, "Yes.\na line that was long enough", []), (3, 2, None, []), (4, 3, "", []),
        (None, 4, "No.\n", [2]), (5, 5, "", [0]), (6, 6, "new", [1]), (6, 6, "new", [1]),
    ], key=str)
