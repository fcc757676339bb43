import hashlib
import random

import pytest

from lakestrata.llm import automata


def brute_force(rows, window):
    first = {}
    tokens = [(key, (text or "").encode().split()) for key, text in rows]
    for key, words in tokens:
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            if key is not None:
                first[run] = min(key, first.get(run, key))
    out = []
    for key, words in tokens:
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            if key is not None and first[tuple(words[at : at + window])] < key:
                gone[at : at + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((key, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, version int").repartition(3)
    found = sorted(map(tuple, automata.dedup_substrings(docs).collect()), key=str)
    assert found == brute_force([r[:2] for r in rows], automata.WINDOW)


def text(rng, words, letters="abcdefgh"):
    return " ".join("".join(rng.choices(letters, k=3)) for _ in range(words))


@pytest.mark.parametrize("seed,shard,stream", [(1, 200_000, 2_000_000), (2, 300, 500)])
def test_passages_match_brute_force(spark, monkeypatch, seed, shard, stream):
    monkeypatch.setattr(automata, "SHARD_WORDS", shard)
    monkeypatch.setattr(automata, "STREAM_WORDS", stream)
    rng = random.Random(seed)
    passages = [text(rng, n) for n in (49, 50, 51, 60, 120, 300)]
    rows = []
    for key in range(160):
        parts = [text(rng, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            words = rng.choice(passages).split()
            if rng.random() < 0.4:  # a piece of a passage, or one with a word replaced
                a = rng.randrange(len(words))
                words = words[a:] if rng.random() < 0.5 else [*words[:a], "changed", *words[a + 1 :]]
            parts += [" ".join(words), text(rng, rng.randint(0, 30))]
        rows.append((key, rng.choice([" ", "\n", "  "]).join(parts), 0))
    rows += [(200 + n, rows[n][1], 0) for n in range(20)]  # whole copies
    rows += [(300, "x " * 400, 0), (301, "x " * 60, 0), (302, "y x " * 60, 0)]  # overlapping windows
    rng.shuffle(rows)
    check(spark, rows)


def test_odd_input(spark):
    rng = random.Random(9)
    long = text(rng, 20_000)
    passage = text(rng, 70)
    rows = [
        (1, None, 0), (2, "", 0), (3, " \n", 0), (4, passage, 1), (4, passage, 1), (4, passage + " more", 1), (5, passage.upper(), 1),
        (None, passage, 2), (None, passage, 2), (6, "é " + passage, 3), (7, long, 0), (8, long[:-1], 0), (9, passage + " " + passage, 0),
    ]
    check(spark, rows)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert automata.dedup_substrings(empty).collect() == []


def test_automaton_knows_the_smallest_document():
    rng = random.Random(3)
    passages = [(doc, [rng.choice("ab").encode() for _ in range(rng.randint(1, 30))]) for doc in rng.sample(range(100), 20)]
    automaton = automata.SuffixAutomaton()
    for doc, words in passages:
        automaton.add(words, doc)
    automaton.finish()
    for _ in range(200):
        query, below, window = [rng.choice("abc").encode() for _ in range(25)], rng.randrange(110), rng.randint(1, 6)
        want = []
        for at in range(window, len(query) + 1):
            run = query[at - window : at]
            docs = [d for d, w in passages if any(w[i : i + window] == run for i in range(len(w) - window + 1))]
            if docs and min(docs) < below:
                want.append(at - 1)
        assert automaton.ends(query, below, window) == want
