import itertools
import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import hmm_score as hmm
from lakestrata.llm.queries import QUERIES, read

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tiny(monkeypatch):
    """A model of 3 states over 5 symbols."""
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "SYMBOLS", 5)
    rng = np.random.default_rng(1)
    row = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1])
    return hmm.Model(0, 0, {}, np.ones(5), np.ones(1), row(3), row(3, 3), row(3, 5).T.copy())


def by_paths(sequence, m):
    total = 0.0
    for path in itertools.product(range(3), repeat=len(sequence)):
        p = m.start[path[0]] * m.emits[sequence[0], path[0]]
        for t in range(1, len(sequence)):
            p *= m.moves[path[t - 1], path[t]] * m.emits[sequence[t], path[t]]
        total += p
    return total


def test_forward_sums_over_all_paths(tiny):
    sequences = [np.array(s) for s in ([0], [4, 1, 2], [3, 3, 0, 1, 2, 4], [2, 2])]
    assert np.allclose(hmm.forward(sequences, tiny), [math.log10(by_paths(s, tiny)) for s in sequences])
    assert math.isclose(sum(by_paths(s, tiny) for s in itertools.product(range(5), repeat=3)), 1.0)


def test_long_texts_do_not_underflow(tiny):
    long = np.random.default_rng(2).integers(0, 5, 50_000)
    got = hmm.forward([long, long[:10]], tiny)
    assert np.isfinite(got).all() and -50_000 < got[0] < -20_000


def test_expected_counts_match_all_paths(tiny):
    sequences, m = [np.array([0, 3, 1, 1]), np.array([2, 4])], tiny
    starts, pairs, emits = hmm.expected_counts(sequences, m, np.array([True, True]))
    want_s, want_p, want_e = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in sequences:
        whole = by_paths(s, m)
        for path in itertools.product(range(3), repeat=len(s)):
            p = m.start[path[0]] * m.emits[s[0], path[0]]
            for t in range(1, len(s)):
                p *= m.moves[path[t - 1], path[t]] * m.emits[s[t], path[t]]
            want_s[path[0]] += p / whole
            for t, k in enumerate(path):
                want_e[s[t], k] += p / whole
                if t:
                    want_p[path[t - 1], k] += p / whole
    assert np.allclose(starts, want_s) and np.allclose(pairs, want_p) and np.allclose(emits, want_e)


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def test_scores_of_the_supplied_texts(spark):
    found = {r["doc_id"]: r for r in QUERIES["op1_hidden_markov_scores"](spark, SMALL).collect()}
    texts = {r["doc_id"]: tokens(r["text"]) for r in read(spark, SMALL, "documents").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, ws in texts.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    assert found.keys() == texts.keys()
    for d, ws in texts.items():
        r = found[d]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d], len(ws), n)
        assert r["n_known"] == sum(w in counts for w in ws)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    unseen = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    assert all(r["score"] < 0 for r in found.values())


def test_passes_raise_the_likelihood(spark):
    docs = read(spark, SMALL, "documents")
    totals = [
        hmm.score_texts(docs, passes).where("NOT held_out").agg(F.sum("score")).first()[0] for passes in (0, 1, 3)
    ]
    assert totals[0] < totals[1] < totals[2]


def test_words_of_one_ending_share_its_probability(spark):
    """What the model gives to all continuations of a text adds up to one."""
    rows = [(1, "aa ab aa ac"), (2, "ab ad"), (3, "ae aa")]
    rows = [(n, t) for n, t in rows for _ in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = hmm.word_counts(hmm.prepared(docs).where("NOT held_out"))
    model = hmm.vocabulary(counts)
    model = hmm.baum_welch(hmm.encode(hmm.prepared(docs), model), hmm.starting_point(hmm.encode(hmm.prepared(docs), model), model), 1)
    symbols = [[s] for s in range(hmm.SYMBOLS)]
    total = sum(10 ** hmm.forward([np.array(s) for s in symbols], model))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_odd_input(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "Word WORD word", 0), (4, "Word WORD word", 0), (None, "word", 0), (8, "é É " * 20_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_id int")
    found = sorted(map(tuple, hmm.score_texts(docs).collect()), key=str)
    assert len(found) == len(rows)
    by_id = {r[0]: r for r in found}
    assert by_id[1][2:4] == by_id[2][2:4] == by_id[3][2:4] and by_id[1][2] == 1
    assert by_id[8][2] == 40_001 and all(math.isfinite(r[6]) and r[6] < 0 for r in found)
    assert hmm.score_texts(docs.limit(0)).collect() == []


def scattered_counts(sequences, m, first):
    """Expected counts with each step's rows picked out of sequences that lie one after another."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    symbols, begin = np.concatenate([sequences[n] for n in order]).astype(np.int64), np.cumsum(sizes) - sizes
    active = [int((sizes > t).sum()) for t in range(sizes[0])]
    alpha, scales = np.empty((len(symbols), hmm.STATES)), np.empty(len(symbols))
    for t, n in enumerate(active):
        at = begin[:n] + t
        now = (m.start if t == 0 else now[:n] @ m.moves) * m.emits[symbols[at]]
        scales[at] = now.sum(axis=1)
        now /= scales[at][:, None]
        alpha[at] = now
    gamma, pairs, beta = np.empty_like(alpha), 0, np.ones((len(sizes), hmm.STATES))
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        gamma[at] = alpha[at] * beta[:n]
        if t:
            onward = beta[:n] * m.emits[symbols[at]] / scales[at][:, None]
            pairs = pairs + alpha[at - 1].T @ onward
            beta[:n] = onward @ m.moves.T
    emits = np.stack([np.bincount(symbols, gamma[:, k], hmm.SYMBOLS) for k in range(hmm.STATES)], axis=1)
    return gamma[begin[first[order]]].sum(axis=0), pairs * m.moves, emits


def test_expected_counts_are_those_of_scattered_steps_at_less_than_their_cost():
    rng = np.random.default_rng(3)
    emits, moves = rng.random((hmm.SYMBOLS, hmm.STATES)), rng.random((hmm.STATES, hmm.STATES))
    m = hmm.Model(
        1, 1, {}, np.ones(hmm.SYMBOLS), np.ones(hmm.ENDINGS), np.full(hmm.STATES, 1 / hmm.STATES),
        moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0),
    )
    sequences = [rng.integers(0, hmm.SYMBOLS, n).astype("<u2") for n in rng.integers(1, 1024, 150)]
    first = rng.random(len(sequences)) < 0.5
    seconds, found = {}, {}
    for call in (scattered_counts, hmm.expected_counts):
        taken = []
        for _ in range(4):
            begin = time.process_time()
            found[call] = call(sequences, m, first)
            taken.append(time.process_time() - begin)
        seconds[call] = min(taken)
    for plain, got in zip(*found.values()):
        assert np.allclose(plain, got)
    assert seconds[hmm.expected_counts] < 0.7 * seconds[scattered_counts]
