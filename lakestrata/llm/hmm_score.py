"""A hidden Markov language model: Baum-Welch counts from all partitions, exact scores of whole texts.

Words are lower-cased A-Z; every text ends with an end token. The model emits symbols: each of the
most frequent words is a symbol of its own, any other word is the symbol of its ending, and is then drawn
from the words with that ending by their smoothed counts. So the emission table has a fixed
size, while the counts of all words stay a distributed table.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.words import pieces

STATES = 8
HEAD_WORDS = 60_000
COUNT_CLASSES = 64  # per doubling of the count
ENDING_BYTES = 4
ENDINGS = 4096  # symbols for rarer words, by a hash of their last bytes
END = HEAD_WORDS + ENDINGS
SYMBOLS = END + 1
PASSES = 3  # Baum-Welch passes over all training texts
SMOOTHING = 5000.0  # tokens of the overall distribution added to every state
STICKY = 0.98
# Training cuts a text into stretches of so many tokens; scoring never does.
STRETCH = 1024
STRETCH_TOKENS = 120_000  # handled at once, in training
SCORED_TOKENS = 1_000_000  # handled at once, in scoring; a longer text is handled alone
COUNTED_WORDS = 150_000  # of a task's running counter
CHUNKS = 64  # of the vector of counts that tasks send
# The starting point (not the model) comes from at most so many texts, and so many tokens of each.
START_TEXTS, START_TOKENS, START_SYMBOLS = 3000, 2000, 4096


def ending(word: bytes) -> int:
    return zlib.crc32(word[-ENDING_BYTES:]) % ENDINGS


def words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, text as bytes, held_out); a null doc_id is in training."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(crc % 7 == 2, F.lit(False))
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), held_out.alias("held_out"))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, ending, c) over all training texts. The end token is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "word": pa.array(list(seen), pa.binary()), "ending": pa.array(list(map(ending, seen)), pa.int32()),
                "c": pa.array(list(seen.values()), pa.int64()),
            })

        for batch in batches:
            for piece in pieces(batch):
                for text in piece.column("text").to_pylist():
                    seen.update(words(text))
                seen[b""] += piece.num_rows
                if len(seen) > COUNTED_WORDS:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    counted = train.select("text").mapInArrow(count, "word binary, ending int, c long")
    return materialize(counted.groupBy("word", "ending").agg(F.sum("c").alias("c")), "word-counts")


@dataclass(frozen=True)
class Model:
    tokens: int  # N
    distinct: int  # V
    head: dict[bytes, int]
    symbol_counts: np.ndarray  # training tokens per symbol
    ending_words: np.ndarray  # distinct rarer words per ending
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # symbols x states

    def smoothed_counts(self) -> np.ndarray:
        """Add-one counts: one more for each word of a symbol, and for unknown words of an ending."""
        counts = self.symbol_counts + (self.symbol_counts > 0).astype(float)
        counts[HEAD_WORDS:END] = self.symbol_counts[HEAD_WORDS:END] + self.ending_words + 1.0
        counts[END] = self.symbol_counts[END] + 1.0
        return counts

    def overall(self) -> np.ndarray:
        counts = self.smoothed_counts()
        return counts / counts.sum()

    def inflated(self, emits: np.ndarray) -> np.ndarray:
        """Expected counts with what smoothing adds to a symbol shared out among its states."""
        return emits * (self.smoothed_counts() / np.maximum(self.symbol_counts, 1))[:, None]


def vocabulary(counts: DataFrame) -> Model:
    """Sizes, frequent words (HEAD_WORDS at most) and totals per ending; no latent states yet.

    Words are taken by classes of their count, from the most frequent class down to the last that fits,
    so the driver receives a short histogram and the chosen words only.
    """
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    classed = counts.where("word <> X''").withColumn("class", F.floor(F.log2("c") * COUNT_CLASSES))
    fits, least = 0, None
    for row in sorted(classed.groupBy("class").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["class"]):
        fits += row["n"]
        if fits > HEAD_WORDS:
            break
        least = row["class"]
    frequent = [] if least is None else classed.where(F.col("class") >= least).select("word", "c").collect()
    frequent.sort(key=lambda r: (-r["c"], bytes(r["word"])))
    head = {bytes(r["word"]): n for n, r in enumerate(frequent)}
    symbols = np.zeros(SYMBOLS, np.int64)
    symbols[: len(frequent)] = [r["c"] for r in frequent]
    rarer = np.zeros(ENDINGS, np.int64)
    for row in counts.groupBy("ending").agg(
        F.sum(F.when(F.col("word") != F.lit(b""), F.col("c"))).alias("c"), F.count_if(F.col("word") != F.lit(b"")).alias("v"),
        F.sum(F.when(F.col("word") == F.lit(b""), F.col("c"))).alias("ends"),
    ).collect():
        symbols[HEAD_WORDS + row["ending"]] = row["c"] or 0
        rarer[row["ending"]] = row["v"]
        symbols[END] += row["ends"] or 0
    for word, n in head.items():
        symbols[HEAD_WORDS + ending(word)] -= symbols[n]
        rarer[ending(word)] -= 1
    none = np.empty(0)
    return Model(total["n"], total["v"], head, symbols, rarer, none, none, none)


ENCODED = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, symbols binary, rare array<binary>, times array<int>"
)


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """Symbols of every text, and its rarer words with their counts, written as a table."""
    head = model.head

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                sizes, symbols, rare, times = [], [], [], []
                for text in piece.column("text").to_pylist():
                    listed = words(text)
                    code = np.fromiter((head.get(w, -1) for w in listed), np.int32, len(listed))
                    others = [listed[n] for n in np.flatnonzero(code < 0)]
                    code[code < 0] = [HEAD_WORDS + ending(w) for w in others]
                    symbols.append(np.append(code, END).astype("<u2").tobytes())
                    sizes.append(len(listed) + 1)
                    tally = Counter(others)
                    rare.append(list(tally))
                    times.append(list(tally.values()))
                yield pa.RecordBatch.from_pydict({
                    "row_id": piece.column("row_id"), "doc_id": piece.column("doc_id").cast(pa.int64()),
                    "held_out": piece.column("held_out"), "n_tokens": pa.array(sizes, pa.int64()),
                    "symbols": pa.array(symbols, pa.binary()), "rare": pa.array(rare, pa.list_(pa.binary())),
                    "times": pa.array(times, pa.list_(pa.int32())),
                })

    rows = docs.withColumn("row_id", F.monotonically_increasing_id())
    return materialize(rows.mapInArrow(run, ENCODED), "encoded-texts")


def _shares(emits: np.ndarray, model: Model) -> np.ndarray:
    """Emission probabilities per state, smoothed by the overall ones."""
    return (emits + SMOOTHING * model.overall()[:, None]) / (emits.sum(axis=0) + SMOOTHING)


def starting_point(encoded: DataFrame, model: Model) -> Model:
    """Break the symmetry of states: spherical k-means of some texts by their frequent words."""
    texts = encoded.where("NOT held_out AND n_tokens > 8")
    part = F.lit(max(1, texts.count() // START_TEXTS))
    spread = F.xxhash64("doc_id", "n_tokens")
    sample = (
        texts.where(F.pmod(spread, part) == 0).select(spread.alias("h"), "row_id", F.substring("symbols", 1, 2 * START_TOKENS).alias("s"))
        .limit(2 * START_TEXTS).collect()
    )
    sample.sort(key=lambda r: (r["h"], r["row_id"]))
    rng = np.random.default_rng(11)
    overall = model.overall()
    emits = np.repeat(overall[:, None], STATES, axis=1)
    if len(sample) >= STATES:
        texts = [np.frombuffer(row["s"], "<u2") for row in sample]
        often = np.argsort(-model.symbol_counts, kind="stable")[:START_SYMBOLS]
        place = np.full(SYMBOLS, -1)
        place[often] = np.arange(len(often))
        x = np.zeros((len(texts), len(often)), np.float32)
        for n, text in enumerate(texts):
            known = place[text]
            x[n] = np.log1p(np.bincount(known[known >= 0], minlength=len(often)))
        x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
        centres = x[[0]]
        for _ in range(1, STATES):  # the text farthest from all centres so far, in a random hundred
            some = rng.choice(len(x), min(100, len(x)), replace=False)
            centres = np.vstack([centres, x[some[np.argmin((x[some] @ centres.T).max(axis=1))]]])
        for _ in range(15):
            near = np.argmax(x @ centres.T, axis=1)
            sums = np.stack([x[near == k].sum(axis=0) for k in range(STATES)])
            sizes = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(sizes > 0, sums / np.maximum(sizes, 1e-9), centres)
        emits = np.zeros((SYMBOLS, STATES))
        for text, k in zip(texts, near):
            emits[:, k] += np.bincount(text, minlength=SYMBOLS)
        emits = _shares(emits, model)
    else:
        emits *= rng.uniform(0.9, 1.1, emits.shape)
        emits /= emits.sum(axis=0)
    moves = np.full((STATES, STATES), (1 - STICKY) / max(1, STATES - 1))
    np.fill_diagonal(moves, STICKY)
    return replace(model, start=np.full(STATES, 1 / STATES), moves=moves, emits=emits)


def _by_time(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all sequences, first ones first and the longest sequence first among them, so that a step of the
    recursion reads them where they lie; where each step begins; the step of each symbol; the sequences' old places."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    whole = np.concatenate([sequences[n] for n in order])
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # sequences longer than t
    step = np.append(0, np.cumsum(active))
    time = np.repeat(np.arange(len(active), dtype=np.int32), active)
    rank = np.arange(len(whole)) - step[time]
    return whole[(np.cumsum(sizes) - sizes)[rank] + time].astype(np.int64), step, time, order


def forward(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Log10 likelihood of each whole sequence, by the scaled forward recursion."""
    symbols, step, time, order = _by_time(sequences)
    scales, ones = np.empty(len(symbols)), np.ones(STATES)
    alpha = None
    for t, (a, b) in enumerate(zip(step[:-1].tolist(), step[1:].tolist())):
        alpha = (model.start if t == 0 else alpha[: b - a] @ model.moves) * model.emits.take(symbols[a:b], axis=0)
        scale = np.matmul(alpha, ones, out=scales[a:b])
        alpha /= scale[:, None]
    out = np.empty(len(sequences))
    out[order] = np.bincount(np.arange(len(symbols)) - step[time], np.log10(scales), len(sequences))
    return out


def expected_counts(sequences: list[np.ndarray], model: Model, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Expected starts, moves and emissions. ``first`` marks sequences that begin a text."""
    symbols, step, time, order = _by_time(sequences)
    steps = list(zip(step[:-1].tolist(), step[1:].tolist()))
    emitted = model.emits.take(symbols, axis=0)
    alpha, scales, ones = np.empty((len(symbols), STATES)), np.empty(len(symbols)), np.ones(STATES)
    before = 0
    for t, (a, b) in enumerate(steps):
        now = alpha[a:b]
        if t:
            np.matmul(alpha[before : before + b - a], model.moves, out=now)
            now *= emitted[a:b]
        else:
            np.multiply(model.start, emitted[a:b], out=now)
        now /= np.matmul(now, ones, out=scales[a:b])[:, None]
        before = a
    emitted /= scales[:, None]
    # What lies ahead of each symbol, and the same as seen from the symbol before it.
    beta, onward = np.ones((len(symbols), STATES)), emitted
    back = np.ascontiguousarray(model.moves.T)
    for t in range(len(steps) - 1, 0, -1):
        a, b = steps[t]
        onward[a:b] *= beta[a:b]
        earlier = steps[t - 1][0]
        np.matmul(onward[a:b], back, out=beta[earlier : earlier + b - a])
    later = steps[0][1]
    rank = np.arange(later, len(symbols)) - step[time[later:]]
    pairs = alpha[step[time[later:] - 1] + rank].T @ onward[later:]
    gamma = np.multiply(alpha, beta, out=beta)
    starts = gamma[:later][first[order]].sum(axis=0)
    emits = np.stack([np.bincount(symbols, gamma[:, k], SYMBOLS) for k in range(STATES)], axis=1)
    return starts, pairs * model.moves, emits


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    cut, first, size = [], [], 0
    for raw in batch.column("symbols").to_pylist():
        whole = np.frombuffer(raw, "<u2")
        for at in range(0, len(whole), STRETCH):
            cut.append(whole[at : at + STRETCH])
            first.append(at == 0)
            size += len(cut[-1])
            if size >= STRETCH_TOKENS:
                yield cut, np.array(first)
                cut, first, size = [], [], 0
    if cut:
        yield cut, np.array(first)


def baum_welch(encoded: DataFrame, model: Model, passes: int = PASSES) -> Model:
    """Each pass sums expected counts over all training texts, task by task, then chunk by chunk
    of the vector; the driver gets one vector of fixed size."""
    train = encoded.where("NOT held_out").select("symbols")
    edges = np.linspace(0, SYMBOLS, CHUNKS + 1).astype(int)

    def add(chunk: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), "<f4").astype("<f8") for v in chunk["counts"])
        return pa.table({"chunk": chunk["chunk"][:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    for _ in range(passes):
        now = model

        def gather(batches: Iterator[pa.RecordBatch], now: Model = replace(now, head={})) -> Iterator[pa.RecordBatch]:
            starts, pairs, emits = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES))
            for batch in batches:
                for sequences, first in _stretches(batch):
                    s, p, e = expected_counts(sequences, now, first)
                    starts += s
                    pairs += p
                    emits += e
            vectors = [np.append(starts, pairs.ravel())] + [emits[a:b].ravel() for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array(range(len(vectors)), pa.int32()),
                "counts": pa.array([v.astype("<f4").tobytes() for v in vectors], pa.binary()),
            })

        schema = "chunk int, counts binary"
        sums = train.mapInArrow(gather, schema).groupBy("chunk").applyInArrow(add, schema).collect()
        if not sums:
            return model
        vectors = [np.frombuffer(r["counts"], "<f8") for r in sorted(sums, key=lambda r: r["chunk"])]
        starts, pairs = vectors[0][:STATES], vectors[0][STATES:].reshape(STATES, STATES)
        emits = np.concatenate(vectors[1:]).reshape(SYMBOLS, STATES)
        if not emits.sum():
            return model
        model = replace(
            model,
            start=(starts + 1) / (starts.sum() + STATES),
            moves=(pairs + 1) / (pairs.sum(axis=1, keepdims=True) + STATES),
            emits=_shares(model.inflated(emits), model),
        )
    return model


def score_texts(docs: DataFrame, passes: int = PASSES) -> DataFrame:
    """Per row of ``docs`` (doc_id integer, text): doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    ``score`` is the log10 probability of the text, end token included, under the model trained on
    texts that are not held out; ``base_score`` that under add-one unigram counts. A null text is an empty
    one. Repeated rows are scored each. Without training texts all words are unknown and states are
    equal.
    """
    rows = prepared(docs)
    counts = word_counts(rows.where("NOT held_out"))
    model = vocabulary(counts)
    encoded = encode(rows, model)
    model = baum_welch(encoded, starting_point(encoded, model), passes)
    slim = replace(model, head={})
    known_log = np.log10(slim.symbol_counts + 1.0)
    known_log[HEAD_WORDS:END] = 0.0  # rarer words come from the join
    ending_log = np.zeros(SYMBOLS)
    ending_log[HEAD_WORDS:END] = np.log10(slim.symbol_counts[HEAD_WORDS:END] + slim.ending_words + 1.0)
    frequent = (slim.symbol_counts > 0).astype(np.int64)
    frequent[HEAD_WORDS:END] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole, "symbols", 2 * SCORED_TOKENS)):
            sequences = [np.frombuffer(s, "<u2") for s in batch.column("symbols").to_pylist()]
            likelihood = forward(sequences, slim)
            yield pa.RecordBatch.from_pydict({
                "row_id": batch.column("row_id"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "n_tokens": batch.column("n_tokens"), "likelihood": pa.array(likelihood),
                "known_log": pa.array([known_log[s].sum() for s in sequences], pa.float64()),
                "ending_log": pa.array([ending_log[s].sum() for s in sequences], pa.float64()),
                "known": pa.array([int(frequent[s].sum()) for s in sequences], pa.int64()),
            })

    scored = encoded.select("row_id", "doc_id", "held_out", "n_tokens", "symbols").mapInArrow(
        run,
        "row_id long, doc_id long, held_out boolean, n_tokens long, likelihood double, known_log double, ending_log double, known long",
    )
    rare = encoded.select("row_id", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row_id", F.col("r.rare").alias("word"), F.col("r.times").alias("times")
    )
    found = rare.join(counts.select("word", "c"), "word")
    sums = found.groupBy("row_id").agg(
        F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("rare_log"), F.sum("times").alias("rare_known")
    )
    all_log = F.col("known_log") + F.coalesce("rare_log", F.lit(0.0))
    size = float(np.log10(model.tokens + model.distinct + 1.0))
    return scored.join(sums, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (all_log - F.col("n_tokens") * size).alias("base_score"),
        (F.col("likelihood") + F.coalesce("rare_log", F.lit(0.0)) - F.col("ending_log")).alias("score"),
    )
