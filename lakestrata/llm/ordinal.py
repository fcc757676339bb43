"""Severity of toxic text by cumulative-link ordinal regression on sparse word features.

P(grade > j) = sigmoid(w.x - t_j): one weight vector for all grades, ordered thresholds t_j.
The expected severity is the sum of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from lakestrata.layout import materialize
from lakestrata.llm.words import MARKS, pieces, words_of

# The classifier is fitted on at most so many labelled rows, those of smallest hash of doc_id.
TRAINING_ROWS = 20_000
MOST_FEATURES = 4096
LEAST_DOCUMENTS = 5  # labelled documents with a feature
LEAST_PHI2 = 0.005  # squared correlation with the label
LEAST_CHI2 = 15.0  # the same times the sample's size, which keeps chance out of small samples
GRADES = ("none", "mild", "severe")
PENALTY = 1e-5
STEPS = 600


@dataclass(frozen=True)
class SeverityModel:
    features: np.ndarray  # hashed words, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one per grade above the lowest

    def chances(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) per document and threshold."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def _hashed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and feature of every word."""
    words = words_of(column, lower=True, between=MARKS)
    return words.document_of_word(), words.hashes().view(np.int64)


def _hits(column: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place in ``features``, count) of the known features, by document."""
    document, feature = _hashed(column)
    if not len(features):
        none = np.empty(0, np.int64)
        return none, none, none
    place = np.minimum(np.searchsorted(features, feature), len(features) - 1)
    known = features[place] == feature
    pairs, count = np.unique(document[known] * len(features) + place[known], return_counts=True)
    return pairs // len(features), pairs % len(features), count


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, one row each.

    Labels without a doc_id or a verdict, and labels of absent documents, are left out before the bound; of
    contradicting labels the toxic one counts, and of several texts under one doc_id that of smallest hash. The chosen
    labels number at most ``rows``, which bounds the broadcast.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = materialize(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "severity-labels")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    once = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return materialize(once.select("text", "toxic"), "severity-sample")


def _associated(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words that go with the label, and whether they speak for it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                document, feature = _hashed(piece.column("text"))
                toxic = piece.column("toxic").to_numpy()
                order = np.lexsort((document, feature))
                document, feature = document[order], feature[order]
                new = np.append(True, feature[1:] != feature[:-1])[: len(feature)]
                once = new | np.append(True, document[1:] != document[:-1])[: len(feature)]
                at = np.flatnonzero(new)
                if len(at):
                    yield pa.RecordBatch.from_pydict(
                        {"feature": pa.array(feature[at]), "n": pa.array(np.add.reduceat(once.astype(np.int64), at)),
                         "n_toxic": pa.array(np.add.reduceat(once * (toxic[document] > 0).astype(np.int64), at))}
                    )

    counted = sample.mapInArrow(count, "feature long, n long, n_toxic long")
    size = sample.agg(F.count("*").alias("rows"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    rows, toxic = float(size["rows"]), float(size["toxic"])
    if not toxic or toxic == rows:
        return np.empty(0, np.int64), np.empty(0, bool)
    gap = F.col("n_toxic") * rows - F.col("n") * toxic
    phi2 = gap * gap / (F.col("n") * (rows - F.col("n") + 1e-9) * toxic * (rows - toxic))
    best = (
        counted.groupBy("feature")
        .agg(F.sum("n").cast("double").alias("n"), F.sum("n_toxic").cast("double").alias("n_toxic"))
        .where(F.col("n") >= LEAST_DOCUMENTS)
        .select("feature", phi2.alias("phi2"), (gap > 0).alias("speaks_for"))
        .where((F.col("phi2") >= LEAST_PHI2) & (F.col("phi2") * rows >= LEAST_CHI2))
        .orderBy(F.desc("phi2"), "feature")
        .limit(MOST_FEATURES)
        .collect()
    )
    best.sort(key=lambda r: r["feature"])
    return np.array([r["feature"] for r in best], np.int64), np.array([r["speaks_for"] for r in best], bool)


def fit_severity(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> SeverityModel:
    """Learn from a bounded sample of labelled documents.

    Labels say toxic or not. A toxic document is graded mild or severe by whether it has fewer words that go
    with the label than the median of toxic documents. Without both kinds of labels
    the model knows no feature and gives every document severity 0.
    """
    sample = labelled_sample(docs, labels, rows)
    features, speaks_for = _associated(sample)
    if not len(features):
        return SeverityModel(features, np.empty(0), np.full(len(GRADES) - 1, 60.0))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                document, place, count = _hits(piece.column("text"), features)
                cuts = np.searchsorted(document, np.arange(piece.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "toxic": piece.column("toxic"),
                        "places": pa.ListArray.from_arrays(cuts, pa.array(place, pa.int32())),
                        "counts": pa.ListArray.from_arrays(cuts, pa.array(count, pa.int32())),
                    }
                )

    # At most `rows` rows of at most MOST_FEATURES places each.
    table = sample.mapInArrow(vectors, "toxic int, places array<int>, counts array<int>").toArrow()
    table = table.combine_chunks()
    toxic = table["toxic"].to_numpy() > 0
    places, counts = (table[c].combine_chunks() for c in ("places", "counts"))
    document = np.repeat(np.arange(len(toxic)), np.diff(places.offsets.to_numpy()))
    place, count = places.values.to_numpy(), counts.values.to_numpy().astype(float)
    hits = np.bincount(document, count * speaks_for[place], len(toxic))
    grade = toxic * (1 + (hits >= np.median(hits[toxic])))
    return _fit(document, place, np.log1p(count), grade, features)


def _fit(document: np.ndarray, place: np.ndarray, value: np.ndarray, grade: np.ndarray, features: np.ndarray) -> SeverityModel:
    """Full-batch Adam on the cumulative-link likelihood with an L2 penalty."""
    n, f, cuts = len(grade), len(features), len(GRADES) - 1
    # Thresholds are t_0 and positive gaps exp(g), so they stay ordered.
    x = np.zeros(f + cuts)
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        gaps = np.exp(x[f + 1 :])
        t = x[f] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(document, value * x[:f][place], n)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - t), np.zeros((n, 1))], axis=1)
        rows = np.arange(n)
        upper, lower = above[rows, grade], above[rows, grade + 1]
        chance = np.maximum(upper - lower, 1e-12)
        slope = above * (1 - above)
        by_score = -(slope[rows, grade] - slope[rows, grade + 1]) / chance / n
        by_t = np.array([
            ((grade == j + 1) * slope[:, j + 1] - (grade == j) * slope[:, j + 1]) @ (1 / chance) / n for j in range(cuts)
        ])
        change = np.concatenate([
            np.bincount(place, value * by_score[document], f) + PENALTY * x[:f],
            [by_t.sum()], [gaps[j] * by_t[j + 1 :].sum() for j in range(cuts - 1)],
        ])
        first = 0.9 * first + 0.1 * change
        second = 0.999 * second + 0.001 * change**2
        x -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    t = x[f] + np.concatenate(([0.0], np.cumsum(np.exp(x[f + 1 :]))))
    return SeverityModel(features, x[:f].copy(), t)


def score_severity(docs: DataFrame, model: SeverityModel, keep: Sequence[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``severity`` (expected grade), ``grade`` (0 to 2) and ``toxic``
    (more likely than not above grade 0). ``keep`` names the columns to carry; None is all.

    A null or empty text has no features and counts like any text without known words. Columns
    of these names in ``docs`` are refused. The model holds at most MOST_FEATURES features.
    """
    clash = {"severity", "grade", "toxic"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    names = docs.columns if keep is None else list(keep)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                document, place, count = _hits(piece.column("text"), model.features)
                total = np.bincount(document, np.log1p(count) * model.weights[place], piece.num_rows)
                above = model.chances(total)
                yield pa.RecordBatch.from_arrays(
                    [*map(piece.column, names), pa.array(above.sum(axis=1)), pa.array((above >= 0.5).sum(axis=1), pa.int32()),
                     pa.array(above[:, 0] >= 0.5)],
                    names=[*names, "severity", "grade", "toxic"],
                )

    added = [("severity", DoubleType()), ("grade", IntegerType()), ("toxic", BooleanType())]
    fields = [f for n in names for f in docs.schema.fields if f.name == n]
    schema = StructType(fields + [StructField(*a) for a in added])
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(score, schema)
