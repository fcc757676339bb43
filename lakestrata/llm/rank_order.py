"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of a language by rank. A text is given the language whose
profile is nearest by out-of-place distance: the sum, over the text's own most frequent n-grams, of how
far each stands from its place in the profile; one that the profile lacks counts as far as can be.

Letters are code points of category L, lower-cased; marks (category M) belong to the word of their
letter. A word stands between blanks, which count in n-grams of two and three.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.llm.words import pieces

PROFILE = 300  # n-grams of a profile and of a text
MOST_LANGUAGES = 5_000  # what the driver accepts as labels; their profiles are 1.5 million rows
FOLDS = 5
UNKNOWN = "und"

BITS = 21  # of a code point, so three fit in 63
BLANK = 32
SLICE = 1 << 20  # code points counted at once
HELD_ENTRIES = 1 << 20  # distinct n-grams a task holds before it sends their counts on


@functools.cache
def _kinds() -> np.ndarray:
    """Per code point: 1 letter, 2 mark, 0 anything else."""
    return np.array([{"L": 1, "M": 2}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def spelled(text: str | None) -> np.ndarray:
    """Code points of the words of a text, a blank before and after each; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[codes]
    if not (kinds == 1).any():
        return np.empty(0, np.int64)
    inside = kinds > 0
    after = np.zeros(len(codes), bool)
    after[1:] = inside[:-1]
    words = np.where(inside, codes, BLANK)[inside | after]
    return np.concatenate(([BLANK], words, [BLANK] * int(inside[-1]))).astype(np.int64)


def merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal n-grams added up, n-grams ascending."""
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    return grams[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of one to three of what :func:`spelled` gives, and how often each stands there."""
    found = []
    for at in range(0, len(codes), SLICE):
        # Two more, so that n-grams that begin here are whole; they are no beginnings here.
        one = codes[at : at + SLICE + 2]
        letter = one != BLANK
        two = (one[:-1] << BITS) | one[1:]
        three = (two[:-1] << BITS) | one[2:]
        found.append(np.unique(np.concatenate([
            one[:SLICE][letter[:SLICE]], two[:SLICE], three[:SLICE][letter[1 : SLICE + 1][: len(three)]]
        ]), return_counts=True))
    if len(found) == 1:
        return found[0]
    return merged(*(np.concatenate(x or [np.empty(0, np.int64)]) for x in zip(*found))) if found else (np.empty(0, np.int64),) * 2


def ranked(grams: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, those of equal counts by their code points."""
    return grams[np.argsort(-counts, kind="stable")[:most]]


def count_by_language(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``texts`` (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> pa.RecordBatch:
            sizes = [len(g) for g, _ in held.values()]
            langs = pa.array(list(held), pa.string()).take(pa.array(np.repeat(np.arange(len(held)), sizes)))
            out = pa.RecordBatch.from_pydict({
                "lang": langs,
                "gram": pa.array(np.concatenate([g for g, _ in held.values()])),
                "n": pa.array(np.concatenate([c for _, c in held.values()]).astype(np.int64)),
            })
            held.clear()
            return out

        for batch in batches:
            for piece in pieces(batch):
                words: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(piece.column("lang").to_pylist(), piece.column("text").to_pylist()):
                    codes = spelled(text)
                    if len(codes):
                        # The blank that ends one text begins the next.
                        mine = words.setdefault(lang, [])
                        mine.append(codes[1:] if mine else codes)
                for lang, all_codes in words.items():
                    grams, counts = gram_counts(np.concatenate(all_codes))
                    if lang in held:
                        grams, counts = merged(*(np.concatenate(x) for x in zip(held[lang], (grams, counts))))
                    held[lang] = grams, counts
                if sum(len(g) for g, _ in held.values()) > HELD_ENTRIES:
                    yield flush()
        if held:
            yield flush()

    counted = texts.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_profiles(texts: DataFrame, most: int = PROFILE) -> dict[str, np.ndarray]:
    """The ``most`` most frequent n-grams of every language of ``texts`` (lang, text), by rank.

    Counts cover all rows and whole texts; rows without a language or a letter give nothing. Only
    profiles reach the driver. More than ``MOST_LANGUAGES`` languages are refused, as such a
    column does not name languages.
    """
    counts = count_by_language(texts.where("lang IS NOT NULL AND text IS NOT NULL"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.select("lang", "gram", rank.alias("rank")).where(F.col("rank") <= most)
    rows = top.limit(MOST_LANGUAGES * most + 1).toPandas()
    if len(rows) > MOST_LANGUAGES * most:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    rows = rows.sort_values(["lang", "rank"])
    return {lang: mine["gram"].to_numpy() for lang, mine in rows.groupby("lang")}


class Profiles:
    """Profiles of all languages, laid out for the distances of one text to each."""

    def __init__(self, profiles: dict[str, np.ndarray], most: int = PROFILE):
        self.most = most
        self.names = sorted(profiles)
        grams = np.concatenate([np.empty(0, np.int64), *(profiles[x] for x in self.names)])
        order = np.argsort(grams, kind="stable")
        self.grams = grams[order]
        self.language = np.repeat(np.arange(len(self.names)), [len(profiles[x]) for x in self.names])[order]
        self.rank = np.concatenate([np.empty(0, np.int64), *(np.arange(len(profiles[x])) for x in self.names)])[order]

    def distances(self, top: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's ranked n-grams to each language."""
        low = np.searchsorted(self.grams, top, "left")
        many = np.searchsorted(self.grams, top, "right") - low
        mine = np.repeat(np.arange(len(top)), many)
        at = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(mine))
        nearer = self.most - np.abs(self.rank[at] - mine)
        return self.most * len(top) - np.bincount(self.language[at], nearer, len(self.names))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language, the first by name among equals, and 1 less its share of the largest distance."""
        codes = spelled(text)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        top = ranked(*gram_counts(codes), self.most)
        distances = self.distances(top)
        best = int(np.argmin(distances))
        return self.names[best], float(1 - distances[best] / (self.most * len(top)))


def score_languages(docs: DataFrame, profiles: dict[str, np.ndarray], keep: list[str], most: int = PROFILE) -> DataFrame:
    """Columns ``keep`` of all rows of ``docs``, with ``lang_pred`` and ``score`` from ``text`` alone.

    ``keep`` may not name ``text``, ``lang_pred`` or ``score``. A null or empty text, and one without a letter, is
    ``und`` with a score of 0, and so is every text where nothing was learned.
    """
    if clash := {"text", "lang_pred", "score"} & set(keep):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    chosen = docs.select(*keep, "text")
    model = docs.sparkSession.sparkContext.broadcast(Profiles(profiles, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = [model.value.predict(text) for text in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in keep), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                    [*keep, "lang_pred", "score"],
                )

    schema = chosen.drop("text").schema.add("lang_pred", "string").add("score", "double")
    return chosen.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: by the CRC-32 of its id as text. One without id is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def identify(docs: DataFrame, most: int = PROFILE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    Learns from rows that are not held out. Repeated rows count as often as they stand there; other columns
    have no say. An empty table gives an empty result.
    """
    learned = docs.where(~held_out(F.col("doc_id"))).select("lang", "text")
    profiles = fit_profiles(learned, most)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return score_languages(rows, profiles, ["doc_id", "held_out"], most)
