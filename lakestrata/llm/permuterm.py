"""Grouping of spelling variants by permuterm rotations.

A word is marked with an end and all its rotations are taken. What stands before the last character of a
rotation is the word without one character, with the place of the gap told by the mark. So words that differ
by a replacement share that beginning, and the whole rotation of a word is the beginning of those that
have one character more. Rotations are sorted, and a range of equal beginnings is a group of
words one edit apart: at most one whole word, and one word per character of the alphabet. A scan
emits, for every word of a range, how many neighbours it has there and the most frequent one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.words import pieces

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5  # a form is so many times as frequent as its variant
DELETE_ONE_IN = 199
PIECE_BYTES = 8 << 20
END = "\x01"  # no letter; below every letter in code-point order

# UTF-8: A-Z, a-z, and 0xC3 with what follows it, which is U+00C0 to U+00FF.
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


@dataclass
class Runs:
    """Lower-cased runs of letters: run ``r`` is ``letters[offsets[r] : offsets[r + 1]]``, of document ``doc[r]``."""

    letters: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray


def runs_of(column: pa.Array) -> Runs:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased. A null text has none."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    lead = data == LEAD
    letter = _ASCII[data] | lead
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    starts = np.flatnonzero(letter & (np.concatenate(([True], ~letter[:-1]))[: len(data)] | edge[:-1]))
    stops = np.flatnonzero(letter & (np.concatenate((~letter[1:], [True]))[: len(data)] | edge[1:])) + 1
    offsets = np.concatenate(([0], np.cumsum(stops - starts)))
    return Runs(_LOWER[data[letter]], offsets, np.searchsorted(ends, starts, side="right") - 1)


def checksums(runs: Runs, before: list[bytes | None]) -> np.ndarray:
    """CRC-32 of each run, continued from that of the bytes ``before`` of its document."""
    state = np.array([zlib.crc32(b or b"") for b in before], np.uint32)[runs.doc] ^ np.uint32(0xFFFFFFFF)
    sizes = np.diff(runs.offsets)
    longest_first = np.argsort(-sizes, kind="stable")
    state, at, sizes = state[longest_first], runs.offsets[:-1][longest_first], sizes[longest_first]
    left = len(sizes)
    for step in range(int(sizes[0]) if left else 0):
        left = int(np.searchsorted(-sizes[:left], -step, side="left"))  # runs longer than step
        byte = runs.letters[at[:left] + step]
        state[:left] = _CRC[(state[:left] ^ byte) & 0xFF] ^ (state[:left] >> np.uint32(8))
    out = np.empty_like(state)
    out[longest_first] = state ^ np.uint32(0xFFFFFFFF)
    return out


def altered(runs: Runs, before: list[bytes | None], one_in: int) -> pa.Array:
    """Runs as strings; where ``one_in`` divides the checksum, without the code point at checksum % length.

    Runs of documents whose ``before`` is None stay as they are.
    """
    sums = checksums(runs, before)
    known = np.array([b is not None for b in before], bool)[runs.doc]
    cut = np.flatnonzero((sums % np.uint32(one_in) == 0) & known)
    keep = np.ones(len(runs.letters), bool)
    for run in cut.tolist():
        low, high = int(runs.offsets[run]), int(runs.offsets[run + 1])
        leads = runs.letters[low:high] == LEAD
        # A code point begins at every byte that does not follow a lead byte.
        points = low + np.flatnonzero(~np.concatenate(([False], leads[:-1])))
        at = points[int(sums[run]) % len(points)]
        keep[at : at + 1 + (runs.letters[at] == LEAD)] = False
    gone = np.concatenate(([0], np.cumsum(~keep)))
    offsets = runs.offsets - gone[runs.offsets]
    letters = runs.letters[keep]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters))


def word_counts(docs: DataFrame, least_letters: int = LEAST_LETTERS, one_in: int = DELETE_ONE_IN) -> DataFrame:
    """(word, n) over all rows of ``docs`` (doc_id, text), words of ``least_letters`` code points or more.

    One run in ``one_in``, chosen by the CRC-32 of ``<doc_id>:<run>``, loses a letter. A null text has no
    words; runs of a document without id stay whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, most=PIECE_BYTES):
                before = [None if i is None else f"{i}:".encode() for i in piece.column("id").to_pylist()]
                words = altered(runs_of(piece.column("text")), before, one_in)
                words = words.filter(pc.greater_equal(pc.utf8_length(words), least_letters))
                counts = pc.value_counts(words)
                yield pa.RecordBatch.from_arrays([counts.field(0).cast(pa.string()), counts.field(1)], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(beginning, last, counted, n): what the scan needs of each rotation of every marked word.

    With ``last`` null, ``beginning`` is a whole rotation. Otherwise ``last`` is the character skipped;
    a word with the same character twice in a row gives equal shorter words, of which ``counted`` marks one.
    """
    size = F.length("word")

    def rotated(at):
        return F.concat(F.substr("word", at + 1, size), F.lit(END), F.substr("word", F.lit(1), at))

    def skipped(at):
        return F.struct(
            F.concat(F.substr("word", at + 2, size), F.lit(END), F.substr("word", F.lit(1), at)).alias("beginning"),
            F.substr("word", at + 1, F.lit(1)).alias("last"),
            (F.substr("word", at + 1, F.lit(1)) != F.substr("word", at + 2, F.lit(1))).alias("counted"),
        )

    def whole(at):
        return F.struct(rotated(at).alias("beginning"), F.lit(None).cast("string").alias("last"), F.lit(True).alias("counted"))

    every = F.concat(
        F.transform(F.sequence(F.lit(0), size), whole), F.transform(F.sequence(F.lit(0), size - 1), skipped)
    )
    return words.select(F.explode(every).alias("r"), "n").select("r.beginning", "r.last", "r.counted", "n")


def neighbour_counts(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): per word with neighbours, how many, and the most frequent with its n.

    Ties go to the word that is smallest in code-point order. ``words`` is (word, n), each word once.
    A range holds at most one word per character and one whole word, so a scan never holds many
    rows; hot words do not exist here.
    """
    schema = "word string, near long, other_n long, other string"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            starts = _starts(batch.column("beginning"))
            # The last range may go on in the next batch.
            held = batch.slice(starts[-1])
            if len(starts) > 1:
                yield _neighbours(batch.slice(0, starts[-1]), starts[:-1])
        if held is not None:
            yield _neighbours(held, np.zeros(1, np.int64))

    ranges = rotations(words).repartition("beginning").sortWithinPartitions("beginning", "last")
    found = ranges.mapInArrow(scan, schema)
    best = F.min(F.struct((-F.col("other_n")).alias("less_n"), F.col("other").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less_n")).alias("best_n"), F.col("best.word").alias("best")
    )


def _starts(beginnings: pa.Array) -> np.ndarray:
    changes = pc.not_equal(beginnings.slice(1), beginnings.slice(0, len(beginnings) - 1))
    return np.flatnonzero(np.concatenate(([True], changes.to_numpy(zero_copy_only=False))))


def _neighbours(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
    """Neighbours of every word of the ranges that begin at ``starts``."""
    sizes = np.diff(np.append(starts, batch.num_rows))
    batch = batch.filter(pa.array(np.repeat(sizes > 1, sizes)))
    if not batch.num_rows:
        return pa.RecordBatch.from_pydict({"word": pa.array([], pa.string()), "near": pa.array([], pa.int64()), "other_n": pa.array([], pa.int64()), "other": pa.array([], pa.string())})
    sizes = sizes[sizes > 1]
    starts = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    whole = batch.column("last").is_null().to_numpy(zero_copy_only=False)
    counted = batch.column("counted").to_numpy(zero_copy_only=False)
    n = batch.column("n").to_numpy()
    parts = pc.split_pattern(batch.column("beginning"), END)
    after, front = pc.list_element(parts, 0), pc.list_element(parts, 1)
    words = pc.binary_join_element_wise(front, pc.fill_null(batch.column("last"), ""), after, "")
    # Places of words in code-point order, for ties.
    order = np.empty(len(n), np.int64)
    order[pc.sort_indices(words).to_numpy()] = np.arange(len(n))
    has_whole = np.add.reduceat(whole.astype(np.int64), starts)[group]
    skips = sizes[group] - has_whole
    links = np.add.reduceat((counted & ~whole).astype(np.int64), starts)[group]
    near = np.where(whole, links, skips - 1 + has_whole * counted)
    # The most frequent of others: the first or second in each range by falling frequency. A whole word sees
    # only counted ones; those not counted see it elsewhere, where the same pair is counted.
    other = np.full(len(n), -1, np.int64)
    for of_whole in (False, True):
        able = (counted | ~whole) if not of_whole else (counted & ~whole)
        rank = np.lexsort((order, -n, group))
        rank = rank[able[rank]]
        of = group[rank]
        first = np.full(len(sizes), -1, np.int64)
        second = first.copy()
        head = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.empty(0, np.int64)
        first[of[head]] = rank[head]
        behind = head + 1
        behind = behind[behind < len(of)]
        behind = behind[of[behind] == of[behind - 1]]
        second[of[behind]] = rank[behind]
        mine = first[group]
        mine = np.where(mine == np.arange(len(n)), second[group], mine)
        other = np.where(whole == of_whole, mine, other)
    keep = np.flatnonzero((near > 0) & (other >= 0))
    chosen = pa.array(other[keep])
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(keep)), pa.array(near[keep].astype(np.int64)), pa.array(n[other[keep]]), words.take(chosen)],
        ["word", "near", "other_n", "other"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): forms followed to the last.

    A form is more frequent than its word, so there are no circles, and each round doubles the steps taken.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialize(moved, "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n), each word once.

    A near word differs by exactly one inserted, deleted or replaced code point. The form is the near word of largest
    n, ties to the smallest, if that n is ``ratio`` times the word's own at least. An empty table gives an empty result.
    """
    near = neighbour_counts(words.select("word", "n"))
    joined = words.select("word", "n").join(near, "word", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    known = materialize(
        joined.select(
            "word",
            F.when(has_form, F.col("best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    last = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_spellings(docs: DataFrame) -> DataFrame:
    """:func:`spelling_variants` of the words of ``docs`` (doc_id, text) with ``LEAST_COUNT`` occurrences or more.

    Repeated rows count as often as they stand there; other columns have no say.
    """
    words = word_counts(docs).where(F.col("n") >= LEAST_COUNT)
    return spelling_variants(materialize(words, "spelling-words"))
