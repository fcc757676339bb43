"""Substring dedup across documents by suffix automata of reference shards.

A window is a run of WINDOW consecutive words. It is removed when it also occurs in a document with
a smaller id. The reference is every repeated window, once, where it occurs first: passages
of first documents, cut into shards of bounded size. The automaton of a shard is built where texts are
streamed past it, and one walk per text gives the matching statistics; each state knows the
smallest document in which its strings occur.

Which texts a shard may concern follows from anchors: the smallest hash of 16 consecutive words
in a window. Equal windows have equal anchors, so texts meet every shard that can match them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.words import Words, mix, pieces, runs, words_of

WINDOW = 50
ANCHOR = 16  # words of an anchor
SHARD_WORDS = 200_000  # of a reference shard
STREAM_WORDS = 2_000_000  # streamed past one copy of a shard's automaton
# Documents with a repeated anchor are preselected by a hash, which bounds the broadcast at 2^20 rows.
PRESELECT = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _join(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    """Hash of the concatenation, if ``b[i + gap]`` follows ``a[i]``; valid where both are."""
    n = len(b) - gap
    return mix(a[:n] * _STEP + b[gap:]) if n > 0 else np.empty(0, np.uint64)


def gram_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ANCHOR words and of WINDOW words from every place, whatever documents they span."""
    two = _join(h, h, 1)
    four = _join(two, two, 2)
    eight = _join(four, four, 4)
    sixteen = _join(eight, eight, 8)
    thirty_two = _join(sixteen, sixteen, 16)
    forty_eight = _join(thirty_two, sixteen, 32)
    return sixteen, _join(forty_eight, two, 48)


def window_anchors(words: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, anchor and hash of every window inside a document."""
    at = runs(words.first, WINDOW)
    if not len(at):
        return at, np.empty(0, np.int64), np.empty(0, np.int64)
    sixteen, whole = gram_hashes(h)
    least, width, span = sixteen, 1, WINDOW - ANCHOR + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    return at, least[at].view(np.int64), whole[at].view(np.int64)


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


PROFILE = "doc_id long, version long, n_words long, sha256 string, anchors array<long>"


def profiles(docs: DataFrame) -> DataFrame:
    """Per document: number and hash of its words, and its distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = words_of(piece.column("text"), lower=False)
                at, anchor, _ = window_anchors(words, words.hashes())
                cut = np.searchsorted(at, words.first)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id").cast(pa.int64()), "version": piece.column("version"),
                    "n_words": pa.array(words.counts(), pa.int64()),
                    "sha256": [_sha((t or b"").split()) for t in piece.column("text").cast(pa.large_binary()).to_pylist()],
                    "anchors": pa.array([np.unique(anchor[a:b]) for a, b in zip(cut, cut[1:])], pa.list_(pa.int64())),
                })

    return materialize(docs.mapInArrow(run, PROFILE), "substring-profiles")


SEGMENTS = "doc_id long, version long, segment long, begin int, words binary, n_words int, anchors array<long>"


def segments(texts: DataFrame) -> DataFrame:
    """Stretches of a text covered by windows with a repeated anchor; ``segment`` numbers them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                words = words_of(piece.column("text"), lower=False)
                at, anchor, _ = window_anchors(words, words.hashes())
                cut = np.searchsorted(at, words.first)
                rows = []
                shared = piece.column("shared").to_pylist()
                for d, (a, b) in enumerate(zip(cut, cut[1:])):
                    hit = a + np.flatnonzero(np.isin(anchor[a:b], np.array(shared[d], np.int64)))
                    if not len(hit):
                        continue
                    splits = np.flatnonzero(np.diff(at[hit]) > WINDOW) + 1
                    for some in np.split(hit, splits):
                        begin, end = at[some[0]], at[some[-1]] + WINDOW
                        text = words.data[words.starts[begin] : words.ends[end - 1]].tobytes()
                        rows.append((
                            piece.column("doc_id")[d].as_py(), piece.column("version")[d].as_py(), 0, begin - words.first[d],
                            text, end - begin, np.unique(anchor[some]),
                        ))
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["doc_id", "version", "segment", "begin", "words", "n_words", "anchors"],
                    )

    found = texts.mapInArrow(run, SEGMENTS).withColumn("segment", F.monotonically_increasing_id())
    return materialize(found, "substring-segments")


def windows(parts: DataFrame) -> DataFrame:
    """(window, doc_id, segment, at): every window of the segments that has a repeated anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "words"):
                words = words_of(piece.column("words"), lower=False)
                at, anchor, whole = window_anchors(words, words.hashes())
                cut = np.searchsorted(at, words.first)
                known = piece.column("anchors").to_pylist()
                use = np.concatenate([np.isin(anchor[a:b], known[d]) for d, (a, b) in enumerate(zip(cut, cut[1:]))])
                owner = np.repeat(np.arange(piece.num_rows), np.diff(cut))[use]
                yield pa.RecordBatch.from_pydict({
                    "window": pa.array(whole[use]), "doc_id": piece.column("doc_id").take(pa.array(owner)),
                    "segment": piece.column("segment").take(pa.array(owner)),
                    "at": pa.array(at[use] - words.first[owner], pa.int32()),
                })

    chosen = parts.select("doc_id", "segment", "words", "anchors")
    return chosen.mapInArrow(run, "window long, doc_id long, segment long, at int")


REFERENCE = "doc_id long, passage long, cluster long, words binary, n_words int, anchors array<long>"


def reference(parts: DataFrame) -> DataFrame:
    """Passages that hold every repeated window once, in the smallest document that has it.

    ``cluster`` is the smallest anchor of the segment a passage is from; those of near copies mostly agree.
    """
    # Both places are taken from the same row: they are ordered by the same values.
    first = windows(parts).groupBy("window").agg(
        F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"),
        F.min_by("segment", "doc_id").alias("segment"), F.min_by("at", "doc_id").alias("at"),
    )
    places = first.where("doc_id < last").groupBy("segment").agg(F.sort_array(F.collect_list("at")).alias("ats"))
    # A list holds at most the windows of one segment.
    chosen = parts.select("doc_id", "segment", "words", F.array_min("anchors").alias("cluster")).join(places, "segment")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, cluster, raw, ats in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "cluster", "words", "ats"))
            ):
                listed, ats = raw.split(), np.array(ats)
                for some in np.split(ats, np.flatnonzero(np.diff(ats) > 1) + 1):
                    text = b" ".join(listed[some[0] : some[-1] + WINDOW])
                    words = words_of(pa.array([text], pa.large_binary()), lower=False)
                    _, anchor, _ = window_anchors(words, words.hashes())
                    name = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)
                    rows.append((doc_id, name, cluster, text, len(words.starts), np.unique(anchor)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    names=["doc_id", "passage", "cluster", "words", "n_words", "anchors"],
                )

    return materialize(chosen.mapInArrow(run, REFERENCE), "substring-reference")


class SuffixAutomaton:
    """Of several passages at once; a state knows the smallest document of its strings."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.doc = [-1], [0], [None]
        self.codes: dict[bytes, int] = {}
        self.last = 0
        self._breaks = count(-1, -1)

    def add(self, words: list[bytes], doc: int) -> None:
        for word in words:
            self._extend(self.codes.setdefault(word, len(self.codes)), doc)
        self._extend(next(self._breaks), doc)  # no string goes on across passages

    def _extend(self, code: int, doc: int) -> None:
        following, link, size = self.next, self.link, self.size
        new, p = len(size), self.last
        following.append({})
        size.append(size[p] + 1)
        link.append(0)
        self.doc.append(doc)
        while p >= 0 and code not in following[p]:
            following[p][code] = new
            p = link[p]
        if p >= 0:
            q = following[p][code]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                clone = len(size)
                following.append(dict(following[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                self.doc.append(None)
                while p >= 0 and following[p].get(code) == q:
                    following[p][code] = clone
                    p = link[p]
                link[q] = link[new] = clone
        self.last = new

    def finish(self) -> None:
        """Hand the smallest document down the suffix links, longest strings first."""
        doc, link = self.doc, self.link
        for v in np.argsort(-np.array(self.size), kind="stable").tolist():
            p = link[v]
            if p > 0 and (doc[p] is None or doc[v] < doc[p]):
                doc[p] = doc[v]

    def ends(self, words: list[bytes], below: int, window: int) -> list[int]:
        """Places of the last words of windows that occur in a document smaller than ``below``."""
        following, link, size, doc = self.next, self.link, self.size, self.doc
        found, state, length = [], 0, 0
        code_of = self.codes.get
        for at, word in enumerate(words):
            code = code_of(word)
            if code is None:
                state = length = 0
                continue
            while state and code not in following[state]:
                state = link[state]
                length = size[state]
            state = following[state].get(code, 0)
            length = length + 1 if state else 0
            while state and size[link[state]] >= window:
                state = link[state]
                length = size[state]
            if length >= window and doc[state] < below:
                found.append(at)
        return found


SPANS = "doc_id long, version long, begins array<int>, ends array<int>"


def _stream(shard: pa.Table, texts: pa.Table) -> pa.Table:
    automaton = SuffixAutomaton()
    for raw, doc in zip(shard["words"].to_pylist(), shard["doc_id"].to_pylist()):
        automaton.add(raw.split(), doc)
    automaton.finish()
    rows = []
    for doc, version, begin, raw in zip(*(texts[c].to_pylist() for c in ("doc_id", "version", "begin", "words"))):
        last = np.array(automaton.ends(raw.split(), doc, WINDOW), np.int64)
        if len(last):
            groups = np.split(last, np.flatnonzero(np.diff(last) > WINDOW) + 1)
            rows.append((doc, version, [begin + g[0] - WINDOW + 1 for g in groups], [begin + g[-1] + 1 for g in groups]))
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
    names = ["doc_id", "version", "begins", "ends"]
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def covered(parts: DataFrame, passages: DataFrame) -> DataFrame:
    """Spans of the segments that lie in windows of a smaller document, by streaming segments past
    the automata of all shards that share an anchor with them."""
    words = passages.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-words // SHARD_WORDS))
    # Passages of a cluster share a shard, so that a text meets few; a large cluster has several.
    slices = passages.groupBy("cluster").agg(F.ceil(F.sum("n_words") / SHARD_WORDS).alias("slices"))
    slice_ = F.pmod(F.xxhash64("passage", "doc_id"), F.col("slices"))
    shard = F.when(F.col("slices") == 1, F.pmod(F.xxhash64("cluster"), F.lit(shards))).otherwise(
        F.lit(shards) + F.pmod(F.xxhash64("cluster", slice_), F.lit(1 << 40))
    )
    sharded = passages.join(slices, "cluster").withColumn("shard", shard).drop("slices")
    routes = sharded.select("shard", F.explode("anchors").alias("anchor")).distinct()
    wanted = parts.select("segment", F.explode("anchors").alias("anchor")).join(routes, "anchor")
    wanted = wanted.select("segment", "shard").distinct()
    routed = parts.select("doc_id", "version", "segment", "begin", "words", "n_words").join(wanted, "segment")
    routed = materialize(routed, "substring-routes")
    load = routed.groupBy("shard").agg(F.ceil(F.sum("n_words") / STREAM_WORDS).alias("copies"))
    load = materialize(load, "substring-load")
    copied = sharded.join(load, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), "doc_id", "words"
    )
    dealt = routed.join(load, "shard").withColumn("copy", F.pmod(F.xxhash64("segment"), "copies"))
    dealt = dealt.select("shard", "copy", "doc_id", "version", "begin", "words")
    return copied.groupBy("shard", "copy").cogroup(dealt.groupBy("shard", "copy")).applyInArrow(_stream, SPANS)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id integer, text): doc_id, n_words, n_removed, kept_sha256.

    Windows are judged on the input. Documents of equal words are resolved first: all but the
    one of smallest id lose everything. A null text has no words; a document without doc_id is
    neither changed nor a reference. Repeated rows, and different texts under one doc_id, do not
    remove each other.
    """
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    profile = profiles(docs)
    long = profile.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW))
    first = long.groupBy("sha256").agg(F.min("doc_id").alias("first"))
    copies = long.select("doc_id", "version", "sha256").join(first, "sha256").where("doc_id > first")
    copies = materialize(copies.select("doc_id", "version").distinct(), "substring-copies")
    anchors = long.join(copies, ["doc_id", "version"], "left_anti").select("doc_id", "version", F.explode("anchors").alias("anchor"))
    repeated = anchors.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    shared = anchors.join(repeated, "anchor").groupBy("doc_id", "version").agg(F.collect_set("anchor").alias("shared"))
    shared = materialize(shared, "substring-shared")
    bucket = F.pmod(F.xxhash64("doc_id", "version"), F.lit(PRESELECT))
    some = docs.withColumn("bucket", bucket).join(F.broadcast(shared.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
    texts = some.dropDuplicates(["doc_id", "version"]).join(shared, ["doc_id", "version"]).select("doc_id", "version", "text", "shared")
    texts = materialize(texts, "substring-texts")
    parts = segments(texts)
    spans = covered(parts, reference(parts)).groupBy("doc_id", "version").agg(
        F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            for text, begins, ends in zip(texts, *(batch.column(c).to_pylist() for c in ("begins", "ends"))):
                listed = text.split()
                gone = np.zeros(len(listed), bool)
                for a, b in zip(begins, ends):
                    gone[a:b] = True
                rows.append((int(gone.sum()), _sha([listed[n] for n in np.flatnonzero(~gone)])))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "version": batch.column("version"),
                "removed": pa.array([r[0] for r in rows], pa.int64()), "kept": pa.array([r[1] for r in rows], pa.string()),
            })

    changed = texts.select("doc_id", "version", "text").join(spans, ["doc_id", "version"])
    changed = changed.mapInArrow(cut, "doc_id long, version long, removed long, kept string")
    whole = copies.select("doc_id", "version", F.lit(-1).cast("long").alias("removed"), F.lit(_sha([])).alias("kept"))
    changed = materialize(changed.unionByName(whole), "substring-changes")
    joined = profile.drop("anchors").join(changed, ["doc_id", "version"], "left")
    removed = F.when(F.col("removed") < 0, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0)))
    return joined.select(
        "doc_id", "n_words", removed.alias("n_removed"), F.coalesce("kept", "sha256").alias("kept_sha256")
    )
