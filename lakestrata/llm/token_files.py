"""Token ids in binary shard files, with document boundaries as Elias-Fano sequences.

A shard file holds, in this order: eight bytes of magic, the ids of all its documents one after
another (2 or 4 bytes each, little-endian, by the size of the vocabulary), three Elias-Fano parts for
the document ends, three for the document ids, a JSON header, its length in eight bytes, and
the magic again. Offsets are never stored as a 64-bit table: document ``n`` ends where the n-th
set bit of the upper part says, found from a sampled position by counting bits.
"""

from __future__ import annotations

import json
import math
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window, functions as F

from lakestrata.layout import materialize, working_folder
from lakestrata.llm.words import MARKS, SPACES, pieces

MAGIC = b"LSTOKEN1"
SAMPLE = 512  # set bits between two sampled positions
CACHED_WORDS = 1_000_000  # of the word to ids table in a Python worker
FILE_IDS = 32 << 20  # a file is closed beyond so many ids
READ_IDS = 1 << 20  # ids read at once
SPECIAL = b"<|"  # how special tokens begin
MANIFEST = "part int, seq int, path string, documents long, ids long"


@dataclass
class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / n) bits per value."""

    count: int
    low_bits: int
    low: np.ndarray  # packed low bits, little-endian
    high: np.ndarray  # unary upper parts: bit (value >> low_bits) + place is set
    samples: np.ndarray  # place of each SAMPLE-th set bit, 32 bits each

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.empty(0, np.uint8), np.empty(0, np.uint8), np.empty(0, np.uint32))
        low_bits = max(0, int(math.floor(math.log2(max(1, int(values[-1])) / n))))
        bits = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> bits) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1, np.uint8)
        high[places] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"), places[::SAMPLE].astype(np.uint32))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        begin, end = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[begin // 8 : (end + 7) // 8], bitorder="little")
        bits = bits[begin % 8 : begin % 8 + end - begin].reshape(-1, self.low_bits).astype(np.uint64)
        return (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last - 1``, reading the upper part from a sample on."""
        if last <= first:
            return np.empty(0, np.uint64)
        at = int(self.samples[first // SAMPLE])
        following = -(-last // SAMPLE)
        stop = int(self.samples[following]) if following < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[at // 8 : stop // 8 + 1], bitorder="little")
        places = np.flatnonzero(bits) + at // 8 * 8
        places = places[places >= at]
        skip = first - first // SAMPLE * SAMPLE
        upper = places[skip : skip + last - first] - np.arange(first, last)
        return upper.astype(np.uint64) << np.uint64(self.low_bits) | self._low(first, last)

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Where a folder of the cluster lives, for use in tasks; ``s3a`` and ``s3n`` are ``s3``."""
    scheme = urlparse(uri).scheme
    if not scheme:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://").replace("s3n://", "s3://"))


def _marks_apart(column: pa.Array) -> list[bytes]:
    """Texts in lower case (A-Z), with a blank before the marks that end a word.

    Neither changes the ids: the tokenizer lower-cases, and always cuts between a letter or digit and
    a run of marks. Far fewer different words remain. Special tokens are matched as they stand, so
    texts that may hold one keep their case.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        space, letter = SPACES[data], ~MARKS[data]
        word = np.cumsum((np.append(True, space[:-1]) | edge[:-1]) & ~space, dtype=np.int32)
        # The last byte of a word that is no mark, if marks follow.
        at = np.flatnonzero(letter)
        at = at[np.append(word[at[1:]] != word[at[:-1]], True)] if len(at) else at
        at = at[at + 1 < len(data)]
        at = at[(word[at + 1] == word[at]) & ~space[at + 1]]
        # An ASCII letter or digit, or one of the letters U+00C0 to U+00FF in UTF-8; else marks may belong to it.
        last = data[at]
        latin = (data[np.maximum(at - 1, 0)] == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7)
        at = at[(last < 128) | latin] + 1
        data, offsets = np.insert(data, at, 32), offsets + np.searchsorted(at, offsets)
    whole = data.tobytes()
    if SPECIAL not in whole:
        whole = whole.lower()
    return [whole[a:b] for a, b in zip(offsets, offsets[1:])]


class _Encoder:
    """Whole texts to ids. The tokenizer drops white space and never looks across it, so a text
    is the concatenation of its words; known words are looked up in a bounded table.

    New words of letters only are encoded as one text without the pattern that would cut it into
    words; the ids of a word end with a word-end token. Words of a-z only need no normalising either.
    """

    def __init__(self, tokenizer_path: str, dtype: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(tokenizer_path)
        self.letters = Tokenizer(self.whole.model)
        self.letters.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.ascii = Tokenizer(self.whole.model)
        self.ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.whole.model.end_of_word_suffix
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, n in vocabulary.items() if suffix else ():
            self.closes[n] = token.endswith(suffix)
        self.has_closes = bool(self.closes.any())
        self.dtype = np.dtype(dtype)
        self.known: dict[bytes, bytes] = {}

    def learn(self, unknown: list[bytes]) -> None:
        plain, letters, rest = [], [], []
        for word in unknown:
            if not self.has_closes:
                rest.append(word)
            elif word.isalpha() and word.islower():
                plain.append(word)
            else:
                text = word.decode()
                (letters if text.isalpha() and text.lower().isalpha() else rest).append(word)
        for tokenizer, words in ((self.ascii, plain), (self.letters, letters)):
            if not words:
                continue
            joined = b" ".join(words).decode()
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids)
            ends = (np.flatnonzero(self.closes[ids]) + 1) * self.dtype.itemsize
            if len(ends) != len(words):
                raise ValueError("the tokenizer's words do not end with word-end tokens")
            raw = ids.astype(self.dtype).tobytes()
            self.known.update((w, raw[a:b]) for w, a, b in zip(words, np.append(0, ends[:-1]).tolist(), ends.tolist()))
        encoded = self.whole.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        self.known.update((w, np.array(e.ids, self.dtype).tobytes()) for w, e in zip(rest, encoded))

    def __call__(self, column: pa.Array) -> list[bytes]:
        split = [text.split() for text in _marks_apart(column)]
        found = [list(map(self.known.get, words)) for words in split]
        unknown = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
        if len(self.known) + len(unknown) > CACHED_WORDS:
            self.known.clear()
        self.learn(list(unknown))
        return [
            b"".join([self.known[w] if i is None else i for w, i in zip(words, ids)] if None in ids else ids)
            for words, ids in zip(split, found)
        ]


_ENCODERS: dict[tuple[str, str], _Encoder] = {}


def _encoder(path: str, dtype: str) -> _Encoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = _Encoder(path, dtype)
    return _ENCODERS[path, dtype]


class ShardWriter:
    """One file, written from front to back; only lengths and document ids are held in memory."""

    def __init__(self, folder: str, width: int) -> None:
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        name = f"shard-{uuid.uuid4().hex}.ids"
        self.path, self.width = f"{folder}/{name}", width
        self.out = fs.open_output_stream(f"{base}/{name}")
        self.out.write(MAGIC)
        self.lengths: list[int] = []
        self.doc_ids: list[int | None] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.out.write(ids)
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // self.width)
        self.ids += self.lengths[-1]

    def close(self) -> tuple[str, int, int]:
        keys = [d for d in self.doc_ids if d is not None]
        base = keys[0] if keys else 0
        header = {"width": self.width, "documents": len(self.lengths), "ids": self.ids,
                  "nulls": len(self.doc_ids) - len(keys), "base": base, "parts": []}
        ends = EliasFano.encode(np.cumsum(np.array(self.lengths, np.uint64)))
        docs = EliasFano.encode(np.array([k - base for k in keys], np.uint64))
        header["low_bits"] = [ends.low_bits, docs.low_bits]
        for part in ends.parts() + docs.parts():
            self.out.write(part)
            header["parts"].append(len(part))
        tail = json.dumps(header).encode()
        self.out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return self.path, len(self.lengths), self.ids


class ShardReader:
    """Random and sequential access to the documents of a shard file."""

    def __init__(self, path: str) -> None:
        fs, base = filesystem(path)
        self.file = fs.open_input_file(base)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"not a complete shard file: {path}")
        length = int.from_bytes(tail[:8], "little")
        self.header = json.loads(self.file.read_at(length, size - 16 - length))
        self.dtype = f"<u{self.header['width']}"
        at, parts = 8 + self.header["ids"] * self.header["width"], []
        for n in self.header["parts"]:
            parts.append(self.file.read_at(n, at))
            at += n
        self.ends, self.docs = (
            EliasFano(count, bits, np.frombuffer(p[0], np.uint8), np.frombuffer(p[1], np.uint8), np.frombuffer(p[2], "<u4"))
            for count, bits, p in (
                (self.header["documents"], self.header["low_bits"][0], parts[:3]),
                (self.header["documents"] - self.header["nulls"], self.header["low_bits"][1], parts[3:]),
            )
        )

    def __len__(self) -> int:
        return self.header["documents"]

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Ends of documents first - 1 to last - 1: offsets of documents first to last."""
        before = self.ends.select(first - 1, first) if first else np.zeros(1, np.uint64)
        return np.concatenate([before, self.ends.select(first, last)]).astype(np.int64)

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        """Null document ids come first."""
        nulls = self.header["nulls"]
        known = self.docs.select(max(0, first - nulls), max(0, last - nulls))
        return [None] * (min(last, nulls) - min(first, nulls)) + [int(k) + self.header["base"] for k in known]

    def ids(self, begin: int, end: int) -> np.ndarray:
        width = self.header["width"]
        return np.frombuffer(self.file.read_at((end - begin) * width, 8 + begin * width), self.dtype)

    def document(self, n: int) -> np.ndarray:
        return self.ids(*self.bounds(n, n + 1))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocabulary: int) -> DataFrame:
    """Encode ``docs`` (doc_id integer, text) into shard files in ascending order of doc_id.

    Returns the manifest: part, seq, path, documents, ids, one row per file. Files have names of
    their own for each attempt, and the manifest lists those of tasks that ended well, so a
    repeated task leaves at most an orphan. A null text counts as empty, a null doc_id comes first, rows with equal
    doc_id follow each other by a hash of their text. No rows give no files.
    """
    width = 2 if vocabulary <= 1 << 16 else 4
    dtype = f"<u{width}"
    end = np.array([end_id], dtype).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = _encoder(tokenizer_path, dtype)
        writer, seq = None, 0

        def row() -> pa.RecordBatch:
            path, documents, ids = writer.close()
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path],
                 "documents": [documents], "ids": [ids]}
            )

        for batch in batches:
            for piece in pieces(batch):
                for doc_id, ids in zip(piece.column("doc_id").to_pylist(), encoder(piece.column("text"))):
                    writer = writer or ShardWriter(folder, width)
                    writer.add(doc_id, ids + end)
                    if writer.ids >= FILE_IDS:
                        yield row()
                        writer, seq = None, seq + 1
        if writer:
            yield row()

    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .drop("_tie")
    )
    return materialize(ordered.mapInArrow(encode, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; the crc is over 32-bit little-endian ids.
    """
    order = Window.orderBy("part", "seq")  # one row per file
    before = F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("start", before).select("path", "start")
    files = files.repartition(max(1, manifest.count()), "path")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(batch.column(c).to_pylist() for c in ("path", "start"))):
                reader = ShardReader(path)
                at = 0
                while at < len(reader):
                    stop = min(len(reader), at + SAMPLE)
                    bounds = reader.bounds(at, stop)
                    take = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, side="right")) - 1)
                    stop, bounds = at + take, bounds[: take + 1]
                    ids = reader.ids(bounds[0], bounds[-1]).astype("<u4")
                    cuts = bounds - bounds[0]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(reader.doc_ids(at, stop), pa.int64()),
                            "start": pa.array(start + bounds[:-1], pa.int64()),
                            "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                            "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64()),
                        }
                    )
                    at = stop

    return files.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int) -> DataFrame:
    """Write files under the shared folder and read them back."""
    folder = working_folder(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id, vocabulary))
