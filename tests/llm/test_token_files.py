import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lakestrata.layout import working_folder
from lakestrata.llm import token_files as tf
from lakestrata.llm.queries import END_ID, VOCABULARY

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=1500), st.integers(0, 1400), st.integers(1, 700))
def test_elias_fano_round_trip(steps, first, size):
    values = np.cumsum(np.array(steps, np.uint64))
    packed = tf.EliasFano.encode(values)
    last = min(len(values), first + size)
    assert packed.select(0, len(values)).tolist() == values.tolist()
    assert packed.select(min(first, last), last).tolist() == values[min(first, last) : last].tolist()


def test_elias_fano_needs_little_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000).astype(np.uint64))
    packed = tf.EliasFano.encode(values)
    assert sum(map(len, packed.parts())) * 8 <= len(values) * (np.log2(values[-1] / len(values)) + 3)


ODD = [
    "It's İstanbul<|endoftext|>X <|ENDOFTEXT|> 3.14, foo... éa bar. x \x1c y\x0bz don't, \"q\". ﬁn Å Ǆ x!?",
    None, "", " \n ", "a.", "Σας ΣΑΣ. ǅ, 5% $3.5,", "x\u0085y z", "…, é…. 'tis 'S dogs' <|", "日本語、テスト。 नमस्ते é, ×. ÷,",
    "word " * 5000,
]


def test_words_one_by_one_give_the_ids_of_the_whole_text():
    whole = Tokenizer.from_file(PATH).encode_batch([t or "" for t in ODD], add_special_tokens=False)
    for texts in (ODD, ODD[::-1]):
        got = tf._Encoder(PATH, "<u2")(pa.array(texts))
        want = whole if texts is ODD else whole[::-1]
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == [w.ids for w in want]


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_files_read_back(spark, monkeypatch):
    rows = [(n * 3, text) for n, text in enumerate(ODD)] + [(1000 + n, f"text {n}.") for n in range(1500)]
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)
    found = tf.token_table(docs, PATH, END_ID, VOCABULARY)
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_random_access(spark):
    rows = [(None, "no id"), (-5, "a b c"), (7, None), (7, "seven"), (7, "seven"), (9, "x" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    manifest = tf.write_token_files(docs, working_folder(spark, "tokens"), PATH, END_ID, VOCABULARY)
    assert [r["documents"] for r in manifest.collect()] != []
    tokenizer = Tokenizer.from_file(PATH)
    for row in manifest.orderBy("part", "seq").collect():
        reader = tf.ShardReader(row["path"])
        for n in range(len(reader)):
            key, text = reader.doc_ids(n, n + 1)[0], None
            ids = reader.document(n).tolist()
            assert ids[-1] == END_ID
            assert any(k == key and tokenizer.encode(t or "", add_special_tokens=False).ids == ids[:-1] for k, t in rows), text
    assert tf.read_token_files(manifest).count() == len(rows)


def test_wide_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    found = tf.token_table(docs, PATH, END_ID, 1 << 17).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected([(1, "a b"), (2, "c")])
    assert tf.token_table(docs.limit(0), PATH, END_ID, VOCABULARY).collect() == []


def test_incomplete_file_is_refused(tmp_path):
    path = tmp_path / "x.ids"
    path.write_bytes(b"LSTOKEN1" + b"\0" * 64)
    with pytest.raises(ValueError):
        tf.ShardReader(str(path))
