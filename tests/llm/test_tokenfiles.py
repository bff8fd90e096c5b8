"""Token files: ids as the library gives them, exact positions, encodings and indexes of the files, reads in part."""

import glob
import json
import random
import zlib

import messy
import numpy as np
import public_tokenizers as PUBLIC
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from lendstrata.llm import tokenfiles as tf

OWN = Tokenizer.from_file(PUBLIC.path(tf.VOCABULARY))


def ids(text):
    return OWN.encode(text or "", add_special_tokens=False).ids + [0]


def brute(rows):
    """Sorted (doc_id, start, n_tokens, crc32) of rows (doc_id, text) with distinct ids."""
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = ids(text)
        out.append((doc_id, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    return out


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tf.write(docs, folder, tf.Layout(files=3, group_rows=40, page_rows=10), keep=("lang",))
    return folder, {r["doc_id"]: ids(r["text"]) for r in docs.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_round_trip_matches_the_library(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = tf.round_trip(docs, tf.Layout(files=5))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_files_are_as_the_layout_says(dataset):
    folder, documents = dataset
    files = sorted(glob.glob(f"{folder}/tokens/part*"))
    ids_seen = []
    for path in files:
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            assert group.num_rows <= 40
            for c in map(group.column, range(group.num_columns)):
                assert c.has_column_index and c.has_offset_index and c.compression == "ZSTD"
                if c.path_in_schema == "tokens.list.element":
                    assert "RLE_DICTIONARY" in c.encodings and c.has_dictionary_page
                elif c.path_in_schema != "lang":
                    assert c.encodings == ("DELTA_BINARY_PACKED",)
        ids_seen += pq.read_table(path, columns=["doc_id"])["doc_id"].to_pylist()
    assert len(files) == 3 and ids_seen == sorted(documents)


def test_metadata_reads_no_tokens(spark, dataset):
    plan = tf.read(spark, dataset[0]).select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "tokens#" not in plan.replace("n_tokens#", "")
    plan = tf.read_documents(spark, dataset[0], 3, 9)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,3)" in plan and "LessThanOrEqual(doc_id,9)" in plan


def test_documents_of_a_range(spark, dataset):
    folder, documents = dataset
    some = sorted(documents)[10:30]
    got = {r["doc_id"]: r["tokens"] for r in tf.read_documents(spark, folder, some[0], some[-1]).collect()}
    assert got == {i: documents[i] for i in some}
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r["doc_id"]: r["lang"] for r in tf.read(spark, folder, "lang string").collect()} == langs


@pytest.mark.parametrize("begin, end", [(0, 1), (0, 700), (777, 60_000), (500, 10**9), (5_000, 5_001)])
def test_span_of_positions(spark, dataset, begin, end):
    folder, documents = dataset
    whole = [t for i in sorted(documents) for t in documents[i]]
    rows = sorted(tf.read_span(spark, folder, begin, end).collect(), key=lambda r: r["start"])
    assert rows[0]["start"] == begin and [t for r in rows for t in r["tokens"]] == whole[begin:end]


def test_positions_past_the_end(spark, dataset):
    assert tf.read_span(spark, dataset[0], 10**9, 10**9 + 5).collect() == []
    with pytest.raises(ValueError):
        tf.read_span(spark, dataset[0], 5, 5)


def test_awkward_rows(spark):
    docs = messy.documents(spark)
    got = [tuple(r) for r in tf.round_trip(docs, tf.Layout(files=4)).orderBy("start").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r[1] == at
        at += r[2]
    own = sorted((str(i), len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for i, t in rows)
    assert sorted((str(r[0]), r[2], r[3]) for r in got) == own
    assert tf.round_trip(messy.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        tf.write(docs, "/nowhere", keep=("doc_id",))


def test_long_texts_are_cut_where_no_token_crosses():
    text = messy.texts()[8] + "  \n\t a  b " + "x" * 3000 + " don't 12 é漢 😀!" * 50
    parts = tf.pieces(text, 700)
    assert len(parts) > 100 and "".join(parts) == text
    assert [i for p in parts for i in OWN.encode(p, add_special_tokens=False).ids] + [0] == ids(text)
    assert tf.pieces("y" * 5000, 700) == ["y" * 5000]


def encode(texts):
    model = tf.Model.read(None, None)
    return [x.tolist() for x in tf.Encoder(model, tf.END)(pa.array(texts, pa.string()))]


def test_characters_are_classed_as_the_library_does():
    kinds = tf.Model.read(None, None).kinds
    cut = OWN.pre_tokenizer.pre_tokenize_str
    rng = random.Random(1)
    some = [*range(0x2100), *(rng.choice([rng.randrange(0x2100, 0xD800), rng.randrange(0xE000, 0x30000)]) for _ in range(4000))]
    for c in some:
        one = chr(c)
        want = 1 if len(cut(f"a{one}a")) == 1 else 2 if len(cut(f"1{one}1")) == 1 else 3 if len(cut(f"!{one}!")) == 1 else 0
        assert kinds[c] == want, hex(c)


@pytest.mark.parametrize("kept, size", [(tf.KEPT, tf.SLICE), (3, 40)])
def test_words_are_encoded_as_texts_are(monkeypatch, kept, size):
    monkeypatch.setattr(tf, "KEPT", kept)
    monkeypatch.setattr(tf, "SLICE", size)
    monkeypatch.setattr(tf, "PIECE", size)
    rng = random.Random(kept)
    parts = [" ", "  ", "\n", "\t ", "word", "Word's", "'ll ", "don't", "12", "é", "漢字", "😀", "!?", "\u00a0", "\u3000", "\u0558", "\ua7ce", "ſ", "½", "_", "\x00", "x" * 50]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(200)] + [None, "", "a <|endoftext|> b", "<|endoftext|>" * 3]
    assert encode(texts) == [ids(t) for t in texts]


def test_other_tokenizers_are_used_as_they_are(tmp_path):
    facts = json.loads(OWN.to_str())
    facts["pre_tokenizer"]["add_prefix_space"] = True
    path = f"{tmp_path}/t.json"
    with open(path, "w") as f:
        json.dump(facts, f)
    model = tf.Model.read(None, path)
    assert model.kinds is None
    own = Tokenizer.from_file(path)
    texts = ["word", " two words", ""]
    assert [x.tolist() for x in tf.Encoder(model, None)(pa.array(texts))] == [own.encode(t, add_special_tokens=False).ids for t in texts]
