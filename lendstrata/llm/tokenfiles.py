"""Token ids in Parquet files that can be read in part.

A dataset is a folder with ``tokens``, one row per document in ascending order of doc_id from file to file, and ``index``, one row per
file. A row holds doc_id, part (the file's place), start (ids before the document in its file), n_tokens and tokens, a list of ints.
The list is dictionary encoded: a vocabulary makes for 16 bits an id at most. The other columns rise or are small and take the delta
encoding. Row groups and pages have a bounded number of rows, and their least and greatest values stand in the page index, so that a
range of documents or of token positions reads its own pages, and metadata reads no tokens.

Documents are dealt to files by ranges of their id, sorted and then encoded where they are written, so ids are made once and never
shuffled. A worker puts a distinct word through the tokenizer's model once; texts are cut into words by the classes
of characters that the tokenizer itself tells apart. Ids before a file are added up from the index, whose rows are as many as the files, by the driver; a row never holds them.

Null texts are empty: the end id alone. A null doc_id comes first. Rows with one doc_id are rows of their own, ordered by a
digest of the text; they and equal rows may lie in several files. Very long texts are encoded a piece at a time, cut where no token can
cross. A string in a text that is one of the tokenizer's special tokens becomes that token, as the library has it. Empty tables give a dataset without rows. Other columns are not written unless they are asked for by name.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import attrgetter
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstrata.llm import bpe
from lendstrata.llm import text as tx
from lendstrata.sources.sinks import work_folder

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Bytes whose words are encoded at once, and characters of a piece of a very long text.
SLICE = 1_000_000
PIECE = 500_000
#: Distinct words a worker keeps the ids of, in some 50 bytes each; they are told apart by 64 bits.
KEPT = 1_200_000
#: Ids of an Arrow batch on their way to a file.
BATCH_IDS = 500_000

_ID = attrgetter("id")
#: Between a letter, digit or mark and a space no token of the split pattern goes on.
_CUT = re.compile(r"(?<=[\w!-/:-@])(?= )")
_FILE = T.StructType().add("doc_id", "long").add("part", "integer").add("start", "long").add("n_tokens", "integer").add("tokens", T.ArrayType(T.IntegerType()))
_INDEX = "part int, base long, documents long, tokens long, first_id long, last_id long"


@dataclass(frozen=True)
class Layout:
    """How files are written. Rows, not bytes, bound row groups and pages, so that the index is as fine for short documents as for long."""

    files: int | None = None  # by default as many as the session's shuffle partitions leave
    group_rows: int = 20_000
    page_rows: int = 500
    group_bytes: int = 64 << 20
    compression: str = "zstd"

    def options(self, plain: list[str]) -> dict[str, str]:
        return {
            "compression": self.compression,
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.block.size": str(self.group_bytes),
            "parquet.block.row.count.limit": str(self.group_rows),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.page.size.row.check.min": str(min(100, self.page_rows)),
        } | {f"parquet.enable.dictionary#{c}": "false" for c in plain}


def _kept() -> dict:
    """What a worker process keeps from task to task. Functions of this folder travel by value, so their module is no place for it."""
    name = "_kept_by_token_files"
    return vars(sys.modules.setdefault(name, ModuleType(name)))


@dataclass(frozen=True)
class Model:
    """A tokenizer's file, and what the driver found out about it."""

    text: str
    special: tuple[str, ...]  # strings that are a token wherever they stand
    kinds: np.ndarray | None  # class of each code point, if words can be cut apart from the library

    @classmethod
    def read(cls, spark: SparkSession, path: str | None) -> Model:
        """The size of the file is fixed by its vocabulary."""
        path = path or public_tokenizers.path(VOCABULARY)
        if "://" in path:
            text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
        else:
            with open(path, encoding="utf-8") as f:
                text = f.read()
        facts = json.loads(text)
        cut = facts["pre_tokenizer"] or {}
        by_words = (
            (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) == ("ByteLevel", True, False)
            and facts["model"]["type"] == "BPE"
            and not facts["model"]["dropout"]
            and not facts["normalizer"]
            and not facts["truncation"]
            and not any(" " in t["content"] for t in facts["added_tokens"])
        )
        special = tuple(t["content"] for t in facts["added_tokens"])
        return cls(text, special, _classes(tokenizer(text)) if by_words else None)


def tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has a core
    from tokenizers import Tokenizer

    return Tokenizer.from_str(text)


def encoder(model: Model, end: int | None) -> Encoder:
    """The worker's encoder, which knows the words of the tasks before."""
    kept, key = _kept(), f"{hash(model.text)} {end} {KEPT} {SLICE} {PIECE}"
    if key not in kept:
        kept[key] = Encoder(model, end)
    return kept[key]


def _classes(own) -> np.ndarray:
    """Class of each code point, as the library's own cutting shows: letter, number, other or white space.

    A run of one class is a piece, so that one character of each piece has to be looked at.
    """
    cut = own.pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, bpe._OTHER, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for _, (start, end) in cut(every):
            start += every[start] == " " and end - start > 1
            one = every[start]
            probes = ((f"a{one}a", bpe._LETTER), (f"1{one}1", bpe._NUMBER), (f"!{one}!", bpe._OTHER))
            kinds[low + start : low + end] = next((kind for text, kind in probes if len(cut(text)) == 1), bpe._SPACE)
    kinds[0x20] = bpe._SPACE
    return kinds


def pieces(text: str, size: int = PIECE) -> list[str]:
    """The text in pieces of about ``size`` characters whose ids together are the text's."""
    out, at = [], 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def _byte_characters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next from 256 on."""
    table = np.arange(256, dtype="<u2")
    others = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 255 and b != 173)]
    table[others] = 256 + np.arange(len(others))
    return table


class Encoder:
    """Ids of texts. Words are cut as the library cuts them; each distinct word is put through its model once, as long as it is kept."""

    def __init__(self, model: Model, end: int | None) -> None:
        self.own, self.kinds, self.end = tokenizer(model.text), model.kinds, end
        self.special = re.compile("|".join(map(re.escape, model.special)).encode()) if model.special else None
        self.characters = _byte_characters()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.empty(0, np.uint64)  # hashes of words, rising
        self.places = np.empty(0, np.int32)
        self.many = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, with the end id."""
        ending = np.array([] if self.end is None else [self.end], np.int32)
        for first, last, data, offsets in tx.slices(texts, SLICE):
            raw = data.tobytes()
            if self.kinds is None or (self.special and self.special.search(raw)) or (last - first == 1 and len(raw) > SLICE):
                for i in range(last - first):
                    yield np.concatenate([*self._by_text(raw[offsets[i] : offsets[i + 1]].decode()), ending])
                continue
            ids, edges = self._by_word(data, offsets)
            for i in range(last - first):
                yield np.concatenate([ids[edges[i] : edges[i + 1]], ending])

    def _by_text(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text's pieces; of the whole text, if the tokenizer is of another kind."""
        for p in pieces(text) if self.kinds is not None else [text]:
            if self.kinds is not None and not (self.special and self.special.search(p.encode())):
                data = np.frombuffer(p.encode(), np.uint8)
                yield self._by_word(data, np.array([0, len(data)]))[0]
            else:
                yield np.array(self.own.encode_batch_fast([p], add_special_tokens=False)[0].ids, np.int32)

    def _by_word(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, and where each text's ids begin."""
        w = bpe.cut(data, offsets, self.kinds)
        if not len(w.starts):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        coded = pc.dictionary_encode(pa.array(tx.hashes(w, strong=True)))
        which = coded.indices.to_numpy()
        first = np.empty(len(coded.dictionary), np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        place = self._placed(coded.dictionary.to_numpy(), data, w.starts[first], w.ends[first])[which]
        many = self.many[place]
        total = np.cumsum(many)
        step = np.arange(int(total[-1])) - np.repeat(total - many, many)
        return self.flat[np.repeat(self.starts[place], many) + step], np.concatenate([[0], total])[w.bounds]

    def _placed(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Place of each distinct word, by its hash; new ones are encoded."""
        if len(self.keys) > KEPT:
            self._forget()
        order = np.argsort(hashes)
        asked = hashes[order]
        at = np.searchsorted(self.keys, asked)
        near = np.minimum(at, max(0, len(self.keys) - 1))
        known = self.keys[near] == asked if len(self.keys) else np.zeros(len(asked), bool)
        out = np.empty(len(hashes), np.int64)
        out[order[known]] = self.places[near[known]]
        new = order[~known]
        if len(new):
            text = self.characters[data].tobytes().decode("utf-16-le")  # a character for each byte
            tokenize, flat, edges = self.own.model.tokenize, [], [0]
            gc.disable()  # nothing here is in a cycle, and there are many small objects
            for a, b in zip(starts[new].tolist(), ends[new].tolist()):
                flat += map(_ID, tokenize(text[a:b]))
                edges.append(len(flat))
            gc.enable()
            edges = np.array(edges, np.int64)
            out[new] = len(self.many) + np.arange(len(new))
            self.starts = np.concatenate([self.starts, len(self.flat) + edges[:-1]])
            self.many = np.concatenate([self.many, np.diff(edges).astype(np.int32)])
            self.flat = np.concatenate([self.flat, np.array(flat, np.int32)])
            self.places = np.insert(self.places, at[~known], out[new].astype(np.int32))
            self.keys = np.insert(self.keys, at[~known], asked[~known])
        return out


def _written(model: Model, end: int | None, names: list[str]):
    """Rows of a file, from its sorted documents (extra columns, doc_id, text, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, start = encoder(model, end), 0
        for batch in batches:
            first, kept, size = 0, [], 0
            for i, ids in enumerate(own(tx.text_of(batch, "text"))):
                kept.append(ids)
                size += len(ids)
                if size >= BATCH_IDS:
                    yield rows(batch.slice(first, i + 1 - first), kept, start)
                    first, kept, size, start = i + 1, [], 0, start + size
            if kept:
                yield rows(batch.slice(first), kept, start)
                start += size

    def rows(batch: pa.RecordBatch, ids: list[np.ndarray], start: int) -> pa.RecordBatch:
        many = np.array([len(x) for x in ids], np.int64)
        ends = np.cumsum(many)
        tokens = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(np.concatenate(ids)))
        columns = [tx.text_of(batch, "doc_id"), tx.text_of(batch, "part"), pa.array(start + ends - many), pa.array(many.astype(np.int32)), tokens]
        extra = [batch.column(i) for i in range(len(names))]
        return pa.RecordBatch.from_arrays(columns + extra, _FILE.names + names)

    return run


def write(docs: DataFrame, folder: str, layout: Layout = Layout(), path: str | None = None, end: int | None = END, keep: tuple[str, ...] = ()) -> None:
    """Writes documents (doc_id, text) as a dataset; ``keep`` names columns that go beside the ids."""
    spark = docs.sparkSession
    tx.bound_batches(spark)
    clash = set(keep) & set(_FILE.names)
    if clash:
        raise ValueError(f"names of the format's own columns: {sorted(clash)}")
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
        F.monotonically_increasing_id().alias("row"),  # parts a hot id's equal texts
    )
    keys = ["doc_id", "digest", "row"]
    dealt = rows.repartitionByRange(layout.files, *keys) if layout.files else rows.repartitionByRange(*keys)
    placed = dealt.sortWithinPartitions(*keys).drop("digest", "row").withColumn("part", F.spark_partition_id())
    schema = T.StructType([*_FILE, *[T.StructField(c, docs.schema[c].dataType) for c in keep]])
    files = placed.mapInArrow(_written(Model.read(spark, path), end, list(keep)), schema)
    files.write.options(**layout.options(["doc_id", "part", "start", "n_tokens"])).parquet(f"{folder}/tokens")
    write_index(spark, folder)


def write_index(spark: SparkSession, folder: str) -> None:
    """One row per file, from the files' metadata columns."""
    files = spark.read.schema(_FILE).parquet(f"{folder}/tokens").groupBy("part")
    files = files.agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    base, out = 0, []
    for r in files.orderBy("part").collect():  # as many as there are files
        out.append((r["part"], base, r["documents"], r["tokens"], r["first_id"], r["last_id"]))
        base += r["tokens"]
    spark.createDataFrame(out, _INDEX).coalesce(1).write.parquet(f"{folder}/index")


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str, keep: str = "") -> DataFrame:
    """Rows (doc_id, start, n_tokens, tokens), start counting the ids of all documents before. Columns that aren't selected are not read.

    ``keep``: names and types of columns that were written beside the ids.
    """
    schema = T.StructType([*_FILE, *(T.StructType.fromDDL(keep) if keep else [])])
    files = spark.read.schema(schema).parquet(f"{folder}/tokens")
    own = index(spark, folder).select("part", "base")
    extra = [c for c in schema.names if c not in _FILE.names]
    return files.join(own, "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "tokens", *extra)


def read_documents(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """Rows of the documents with ids from ``first`` to ``last``; reads the pages that hold them."""
    return read(spark, folder).where(F.col("doc_id").between(first, last))


def read_span(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """(doc_id, start, tokens) of the ids at positions ``begin`` to ``end`` - 1 of the whole dataset, cut to the span.

    The index names the files; in a file only pages whose documents start before the span's end are read.
    """
    if begin >= end:
        raise ValueError("a span has a position")
    touched = index(spark, folder).where((F.col("base") < end) & (F.col("base") + F.col("tokens") > begin)).collect()
    files = spark.read.schema(_FILE).parquet(f"{folder}/tokens")
    one = F.lit(False)
    base = F.lit(0).cast("long")
    for r in touched[:1] + touched[1:][-1:]:  # the first and last file are cut, those between are whole
        low, high = begin - r["base"], end - r["base"]
        one = one | ((F.col("part") == r["part"]) & (F.col("start") < high) & (F.col("start") + F.col("n_tokens") > low))
    if len(touched) > 2:
        one = one | F.col("part").between(touched[1]["part"], touched[-2]["part"])
    rows = files.where(one).join(index(spark, folder).select("part", "base"), "part").withColumn("start", F.col("base") + F.col("start"))
    skip = F.greatest(F.lit(0), F.lit(begin) - F.col("start"))
    many = F.least(F.col("start") + F.col("n_tokens"), F.lit(end)) - F.col("start") - skip
    return rows.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("tokens", (skip + 1).cast("int"), many.cast("int")).alias("tokens"))


def checksum(column: str) -> Column:
    """Unsigned crc32 of a list of ids as little-endian 32-bit integers."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            data = np.ascontiguousarray(rows.flatten().to_numpy(), "<u4").view(np.uint8)
            ends = np.cumsum(np.append(0, rows.value_lengths().to_numpy())) * 4
            yield pa.array([zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return run(column)


def round_trip(docs: DataFrame, layout: Layout = Layout(), path: str | None = None) -> DataFrame:
    """Writes the documents as a dataset in the shared folder; (doc_id, start, n_tokens, ids_crc32) as read from it."""
    spark = docs.sparkSession
    folder = f"{work_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(docs, folder, layout, path)
    return read(spark, folder).select("doc_id", "start", "n_tokens", checksum("tokens").alias("ids_crc32"))
