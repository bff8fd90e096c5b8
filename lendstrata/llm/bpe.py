"""Byte-level BPE: text to token ids and back.

A text is cut by the tokenizer's split pattern. Words that occur more than once in all documents are encoded once, up
to a bounded number and size of the most frequent ones, and sent to all tasks; any other word is encoded in the row where it
occurs. Either way a fold of Spark's higher-order functions merges the pieces of a word: its state is the array of
pieces and the ranks of neighbouring pairs, and each step joins the leftmost pair with the least rank. Ranks are a literal of
the plan, an array of small maps by hash. A piece is a string with one Latin-1 character for each byte. Words of many
bytes take a fold whose steps join all places of the least pair at once. Decoding puts the bytes of the ids together.

The result is a stored table, after which the words that were sent are released.

Null texts are empty and have no ids; an empty table has no rows. Repeated rows give equal rows. Other columns are passed on, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendstrata.llm import text as tx
from lendstrata.sources.sinks import materialize

RANKS = "byte_bpe_50k.tiktoken"
#: Most words that are encoded beforehand and sent to every task, and most bytes of them.
KNOWN_WORDS = 2_000_000
KNOWN_BYTES = 32 << 20
#: Bytes of a word from which a step joins all places of a pair.
LONG = 200
#: Words of a task counted together.
CHUNK = 500_000

_MAPS = 1 << 15
_NONE = (1 << 31) - 1
#: Borders of a piece in the state of the fold for long words; not Latin-1.
_OPEN, _CLOSE = "Ā", "ā"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def read_ranks(spark, path: str) -> dict[bytes, int]:
    """Ranks by token; each line has a token in base64 and its rank. The vocabulary's size is fixed by the tokenizer."""
    rows = spark.read.text(path).collect() if "://" in path else [(line,) for line in open(path, encoding="ascii")]
    return {base64.b64decode(token): int(rank) for token, rank in (r[0].split() for r in rows if r[0].strip())}


# --- cutting a text by the pattern -------------------------------------------------------------------------------


def character_classes() -> np.ndarray:
    """Class of each code point: white space, letter, number or other."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for low, high in ((0, 0xD800), (0xE000, 0x110000)):
        every = "".join(map(chr, range(low, high)))
        for kind, pattern in ((_SPACE, r"\p{White_Space}+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                kinds[low + m.start() : low + m.end()] = kind
    return kinds


def cut(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tx.Words:
    """The matches of the split pattern, which cover the texts.

    Characters of one class form a run; the last white space before another character is apart and joins that
    character's run if it is a space; a lone apostrophe that no space precedes takes the letters of a contraction.
    """
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    widths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(widths)])
    borders = np.searchsorted(at, offsets)
    kind = kinds[points]
    first = np.zeros(n + 1, bool)
    first[borders] = True  # texts
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    start[n] = True

    space = kind == _SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) if n > 1 else np.empty(0, np.int64)
    start[last] = True
    blank = last[points[last] == 0x20]
    start[blank + 1] = False

    mark = np.flatnonzero(points == 0x27)
    mark = mark[mark + 1 < n]
    spaced = (mark > 0) & (points[mark - 1] == 0x20) & ~first[mark]
    alone = start[mark] & ~spaced & (kind[np.minimum(mark + 1, n - 1)] == _LETTER) & ~first[mark + 1]
    mark = mark[alone]
    if len(mark):
        one = points[mark + 1]
        inside = (mark + 2 < n) & ~first[np.minimum(mark + 2, n)]
        two = np.where(inside, points[np.minimum(mark + 2, n - 1)], 0)
        taken = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            taken = np.where((one == ord(a)) & (two == ord(b)), 2, taken)
        mark, taken = mark[taken > 0], taken[taken > 0]
        start[mark + 1] = False
        start[mark + 1 + taken] = True
    edges = np.flatnonzero(start)
    edges = at[edges]
    starts, ends = edges[:-1], edges[1:]
    return tx.Words(data, starts, ends, np.searchsorted(starts, offsets))


def _identity(w: tx.Words) -> np.ndarray:
    """128 bits for each word, as two columns."""
    first = tx.hashes(w, strong=True)
    second = tx.mix(tx.hashes(w) + np.uint64(0x632BE59BD9B4E019) * (w.ends - w.starts).astype(np.uint64))
    return np.stack([first, second], axis=1)


# --- words that occur often -------------------------------------------------------------------------------------


def _words_of(w: tx.Words) -> pa.Array:
    """The words as an Arrow array over the same bytes, which they cover."""
    edges = np.append(w.starts, len(w.data)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(w.starts), [None, pa.py_buffer(edges), pa.py_buffer(w.data)])


def _counted(kinds: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0)):
                w = cut(data, offsets, kinds)
                if not len(w.starts):
                    continue
                own, at, n = np.unique(_identity(w)[:, 0], return_index=True, return_counts=True)
                kept.append((own, n, _words_of(w).take(pa.array(at))))
                if sum(len(k[0]) for k in kept) >= 2 * CHUNK:
                    kept = [_summed(kept)]
                    if len(kept[0][0]) >= CHUNK:
                        yield pa.RecordBatch.from_arrays([kept[0][2], pa.array(kept[0][1])], ["word", "n"])
                        kept = []
        if kept:
            _, n, names = _summed(kept)
            yield pa.RecordBatch.from_arrays([names, pa.array(n)], ["word", "n"])

    return count


def _summed(kept: list[tuple[np.ndarray, np.ndarray, pa.Array]]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    hashes = np.concatenate([k[0] for k in kept])
    own, at, where = np.unique(hashes, return_index=True, return_inverse=True)
    n = np.bincount(where, np.concatenate([k[1] for k in kept])).astype(np.int64)
    return own, n, pa.concat_arrays([k[2] for k in kept]).take(pa.array(at))


def frequent_words(docs: DataFrame, kinds: np.ndarray, most: int = KNOWN_WORDS, most_bytes: int = KNOWN_BYTES) -> DataFrame:
    """Words that occur more than once, at most ``most`` of at most ``most_bytes``: those with the highest counts over all documents."""
    counts = docs.select("text").mapInArrow(_counted(kinds), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where("n > 1"), "words")
    # Powers of two as limits: the least one that leaves few enough words.
    by_power = counts.groupBy(F.floor(F.log2("n")).alias("power"))
    sizes = {r["power"]: r[1:] for r in by_power.agg(F.count("*"), F.sum(F.octet_length("word"))).collect()}
    total, size, limit = 0, 0, 1 << 62
    for power in sorted(sizes, reverse=True):
        total, size = total + sizes[power][0], size + sizes[power][1]
        if total > most or size > most_bytes:
            break
        limit = 1 << power
    return counts.where(F.col("n") >= limit).select("word")


# --- the fold -------------------------------------------------------------------------------------------------


def _given(spark: SparkSession, value: list, kind: str) -> Column:
    """A literal of a vocabulary's size, as the one value of a local table: plans name it and don't spell it out, wherever they are kept.

    It has to be a column of its own before a higher-order function may use it; the optimizer puts it back where it is used.
    """
    return spark.createDataFrame([(json.dumps(value),)], "value string").select(F.from_json("value", kind)).scalar()


def rank_maps(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: maps from token to rank, by the token's hash."""
    maps: list[dict[str, int]] = [{} for _ in range(_MAPS)]
    for token, rank in ranks.items():
        piece = token.decode("latin-1")
        maps[xxhash.xxh64_intdigest(piece.encode(), 42) & (_MAPS - 1)][piece] = rank
    return _given(spark, maps, "array<map<string,int>>")


def _rank(piece: Column, maps: Column) -> Column:
    own = F.element_at(maps, F.xxhash64(piece).bitwiseAND(F.lit(_MAPS - 1)).cast("int") + 1)
    return F.element_at(own, piece)


def _with(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _merged(word: Column, maps: Column) -> Column:
    """Ids of a word: the state is its pieces and, for each pair of neighbours, the rank of the two together."""
    pieces = F.split(word, "")
    none = F.array().cast("array<int>")

    def pair(a: Column, b: Column) -> Column:
        return F.coalesce(_rank(F.concat(a, b), maps), F.lit(_NONE))

    def begin(p: Column) -> Column:
        ranks = F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: pair(p[i - 1], p[i]))
        return F.struct(p.alias("p"), F.when(F.size(p) > 1, ranks).otherwise(none).alias("r"))

    def join(state: Column, k: Column) -> Column:
        p, r = state["p"], state["r"]

        def put(x: Column) -> Column:
            before = F.when(k > 1, F.concat(F.slice(r, F.lit(1), k - 2), F.array(pair(p[k - 2], x)))).otherwise(none)
            after = F.when(k < F.size(r), F.concat(F.array(pair(x, p[k + 1])), F.slice(r, k + 2, F.size(r)))).otherwise(none)
            joined = F.concat(F.slice(p, F.lit(1), k - 1), F.array(x), F.slice(p, k + 2, F.size(p)))
            return F.struct(joined.alias("p"), F.concat(before, after).alias("r"))

        return _with(F.concat(p[k - 1], p[k]), put)

    def step(state: Column, _: Column) -> Column:
        least = F.coalesce(F.array_min(state["r"]), F.lit(_NONE))
        return _with(least, lambda m: F.when(m == _NONE, state).otherwise(_with(F.array_position(state["r"], m).cast("int"), lambda k: join(state, k))))

    folded = _with(
        pieces,
        lambda p: F.aggregate(F.sequence(F.lit(1), F.size(p)), begin(p), step, lambda s: F.transform(s["p"], lambda x: _rank(x, maps))),
    )
    return folded


def _merged_long(word: Column, maps: Column) -> Column:
    """Ids of a long word: the state is its pieces in one string; a step joins all places of the least pair."""
    wrapped = F.regexp_replace(word, "(?s)(.)", f"{_OPEN}$1{_CLOSE}")

    def pieces(s: Column) -> Column:
        return F.split(F.substring(s, F.lit(2), F.length(s) - 2), _CLOSE + _OPEN)

    def step(state: Column, _: Column) -> Column:
        def least(p: Column) -> Column:
            pairs = F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: F.struct(_rank(F.concat(p[i - 1], p[i]), maps).alias("r"), p[i - 1].alias("a"), p[i].alias("b")))
            return F.when(F.size(p) > 1, F.array_min(F.filter(pairs, lambda x: x["r"].isNotNull())))

        def join(m: Column) -> Column:
            old = F.concat(F.lit(_OPEN), m["a"], F.lit(_CLOSE + _OPEN), m["b"], F.lit(_CLOSE))
            new = F.concat(F.lit(_OPEN), m["a"], m["b"], F.lit(_CLOSE))
            joined = F.struct(F.replace(state["s"], old, new).alias("s"), F.lit(False).alias("done"))
            return F.when(m.isNull(), F.struct(state["s"].alias("s"), F.lit(True).alias("done"))).otherwise(joined)

        return F.when(state["done"], state).otherwise(_with(_with(pieces(state["s"]), least), join))

    start = F.struct(wrapped.alias("s"), F.lit(False).alias("done"))
    steps = F.sequence(F.lit(1), F.length(word))
    return F.aggregate(steps, start, step, lambda s: F.transform(pieces(s["s"]), lambda x: _rank(x, maps)))


def _joined(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def encoded_words(words: Column, maps: Column) -> Column:
    """Ids of each of an array of words (binary)."""

    def ids(word: Column, m: Column) -> Column:
        whole = _rank(word, m)
        return F.when(whole.isNotNull(), F.array(whole)).when(F.length(word) < LONG, _merged(word, m)).otherwise(_merged_long(word, m))

    pieces = F.transform(words, lambda w: F.decode(w, "ISO-8859-1"))
    return _with(maps, lambda m: F.transform(pieces, lambda w: ids(w, m)))


# --- texts ----------------------------------------------------------------------------------------------------


class Known:
    """Ids of the words that are encoded beforehand, by the words' hashes."""

    def __init__(self, words: pa.Array, ids: pa.Array) -> None:
        """``words``: binary, ``ids``: lists of ints."""
        parts = [np.empty((0, 2), np.uint64)]
        for _, _, data, edges in tx.slices(words):
            parts.append(_identity(tx.Words(data, edges[:-1], edges[1:], np.empty(0, np.int64))))
        own = np.concatenate(parts)
        order = np.argsort(own[:, 0], kind="stable")
        self.first, self.second = own[order, 0], own[order, 1]
        many = np.asarray(pc.list_value_length(ids)).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(many)])
        self.start, self.many = cuts[:-1][order].astype(np.int32), many[order].astype(np.int32)
        self.ids = np.asarray(pc.list_flatten(ids)).astype(np.int32)

    @classmethod
    def of(cls, arrays: dict[str, np.ndarray]) -> Known:
        """From what ``vars`` gives, which a broadcast can hold."""
        out = cls.__new__(cls)
        vars(out).update(arrays)
        return out

    def find(self, identity: np.ndarray) -> np.ndarray:
        """Place of each word, or -1."""
        if not len(self.first):
            return np.full(len(identity), -1, np.int64)
        at = np.minimum(np.searchsorted(self.first, identity[:, 0]), len(self.first) - 1)
        return np.where((self.first[at] == identity[:, 0]) & (self.second[at] == identity[:, 1]), at, -1)


_DRAFT = "struct<ids: array<int>, words: array<binary>>"


def _draft(known, kinds):
    """Ids of a text's known words; -1 - i stands for the i-th of the other words."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Known.of(known.value)
        for texts in batches:
            sizes, ids, word_sizes, words = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)], [pa.array([], pa.binary())]
            for first, last, data, offsets in tx.slices(texts):
                w = cut(data, offsets, kinds.value)
                own, at, where = np.unique(_identity(w)[:, 0], return_index=True, return_inverse=True)
                del own
                some = tx.Words(data, w.starts[at], w.ends[at], np.empty(0, np.int64))
                place = lookup.find(_identity(some))[where] if len(at) else np.empty(0, np.int64)
                new = place < 0
                many = np.where(new, 1, lookup.many[place] if len(lookup.many) else 1)
                total = np.cumsum(many)
                begin = total - many
                out = np.empty(int(total[-1]) if len(total) else 0, np.int32)
                # Other words: numbered within their text.
                seen = np.concatenate([[0], np.cumsum(new)])
                owner = w.owners()
                out[begin[new]] = -1 - (seen[:-1] - seen[w.bounds[owner]])[new]
                old = ~new
                if old.any():
                    step = np.arange(int(many[old].sum())) - np.repeat(np.cumsum(many[old]) - many[old], many[old])
                    out[np.repeat(begin[old], many[old]) + step] = lookup.ids[np.repeat(lookup.start[place[old]], many[old]) + step]
                ids.append(out)
                edges = np.concatenate([[0], total])[w.bounds]
                sizes.append(np.diff(edges))
                word_sizes.append(np.diff(seen[w.bounds]))
                words.append(_words_of(w).take(pa.array(np.flatnonzero(new))))
            columns = [
                pa.ListArray.from_arrays(_edges(sizes), pa.array(np.concatenate(ids))),
                pa.ListArray.from_arrays(_edges(word_sizes), pa.concat_arrays(words)),
            ]
            yield pa.StructArray.from_arrays(columns, ["ids", "words"])

    return F.arrow_udf(run, _DRAFT).asNondeterministic()  # computed once, apart from what uses it


def _edges(sizes: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32))


def _filled(drafts: pa.Array, others: pa.Array) -> pa.Array:
    """The draft's ids with those of the other words in their places."""
    out, sizes = [], []
    for draft, own in zip(drafts, others):
        ids = draft.values.to_numpy()
        if len(own):
            extra = [np.asarray(x) for x in own.values]
            marks = np.flatnonzero(ids < 0)
            parts, at = [], 0
            for m in marks.tolist():
                parts += [ids[at:m], extra[-1 - ids[m]]]
                at = m + 1
            ids = np.concatenate([*parts, ids[at:]])
        out.append(ids.astype(np.int32))
        sizes.append(len(ids))
    return pa.ListArray.from_arrays(_edges([np.array(sizes, np.int64)]), pa.array(np.concatenate([np.empty(0, np.int32), *out])))


def _known(words: DataFrame, maps: Column) -> Known:
    """The encoded words; the driver keeps nothing but the arrays that are sent."""
    done = words.select("word", maps.alias("maps")).select("word", F.element_at(encoded_words(F.array("word"), F.col("maps")), 1).alias("ids")).toArrow()
    out = Known(_joined(done["word"]), _joined(done["ids"]))
    del done
    pa.default_memory_pool().release_unused()
    return out


def _drafted(docs: DataFrame, row: Column, path: str | None, known: int) -> tuple[DataFrame, list[Broadcast]]:
    """row, the ids of known words with places for the others, and the ids of the others; and what was sent to the tasks."""
    spark = docs.sparkSession
    tx.bound_batches(spark)
    maps = rank_maps(spark, read_ranks(spark, path or public_tokenizers.path(RANKS)))
    kinds = character_classes()
    words = frequent_words(docs, kinds, known)
    shared = [spark.sparkContext.broadcast(x) for x in (vars(_known(words, maps)), kinds)]
    drafts = docs.select(row.alias("row"), _draft(*shared)("text").alias("d"))
    parts = drafts.select("row", F.col("d.ids").alias("draft"), F.col("d.words").alias("words"), maps.alias("maps"))
    return parts.select("row", "draft", encoded_words(F.col("words"), F.col("maps")).alias("others")), shared


def _stored(done: DataFrame, shared: list[Broadcast]) -> DataFrame:
    """The rows as a stored table, so that neither the driver nor the executors hold the known words any longer."""
    out = materialize(done, "encoded")
    for b in shared:
        b.destroy()
    return out


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _filled(batch.column(1), batch.column(2))], ["row", "ids"])


def _with_ids(row: T.StructField) -> T.StructType:
    return T.StructType([row, T.StructField("ids", T.ArrayType(T.IntegerType()))])


def encode(docs: DataFrame, path: str | None = None, known: int = KNOWN_WORDS) -> DataFrame:
    """Columns row (as it came) and ids, for the ranks in the file at ``path``."""
    drafted, shared = _drafted(docs, F.struct("*"), path, known)
    return _stored(drafted.mapInArrow(_fill, _with_ids(drafted.schema["row"])), shared)


class Decoder:
    """The bytes of ids: those of their tokens, put together."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.many, self.data = ends - self.starts, np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        many = self.many[ids]
        place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        return self.data[np.repeat(self.starts[ids], many) + place].tobytes()


def decode(column: str, ranks: dict[bytes, int]) -> Column:
    """The bytes of an array of ids; null if there is none."""

    @F.arrow_udf("binary")
    def join(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Decoder(ranks)
        for rows in batches:
            yield pa.array([own(r.values.to_numpy()) if r.is_valid else None for r in rows], pa.binary())

    return join(column)


def _digested(ranks: dict[bytes, int]):
    """row, ids, their number and digest, and the digest of the bytes decoded from them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder(ranks)
        for batch in _fill(batches):
            rows = [r.values.to_numpy() for r in batch.column(1)]
            columns = [
                *batch.columns,
                pa.array([len(r) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(own(r)).hexdigest() for r in rows], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    return read


def _round_trip(docs: DataFrame, row: Column, path: str | None, *columns: str) -> DataFrame:
    """Encoded and decoded in one step, so that a task has no more Python workers than it needs; the named columns."""
    ranks = read_ranks(docs.sparkSession, path or public_tokenizers.path(RANKS))
    drafted, shared = _drafted(docs, row, path, KNOWN_WORDS)
    schema = _with_ids(drafted.schema["row"]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return _stored(drafted.mapInArrow(_digested(ranks), schema).select(*columns), shared)


def digest_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: number of ids, digests of the ids and of the bytes decoded from them."""
    row = F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    return _round_trip(docs, row, path, "row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def _put_together(draft: Column, others: Column) -> Column:
    """The draft's ids with those of the other words in their places."""
    return F.flatten(F.transform(draft, lambda x: F.when(x < 0, F.get(others, -1 - x)).otherwise(F.array(x))))


def decoded(ids: Column, pieces: Column) -> Column:
    """The bytes of ids: their pieces, which have one character for each byte, joined."""
    return F.encode(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""), "ISO-8859-1")


def vocabulary(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The pieces by id, as a literal."""
    pieces = [""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    return _given(spark, pieces, "array<string>")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and the digest of the text decoded from the ids.

    Ids are put together and decoded by Spark's functions, so that a task has one Python worker.
    """
    ranks = read_ranks(docs.sparkSession, path or public_tokenizers.path(RANKS))
    drafted, shared = _drafted(docs, F.struct("doc_id", "lang", "source"), path, KNOWN_WORDS)

    def facts(ids: Column, pieces: Column) -> Column:
        digest = F.sha2(decoded(ids, pieces), 256)
        return F.struct(ids.alias("ids"), F.size(ids).cast("long").alias("n_tokens"), digest.alias("decoded_sha256"))

    # Bound first: in a lambda, the folds of the other words would be run for each of them.
    given = drafted.select("*", vocabulary(docs.sparkSession, ranks).alias("pieces"))
    bound = F.struct("draft", "others", "pieces")
    own = _with(bound, lambda s: _with(_put_together(s["draft"], s["others"]), lambda ids: facts(ids, s["pieces"])))
    done = given.select("row", own.alias("x"))
    return _stored(done.select("row.doc_id", "row.lang", "row.source", "x.ids", "x.n_tokens", "x.decoded_sha256"), shared)
