"""Substring dedup: every word is removed that is covered by a window of words that starts anywhere else too.

Words are ``[^\\x20\\x09-\\x0D]+``; a window is 35 consecutive words of one text. The windows of a text are cut
into segments that share a pick: of the 8-word sequences in a window, the leftmost one with the least hash. Equal windows have equal
picks at different places, so a pick occurs at least as often as each window of its segment.

First pass: every task counts its picks in a count-min sketch, and the sketches are merged page by page. Its size
follows the input up to a fixed bound, so it can be sent to all tasks. Second pass: windows whose pick the sketch estimates to
occur once are unique. The others are grouped exactly, by 128 bits of hash: a segment travels with the hashes of its windows to
the task of its pick. Windows of very frequent picks travel one by one to the task of their own hash. A task sends a
window that it has seen itself more than once only once. An estimate is never too low, so no repeated window is
lost; a larger input than the bound is made for only means more windows in the second pass.

Null texts have no words and give an empty text. Texts shorter than a window keep all words. Repeated rows repeat each other's windows, so
those of a window's length or more lose all words. Columns other than doc_id and text are passed on, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.llm import text as tx

WINDOW = 35
PICK = 8
#: Rows of the sketch, and the bounds of its cells per row.
DEPTH = 2
CELLS = (1 << 20, 1 << 28)
PAGE = 1 << 16
#: Estimated count from which a pick's windows travel one by one.
FREQUENT = 500
#: Windows that a task compares before it sends them on.
CHUNK = 1 << 20
#: Windows of a task that groups.
PART_WINDOWS = 1_500_000

_BASES = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))


def _rolled(w: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Hash of each run of ``length`` elements, joined from runs of powers of two."""
    out, done = None, 0
    part, size = w, 1
    while done < length:
        if length & size:
            if out is None:
                out = part
            else:  # what is there covers ``done`` elements; the next ``size`` follow
                n = len(w) - done - size + 1
                out = out[:n] * _power(base, size) + part[done : done + n]
            done += size
        if done < length:
            n = max(0, len(part) - size)
            part, size = part[:n] * _power(base, size) + part[size : size + n], 2 * size
    return tx.mix(out)


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _picks(g: np.ndarray, span: int) -> np.ndarray:
    """Place of the leftmost least element in each run of ``span``."""
    at, size = np.arange(len(g)), 1
    while 2 * size <= span:
        left, right = at[: len(at) - size], at[size:]
        at, size = np.where(g[left] <= g[right], left, right), 2 * size
    if size < span:
        left, right = at[: len(at) - (span - size)], at[span - size :]
        at = np.where(g[left] <= g[right], left, right)
    return at


class Segments:
    """Segments of a slice of texts: text, first window, number of windows and pick of each; hashes of all windows."""

    def __init__(self, w: tx.Words, window: int, pick: int) -> None:
        self.first = np.empty(0, np.int64)
        n = len(w.starts)
        if n < window:
            return
        own = tx.hashes(w, strong=True)
        grams = _rolled(own, pick, _BASES[0])
        at = _picks(grams, window - pick + 1)
        owner = w.owners()
        inside = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
        if not len(inside):
            return
        at = at[inside]
        cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.first = inside[cut]
        self.many = np.diff(np.append(cut, len(inside)))
        self.pick = grams[at[cut]]
        self.text = owner[self.first]
        self.start = self.first - w.bounds[self.text]
        self.windows = [_rolled(own, window, base) for base in _BASES]


def _segments(batches: Iterator[pa.RecordBatch], window: int, pick: int):
    for batch in batches:
        for first, _, data, offsets in tx.slices(tx.text_of(batch, "text"), tx.LARGE_SLICE):
            s = Segments(tx.words(data, offsets), window, pick)
            if len(s.first):
                yield batch, first, s


def _cells(picks: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (tx.mix(picks + np.uint64((row + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(cells - 1)).astype(np.int64)


def _sketch(cells: int, window: int, pick: int):
    """Counts of a task's picks, as pages of (cell, count)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for _, _, s in _segments(batches, window, pick):
            kept.append(s.pick)
            size += len(s.pick)
            if size >= 4 * CHUNK:
                yield from _pages(np.concatenate(kept), cells)
                kept, size = [], 0
        if kept:
            yield from _pages(np.concatenate(kept), cells)

    return count


def _pages(picks: np.ndarray, cells: int) -> Iterator[pa.RecordBatch]:
    for row in range(DEPTH):
        own, n = np.unique(_cells(picks, row, cells), return_counts=True)
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] // PAGE != own[:-1] // PAGE]))
        pages = own[cuts] // PAGE + row * (cells // PAGE)
        places, n = (own % PAGE).astype(np.uint16), np.minimum(n, 0xFFFF).astype(np.uint16)
        parts = [[x.tobytes() for x in np.split(a, cuts[1:])] for a in (places, n)]
        yield pa.RecordBatch.from_arrays([pa.array(pages), *(pa.array(p, pa.binary()) for p in parts)], ["page", "places", "counts"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit per cell for an estimate of at least 2, and one for a frequent pick."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for page, places, counts in zip(*(c.to_pylist() for c in batch.columns)):
            own = total.setdefault(page, np.zeros(PAGE, np.uint16))
            at = np.frombuffer(places, np.uint16)
            own[at] = np.minimum(own[at].astype(np.int64) + np.frombuffer(counts, np.uint16), 0xFFFF)
    for page, own in total.items():
        if (own >= 2).any():
            bits = [np.packbits(own >= least).tobytes() for least in (2, FREQUENT)]
            yield pa.RecordBatch.from_arrays([pa.array([page]), *(pa.array([b], pa.binary()) for b in bits)], ["page", "several", "frequent"])


def sketch(docs: DataFrame, cells: int, window: int = WINDOW, pick: int = PICK) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the merged sketch: picks estimated to occur at least twice, and frequent ones."""
    parts = docs.select("text").mapInArrow(_sketch(cells, window, pick), "page long, places binary, counts binary")
    merged = parts.repartition("page").mapInArrow(_merge, "page long, several binary, frequent binary")
    several, frequent = (np.zeros(DEPTH * cells // 8, np.uint8) for _ in range(2))
    for row in merged.toLocalIterator():
        at = row["page"] * (PAGE // 8)
        several[at : at + PAGE // 8] = np.frombuffer(row["several"], np.uint8)
        frequent[at : at + PAGE // 8] = np.frombuffer(row["frequent"], np.uint8)
    return several, frequent


def _estimated(picks: np.ndarray, bits: np.ndarray, cells: int) -> np.ndarray:
    found = np.ones(len(picks), bool)
    for row in range(DEPTH):
        at = _cells(picks, row, cells) + row * cells
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 != 0
    return found


ROWS = "key long, doc_id long, text_hash long, start int, known int, present int, twice int, hashes binary"


class _Chunk:
    """Candidate segments of a task, gathered until there are enough windows."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch, first: int, s: Segments, candidate: np.ndarray, single: np.ndarray) -> None:
        own = np.flatnonzero(candidate)
        if not len(own):
            return
        many = s.many[own]
        which = np.repeat(np.arange(len(own)), many)
        place = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        at = np.repeat(s.first[own], many) + place
        rows = first + s.text[own]
        ids = batch.column(0).take(pa.array(rows))
        null = np.asarray(ids.is_null())
        doc_id = np.asarray(pc.fill_null(ids, 0))
        marks = np.asarray(batch.column(1))[rows]
        offset = sum(len(p[0]) for p in self.parts)
        self.parts.append((doc_id, null, marks, s.start[own], s.pick[own], single[own], which + offset, place, s.windows[0][at], s.windows[1][at]))
        self.size += len(which)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        doc_id, null, marks, start, pick, single, which, place, h, h2 = (np.concatenate(c) for c in zip(*self.parts))
        self.__init__()
        order = np.lexsort([h2, h])
        same = (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])
        lead = np.concatenate([[True], ~same])
        several = np.empty(len(h), bool)
        several[order] = ~lead | np.append(~lead[1:], False)
        send = np.empty(len(h), bool)
        send[order] = lead
        bit = np.left_shift(1, place)
        known = np.bincount(which, bit * several, minlength=len(doc_id)).astype(np.int64)

        # Whole segments: the hashes of their windows go to the task of the pick.
        whole = send & ~single[which]
        present = np.bincount(which, bit * whole, minlength=len(doc_id)).astype(np.int64)
        twice = np.bincount(which, bit * (whole & several), minlength=len(doc_id)).astype(np.int64)
        cuts = np.cumsum(np.bincount(which[whole], minlength=len(doc_id)))
        data = h[whole].tobytes()
        edges = 8 * np.concatenate([[0], cuts])
        hashes = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        spread = tx.mix(marks.view(np.uint64) ^ start.astype(np.uint64))
        key = np.where(present > 0, pick, spread)
        some = np.flatnonzero((present > 0) | (known > 0))
        yield _batch(key, doc_id, null, marks, start, known, present, twice, hashes, some)

        # Windows of frequent picks: one by one to the task of their own hash.
        own = np.flatnonzero(send & single[which])
        if len(own):
            seg, zero, one = which[own], np.zeros(len(own), np.int64), np.ones(len(own), np.int64)
            data = [x.tobytes() for x in h2[own]]
            yield _batch(h[own], doc_id[seg], null[seg], marks[seg], start[seg] + place[own], zero, one, several[own].astype(np.int64), data, np.arange(len(own)))


def _batch(key, doc_id, null, marks, start, known, present, twice, hashes, some) -> pa.RecordBatch:
    columns = [
        pa.array(key.view(np.int64)[some]),
        pa.array(doc_id[some], mask=null[some]),
        pa.array(marks[some]),
        *(pa.array(x[some].astype(np.int32)) for x in (start, known, present, twice)),
        pa.array([hashes[i] for i in some.tolist()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ROWS.split(", ")])


def _candidates(several, frequent, cells: int, window: int, pick: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch, first, s in _segments(batches, window, pick):
            candidate = _estimated(s.pick, several.value, cells)
            chunk.add(batch, first, s, candidate, _estimated(s.pick, frequent.value, cells))
            if chunk.size >= CHUNK:
                yield from chunk.flush()
        yield from chunk.flush()

    return send


MARKS = "doc_id long, text_hash long, start int, mask int"


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which windows of the segments of this task occur more than once."""
    parts = list(batches)
    if not parts:
        return
    rows = pa.Table.from_batches(parts).combine_chunks()
    del parts
    key, present, twice, known = (np.asarray(rows.column(c)) for c in ("key", "present", "twice", "known"))
    h = np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint64)
    many = np.bitwise_count(present.astype(np.uint32)).astype(np.int64)
    which = np.repeat(np.arange(len(key)), many)
    # The n-th hash of a row belongs to the n-th bit of ``present``.
    bits = np.unpackbits(present.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    place = np.nonzero(bits)[1]
    bit = np.left_shift(np.int64(1), place)
    weight = 1 + ((twice[which] & bit) != 0)
    order = np.lexsort([h, key[which]])
    k, s = key[which][order], h[order]
    edges = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])) if len(s) else np.empty(0, np.int64)
    again = np.zeros(len(s), bool)
    if len(s):
        total = np.add.reduceat(weight[order], edges)
        again[order] = np.repeat(total >= 2, np.diff(np.append(edges, len(s))))
    mask = known.astype(np.int64) | np.bincount(which, bit * again, minlength=len(key)).astype(np.int64)
    some = pa.array(np.flatnonzero(mask))
    found = [rows.column(c).take(some).combine_chunks() for c in ("doc_id", "text_hash", "start")]
    yield pa.RecordBatch.from_arrays([*found, pa.array(mask[mask != 0].astype(np.int32))], [c.split()[0] for c in MARKS.split(", ")])


def repeated(docs: DataFrame, window: int = WINDOW, pick: int = PICK) -> DataFrame:
    """(doc_id, text_hash, start, mask): repeated windows start at ``start`` + each bit of ``mask``. ``docs``: those and text."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    words = size / 6
    cells = min(CELLS[1], max(CELLS[0], 1 << math.ceil(math.log2(max(1, words / 2)))))
    several, frequent = (spark.sparkContext.broadcast(bits) for bits in sketch(docs, cells, window, pick))
    rows = docs.select("doc_id", "text_hash", "text").mapInArrow(_candidates(several, frequent, cells, window, pick), ROWS)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(words / PART_WINDOWS))
    return rows.repartition(parts, "key").mapInArrow(_group, MARKS)


def _kept(window: int):
    """(words, removed words, text of the words that are left) from a text and its repeated windows."""

    def run(texts: pa.Array, marks: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(pc.fill_null(texts.cast(pa.large_binary()), b""), marks):
            found = text.as_py().split()
            gone = None
            if own.is_valid and len(own):
                cover = np.zeros(len(found) + 1, np.int64)
                start = np.asarray(own.values.field("start"))
                mask = np.asarray(own.values.field("mask")).astype("<u4")
                bits = np.unpackbits(mask.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
                row, place = np.nonzero(bits)
                first = np.unique(start[row].astype(np.int64) + place)
                np.add.at(cover, first, 1)
                np.add.at(cover, first + window, -1)
                gone = np.cumsum(cover[:-1]) > 0
            left = found if gone is None else compress(found, (~gone).tolist())
            rows.append((len(found), 0 if gone is None else int(gone.sum()), b" ".join(left).decode()))
        names, kinds = ["n_words", "n_removed", "kept"], [pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*rows)) if rows else [()] * 3
        return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return F.arrow_udf(run, "struct<n_words: long, n_removed: long, kept: string>")


def remove_repeats(docs: DataFrame, window: int = WINDOW, pick: int = PICK) -> DataFrame:
    """Columns row (as it came), n_words, n_removed and kept (the words that are left, joined by spaces)."""
    if not pick <= window <= pick + 30:
        raise ValueError("a segment must not have more than 31 windows")
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marks = repeated(own.select("doc_id", "text_hash", "text"), window, pick)
    per_text = marks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "mask")).alias("marks"))
    per_text = per_text.select(F.col("doc_id").alias("m_doc_id"), F.col("text_hash").alias("m_text_hash"), "marks")
    both = own.join(per_text, F.col("doc_id").eqNullSafe(F.col("m_doc_id")) & (F.col("text_hash") == F.col("m_text_hash")), "left")
    done = both.select("row", _kept(window)("text", "marks").alias("d"))
    return done.select("row", "d.n_words", "d.n_removed", "d.kept")


def digest_repeats(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs.select("doc_id", "text"))
    return done.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
