"""Words of whole Arrow batches, found and hashed byte by byte with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text handled at once; a longer text is a slice of its own. Working arrays take some 60 times as much.
SLICE_BYTES = 250_000
LARGE_SLICE = 2_000_000

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_BLOCK = 1 << 16


class Words(NamedTuple):
    """Words of consecutive texts. Words of text i are ``bounds[i]:bounds[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


class _Kept(dict):
    """Tables that a task builds once; they don't travel."""

    def __reduce__(self):
        return _Kept, ()


_POWERS = _Kept()


def _classes(punctuation: bool) -> np.ndarray:
    """Class of each byte: 0 white space, 1 word; with ``punctuation`` each mark is a class of its own."""
    table = np.ones(256, np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    if punctuation:
        for b in range(0x21, 0x80):
            if not chr(b).isalnum():
                table[b] = b
    return table


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of whole texts of about ``limit`` bytes; null texts are empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(len(texts), max(last, first + 1))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, punctuation: bool = False) -> Words:
    """Runs of bytes of one class, white space left out; none crosses the end of a text.

    Without ``punctuation`` these are the matches of ``[^\\x20\\x09-\\x0D]+``.
    """
    kinds = _classes(punctuation)[data]
    change = np.ones(len(data) + 1, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=change[1:-1])
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    keep = kinds[starts] != 0 if len(starts) else np.empty(0, bool)
    starts, ends = starts[keep], ends[keep]
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(factor: int, n: int) -> np.ndarray:
    if len(_POWERS.get(factor, ())) < n:
        out = np.ones(n, np.uint64)
        out[1:] = np.uint64(factor)
        _POWERS[factor] = np.multiply.accumulate(out)
    return _POWERS[factor]


def hashes(w: Words, limit: int | None = None, strong: bool = False) -> np.ndarray:
    """64-bit hash of each word, or of its first ``limit`` bytes; ``strong`` mixes two independent ones."""
    ends = w.ends if limit is None else np.minimum(w.ends, w.starts + limit)
    out = None
    for factor in _FACTORS[: 1 + strong]:
        h = _polynomial(w.data, w.starts, ends, factor)
        out = mix(h) if out is None else mix(out ^ (mix(h) << np.uint64(1)))
    return out


def _polynomial(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: int) -> np.ndarray:
    """Sum of (byte + 1) * factor^i over a word, from running sums over all bytes."""
    size = 1 << max(16, int(len(data)).bit_length())
    inverse = pow(factor, -1, 1 << 64)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(factor, size)[: len(data)], out=running[1:])
    return (running[ends] - running[starts]) * _powers(inverse, size)[starts]


def bound_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Fewer texts in an Arrow batch than the default of 10,000, which whole texts make too large for a worker.

    The setting is the session's, and is left alone if it isn't the default; results don't depend on it.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, str(rows))


def text_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))
