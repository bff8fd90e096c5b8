"""Exact duplicates through a cuckoo-filter index of live text digests.

The index is dealt by digest. Each part keeps a cuckoo filter (four 16-bit fingerprints to a bucket) beside
the stored digests, bucketed alike. A fingerprint that is absent proves a digest new; one that is present is
verified against the content of the bucket. When no place is found for a fingerprint, the filter is
rebuilt at twice the size from the stored keys. Digests can be deleted again.

Every task first runs its own rows through such an index, so that a text with very many copies sends a
row per task, not one per copy. Null texts count as empty, and empty texts equal each other. Of rows with
equal texts the largest doc_id stays (a null id only among nulls); repeated rows with that id all say so.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Digests a part of the index should hold.
PART_ROWS = 200_000
#: Digests a task gathers before it passes them on.
FLUSH_ROWS = 200_000
#: Parts that the rows of one text are dealt to when they look up their group.
SALTS = 8

_SLOTS = 4
_KICKS = 200


class CuckooIndex:
    """Live digests with the largest id and the number of rows of each."""

    def __init__(self, buckets: int = 1024) -> None:
        self.size = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = array("H", bytes(2 * _SLOTS * buckets))
        self.content: list[dict] = [{} for _ in range(buckets)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(digest[:8], "little")
        mark = (h >> 48) or 1
        first = h & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995) & self.mask)

    def _slots(self, bucket: int) -> array:
        return self.prints[_SLOTS * bucket : _SLOTS * bucket + _SLOTS]

    def find(self, digest: bytes) -> list | None:
        """[id, rows] of a live digest."""
        mark, first, second = self._places(digest)
        if mark in self._slots(first) or mark in self._slots(second):
            return self.content[first].get(digest)
        return None

    def insert(self, digest: bytes, doc_id: int | None, rows: int) -> None:
        found = self.find(digest)
        if found is not None:
            found[0] = doc_id if found[0] is None else found[0] if doc_id is None else max(found[0], doc_id)
            found[1] += rows
            return
        mark, first, _ = self._places(digest)
        self.content[first][digest] = [doc_id, rows]
        self.size += 1
        if not self._place(mark, first):
            self._grow()

    def _place(self, mark: int, bucket: int) -> bool:
        for kick in range(_KICKS):
            for b in (bucket, self._other(bucket, mark)):
                for slot in range(_SLOTS * b, _SLOTS * b + _SLOTS):
                    if not self.prints[slot]:
                        self.prints[slot] = mark
                        return True
            bucket = b  # full on both sides: push one out, which moves to its other bucket
            slot = _SLOTS * bucket + kick % _SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            bucket = self._other(bucket, mark)
        return False

    def _grow(self) -> None:
        """Twice the buckets, or more, filled again from the stored keys."""
        stored = list(self.entries())
        buckets = self.mask + 1
        placed = False
        while not placed:
            buckets *= 2
            self._empty(buckets)
            placed = True
            for digest, doc_id, rows in stored:
                mark, first, _ = self._places(digest)
                self.content[first][digest] = [doc_id, rows]
                placed = placed and self._place(mark, first)

    def delete(self, digest: bytes) -> bool:
        """Forget a digest; False if it isn't live."""
        if self.find(digest) is None:
            return False
        mark, first, second = self._places(digest)
        del self.content[first][digest]
        self.size -= 1
        for b in (first, second):
            for slot in range(_SLOTS * b, _SLOTS * b + _SLOTS):
                if self.prints[slot] == mark:
                    self.prints[slot] = 0
                    return True
        raise AssertionError("a stored digest has no fingerprint")

    def entries(self) -> Iterator[tuple[bytes, int | None, int]]:
        for bucket in self.content:
            for digest, (doc_id, rows) in bucket.items():
                yield digest, doc_id, rows


INDEX_SCHEMA = "digest binary, keep_id long, rows long"


def _batch(index: CuckooIndex) -> pa.RecordBatch:
    rows = list(index.entries())
    columns = list(zip(*rows)) if rows else [(), (), ()]
    kinds = [pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["digest", "keep_id", "rows"])


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, id, rows) of a task, each digest once unless there are very many."""
    index = CuckooIndex()
    for batch in batches:
        for digest, doc_id, rows in zip(*(c.to_pylist() for c in batch.columns[:3])):
            index.insert(digest, doc_id, rows)
            if index.size >= FLUSH_ROWS:
                yield _batch(index)
                index = CuckooIndex()
    yield _batch(index)


def _part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part of the index: all insertions of its digests, then the deletions."""
    index, gone = CuckooIndex(), []
    for batch in batches:
        for digest, doc_id, rows in zip(*(c.to_pylist() for c in batch.columns)):
            if rows:
                index.insert(digest, doc_id, rows)
            else:
                gone.append(digest)
    for digest in gone:
        index.delete(digest)
    yield _batch(index)


def digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / PART_ROWS))
    return rows.repartition(parts, "digest").mapInArrow(_part, INDEX_SCHEMA)


def _inserts(docs: DataFrame) -> DataFrame:
    own = docs.select(F.unhex(digest(F.col("text"))).alias("digest"), F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).cast("long").alias("rows"))
    return own.mapInArrow(_gather, INDEX_SCHEMA)


def build(docs: DataFrame) -> DataFrame:
    """The index of all texts: digest, keep_id, rows."""
    return _dealt(_inserts(docs), docs.count())


def insert(index: DataFrame, docs: DataFrame) -> DataFrame:
    """The index with more documents."""
    return _dealt(index.select("digest", "keep_id", "rows").unionByName(_inserts(docs)), index.count() + docs.count())


def delete(index: DataFrame, digests: DataFrame) -> DataFrame:
    """The index without the given digests (a binary column ``digest``)."""
    gone = digests.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("rows"))
    return _dealt(index.select("digest", "keep_id", "rows").unionByName(gone), index.count())


def group_documents(docs: DataFrame) -> DataFrame:
    """One row per document: the row of its group that stays, and the size of the group."""
    several = build(docs).where("rows > 1").select(
        F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "rows", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    own = docs.select(
        "doc_id",
        digest(F.col("text")).alias("text_sha256"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    keep = F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return own.join(several, ["text_sha256", "salt"], "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
