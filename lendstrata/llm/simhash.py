"""SimHash near-duplicates: fingerprints, links within a few bits, connected components.

A fingerprint has 64 bits; a bit is 1 if it is set in over half of the hashes of the text's word shingles,
repeats included. Texts with fewer words than a shingle are one shingle; null texts and texts without
a word have fingerprint zero and are linked like others.

Links are found by pigeonring filtering. The bits form a ring of four segments. If two fingerprints
differ in at most d bits, then from some segment on, every chain of l segments differs in at most l * d / 4
bits. Chains of two are the join key: all first segments' bits, and the second's bits up to the difference the
budget leaves, which one side spells out. The longer chains are checked on each candidate before the full distance.
Equal fingerprints are one node, however many documents have them. Candidates are compared within the tasks that get
their keys, and only a spanning forest of the links leaves a task.

A null id takes no part in a group's smallest id: ``group_documents`` gives its row the component_id of the others, or null if
there are none, and ``keep_one`` keeps it. Repeated rows give repeated rows. An empty table gives none. Other columns are not
read by ``group_documents`` and passed on by ``keep_one``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendstrata.llm import text as tx
from lendstrata.llm.components import components, forest
from lendstrata.sources.sinks import materialize

SHINGLE = 3
BITS = 3
SEED = 42
#: Key rows of one task that compares candidates.
PART_ROWS = 2_000_000
#: Candidate pairs compared at once; a key with more is searched from neighbour to neighbour.
PAIRS = 4_000_000
#: Parts that the documents of one fingerprint are dealt to when they look up their component.
SALTS = 8


def shingle_hashes(text: bytes, size: int = SHINGLE, seed: int = SEED) -> bytes:
    """XXH64 of each shingle, 8 bytes each, most significant byte first."""
    found = text.lower().split()  # of bytes: A-Z, and runs of 0x20 and 0x09-0x0D
    if not found:
        return b""
    digest = xxhash.xxh64_digest
    if len(found) <= size:
        return digest(b" ".join(found), seed)
    return b"".join([digest(s, seed) for s in map(b" ".join, zip(*(found[i:] for i in range(size))))])


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    hashes = np.frombuffer(shingle_hashes(text, size, seed), np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(column: str, size: int = SHINGLE) -> Column:
    """Fingerprint of a text as a signed long."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
            found = np.fromiter((fingerprint(t.as_py(), size) for t in texts), np.uint64, len(texts))
            yield pa.array(found.view(np.int64))

    return run(column)


def _segment(x: np.ndarray, i: int) -> np.ndarray:
    return (x >> np.uint64(16 * (i % 4))) & np.uint64(0xFFFF)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _flips(bits: int, least: int = 0) -> np.ndarray:
    """Patterns of up to ``bits`` ones in a segment."""
    return np.array([sum(1 << b for b in c) for k in range(least, bits + 1) for c in combinations(range(16), k)], np.uint64)


def keys(bits: int):
    """Rows (key, node, probe) of the chains of two segments of each node."""
    # Budgets of chains of one and two segments; a chain's first segment must keep the first one.
    one, two = bits // 4, 2 * bits // 4
    firsts, seconds = _flips(one), _flips(two)
    pairs = [(f, s) for f in firsts for s in seconds if int(f).bit_count() + int(s).bit_count() <= two]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(x), 20_000):
                node = x[at : at + 20_000]
                out = []
                for i in range(4):
                    key = (np.uint64(i) << np.uint64(32)) | (_segment(node, i) << np.uint64(16)) | _segment(node, i + 1)
                    out.append((key, node, np.zeros(len(node), bool)))
                    for f, s in pairs:
                        out.append((key ^ ((f << np.uint64(16)) | s), node, np.ones(len(node), bool)))
                columns = [np.concatenate(c) for c in zip(*out)]
                arrays = [pa.array(columns[0].view(np.int64)), pa.array(columns[1].view(np.int64)), pa.array(columns[2])]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "node", "probe"])

    return spell


def _chained(a: np.ndarray, b: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    """Whether all chains from each pair's segment ``first`` on stay within their budgets."""
    apart, ok, total = a ^ b, np.ones(len(a), bool), np.zeros(len(a), np.int64)
    for length in range(1, 5):
        shift = ((first + np.uint64(length - 1)) & np.uint64(3)) * np.uint64(16)
        total += np.bitwise_count((apart >> shift) & np.uint64(0xFFFF))
        ok &= total * 4 <= length * bits
    return ok


def _walk(nodes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all nodes within reach of each other, found from neighbour to neighbour."""
    left, found = nodes, ([], [])
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = _distance(left, x) <= bits
            if near.any():
                new = left[near]
                left = left[~near]
                queue.extend(new)
                found[0].append(np.full(len(new), x, np.uint64))
                found[1].append(new)
    return tuple(np.concatenate(side) if side else np.empty(0, np.uint64) for side in found)


def linked(bits: int):
    """Spanning links (a, b) of the candidates that share a key in this task."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[np.asarray(b.column(0)), np.asarray(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)] for b in batches]
        if not parts:
            return
        key, node, probe = (np.concatenate(c) for c in zip(*parts))
        key, node = key.view(np.uint64), node.view(np.uint64)
        del parts
        order = np.argsort(key[~probe], kind="stable")
        stored_key, stored = key[~probe][order], node[~probe][order]
        probe_key, probes = key[probe], node[probe]
        low = np.searchsorted(stored_key, probe_key, side="left")
        many = np.searchsorted(stored_key, probe_key, side="right") - low
        some = many > 0
        probe_key, probes, low, many = probe_key[some], probes[some], low[some], many[some]

        links: list[tuple[np.ndarray, np.ndarray]] = []
        # Keys whose pairs are very many: all nodes of the key are walked instead.
        groups, at, sizes = np.unique(probe_key, return_inverse=True, return_counts=True)
        work = np.zeros(len(groups), np.int64)
        np.maximum.at(work, at, many)
        heavy = work * sizes > PAIRS
        for g in np.flatnonzero(heavy):
            own = at == g
            members = np.unique(np.concatenate([probes[own], stored[low[own][0] : low[own][0] + many[own][0]]]))
            links.append(_walk(members, bits))
        light = ~heavy[at] if len(at) else np.empty(0, bool)
        probe_key, probes, low, many = probe_key[light], probes[light], low[light], many[light]

        ends = np.cumsum(many)
        first = 0
        while first < len(probes):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
            count = many[first:last]
            inner = np.arange(count.sum()) - np.repeat(ends[first:last] - count - done, count)
            a, b = stored[np.repeat(low[first:last], count) + inner], np.repeat(probes[first:last], count)
            start = np.repeat(probe_key[first:last] >> np.uint64(32), count)
            keep = a < b
            a, b, start = a[keep], b[keep], start[keep]
            keep = _chained(a, b, start, bits)
            a, b = a[keep], b[keep]
            keep = _distance(a, b) <= bits
            if keep.any():
                links.append(forest(a[keep], b[keep]))
            first = last
        if links:
            a, b = forest(*(np.concatenate(side) for side in zip(*links)))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return compare


def links_between(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (a, b) that connect the same nodes as all pairs within ``bits`` bits do. ``nodes``: distinct longs."""
    if not 0 <= bits <= 7:
        raise ValueError("a distance of 0 to 7 bits is supported")
    one, two = bits // 4, 2 * bits // 4
    per_node = 4 * (1 + sum(math.comb(16, i) * math.comb(16, j) for i in range(one + 1) for j in range(two + 1) if i + j <= two))
    parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(nodes.count() * per_node / PART_ROWS))
    spelled = nodes.mapInArrow(keys(bits), "key long, node long, probe boolean")
    return spelled.repartition(parts, "key").mapInArrow(linked(bits), "a long, b long")


def group_documents(docs: DataFrame, bits: int = BITS, size: int = SHINGLE) -> DataFrame:
    """One row per document: fingerprint, and the smallest doc_id that links lead to."""
    tx.bound_batches(docs.sparkSession)
    own = materialize(docs.select("doc_id", fingerprints("text", size).alias("node")), "fingerprints")
    nodes = materialize(own.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("docs")), "nodes")
    roots = components(links_between(nodes.select("node"), bits))
    rooted = materialize(nodes.join(roots, "node", "left").select("node", "least", "docs", F.coalesce("root", "node").alias("root"), F.col("root").isNotNull().alias("linked")), "rooted")
    several = rooted.where("docs > 1 or linked")
    smallest = several.groupBy("root").agg(F.min("least").alias("component_id"))
    table = several.join(smallest, "root").select("node", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = own.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return salted.join(table, ["node", "salt"], "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, bits: int = BITS, size: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest id, columns unchanged; rows without an id stay.

    Groups are those of ``group_documents``. Rows go one by one: of repeated rows of the smallest id one stays, and if that id
    has several texts in the group, the one with the smallest fingerprint, then digest.
    """
    tx.bound_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", fingerprints("text", size).alias("node"))
    rows = materialize(rows.withColumn("digest", F.unhex(F.md5(F.coalesce("row.text", F.lit(""))))), "fingerprinted")
    nodes = materialize(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("docs")), "nodes")
    roots = components(links_between(nodes.select("node"), bits))
    rooted = nodes.join(roots, "node", "left").where("docs > 1 or root is not null").withColumn("root", F.coalesce("root", "node"))
    rooted = materialize(rooted, "rooted")
    kept = rooted.where("least is not null").groupBy("root").agg(F.min(F.struct("least", "node")).alias("kept"))
    table = rooted.join(kept, "root").select("node", F.col("kept.least").alias("kept_id"), (F.col("kept.node") == F.col("node")).alias("own"))
    table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    stay = F.col("kept_id").isNull() | F.col("doc_id").isNull() | (F.col("own") & (F.col("doc_id") == F.col("kept_id")))
    left = materialize(salted.join(table, ["node", "salt"], "left").where(stay).select("row", "doc_id", "node", "digest", "kept_id"), "left")
    # Rows of the kept id and fingerprint: one stays. Only digests meet; the row is taken from its own task's first.
    again = F.col("doc_id").isNotNull() & F.col("kept_id").isNotNull()
    once = left.where(again).groupBy("doc_id", "node").agg(F.min_by("row", "digest").alias("row"))
    return left.where(~again).select("row.*").unionByName(once.select("row.*"))
