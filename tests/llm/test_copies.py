"""Exact, near and partial copies against brute force."""

import hashlib
import random
import re
from collections import Counter

import messy
import numpy as np
import pytest
import xxhash

from lendstrata.llm import components, exact, simhash, substrings


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact copies


def brute_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    out = []
    for r in rows:
        ids = groups[r["text"] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r["doc_id"], keep, len(ids), r["doc_id"] == keep, sha(r["text"] or "")))
    return Counter(out)


def test_exact_groups(spark):
    docs = messy.documents(spark)
    assert Counter(map(tuple, exact.group_documents(docs).collect())) == brute_groups(docs.collect())
    assert exact.group_documents(messy.empty(spark)).count() == 0


def test_cuckoo_index_grows_and_forgets():
    index = exact.CuckooIndex(buckets=2)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(5000)]
    for i, d in enumerate(digests):
        index.insert(d, i, 1)
    index.insert(digests[7], 99_999, 2)
    assert index.size == 5000 and index.find(digests[7]) == [99_999, 3]
    assert index.mask + 1 >= 1024
    for d in digests[::2]:
        assert index.delete(d)
    assert not index.delete(digests[0])
    assert index.size == 2500
    assert all((index.find(d) is None) == (i % 2 == 0) for i, d in enumerate(digests))
    index.insert(digests[0], 1, 1)
    assert index.find(digests[0]) == [1, 1]


def test_index_table_takes_insertions_and_deletions(spark):
    docs = messy.documents(spark)
    first, second = docs.where("doc_id < 7"), docs.where("doc_id >= 7 or doc_id is null")
    want = {tuple(r) for r in exact.build(docs).collect()}
    both = exact.insert(exact.build(first), second)
    assert {tuple(r) for r in both.collect()} == want
    gone = spark.createDataFrame([(bytearray(hashlib.sha256(b"one").digest()),), (bytearray(b"unknown"),)], "digest binary")
    left = {tuple(r) for r in exact.delete(both, gone).collect()}
    assert left == {w for w in want if bytes(w[0]) != hashlib.sha256(b"one").digest()}


# --- near copies


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits):
    label = list(range(len(fps)))
    x = np.array(fps, np.uint64)

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= bits):
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_groups(spark):
    docs = messy.documents(spark).where("doc_id is not null")
    rows = docs.collect()
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.group_documents(docs).collect()}
    ids = sorted({r["doc_id"] for r in rows})
    text = {r["doc_id"]: r["text"] for r in rows}
    fps = [brute_fingerprint(text[i]) for i in ids]
    roots = brute_components(fps, 3)
    assert got == {i: (f"{f:016x}", ids[r]) for i, f, r in zip(ids, fps, roots)}
    assert got[0][1] == got[1][1] == got[2][1] == 0 and got[8][1] == got[9][1] == 8


def test_keep_one(spark):
    docs = messy.documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 in ids and 1 not in ids and 9 not in ids and ids.count(None) == 2
    assert simhash.keep_one(messy.empty(spark)).count() == 0
    assert simhash.group_documents(messy.empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [0, 3, 5, 7])
@pytest.mark.parametrize("pairs", [4_000_000, 3])
def test_links_connect_the_same_nodes(spark, monkeypatch, bits, pairs):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    rng = random.Random(bits)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            fps.add(x)
            for b in rng.sample(range(64), rng.randrange(0, 9)):
                x ^= 1 << b
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    links = simhash.links_between(spark.createDataFrame([(s,) for s in signed], "node long"), bits)
    for a, b in links.collect():
        assert a != b
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = brute_components(fps, bits)
    groups = {}
    for s, w in zip(signed, want):
        groups.setdefault(w, []).append(s)
    assert got == {s: min(g) for g in groups.values() if len(g) > 1 for s in g}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(301)} | {2000: 2000, 2001: 2000}


# --- repeated passages


def brute_repeats(rows, window=35):
    words = [re.findall(r"[^\x20\x09-\x0d]+", r["text"] or "") for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((r["doc_id"], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return Counter(out)


def test_repeats_in_awkward_rows(spark):
    docs = messy.documents(spark)
    assert Counter(map(tuple, substrings.digest_repeats(docs).collect())) == brute_repeats(docs.collect())
    assert substrings.digest_repeats(messy.empty(spark)).count() == 0
    assert substrings.remove_repeats(docs).select("row.*").columns == docs.columns


@pytest.mark.parametrize("frequent, chunk", [(500, 1 << 20), (2, 50), (3, 1 << 20), (2, 1 << 20)])
def test_repeats_on_all_paths(spark, monkeypatch, frequent, chunk):
    monkeypatch.setattr(substrings, "FREQUENT", frequent)
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rng = random.Random(chunk + frequent)
    passages = [[rng.choice("abc") for _ in range(rng.randrange(20, 90))] for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40))] for _ in range(5)]
        rows.append((i, " ".join(w for p in parts for w in p)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, substrings.digest_repeats(docs).collect())) == brute_repeats(docs.collect())
