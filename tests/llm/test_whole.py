"""Cases that earlier versions cut short."""

import hashlib
import random
from collections import Counter

import numpy as np
from test_copies import brute_components, brute_fingerprint
from test_rows import brute_neighbours, found_by_query, recall

from lendstrata.llm import neighbours, simhash


def test_repeated_rows_do_not_push_out_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x) for _ in range(2)] + [(1, x[0].tolist())] * 20
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got, want = found_by_query(neighbours.search_hundredths(df)), brute_neighbours(rows)
    assert {q: len(found) for q, found in got.items()} == {0: 10, 100: 10, 200: 10}
    assert recall(got, want) >= 0.9


def test_block_takes_the_nearest_ids_not_rows():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(100, 4))
    best = neighbours.Best(10)
    best.compare(np.array([0]), x[:1], np.repeat(np.arange(100), 12), np.repeat(x, 12, axis=0))
    far = np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    assert best.found[0][1].tolist() == np.argsort(far)[1:11].tolist()


def test_near_copies_leave_one_of_each_group(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(5000)}" for _ in range(400)]
        rows.append((3 * i, " ".join(words)))
        for extra, edits in ((1, 1), (2, 1 + i % 40)):
            copy = list(words)
            for at in rng.sample(range(400), edits):
                copy[at] = "edited"
            rows.append((3 * i + extra, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    roots = brute_components([brute_fingerprint(t) for _, t in rows], 3)
    left = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert left == [i for i, root in enumerate(roots) if i == root] and 120 <= len(left) < 300


def test_large_group_of_copies_leaves_one(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = [(i, "  ".join(words[:200] + ["\t"] * (i % 9) + words[200:]).upper() if i % 2 else " ".join(words)) for i in range(3, 900)]
    assert [r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [3]


def test_near_duplicates_go_by_row(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text), (1, text), (1, text.upper()), (2, text + " \n"), (2, "another text without a copy of it"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = min((text, text.upper()), key=lambda t: hashlib.md5(t.encode()).digest())
    assert Counter(map(tuple, simhash.keep_one(docs).collect())) == Counter({(1, one): 1, rows[4]: 1, rows[5]: 1})
