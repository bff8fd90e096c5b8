"""Lines, mixing, neighbours, chat and token ids against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import messy
import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from lendstrata.llm import bpe, chat, lines, mixing, neighbours, queries
from lendstrata.llm import text as tx


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines


def brute_lines(rows, ratio, distinct=False):
    """Texts without the lines that are on two pages at least and on more than a share of their host's."""
    pages, seen = defaultdict(set), defaultdict(set)
    for i, (host, text) in enumerate(rows):
        if text is not None:
            page = text if distinct else i
            pages[host or ""].add(page)
            for line in set(text.split("\n")):
                seen[host or "", line].add(page)
    gone = {k for k, v in seen.items() if k[1] and len(v) >= 2 and len(v) > ratio * len(pages[k[0]])}
    return [None if t is None else "\n".join(x for x in t.split("\n") if (h or "", x) not in gone) for h, t in rows]


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("sent, hosts", [(100_000, 100_000), (-1, 100_000), (-1, -1)])
def test_lines_that_many_pages_have(spark, monkeypatch, sent, hosts, distinct):
    monkeypatch.setattr(lines, "SENT_LINES", sent)
    monkeypatch.setattr(lines, "SENT_HOSTS", hosts)
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), "\n".join(rng.choice(["", "menu", "© é", f"body {rng.randrange(900)}"]) for _ in range(6))) for _ in range(150)]
    rows += [("c", "only page")] + [("d", "copied page\nof many")] * 30 + [("d", f"page {i}") for i in range(9)] + [("a", None), (None, None), ("a", "")]
    rows += [("e", f"banner\nown {i}") for i in range(4)] + [("f", "twice"), ("f", "twice"), ("f", "once\nonce")]
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3)
    got = {r["row"]["doc_id"]: r["text"] for r in lines.drop_lines(docs, F.col("source"), F.col("text"), 0.3, distinct).collect()}
    want = brute_lines(rows, 0.3, distinct)
    assert got == dict(enumerate(want))
    assert got[150] == "only page" and got[151] == ("copied page\nof many" if distinct else "")
    assert [got[193 + i] for i in range(4)] == [f"own {i}" for i in range(4)]
    assert got[197] == ("twice" if distinct else "") and got[199] == "once\nonce"


@pytest.mark.parametrize("sent", [100_000, -1])
def test_lines_of_awkward_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(lines, "SENT_LINES", sent)
    docs = messy.documents(spark)
    out = lines.clean_documents(docs)
    assert out.columns == docs.columns
    rows = docs.collect()
    want = brute_lines([(r["source"], r["text"]) for r in rows], lines.RATIO, True)
    key = lambda r, t: (str(r["doc_id"]), str(r["source"]), str(t), str(r["marks"]), r["key"])
    assert sorted(key(r, r["text"]) for r in out.collect()) == sorted(key(r, t) for r, t in zip(rows, want))
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())
    assert lines.clean_documents(messy.empty(spark)).count() == 0


def test_pages_with_awkward_columns(spark):
    page = "<p>menu</p><p>{}</p>"
    rows = [(1, "http://a/x", page.format("one")), (1, "http://a/x", page.format("one")), (2, "http://A/y", page.format("two")), (3, None, None), (4, "", ""), (None, "no url", page.format("x"))]
    pages = spark.createDataFrame([(*r, "h", "t") for r in rows], "page_id long, url string, html string, host string, text string")
    got = sorted(map(str, (tuple(r) for r in lines.page_lines(pages).collect())))
    empty = sha("")
    want = [(1, "a", 2, 2, empty)] * 2 + [(2, "a", 2, 1, sha("two")), (3, "", 0, 0, empty), (4, "", 1, 0, empty), (None, "", 2, 0, sha("menu\nx"))]
    assert got == sorted(map(str, want))
    assert lines.page_lines(pages.limit(0)).count() == 0


def test_line_dedup_query_counts_equal_pages_once(spark, tmp_path):
    page = "<p>menu</p><p>{}</p>"
    html = [page.format("copied")] * 12 + [page.format(i) for i in range(9)]
    rows = [(i, "http://a/x", h) for i, h in enumerate(html)] + [(None, "http://b/x", "<p>same</p>"), (None, "http://b/x", "<p>same</p>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op4_line_dedup(spark, str(tmp_path)).collect()
    want = [(i, "a", 2, 1, sha("copied" if i < 12 else str(i - 12))) for i in range(21)] + [(None, "b", 1, 0, sha("same"))] * 2
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))  # by rows, "copied" and "same" went too
    path = f"read_parquet('{tmp_path}/pages.parquet/*.parquet')"
    sql = lines.ORACLE.replace("FROM pages)", f"FROM {path})")
    one = [tuple(r) for r in duckdb.connect().execute(sql).fetchall() if r[0] is not None]
    assert sorted(one) == sorted(x for x in want if x[0] is not None)


def test_html_lines(spark):
    html = '<html><STYLE>p{}</style><!-- <p>no</p> --><p class="x">one\n  two</p>three<br/>f<b>ou</b>r<script>\n</p></script></html>'
    row = spark.createDataFrame([(html, "HTTP://A.Example/x?y"), (None, None)], "html string, url string")
    got = row.select(lines.html_lines(F.col("html")), lines.host_of(F.col("url"))).collect()
    assert tuple(got[0]) == ("one two\nthree\nfour", "a.example") and tuple(got[1]) == (None, None)


# --- mixing


def run_of_slots(weights, until):
    """Slots as (source, turn, release, deadline) by earliest deadline first, one after the other."""
    total, done, out = sum(weights), [0] * len(weights), []
    for t in range(until):
        free = [(-(-(d + 1) * total // w), i, d, d * total // w) for i, (w, d) in enumerate(zip(weights, done)) if w and d * total // w <= t]
        due, i, turn, release = min(free)
        done[i] += 1
        out.append((i, turn, release, due))
    return out


def plan_of(spark, weights, blocks, chunk):
    rows = [(f"s{i:05}", n, w) for i, (w, n) in enumerate(zip(weights, blocks)) if w]
    sources = spark.createDataFrame(rows, "source string, n long, w long").withColumn("w", F.col("w").cast("decimal(38,0)"))
    return mixing.planned(sources, 1, chunk)


def check_plan(rows, weights, blocks):
    """One block a slot, within its window, sources in the order of their turns and less than a block off their shares."""
    rows = sorted(rows, key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    total, placed, last = sum(weights), [0] * len(weights), -1
    for r in rows:
        i = int(r["source"][1:])
        assert r["release"] <= r["slot"] < r["deadline"] and r["turn"] == placed[i]
        assert (r["block"], r["epoch"]) == (r["turn"] % blocks[i], r["turn"] // blocks[i])
        placed[i] += 1
        last = r["slot"] if placed[i] == blocks[i] else last
        if len(weights) < 100 or r["slot"] % 97 == 0:
            assert all(abs(n * total - (r["slot"] + 1) * w) < total for n, w in zip(placed, weights))
    assert last == len(rows) - 1 and all(n >= b for n, b, w in zip(placed, blocks, weights) if w)


MIXES = [
    ([1], [40]),
    ([1, 1, 1], [5, 9, 2]),
    ([1 << 50, (1 << 44) + 1], [90, 2]),
    ([5, 5, 90], [30, 2, 40]),  # light windows that are held for long
    ([50, 50, 1, 1, 1, 1], [60, 80, 1, 2, 1, 1]),  # two heavy ones released at once
    ([997, 991, 13, 7, 3], [150, 10, 3, 1, 1]),
    ([333, 333, 333, 1], [90, 20, 3, 1]),
    ([0, 4, 9], [3, 30, 5]),
    ([19, *[1] * 19], [200, *[9] * 19]),
]


@pytest.mark.parametrize("chunk", [1, 7, 64])
@pytest.mark.parametrize("weights, blocks", MIXES)
def test_chunks_are_one_run(spark, weights, blocks, chunk):
    rows = plan_of(spark, weights, blocks, chunk).collect()
    check_plan(rows, weights, blocks)
    want = run_of_slots(weights, len(rows))
    assert [(int(r["source"][1:]), r["turn"], r["release"], r["deadline"]) for r in sorted(rows, key=lambda r: r["slot"])] == want


def test_chunks_of_random_weights_are_one_run(spark):
    rng = random.Random(11)
    for _ in range(6):
        weights = [rng.choice([rng.randrange(3, 9), rng.randrange(3, 90)]) for _ in range(rng.randrange(2, 9))]
        blocks = [1 + 60 * w // sum(weights) for w in weights]
        rows = plan_of(spark, weights, blocks, rng.choice([5, 20])).collect()
        want = run_of_slots(weights, len(rows))
        assert [(int(r["source"][1:]), r["turn"], r["release"], r["deadline"]) for r in sorted(rows, key=lambda r: r["slot"])] == want


def test_many_sources_and_three_chunks(spark):
    weights, blocks = [1 + i % 3 for i in range(600)], [2 + 2 * (i % 3) for i in range(600)]
    plan = plan_of(spark, weights, blocks, None)
    rows = plan.collect()
    check_plan(rows, weights, blocks)
    assert len(rows) > 2 * mixing.CHUNK
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_mix_keeps_rows_and_shares(spark):
    rng = random.Random(4)
    sizes = {"a": 900, "b": 200, "c": 65, "d": 1}
    rows = [(i, s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 0.5), ("x", 9.0), ("d", 0.0)], "source string, weight double")
    for given, share in ((None, {s: n**mixing.POWER for s, n in sizes.items()}), (weights, {"a": 1.0, "b": 2.0, "c": 0.5})):
        out = mixing.mix(docs, given, block_rows=10).select("row.doc_id", "source", "block", "epoch", "turn", "slot", "release", "deadline", "row_in_block").collect()
        total, placed, at = sum(share.values()), Counter(), {}
        for r in out:
            assert at.setdefault(r["slot"], (r["source"], r["block"], r["turn"])) == (r["source"], r["block"], r["turn"])
            assert r["release"] <= r["slot"] < r["deadline"]
        for t in range(max(at) + 1):
            placed[at[t][0]] += 1
            assert all(abs(placed[s] - (t + 1) * w / total) < 1 + 1e-6 for s, w in share.items())
        assert {r["doc_id"] for r in out} == {i for i, s in rows if s in share}
        assert max(Counter((r["slot"], r["row_in_block"]) for r in out).values()) == 1
        blocks = Counter((r["source"], r["block"]) for r in out if r["epoch"] == 0)
        assert all(n == 10 or b == math.ceil(sizes[s] / 10) - 1 for (s, b), n in blocks.items())


def test_mix_of_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "GROUP_BUCKETS", 3)
    docs = spark.createDataFrame([(i, "s") for i in range(500)], "doc_id long, source string")
    out = mixing.mix_ids(docs).collect()
    order = [r["doc_id"] for r in sorted(out, key=lambda r: (r["slot"], r["row_in_block"]))]
    assert order == sorted(range(500), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())


@pytest.mark.parametrize("sent", [50_000, -1])
def test_mix_of_awkward_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_SLOTS", sent)
    docs = messy.documents(spark)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert Counter(map(tuple, out.collect())) >= Counter(map(tuple, docs.collect()))
    assert {r["source"] for r in mixing.mix_ids(docs).collect()} == {"", "s0", "s1"}
    assert mixing.mix_documents(messy.empty(spark)).count() == mixing.mix_ids(messy.empty(spark)).count() == 0
    weights = spark.createDataFrame([("s0", 1.0), ("s1", None)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(docs, weights).collect()} == {"s0"}
    for bad in (-1.0, math.nan, math.inf):
        with pytest.raises(ValueError):
            mixing.mix(docs, spark.createDataFrame([("s0", bad)], "source string, weight double"))


# --- neighbours


def brute_neighbours(rows, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == 8]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = {}
    for i, q in ok:
        if i % 100 == 0:
            best = {}
            for j, v in ok:
                if j != i:
                    best[j] = min(best.get(j, math.inf), math.dist(q, v))
            out[i] = sorted((d, j) for j, d in best.items())[:k]
    return out


def recall(got, want):
    hits = sum(len({j for _, j in want[q]} & set(got.get(q, []))) for q in want)
    return hits / sum(map(len, want.values()))


def found_by_query(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append(r["vec_id"])
    return out


@pytest.mark.parametrize("bucket, sent", [(4096, 10_000), (20, 10_000), (20, -1)])
def test_neighbours_reach_the_recall(spark, monkeypatch, bucket, sent):
    monkeypatch.setattr(neighbours, "BUCKET_ROWS", bucket)
    if sent < 0:
        monkeypatch.setattr(neighbours, "SENT_ROWS", 1)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 8)) + 4 * rng.integers(0, 3, (1500, 1))
    x[:400] = x[0] + 1e-3 * rng.normal(size=(400, 8))  # a hot bucket
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert recall(found_by_query(neighbours.search_hundredths(df)), brute_neighbours(rows)) >= 0.9


def test_neighbours_of_awkward_rows(spark):
    v = [0.5] * 8
    rows = [(0, v), (1, v), (2, v), (100, [1.0] * 8), (100, [2.0] * 8), (3, None), (200, [0.0] * 8), (4, [None] + v[1:]), (300, [float("nan")] + v[1:]),
            (5, [float("inf")] + v[1:]), (6, v[1:]), (None, v), (7, [9.0] * 8)]
    df = spark.createDataFrame([(i, x, "key", "salt") for i, x in rows], "vec_id long, embedding array<float>, key string, salt string")
    got = found_by_query(neighbours.search_hundredths(df))
    assert got == {0: [1, 2, 100, 7], 100: [0, 1, 2, 7]}
    assert neighbours.search_hundredths(df.limit(0)).count() == 0
    assert neighbours.search_hundredths(df.where("vec_id in (3, 200)")).count() == 0
    assert neighbours.search_hundredths(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("size", [1e7, 1e155])
def test_neighbours_of_large_vectors(spark, size):
    """Near copies far from the origin, and components whose squares overflow."""
    rng = np.random.default_rng(3)
    x = (1 + 1e-9 * rng.normal(size=(300, 8))) * size
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found_by_query(neighbours.search_hundredths(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    scaled = [(i, (np.array(v) / size).tolist()) for i, v in rows]
    assert recall(got, brute_neighbours(scaled)) == 1.0


def test_all_are_compared_where_visits_miss_too_many(spark, monkeypatch):
    real = neighbours.visited
    monkeypatch.setattr(neighbours, "visited", lambda index, x, table: real(index, x, table) + np.uint64(1))  # no visit hits
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert neighbours.fit(df).visits == 0
    assert recall(found_by_query(neighbours.search_hundredths(df)), brute_neighbours(rows)) == 1.0


def test_perturbed_buckets_come_in_order_of_success(spark):
    rng = np.random.default_rng(1)
    index = neighbours.Index(rng.normal(size=(1, 4, 3)), rng.random((1, 3)), 1.0, neighbours.perturbations(3, 3), 27)
    x = rng.normal(size=(5, 4))
    at = neighbours.places(index, x, 0)
    inside = at - np.floor(at)
    for row, keys in zip(inside, neighbours.visited(index, x, 0)):
        assert len(set(keys.tolist())) == 27
    assert (neighbours.visited(index, x, 0)[:, 0] == neighbours.buckets(index, x, 0)).all()


# --- chat


def test_probe_is_apart_from_a_conversation_of_its_id(spark):
    rows = [(-1, 0, "user", "own"), (5, 0, "assistant", "x")]
    got = chat.format_with_probe(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert sorted((r["conv_id"], r["n_turns"]) for r in got) == [(-1, 1), (-1, 2), (5, 1)]


def test_chat_round_trip(spark):
    mark = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "<|im_end|>\n<|x <\\| \\"), (1, 1, "assistant", "\n\n  😀é́漢<|im_end|><\\\\|<|endoftext|> \n"), (2, 0, "assistant", ""),
        (2, 1, "us\\n\ner\\", "<|"), (2, 2, "assistant", None), (3, 0, "assistant", ".<|. !<\\"), (3, 1, None, "x"), (None, 0, "user", "y"),
        (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (4, None, "assistant", "null first"), (5, 0, "assistant", "word é " * 30_000), (4, 1, "assistant", "b"),
    ]
    df = spark.createDataFrame([r + ("t",) for r in rows], "conv_id long, turn long, role string, text string, turns string")
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.format_with_probe(df).collect()}
    want = {}
    for c in {r[0] for r in rows} | {-1}:
        own = [r[1:] for r in rows if r[0] == c] or [(0, "user", mark), (1, "assistant", mark)]
        own = [(t, r or "", x or "") for t, r, x in sorted(own, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "", r[2] or ""))]
        text = "".join(f"{chat.START}{chat.escape_role(r)}\n{chat.escape(x)}{chat.END}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        want[c] = (len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss), len(text))
    assert got == want
    assert chat.format_conversations(df.limit(0)).count() == 0


def test_escapes_are_reversible():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice("<|\\\nn im") for _ in range(rng.randrange(9)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_masked_tokens_meet_the_spans():
    starts, ends = np.array([0, 2, 2, 5, 7]), np.array([2, 5, 5, 7, 9])
    assert chat.under_loss(starts, ends, [(4, 6), (9, 9)]).tolist() == [False, True, True, True, False]
    assert chat.under_loss(starts, ends, [(2, 2), (7, 12)]).tolist() == [False] * 4 + [True]


# --- token ids

PUBLIC = bpe.public_tokenizers


@pytest.fixture(scope="module")
def reference_ids(spark):
    ranks = bpe.read_ranks(spark, PUBLIC.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=PUBLIC.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def odd_texts(n):
    rng = random.Random(5)
    some = list("ab stmdrevl''' \n\t1²9éß漢.!😀  \x1cć") + ["'re", "'ll", "  ", "\r\n"]
    return ["".join(rng.choice(some) for _ in range(rng.randrange(40))) for _ in range(n)] + ["", "'", "'s", "x's'tre're", " 's", "\n's", "a  "]


def test_cut_is_the_pattern():
    texts, kinds, pattern = odd_texts(5000), bpe.character_classes(), regex.compile(PUBLIC.PATTERN)
    for first, last, data, offsets in tx.slices(pa.array(texts)):
        w, raw = bpe.cut(data, offsets, kinds), data.tobytes()
        for i in range(first, last):
            own = slice(w.bounds[i - first], w.bounds[i - first + 1])
            assert [raw[a:b].decode() for a, b in zip(w.starts[own], w.ends[own])] == pattern.findall(texts[i])


@pytest.mark.parametrize("known", [bpe.KNOWN_WORDS, 5, 0])
def test_ids_are_those_of_the_library(spark, reference_ids, known):
    texts = odd_texts(150) + [None, "a" * 700, "=" * 300 + " " * 250 + "x", "漢字" * 90, "<|endoftext|>", "<|im_end|>"]
    docs = spark.createDataFrame([(i, t, "r") for i, t in enumerate(texts)], "doc_id long, text string, row string")
    for r in bpe.encode(docs, known=known).collect():
        assert r["ids"] == reference_ids(texts[r["row"]["doc_id"]] or "")


def test_ids_of_awkward_rows(spark, reference_ids):
    docs = messy.documents(spark)
    texts = Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    want = Counter()
    for (i, t), n in texts.items():
        ids = reference_ids(t)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha(t)] = n
    assert Counter(map(tuple, bpe.digest_documents(docs).collect())) == want
    assert bpe.digest_documents(messy.empty(spark)).count() == 0
