"""The pipeline against a brute-force version of its stages."""

import hashlib
import math
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
import messy
import tiktoken
from test_copies import brute_components, brute_fingerprint
from test_rows import PUBLIC, brute_lines

from lendstrata.llm import bpe, lines, mixing, toxicity
from lendstrata.sources.sinks import materialize

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "mixing", "byte-level BPE"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_matches_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).collect()}
    rows = [r.asDict() for r in docs.collect() if scores[r["doc_id"]] < 0.3]
    assert 0 < len(rows)
    for row, text in zip(rows, brute_lines([(r["source"], r["text"]) for r in rows], lines.RATIO, distinct=True)):
        row["text"] = text
    rows.sort(key=lambda r: r["doc_id"])
    roots = brute_components([brute_fingerprint(r["text"]) for r in rows], 3)
    rows = [r for i, r in enumerate(rows) if roots[i] == i]
    sizes = Counter(r["source"] for r in rows)
    turns = mixed_turns(sizes)
    ranked = defaultdict(list)
    for r in sorted(rows, key=lambda r: hashlib.md5(str(r["doc_id"]).encode()).hexdigest()):
        ranked[r["source"]].append(r)
    encode = tiktoken.Encoding("own", pat_str=PUBLIC.PATTERN, mergeable_ranks=bpe.read_ranks(spark, PUBLIC.path(bpe.RANKS)), special_tokens={}).encode_ordinary
    want = Counter()
    for source, own in ranked.items():
        blocks = -(-len(own) // mixing.BLOCK_ROWS)
        for rank, r in enumerate(own):
            times = (turns[source] - 1 - rank // mixing.BLOCK_ROWS) // blocks + 1
            ids = encode(r["text"])
            want[r["doc_id"], r["lang"], r["source"], tuple(ids), len(ids), hashlib.sha256(r["text"].encode()).hexdigest()] = times
    got = Counter((*r[:3], tuple(r[3]), *r[4:]) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def mixed_turns(sizes):
    """Blocks of each source until every source has been through, by earliest deadline first."""
    weights = {s: int(n**mixing.POWER * 2**20) for s, n in sizes.items()}
    share = {s: Fraction(w, sum(weights.values())) for s, w in weights.items()}
    need = {s: -(-n // mixing.BLOCK_ROWS) for s, n in sizes.items()}
    done = Counter()
    t = 0
    while any(done[s] < need[s] for s in sizes):
        open_ = [s for s in sizes if done[s] // share[s] <= t]
        best = min(open_, key=lambda s: (math.ceil((done[s] + 1) / share[s]), s))
        done[best] += 1
        t += 1
    return done


def test_awkward_rows_pass_every_stage(spark, tmp_path):
    messy.labels(spark, [(3, 1, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    docs = messy.documents(spark)
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)))
        assert docs.columns == columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count() > 5
    empty = messy.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, str(tmp_path)))
    assert empty.count() == 0
