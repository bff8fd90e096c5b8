"""The divergence audit against exact fractions, and on awkward rows."""

import random
import re
from collections import Counter, defaultdict

import messy
import numpy as np
import pytest

from lendstrata.llm import divergence as dv


def brute(rows, least, top):
    """Rows of (text, lang, source) to the audit's rows, with Python's whole numbers."""
    own, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        langs[lang].add(source)
        found = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        own[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in langs.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=lambda t: t.encode())

        def share(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        whole = share(sum((own[lang, s] for s in sources), Counter()))
        p = {s: share(own[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((p[s][t] - p[x][t]) ** 2 // p[x][t] for t in kept), x) for x in sources - {s}]
            terms = [((p[s][t] - whole[t]) ** 2 // whole[t], t) for t in kept if own[lang, s][t] and p[s][t] > whole[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_against_whole_numbers(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(dv, "BLOCK_COUNTS", 7)
    rng = random.Random(4)
    words = ["alpha", "Beta", "GAMMA", "é漢", "Ünder", "x_y", "don't", "zeta9eta", "\x7fodd", "İ"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(12))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])) for _ in range(90)]
    rows += [(None, "xx", "only"), ("", "yy", "a"), (" 12 ", "yy", "b"), ("rare words", "yy", "c")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = [tuple(r) for r in dv.audit(docs, 3, 5).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 3, 5)


def test_awkward_rows(spark):
    docs = messy.documents(spark)
    got = {tuple(r) for r in dv.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert got == brute([(r["text"], r["lang"], r["source"]) for r in docs.collect()], dv.LEAST_DOCUMENTS, dv.TERMS)
    assert dv.audit(messy.empty(spark)).collect() == []


def test_long_texts_are_split_in_slices(monkeypatch):
    text = ("Word é" * 50 + " x;y ") * 40
    whole = [w for part in dv.terms(text.encode()) for w in part]
    monkeypatch.setattr(dv, "SLICE", 30)
    parts = list(dv.terms(text.encode()))
    assert len(parts) > 10 and [w for part in parts for w in part] == whole
    assert b"x" in whole and not any(w != w.lower() for w in whole)


def test_tasks_pass_on_counts_when_they_hold_many(spark, monkeypatch):
    rows = [(f"a b c{chr(97 + i % 26)}{chr(97 + i // 26)}", "en", "s") for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    want = sorted(map(str, dv.count_terms(docs).collect()))
    monkeypatch.setattr(dv, "TALLY", 3)
    assert sorted(map(str, dv.count_terms(docs).collect())) == want


def test_shares_of_counts_beyond_64_bits():
    n, total = np.array([10**15, 3], np.int64), 3 * 10**15
    assert dv.shares(n, total).tolist() == [1 + (x + 1) * 10**9 // total for x in n.tolist()]
