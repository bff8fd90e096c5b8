"""Source divergence audit: how far the word use of each source is from its language and from other sources.

A term is a run of letters A-Z, lower-cased, and of bytes above 0x7F. One pass of ``bytes.translate`` lowers the letters and
blanks everything else, ``bytes.split`` finds the terms, and a Counter per document gives its frequencies, which a task adds
up for each (language, source) before they are shuffled: only terms that occur travel.

A language keeps the terms that enough of its documents hold. Each of its V kept terms has in a group (a source of the
language, or the language) of N such words the share p = 1 + floor(10^9 * (count + 1) / (N + V)). With the share q of another
group, f = floor((p - q)^2 / q) says how far the two are apart on that term. Part ``pair`` adds f up over all kept terms
for each two sources of a language; part ``term`` lists the terms that a source uses more than its language does.

Kept terms are dealt to blocks by their hash. A block's task gets the totals of all sources of the language, so that it
works on dense rows of shares; it passes on one sum for each pair of sources, and each source's leading terms. It holds
the square of the number of a language's sources, as the result does.

Null text, language and source count as empty strings. Every row is a document, repeated rows and rows without an id too. A
group without terms has its pairs; a language with one source has none. Very long texts are split a slice at a time. An empty
table gives no rows. Other columns are not read. Numbers are whole and exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lendstrata.llm import text as tx
from lendstrata.sources.sinks import materialize

LEAST_DOCUMENTS = 3
TERMS = 200
SCALE = 10**9
#: Terms that a task adds up before it passes them on.
TALLY = 300_000
#: Bytes of a text that are split at once.
SLICE = 1_000_000
#: Counts of a block, and shares compared at once.
BLOCK_COUNTS = 200_000
CELLS = 500_000

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term binary, n long, docs long"
_PARTS = "lang string, source string, part string, item string, value long"


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice of it at a time."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


class _Tally:
    """Counts of terms, and of documents that hold them, by (language, source)."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.rows: Counter = Counter()

    def add(self, group: tuple[str, str], text: bytes) -> int:
        """Adds a document; returns the number of terms that are new here."""
        own: Counter = Counter()
        for words in terms(text):
            own.update(words)
        n, docs = self.groups.setdefault(group, (Counter(), Counter()))
        before = len(n)
        n.update(own)
        docs.update(own.keys())
        self.rows[group] += 1
        return len(n) - before

    def batches(self) -> Iterator[pa.RecordBatch]:
        """One row per group and term, and one without a term for each group."""
        for (lang, source), (n, docs) in self.groups.items():
            names = list(n)
            columns = [
                pa.array([lang] * (len(names) + 1), pa.string()),
                pa.array([source] * (len(names) + 1), pa.string()),
                pa.array([*names, None], pa.binary()),
                pa.array([*n.values(), 0], pa.int64()),
                pa.array([*map(docs.__getitem__, names), self.rows[lang, source]], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally, size = _Tally(), 0
    for batch in batches:
        groups = zip(*(pc.fill_null(tx.text_of(batch, c), "").to_pylist() for c in ("lang", "source")))
        texts = tx.text_of(batch, "text").cast(pa.large_binary())
        for group, text in zip(groups, texts):
            size += tally.add(group, text.as_py() or b"")
            if size >= TALLY:
                yield from tally.batches()
                tally, size = _Tally(), 0
    yield from tally.batches()


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs); a group has a row without a term, whose docs are its documents."""
    tx.bound_batches(docs.sparkSession)
    counted = docs.select("text", F.col("lang").cast("string"), F.col("source").cast("string")).mapInArrow(_counted, _COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """The counts of kept terms, with the language's count; ``lead`` is true on one row of each term of a language."""
    term = W.partitionBy("lang", "term")  # a row per source
    every = counts.where("term is not null").select(
        "lang",
        "source",
        F.col("term").cast("string").alias("term"),
        "n",
        F.sum("n").over(term).alias("n_lang"),
        F.sum("docs").over(term).alias("n_docs"),
        (F.min("source").over(term) == F.col("source")).alias("lead"),
    )
    return every.where(F.col("n_docs") >= least).drop("n_docs")


def totals(counts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, words, vocabulary, lang_words) of every group."""
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count_if("lead").alias("leads"))
    groups = counts.where("term is null").select("lang", "source").join(own, ["lang", "source"], "left")
    whole = groups.groupBy("lang").agg(F.sum("words").alias("lang_words"), F.sum("leads").alias("vocabulary"))
    zero = {"words": 0, "vocabulary": 0, "lang_words": 0}
    return groups.drop("leads").join(whole, "lang").fillna(zero).select("lang", "source", *zero)


def shares(n: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / total), exactly."""
    if n.size and int(n.max()) >= (1 << 62) // SCALE:
        n = n.astype(object)
    return (1 + (n + 1) * SCALE // total).astype(np.int64)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _compared(top: int):
    """Sums for pairs of sources over a block's terms, and each source's leading terms of the block."""

    def compare(key, counts: pa.Table, groups: pa.Table) -> pa.Table:
        lang, block = (k.as_py() for k in key)
        groups = groups.sort_by("source")
        names = groups["source"].combine_chunks()
        many, words = len(names), groups["words"].to_numpy()
        vocabulary, lang_words = groups["vocabulary"][0].as_py(), groups["lang_words"][0].as_py()
        total = words + vocabulary
        sums = np.zeros((many, many), np.int64)
        parts = []
        if len(counts):
            counts = counts.sort_by("term").combine_chunks()
            coded = pc.dictionary_encode(counts["term"].combine_chunks())
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            term = coded.indices.to_numpy()  # in the terms' order
            who = pc.index_in(counts["source"].combine_chunks(), names).to_numpy().astype(np.int64)
            n = counts["n"].to_numpy()
            p = shares(n, total[who])
            absent = shares(np.zeros(many, np.int64), total)
            step = max(1, CELLS // many)
            for first in range(0, int(term[-1]) + 1, step):
                own = slice(*np.searchsorted(term, [first, first + step]))
                table = np.tile(absent, (int(term[own][-1]) - first + 1, 1))
                table[term[own] - first, who[own]] = p[own]
                for i in range(many):
                    sums[i] += apart(table[:, i : i + 1], table).sum(axis=0)
            parts.append(_leading(lang, names, counts["term"], who, p, shares(counts["n_lang"].to_numpy(), lang_words + vocabulary), top))
        a, b = np.nonzero(~np.eye(many, dtype=bool) & ((sums != 0) | (block == 0)))
        parts.append(_rows(lang, "pair", names.take(pa.array(a)), names.take(pa.array(b)), sums[a, b]))
        return pa.concat_tables(parts)

    return compare


def _leading(lang: str, names: pa.Array, terms: pa.ChunkedArray, who: np.ndarray, p: np.ndarray, q: np.ndarray, top: int) -> pa.Table:
    more = np.flatnonzero(p > q)
    value = apart(p[more], q[more])
    order = more[np.lexsort([more, -value, who[more]])]  # rows are in the terms' order
    place = np.arange(len(order)) - np.searchsorted(who[order], who[order])
    order = order[place < top]
    return _rows(lang, "term", names.take(pa.array(who[order])), terms.take(pa.array(order)), apart(p[order], q[order]))


def _rows(lang: str, part: str, source: pa.Array, item: pa.Array, value: np.ndarray) -> pa.Table:
    item = item.combine_chunks() if isinstance(item, pa.ChunkedArray) else item
    columns = [pa.array([lang] * len(source), pa.string()), source, pa.array([part] * len(source), pa.string()), item, pa.array(value, pa.int64())]
    return pa.table(columns, names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TERMS) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): all other sources of the language, and the ``top`` leading terms."""
    counts = materialize(count_terms(docs), "counts")
    kept = materialize(kept_terms(counts, least), "kept")
    most = kept.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = max(1, math.ceil(most / BLOCK_COUNTS))
    own = kept.select("lang", "source", "term", "n", "n_lang", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int").alias("block"))
    groups = totals(counts, kept).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = materialize(own.groupBy("lang", "block").cogroup(groups.groupBy("lang", "block")).applyInArrow(_compared(top), _PARTS), "compared")
    keys = ["lang", "source", "part", "item"]
    place = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs = found.where("part = 'pair'").groupBy(*keys).agg(F.sum("value").alias("value")).withColumn("rank", place)
    leading = found.where("part = 'term'").withColumn("rank", place).where(F.col("rank") <= top)
    return pairs.unionByName(leading)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{_LETTERS}', '{_LETTERS.lower()}') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST_DOCUMENTS}),
g AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (SELECT g.lang, g.source, kept.term, kept.n AS n_lang, coalesce(counts.n, 0) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
shares AS (SELECT lang, source, term, n,
    1 + CAST(n + 1 AS HUGEINT) * {SCALE} // CAST(sum(n) OVER own + count(*) OVER own AS HUGEINT) AS p,
    1 + CAST(n_lang + 1 AS HUGEINT) * {SCALE} // CAST(sum(n_lang) OVER own + count(*) OVER own AS HUGEINT) AS q
  FROM dense WINDOW own AS (PARTITION BY lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN pairs ON pairs.lang = g.lang AND pairs.source = g.source AND pairs.item = h.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM parts QUALIFY part = 'pair' OR rank <= {TERMS}"""
