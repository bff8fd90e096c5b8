"""Mixing sources to target weights by Pfair scheduling.

A source's rows are cut into blocks of equal size, in an order given by a digest of the id. With weight w
(all weights add up to 1) its block j is released at slot floor(j / w) and due by slot ceil((j + 1) / w). A
slot takes the released block with the earliest deadline, ties to the first source, so that after any number of slots every
source is less than one block off its share. Each source starts over when its blocks are used up; the mix ends when every source has
been through once. So every row is there, and rows of a source that is to weigh more than its size are there more often.

The slots are planned in chunks that don't wait for each other. What earliest deadline first has done by the first slot T of a chunk
can be told without running it: all blocks that are due by T, and of those whose window holds T, by deadline, as many as found a
slot. A block found one if, for every slot s before T, blocks released from s on that were done don't outnumber the slots from s to T. From
that state each chunk goes on slot by slot, so that together they are the plan of one long run. Looking back takes as many slots as
the windows at T are long, at most 1 / w for the smallest weight.

Without given weights a source weighs its number of rows to the power 0.7; windows are computed on whole numbers, weights being counted in
units of a 2^20th (or, if given, of a 2^50th of the largest). Given weights are finite and not negative; sources of weight 0, or
that aren't named, take no part. Rows without a source are a source of their own, named by the empty string. Null ids and repeated rows are
rows like others; which of some equal rows comes first makes no difference. Other columns are passed on, whatever their names. An empty
table gives an empty mix. No task runs Python.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lendstrata.sources.sinks import materialize

BLOCK_ROWS = 64
POWER = 0.7
#: Slots of a chunk at least; it has one for each source at least.
CHUNK = 1024
#: Rows of one source that a task numbers.
BUCKET_ROWS = 2_000
#: Buckets that a task adds up.
GROUP_BUCKETS = 1_000
#: Slots of a plan that is sent to every task.
SENT_SLOTS = 50_000

_WHOLE = "decimal(38,0)"


def weighted(sources: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(source, n, w): weights as whole numbers, of the sources that take part."""
    if weights is None:
        units = F.pow(F.col("n").cast("double"), F.lit(POWER)) * float(1 << 20)
        return sources.select("source", "n", F.greatest(F.lit(1), F.floor(units)).cast(_WHOLE).alias("w"))
    given = weights.select("source", F.col("weight").cast("double").alias("weight"))
    bad = (F.col("weight") < 0) | F.isnan("weight") | (F.col("weight") == float("inf"))
    most, wrong = given.agg(F.max("weight"), F.count_if(bad)).first()
    if wrong:
        raise ValueError("weights are finite numbers of 0 or more")
    units = F.floor(F.col("weight") / F.lit(float(most or 1.0)) * float(1 << 50))
    known = sources.join(given.where("weight > 0"), "source")
    return known.select("source", "n", F.greatest(F.lit(1), units).cast(_WHOLE).alias("w"))


# In the expressions below s is the array of (source, n, w, blocks), p the sum of weights, t0 a chunk's first slot, of long type.

#: Of each source: blocks due by t0, and whether another one's window holds t0.
_DUE = "transform(s, x -> named_struct('j', cast((x.w * t0) div p AS bigint), 'held', (x.w * t0) % p > 0, 'w', x.w))"
#: The blocks whose windows hold t0, by deadline.
_HELD = """array_sort(filter(transform(due, (x, i) -> named_struct('due', cast(((x.j + 1) * p + x.w - 1) div x.w AS bigint), 'i', i,
  'rel', cast((x.j * p) div x.w AS bigint), 'held', x.held)), x -> x.held))"""
#: From each slot between the first and the last of their releases on: slots to t0 that blocks due by then leave.
_ROOM = """if(array_min(transform(held, x -> x.rel)) < array_max(transform(held, x -> x.rel)),
  transform(sequence(array_min(transform(held, x -> x.rel)) + 1, array_max(transform(held, x -> x.rel))),
    at -> named_struct('s', at, 'room', t0 - at - aggregate(due, 0L, (n, x) ->
      n + greatest(0L, x.j - cast((x.w * at + p - 1) div p AS bigint))))),
  cast(array() AS array<struct<s: bigint, room: bigint>>))"""
#: Which of them were done: by deadline, as long as there is room from every slot up to their release.
_DONE = """aggregate(held, named_struct('left', t0 - aggregate(due, 0L, (n, x) -> n + x.j), 'room', room, 'done', cast(array() AS array<int>)),
  (a, x) -> if(a.left > 0 AND forall(a.room, r -> r.s > x.rel OR r.room > 0),
    named_struct('left', a.left - 1, 'room', transform(a.room, r -> named_struct('s', r.s, 'room', if(r.s > x.rel, r.room, r.room - 1))), 'done', concat(a.done, array(x.i))),
    a), a -> a.done)"""
#: Of each source: the blocks that may be placed in the chunk, with their windows.
_JOBS = """transform(due, (x, i) -> transform(
  sequence(x.j + if(array_contains(ahead, i), 1L, 0L), greatest(x.j + 1, cast((x.w * (t0 + {chunk}) + p - 1) div p AS bigint))),
  j -> named_struct('turn', j, 'rel', cast((j * p) div x.w AS bigint), 'due', cast(((j + 1) * p + x.w - 1) div x.w AS bigint))))"""
#: Slot by slot the released block with the earliest deadline; ``at`` counts each source's placed blocks.
_PLAN = """aggregate(sequence(t0, t0 + {chunk} - 1),
  named_struct('at', transform(jobs, x -> 0), 'plan', cast(array() AS array<struct<due: bigint, i: int, turn: bigint, rel: bigint>>)),
  (a, t) -> transform(array(array_min(filter(transform(jobs, (x, i) ->
      named_struct('due', x[a.at[i]].due, 'i', i, 'turn', x[a.at[i]].turn, 'rel', x[a.at[i]].rel)), x -> x.rel <= t))),
    best -> named_struct('at', transform(a.at, (n, i) -> if(i = best.i, n + 1, n)), 'plan', concat(a.plan, array(best))))[0],
  a -> a.plan)"""


def planned(sources: DataFrame, block_rows: int = BLOCK_ROWS, chunk: int | None = None) -> DataFrame:
    """The stored plan for (source, n, w): (source, block, epoch, turn, slot, release, deadline), until each source has been through.

    One row holds all sources and is copied to each chunk: a number and a name per source and chunk.
    """
    blocks = sources.withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("long"))
    whole = blocks.agg(F.array_sort(F.collect_list(F.struct("source", "n", "w", "blocks"))).alias("s"), F.sum("w").cast(_WHOLE).alias("p")).where("p > 0")
    size = chunk or max(CHUNK, sources.count())
    last = F.expr("array_max(transform(s, x -> cast((x.blocks * p + x.w - 1) div x.w AS bigint)))")
    starts = whole.select("s", "p", F.explode(F.sequence(F.lit(0).cast("long"), last - 1, F.lit(size).cast("long"))).alias("t0"))
    steps = _PLAN.format(chunk=size)
    for name, step in (("jobs", _JOBS.format(chunk=size)), ("ahead", _DONE), ("room", _ROOM), ("held", _HELD), ("due", _DUE)):
        steps = f"transform(array({step}), {name} -> {steps})[0]"  # bound, so that it is computed once
    state = starts.repartition("t0").select("s", "t0", F.expr(steps).alias("plan"))
    placed = state.select("s", "t0", F.posexplode("plan").alias("at", "x")).select(
        F.expr("s[x.i].source").alias("source"), F.expr("s[x.i].blocks").alias("blocks"), F.col("x.turn"),
        (F.col("t0") + F.col("at")).alias("slot"), F.col("x.rel").alias("release"), F.col("x.due").alias("deadline"),
    )
    stored = materialize(placed, "plan")
    end = stored.where("turn = blocks - 1").agg(F.max("slot")).first()[0]
    block, epoch = F.expr("turn % blocks").alias("block"), F.expr("turn div blocks").alias("epoch")
    return stored.where(F.col("slot") <= F.lit(-1 if end is None else end)).select("source", block, epoch, "turn", "slot", "release", "deadline")


def numbered(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``rank`` within the source, from 0, to rows of (row, source, mark, tie): the order of marks and ties.

    Marks are uniform hex digests. Rows fall into buckets by the mark, in order; counts of buckets give the rank at which
    each bucket starts, so that no task numbers a whole source.
    """
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    at = F.floor(F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(float(1 << 32)))
    placed = rows.withColumn("bucket", at)
    counts = placed.groupBy("source", "bucket").agg(F.count("*").alias("rows")).withColumn("part", F.floor(F.col("bucket") / GROUP_BUCKETS))
    parts = counts.groupBy("source", "part").agg(F.sum("rows").alias("rows"))
    parts = parts.select("source", "part", F.coalesce(F.sum("rows").over(W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("rows").over(W.partitionBy("source", "part").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("source", "part", "bucket", inner.alias("inner")).join(parts, ["source", "part"])
    starts = starts.select("source", "bucket", (F.col("base") + F.col("inner")).alias("start"))
    own = F.row_number().over(W.partitionBy("source", "bucket").orderBy("mark", "tie"))
    return placed.withColumn("own", own).join(starts, ["source", "bucket"]).withColumn("rank", F.col("start") + F.col("own") - 1)


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct("*").alias("row"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("mark"),
        F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]).alias("tie"),
    )


def mix(docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Columns row (as it came), source, block, epoch, turn, slot, release, deadline, row_in_block; in the mix's order by (slot, row_in_block).

    ``weights``: (source, weight); rows of sources without weight are not in the mix.
    """
    rows = _marked(docs)
    sources = rows.groupBy("source").agg(F.count("*").alias("n"))
    plan = planned(weighted(sources, weights), block_rows)
    placed = numbered(rows, docs.count()).select(
        "row", "source", F.floor(F.col("rank") / block_rows).alias("block"), F.pmod("rank", F.lit(block_rows)).alias("row_in_block")
    )
    side = F.broadcast(plan) if plan.count() <= SENT_SLOTS else plan
    return placed.join(side, ["source", "block"]).select("row", "source", "block", "epoch", "turn", "slot", "release", "deadline", "row_in_block")


ORACLE = f"""
WITH RECURSIVE s0 AS (SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY 1),
s1 AS (SELECT source, n, CAST(greatest(1, floor(power(n, {POWER}) * {1 << 20})) AS HUGEINT) AS w, CAST(ceil(n / {BLOCK_ROWS}) AS HUGEINT) AS blocks,
  row_number() OVER (ORDER BY source) AS i FROM s0),
l AS (SELECT list(w ORDER BY i) AS w, CAST(sum(w) AS HUGEINT) AS p, count(*) AS many FROM s1),
h AS (SELECT max((blocks * p + s1.w - 1) // s1.w) AS horizon FROM s1, l),
steps AS (
  SELECT -1 AS t, list_transform(w, lambda x: 0::HUGEINT) AS done, 0::HUGEINT AS best FROM l
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: CASE WHEN i = best THEN d + 1 ELSE d END), best FROM (
    SELECT t, done, list_aggregate(list_transform(list_filter(range(1, many + 1), lambda i: (done[i] * p) // w[i] <= t + 1),
        lambda i: ((done[i] + 1) * p + w[i] - 1) // w[i] * 100000 + i), 'min') % 100000 AS best
    FROM steps, l, h WHERE t < horizon - 1)),
places AS (SELECT best AS i, t AS slot, row_number() OVER (PARTITION BY best ORDER BY t) - 1 AS turn FROM steps WHERE t >= 0),
plan AS (SELECT source, turn % blocks AS block, turn // blocks AS epoch, turn, slot, (turn * p) // s1.w AS release, ((turn + 1) * p + s1.w - 1) // s1.w AS deadline
  FROM places JOIN s1 USING (i), l WHERE slot <= (SELECT max(slot) FROM places JOIN s1 USING (i) WHERE turn = blocks - 1)),
d AS (SELECT doc_id, coalesce(source, '') AS source,
    row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS rank FROM documents)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(epoch AS BIGINT) AS epoch, CAST(turn AS BIGINT) AS turn, CAST(slot AS BIGINT) AS slot,
  CAST(release AS BIGINT) AS release, CAST(deadline AS BIGINT) AS deadline, CAST(rank % {BLOCK_ROWS} AS BIGINT) AS row_in_block
FROM d JOIN plan USING (source) WHERE block = rank // {BLOCK_ROWS}"""


def mix_ids(docs: DataFrame) -> DataFrame:
    """The mix as ids and places."""
    done = mix(docs.select("doc_id", "source"))
    return done.select("row.doc_id", "source", "block", "epoch", "turn", "slot", "release", "deadline", "row_in_block")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, columns unchanged."""
    return mix(docs).select("row.*")
