"""Mixing sources to target weights along a time-varying curriculum.

Targets: the budget is shared by weight; a source stops at ``most_passes``
times its size, and what it leaves is shared again by weight among the rest.

Order: each source's documents stand in an order fixed by a hash, repeated pass
after pass; the source takes words from that stream up to its target. A
source's weight over training time is piecewise linear. Its integral, scaled to
the target, is the words demanded so far; inverting it at a document's place in
the stream gives the time (0 to 1) at which the mix reaches that document. The
documents are then range-sorted by that position.

A running total over a whole source would put a hot source into one task. So
each source is split by its first hash digits, as many as leave no more than
about ``BUCKET_ROWS`` rows of a source that has them all: sums by bucket are
pre-aggregated, their running totals need one row per source and bucket,
and each bucket then counts on from its own offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import free_name, table, word_count, written

#: Weights of the sources in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Words that the mix takes for each 100 words of input.
BUDGET_PERCENT = 150
MOST_PASSES = 2
#: Weight over time as (time, weight) knots, by the source's place, repeating.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)))
#: Documents of one bucket, at most, if all are of one source.
BUCKET_ROWS = 4096
#: Bytes of (source, bucket) rows that are broadcast, else joined; a row takes
#: about 200 bytes.
BROADCAST_BYTES = 32 << 20


def targets(sized: DataFrame, weights: tuple = WEIGHTS, budget_percent: int = BUDGET_PERCENT, most_passes: int = MOST_PASSES) -> DataFrame:
    """(source, place, source_size, target double) from (source, size).

    In ascending order of cap over weight, the capped sources come first: a
    source is capped if its share of what the earlier ones leave is no less
    than its cap. One row for each source, so the windows are small.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*map(F.lit, weights))
    by = by.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    by = by.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    by = by.withColumn("cap", most_passes * F.col("source_size"))
    rising = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "place")
    every = Window.partitionBy()
    by = by.withColumn("budget", F.sum("source_size").over(every) * budget_percent / 100.0)
    left = F.col("budget") - F.sum("cap").over(rising) + F.col("cap")
    heavier = F.sum("weight").over(every) - F.sum("weight").over(rising) + F.col("weight")
    by = by.withColumn("capped", F.col("cap") * heavier <= F.col("weight") * left)
    kept = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    shared = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * (F.col("budget") - kept) / shared)
    return by.select("source", "place", "source_size", target.alias("target"))


def time_of(share: Column, place: Column, schedules: tuple = SCHEDULES) -> Column:
    """When a source has had ``share`` of its target: the inverse of the
    integral of its schedule. Weights must be positive."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        done, when = 0.0, None
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:]), areas):
            u0, u1 = done / sum(areas), (done + area) / sum(areas)
            inside = (share - u0) / (u1 - u0)
            part = inside if w0 == w1 else (F.sqrt(w0 * w0 + (w1 - w0) * (w0 + w1) * inside) - w0) / (w1 - w0)
            here = t0 + (t1 - t0) * part
            when = here if when is None else F.when(share < u0, when).otherwise(here)
            done += area
        out = F.when(place % len(schedules) == k, when).otherwise(out)
    return out


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, weights: tuple = WEIGHTS, budget_percent: int = BUDGET_PERCENT, most_passes: int = MOST_PASSES, schedules: tuple = SCHEDULES, cut: bool = True, keep: tuple[str, ...] = (), bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: what the mix takes of it, and when.

    Columns: the id, those of ``keep``, ``size`` (words), ``source_size``,
    ``target`` (of its source), ``taken`` (words taken, repeats counted) and
    ``position`` (time of its first words, null if nothing is taken).

    cut: the document at which a source reaches its target gives only the
    words that are missing, so the source is met to the word; else it is taken
    whole or not at all, whichever is nearer.

    A null text has no words, a null source is a source of its own. Repeated
    rows are documents of their own; documents with equal ids and sizes may
    swap places. Nothing is taken of empty documents. An empty table gives no
    rows.
    """
    source, start = "mix_source", "mix_start"
    d = docs.select(F.col(id_col), *keep, F.col(source_col).cast("string").alias(source), word_count(F.col(text_col).cast("string")).alias("size"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("mix_order"))
    d = written(d, "sized")
    digits = max(1, -(-(-(-d.count() // bucket_rows)).bit_length() // 4))
    d = d.withColumn("mix_bucket", F.left("mix_order", F.lit(digits)))
    sums = written(d.groupBy(source, "mix_bucket").agg(F.sum("size").alias("n")), "sums")
    goals = targets(sums.select(F.col(source).alias("source"), F.col("n").alias("size")), weights, budget_percent, most_passes)
    upto = Window.partitionBy(source).orderBy("mix_bucket")
    sums = sums.withColumn("mix_before", F.sum("n").over(upto) - F.col("n")).drop("n")
    known = sums.join(goals, F.col(source).eqNullSafe(goals["source"])).select(F.col(source).alias("s"), F.col("mix_bucket").alias("b"), "mix_before", "place", "source_size", "target")
    n, names = sums.agg(F.count("*"), F.sum(F.coalesce(F.octet_length(source), F.lit(0)))).first()
    if 200 * n + 2 * (names or 0) <= BROADCAST_BYTES:
        known = F.broadcast(known)  # else each document would be shuffled twice
    within = Window.partitionBy(source, "mix_bucket").orderBy("mix_order", id_col, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("mix_here", F.sum("size").over(within) - F.col("size"))
    d = d.join(known, F.col(source).eqNullSafe(F.col("s")) & (F.col("mix_bucket") == F.col("b"))).withColumn(start, F.col("mix_before") + F.col("mix_here"))
    goal = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size")).cast("long")).otherwise(0)
    rest = goal - passes * F.col("source_size") - F.col(start)
    if cut:
        part = F.greatest(F.lit(0), F.least("size", rest))
    else:
        part = F.when(2 * rest >= F.col("size"), F.col("size")).otherwise(0)
    d = d.withColumn("taken", (passes * F.col("size") + part).cast("long"))
    share = (F.col(start) + F.least("size", "taken") / 2.0) / F.col("target")
    d = d.withColumn("position", F.when(F.col("taken") > 0, time_of(F.least(share, F.lit(1.0)), F.col("place"), schedules)))
    return d.select(id_col, *keep, "size", "source_size", "target", "taken", "position", F.col(start), F.col("place").alias("mix_place"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mixed documents, whole, one row for each time one is taken, with
    the columns of ``docs`` and ``mix_position``, range-sorted by it.

    A source is met to within half of its last document. See ``plan`` for
    nulls, ties and repeats.
    """
    row = free_name(docs.columns, "mix_row")
    position = free_name(docs.columns, "mix_position")
    at = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), F.col(id_col).alias("mix_id"), F.col(text_col).alias("mix_text"), F.col(source_col).alias("mix_from"))
    p = plan(at, "mix_id", "mix_text", "mix_from", cut=False, keep=(row,), **options)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    p = p.where("taken > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), times - 1)))
    share = (F.col("pass") * F.col("source_size") + F.col("mix_start") + F.col("size") / 2.0) / F.col("target")
    p = p.withColumn(position, time_of(F.least(share, F.lit(1.0)), F.col("mix_place"), options.get("schedules", SCHEDULES)))
    return p.select(f"{row}.*", position).sort(position)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = plan(table(spark, sf_dir, "documents"))
    # Documents that are not taken follow in the order of their streams.
    p = p.sort(F.coalesce("position", 1 + F.try_divide("mix_start", "source_size"), F.lit(2.0)), "doc_id")
    return p.select("doc_id", "size", "source_size", "target", "taken", "position")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, text, '')) AS o
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, sum(source_size) OVER () * 150 / 100.0::DOUBLE AS budget FROM s),
c AS (
  SELECT *, cap * (sum(weight) OVER () - sum(weight) OVER r + weight) <= weight * (budget - sum(cap) OVER r + cap) AS capped
  FROM w WINDOW r AS (ORDER BY cap::DOUBLE / weight, place)),
t AS (
  SELECT source, source_size, place,
         CASE WHEN capped THEN cap::DOUBLE ELSE weight * (budget - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target
  FROM c),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.place, floor(t.target)::BIGINT AS goal,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.o, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS passes FROM p),
x AS (
  SELECT *, passes * size + greatest(0, least(size, goal - passes * source_size - start)) AS taken FROM k),
u AS (SELECT *, least((start + least(size, taken) / 2.0::DOUBLE) / target, 1.0::DOUBLE) AS share FROM x)
SELECT doc_id, size, source_size, target::DOUBLE AS target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN CASE place % 3
         WHEN 0 THEN share
         WHEN 1 THEN (sqrt(0.25::DOUBLE + 2.0::DOUBLE * share) - 0.5::DOUBLE) / 1.0::DOUBLE
         ELSE (sqrt(2.25::DOUBLE + -2.0::DOUBLE * share) - 1.5::DOUBLE) / -1.0::DOUBLE END END AS position
FROM u
"""

QUERIES = {"op3_mix_sources": op3_mix_sources}
ORACLES = {"op3_mix_sources": ORACLE}
