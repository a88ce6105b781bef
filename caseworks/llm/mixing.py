"""Mixing sources to target weights by Pareto order sampling, with DataFrame operations only.

Each source has a target in words. A document's expected copies are the source's rate, tilted by its length:
longer texts are somewhat likelier to be taken (bounded, and balanced so that the expected words still add up
to the target). The whole part is certain. The rest is the inclusion probability ``p`` of an order sample:
every document draws a keyed uniform ``u``, its place is ``(u / (1 - u)) / (p / (1 - p))``, and the smallest
places are taken until the fixed size, counted in words, is full. So a source misses its target by at most
half of the document at the edge.

The edge is one (place, doc_id, size) per source, found without sorting a source: the words per place bucket
are summed, only the bucket that crosses the target is split again, and only the rows of the last, tiny bucket
are put in order, those equal in place, doc_id and size as one. Rows without a rest (in a source at its cap, say) are
certain and take no part in that. A source with a third of all rows is spread like any other. The edges (one row per source)
are then joined to the documents, so copies follow from the row itself and need no row key.

Rows without a source form the last source, a NULL or empty text has size 0 and is never taken for words, rows
without a doc_id draw one common number, and rows equal in doc_id, size and source are taken or left alike. A
source whose texts are all empty has target 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseworks.llm.support import packed, settled, unpacked, word_count

SEED = "mix-1"
MOST_COPIES = 3
TILT = 0.5  # share of the room around the rate that the length tilt may use
HALF_LENGTH = 500  # words at which the length score is half of its maximum
BUCKETS = 1024
CERTAIN = 1e300  # the place of rows without a rest, behind all others
FEW_SOURCES = 10_000  # rows of about 100 bytes; with more sources the joins shuffle


def _length_score(size: str) -> Column:
    """0 for empty texts, up to 999 for very long ones, in whole numbers so that sums are exact."""
    return F.expr(f"{size} * 1000 div ({size} + {HALF_LENGTH})")


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and the mean length score of its words.

    Sources weigh 1, 2, 3, repeating, by code point, NULL last. A target stops at three times its source; the
    excess goes to the others by weight until none is above, which is one level for all that are not full.
    The windows here see one row per source, not documents.
    """
    per = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(F.col("size") * _length_score("size")).alias("scored")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("bigint"))
    per = per.withColumn("cap", MOST_COPIES * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumns({
        "left": F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        "weights": F.sum("weight").over(onward),
    })
    per = per.withColumn("full", F.col("cap") <= F.col("weight") * F.col("left") / F.col("weights"))
    # The first source that is not full sees what all full ones leave.
    first_open = F.max(F.when(~F.col("full"), F.struct("weights", "left"))).over(whole)
    per = per.withColumn("open", first_open)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("open.left") / F.col("open.weights")
    )
    has = F.col("source_size") > 0
    return per.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(has, target / F.col("source_size")).otherwise(0.0).alias("rate"),
        F.when(has, F.col("scored") / F.col("source_size")).otherwise(0.0).alias("mean_score"),
    )


def _placed(rows: DataFrame, seed: str) -> DataFrame:
    """Adds ``whole`` copies, the Pareto ``place`` and its buckets to rows with the figures of their source."""
    room = F.least(F.col("rate"), MOST_COPIES - F.col("rate"))
    expected = F.col("rate") + TILT * room * (_length_score("size") - F.col("mean_score")) / 1000
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))), 1, 13), 16, 10)
    rows = rows.withColumn("expected", expected).withColumn("u", (draw.cast("bigint") + 0.5) / float(2**52))
    rows = rows.withColumn("whole", F.floor("expected"))
    rows = rows.withColumn("p", F.col("expected") - F.col("whole"))
    place = F.when(F.col("p") > 0, F.col("u") * (1 - F.col("p")) / ((1 - F.col("u")) * F.col("p"))).otherwise(CERTAIN)
    rows = rows.withColumn("place", place).drop("expected", "u", "p")
    spread = F.col("place") / (1 + F.col("place")) * BUCKETS
    rows = rows.withColumn("b1", F.least(F.floor(spread), F.lit(BUCKETS - 1)))
    return rows.withColumn("b2", F.least(F.floor((spread - F.col("b1")) * BUCKETS), F.lit(BUCKETS - 1)))


def _with_source(rows: DataFrame, per_source: DataFrame, how: str = "inner", small: bool = False) -> DataFrame:
    """``rows`` joined with one row per source, NULL sources included. ``small``: the sources were counted and are
    at most ``FEW_SOURCES``, so they are sent to every task and ``rows`` stay where they are."""
    other = per_source.withColumnRenamed("source", "_source")
    other = F.broadcast(other) if small else other
    return rows.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _crossing(sums: DataFrame, bucket: str) -> DataFrame:
    """The first bucket per source whose words reach what is left (the last one if none does), and what is
    left when it begins. The window sees one row per bucket."""
    order = Window.partitionBy("source").orderBy(bucket)
    up_to = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    sums = sums.withColumn("up_to", up_to).withColumn("_final", F.lead(bucket).over(order).isNull())
    reached = sums.filter((F.col("up_to") >= F.col("left")) | F.col("_final"))
    found = F.struct(bucket, (F.col("left") - F.col("up_to") + F.col("words")).alias("left"))
    return reached.groupBy("source").agg(F.min(found).alias("_c")).select("source", f"_c.{bucket}", "_c.left")


def _edges(sized: DataFrame, targets: DataFrame, seed: str, small: bool) -> DataFrame:
    """``targets`` with ``edge``, the last (buckets, place, doc_id, size) that each source takes."""
    rows = _placed(_with_source(sized, targets, small=small), seed)
    rows = rows.select("source", "target", "doc_id", "size", "whole", "b1", "b2", "place")
    rows = rows.withColumn("b1", F.when(F.col("place") < CERTAIN, F.col("b1")))
    first = rows.groupBy("source", "b1").agg(
        F.sum("size").alias("words"), F.sum(F.col("whole") * F.col("size")).alias("sure"), F.first("target").alias("target")
    )
    every = Window.partitionBy("source")
    first = first.withColumn("left", F.first("target").over(every) - F.sum("sure").over(every))
    at1 = _crossing(first.filter("b1 IS NOT NULL"), "b1")
    inner = _with_source(rows, at1.withColumnRenamed("b1", "at1"), small=small).filter("b1 = at1")
    second = inner.groupBy("source", "b1", "b2").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    at2 = _crossing(second, "b2")
    last = _with_source(inner.drop("left"), at2.withColumnRenamed("b2", "at2"), small=small).filter("b2 = at2")
    spot = ("source", "b1", "b2", "place", "doc_id", "size")
    last = last.groupBy(*spot).agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    order = Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("earlier", F.sum("words").over(order) - F.col("words"))
    # A row is taken while that brings the words nearer to the target. With no row of the last bucket taken,
    # the edge lies just before it: all rows of earlier buckets go in.
    taken = F.when(2 * F.col("earlier") + F.col("size") < 2 * F.col("left"), F.struct(*spot[1:]))
    before = F.struct(
        "b1", "b2", F.lit(-1.0).alias("place"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(-1).cast("bigint").alias("size")
    )
    edge = last.groupBy("source").agg(F.max(F.coalesce(taken, before)).alias("edge"))
    return _with_source(targets, edge, "left")


def _copies(documents: DataFrame, seed: str) -> DataFrame:
    """``_own`` (the row), doc_id, size, source_size, target and copies of every row."""
    size = word_count(F.col("text").cast("string")).alias("size")
    key = F.col("doc_id").cast("bigint").alias("doc_id")
    sized = settled(documents.select(key, F.col("source").cast("string").alias("source"), size))
    targets = settled(source_targets(sized))
    small = targets.count() <= FEW_SOURCES
    edges = settled(_edges(sized, targets, seed, small))
    rows = packed(documents, key, F.col("source").cast("string").alias("source"), size)
    rows = _placed(_with_source(rows, edges, "left", small), seed)
    picked = F.coalesce(F.struct("b1", "b2", "place", "doc_id", "size") <= F.col("edge"), F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("whole") + picked.cast("bigint")).otherwise(0)
    return rows.select("_own", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def copies_per_row(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """``documents`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to 3) of each row.

    Needs the columns doc_id (whole number), text and source. Columns of ``documents`` with one of the added
    names are replaced; all others are kept whatever their names.
    """
    added = ("size", "source_size", "target", "copies")
    own = [c for c in documents.columns if c.lower() not in added]
    return _copies(documents, seed).select(*unpacked(own), *added)


def mixed(documents: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``documents``."""
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("_copy")
    return _copies(documents, seed).filter("copies > 0").select("_own", copy).select(*unpacked(documents.columns))


def op1_source_mixing(documents: DataFrame) -> DataFrame:
    rows = copies_per_row(documents.select("doc_id", "text", "source"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


# The same draw and the same rule, with one sort per source instead of buckets.
SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(list_filter(string_split_regex(text, '[ \\x09-\\x0D]+'), lambda x: x <> '')), 0)::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size * ((size * 1000) // (size + {HALF_LENGTH})))::BIGINT AS scored,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * sum(size)::BIGINT AS cap
  FROM sized GROUP BY source),
filled AS (
  SELECT *, sum(source_size) OVER ()::BIGINT - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
    sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights
  FROM per WINDOW f AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
marked AS (SELECT *, cap <= (weight * rest)::DOUBLE / weights AS is_full FROM filled),
targets AS (
  SELECT source, source_size, scored, CASE WHEN is_full THEN cap::DOUBLE ELSE (weight * first_open.rest)::DOUBLE / first_open.weights END AS target
  FROM (SELECT *, max(CASE WHEN NOT is_full THEN {{'weights': weights, 'rest': rest}} END) OVER () AS first_open FROM marked)),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CASE WHEN source_size > 0 THEN scored::DOUBLE / source_size ELSE 0 END AS mean_score FROM targets),
expected AS (
  SELECT doc_id, size, s.source, source_size, target,
    rate + {TILT}::DOUBLE * least(rate, {MOST_COPIES} - rate) * (((size * 1000) // (size + {HALF_LENGTH})) - mean_score) / 1000 AS e,
    (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'none')), 1, 13))::BIGINT + 0.5::DOUBLE) / {2**52}::DOUBLE AS u
  FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
placed AS (
  SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS p FROM expected),
ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS up_to,
    target - sum(whole * size) OVER (PARTITION BY source) AS rest
  FROM (SELECT *, CASE WHEN p > 0 THEN u * (1 - p) / ((1 - u) * p) ELSE 1e300 END AS place FROM placed))
SELECT doc_id, size, source_size, target,
  (CASE WHEN size > 0 THEN whole + (2 * up_to - size < 2 * rest)::INT ELSE 0 END * size)::BIGINT AS taken
FROM ordered
"""
