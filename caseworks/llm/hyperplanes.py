"""Near-duplicate vectors of equal label: random-hyperplane signs in several tables, exact cosines, connected components.

A table's key is the signs of a vector's products with a set of random hyperplanes; vectors at an angle t agree on a
sign with probability 1 - t/pi. The signs per table follow the logarithm of the number of vectors, so that unlike
vectors rarely share a bucket, and the tables are as many as make a pair of exactly the least similarity share no bucket
with probability ``MISS`` at most (a closer pair: far less). Every vector is indexed; the planes depend on a seed only.

Equal vectors of a label are one class and take part once, with their number. Buckets with one class are dropped. In
each other bucket all pairs are compared exactly, in double precision, and no pair is written: a task adds up the
links of each class and gives it the smallest class that it reaches within the bucket, one row per class. A pair that
shares several tables is counted in the first of them alone, for which each row carries its keys of all tables. Large
buckets are split into parts of ``PART`` classes and every two parts meet in a group of their own; no bucket is capped.

Results: a vector that is NULL, empty, zero or holds a NULL or non-finite component, or has no label, is linked with
nothing; so are vectors of different lengths. Rows without vec_id take no part, are linked with nothing and are kept,
their component is NULL. Repeated rows (equal vec_id, label and vector) are one vector and give repeated result rows;
different rows with one vec_id are vectors of their own. Equal vectors are linked whatever rounding says. Components
of any finite size are scaled by a power of two first, so nothing overflows. Further columns are left out. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.components import components
from caseworks.llm.flat_text import lists
from caseworks.llm.met import matrix
from caseworks.llm.support import in_parts, settled

SIMILAR = 0.98
MISS = 0.0005
SEED = 12
LEAST_SIGNS, MOST_SIGNS = 8, 40
PART = 512  # classes of a bucket that meet in one group
SMALL = 24  # buckets of at most so many classes are compared many at a time
NUMBERS = 1 << 20  # components of small buckets' pairs that are compared at a time
PAIRS = 1 << 14


def shape(n: int, similar: float = SIMILAR, miss: float = MISS) -> tuple[int, int]:
    """Signs per table and number of tables for n vectors."""
    signs = min(MOST_SIGNS, max(LEAST_SIGNS, n.bit_length()))
    agree = 1 - math.acos(similar) / math.pi
    return signs, math.ceil(math.log(miss) / math.log1p(-(agree**signs)))


@cache
def _planes(wide: int, signs: int, tables: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, wide])).standard_normal((tables * signs, wide)).T.copy()


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one. A power of two brings the largest component near one, which loses nothing."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    scaled = np.ldexp(vectors, -power[:, None])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _keyed(signs: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for wide in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == wide)
                rows = batch.take(pa.array(at))
                keys = np.zeros((len(at), tables), dtype=np.int64)
                for a in range(0, len(at), 1024):
                    side = units(matrix(rows.column("vector").slice(a, 1024), np.float64)) @ _planes(wide, signs, tables) >= 0
                    bits = side.reshape(len(side), tables, signs).astype(np.int64)
                    keys[a : a + 1024] = (bits << np.arange(signs)).sum(axis=2)
                yield rows.append_column("keys", lists(keys.ravel(), np.full(len(at), tables), pa.int64()))

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


GROUP = ("bucket", "one", "other")


class _Rows:
    """The rows of some groups, sorted by group: of each its class, label, table, part, copies, keys and unit vector."""

    def __init__(self, rows: pa.Table):
        self.id, self.copies, self.part, self.table, self.label, self.one, self.other = (
            rows[c].to_numpy() for c in ("class", "copies", "part", "table", "label", "one", "other")
        )
        self.keys, self.unit = matrix(rows["keys"]), units(matrix(rows["vector"], np.float64))
        new = np.ones(len(self.id), dtype=bool)
        new[1:] = np.logical_or.reduce([own[1:] != own[:-1] for own in (rows[c].to_numpy() for c in GROUP)])
        self.bounds = np.append(np.flatnonzero(new), len(self.id))
        self.at_once = max(1, NUMBERS // max(1, self.unit.shape[1]))

    def _first(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no earlier table than their own has the pairs too."""
        earlier = np.arange(self.keys.shape[1]) < self.table[a][:, None]
        return ~((self.keys[a] == self.keys[b]) & earlier).any(axis=1)

    def _same_label(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets are met by hash, so that two of them might share a group."""
        same = self.label[a] == self.label[b]
        return a[same], b[same]

    def _dense(self, a: int, b: int, similar: float) -> tuple[np.ndarray, np.ndarray]:
        """Links of one group, by a product of matrices."""
        left = np.arange(a, b) if self.one[a] == self.other[a] else a + np.flatnonzero(self.part[a:b] == self.one[a])
        right = left if self.one[a] == self.other[a] else a + np.flatnonzero(self.part[a:b] == self.other[a])
        linked = self.unit[left] @ self.unit[right].T >= similar
        if left is right:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        return left[i], right[j]

    def _paired(self, groups: np.ndarray, similar: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of many small groups, pair by pair. Small groups are whole buckets."""
        first, size = self.bounds[groups], np.diff(self.bounds)[groups]
        pairs = size * (size - 1) // 2
        ends = np.cumsum(pairs)
        at = 0
        while at < len(groups):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.at_once, side="right")))
            own = slice(at, to)
            # Row r of a group of s meets the rows after it.
            row = np.repeat(first[own], size[own]) + (np.arange(size[own].sum()) - np.repeat(np.cumsum(size[own]) - size[own], size[own]))
            after = np.repeat(first[own] + size[own], size[own]) - row - 1
            a = np.repeat(row, after)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
            linked = np.einsum("ij,ij->i", self.unit[a], self.unit[b]) >= similar
            yield a[linked], b[linked]
            at = to

    def links(self, similar: float) -> Iterator[pa.RecordBatch]:
        """class, links found here, and the smallest class reached here, of every class with a link."""
        sizes = np.diff(self.bounds)
        small = (sizes <= SMALL) & (self.one == self.other)[self.bounds[:-1]]
        for g in np.flatnonzero(~small).tolist():
            yield from self._told(*self._dense(self.bounds[g], self.bounds[g + 1], similar))
        for a, b in self._paired(np.flatnonzero(small & (sizes > 1)), similar):
            yield from self._told(a, b)

    def _told(self, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = self._same_label(a, b)
        if not len(a):
            return
        new = np.concatenate([self._first(a[at : at + PAIRS], b[at : at + PAIRS]) for at in range(0, len(a), PAIRS)])
        places, local = np.unique(np.concatenate([a, b]), return_inverse=True)
        la, lb = local[: len(a)], local[len(a) :]
        count = np.zeros(len(places), dtype=np.int64)
        np.add.at(count, la[new], self.copies[b[new]])
        np.add.at(count, lb[new], self.copies[a[new]])
        # Numbered by class, so that the smallest place is the smallest class; a class is in several of these buckets.
        ids, number = np.unique(self.id[places], return_inverse=True)
        root = ids[_roots(len(ids), number[la], number[lb])][number]
        yield pa.record_batch({"class": self.id[places], "links": count, "root": root})


def _compared(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # What belongs to the batch's last group waits for the next batch.
            last = np.logical_and.reduce([own == own[-1] for own in (batch.column(c).to_numpy() for c in GROUP)])
            cut = batch.num_rows - int(last.sum())
            if cut:
                yield from _Rows(pa.Table.from_batches([*held, batch.slice(0, cut)])).links(similar)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from _Rows(pa.Table.from_batches(held)).links(similar)

    return run


def _takes_part() -> Column:
    """Whether a row may have links."""
    odd = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~odd & F.exists("embedding", lambda v: v != 0)
    return F.coalesce(good, F.lit(False))


def linked_classes(vectors: DataFrame, n: int, similar: float = SIMILAR, miss: float = MISS) -> DataFrame:
    """class, label, vector, copies, least vec_id, links and component of every distinct (label, vector)."""
    signs, tables = shape(n, similar, miss)
    classes = vectors.distinct().groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"))
    # Numbers are given once, as they are written.
    classes = settled(classes.withColumn("class", F.monotonically_increasing_id()))
    schema = "class bigint, label bigint, vector array<double>, copies bigint, keys array<bigint>"
    keyed = settled(classes.select("class", "label", "vector", "copies").mapInArrow(_keyed(signs, tables), schema))
    table = F.posexplode("keys").alias("table", "key")
    bucket = F.xxhash64("label", "wide", "table", "key")
    rows = keyed.select("class", "label", F.size("vector").alias("wide"), table).select("class", "table", bucket.alias("bucket"))
    sizes = settled(rows.groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    live = rows.join(sizes, ["table", "bucket"])
    # A bucket of one part is one group; in a larger one, each part meets itself and every other part.
    parts = F.ceil(F.col("size") / PART).cast("int")
    part = F.pmod(F.xxhash64("class"), parts).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("with")
    live = live.select("class", "table", "bucket", parts.alias("parts"), part.alias("part")).select("*", met)
    live = live.select("class", "table", "bucket", "part", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"))
    dealt = live.join(keyed, "class").withColumn("bucket", F.xxhash64("table", "bucket"))
    columns = ["class", "label", "table", "bucket", "part", "one", "other", "copies", "keys", "vector"]
    dealt = dealt.select(*columns).repartition(*GROUP).sortWithinPartitions(*GROUP)
    found = settled(dealt.mapInArrow(_compared(similar), "class bigint, links bigint, root bigint"))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("class").alias("a"), F.col("root").alias("b")).filter("a != b").distinct()
    roots = settled(components(edges))
    roots = in_parts(roots, roots.count()).select(F.col("node").alias("class"), "root")
    rows = classes.join(links, "class", "left").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    lowest = rows.groupBy("root").agg(F.min("low").alias("component_id"))
    return rows.join(lowest, "root").select("label", "vector", "copies", F.coalesce("links", F.lit(0)).alias("links"), "component_id")


def near_duplicates(embeddings: DataFrame, similar: float = SIMILAR, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept, for every row of ``embeddings``."""
    whole = F.transform("embedding", lambda v: v.cast("double") + F.lit(0.0))  # minus zero is zero
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), whole.alias("embedding"))
    valid = rows.filter(_takes_part()).withColumnRenamed("embedding", "vector")
    classes = settled(linked_classes(valid, rows.count(), similar, miss))
    linked = valid.join(classes, ["label", "vector"]).select("vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = rows.filter(~_takes_part()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_hyperplane_near_dedup(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings.select("vec_id", "label", "embedding"))


SQL = """
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector)
  WHERE list_dot_product(a.vector, b.vector)
    / (sqrt(list_dot_product(a.vector, a.vector)) * sqrt(list_dot_product(b.vector, b.vector))) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM embeddings e LEFT JOIN counted c ON e.vec_id = c.a LEFT JOIN lowest w ON e.vec_id = w.a
"""
