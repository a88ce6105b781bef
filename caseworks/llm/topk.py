"""Exact top-k search with an impact-ordered index, processed score at a time.

Components are whole numbers. Rows are dealt into blocks of about ``BLOCK`` vectors, and the queries pass by each block
in batches (``met``): a block is indexed once, whatever the number of queries, nothing is broadcast and the memory of a
task is fixed. A block is indexed by dimension: postings in the order of impact, quantised to ``STEP``, or to a larger
power of two where components are large. For a positive query component the impact is the distance above the block's
minimum, for a negative one the distance below its maximum, so all contributions are positive and sums only grow.

A query takes posting segments in descending contribution, round by round down to a falling bar. Each vector sums what
its postings bring and counts them, so what it can still gain is bounded: the bar for every dimension not yet seen,
and the quantisation. The exact scores of the k best sums bound the answer from below. As soon as all but a small
share of the vectors provably cannot reach that, the possible members are rescored exactly; if no proof comes, all
segments are taken first. The best k of each block are merged per query.

Sums of quantised contributions are kept under 2**60, by dividing a query's weights (rounded up, so that bounds hold) where
they are large; exact scores are taken in Python's integers where 64 bits may not do. Whole components beyond 2**56
either way count as 2**56. Scores are compared exactly whatever their size; one beyond 64 bits is shown as the nearest
64-bit value.

Vectors that are NULL or hold a NULL or non-finite component take no part, nor do rows without vec_id; a shorter
vector counts as padded with zeros. Repeated rows are candidates each, and one query. A query never finds rows of
its own vec_id. Equal scores go to the smaller vec_id. Further columns, whatever their names, are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseworks.llm.met import matrix, met

BLOCK = 16_384
STEP = 2
BARS = (0.3, 0.15, 0.1, 0.07, 0.045, 0.025, 0.0)  # shares of the largest contribution, one per round
FEW = 16  # rescoring one in so many vectors is cheaper than another round
_ONE = 1 << 40  # a posting's count, above any sum
_LARGEST = 2**56
_INT64 = 2**63 - 1


class BlockIndex:
    """Impact-ordered postings of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.most = [int(x) for x in np.abs(vectors).max(axis=0, initial=0)]
        self.low, self.high = vectors.min(axis=0), vectors.max(axis=0)
        self.step = STEP
        while int((self.high - self.low).max(initial=0)) // self.step >= 1 << 30:
            self.step *= 2
        order = np.argsort(vectors, axis=0, kind="stable").T.copy()  # by dimension, ascending
        ranked = np.take_along_axis(vectors.T, order, axis=1)
        self.postings = []
        for d in range(len(order)):
            # Rows and quantised impacts, largest first: for positive query components, then for negative ones.
            up = np.ascontiguousarray(order[d][::-1]), np.ascontiguousarray((ranked[d] - self.low[d])[::-1] // self.step)
            down = order[d], (self.high[d] - ranked[d]) // self.step
            self.postings.append([(rows, impact, int(impact[0]) if len(impact) else 0) for rows, impact in (up, down)])

    def _scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if sum(abs(q) * most for q, most in zip(query.tolist(), self.most)) >= 1 << 62:
            return self.vectors[rows].astype(object) @ query.astype(object)
        return self.vectors[rows] @ query

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best rows of the block for one query, as (vec_id, score)."""
        others = np.flatnonzero(self.ids != query_id)
        k = min(k, len(others))
        if k == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        parts = [(d, abs(q), q > 0) for d, q in enumerate(query.tolist()) if q]
        terms = [(w, *self.postings[d][0 if positive else 1]) for d, w, positive in parts]
        scale = 1
        while sum(-(-w // scale) * most for w, _, _, most in terms) >= 1 << 60:
            scale *= 2
        terms = [(-(-w // scale), *posting) for w, *posting in terms]
        base = sum(w * int(self.low[d]) if positive else -w * int(self.high[d]) for d, w, positive in parts)
        weights = sum(w for w, *_ in terms)
        top = max((w * most for w, _, _, most in terms), default=0)
        # Sums and counts of postings share a number where every sum stays below the count.
        apart = sum(w * most for w, _, _, most in terms) >= _ONE
        packed, done, members = np.zeros(len(self.ids), dtype=np.int64), [0] * len(terms), others
        counted = np.zeros(len(self.ids), dtype=np.int64) if apart else None
        for share in BARS:
            bar = int(top * share)
            active, idle = 0, 0
            for t, (w, rows, impact, most) in enumerate(terms):
                # All segments of this dimension with a contribution of at least the bar.
                level = bar // w
                if level > most:
                    idle += w * most
                    continue
                active += 1
                a, b = done[t], len(impact) - int(impact[::-1].searchsorted(level))
                if b > a:
                    if apart:
                        packed[rows[a:b]] += impact[a:b] * w
                        counted[rows[a:b]] += 1
                    else:
                        packed[rows[a:b]] += impact[a:b] * w + _ONE
                    done[t] = b
            sums, seen = (packed, counted) if apart else (packed & (_ONE - 1), packed >> 40)
            if share:
                gain = bar * (active - seen) + idle
            else:
                gain = 0
            best = others[np.argpartition(-sums[others], k - 1)[:k]]
            least = int(self._scores(best, query).min())
            # Postings hold the impact without its remainder, which is under the step: a vector's score is at most
            # base + scale * (step * (sum + gain) + (step - 1) * weights).
            needed = -((base + scale * (self.step - 1) * weights - least) // (scale * self.step))
            members = others[(sums + gain)[others] >= min(max(needed, -_INT64), _INT64)]
            if len(members) * FEW <= len(others) + FEW * k:
                break
        scores = self._scores(members, query)
        best = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members[best]], scores[best]


def _padded(vectors: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, wide - vectors.shape[1])))


def _searched(k: int, n_chunks: int):
    def search(rows: pa.Table, queries: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = BlockIndex(rows["vec_id"].to_numpy(), matrix(rows["vector"]))
        chunk = rows["block"][0].as_py() % n_chunks
        for batch in queries:
            batch = batch.filter(pa.array(batch.column("chunk").to_numpy() == chunk))
            wanted = matrix(batch.column("vector"))
            if wanted.shape[1] > index.vectors.shape[1]:
                index = BlockIndex(index.ids, _padded(index.vectors, wanted.shape[1]))
            found = []
            for q, v in zip(batch.column("vec_id").to_pylist(), _padded(wanted, index.vectors.shape[1])):
                ids, scores = index.search(q, v, k)
                found += [(q, i, Decimal(score)) for i, score in zip(ids.tolist(), scores.tolist())]
            kinds = (pa.int64(), pa.int64(), pa.decimal128(38, 0))
            columns = zip(*found) if found else [()] * 3
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["query_id", "vec_id", "score"])

    return search


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and whole-number ``vector`` of the rows that take part."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = lambda v: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.floor(256 * v)))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    return rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, whole).alias("vector")
    )


def top_k(vectors: DataFrame, queries: DataFrame, k: int, n_blocks: int, n_chunks: int = 1) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of ``vectors`` for each of ``queries``. With ``n_chunks`` each
    block is held by that many tasks, which share the queries: for more tasks than there are blocks."""
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))
    rows = vectors.select("vec_id", "vector", deal(n_blocks).alias("block"), copies.alias("copy"))
    rows = rows.select("vec_id", "vector", (F.col("block") * n_chunks + F.col("copy")).cast("int").alias("block"))
    wanted = queries.select("vec_id", "vector", deal(n_chunks).alias("chunk")).dropDuplicates()
    found = met(rows, wanted, n_blocks * n_chunks, _searched(k, n_chunks), "query_id bigint, vec_id bigint, score decimal(38,0)")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    shown = F.least(F.lit(_INT64), F.greatest(F.lit(-_INT64), "score")).cast("bigint").alias("score")
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", shown)


def op10_exact_top_k(embeddings: DataFrame) -> DataFrame:
    vectors = quantised(embeddings)
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5, embeddings.count() // BLOCK + 1)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.vector, c.vector), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
