"""Hard negatives: for an anchor and one of its nearest rows of the same label, the best rows of other labels whose score
lies in a band below the positive's. Scores are exact inner products of whole numbers, many to a multiplication.

**Kronecker packing.** Anchors' and candidates' components are raised by a bias, so that none is negative. Several
candidates' components of one dimension then lie in separate fields of one wide integer, and one multiplication by an
anchor's component multiplies them all; the products of all dimensions are added up. A field is as wide as the largest
sum that the block and the anchors can make, so that no field runs over, and what the biases added is taken off when
the fields are unpacked: the scores are exact. Wide integers are 64-bit machine words where two or more fields, or one,
fit in; larger components use Python's integers without a limit, with all candidates of a block in one integer.

Rows are dealt into blocks of about ``BLOCK`` and the anchors pass by each block in batches (``met``), once for the
positives (each label's anchors meet only the rows of that label) and once, with the bands found, for the negatives. A
block gives at most the wanted number per anchor, or anchor and positive; the best of all blocks are ranked per key.
Nothing is broadcast. The work is anchors times rows, as the anchors are a fixed share of all rows.

Results for odd rows: rows without vec_id, label or vector, or with a NULL or non-finite component, take no part. A
vec_id names one vector: repeated rows count once, and of different rows with one vec_id the one with the least
(label, vector) takes part. A shorter vector counts as padded with zeros, an empty one as zeros. Equal scores go to the
smaller vec_id. Whole components beyond 2**56 either way count as 2**56. Scores are compared exactly whatever their
size; one beyond 64 bits is shown as the nearest 64-bit value. Further columns, whatever their names, are left out. An
empty table, or a label with a single row, gives no rows for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseworks.llm.met import matrix, met
from caseworks.llm.support import settled

BLOCK = 8192
CHUNK = 64  # anchors that meet a block at once
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # percent of the positive's score
_U = np.uint64
_INT64 = 2**63 - 1
_LARGEST = 2**56


class Packed:
    """A block's vectors (rows by dimensions, int64) in fields of wide integers."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.bias = max(0, -int(vectors.min(initial=0)))
        self.highest = [int(v) + self.bias for v in vectors.max(axis=0, initial=-_INT64)] if len(vectors) else []
        self.width, self.words = 0, None
        self.sums = [sum(row) for row in vectors.tolist()] if self.large else vectors.sum(axis=1)

    @property
    def large(self) -> bool:
        """Whether sums of components may leave 64 bits."""
        return (max(self.highest, default=0) + self.bias) * max(1, len(self.highest)) >= 1 << 62

    def _pack(self, width: int) -> None:
        """Fields of ``width`` bits. Machine words hold row i of field f at place f * words + i."""
        if self.width == width:
            return
        self.width = width
        n, wide = self.vectors.shape
        if width > 64 or self.large:
            size = -(-width // 8)
            self.words = [
                int.from_bytes(b"".join((x + self.bias).to_bytes(size, "little") for x in self.vectors[:, d].tolist()), "little")
                for d in range(wide)
            ]
            return
        fields = 64 // width
        words = -(-n // fields)
        raised = np.zeros((words * fields, wide), dtype=_U)
        raised[:n] = (self.vectors + self.bias).astype(_U)
        self.words = np.zeros((wide, words), dtype=_U)
        for f in range(fields):
            self.words |= raised[f * words : (f + 1) * words].T << _U(f * width)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products, anchors by rows: int64, or Python integers where those may be too large."""
        n, wide = self.vectors.shape
        bias = max(0, -int(anchors.min(initial=0)))
        raised = [[x + bias for x in row] for row in anchors.tolist()]
        most = max((sum(a * x for a, x in zip(row, self.highest)) for row in raised), default=0)
        width = max(1, most.bit_length())
        # Fields are widened only, so that a block is packed anew a few times at most.
        exact = width > 62 or self.large or any(sum(map(abs, row)) * self.bias >= 1 << 62 for row in anchors.tolist())
        exact = exact or bias * max(1, self.bias) * wide >= 1 << 62
        if exact:
            return self._exact(anchors.tolist(), raised, bias, max(width, self.width))
        self._pack(max(width, self.width) if self.width <= 64 else width)
        fields = 64 // self.width
        total = np.zeros((len(raised), self.words.shape[1]), dtype=_U)
        factors = np.array(raised, dtype=_U).reshape(len(raised), wide)
        product = np.empty_like(total)
        for d in range(wide):
            np.multiply(factors[:, d, None], self.words[d], out=product)
            total += product
        mask = _U((1 << self.width) - 1)
        unpacked = np.concatenate([(total >> _U(f * self.width)) & mask for f in range(fields)], axis=1)[:, :n].astype(np.int64)
        return unpacked - (self.bias * anchors.sum(axis=1))[:, None] - bias * self.sums - wide * bias * self.bias

    def _exact(self, anchors: list, raised: list, bias: int, width: int) -> np.ndarray:
        n, wide = self.vectors.shape
        self._pack(max(width, 65))
        size = -(-self.width // 8)
        out = np.empty((len(anchors), n), dtype=object)
        for i, (own, row) in enumerate(zip(anchors, raised)):
            total = sum(a * word for a, word in zip(row, self.words)).to_bytes(n * size, "little")
            off = self.bias * sum(own) + wide * bias * self.bias
            for j in range(n):
                out[i, j] = int.from_bytes(total[j * size : (j + 1) * size], "little") - off - bias * int(self.sums[j])
        return out


def _best(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of the places, which ascend, those of the k highest scores; equal scores by place."""
    own = scores[places]
    if len(places) > k and own.dtype != object:
        near = own >= np.partition(own, len(own) - k)[len(own) - k]
        places, own = places[near], own[near]
    return places[np.argsort(-own, kind="stable")[:k]]


def _padded(vectors: np.ndarray, wide: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, wide - vectors.shape[1])))


def _block(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors by ascending id, so that places break ties."""
    ids = rows["vec_id"].to_numpy()
    order = np.argsort(ids)
    return ids[order], rows["label"].to_numpy()[order], matrix(rows["vector"])[order]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _columns(names: list[str], found: list[tuple]) -> pa.RecordBatch:
    """Scores travel as decimals, since they may be wider than 64 bits."""
    kinds = [pa.decimal128(38, 0) if name.endswith("score") else pa.int64() for name in names]
    values = zip(*found) if found else [()] * len(names)
    return pa.record_batch([
        pa.array([Decimal(int(v)) for v in own] if kind != pa.int64() else own, kind) for own, kind in zip(values, kinds)
    ], names)


def _positives(k: int):
    names = ["anchor_id", "positive_id", "positive_score"]

    def search(rows: pa.Table, anchors: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = _block(rows)
        own: dict[int, tuple[np.ndarray, Packed]] = {}
        for batch in _chunks(anchors):
            a_ids, a_labels, a_vectors = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("vector"))
            wide, found = max(vectors.shape[1], a_vectors.shape[1]), []
            for label in np.unique(a_labels).tolist():
                if label not in own or own[label][1].vectors.shape[1] < wide:
                    members = np.flatnonzero(labels == label)
                    own[label] = members, Packed(_padded(vectors[members], wide))
                members, packed = own[label]
                mine = np.flatnonzero(a_labels == label)
                scores = packed.scores(_padded(a_vectors[mine], packed.vectors.shape[1]))
                for i, row in zip(mine.tolist(), scores):
                    best = _best(row, np.flatnonzero(ids[members] != a_ids[i]), k)
                    found += [(int(a_ids[i]), int(ids[members[p]]), row[p]) for p in best.tolist()]
            yield _columns(names, found)

    return search


def _negatives(k: int, least: int, most: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def search(rows: pa.Table, anchors: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = _block(rows)
        packed = Packed(vectors)
        for batch in _chunks(anchors):
            a_ids, a_labels, a_vectors = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("vector"))
            if a_vectors.shape[1] > packed.vectors.shape[1]:
                packed = Packed(_padded(vectors, a_vectors.shape[1]))
            scores, found = packed.scores(_padded(a_vectors, packed.vectors.shape[1])), []
            for i, (row, positives) in enumerate(zip(scores, batch.column("positives").to_pylist())):
                other = labels != a_labels[i]
                for positive in positives:
                    score = int(positive["score"])
                    low, high = -(-least * score // 100), most * score // 100
                    if row.dtype != object:
                        low, high = min(max(low, -_INT64), _INT64), max(min(high, _INT64), -_INT64)
                    best = _best(row, np.flatnonzero(other & (row >= low) & (row <= high)), k)
                    found += [(int(a_ids[i]), positive["id"], score, int(ids[p]), row[p]) for p in best.tolist()]
            yield _columns(names, found)

    return search


def whole_vectors(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and whole-number vector of the rows that take part, one per vec_id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~odd)
    whole = F.transform(x, lambda v: F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.floor(256 * v))))
    row = F.struct(label.cast("bigint").alias("label"), whole.alias("vector"))
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), row.alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, n_blocks: int, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores. ``vectors`` and ``anchors`` have vec_id, label, vector."""
    rows = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int"))
    score = "decimal(38,0)"
    near = met(rows, anchors, n_blocks, _positives(positives), f"anchor_id bigint, positive_id bigint, positive_score {score}")
    near = _ranked(near, ["anchor_id"], "positive_score", "positive_id", positives)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")
    )
    bands = settled(anchors.join(near, "vec_id"))
    schema = f"anchor_id bigint, positive_id bigint, positive_score {score}, negative_id bigint, negative_score {score}"
    found = met(rows, bands, n_blocks, _negatives(negatives, least, most), schema)
    found = _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    shown = [F.least(F.lit(_INT64), F.greatest(F.lit(-_INT64), c)).cast("bigint").alias(c) for c in ("positive_score", "negative_score")]
    return found.select("anchor_id", "positive_id", "rank", "negative_id", *shown)


def _ranked(found: DataFrame, key: list[str], score: str, by: str, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), by))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def op11_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The contract's labels, anchors and bands over all rows."""
    n_blocks = embeddings.count() // BLOCK + 1
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = settled(whole_vectors(embeddings, label))
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"), n_blocks)


SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS vector FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT * FROM given QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, vector) = 1),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_sum(list_transform(list_zip(a.vector, c.vector), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM positives JOIN scored n USING (anchor_id)
  WHERE NOT n.same AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
