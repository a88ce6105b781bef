"""Rows in blocks of a fixed size, met by a stream of queries: each block is read once, whatever the number of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a block's owner gets: its rows, then the queries as batches, one after another.
Search = Callable[[pa.Table, Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]


def met(rows: DataFrame, queries: DataFrame, n_blocks: int, search: Search, schema: str, order: tuple[str, ...] = ()) -> DataFrame:
    """What ``search`` finds in each block (int column ``block``, 0 to ``n_blocks`` - 1) of ``rows`` for ``queries``.

    The queries are copied to every block and come after its rows, so that only the block is held in memory and the
    queries pass by in batches. Blocks are dealt by their number: one task each, and an equality throughout. Columns
    that one side lacks are NULL there. A block without rows or queries gives nothing.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    held = rows.withColumn("_query", F.lit(False))
    passing = queries.withColumns({"_query": F.lit(True), "block": every})
    both = held.unionByName(passing, allowMissingColumns=True)
    dealt = both.repartitionById(n_blocks, "block").sortWithinPartitions("block", "_query", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts(batches)
        part = next(parts, None)
        while part is not None:
            number, own = part[0], []
            while part is not None and part[0] == number and not part[1]:
                own.append(part[2])
                part = next(parts, None)

            def passing_by() -> Iterator[pa.RecordBatch]:
                nonlocal part
                while part is not None and part[0] == number:
                    yield part[2]
                    part = next(parts, None)

            rest = passing_by()
            if own:
                yield from search(pa.Table.from_batches(own), rest)
            for _ in rest:
                pass

    return dealt.mapInArrow(run, schema)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(block, whether queries, rows) for each run of equal values."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy(zero_copy_only=False).astype(np.int64)
        kind = batch.column("_query").to_numpy(zero_copy_only=False).astype(bool)
        cuts = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            yield int(block[a]), bool(kind[a]), batch.slice(a, b - a)


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """A list column as a matrix; shorter lists are padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=kind)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
