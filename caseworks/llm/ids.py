"""Keeping only the rows of wanted ids before a wide shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.llm.flat_text import mix

BITS = 25  # the bit map that is sent to the tasks holds 2**25 bits, 4 MB, whatever the number of ids


def _places(values: np.ndarray, bits: int) -> np.ndarray:
    return (mix(values.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def bit_map(values: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """A bit per hash of the values. Its size is fixed, and so is what reaches the driver: at most one row per
    64 bits, since the bits are gathered into words by the executors."""

    def placed(batches):
        for batch in batches:
            own = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
            at = _places(own, bits)
            yield pa.record_batch({"word": at >> 6, "bit": np.int64(1) << (at & 63)})

    words = values.select(F.col(column).cast("bigint")).mapInArrow(placed, "word bigint, bit bigint")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def is_set(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) == 1


def has(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether values may be among those of a bit map."""
    return is_set(bitmap, _places(values, (len(bitmap) * 64).bit_length() - 1))


def possible(rows: DataFrame, column: str, bitmap) -> DataFrame:
    """The rows whose id may be among those of a broadcast bit map. Some others stay: a join must follow."""
    bits = (len(bitmap.value) * 64).bit_length() - 1

    def kept(batches):
        for batch in batches:
            own = batch.column(column)
            values = own.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            good = is_set(bitmap.value, _places(values, bits)) & own.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(good))

    return rows.mapInArrow(kept, rows.schema)
