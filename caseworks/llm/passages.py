"""Substring deduplication: a count-min prefilter, then exact grouping of the windows estimated repeated.

A window is 50 consecutive words. Every word of a window whose word sequence also starts in a document with a
smaller doc_id is removed; all windows are judged on the input.

1. One scan gives each document its word count, the digest of its words and its anchors: of the 26 runs of 25
   words inside a window, the one with the smallest hash. Equal windows have equal anchors, and neighbours
   mostly share theirs, so there are about 13 times fewer anchors than windows.
2. Whole copies are settled by the digest: all windows of a copy start in the first document of its group.
3. The anchors of the first documents are counted in a count-min sketch: every task sums its own cells, the sums
   are merged by cell, and the cells counted twice or more become a bit map. Its size follows the number of anchors, up
   to 64 MB. An anchor in two documents always passes. What passes is grouped exactly by anchor.
4. The documents that hold an anchor of several documents are read again; their windows around such anchors are
   grouped exactly, by 128-bit hashes, with the smallest doc_id of each. Nothing that repeats is lost: a fuller
   sketch only lets more through.
5. Documents with a window that started earlier lose its words.

Groups are reduced before each shuffle (counts, minima); the joins back to occurrences are plain inner joins, which
adaptive execution splits where one window is very common. Rows without a doc_id keep their words and remove
none. Rows that share doc_id and text get equal results. NULL and empty texts have no words. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseworks.llm.flat_text import Slice, lists, run_hashes, signed, slices
from caseworks.llm.ids import bit_map, is_set, possible
from caseworks.llm.support import settled

WINDOW = 50
GRAM = 25
# Cells per row of the sketch: four an anchor, to the next power of two, and 2**28 at most. Two rows, one bit per cell
# when sent to the tasks. An anchor that does not repeat passes with (1 - exp(-anchors / cells))**2: 5% at most up to 67
# million anchors, some 40% with 270 million.
CELLS_PER_ANCHOR = 4
SKETCH_BITS = 28
_U = np.uint64


def words_digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def window_anchors(part: Slice, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, text and anchor of every window; also the word hashes."""
    hashes = part.word_hashes()
    counts = part.counts
    n = np.maximum(counts - window + 1, 0)
    if not n.any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(0, dtype=_U), hashes
    grams = np.arange(len(hashes) - gram + 1)
    lowest = _sliding_min(run_hashes(hashes, grams, grams + gram, 1), window - gram + 1)
    ends = np.cumsum(n)
    start = np.repeat(part.first[:-1], n) + np.arange(ends[-1]) - np.repeat(ends - n, n)
    return start, np.repeat(np.arange(len(n)), n), lowest[start], hashes


def _described(batches):
    for batch in batches:
        for at, to, part in slices(batch.column("text")):
            _, owner, anchor, _ = window_anchors(part)
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch({
                "doc_id": batch.column("doc_id")[at:to],
                "text_key": batch.column("text_key")[at:to],
                "n_words": pa.array(part.counts, pa.int64()),
                "words_sha256": pa.array([words_digest(part.text(i).split()) for i in range(to - at)]),
                "anchors": lists(signed(anchor[new]), np.bincount(owner[new], minlength=to - at), pa.int64()),
            })


def sketch_bits(anchors: int) -> int:
    """Cells per row for so many anchors, as a power of two."""
    return min(max(CELLS_PER_ANCHOR * anchors - 1, 63).bit_length(), SKETCH_BITS)


def _sketch(anchors: DataFrame, bits: int) -> np.ndarray:
    """Two rows of bits: the cells that were counted twice or more."""
    cells = 1 << bits
    place = F.array(
        F.col("anchor").bitwiseAND(cells - 1), F.shiftrightunsigned("anchor", 32).bitwiseAND(cells - 1) + cells
    )
    counted = anchors.select(F.explode(place).alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    one = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = counted.filter("n > 1").select(F.shiftright("cell", 6).alias("word"), one.alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(2 * cells // 64, dtype=_U)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(_U)
    return out


def _maybe_repeated(rows: DataFrame, sketch) -> DataFrame:
    """(doc_id, text_key, anchor) of the anchors that the sketch counts twice or more."""
    def kept(batches):
        mask = len(sketch.value) * 32 - 1
        for batch in batches:
            anchors = batch.column("anchors")
            flat = anchors.flatten().to_numpy(zero_copy_only=False)
            low, high = flat & mask, (flat.view(_U) >> _U(32)).astype(np.int64) & mask
            good = is_set(sketch.value, low) & is_set(sketch.value, high + mask + 1)
            owner = np.repeat(np.arange(len(anchors)), anchors.value_lengths().to_numpy(zero_copy_only=False))[good]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(owner)),
                "text_key": batch.column("text_key").take(pa.array(owner)),
                "anchor": flat[good],
            })

    return rows.select("doc_id", "text_key", "anchors").mapInArrow(kept, "doc_id bigint, text_key bigint, anchor bigint")


def _windows(batches):
    for batch in batches:
        listed = batch.column("anchors")
        for at, to, part in slices(batch.column("text")):
            start, owner, anchor, hashes = window_anchors(part)
            good = np.isin(anchor, listed[at:to].flatten().to_numpy(zero_copy_only=False).view(_U))
            start, owner = start[good], owner[good]
            yield pa.record_batch({
                "h1": signed(run_hashes(hashes, start, start + WINDOW, 2)),
                "h2": signed(run_hashes(hashes, start, start + WINDOW, 3)),
                "doc_id": batch.column("doc_id")[at:to].take(pa.array(owner)),
                "text_key": batch.column("text_key")[at:to].take(pa.array(owner)),
                "place": pa.array(start - part.first[owner], pa.int32()),
            })


def _cut(batches):
    for batch in batches:
        texts, starts = batch.column("text"), batch.column("starts")
        n_words, digests = [], []
        for text, begins in zip(texts, starts):
            words = (text.as_py() or "").encode().split()
            gone = np.zeros(len(words) + 1, dtype=np.int64)
            places = np.asarray(begins.values.to_numpy(zero_copy_only=False))
            np.add.at(gone, places, 1)
            np.add.at(gone, places + WINDOW, -1)
            gone = np.cumsum(gone)[:-1] > 0
            n_words.append(int(gone.sum()))
            digests.append(words_digest([w for w, out in zip(words, gone.tolist()) if not out]))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "removed": pa.array(n_words, pa.int64()),
            "rest_sha256": pa.array(digests, pa.string()),
        })


def _documents(documents: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _readable(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts that may have one of the ids."""
    return possible(_documents(documents), "doc_id", documents.sparkSession.sparkContext.broadcast(bit_map(ids, "doc_id")))


def described(documents: DataFrame) -> DataFrame:
    return _documents(documents).mapInArrow(
        _described, "doc_id bigint, text_key bigint, n_words bigint, words_sha256 string, anchors array<bigint>"
    )


def repeated_starts(firsts: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, starts): the windows of each document that also start in an earlier one.

    ``firsts`` holds the anchors of the documents to look at.
    """
    firsts = settled(firsts)
    found = firsts.agg(F.sum(F.size("anchors")).alias("n")).first().n or 0
    single = firsts.select(F.explode("anchors").alias("anchor"))
    sketch = documents.sparkSession.sparkContext.broadcast(_sketch(single, sketch_bits(found)))
    passed = settled(_maybe_repeated(firsts, sketch))
    shared = passed.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low != high")
    per_document = settled(
        passed.join(shared.select("anchor"), "anchor").groupBy("doc_id", "text_key").agg(F.collect_set("anchor").alias("anchors"))
    )
    windows = (
        _readable(documents, per_document)
        .join(per_document, ["doc_id", "text_key"])
        .select("doc_id", "text_key", "text", "anchors")
        .mapInArrow(_windows, "h1 bigint, h2 bigint, doc_id bigint, text_key bigint, place int")
    )
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low != high")
    # Settled, so that the join meets it as a plain shuffle and can split a hot window.
    later = windows.join(settled(first.drop("high")), ["h1", "h2"]).filter("doc_id > low")
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("starts"))


def deduplicated(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``documents``."""
    rows = settled(described(documents))
    long_enough = rows.filter((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
    # The first document of each group of whole copies; the others lose every word.
    groups = long_enough.groupBy("words_sha256").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    groups = groups.select("words_sha256", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    rows = settled(rows.join(groups, "words_sha256", "left"))
    firsts = rows.filter("doc_id = first_id AND text_key = first_key").select("doc_id", "text_key", "anchors").dropDuplicates(["doc_id", "text_key"])
    gone = settled(repeated_starts(firsts, documents))
    cut = _readable(documents, gone).join(gone, ["doc_id", "text_key"]).mapInArrow(
        _cut, "doc_id bigint, text_key bigint, removed bigint, rest_sha256 string"
    )
    cut = cut.dropDuplicates(["doc_id", "text_key"])
    # A text that repeats its doc_id in other white space has the windows of the first text of that id.
    cut = cut.withColumnsRenamed({"doc_id": "first_id", "text_key": "first_key"})
    rows = rows.select("doc_id", "n_words", "words_sha256", "first_id", "first_key").join(cut, ["first_id", "first_key"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, F.lit(words_digest([]))).otherwise(F.coalesce("rest_sha256", "words_sha256")).alias("kept_sha256"),
    )


def op8_substring_dedup(documents: DataFrame) -> DataFrame:
    return deduplicated(documents.select("doc_id", "text"))
