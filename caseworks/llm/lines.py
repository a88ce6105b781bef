"""Line deduplication: winnowed fingerprints of line hashes, joined, extended both ways, later runs deleted.

The lines of a document that hold a word form a sequence (compared without white space at their ends). A run of
neighbouring lines that also starts earlier (smaller doc_id, or further up in the same text) is deleted if it has
``RUN`` lines or more, or ``WORDS`` words or more in fewer lines, a single one included. Of every ``RUN`` neighbouring
lines, and of every two with that many words, the one with the smallest hash is a fingerprint; so is every line with
that many words. Any repeated run that counts thus shares one with its first copy. Fingerprints that occur at a single
place are dropped; around each of the others the match is extended to both sides, as all shortest runs that count and
contain it, and those are grouped exactly; overlapping ones add up to the whole repeated passage. Lines that a run
shares with its own first copy stay.

Groups are counted before the shuffle and joined back by plain inner joins, so a very common line is spread by
adaptive execution and never gathered. Blank lines stay unless the text is left without a word. Rows without a
doc_id are left as they are; rows that share doc_id and text lose the same lines; NULL texts stay NULL; a text without
a run that counts loses nothing. Very long texts are compared whole: a text is one record, a run at most ``RUN`` line
hashes. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.flat_text import buffers, lists
from caseworks.llm.support import packed, settled

RUN = 3
WORDS = 50
_BLANK = b" \t\x0b\x0c\r"


def fingerprints(hashes: np.ndarray, width: int = RUN) -> np.ndarray:
    """Places of the smallest hash (the last of equals) of every ``width`` neighbours."""
    if len(hashes) < width:
        return np.zeros(0, dtype=np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)
    last = width - 1 - np.argmin(windows[:, ::-1], axis=1)
    return np.unique(np.arange(len(windows)) + last)


def _counting(n_words: np.ndarray) -> np.ndarray:
    """Which runs of fewer than ``RUN`` lines have the words to count: for each line the sum of the widths, 1 and 2, of
    those that start there."""
    pairs = np.zeros(len(n_words), dtype=bool)
    pairs[:-1] = n_words[:-1] + n_words[1:] >= WORDS
    return (n_words >= WORDS) * 1 + pairs * 2


def _marked(hashes: np.ndarray, counting: np.ndarray) -> np.ndarray:
    """Places of all fingerprints."""
    pairs = np.flatnonzero(counting & 2)
    lower = pairs + (hashes[pairs + 1] <= hashes[pairs])
    return np.unique(np.concatenate([fingerprints(hashes), np.flatnonzero(counting & 1), lower]))


def _described(batches):
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        ends = offsets.tolist()
        hashes, numbers, n_lines, counts, prints, n_prints = [], [], [], [], [], []
        for i in range(len(batch)):
            found = [
                (xxhash.xxh3_64_intdigest(line), number, len(line.split()))
                for number, raw in enumerate(data[ends[i] : ends[i + 1]].tobytes().split(b"\n"))
                if (line := raw.strip(_BLANK))
            ]
            own = np.array([h for h, *_ in found], dtype=np.uint64).view(np.int64)
            counting = _counting(np.array([n for *_, n in found], dtype=np.int64))
            places = _marked(own, counting)
            hashes.append(own)
            numbers.extend(number for _, number, _ in found)
            n_lines.append(len(found))
            counts.append(counting)
            prints.append(places)
            n_prints.append(len(places))
        none = np.zeros(0, dtype=np.int64)
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            "text_key": batch.column("text_key"),
            "lines": lists(np.concatenate([none, *hashes]), np.array(n_lines, dtype=np.int64), pa.int64()),
            "numbers": lists(np.array(numbers, dtype=np.int32), np.array(n_lines, dtype=np.int64), pa.int32()),
            "counting": lists(np.concatenate([none, *counts]).astype(np.int32), np.array(n_lines, dtype=np.int64), pa.int32()),
            "prints": lists(np.concatenate([none, *prints]).astype(np.int32), np.array(n_prints, dtype=np.int64), pa.int32()),
        })


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _runs_around(at: str) -> Column:
    """All shortest runs (start, width) that count and contain one of the places in ``at``."""

    def around(place: Column) -> Column:
        runs = [F.struct((place - before).alias("start"), F.lit(width).alias("width")) for width in range(1, RUN + 1) for before in range(width)]
        return F.array(*runs)

    def counts(run: Column) -> Column:
        within = (run.start >= 0) & (run.start + run.width <= F.size("lines"))
        return within & ((run.width == RUN) | (F.get("counting", run.start).bitwiseAND(run.width) > 0))

    return F.filter(F.array_distinct(F.flatten(F.transform(at, around))), counts)


def repeated_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, gone): the numbers, from 0, of the lines to delete from each text that loses some."""
    text = F.col("text").cast("string")
    rows = documents.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), _key(text).alias("text_key"), text.alias("text"))
    rows = settled(rows.mapInArrow(
        _described, "doc_id bigint, text_key bigint, lines array<bigint>, numbers array<int>, counting array<int>, prints array<int>"
    ))
    marks = rows.select("doc_id", "text_key", "lines", F.explode("prints").alias("at"))
    marks = marks.select("doc_id", "text_key", "at", F.get("lines", F.col("at")).alias("mark"))
    here = F.struct("doc_id", "at")
    shared = marks.groupBy("mark").agg(F.min(here).alias("low"), F.max(here).alias("high")).filter("low != high")
    # Settled, here and below, so that the join meets it as a plain shuffle and can split a hot line.
    marks = marks.join(settled(shared.select("mark")), "mark").groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("at"))
    runs = rows.dropDuplicates(["doc_id", "text_key"]).join(marks, ["doc_id", "text_key"])
    runs = runs.select("doc_id", "text_key", "lines", "numbers", F.explode(_runs_around("at")).alias("run")).select("*", "run.start", "run.width")
    cut = lambda of: F.slice(of, F.col("start") + 1, F.col("width"))
    runs = settled(runs.select("doc_id", "text_key", "start", "width", cut("lines").alias("run"), cut("numbers").alias("numbers")))
    here = F.struct("doc_id", "start")
    first = runs.groupBy("run").agg(F.min(here).alias("first"), F.max(here).alias("final")).filter("first != final")
    later = runs.join(settled(first.drop("final")), "run").filter(F.struct("doc_id", "start") > F.col("first"))
    own = F.greatest(F.lit(0), F.col("first.start") + F.col("width") - F.col("start"))
    shared_lines = F.when(F.col("first.doc_id") == F.col("doc_id"), own).otherwise(0)
    gone = later.select("doc_id", "text_key", F.explode(F.slice("numbers", shared_lines + 1, F.col("width"))).alias("number"))
    return gone.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("number")).alias("gone"))


def deduplicated(documents: DataFrame, removed: str = "lines_removed") -> DataFrame:
    """``documents`` with the repeated lines taken out of ``text``, and their number in the column ``removed``."""
    gone = settled(repeated_lines(documents)).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    own = [c for c in documents.columns if c.lower() != removed.lower()]
    rows = packed(
        documents,
        F.col("doc_id").cast("bigint").alias("_doc_id"),
        _key(F.col("text").cast("string")).alias("_text_key"),
    )
    rows = rows.join(gone, (F.col("_doc_id") == F.col("_id")) & (F.col("_text_key") == F.col("_key")), "left")
    rows = rows.withColumn("_lines", F.when(F.col("gone").isNotNull(), F.split("_own.text", "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "gone")
    text = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    rest = F.when(F.col("gone").isNull(), F.col("_own.text")).otherwise(F.when(text.rlike(r"[^ \x09-\x0D]"), text).otherwise(""))
    rows = rows.withColumn("_rest", rest)
    number = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    return rows.select(
        *[F.col("_rest").alias(c) if c.lower() == "text" else F.col(f"_own.`{c}`") for c in own],
        number.cast("bigint").alias(removed),
    )


def op6_line_dedup(documents: DataFrame) -> DataFrame:
    rows = deduplicated(documents.select("doc_id", "text"))
    return rows.select("doc_id", "lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"), F.length("text").cast("bigint").alias("kept_chars"))


# Every shortest run that counts, grouped without fingerprints.
SQL = rf"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS number FROM documents),
worded AS (
  SELECT doc_id, number, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
    len(list_filter(string_split_regex(line, '[ \x09-\x0D]+'), lambda x: x <> '')) AS words,
    row_number() OVER (PARTITION BY doc_id ORDER BY number) AS start
  FROM split WHERE regexp_matches(line, '[^ \x09-\x0D]')),
followed AS (
  SELECT *, lead(line) OVER w AS line2, lead(line, 2) OVER w AS line3, lead(words) OVER w AS words2
  FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY number)),
runs AS (
  SELECT doc_id, start, 3 AS width, [line, line2, line3] AS run FROM followed WHERE line3 IS NOT NULL
  UNION ALL SELECT doc_id, start, 2, [line, line2] FROM followed WHERE words + words2 >= {WORDS}
  UNION ALL SELECT doc_id, start, 1, [line] FROM followed WHERE words >= {WORDS}),
firsts AS (
  SELECT doc_id, start, width, first_value({{'d': doc_id, 's': start}}) OVER (PARTITION BY run ORDER BY doc_id, start) AS f FROM runs),
later AS (SELECT * FROM firsts WHERE f.d < doc_id OR f.s < start),
gone AS (
  SELECT DISTINCT l.doc_id, w.number AS n
  FROM (SELECT *, unnest(range(start, start + width)) AS spot FROM later) l JOIN worded w ON l.doc_id = w.doc_id AND l.spot = w.start
  WHERE l.f.d <> l.doc_id OR l.spot >= l.f.s + l.width),
rest AS (
  SELECT s.doc_id, string_agg(line, chr(10) ORDER BY number) FILTER (n IS NULL) AS text, count(n) AS removed
  FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.number = g.n GROUP BY s.doc_id),
final AS (
  SELECT d.doc_id, coalesce(removed, 0)::BIGINT AS lines_removed,
    CASE WHEN coalesce(removed, 0) = 0 THEN d.text WHEN regexp_matches(coalesce(r.text, ''), '[^ \x09-\x0D]') THEN r.text ELSE '' END AS text
  FROM documents d LEFT JOIN rest r ON d.doc_id = r.doc_id)
SELECT doc_id, lines_removed, sha256(coalesce(text, '')) AS kept_sha256, length(text) AS kept_chars FROM final
"""
