"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language is a zstandard raw-content dictionary: texts of a bounded sample of its labelled documents (the
``SAMPLE`` documents with the smallest keyed hash of their id, each cut at ``LONGEST`` characters, cut at
``DICTIONARY_BYTES`` together). So the model has a fixed size per language and reaches the tasks as a broadcast;
the languages are those of the labels. A text is compressed whole with every dictionary, in blocks of at most
``BLOCK_BYTES`` that each start anew from the dictionary, so that all of a long text counts alike; the smallest sum
names the language, the margin to the second is the score, and a narrow margin is a rejection.

NULL texts and texts without a letter are ``und`` with score 0, and are rejected; so is every text if no label can
be learned from. With a single language the score is 1. Equal sizes go to the commoner language (then
the first by name), with score 0. Rows are judged one by one, so repeated rows get equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseworks.llm.flat_text import buffers
from caseworks.llm.support import packed, unpacked

SAMPLE = 64
LONGEST = 20_000
DICTIONARY_BYTES = 112 * 1024
BLOCK_BYTES = 32 * 1024
LEVEL = 5
NARROW = 0.004
UNKNOWN = "und"


def letters(text: Column) -> Column:
    """What of a text is compared; NULL for a text without a letter."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.when(F.length(plain) > 0, plain)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning; NULL ids are."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def learned(documents: DataFrame) -> dict[str, bytes]:
    """The dictionary of each language, from the labelled documents that are not held out; commonest first.

    Every task sends at most ``SAMPLE`` documents per language to the ranking, and as many per language in all
    reach the driver.
    """
    labelled = documents.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    rows = labelled.select(
        "doc_id", "lang", letters(F.substring("text", 1, LONGEST)).alias("text"), F.xxhash64(F.lit("language"), "doc_id").alias("draw")
    )
    rows = rows.filter("text IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    sample = rows.withColumn("place", place).filter(F.col("place") <= SAMPLE).select("lang", "place", "text")
    texts: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.lang, r.place)):
        texts.setdefault(row.lang, []).append(row.text)
    count = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect() if row.lang in texts}
    order = sorted(texts, key=lambda lang: (-count[lang], lang))
    return {lang: "\n".join(texts[lang]).encode()[:DICTIONARY_BYTES] for lang in order}


@cache
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[zstandard.ZstdCompressor, int]]:
    """A compressor per language with its dictionary prepared, and the size it gives an empty text."""
    out = []
    for _, content in model:
        prepared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        prepared.precompute_compress(level=LEVEL)
        tool = zstandard.ZstdCompressor(dict_data=prepared, level=LEVEL, write_content_size=False)
        out.append((tool, len(tool.compress(b""))))
    return out


def classified(model: tuple[tuple[str, bytes], ...], raw: bytes) -> tuple[str, float]:
    """Language and score of one text that has a letter."""
    if not model:
        return UNKNOWN, 0.0
    # Blocks of like size; a short text is one block.
    n = -(-len(raw) // BLOCK_BYTES)
    blocks = [raw[len(raw) * i // n : len(raw) * (i + 1) // n] for i in range(n)]
    sizes = [max(1, sum(len(tool.compress(block)) - least for block in blocks)) for tool, least in _compressors(model)]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    rest = [size for i, size in enumerate(sizes) if i != best]
    return model[best][0], 1 - sizes[best] / min(rest) if rest else 1.0


def identified(documents: DataFrame, model: dict[str, bytes], into: str = "language") -> DataFrame:
    """``documents`` with the struct ``into`` (lang, score, rejected); other columns are kept."""
    shared = documents.sparkSession.sparkContext.broadcast(tuple(model.items()))

    @F.arrow_udf("struct<lang:string,score:double>")
    def told(text: pa.Array) -> pa.Array:
        data, offsets = buffers(text)
        ends, known = offsets.tolist(), text.is_valid().to_numpy(zero_copy_only=False)
        langs, scores = [UNKNOWN] * len(text), np.zeros(len(text))
        for i in np.flatnonzero(known).tolist():
            langs[i], scores[i] = classified(shared.value, data[ends[i] : ends[i + 1]].tobytes())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores)], ["lang", "score"])

    own = [c for c in documents.columns if c.lower() != into.lower()]
    rows = packed(documents, told(letters(F.col("text").cast("string"))).alias("told"))
    reject = (F.col("told.score") < NARROW) | (F.col("told.lang") == UNKNOWN)
    return rows.select(*unpacked(own), F.struct("told.lang", "told.score", reject.alias("rejected")).alias(into))


def op5_language_id(documents: DataFrame) -> DataFrame:
    rows = identified(documents.select("doc_id", "text"), learned(documents))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected"
    )
