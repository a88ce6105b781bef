"""Small tables with everything that may go wrong: NULLs, empty and very long texts, repeated rows, clashing names."""

from __future__ import annotations

from pyspark.sql import functions as F

# Names that the operators use inside, as further columns of the input.
CLASHING = ["size", "rate", "place", "whole", "source_size", "copies", "rep", "bands", "text_key", "gone", "language", "kept", "word", "_own", "root", "block", "pattern", "u"]
LONG = " ".join(f"word{i % 977} other{i % 13}" for i in range(60_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))


def documents(spark, clashing: bool = True):
    rows = [
        (None, "a text without an id but with some words in it", "en", "s1", None),
        (None, None, None, None, None),
        (1, None, "en", "s1", 0),
        (2, "", "en", None, 0),
        (3, " \n\t ", "en", "s1", 4),
        (4, "one", "en", "s2", 3),
        (5, "one", "fr", "s2", 3),
        (6, LONG, "en", "s2", len(LONG)),
        (7, LONG + " end", "en", "s3", len(LONG) + 4),
        (8, "alpha beta gamma\nsecond line here\nthird line here\nfourth line", "en", "s3", 60),
        (9, "alpha beta gamma\nsecond line here\nthird line here\nfifth line", "en", "s3", 60),
        (9, "alpha beta gamma\nsecond line here\nthird line here\nfifth line", "en", "s3", 60),
        (10, "same\nsame\nsame\nsame\nsame\nsame\nsame", "en", "", 34),
        (11, "x " + PASSAGE + " y", "de", "s1", 500),
        (12, PASSAGE + " " + PASSAGE, "de", "s1", 900),
        (13, "▁ literal \\ <s> [INST] ▁▁ \x00 \U0001f600 é", "fr", "s1", 30),
        (14, "12 34 !!! ###", "fr", "s4", 13),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in CLASHING if clashing else []:
        df = df.withColumn(name, F.lit("own value"))
    return df


def empty(df):
    return df.filter("false")
