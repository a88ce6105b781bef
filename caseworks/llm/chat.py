"""Chat formatting: prefix-target expansion with DataFrame operations only.

Every assistant turn becomes one example: all turns up to and with it, formatted, with the reply as the only
trainable span. As a prefix of the turns formats to a prefix of the formatted conversation, a conversation is
formatted once and each example is a cut of it. A conversation that does not end with a reply gives one more
example without a trainable span, so that no turn is lost.

The template marks a turn by its role; control strings inside texts (and inside unusual roles) are broken by a
backslash after their first character, and backslashes are doubled, so both are read back exactly:

    user       [INST] text [/INST]
    assistant  <s>text</s>
    system     <<SYS>>text<</SYS>>
    others     [TURN]role[/ROLE]text[/TURN]

A conversation is one record: its turns are gathered by conversation, in the order of turn, role and text, and
its memory is that of its longest example. Rows without conv_id form one conversation; NULL turns come first,
NULL roles and texts are empty; repeated rows are repeated turns. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[TURN]", "[/ROLE]", "[/TURN]")
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[TURN]", "[/ROLE]", "[/TURN]")
_CONTROL_START = r"([<\[])(?=/?INST\]|/?s>|<SYS>>|</SYS>>|/?TURN\]|/ROLE\])"
_TURN = r"(?s)\[INST\] .*? \[/INST\]|<s>.*?</s>|<<SYS>>.*?<</SYS>>|\[TURN\].*?\[/ROLE\].*?\[/TURN\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL_START, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _formatted(role: Column, text: Column) -> Column:
    out = F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1]), escaped(text), F.lit(OTHER[2]))
    for name, (opening, closing) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(opening), escaped(text), F.lit(closing))).otherwise(out)
    return out


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, ``example`` (from 0), formatted ``text`` and its trainable span
    [``loss_start``, ``loss_end``) in code points; an example without a reply has an empty span at its end."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("said")
    )
    rows = rows.withColumn("text", _formatted(F.col("role"), F.col("said"))).drop("said")
    rows = rows.withColumn("n", F.length("text").cast("bigint"))
    turn = F.struct("turn", "role", "text", "n")
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    opening, closing = (len(mark) for mark in MARKS["assistant"])
    # Running ends of the turns, and from them the cuts: (end, loss_start, loss_end).
    ends = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<cut:bigint,from:bigint,to:bigint,reply:boolean>>").alias("cuts")),
        lambda state, t: F.struct(
            (state["at"] + t["n"]).alias("at"),
            F.concat(state["cuts"], F.array(F.struct(
                (state["at"] + t["n"]).alias("cut"),
                (state["at"] + opening).alias("from"),
                (state["at"] + t["n"] - closing).alias("to"),
                (t["role"] == "assistant").alias("reply"),
            ))).alias("cuts"),
        ),
        lambda state: state["cuts"],
    )
    whole = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("all"), ends.alias("ends"))
    last = F.element_at("ends", -1)
    replies = F.transform(F.filter("ends", lambda e: e["reply"]), lambda e: F.struct(e["cut"].alias("cut"), e["from"].alias("from"), e["to"].alias("to")))
    rest = F.when(
        ~last["reply"], F.array(F.struct(last["cut"].alias("cut"), last["cut"].alias("from"), last["cut"].alias("to")))
    ).otherwise(F.array().cast("array<struct<cut:bigint,from:bigint,to:bigint>>"))
    cuts = whole.select("conv_id", "all", F.posexplode(F.concat(replies, rest)).alias("example", "cut"))
    return cuts.select(
        "conv_id",
        "example",
        F.substring("all", F.lit(1), F.col("cut.cut").cast("int")).alias("text"),
        F.col("cut.from").alias("loss_start"),
        F.col("cut.to").alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""

    def read(piece: Column) -> Column:
        other = F.substring_index(F.substring(piece, F.lit(len(OTHER[0]) + 1), F.length(piece)), OTHER[1], 1)
        role, start, end = other, F.length(other) + len(OTHER[0]) + len(OTHER[1]), F.lit(len(OTHER[2]))
        for name, (opening, closing) in MARKS.items():
            here = piece.startswith(opening)
            role = F.when(here, F.lit(name)).otherwise(role)
            start = F.when(here, F.lit(len(opening))).otherwise(start)
            end = F.when(here, F.lit(len(closing))).otherwise(end)
        inner = F.substring(piece, start + 1, F.length(piece) - start - end)
        return F.struct(unescaped(role).alias("role"), unescaped(inner).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(_TURN), F.lit(0)), read)


def op2_prefix_targets(conversations: DataFrame) -> DataFrame:
    """Digests per conversation, read back from its examples alone."""
    said = F.explode(F.array(*[
        F.struct(F.lit(-1).cast("bigint").alias("conv_id"), F.lit(turn).cast("bigint").alias("turn"), F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
        for turn, role in enumerate(("user", "assistant"))
    ])).alias("row")
    added = conversations.sparkSession.range(1).select(said).select("row.*")
    rows = examples(conversations.select("conv_id", "turn", "role", "text").unionByName(added))
    span = F.substring("text", (F.col("loss_start") + 1).cast("int"), (F.col("loss_end") - F.col("loss_start")).cast("int"))
    rows = rows.withColumn("loss", F.struct("example", unescaped(span).alias("text")))
    per = rows.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda x: x["text"]), "").alias("loss"),
        F.sum(F.length("text")).cast("bigint").alias("formatted_chars"),
    )
    per = per.withColumn("turns", read_turns(F.col("longest"))).drop("longest")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (
  SELECT *, row_number() OVER w AS place, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS is_last,
    length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '\[/?INST\]|</?s>|<<SYS>>|<</SYS>>|\[/?TURN\]|\[/ROLE\]'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
        ELSE 20 + length(role) + length(role) - length(replace(role, '\', '')) END AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
ended AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY place) AS cut FROM sized)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(cut) FILTER (role = 'assistant' OR is_last))::BIGINT AS formatted_chars
FROM ended GROUP BY conv_id
"""
