"""Quality rules: a threshold table compiled into one projection of text ratios, without user functions.

Every metric is a built-in expression over the row's own text, so the whole operator is a scan and a
projection: no shuffle, no state, nothing that grows with the corpus. Repeated three-word windows are found
by sorting the window hashes of one text, so a very long text costs n log n, not n squared.

NULL and empty texts have no words and fail the base rule. Rows are judged one by one: repeated rows get
equal verdicts, an empty table gives an empty result, and other columns (of any name but those of the result) are
passed through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseworks.llm.support import packed, unpacked, words

SYMBOLS = "#*$%&|<>"
WINDOW = 3
# Fixed list: very frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "le", "la", "les", "de", "et", "des", "un", "une", "que",
    "en", "der", "die", "das", "und", "den", "dem", "ist", "ein", "eine", "el", "los", "las", "y", "por", "con", "del",
)


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; a side that is None is open. A NULL metric passes."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


# Production thresholds. Ratios are over words or lines of one text.
THRESHOLDS = (
    Rule("mean_word_length", "mean_word_length", 2.0, 15.0),
    Rule("symbol_ratio", "symbols_per_word", None, 0.5),
    Rule("stop_words", "stop_word_ratio", 0.005, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("repeated_windows", "repeat_word_ratio", None, 0.4),
    Rule("letters", "letter_ratio", 0.5, None),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(grams: str) -> Column:
    """Words covered by windows that occur at least twice, from the sorted (hash, place) array."""
    g = F.col(grams)

    def same(x: Column, place: Column) -> Column:
        return F.coalesce(F.get(g, place)["h"] == x["h"], F.lit(False))

    return F.sort_array(F.transform(F.filter(g, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))


def measured(df: DataFrame) -> DataFrame:
    """``df`` (with ``text``) and one struct column ``_q`` of counts and ratios. Each step is its own projection, so that no
    array is computed twice."""
    t = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    step = df.withColumns({
        "_words": words(t),
        "_lines": lines,
        "_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("bigint"),
        "_letters": F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("bigint"),
    })
    n = F.size("_words")
    gram = lambda i: F.struct(
        F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]).alias("h"), i.alias("p")
    )
    step = step.withColumns({
        "_grams": F.when(n >= WINDOW, F.array_sort(F.transform(F.sequence(F.lit(0), n - WINDOW), gram))),
        "_stops": F.size(F.filter("_words", lambda w: w.isin(*STOP_WORDS))).cast("bigint"),
        "_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "_n": n.cast("bigint"),
        "_n_lines": F.size("_lines").cast("bigint"),
        "_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    }).drop("_words", "_lines")
    step = step.withColumn("_again", F.coalesce(_repeat_words("_grams"), F.array().cast("array<int>"))).drop("_grams")
    covered = F.aggregate(
        F.transform("_again", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    step = step.withColumn("_covered", covered).drop("_again")

    def share(top: str, of: str) -> Column:
        return F.when(F.col(of) > 0, F.col(top) / F.col(of))

    return step.withColumn(
        "_q",
        F.struct(
            F.col("_n").alias("n_words"),
            F.col("_chars").alias("word_chars"),
            F.col("_symbols").alias("n_symbols"),
            F.col("_dup_lines").alias("n_dup_lines"),
            F.col("_covered").alias("n_repeat_words"),
            share("_chars", "_n").alias("mean_word_length"),
            share("_symbols", "_n").alias("symbols_per_word"),
            share("_stops", "_n").alias("stop_word_ratio"),
            share("_dup_lines", "_n_lines").alias("dup_line_ratio"),
            share("_covered", "_n").alias("repeat_word_ratio"),
            share("_letters", "_chars").alias("letter_ratio"),
        ),
    ).drop("_n", "_chars", "_symbols", "_letters", "_dup_lines", "_n_lines", "_covered", "_stops")


def verdict(rules: Sequence[Rule], quality: str = "_q") -> Column:
    """The names of the rules that a row breaks, as an array."""

    def broken(rule: Rule) -> Column:
        value, out = F.col(f"{quality}.{rule.metric}"), F.lit(False)
        if rule.low is not None:
            out = out | (value < rule.low)
        if rule.high is not None:
            out = out | (value > rule.high)
        return F.when(F.coalesce(out, F.lit(False)), F.lit(rule.name))

    return F.filter(F.array(*[broken(r) for r in rules]), lambda x: x.isNotNull())


def judged(df: DataFrame, rules: Sequence[Rule] = THRESHOLDS, text: str = "text") -> DataFrame:
    """``df`` with the struct ``quality`` (counts and ratios), ``base_failed``, the broken rules and ``kept``.

    The base rule fails texts under 50 words, or with more than half of their words in repeated windows.
    """
    own = [c for c in df.columns if c.lower() not in ("quality", "base_failed", "broken_rules", "kept")]
    rows = measured(packed(df, F.col(f"`{text}`").cast("string").alias("text"))).select("_own", F.col("_q").alias("quality"))
    rows = rows.withColumns({
        "base_failed": (F.col("quality.n_words") < 50) | (100 * F.col("quality.n_repeat_words") > 50 * F.col("quality.n_words")),
        "broken_rules": verdict(rules, "quality"),
    })
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
    return rows.select(*unpacked(own), "quality", "base_failed", "broken_rules", "kept")


def op7_quality_rules(documents: DataFrame) -> DataFrame:
    rows = judged(documents.select("doc_id", "text"))
    return rows.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in BASE], "base_failed", "kept")


SQL = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \x09-\x0D]')) AS lines
  FROM documents),
places AS (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS p FROM split WHERE len(words) >= 3),
grams AS (SELECT row_id, p, count(*) OVER (PARTITION BY row_id, words[p], words[p + 1], words[p + 2]) AS n FROM places),
again AS (SELECT row_id, p, lead(p) OVER (PARTITION BY row_id ORDER BY p) AS following FROM grams WHERE n > 1),
covered AS (SELECT row_id, sum(least(3, coalesce(following - p, 3)))::BIGINT AS n FROM again GROUP BY row_id),
base AS (
  SELECT doc_id, text, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines) AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, length(regexp_replace(text, '\PL+', '', 'g')) AS letters,
    len(list_filter(words, lambda w: list_contains([STOPS], w))) AS stops
  FROM split s LEFT JOIN covered c USING (row_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  CASE WHEN base_failed THEN false ELSE RULES END AS kept
FROM judged
"""
_SQL_METRICS = {
    "mean_word_length": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "stop_word_ratio": "stops / n_words",
    "dup_line_ratio": "n_dup_lines / n_lines",
    "repeat_word_ratio": "n_repeat_words / n_words",
    "letter_ratio": "letters / word_chars",
}


def sql(rules: Sequence[Rule] = THRESHOLDS) -> str:
    """The same table of rules as SQL."""
    sides = []
    for rule in rules:
        value = f"({_SQL_METRICS[rule.metric]})"
        sides += [f"{value} >= {rule.low}::DOUBLE"] if rule.low is not None else []
        sides += [f"{value} <= {rule.high}::DOUBLE"] if rule.high is not None else []
    return SQL.replace("RULES", " AND ".join(sides)).replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS))
