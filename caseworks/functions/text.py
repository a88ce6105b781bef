"""Text helpers: lot labels, slugs and URL parts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from caseworks.functions.values import as_column, empty_to_null, strip


def token(text: Column | str, position: int) -> Column:
    """The 0-based blank-separated token, NULL when there are fewer."""
    return F.get(F.split(as_column(text), " "), F.lit(position))


def after_first_token(text: Column | str) -> Column:
    """Everything behind the first blank, trimmed; the whole text when it has no blank."""
    text = as_column(text)
    return strip(F.substr(text, F.instr(text, F.lit(" ")) + 1))


def slugify_name(name: str | None) -> str:
    """Column-name form: lower case, blanks and dashes to '_', other signs dropped."""
    slug = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", (name or "").lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug


def slugify(text: Column | str) -> Column:
    """The same rule as :func:`slugify_name` over a column."""
    words = F.regexp_replace(F.lower(as_column(text)), "[ -]+", "_")
    kept = F.regexp_replace(words, "[^a-z0-9_]+", "")
    return F.coalesce(F.regexp_replace(kept, "^([0-9])", "_$1"), F.lit(""))


def _without(text: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def _part(text: Column, separator: str, position: int) -> Column:
    return F.split_part(text, F.lit(separator), F.lit(position))


def url_host(url: Column | str) -> Column:
    bare = _without(as_column(url), "android-app://", "http://", "https://")
    return _part(_part(bare, "/", 1), "?", 1)


def url_path(url: Column | str) -> Column:
    """Text after the first '/', up to '?'. Without a '/', what follows the sign before '?'."""
    bare = _without(as_column(url), "http://", "https://")
    slash = F.coalesce(
        F.nullif(F.instr(bare, F.lit("/")), F.lit(0)),
        F.instr(bare, F.lit("?")) - 1,
    )
    return _part(F.right(bare, F.length(bare) - slash), "?", 1)


def url_parameter(url: Column | str, name: str) -> Column:
    """Value behind the first ``name=``, up to '&'. A plain text match, so 'ref' also finds 'xref='."""
    return empty_to_null(_part(_part(as_column(url), f"{name}=", 2), "&", 1))
