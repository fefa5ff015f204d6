"""Tokens and stop words."""

from __future__ import annotations

import functools
import importlib.resources

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns.  Unicode letter/digit classes behave the same
# in Java regex and RE2, unlike ``\w`` (ASCII-only in Java).
WORD = r"[\p{L}\p{N}_]+"
WORD2 = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column, pattern: str = WORD) -> Column:
    """Lower-cased word tokens in text order (whole text, no prefix cut)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), 0)


@functools.lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    """The default English stop words of Spark ML's ``StopWordsRemover``.

    Kept as a text resource of this package so that neither the job nor the SQL
    oracle needs the JVM or a particular jar layout; a test compares it with
    ``StopWordsRemover.loadDefaultStopWords("english")``.
    """
    raw = importlib.resources.files(__package__).joinpath("stop_words_english.txt").read_text("utf-8")
    return tuple(w for w in raw.splitlines() if w)


def sql_string_list(values) -> str:
    """A SQL list literal ``['a', 'b']`` (DuckDB syntax) of ``values``."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"
