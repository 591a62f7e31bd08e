"""Word expressions that stay on the JVM."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, functions as F

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def normal_text(text: Column) -> Column:
    """The words of ``text``, A-Z lower-cased, with one space between them; null
    counts as empty. A word is a run of ASCII letters, digits and non-ASCII."""
    return F.trim(F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD, " "))


def words_of(normal: Column) -> Column:
    """The words of a ``normal_text``, none if it is empty."""
    return F.when(normal == "", F.array().cast("array<string>")).otherwise(F.split(normal, " "))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, also where ``body`` uses it
    inside a function of array elements."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_words(normal: Column) -> Column:
    spaces = F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit("")))
    return F.when(normal == "", 0).otherwise(spaces + 1).cast("long")
