"""Sentence templates as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

from curate.fixed_values import HIGHEST_WORDS, LOWEST_WORDS, VALUE_UNKNOWN


def fill(template: str, values: dict[str, Column], missing: str = VALUE_UNKNOWN) -> Column:
    """``template`` with each ``{name}`` replaced by a column; NULL prints ``missing``."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(F.coalesce(values[name].cast("string"), F.lit(missing)))
    return F.concat(*parts)


def intent(question: Column | str, whole_words: bool = False) -> Column:
    """``lowest``, ``highest`` or ``lookup``, by words found in the question.

    Words of the lowest group win over words of the highest group. By default
    a word also counts inside a longer one ("almost" holds "most");
    ``whole_words`` asks for word boundaries.
    """
    lowered = F.lower(question)

    def mentions(words: tuple[str, ...]) -> Column:
        pattern = "|".join(words)
        return lowered.rlike(rf"\b(?:{pattern})\b" if whole_words else pattern)

    return (
        F.when(mentions(LOWEST_WORDS), "lowest")
        .when(mentions(HIGHEST_WORDS), "highest")
        .otherwise("lookup")
    )
