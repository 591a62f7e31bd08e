"""Rates, bands and the text form of percentages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from curate.fixed_values import BAND_BELOW, BAND_CUTS, BAND_UNKNOWN, RATE_SCALE


def exact_rate(num: Column | str, den: Column | str) -> Column:
    """num / den as double; NULL where either is NULL or den is 0."""
    return F.try_divide(num, den)


def safe_rate(num: Column | str, den: Column | str, scale: int = RATE_SCALE) -> Column:
    return F.round(exact_rate(num, den), scale)


def band(
    rate: Column,
    cuts: Sequence[tuple[str, float]] = BAND_CUTS,
    below: str = BAND_BELOW,
    unknown: str = BAND_UNKNOWN,
) -> Column:
    """Label of the first cut that ``rate`` reaches. Give it the unrounded rate."""
    label = F.when(rate.isNull(), unknown)
    for name, at_least in cuts:
        label = label.when(rate >= at_least, name)
    return label.otherwise(below)


def percent_text(rate: Column) -> Column:
    """``0.125`` as ``12.50%``.

    A textual pattern makes ``format_number`` round the binary value half-even,
    the same as C's ``%.2f``; ``format_string`` rounds the decimal text half-up
    and differs near ties.
    """
    return F.concat(F.call_function("format_number", rate * 100, F.lit("0.00")), F.lit("%"))
