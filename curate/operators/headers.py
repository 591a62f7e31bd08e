"""Header text: names on one side, classification tags on the other."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from curate.fixed_values import ATTENDANCE_HEADERS, HEADER_TAG_PATTERN

_TAG = re.compile(HEADER_TAG_PATTERN)


def snake_name(header: str) -> str:
    """``Course Name&3# PII`` as ``course_name``."""
    words = re.findall(r"[A-Za-z0-9]+", _TAG.sub("", header))
    return "_".join(word.lower() for word in words)


def clean_headers(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename every column and move header tags into field metadata.

    Headers missing from ``mapping`` get their snake-case name.
    """
    mapping = ATTENDANCE_HEADERS if mapping is None else mapping
    columns = []
    for header in df.columns:
        source = df[f"`{header}`"]
        name = mapping.get(header, snake_name(header))
        tag = _TAG.search(header)
        columns.append(
            source.alias(name, metadata={"classification": tag.group(1)})
            if tag
            else source.alias(name)
        )
    return df.select(*columns)


def header_tags(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """(column, tag, filled_rows) for each column whose header carries a tag.

    ``filled_rows`` says how many values the classification covers; all tagged
    columns are counted in one aggregate.
    """
    mapping = ATTENDANCE_HEADERS if mapping is None else mapping
    tagged = [(h, m.group(1)) for h in df.columns if (m := _TAG.search(h))]
    if not tagged:
        return df.sparkSession.createDataFrame([], "column string, tag string, filled_rows bigint")
    counts = df.agg(*[F.count(df[f"`{h}`"]).alias(f"n{i}") for i, (h, _) in enumerate(tagged)])
    entries = [
        F.struct(
            F.lit(mapping.get(h, snake_name(h))).alias("column"),
            F.lit(tag).alias("tag"),
            F.col(f"n{i}").alias("filled_rows"),
        )
        for i, (h, tag) in enumerate(tagged)
    ]
    return counts.select(F.inline(F.array(*entries)))
