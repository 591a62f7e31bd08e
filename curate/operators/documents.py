"""Gold records as text plus exact figures, without personal names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curate import fixed_values as fixed
from curate.functions.rates import exact_rate, percent_text
from curate.functions.text import fill


def _metadata() -> dict[str, Column]:
    date_text = F.coalesce(F.col("course_date").cast("string"), F.lit(fixed.DATE_UNKNOWN))
    return {
        "type": F.lit(fixed.DOCUMENT_TYPE),
        "name": F.col("fileno"),
        "branch": F.col("branch"),
        "course_name": F.col("course_name"),
        "course_date": date_text,
        "scheduled": F.col("number_of_days"),
        "attended": F.col("days_attended"),
        "absent": F.col("days_absent"),
        "rate": exact_rate("days_attended", "number_of_days"),
        "age": F.col("age_clean"),
        "attendance_band": F.col("attendance_band"),
    }


def build_documents(gold: DataFrame) -> DataFrame:
    """(doc_id, text, metadata), one document per gold record.

    Figures in ``metadata`` are exact; the text is for retrieval. The applicant
    column is never read, so no name can reach either.
    """
    meta = _metadata()
    values = {
        **meta,
        "age_txt": F.when(meta["age"].isNull(), fixed.AGE_UNKNOWN).otherwise(
            fill(fixed.AGE_KNOWN, meta)
        ),
        "rate_txt": F.coalesce(percent_text(meta["rate"]), F.lit(fixed.RATE_UNKNOWN)),
        "band_txt": F.when(meta["attendance_band"].isNull(), fixed.BAND_UNKNOWN_TEXT).otherwise(
            fill(fixed.BAND_KNOWN_TEXT, meta)
        ),
    }
    return gold.select(
        F.col("fileno").alias("doc_id"),
        fill(fixed.DOCUMENT_TEXT, values).alias("text"),
        F.struct(*[value.alias(name) for name, value in meta.items()]).alias("metadata"),
    )


def citation(metadata: Column) -> Column:
    """Reference, course, branch, rate and days of one document."""
    values = {
        name: metadata[name]
        for name in ("type", "name", "course_name", "branch", "attended", "scheduled")
    }
    values["rate_txt"] = F.coalesce(
        percent_text(metadata["rate"]), F.lit(fixed.CITATION_RATE_UNKNOWN)
    )
    return fill(fixed.CITATION, values)
