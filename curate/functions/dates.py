"""Parsing of one text column that holds dates in several formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from curate.fixed_values import DATE_FORMATS, SERIAL_DAY_EPOCH, SERIAL_DAY_PATTERN

# What each field looks like in text. Years beyond 9999 carry a plus sign.
_FIELDS = {
    "yyyy": r"([0-9]{4}|-(?!0000)[0-9]{4}|\+[0-9]{5,6})",
    "MM": "([0-9]{2})",
    "dd": "([0-9]{2})",
}
_NUMERIC_FORMAT = re.compile(r"(yyyy|MM|dd)(\W)(yyyy|MM|dd)(\W)(yyyy|MM|dd)")


def _reading(raw: Column, date_format: str) -> Column:
    """``raw`` read by one format, NULL where it does not fit.

    A numeric format is put into ISO order and cast. That is cheaper than the
    pattern parser, which moreover fails the job on years that overflow it.
    """
    numeric = _NUMERIC_FORMAT.fullmatch(date_format)
    if not numeric or {numeric[1], numeric[3], numeric[5]} != set(_FIELDS):
        return F.try_to_date(raw, date_format)
    fields = [numeric[1], numeric[3], numeric[5]]
    first, second, third = (_FIELDS[f] for f in fields)
    shape = f"^{first}{re.escape(numeric[2])}{second}{re.escape(numeric[4])}{third}\\z"
    year, month, day = (fields.index(f) + 1 for f in _FIELDS)
    iso = raw if date_format == "yyyy-MM-dd" else F.regexp_replace(
        raw, shape, f"${year}-${month}-${day}"
    )
    return F.when(raw.rlike(shape), iso.try_cast("date"))


def parse_mixed_date(
    text: Column | str,
    formats: Sequence[str] = DATE_FORMATS,
    excel_serial: bool = True,
) -> Column:
    """The first format that reads ``text`` as a real date, else NULL.

    Four to six bare digits count days from the spreadsheet epoch.
    """
    raw = F.col(text) if isinstance(text, str) else text
    readings = [_reading(raw, f) for f in formats]
    if excel_serial:
        epoch = F.lit(SERIAL_DAY_EPOCH).cast("date")
        readings.append(
            F.when(raw.rlike(SERIAL_DAY_PATTERN), F.date_add(epoch, raw.try_cast("int")))
        )
    return F.coalesce(*readings)
