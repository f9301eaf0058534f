"""Dates written as year, month, day around a divider."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_pattern(divider: str = "-") -> str:
    """The date pattern for a divider, quoted where the divider is a pattern letter."""
    mark = "".join("''" if c == "'" else c for c in divider)
    mark = f"'{mark}'" if mark else ""
    return f"yyyy{mark}MM{mark}dd"


def parse_day(text: Column | str, divider: str = "-", strict: bool = True) -> Column:
    """Text to DATE; NULL stays NULL. Bad text raises, or gives NULL when ``strict`` is off."""
    text = F.col(text) if isinstance(text, str) else text
    parsed = F.try_to_date(text, day_pattern(divider))
    if not strict:
        return parsed
    message = F.concat(F.lit("not a date: "), text)
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(message).cast("date")).otherwise(parsed)


def format_day(day: Column | str, divider: str = "-") -> Column:
    """DATE to text."""
    return F.date_format(day, day_pattern(divider))
