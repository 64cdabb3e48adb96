"""Date and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def calendar_attributes(day: Column) -> list[Column]:
    """The calendar dimension's attributes of a date column.

    Year is the calendar year, week is the ISO week (so 2024-12-30 is year
    2024, week 1). ``weekday`` counts 0 = Monday ... 6 = Sunday, as the
    dimension does. Names use Spark's fixed English (US) locale.
    """
    numbers = {part: F.date_part(F.lit(part), day) for part in ("year", "quarter", "month", "day")}
    numbers |= {"week_of_year": F.date_part(F.lit("week"), day), "day_of_week": F.weekday(day)}
    names = {"month_name": "MMMM", "day_name": "EEEE"}
    return [
        *(number.cast("smallint").alias(name) for name, number in numbers.items()),
        *(F.date_format(day, pattern).alias(name) for name, pattern in names.items()),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]


def months_between_calendar(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later`` (day of month ignored)."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
    ).cast("smallint")


def to_utc_wall_clock(df: DataFrame) -> DataFrame:
    """Render every session-zone timestamp column as a zone-less UTC timestamp.

    Used at the edge of query outputs so that values compare equal to engines
    whose timestamps carry no zone. The session zone must be UTC.
    """
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)
