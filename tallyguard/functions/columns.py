"""Small column expressions used across the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.fixed_values import AGE_CODES, CLASS_CODES, TIME_FORMATS


def as_col(c: str | Column) -> Column:
    """A column name or expression as an expression."""
    return F.col(c) if isinstance(c, str) else c


def parse_ts_or_null(c: str | Column, fmt: str | tuple[str, ...] | list[str] | None = None) -> Column:
    """Timestamp, or null where the text cannot be read.

    Formats are tried in order; without any these are the slash dates of TIME_FORMATS, then dashed dates.
    """
    if fmt is not None:
        return F.coalesce(*[F.try_to_timestamp(as_col(c), F.lit(f)) for f in ([fmt] if isinstance(fmt, str) else fmt)])
    return F.coalesce(*[F.try_to_timestamp(as_col(c), F.lit(f)) for f in TIME_FORMATS], F.try_to_timestamp(as_col(c)))


def strip_quotes(c: str | Column) -> Column:
    """Remove single and double quotes from both ends."""
    return F.btrim(as_col(c), F.lit("'\""))


def to_text(c: str | Column) -> Column:
    """Value as text, null as ``nan``."""
    return F.coalesce(as_col(c).cast("string"), F.lit("nan"))


def map_values(c: str | Column, mapping: dict, default=None) -> Column:
    """Look the value up in a small fixed mapping; ``default`` for everything else."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    hit = F.create_map(*pairs)[as_col(c)]
    return hit if default is None else F.coalesce(hit, F.lit(default))


def age_code(c: str | Column) -> Column:
    """Age letter or digit to its code; unknown and missing become 0."""
    return map_values(as_col(c).cast("string"), AGE_CODES, 0)


def class_code(c: str | Column) -> Column:
    """Class 1 to label 1, class 2 to label 0, given as text or number."""
    return map_values(as_col(c).cast("string"), CLASS_CODES)


def gender_flag(c: str | Column) -> Column:
    """1 for ``M``, else 0 (missing too)."""
    return F.coalesce(as_col(c) == "M", F.lit(False)).cast("int")


def age_bracket(c: str | Column, bounds: tuple[int, ...] = (19, 26, 36, 46, 56, 66)) -> Column:
    """Number of bracket bounds at or below a numeric age: 0 below the first, then 1, 2, ..."""
    age = as_col(c)
    code = F.when(age.isNull(), F.lit(None).cast("int"))
    for i in range(len(bounds), 0, -1):
        code = code.when(age >= bounds[i - 1], F.lit(i))
    return code.otherwise(F.lit(0))


def hour_of_day(ts: str | Column) -> Column:
    """Hour 0-23."""
    return F.hour(as_col(ts))


def day_of_week(ts: str | Column) -> Column:
    """Day of the week, Monday is 0."""
    return F.weekday(as_col(ts))


def day_of_month(ts: str | Column) -> Column:
    """Day 1-31."""
    return F.dayofmonth(as_col(ts))


def week_of_year(ts: str | Column) -> Column:
    """ISO week number."""
    return F.weekofyear(as_col(ts))
