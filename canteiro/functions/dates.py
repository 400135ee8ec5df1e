"""Dates, durations and the rules that depend on the current day.

No function reads the clock: the reference time is always the argument ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.text import _col, strip

_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?"
_DAY_FIRST = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4})(?:\s+(" + _CLOCK + r"))?$"
_YEAR_FIRST = (
    r"^\d{4}([/-])\d{1,2}\1\d{1,2}"
    r"(?: |[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s?(?:Z|[+-]\d{2}:?\d{2})?)?$"
)
_MILLIS_FROM = 100_000_000_000
_LAST_MICRO = 9_223_372_036_000_000  # 2262-04-11, the last second of a 64-bit nanosecond clock
_DAY_MICROS = 86_400_000_000


def epoch(number: Column | str) -> Column:
    """Seconds, or milliseconds when above 1e11, since 1970 (UTC).

    Values after 2262-04-11 are NULL, as they are for the 64-bit nanosecond clock of the sources'
    own tools; calendar texts have no such limit.
    """
    number = _col(number).try_cast("double")
    micros = number * F.when(number > _MILLIS_FROM, 1_000).otherwise(1_000_000)
    return F.timestamp_micros(F.when(micros.between(-_LAST_MICRO, _LAST_MICRO), micros.cast("bigint")))


def calendar_text(text: Column | str) -> Column:
    """Day-first and year-first dates with optional time; month-first is never accepted."""
    year_first = F.regexp_replace(strip(text), _DAY_FIRST, "$4-$3-$1 $5")
    readable = F.regexp_extract(year_first, _YEAR_FIRST, 0)
    return F.replace(readable, F.lit("/"), F.lit("-")).try_cast("timestamp")


def parse_timestamp(text: Column | str, digits_as_epoch: bool = True, parity: bool = False) -> Column:
    """Date text to a UTC timestamp; unreadable text is NULL.

    With ``digits_as_epoch`` a text of digits only counts as an epoch. Up to four digits are a bare
    year, which names no day and is NULL; with ``parity`` it is an epoch like any other number.
    """
    text = _col(text).cast("string")
    parsed = calendar_text(text)
    if digits_as_epoch:
        digits = r"^\d+$" if parity else r"^\d{5,}$"
        parsed = F.coalesce(parsed, epoch(F.regexp_extract(strip(text), digits, 0)))
    return parsed


def unreadable_date(text: Column | str, parity: bool = False) -> Column:
    """Whether a filled cell gives no date; sums of it are the reject count of a load."""
    text = _col(text).cast("string")
    return F.coalesce(strip(text) != "", F.lit(False)) & parse_timestamp(text, parity=parity).isNull()


def month_and_year(text: Column | str) -> Column:
    """``Abril/2022`` to the first day of that month."""
    parts = F.split(_col(text), "/")
    names = F.array(*[F.lit(month.replace("ç", "c")) for month in vocab.MONTHS])
    name = F.replace(F.lower(strip(F.get(parts, F.lit(0)))), F.lit("ç"), F.lit("c"))
    month = F.array_position(names, name).cast("int")
    year = strip(F.get(parts, F.lit(1)))
    readable = (F.size(parts) == 2) & (month > 0) & year.rlike(r"^\d{1,4}$")
    zero = F.lit(0)
    return F.when(
        readable, F.try_make_timestamp(year.try_cast("int"), month, F.lit(1), zero, zero, zero)
    )


def duration_days(text: Column | str) -> Column:
    """``12 MESES`` to 360: days per unit are fixed (30, 7, 365)."""
    upper = F.upper(_col(text))
    pattern = r"(\d+)\s*(" + "|".join(vocab.DAYS_PER_UNIT) + ")"
    count = F.regexp_extract(upper, pattern, 1).try_cast("bigint")
    unit = F.regexp_extract(upper, pattern, 2)
    days = F.lit(None).cast("bigint")
    for name, factor in vocab.DAYS_PER_UNIT.items():
        days = F.when(unit == name, count * factor).otherwise(days)
    return days


def expected_end(text: Column | str, start: Column | str) -> Column:
    """Deadline text: a month and year, or a duration counted from the start."""
    return F.coalesce(month_and_year(text), plus_days(_col(start), duration_days(text)))


def plus_days(moment: Column, days: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(moment) + days * _DAY_MICROS)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole 24-hour days from ``earlier`` to ``later``, rounded down."""
    span = F.unix_micros(_col(later).cast("timestamp")) - F.unix_micros(_col(earlier).cast("timestamp"))
    return F.call_function("div", span - F.pmod(span, F.lit(_DAY_MICROS)), F.lit(_DAY_MICROS))


def status_by_end(end: Column | str, as_of: Column) -> Column:
    """Contract status when the source gives none."""
    end = _col(end)
    return (
        F.when(end < as_of, "Expirado").when(end >= as_of, "Vigente").otherwise(vocab.UNDEFINED_STATUS)
    )


def delay_days(deadline: Column | str, completed: Column | str, as_of: Column) -> Column:
    """Days past the deadline at completion (or now), never negative; NULL without a deadline."""
    deadline = _col(deadline).cast("timestamp")
    reached = F.coalesce(_col(completed).cast("timestamp"), as_of)
    late = days_between(reached, deadline)
    return F.when(deadline.isNotNull(), F.greatest(F.lit(0).cast("bigint"), late))


def elapsed_percent(start: Column, deadline: Column, as_of: Column) -> Column:
    """Share of the planned time that has passed, one decimal, at most 99."""
    planned = days_between(deadline, start)
    passed = days_between(as_of, start)
    share = F.bround(passed / F.nullif(planned, F.lit(0).cast("bigint")) * 100, 1)
    return F.when(planned > 0, F.least(share, F.lit(99.0)))


def percent_complete(
    status: Column | str,
    given: Column | str,
    start: Column | str,
    deadline: Column | str,
    as_of: Column,
) -> Column:
    """Percent complete with fallbacks by official status.

    A known, non-negative percent is kept, except 0 on finished works.
    """
    status = F.lower(strip(status))
    given = _col(given)
    start, deadline = _col(start).cast("timestamp"), _col(deadline).cast("timestamp")
    absent = F.coalesce(given < 0, F.lit(True))
    by_time = F.when(deadline > start, elapsed_percent(start, deadline, as_of))
    return (
        F.when(status.isin(*vocab.DONE_STATUSES) & (absent | (given == 0)), F.lit(100.0))
        .when(status.isin(*vocab.STOPPED_STATUSES) & absent, F.lit(0.0))
        .when(status.isin(*vocab.PLANNED_STATUSES) & absent, F.lit(0.0))
        .when(status.isin(*vocab.RUNNING_STATUSES) & absent, F.coalesce(by_time, given, F.lit(0.0)))
        .otherwise(F.coalesce(given, F.lit(0.0)))
    )
