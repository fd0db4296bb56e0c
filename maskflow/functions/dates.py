"""Dates: reading them from text, cutting, capping and shifting."""

from __future__ import annotations

from pyspark.sql import types as T

from maskflow.functions.vocabulary import SHIFT_DAYS

# The date texts that are understood.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"
# A date with or without a time of day and a zone, as a whole text.
ISO_STAMP = (
    r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)

_STAMPS = (T.TimestampType, T.TimestampNTZType)


def matches(c: str, pattern: str) -> str:
    return f"{c} RLIKE r'{pattern}'"


def slash_to_iso(c: str) -> str:
    year = f"lpad(substring_index({c}, '/', -1), 4, '0')"
    return f"concat({year}, '-', replace(substring_index({c}, '/', 2), '/', '-'))"


def text_to_stamp(c: str) -> str:
    """``yyyy-MM-dd`` with or without a time, or ``M/d/yyyy``; anything else, and any
    text with something behind the date or time, is null."""
    return (
        f"CASE WHEN {matches(c, ISO_STAMP)} THEN try_cast({c} AS TIMESTAMP_NTZ) "
        f"WHEN {matches(c, SLASH_DATE)} THEN try_cast({slash_to_iso(c)} AS TIMESTAMP_NTZ) END"
    )


def text_to_date(c: str) -> str:
    """The day of ``text_to_stamp``. A cast to a date alone would pass over what is
    behind the day."""
    return f"CAST({text_to_stamp(c)} AS DATE)"


def _checked(source: str, parsed: str, on_bad: str) -> str:
    """With ``error`` unreadable text fails the query; the message leaves the value out."""
    if on_bad != "error":
        return parsed
    return (
        f"coalesce({parsed}, CASE WHEN {source} IS NOT NULL AND lower({source}) <> 'null' "
        f"THEN raise_error('unreadable date text') END)"
    )


def as_date(c: str, dtype: T.DataType, on_bad: str = "null") -> str:
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, _STAMPS):
        return f"CAST({c} AS DATE)"
    if isinstance(dtype, T.StringType):
        return _checked(c, text_to_date(c), on_bad)
    raise ValueError(f"a date strategy cannot read {dtype.simpleString()}")


def as_stamp(c: str, dtype: T.DataType, on_bad: str = "null") -> str:
    """Timestamp without zone, as zoned and plain sources must give equal results."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.DateType, T.TimestampType)):
        return f"CAST({c} AS TIMESTAMP_NTZ)"
    if isinstance(dtype, T.StringType):
        return _checked(c, text_to_stamp(c), on_bad)
    raise ValueError(f"a date strategy cannot read {dtype.simpleString()}")


def new_year(year: str) -> str:
    """January 1, 00:00 of a year; null for a null year."""
    return f"CAST(make_date({year}, 1, 1) AS TIMESTAMP_NTZ)"


def floored_year(d: str, first: int) -> str:
    """The year of ``d``, at least ``first``; null for null, which ``greatest``
    alone would skip."""
    return f"(year({d}) + greatest({first} - year({d}), 0))"


def year_only(c: str, dtype: T.DataType, as_of: int, on_bad: str = "null") -> str:
    return new_year(floored_year(as_date(c, dtype, on_bad), as_of - 90))


def year_only_compat(c: str, dtype: T.DataType, as_of: int) -> str:
    """Year as older outputs have it: only whole date texts are read, months and
    days beyond their range roll over, everything else counts as this year."""
    readable = isinstance(dtype, (T.DateType, T.StringType))
    text = f"CAST({c} AS STRING)" if readable else "''"

    def rolled(separator: str, order: tuple[int, int, int]) -> str:
        y, m, d = (f"CAST(split({text}, '{separator}')[{i}] AS INT)" for i in order)
        start = f"make_date(greatest({y}, 1), 1, 1)"
        return f"year(date_add(add_months({start}, {m} - 1), {d} - 1))"

    year = (
        f"CASE WHEN {matches(text, ISO_DATE)} THEN {rolled('-', (0, 1, 2))} "
        f"WHEN {matches(text, SLASH_DATE)} THEN {rolled('/', (2, 0, 1))} ELSE {as_of} END"
    )
    capped = new_year(f"greatest({year}, {as_of - 90})")
    return f"CASE WHEN {c} IS NOT NULL THEN {capped} END"


def day_cut(c: str, dtype: T.DataType, as_of: int, on_bad: str = "null") -> str:
    """January 1 of the year, which is at least 89 years back."""
    return new_year(floored_year(as_date(c, dtype, on_bad), as_of - 89))


def day_cut_keep_time(c: str, dtype: T.DataType, as_of: int, on_bad: str = "null") -> str:
    """Like ``day_cut`` with the time of day kept."""
    stamp = as_stamp(c, dtype, on_bad)
    time_of_day = f"({stamp} - CAST(CAST({stamp} AS DATE) AS TIMESTAMP_NTZ))"
    return f"({new_year(floored_year(stamp, as_of - 89))} + {time_of_day})"


def days_between(later: str, earlier: str) -> str:
    return f"datediff({later}, {earlier})"


def shift_days(patient: str, chance: str, on_bad_key: str = "error") -> str:
    """Days to shift by: set by the last digit of the patient id.

    ``chance`` (0 up to 1) picks one of the ten shifts where the id is null.
    """
    if on_bad_key == "hash":
        other = f"CAST(pmod(xxhash64({patient}), 10) AS INT)"
    else:
        other = "CAST(raise_error('patient id does not end in a digit') AS INT)"
    digit = f"try_cast(substring({patient}, -1, 1) AS INT)"
    days = f"array({', '.join(map(str, SHIFT_DAYS))})"
    return (
        f"get({days}, CASE WHEN {patient} IS NULL THEN CAST(floor({chance} * 10) AS INT) "
        f"ELSE coalesce({digit}, {other}) END)"
    )


def shift_date(d: str, days: str) -> str:
    return f"date_add({d}, {days})"


def shift_stamp(stamp: str, days: str) -> str:
    return f"({stamp} + make_dt_interval({days}))"


def epoch_start(d: str, chance: str, compat: bool = False) -> str:
    """A date up to 730 days before or after; compat first moves one month on."""
    if compat:
        d = f"date_add(add_months(trunc({d}, 'MM'), 1), dayofmonth({d}) - 1)"
    return f"date_add({d}, CAST(floor({chance} * 1460) - 730 AS INT))"
