"""Fixed-width text: lines cut by a layout into typed columns, and back.

A layout is a JSON array of ``{"name", "length", "format"}`` with the formats
``X`` (text), ``9`` (whole number), ``-9.99`` with any number of decimals
(number) and ``YYYY-MM-DD`` (date).
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.functions.dates import matches, slash_to_iso
from maskflow.functions.text import literal, quoted, strip_blanks

CORRUPT = "_corrupt_record"

# Date texts within lines. Dates are written as MM/dd/yyyy.
DASH_DATE = r"^\d{4}-\d{2}-\d{2}$"
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{2,4}$"


@dataclass(frozen=True)
class Field:
    name: str
    length: int
    format: str

    @property
    def dtype(self) -> T.DataType:
        if self.format == "X":
            return T.StringType()
        if self.format == "9":
            return T.LongType()
        if re.fullmatch(r"-9\.9+", self.format):
            return T.DoubleType()
        if self.format == "YYYY-MM-DD":
            return T.DateType()
        raise ValueError(f"unknown format {self.format!r} of field {self.name!r}")


def parse_layout(text: str) -> list[Field]:
    layout = [Field(item["name"], int(item["length"]), item["format"]) for item in json.loads(text)]
    layout_schema(layout)
    return layout


def layout_schema(layout: Sequence[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dtype) for f in layout])


def layout_width(layout: Sequence[Field]) -> int:
    return sum(f.length for f in layout)


# -- reading


def _date(token: str) -> str:
    """``yyyy-MM-dd`` or ``M/d/y``; years of two digits are taken as they stand."""
    return (
        f"CASE WHEN {matches(token, DASH_DATE)} THEN try_cast({token} AS DATE) "
        f"WHEN {matches(token, SLASH_DATE)} THEN try_cast({slash_to_iso(token)} AS DATE) END"
    )


def _typed(item: Field, fail: bool) -> str:
    """The token as its field's type. Null stands for unreadable, unless that fails."""
    token, kind = quoted(item.name), item.dtype.simpleString()
    if kind == "string":
        return token
    if kind == "bigint":
        return f"CASE WHEN {token} IS NOT NULL THEN coalesce(try_cast({token} AS BIGINT), 0L) END"
    if kind == "double":
        value = f"coalesce(try_cast({token} AS DOUBLE), CASE WHEN {token} = 'Z' THEN 0D END)"
    else:
        value = _date(token)
    if fail:
        message = literal(f"unreadable value in field {item.name}")
        value = f"coalesce({value}, CAST(raise_error({message}) AS {kind}))"
    if kind == "date":
        value = f"CASE WHEN {token} <> '' THEN {value} END"
    return value


# The two parts of the message for a line that ends too early.
SHORT_LINE = ("Expected string of length at least ", "; got one of length ")


def _line_too_short(layout: Sequence[Field]) -> str:
    """Message naming the first field end that lies beyond the line."""
    width, ends = 0, []
    for item in layout:
        width += item.length
        ends.append(f"CASE WHEN length(value) < {width} THEN {width} END")
    return (
        f"concat({literal(SHORT_LINE[0])}, least({', '.join(ends)}, {width}), "
        f"{literal(SHORT_LINE[1])}, length(value))"
    )


def split_lines(
    lines: DataFrame, layout: Sequence[Field], mode: str = "FAILFAST"
) -> DataFrame:
    """Cut the text column ``value`` into the layout's columns.

    Tokens are trimmed. Whole numbers that cannot be read are 0, a blank date
    is null, the number ``Z`` is 0, and characters beyond the layout are
    ignored. Lines too short and other unreadable dates and numbers fail the
    query (``FAILFAST``) or give null and keep the line in ``_corrupt_record``
    (``PERMISSIVE``). Columns not selected later are neither cut nor checked.
    """
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError(f"unknown mode {mode!r}")
    if not layout:
        return lines.select()
    fail = mode == "FAILFAST"
    width = layout_width(layout)
    short = f"CAST(raise_error({_line_too_short(layout)}) AS STRING)" if fail else "NULL"
    names = [quoted(item.name) for item in layout]

    # Several projections, as lines, tokens and values are each looked at more
    # than once: Spark computes them once and still drops unselected columns.
    checked = lines.selectExpr(
        "value",
        f"CASE WHEN length(value) < {width} THEN {short} ELSE value END AS line",
        r"value RLIKE r'[\x00-\x1f]' AS has_controls",
    )
    cut, start = [], 1
    for item in layout:
        cut.append(f"substring(line, {start}, {item.length}) AS {quoted(item.name)}")
        start += item.length
    trimmed = checked.selectExpr("value", "line", "has_controls", *cut).selectExpr(
        "value",
        "line",
        *[f"if(has_controls, {strip_blanks(c)}, trim({c})) AS {c}" for c in names],
    )
    typed = [f"{_typed(item, fail)} AS {quoted(item.name)}" for item in layout]
    if fail:
        return trimmed.selectExpr(*typed)

    kinds = {quoted(item.name): item.dtype.simpleString() for item in layout}
    days = [c for c, kind in kinds.items() if kind == "date"]
    blanks = [f"{c} = '' AS __blank_{i}" for i, c in enumerate(days)]
    faults = ["line IS NULL"]
    faults += [f"{c} IS NULL" for c, kind in kinds.items() if kind == "double"]
    faults += [f"({c} IS NULL AND NOT __blank_{i})" for i, c in enumerate(days)]
    corrupt = f"CASE WHEN {' OR '.join(faults)} THEN value END AS {CORRUPT}"
    return trimmed.selectExpr("value", "line", *typed, *blanks).selectExpr(*names, corrupt)


def read_fixed_width(
    spark: SparkSession,
    path: str | Sequence[str],
    layout: Sequence[Field],
    mode: str = "FAILFAST",
) -> DataFrame:
    if not path:
        raise ValueError("fixed-width data needs a path")
    if layout is None:
        raise ValueError("fixed-width data needs a layout")
    path = path if isinstance(path, str) else list(path)
    return split_lines(spark.read.text(path), layout, mode)


# -- writing


def _written_date(c: Column, dtype: T.DataType) -> Column:
    """``MM/dd/yyyy``, put together from the ISO text, which is faster than formatting."""
    iso = (c if isinstance(dtype, T.DateType) else c.cast("date")).cast("string")
    return F.concat(
        F.substring(iso, 6, 2), F.lit("/"), F.substring(iso, 9, 2), F.lit("/"),
        F.substring(iso, 1, 4),
    )


def _written(c: Column, dtype: T.DataType, item: Field, zero_numbers: bool) -> Column:
    """The value as text, before it is made as wide as its field."""
    want = item.dtype
    if isinstance(want, T.DateType):
        if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ValueError(f"field {item.name} takes a date, not {dtype.simpleString()}")
        return _written_date(c, dtype)
    if isinstance(want, T.StringType):
        return c.cast("string")
    if isinstance(want, T.LongType) and isinstance(dtype, T.IntegralType):
        return c.cast("string")
    if isinstance(want, T.DoubleType) and isinstance(dtype, T.NumericType):
        return c.cast("double").cast("string")
    if zero_numbers and isinstance(want, T.LongType):
        number = F.coalesce(c.cast("string").try_cast("bigint"), F.lit(0))
        return F.when(c.isNotNull(), number.cast("string"))
    raise ValueError(f"field {item.name} ({item.format}) cannot hold {dtype.simpleString()}")


# What fields hold whose column the table lacks, by type.
ABSENT = {T.StringType(): "0", T.LongType(): "0", T.DoubleType(): "0.0", T.DateType(): ""}


def format_lines(
    df: DataFrame,
    layout: Sequence[Field],
    truncate: bool = False,
    zero_numbers: bool = False,
) -> DataFrame:
    """The table as one text column ``value``, every line as wide as the layout.

    Null is written as blanks. Values wider than their field fail the query
    unless ``truncate`` is set: a cut hash no longer tells ids apart. Text in a
    whole-number field is an error, or 0 where not a number with ``zero_numbers``.
    """
    columns = {f.name.lower(): f for f in df.schema.fields}
    texts, tokens = [], []
    for i, item in enumerate(layout):
        found = columns.get(item.name.lower())
        if found is None:
            tokens.append(F.lit(ABSENT[item.dtype].ljust(item.length)[: item.length]))
            continue
        c = F.col(quoted(found.name))
        text = F.coalesce(_written(c, found.dataType, item, zero_numbers), F.lit(""))
        texts.append(text.alias(f"text_{i}"))
        text = F.col(f"text_{i}")
        token = F.rpad(text, item.length, " ")
        if not truncate:
            error = F.raise_error(F.lit(f"value longer than field {item.name}")).cast("string")
            token = F.when(F.length(text) <= item.length, token).otherwise(error)
        tokens.append(token)
    # Two projections, so that every text is made once though looked at twice.
    return df.select(*texts).select(F.concat(*tokens).alias("value"))


def write_fixed_width(
    df: DataFrame,
    path: str,
    layout: Sequence[Field],
    mode: str = "error",
    truncate: bool = False,
    zero_numbers: bool = False,
) -> None:
    """Write lines with Spark's save modes: error, overwrite, ignore or append."""
    if not path:
        raise ValueError("fixed-width data needs a path")
    format_lines(df, layout, truncate, zero_numbers).write.mode(mode).text(path)
