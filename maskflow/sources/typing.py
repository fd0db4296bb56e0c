"""Types of text columns, found by one native aggregate over a scan.

The kinds are those of Spark's CSV inference, but that digits are 0 to 9 and that types do
not depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.functions.text import quoted

# A bit for each kind of cell; those of a column are put together by "or", in any order.
INT, LONG, DECIMAL, DOUBLE, DATE, STAMP, BOOLEAN, STRING = (1 << k for k in range(8))
NUMBERS, TIMES = INT | LONG | DECIMAL | DOUBLE, DATE | STAMP

# How numbers and days are written that CSV inference takes for such.
WHOLE = r"^[+-]?[0-9]+\.?$"
FLOATING = (
    r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?"
    r"|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?)[\x00-\x20]*$"
)
DAY = r"^-?[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SPECIAL = ("Inf", "-Inf")
MOST_DIGITS = 38


def kind_of(cell: Column) -> Column:
    """The narrowest kind of a cell, as its bit; null for a null or empty one."""
    whole = cell.rlike(WHOLE)
    # A point at the end makes a decimal of a whole number.
    number = F.when(~cell.endswith("."), cell.try_cast("bigint"))
    return (
        F.when(cell.isNull() | (cell == ""), F.lit(None))
        .when(whole & number.between(-(1 << 31), (1 << 31) - 1), INT)
        .when(whole & number.isNotNull(), LONG)
        .when(whole & (digits_of(cell) <= MOST_DIGITS), DECIMAL)
        .when(cell.rlike(FLOATING) | cell.isin(*SPECIAL), DOUBLE)
        .when(cell.rlike(DAY) & cell.try_cast("date").isNotNull(), DATE)
        .when(cell.try_cast("timestamp").isNotNull(), STAMP)
        .when(F.lower(cell).isin("true", "false"), BOOLEAN)
        .otherwise(STRING)
    )


def digits_of(cell: Column) -> Column:
    """Digits of a whole number without leading zeros, at least one."""
    return F.greatest(F.lit(1), F.length(F.regexp_replace(cell, r"^[+-]?0*|\.$", "")))


def type_of(kinds: int, digits: int) -> T.DataType:
    """The type that holds cells of all kinds in a set; ``digits`` is the most that a
    decimal has. Kinds that have no type in common are text, as is a column of nulls."""
    if not kinds or kinds & STRING:
        return T.StringType()
    if kinds & BOOLEAN:
        return T.BooleanType() if kinds == BOOLEAN else T.StringType()
    if kinds & TIMES:
        if kinds & NUMBERS:
            return T.StringType()
        return T.TimestampType() if kinds & STAMP else T.DateType()
    if kinds & DOUBLE:
        return T.DoubleType()
    if kinds & DECIMAL:
        # Decimals that hold every int and long as well.
        return T.DecimalType(max(digits, 20 if kinds & LONG else 10 if kinds & INT else 1), 0)
    return T.LongType() if kinds & LONG else T.IntegerType()


def infer_types(df: DataFrame, keep: Iterable[str] = ()) -> T.StructType:
    """The schema of a table of text columns by what they hold; those of ``keep``, in any
    case, stay text.

    One scan and one row: a set of kinds is a number, and sets merge in any order, so tasks
    and files may come as they like.
    """
    keep = {name.lower() for name in keep}
    names = [name for name in df.columns if name.lower() not in keep]
    found = {}
    if names:
        parts = []
        for k, name in enumerate(names):
            cell = F.col(quoted(name))
            kind = kind_of(cell)
            parts.append(F.bit_or(kind).alias(f"kinds_{k}"))
            parts.append(F.max(F.when(kind == DECIMAL, digits_of(cell))).alias(f"digits_{k}"))
        row = df.agg(*parts).first()
        found = {name: type_of(row[f"kinds_{k}"] or 0, row[f"digits_{k}"] or 0) for k, name in enumerate(names)}
    return T.StructType([T.StructField(name, found.get(name, T.StringType())) for name in df.columns])
