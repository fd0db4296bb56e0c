"""Ranges of a key that hold about as many rows each, from mergeable sketches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Rows of a sample that is off by more than ``eps`` at some value once in a billion cases
# are log(2e9) / (2 * (eps / 2) ** 2).
ODDS = math.log(2e9)


def even_cuts(df: DataFrame, column: str, ranges: int, eps: float = 0.01) -> list:
    """Where to cut ``column`` into ``ranges`` ranges, ascending and distinct: none holds more
    than 1 / ranges + eps of the rows, but for what a single value holds.

    Numbers, dates and timestamps are sketched by quantile summaries that merge from task
    to task; texts, which have none, by the rows with the lowest hashes, a sample of
    about one size whatever the table's. Nulls are left out. One scan of one column, and only
    the cuts reach the driver. Fewer cuts come where values repeat; an empty column has none.
    """
    if ranges < 1 or not 0 < eps < 1:
        raise ValueError("ranges must be at least 1, eps between 0 and 1")
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    shares = [k / ranges for k in range(1, ranges)]
    if not shares:
        return []
    if isinstance(kind, ORDERED):
        accuracy = math.ceil(2 / eps)
        cuts = df.agg(F.percentile_approx(value, shares, accuracy).alias("cuts")).first()["cuts"]
    elif isinstance(kind, T.StringType):
        size = math.ceil(2 * ODDS / eps**2)
        # Equal values are rows of their own: they are told apart by where they are read.
        draw = F.xxhash64(F.monotonically_increasing_id(), value)
        rows = df.select(value.alias("value"), draw.alias("draw")).where("value is not null")
        share_drawn = F.lit(min(1.0, size / max(1, rows.count())) * 2.0**63)
        sample = rows.where(F.shiftrightunsigned("draw", 1).cast("double") <= share_drawn).select("value")
        values = F.array_sort(F.collect_list("value")).alias("values")
        places = [F.get("values", F.floor(F.size("values") * share).cast("int")) for share in shares]
        cuts = sample.agg(values).select(F.array(*places).alias("cuts")).first()["cuts"]
    else:
        raise ValueError(f"a {kind.simpleString()} has no ranges")
    return sorted({cut for cut in cuts or [] if cut is not None and cut == cut})


def range_sizes(df: DataFrame, column: str, cuts: list) -> DataFrame:
    """(range, n_rows): rows of every range between cuts, nulls in the first, as the
    predicates of a range read part them. One scan; ranges without rows are left out."""
    kind = df.schema[column].dataType.simpleString()
    value = F.col(f"`{column}`")
    bounds = F.array(*(F.lit(cut).cast(kind) for cut in cuts)) if cuts else None
    number = F.size(F.filter(bounds, lambda cut: cut <= value)) if cuts else F.lit(0)
    number = F.when(value.isNull(), 0).otherwise(number)
    return df.select(number.alias("range")).groupBy("range").agg(F.count(F.lit(1)).alias("n_rows"))
