"""Pieces that several operators on training data share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.sources.shared import new_path

# White space of the word rule: \x20 and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"
# Measured bytes up to which a stored table is broadcast.
BROADCAST_BYTES = 32 << 20


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts the lineage so that a lost executor costs a re-read, and freezes what
    later steps read more than once.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bytes_of(table: DataFrame) -> int:
    """Bytes of a stored table's values: texts and binaries by their lengths, other values
    16 each. What a broadcast is checked with, beside the overhead of its rows."""
    texts = [f.name for f in table.schema if f.dataType.simpleString() in ("string", "binary")]
    fixed = F.lit(16 * len(table.columns))
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), fixed)
    return int(table.agg(F.sum(size.cast("bigint"))).first()[0] or 0)


def hashable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` as hash functions take them: those that hold a map or a variant
    as JSON text."""
    return [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if any(x in f.dataType.simpleString() for x in ("map<", "variant"))
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]


def word_count(text: str | Column) -> Column:
    """Number of runs of other characters than white space; null counts 0.

    Every word is shortened to one character and white space removed, so no
    array of words is built, however long the text.
    """
    text = F.col(text) if isinstance(text, str) else text
    short = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(short, SPACES, "")), F.lit(0)).cast("bigint")


def utf8_bytes(text: str | Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def null_key(column: Column) -> Column:
    """A column as a text join key that is never null."""
    return F.when(column.isNull(), F.lit("-")).otherwise(
        F.concat(F.lit("+"), column.cast("string"))
    )


def numbered(df: DataFrame, keys: list[str], order: str, out: str, home: str) -> DataFrame:
    """Add ``out``: gapless places from 0 among the rows of equal ``keys``, sorted
    by the bigint column ``order``.

    No task holds the rows of a key: places come from counts of (key, order,
    home) and prefix sums over them in two levels, first within 1/4096 of the
    range of ``order``, then over these parts. ``home`` is a column that holds
    the input partition a row was read from; it parts rows with equal
    ``order``, which must be interchangeable.
    """
    part = f"{out}_part"
    rows = df.withColumn(part, F.shiftrightunsigned(order, 52))
    counts = rows.groupBy(*keys, part, order, home).agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(*keys, part).orderBy(order, home)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = counts.groupBy(*keys, part).agg(F.sum("n").alias("n"))
    earlier = (
        Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.select(
        *keys, part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start")
    )
    starts = starts.join(parts, [*keys, part]).select(
        *keys, part, order, home, (F.col("start") + F.col("part_start")).alias(f"{out}_start")
    )
    local = Window.partitionBy(*keys, part, order, home).orderBy(F.lit(0))
    return (
        rows.join(starts, [*keys, part, order, home])
        .withColumn(out, F.col(f"{out}_start") + F.row_number().over(local) - 1)
        .drop(part, f"{out}_start")
    )
