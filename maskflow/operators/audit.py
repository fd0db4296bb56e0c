"""Checks on masked tables: do raw values remain, do joins still match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.sources.shared import shared_folder

# Bits of the filter per distinct raw value, and the fewest and most bits there are.
BITS_A_VALUE = 16
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 28
# A bitmap's bits, fixed by the functions that build it.
BITMAP_BITS = 32768
# Rows of values up to which those that pass the filter are broadcast, if short.
SURVIVOR_BYTES = 32 << 20


def value_filter(values: DataFrame, bits: int) -> DataFrame:
    """(bucket, bitmap): a set bit for the hash of every text of the column ``value``, in
    bitmaps of 4 KB; at most ``bits`` / 8 bytes in all."""
    place = F.pmod(F.xxhash64("value"), F.lit(bits)) + 1
    return (
        values.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


def passing(values: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Rows of the column ``value`` whose bit is set. The bitmaps are broadcast, bounded as
    they are; the values stay where they are."""
    place = F.pmod(F.xxhash64("value"), F.lit(bits)) + 1
    rows = values.select(
        "value", F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit")
    )
    byte = F.expr("conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10)").cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
    return rows.join(F.broadcast(bitmaps), "bucket").where(is_set).select("value")


def leaked_values(raw: DataFrame, masked: DataFrame, raw_name: str, masked_name: str) -> DataFrame:
    """Distinct values found in both columns, as text; empty if the masking is complete.

    The raw values set bits by their hash; masked values without their bit, all but a few
    of a complete masking, go where they are read. What passes is made distinct, then looked
    for among the raw values: neither table's values are shuffled. With more raw values than
    the largest filter tells apart more pass, and the result is the same.
    """
    shared_folder(raw.sparkSession)
    before = raw.select(F.col(raw_name).cast("string").alias("value")).where("value is not null")
    after = masked.select(F.col(masked_name).cast("string").alias("value")).where("value is not null")
    wanted = BITS_A_VALUE * (before.agg(F.approx_count_distinct("value")).first()[0] or 1)
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length()))
    suspects = passing(after, value_filter(before, bits), bits).distinct().checkpoint()
    size = suspects.agg(F.sum(F.octet_length("value") + 32)).first()[0] or 0
    few = F.broadcast(suspects) if size <= SURVIVOR_BYTES else suspects
    return before.join(few, "value", "left_semi").distinct()


def leak_report(raw: DataFrame, masked: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per column: distinct raw values, distinct masked values, and those in both.

    One scan of each table and one shuffle of its values, whatever the number
    of columns. Nulls are left out.
    """

    def values(df: DataFrame, side: str) -> DataFrame:
        pairs = F.array(
            *[
                F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
                for name in names
            ]
        )
        return (
            df.select(F.inline(pairs))
            .where(F.col("value").isNotNull())
            .select(
                "column",
                "value",
                F.lit(side == "raw").alias("in_raw"),
                F.lit(side == "masked").alias("in_masked"),
            )
        )

    per_value = (
        values(raw, "raw")
        .unionAll(values(masked, "masked"))
        .groupBy("column", "value")
        .agg(F.bool_or("in_raw").alias("in_raw"), F.bool_or("in_masked").alias("in_masked"))
    )
    return per_value.groupBy("column").agg(
        F.count_if("in_raw").alias("raw_values"),
        F.count_if("in_masked").alias("masked_values"),
        F.count_if(F.col("in_raw") & F.col("in_masked")).alias("leaked_values"),
    )


def join_size(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Number of rows of an inner join, from per-key counts and without its rows."""
    lefts = left.groupBy(F.col(left_key).alias("key")).agg(F.count(F.lit(1)).alias("l"))
    rights = right.groupBy(F.col(right_key).alias("key")).agg(F.count(F.lit(1)).alias("r"))
    joined = lefts.join(rights, "key")
    return joined.agg(F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_rows"))


def joins_preserved(
    raw: tuple[DataFrame, DataFrame],
    masked: tuple[DataFrame, DataFrame],
    left_key: str,
    right_key: str,
) -> DataFrame:
    """One row (raw_rows, masked_rows): equal if masked keys still join as raw ones do."""
    before = join_size(*raw, left_key, right_key).withColumnRenamed("n_rows", "raw_rows")
    after = join_size(*masked, left_key, right_key).withColumnRenamed("n_rows", "masked_rows")
    both = before.select("raw_rows", F.lit(None).cast("bigint").alias("masked_rows")).unionAll(
        after.select(F.lit(None).cast("bigint").alias("raw_rows"), "masked_rows")
    )
    return both.agg(F.max("raw_rows").alias("raw_rows"), F.max("masked_rows").alias("masked_rows"))
