"""Plain relational operators the engine's jobs and demos use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNotNull())


def null_or_empty(df: DataFrame, name: str) -> DataFrame:
    """Rows whose text is missing: null or empty."""
    return df.where(F.col(name).isNull() | (F.col(name) == ""))


def with_sum(df: DataFrame, first: str, second: str, out: str = "sum") -> DataFrame:
    return df.withColumn(out, F.col(first) + F.col(second))


def days_since_epoch(c: Column) -> Column:
    return F.datediff(c, F.lit("1970-01-01").cast("date"))


def join_on(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join of tables from any two sources.

    No hint: Spark broadcasts by its own size limit and splits the partitions
    of hot keys otherwise.
    """
    return left.join(right, left[left_key] == right[right_key])


def count_through_chain(
    named: DataFrame,
    linked: DataFrame,
    facts: DataFrame,
    name: str,
    named_key: str,
    linked_to_named: str,
    linked_key: str,
    fact_key: str,
) -> DataFrame:
    """Rows per ``name`` of the chain named - linked - facts, inner joined by keys.

    The facts are counted per key first and the links then per named key, so
    no join moves more than one row per key and a hot key meets its rows in
    partial aggregates before any shuffle.
    """
    per_link = facts.groupBy(F.col(fact_key).alias("link")).agg(F.count(F.lit(1)).alias("n"))
    per_named = (
        linked.select(F.col(linked_to_named).alias("owner"), F.col(linked_key).alias("link"))
        .join(per_link, "link")
        .groupBy("owner")
        .agg(F.sum("n").alias("n"))
    )
    return (
        named.select(F.col(name), F.col(named_key).alias("owner"))
        .join(per_named, "owner")
        .groupBy(name)
        .agg(F.sum("n").alias("count"))
    )
