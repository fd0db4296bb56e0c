"""City lookup: a city drawn among those sharing a zip's first three digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from maskflow.functions.text import quoted
from maskflow.sources.shared import shared_folder

# Texts given for zips that cannot be looked up.
NOT_A_ZIP = "that is not a valid zipcode"
UNKNOWN = "unknown"

# Bytes of a broadcast row besides its text: two keys, a place, the hash map around them.
ROW_BYTES = 96
# Keys looked up apart as possible hot ones. No other key holds 1/N of all rows.
HOT_KEYS = 1024
# Cities in one row of ``cities_by_area``.
LIST_SIZE = 10_000


def cities_by_area(cities: DataFrame, list_size: int = LIST_SIZE, large: bool = False) -> DataFrame:
    """(zip, city) as (zip3, part, cities): sorted lists of at most ``list_size`` cities.

    Part 0 holds the first cities of an area, and nearly always all of them.
    """
    _, numbered = numbered_cities(cities, large)
    part = F.floor(F.col("place") / list_size).cast("int").alias("part")
    return numbered.groupBy("zip3", part).agg(F.sort_array(F.collect_list("city")).alias("cities"))


def numbered_cities(cities: DataFrame, large: bool = False) -> tuple[DataFrame, DataFrame]:
    """Postal table as (zip3, n) and (zip3, city, place) with places 0 to n-1.

    A table of broadcast size is numbered by one window. A ``large`` one is dealt
    out by ranges of (zip3, city) first, so that an area is numbered by as many
    tasks as it fills; it is checkpointed, as ranges are found by sampling.
    """
    areas = cities.select(F.substring("zip", 1, 3).alias("zip3"), "city")
    counts = areas.groupBy("zip3").agg(F.count(F.lit(1)).alias("n"))
    if not large:
        in_area = Window.partitionBy("zip3").orderBy("city")
        return counts, areas.withColumn("place", (F.row_number().over(in_area) - 1).cast("bigint"))
    shared_folder(cities.sparkSession)
    ranged = (
        areas.repartitionByRange("zip3", "city")
        .withColumn("range", F.spark_partition_id())
        .checkpoint()
    )
    earlier = (
        Window.partitionBy("zip3").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = ranged.groupBy("zip3", "range").agg(F.count(F.lit(1)).alias("rows"))
    starts = starts.select(
        "zip3", "range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start")
    )
    in_range = Window.partitionBy("zip3", "range").orderBy("city")
    numbered = ranged.join(starts, ["zip3", "range"]).withColumn(
        "place", (F.col("start") + F.row_number().over(in_range) - 1).cast("bigint")
    )
    return counts, numbered.select("zip3", "city", "place")


def table_bytes(table: DataFrame, text: str | None = None) -> int:
    """Bytes that a broadcast of the table takes, from its rows and the length of one text."""
    length = F.coalesce(F.octet_length(text), F.lit(0)) if text else F.lit(0)
    return table.agg(F.sum(length + ROW_BYTES)).first()[0] or 0


def join_spread(
    frame: DataFrame, table: DataFrame, key: Column, table_key: Column, value: str, out: str,
    spread_on: list[str],
) -> DataFrame:
    """``frame`` with ``out``, the ``value`` of the table's row of an equal key, or null.

    For tables that are not broadcast. The most frequent keys, a fixed number,
    are looked up by broadcast, those that the table lacks included. They and
    null keys then take part in the shuffle under fillers that match nothing
    and spread them. A filler comes from the row and its partition, so it stays
    the same when a task is repeated.
    """
    probe, found, hot = f"{out}_probe", f"{out}_hot", f"{out}_is_hot"
    keyed = frame.withColumn(probe, key)
    rows = table.select(table_key.alias(probe), F.col(value).alias(found))
    often = (
        keyed.where(F.col(probe).isNotNull()).groupBy(probe).count()
        .orderBy(F.desc("count"), probe).limit(HOT_KEYS).select(probe)
    )
    few = F.broadcast(often).join(rows, probe, "left").withColumn(hot, F.lit(True))
    row = F.xxhash64(F.spark_partition_id(), *[quoted(name) for name in spread_on])
    filler = F.concat(F.lit("-"), row.cast("string"))
    keyed = keyed.join(F.broadcast(few), probe, "left")
    cold = F.when(F.col(hot).isNull() & F.col(probe).isNotNull(), F.concat(F.lit("+"), probe))
    keyed = keyed.withColumn(probe, F.coalesce(cold, filler))
    rows = rows.select(F.concat(F.lit("+"), probe).alias(probe), F.col(found).alias(f"{out}_cold"))
    joined = keyed.join(rows, probe, "left")
    return joined.withColumn(out, F.coalesce(found, f"{out}_cold")).drop(
        probe, found, hot, f"{out}_cold"
    )


def add_city(
    frame: DataFrame,
    zip_code: str,
    chance: str,
    cities: DataFrame,
    out: str,
    broadcast_bytes: int = 64 << 20,
    spread_on: list[str] = (),
) -> DataFrame:
    """Add ``out``: the city at ``chance`` of the way through the zip's area, both
    being columns.

    Two lookups, by area and by (area, place), in place of a list per row. A
    side of at most ``broadcast_bytes`` is broadcast and the table not moved.
    Beyond that null and short zips, unknown areas and frequent keys stay out of
    the shuffle's keys (see ``join_spread``).
    """
    cities = cities.where(F.length("zip") >= 3)
    large = table_bytes(cities, "city") > broadcast_bytes
    sizes, numbered = numbered_cities(cities, large)
    zip3, place, n, city = (f"{out}_{part}" for part in ("zip3", "place", "n", "city"))
    joined = frame.withColumn(zip3, F.when(F.length(zip_code) >= 3, F.substring(zip_code, 1, 3)))
    if not large or table_bytes(sizes) <= broadcast_bytes:
        few = sizes.select(F.col("zip3").alias(zip3), F.col("n").alias(n))
        joined = joined.join(F.broadcast(few), zip3, "left")
    else:
        joined = join_spread(joined, sizes, F.col(zip3), F.col("zip3"), "n", n, spread_on)
    joined = joined.withColumn(place, F.floor(F.col(chance) * F.col(n)))
    if not large:
        few = numbered.select(
            F.col("zip3").alias(zip3), F.col("place").alias(place), F.col("city").alias(city)
        )
        joined = joined.join(F.broadcast(few), [zip3, place], "left")
    else:
        # Null, and so out of the shuffle, for null and short zips and unknown areas.
        key = F.concat(F.col(zip3), F.lit("/"), F.col(place).cast("string"))
        table_key = F.concat(F.col("zip3"), F.lit("/"), F.col("place").cast("string"))
        joined = join_spread(joined, numbered, key, table_key, "city", city, spread_on)
    found = (
        F.when(F.col(zip_code).isNull(), None)
        .when(F.col(zip3).isNull(), NOT_A_ZIP)
        .otherwise(F.coalesce(F.col(city), F.lit(UNKNOWN)))
    )
    return joined.withColumn(out, found).drop(zip3, place, n, city)
