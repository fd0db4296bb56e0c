"""Sharding by a tree of weighted hash draws."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import numbered, stored, utf8_bytes


@dataclass(frozen=True)
class Tree:
    """Regions of racks of shards: shard ``i`` lies in rack ``i // rack_shards``, rack
    ``r`` in region ``r // region_racks``. ``weights`` overrides the weight 1 of
    single shards; a weight of 0 or less takes a shard out."""

    shards: int
    rack_shards: int = 5
    region_racks: int = 4
    weights: dict[int, float] = field(default_factory=dict)

    def nested(self) -> list[list[list[int]]]:
        """Shard numbers by region and rack, without those taken out."""
        regions: dict[int, dict[int, list[int]]] = {}
        for shard in range(self.shards):
            if self.weights.get(shard, 1.0) > 0:
                rack = shard // self.rack_shards
                regions.setdefault(rack // self.region_racks, {}).setdefault(rack, []).append(shard)
        return [list(racks.values()) for racks in regions.values()]


def _arrival(key: Column, shard: int, weight: float) -> Column:
    """A weighted draw of a key at a shard: exponential with the shard's weight as
    rate, a function of key and shard alone. The lowest draw wins."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"shard {shard}"), key), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / F.lit(weight)


def placed(key: Column, tree: Tree) -> Column:
    """(shard, draw) of a key, found by descending region, rack and shard.

    Every shard's draw belongs to its leaf alone; that of a rack or region is the lowest
    draw in its subtree: exponential with the subtree's weight as rate, so regions and
    racks are chosen by weight. As it depends on nothing outside the subtree, a changed
    weight moves rows only between the changed shard and others, and a new shard only
    takes rows in. Equal draws go to the lower number at every level. The descent hence
    ends at the lowest draw of all shards.
    """
    key = key.cast("string")
    nested = tree.nested()
    if not nested:
        raise ValueError("no shard has weight")
    leaves = F.array(
        *(
            F.array(
                *(
                    F.array(*(_arrival(key, s, tree.weights.get(s, 1.0)) for s in rack))
                    for rack in racks
                )
            )
            for racks in nested
        )
    )
    numbers = F.array(*(F.array(*(F.array(*map(F.lit, rack)) for rack in racks)) for racks in nested))

    def descend(node: Column, number: Column) -> Column:
        """Follow the lowest draw through three levels of nested arrays."""
        by_rack = F.transform(node, lambda racks: F.transform(racks, F.array_min))
        by_region = F.transform(by_rack, F.array_min)
        region = F.array_position(by_region, F.array_min(by_region)).cast("int")
        rack_draws = F.element_at(by_rack, region)
        rack = F.array_position(rack_draws, F.array_min(rack_draws)).cast("int")
        draws = F.element_at(F.element_at(node, region), rack)
        shard = F.array_position(draws, F.array_min(draws)).cast("int")
        found = F.element_at(F.element_at(F.element_at(number, region), rack), shard)
        return F.struct(found.alias("shard"), F.array_min(draws).alias("draw"))

    return F.get(F.transform(F.array(leaves), lambda node: descend(node, numbers)), F.lit(0))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard a key belongs to."""
    return placed(key, tree)["shard"]


def shard_after_growth(place: Column, key: Column, tree: Tree, shards: int) -> Column:
    """The shard of a key once the tree has ``shards`` shards, new ones of weight 1, given its
    (shard, draw) in ``tree``: a new shard where its draw is lower, else the one it had."""
    new = range(tree.shards, shards)
    if not new:
        return place["shard"]
    draws = F.array(*(_arrival(key.cast("string"), s, 1.0) for s in new))
    lowest = F.array_min(draws)
    taken = (F.array_position(draws, lowest) + F.lit(tree.shards - 1)).cast("int")
    return F.when(lowest < place["draw"], taken).otherwise(place["shard"])


def shard(docs: DataFrame, tree: Tree, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with the column ``out``: a shard of the tree, from the key alone.

    One projection, no shuffle. A null key counts as one more key, so rows
    without one share a shard; repeated rows get equal shards; text plays no
    part; an ``out`` the table has already is replaced; an empty table stays
    empty.
    """
    return docs.withColumn(out, shard_of(F.coalesce(F.col(key).cast("string"), F.lit("")), tree))


def with_slots(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sharded ``docs`` with ``slot``: gapless places from 0 within each shard.

    Sorted by a hash of key and text. ``docs`` must read stored files, as the
    partition a row is read from tells repeated rows apart.
    """
    rows = docs.drop("slot").select(
        F.struct("*").alias("doc"),
        F.col("shard"),
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("_order"),
        F.spark_partition_id().alias("_home"),
    )
    return numbered(rows, ["shard"], "_order", "slot", "_home").select("doc.*", "slot")


def shard_digests(docs: DataFrame, tree: Tree, grown: int) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The size is the text's UTF-8 bytes (null: none) plus 16, the checksum that
    of the text (null: of no bytes); ``grown_shard`` is the shard once there are
    ``grown`` shards. The narrow rows are stored once; texts pass no shuffle.
    """
    rows = docs.select(
        F.col("doc_id"),
        (utf8_bytes("text") + 16).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    place = F.col("_place")
    rows = rows.withColumn("_place", placed(key, tree)).withColumns(
        {"shard": place["shard"], "grown_shard": shard_after_growth(place, key, tree, grown)}
    ).drop("_place")
    rows = rows.withColumn("_order", F.xxhash64(F.col("doc_id").cast("string"), "text_crc32", "size"))
    rows = stored(rows.withColumn("_home", F.spark_partition_id()), "shards")
    return numbered(rows, ["shard"], "_order", "slot", "_home").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
