"""Connected components of links between bigint ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import stored

# Copies of a node's smallest neighbour, so that a hub's links are dealt out.
SALTS = 16


def _to_smallest(links: DataFrame, only_larger: bool) -> DataFrame:
    """Every neighbour of a node linked to the node's smallest neighbour or itself.

    ``links`` has columns src and dst. The smallest is a partial aggregate; the
    links meet it by (node, salt), so that a hub is spread over tasks.
    """
    smallest = links.groupBy("src").agg(F.min("dst").alias("low"))
    smallest = smallest.select(
        "src",
        F.least("src", "low").alias("low"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    salted = links.withColumn("salt", F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int"))
    met = salted.join(smallest, ["src", "salt"])
    if only_larger:
        return met.where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    own = smallest.where("salt = 0").select("src", F.col("low").alias("dst"))
    return met.select(F.col("dst").alias("src"), F.col("low").alias("dst")).unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) for every id that occurs in ``links`` (a, b): the smallest
    id reachable. Null ends and self-links are ignored.

    Alternates linking larger neighbours and smaller neighbours to the smallest
    one until the links form stars, however many rounds that takes: every round
    brings some node nearer to its smallest, and a round that changes nothing is the
    last. Each round is a stored table, so lineage stays short; only a count and a
    checksum reach the driver.
    """
    ends = links.select(F.col("a").cast("bigint").alias("src"), F.col("b").cast("bigint").alias("dst"))
    now = stored(
        ends.where("src <> dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        mark = now.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")), F.lit(0)),
        ).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        large = _to_smallest(both, only_larger=True).distinct()
        now = stored(
            _to_smallest(large, only_larger=False).where("src <> dst").distinct(), "links"
        )
    found = now.select(F.col("src").alias("id"), F.col("dst").alias("component_id"))
    roots = now.select(F.col("dst").alias("id")).distinct()
    return found.unionByName(roots.select("id", F.col("id").alias("component_id")))
