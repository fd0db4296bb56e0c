"""Merkle manifest of a dataset: levels built bottom up, proofs by a recursive query.

Every row is a leaf. Leaves of a group are ordered and hashed in runs of eight, level by
level, up to the group's subroot; the subroots of all groups give the root in the same way.
Inner nodes are stored as rows that name their parent's place. A recursive query climbs
from every run of leaves to the root, appending the siblings it passes and folding the
digests of the leaves, tampered ones included.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from maskflow.llm.common import BROADCAST_BYTES, bytes_of, null_key, stored

FAN = 8
# Levels within a block: climbs of up to FAN**4 leaves share copies of the nodes above them,
# so that a join by block never meets more than FAN**3 runs at one node.
BLOCK_LEVELS = 4
BLOCK_RUNS = FAN ** (BLOCK_LEVELS - 1)
SALTS = 16
# Name of the group tree that holds the subroots; those of the groups begin with + or -.
TOP = ""
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def encoded(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and its text; a null is a dash."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex SHA-256 of the encoded columns, in their order."""
    return F.sha2(F.concat(*(encoded(c) for c in columns.values())), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a document is one of those whose text is tampered with."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 0, F.lit(False))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest_of(hexes: Column) -> Column:
    """Digest, as bytes, of digests put end to end, given as bytes and hashed as hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(hexes)), 256))


# -- places

def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows``, a stored table, with ``place``: gapless places from 0 within each ``group`` by
    ``order``, nulls first.

    Rows are dealt out by ranges of (group, order) and a number of their own, which parts
    repeated rows; the places of a range start behind the counts of the ranges before it.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_own")]
    numbered_rows = rows.withColumn("_own", F.monotonically_increasing_id())
    sorted_rows = numbered_rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The upper bits of the number are those of the partition.
    dealt = stored(sorted_rows.withColumn("_row", F.monotonically_increasing_id()).drop("_own"), name)
    dealt = dealt.withColumn("_part", F.shiftrightunsigned("_row", 33))
    starts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    met = dealt.join(starts, [group, "_part"])
    return met.withColumn("place", F.col("_row") - F.col("_first") + F.col("_start")).drop(
        "_part", "_row", "_first", "_start"
    )


# -- building

def next_level(nodes: DataFrame) -> DataFrame:
    """Parents (tree, place, size, children, digest) of the nodes (tree, place, digest, size)
    of trees of more than one node; ``size`` counts the nodes of the tree's level."""
    runs = nodes.where("size > 1").groupBy(
        "tree", F.expr(f"place div {FAN}").alias("place"), F.expr(f"(size + {FAN - 1}) div {FAN}").alias("size")
    )
    members = F.array_sort(F.collect_list(F.struct(F.col("place").alias("at"), "digest")))
    runs = runs.agg(members.alias("members"))
    children = F.aggregate("members", F.unhex(F.lit("")), lambda whole, m: F.concat(whole, m["digest"]))
    return runs.select("tree", "place", "size", children.alias("children")).withColumn(
        "digest", digest_of(F.col("children"))
    )


def build_levels(leaves: DataFrame, name: str) -> DataFrame:
    """Inner nodes (tree, height, place, size, children, digest) of all trees whose leaves
    (tree, place, digest, size) are given, level by level; each level is stored."""
    level, height = leaves, 0
    nodes = None
    while (level.agg(F.max("size")).first()[0] or 0) > 1:
        height += 1
        level = stored(next_level(level), f"{name}-{height}")
        found = level.withColumn("height", F.lit(height))
        nodes = found if nodes is None else nodes.unionByName(found)
    if nodes is None:
        empty = next_level(leaves).withColumn("height", F.lit(0))
        return empty.where("false")
    return nodes


def heights(size: Column) -> Column:
    """Levels above ``size`` leaves: the least h with FAN**h >= size. No log, which rounds."""
    powers = F.array(*(F.lit(FAN**k) for k in range(1, 21)))
    return F.when(size <= 1, F.lit(0)).otherwise(F.size(F.filter(powers, lambda p: p < size)) + 1)


def joined_small(rows: DataFrame, small: DataFrame, key: str, most: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with the columns of ``small``, a stored table of one row a key: broadcast up to
    ``most`` bytes, else met by (key, salt), so that a hot key is spread."""
    if bytes_of(small) <= most:
        return rows.join(F.broadcast(small), key)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("place"), F.lit(SALTS)).cast("int"))
    return salted.join(small.withColumn("_salt", salts), [key, "_salt"]).drop("_salt")


class Manifest:
    """The stored tables of one Merkle manifest.

    ``leaves``: (doc_id, tree, place, size, digest, changed); ``nodes`` and ``top``: the inner
    nodes of the groups' trees and of the tree of subroots; ``groups``: (tree, size, height,
    rank, subroot); ``root``: the root as bytes, or None without rows.
    """

    def __init__(self, leaves: DataFrame, nodes: DataFrame, groups: DataFrame, top: DataFrame):
        self.leaves, self.nodes, self.groups, self.top = leaves, nodes, groups, top
        found = top.where("size = 1").select("digest").first() or groups.select("subroot").first()
        self.root = bytes(found[0]) if found else None


def build(leaves: DataFrame, order: list[str]) -> Manifest:
    """A manifest of ``leaves``, which has group, digest and changed (bytes), and the columns
    of ``order``, all of which the leaves keep."""
    rows = stored(leaves.withColumn("tree", null_key(F.col("group"))), "leaves")
    placed = ranked(rows, "tree", [*order, "digest"], "ordered")
    sizes = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("size"), F.first("group").alias("group"))
    sizes = stored(sizes, "sizes")
    placed = stored(joined_small(placed, sizes.drop("group"), "tree"), "placed")
    nodes = build_levels(placed.select("tree", "place", "digest", "size"), "nodes")

    # Subroots: the one node of a tree's last level, or a leaf alone.
    tops = nodes.where("size = 1").select("tree", F.col("digest").alias("subroot"))
    alone = placed.where("size = 1").select("tree", F.col("digest").alias("subroot"))
    groups = sizes.join(tops.unionByName(alone), "tree").withColumn("all", F.lit(TOP))
    groups = ranked(stored(groups, "groups"), "all", ["group"], "ordered-groups")
    groups = stored(groups.withColumn("height", heights(F.col("size"))).withColumnRenamed("place", "rank"), "groups")
    subroots = groups.select(
        F.lit(TOP).alias("tree"), F.col("rank").alias("place"), F.col("subroot").alias("digest"),
        F.lit(groups.count()).cast("bigint").alias("size"),
    )
    return Manifest(placed.drop("group"), nodes, groups.drop("all", "group"), build_levels(subroots, "top"))


# -- climbing

def climb_nodes(manifest: Manifest) -> DataFrame:
    """Inner nodes as rows a climb meets: (tree, block, height, place, seat, children).

    ``seat`` is the place by which a node finds its parent at the next height: its own, or
    the group's rank at the subroot. Nodes above a block are copied to every block below
    them, so that all climbs of a block meet copies of their own.
    """
    seat = F.when(F.col("size") > 1, F.col("place")).otherwise(F.col("rank"))
    groups = manifest.groups.select("tree", "rank", "height")
    nodes = joined_small(
        manifest.nodes, groups.withColumnRenamed("height", "top"), "tree"
    ).withColumn("seat", seat)
    columns = ["tree", "block", "height", "place", "seat", "children"]
    inside = nodes.where(F.col("height") <= BLOCK_LEVELS).withColumn(
        "block", F.expr(f"place * cast(pow({FAN}, height - 1) as bigint) div {BLOCK_RUNS}")
    )
    # One row per block of a group, from the node at its top or the highest there is.
    blocks = manifest.groups.select(
        "tree", "rank", "height",
        F.explode(F.expr(f"sequence(0L, (size - 1) div {BLOCK_RUNS * FAN})")).alias("block"),
    )

    def met(steps: DataFrame, above: DataFrame, key: list[str]) -> DataFrame:
        """Steps of blocks with their nodes; few nodes are broadcast, else the join splits
        its skewed keys at run time."""
        return steps.join(F.broadcast(above) if bytes_of(above) <= BROADCAST_BYTES else above, key)

    level = F.explode(F.expr(f"sequence({BLOCK_LEVELS + 1}, height)"))
    high = blocks.where(F.col("height") > BLOCK_LEVELS).select(
        "tree", "block", level.alias("height")
    ).withColumn("place", F.expr(f"block div cast(pow({FAN}, height - {BLOCK_LEVELS}) as bigint)"))
    above = nodes.where(F.col("height") > BLOCK_LEVELS).select("tree", "height", "place", "seat", "children")
    high = met(high, above, ["tree", "height", "place"])

    found = inside.select(*columns).unionByName(high.select(*columns))
    tallest = manifest.top.agg(F.max("height")).first()[0] or 0
    if tallest:
        over = blocks.withColumn("step", F.explode(F.expr(f"sequence(1, {tallest})")))
        over = over.withColumn("place", F.expr(f"rank div cast(pow({FAN}, step) as bigint)"))
        top = manifest.top.select(F.col("height").alias("step"), "place", "children")
        over = met(over, top, ["step", "place"])
        found = found.unionByName(over.select(
            "tree", "block", (F.col("height") + F.col("step")).alias("height"), "place",
            F.col("place").alias("seat"), "children",
        ))
    return found


def climb_starts(manifest: Manifest, order: list[str]) -> DataFrame:
    """One row per run of leaves: its members, their digests folded to the run's node (a leaf
    alone stays as it is), where the climb goes on and its last height."""
    top = manifest.top.agg(F.max("height")).first()[0] or 0
    groups = manifest.groups.select("tree", "rank", "subroot", F.col("height").alias("tall"))
    member = F.struct(F.col("place").alias("at"), "digest", "changed", *order)
    runs = manifest.leaves.groupBy("tree", F.expr(f"place div {FAN}").alias("place")).agg(
        F.array_sort(F.collect_list(member)).alias("members")
    )
    runs = joined_small(runs, groups, "tree")

    def others(m: Column) -> Column:
        """The run's digests with those of one member changed."""
        return F.aggregate(
            "members", F.unhex(F.lit("")),
            lambda whole, x: F.concat(whole, F.when(x["at"] == m["at"], x["changed"]).otherwise(x["digest"])),
        )

    folded = F.transform(
        "members", lambda m: F.when(F.col("tall") == 0, m["changed"]).otherwise(digest_of(others(m)))
    )
    return runs.select(
        "tree", F.col("place").alias("run"), "subroot", "members", folded.alias("folded"),
        F.expr(f"place div {BLOCK_RUNS}").alias("block"),
        F.least("tall", F.lit(1)).alias("height"),
        F.when(F.col("tall") <= 1, F.col("rank")).otherwise(F.col("place")).alias("seat"),
        (F.col("tall") + F.lit(top)).alias("last"),
    )


@contextmanager
def recursion_settings(spark: SparkSession):
    """Recursive queries of any number of rows, for as long as one is run. Their steps keep
    the session's number of shuffle partitions: the union of all steps is read by as many
    tasks as one step has, which merged partitions would make a few."""
    settings = {ROW_LIMIT: "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# A node's children are digests of 32 bytes end to end; the climb comes from the child
# numbered seat % 8. Every step appends the other children to the siblings and hashes the
# children with the climb's own digests in place.
CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT tree, run, block, height, last, seat, folded, unhex('') AS siblings FROM {{starts}}
  UNION ALL
  SELECT c.tree, c.run, c.block, c.height + 1, c.last, n.seat,
    transform(c.folded, own -> unhex(sha2(lower(hex(concat(
      substring(n.children, 1, 32 * cast(c.seat % {FAN} as int)), own,
      substring(n.children, 32 * cast(c.seat % {FAN} as int) + 33)))), 256))),
    concat(c.siblings,
      substring(n.children, 1, 32 * cast(c.seat % {FAN} as int)),
      substring(n.children, 32 * cast(c.seat % {FAN} as int) + 33))
  FROM climb c JOIN {{nodes}} n
    ON n.tree = c.tree AND n.block = c.block AND n.height = c.height + 1 AND n.place = c.seat div {FAN})
SELECT tree, run, folded, siblings FROM climb WHERE height = last
"""


def climb(manifest: Manifest, order: list[str]) -> DataFrame:
    """(``order`` columns, leaf, subroot, root, proof_sha256, folded_root, verified) of every
    leaf, digests in hex: what a recursive query gives that climbs from every run of leaves
    to the root.

    The eight leaves of a run share all siblings above them and climb in one row. The
    siblings are hashed left to right, level by level, from the leaf's run up.
    """
    spark = manifest.leaves.sparkSession
    starts = stored(climb_starts(manifest, order), "climb-starts")
    nodes = stored(climb_nodes(manifest), "climb-nodes")
    views = {name: f"{name}_{id(starts)}" for name in ("starts", "nodes")}
    starts.drop("members", "subroot").createOrReplaceTempView(views["starts"])
    nodes.createOrReplaceTempView(views["nodes"])
    with recursion_settings(spark):
        reached = stored(spark.sql(CLIMB.format(**views)), "climbs")
    for view in views.values():
        spark.catalog.dropTempView(view)

    def siblings(m: Column) -> Column:
        """Digests of the run's other leaves, then those met on the way up."""
        own = F.aggregate(
            F.filter("members", lambda x: x["at"] != m["at"]), F.unhex(F.lit("")),
            lambda whole, x: F.concat(whole, x["digest"]),
        )
        return F.concat(own, F.col("siblings"))

    met = starts.select("tree", "run", "members", "subroot").join(reached, ["tree", "run"])
    proofs = F.transform(
        "members",
        lambda m, k: F.struct(
            *(m[c].alias(c) for c in order),
            m["digest"].alias("leaf"),
            digest_of(siblings(m)).alias("proof"),
            F.get("folded", k).alias("folded"),
        ),
    )
    rows = met.select("subroot", F.explode(proofs).alias("p"))
    root = F.unhex(F.lit((manifest.root or b"").hex()))

    def shown(digest: Column, name: str) -> Column:
        return F.lower(F.hex(digest)).alias(name)

    return rows.select(
        *(F.col(f"p.{c}").alias(c) for c in order),
        shown(F.col("p.leaf"), "leaf"),
        shown(F.col("subroot"), "subroot"),
        shown(root, "root"),
        shown(F.col("p.proof"), "proof_sha256"),
        shown(F.col("p.folded"), "folded_root"),
        (F.col("p.folded") == root).alias("verified"),
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, group, digest, changed) of documents: the digest of the whole row, and that of
    the row with its text tampered with where it is."""
    plain = {name: F.col(name) for name in COLUMNS}
    bad = {**plain, "text": lower_ascii(F.col("text"))}
    digest = F.unhex(leaf_digest(plain))
    changed = F.when(tampered(F.col("doc_id")), F.unhex(leaf_digest(bad))).otherwise(digest)
    return docs.select("doc_id", F.col("lang").alias("group"), digest.alias("digest"), changed.alias("changed"))


def verify_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Texts are read once and moved nowhere. Nulls in any column are encoded as such; a null
    lang is a group, sorted first, as is a null doc_id within its group; documents with equal
    doc_ids go by digest, and repeated rows are leaves of their own; an empty table gives no
    rows; other columns of the table play no part.
    """
    manifest = build(document_leaves(docs), ["doc_id"])
    return climb(manifest, ["doc_id"])
