"""SimHash near-duplicates, found with BK-trees over fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import BROADCAST_BYTES, bytes_of, hashable, null_key, stored
from maskflow.llm.components import components

RADIUS = 3
SHINGLE = 3
# Fingerprints in one tree, about 30 bytes each when sent to a task.
TREE_SIZE = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits of a whole text: a bit is set if it is in over half the hashes of its
    shingles, repeats included. No words: 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), dtype=np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    result = 0
    for k in range(8):
        counts = np.bincount(octets[:, k], minlength=256)
        for bit in range(8):
            ones = counts[_HAS_BIT[bit]].sum()
            if 2 * int(ones) > len(hashes):
                result |= 1 << (8 * k + bit)
    return result


_HAS_BIT = [(np.arange(256) >> bit & 1).astype(bool) for bit in range(8)]


def fingerprint_of(text, shingle: int = SHINGLE) -> F.Column:
    """Column of fingerprints as bigint, the 64 bits taken as signed."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [fingerprint(t if isinstance(t, str) else None, shingle) for t in texts]
            yield pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return F.pandas_udf(run, "bigint")(text)


class Tree:
    """BK-tree of integers: a child hangs below its parent under their Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        """Add a value; one that is there already is left out."""
        self.values.append(value)
        self.children.append({})
        place, at = len(self.values) - 1, 0
        while place:
            distance = (self.values[at] ^ value).bit_count()
            if not distance:
                self.values.pop()
                self.children.pop()
                return
            below = self.children[at].setdefault(distance, place)
            if below == place:
                return
            at = below

    def within(self, value: int, radius: int) -> list[int]:
        """Values at most ``radius`` away, following only edges that can lead to one."""
        found, open_ = [], [0] if self.values else []
        values, children = self.values, self.children
        while open_:
            at = open_.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(values[at])
            below = children[at]
            if len(below) > 2 * radius + 1:
                open_ += [below[d] for d in range(distance - radius, distance + radius + 1) if d in below]
            else:
                open_ += [c for d, c in below.items() if -radius <= d - distance <= radius]
        return found


def blocks_needed(rows: int, radius: int = RADIUS, bits: int = 64, per_key: int = 64) -> int:
    """Smallest number of blocks whose keys hold at most ``per_key`` of ``rows`` spread
    fingerprints on average."""
    blocks = radius + 1
    while blocks < 2 * radius + 2 and rows > per_key * 2 ** (bits * (blocks - radius) // blocks):
        blocks += 1
    return blocks


def key_columns(blocks: int, radius: int = RADIUS, bits: int = 64) -> list[F.Column]:
    """Keys of the column ``fp``: two fingerprints at most ``radius`` apart agree in at
    least ``blocks - radius`` of the blocks, hence in one of these keys."""
    cuts = [bits * k // blocks for k in range(blocks + 1)]
    keys = []
    for kept in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << (cuts[k + 1] - cuts[k])) - 1) << cuts[k] for k in kept)
        mask -= (mask >> 63) << 64
        keys.append(F.col("fp").bitwiseAND(F.lit(mask).cast("bigint")))
    return keys


def _root(parent: dict[int, int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _forest(parent: dict[int, int]) -> list[tuple[int, int]]:
    return [(x, r) for x in parent if (r := _root(parent, x)) != x]


def _join(parent: dict[int, int], a: int, b: int) -> None:
    a, b = _root(parent, a), _root(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def _links_of_cell(mine: list[int], other: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that hold together all fingerprints of a tree (and of a second list of
    the same key) that are at most ``radius`` apart: a forest, not all pairs."""
    unsigned = (1 << 64) - 1
    tree = Tree()
    parent = {x: x for x in mine}
    for x in mine:
        if other is None:
            for y in tree.within(x & unsigned, radius):
                _join(parent, x, y if y < 1 << 63 else y - (1 << 64))
        tree.add(x & unsigned)
    for x in other or ():
        parent.setdefault(x, x)
        for y in tree.within(x & unsigned, radius):
            _join(parent, x, y if y < 1 << 63 else y - (1 << 64))
    return _forest(parent)


def near_links(fingerprints: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, as bigint, that connect all that
    are at most ``radius`` bits apart.

    Fingerprints meet under keys made of whole blocks. A key with more than
    ``tree_size`` fingerprints is split into trees of that size; every tree is
    sent to every list of its key, so one task holds two pieces at most.
    """
    rows = fingerprints.select("fp").distinct()
    rows = stored(rows, "fingerprints")
    keys = key_columns(blocks_needed(rows.count(), radius), radius)
    cells = rows.select(
        "fp", F.posexplode(F.array(*keys)).alias("block", "key")
    )
    sizes = cells.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.withColumn("pieces", F.ceil(F.col("n") / tree_size).cast("int"))
    # At most 1 / tree_size of all cells: the large keys alone.
    large = stored(sizes.where("pieces > 1").select("block", "key", "pieces"), "large-keys")

    def link_small(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, members = None, []
        for batch in batches:
            found = []
            for block, key, fp in zip(batch["block"], batch["key"], batch["fp"]):
                if (block, key) != cell:
                    if len(members) > 1:
                        found += _links_of_cell(members, None, radius)
                    cell, members = (block, key), []
                members.append(int(fp))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if len(members) > 1:
            found = _links_of_cell(members, None, radius)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    # The large keys are at most cells / tree_size rows; beyond a size they are shuffled.
    sent = F.broadcast(large) if bytes_of(large) <= BROADCAST_BYTES else large
    flagged = cells.join(sent, ["block", "key"], "left")
    small = (
        flagged.where("pieces is null")
        .repartition("block", "key")
        .sortWithinPartitions("block", "key", "fp")
        .select("block", "key", "fp")
        .mapInPandas(link_small, "a bigint, b bigint")
    )

    pieces = flagged.where("pieces is not null").withColumn(
        "piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    )
    firsts = pieces.select(
        "block", "key", "fp", F.col("piece").alias("i"),
        F.explode(F.sequence("piece", F.col("pieces") - 1)).alias("j"), F.lit(True).alias("is_tree"),
    )
    seconds = pieces.where("piece > 0").select(
        "block", "key", "fp",
        F.explode(F.sequence(F.lit(0), F.col("piece") - 1)).alias("i"), F.col("piece").alias("j"),
        F.lit(False).alias("is_tree"),
    )

    def link_pieces(group: pd.DataFrame) -> pd.DataFrame:
        tree = [int(x) for x in group.loc[group["is_tree"], "fp"]]
        rest = [int(x) for x in group.loc[~group["is_tree"], "fp"]]
        same = group["i"].iloc[0] == group["j"].iloc[0]
        found = _links_of_cell(tree, None if same else rest, radius)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    wide = (
        firsts.unionByName(seconds)
        .groupBy("block", "key", "i", "j")
        .applyInPandas(link_pieces, "a bigint, b bigint")
    )
    return small.unionByName(wide)


def near_duplicates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, group_fp) for the fingerprints of ``prints`` that are linked to another:
    ``group_fp`` is the smallest of their component as a signed number."""
    found = components(near_links(prints, radius))
    return found.select(F.col("id").alias("fp"), F.col("component_id").alias("group_fp"))


def component_ids(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, component_id) for every fingerprint: the smallest doc_id among documents
    whose fingerprints are reachable over links. ``prints`` has doc_id and fp.

    Copies share a fingerprint and are one row here, so groups of any size take
    part as one. Null doc_ids are never the smallest.
    """
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
    groups = near_duplicates(classes, radius)
    linked = classes.join(groups, "fp", "left").withColumn(
        "group_fp", F.coalesce("group_fp", "fp")
    )
    lows = linked.groupBy("group_fp").agg(F.min("low").alias("component_id"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt")
    return (
        linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(16)).cast("int"))
        .join(lows.select("*", salts), ["group_fp", "salt"])
        .select("fp", "component_id")
    )


def with_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``prints`` (doc_id, fp, ...) with ``component_id``, which takes the place of one it has.

    Null and empty texts have fingerprint 0 and are linked like any other;
    repeated rows stay; an empty table stays empty. Each fingerprint's answer is
    copied to 16 salts, so the copies of one text are dealt out.
    """
    answers = component_ids(prints, radius).select(
        "fp", "component_id", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("_fp_salt")
    )
    salted = prints.drop("component_id").withColumn(
        "_fp_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(16)).cast("int")
    )
    return salted.join(answers, ["fp", "_fp_salt"]).drop("_fp_salt")


def one_of_each(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The documents that stay when one of every group of near-duplicates stays.

    That is the one with the smallest doc_id (null last), then the smallest hash
    of the whole row; of rows equal in all columns one stays. Other columns may hold
    anything, maps included. Texts are moved once, to meet the narrow rows of those
    that stay.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hashed = hashable(docs)
    rows = docs.select(
        F.struct(*columns).alias("doc"), F.xxhash64(*hashed).alias("row"), F.xxhash64(F.lit(1), *hashed).alias("row2")
    )
    prints = stored(
        rows.select(
            F.col("doc.doc_id").alias("doc_id"), "row",
            fingerprint_of(F.col("doc.text"), shingle).alias("fp"),
        ),
        "prints",
    )
    classes = stored(
        prints.groupBy("fp").agg(
            F.min("doc_id").alias("low"),
            F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best"),
        ),
        "classes",
    )
    groups = near_duplicates(classes, radius)
    best = (
        classes.join(groups, "fp", "left")
        .groupBy(F.coalesce("group_fp", "fp").alias("group_fp"))
        .agg(F.min("best").alias("best"))
        .select(null_key(F.col("best.doc_id")).alias("key"), F.col("best.row").alias("row"))
    )
    if prints.count() != prints.select("doc_id", "row").distinct().count():
        rows = rows.dropDuplicates(["row", "row2"])  # equal rows meet in partial aggregates first
    kept = rows.withColumn("key", null_key(F.col("doc.doc_id"))).join(
        best.distinct(), ["key", "row"], "left_semi"
    )
    return kept.select("doc.*")
