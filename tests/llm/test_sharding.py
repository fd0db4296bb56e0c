"""Sharding, against draws worked out with the xxhash module."""

import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from maskflow.llm.sharding import Tree, placed, shard, shard_after_growth, shard_digests, with_slots


def draw(key, number, weight=1.0):
    # Spark's xxhash64 of several columns seeds each with the hash of those before.
    first = xxhash.xxh64_intdigest(f"shard {number}".encode(), 42)
    bits = xxhash.xxh64_intdigest(key.encode(), first) >> 11
    return -math.log((bits + 0.5) / 2.0**53) / weight


def rows(n):
    return [(k, f"text {k % 50}", f"s{k % 3}") for k in range(n)]


def test_brute_force(spark, make_docs):
    tree = Tree(13, 2, 3, {4: 3.0, 7: 0.0})
    got = shard(make_docs(rows(500)), tree).collect()
    for r in got:
        costs = {s: draw(str(r["doc_id"]), s, tree.weights.get(s, 1.0)) for s in range(13) if s != 7}
        assert r["shard"] == min(costs, key=costs.get)


def test_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = Counter(r["shard"] for r in shard(docs, Tree(8, 2, 2, {3: 4.0})).select("shard").collect())
    assert abs(counts[3] / 20_000 - 4 / 11) < 0.02
    assert all(abs(counts[s] / 20_000 - 1 / 11) < 0.01 for s in range(8) if s != 3)


def test_weights_at_every_level(spark):
    weights = {0: 2.0, 1: 0.5, 2: 3.0, 4: 0.0, 7: 1.5, 8: 4.0, 9: 0.25, 11: 0.0}
    tree = Tree(12, 2, 2, weights)
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"))
    counts = Counter(r["shard"] for r in shard(docs, tree).select("shard").collect())
    own = {s: weights.get(s, 1.0) for s in range(12)}
    for size in (1, 2, 4):  # shards, racks, regions
        for first in range(0, 12, size):
            part = range(first, first + size)
            share = sum(own[s] for s in part) / sum(own.values())
            assert abs(sum(counts[s] for s in part) / 40_000 - share) < 0.01


def test_growth_equals_the_grown_tree(spark):
    docs = spark.range(3_000).select(F.col("id").alias("doc_id"))
    tree = Tree(7, 2, 2, {3: 2.0, 5: 0.0})
    key = F.col("doc_id").cast("string")
    rows = docs.withColumn("place", placed(key, tree))
    for shards in (7, 8, 11):
        grown = Tree(shards, 2, 2, tree.weights)
        found = rows.select("doc_id", shard_after_growth(F.col("place"), key, tree, shards).alias("shard"))
        assert dict(map(tuple, found.collect())) == dict(map(tuple, shard(docs, grown).select("doc_id", "shard").collect()))


def test_growth_and_changes_move_rows_only_to_or_from_what_changed(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))

    def at(tree):
        return {r["doc_id"]: r["shard"] for r in shard(docs, tree).select("doc_id", "shard").collect()}

    old = at(Tree(40))
    for changed, tree in ((40, Tree(41)), (5, Tree(40, weights={5: 2.5})), (9, Tree(40, weights={9: 0.0}))):
        new = at(tree)
        moved = [k for k in old if old[k] != new[k]]
        assert moved
        if tree.weights.get(changed, 1.0) >= 1:
            assert {new[k] for k in moved} == {changed}
        else:
            assert {old[k] for k in moved} == {changed}


def test_digests(spark, make_docs):
    special = [(9000, None, "s"), (9001, "", "s"), (None, "é" * 100_000, "s"), (None, None, None)]
    docs = make_docs(rows(800) + special + rows(5) + rows(5))
    got = shard_digests(docs, Tree(40), 41).collect()
    assert len(got) == 814
    for number in range(40):
        slots = sorted(r["slot"] for r in got if r["shard"] == number)
        assert slots == list(range(len(slots)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    for r in got:
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
        if r["doc_id"] is not None:
            data = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    again = shard_digests(docs.repartition(5), Tree(40), 41).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_slots_keep_columns(make_docs):
    docs = make_docs([(k, f"t{k}", "s", 7, 8) for k in range(60)], ", slot bigint, _order int")
    got = with_slots(shard(docs.withColumn("shard", F.lit("old")), Tree(3)))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_order", "shard", "slot"]
    for number in range(3):
        own = sorted(r["slot"] for r in got.where(F.col("shard") == number).collect())
        assert own == list(range(len(own)))


def test_empty(make_docs):
    docs = make_docs([])
    assert shard_digests(docs, Tree(4), 5).count() == 0
    assert with_slots(shard(docs, Tree(4))).count() == 0
