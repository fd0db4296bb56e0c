"""Merkle manifests against plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from maskflow.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([h(*level[k : k + 8]) for k in range(0, len(level), 8)])
    return levels


def plain(rows):
    groups = {}
    for row in rows:
        changed = leaf = h(*map(encoded, row))
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
            text = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            changed = h(*map(encoded, (*row[:4], text)))
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf, changed, row[0]))
    groups = {lang: sorted(leaves) for lang, leaves in groups.items()}
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels_of([leaf[1] for leaf in leaves]) for lang, leaves in groups.items()}
    top = levels_of([trees[lang][-1][0] for lang in order])
    out = []
    for rank, lang in enumerate(order):
        for place, (_, leaf, folded, doc_id) in enumerate(groups[lang]):
            proof = []
            for levels, at in ((trees[lang], place), (top, rank)):
                for level in levels[:-1]:
                    run, own = level[at // 8 * 8 :][:8], at % 8
                    proof += run[:own] + run[own + 1 :]
                    folded = h(*run[:own], folded, *run[own + 1 :])
                    at //= 8
            out.append((doc_id, leaf, trees[lang][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, manifest.verify_documents(docs).collect()), key=str)
    assert got == plain(rows)
    return got


def rows_of(sizes, first=0):
    rows, doc_id = [], first
    for lang, size in sizes.items():
        for _ in range(size):
            rows.append((doc_id, f"s{doc_id % 3}", lang, doc_id * 7, f"Text {doc_id} Of {lang}"))
            doc_id += 1
    random.Random(1).shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"en": 1}, {"en": 2, None: 1}, {"en": 8}, {"en": 9, "de": 64, "fr": 65},
        {f"l{k}": 1 + k % 3 for k in range(20)} | {None: 70, "": 3},
        {f"l{k}": 1 for k in range(70)},
    ],
)
def test_trees_of_all_shapes(spark, sizes):
    got = check(spark, rows_of(sizes))
    changed = [r for r in got if zlib.crc32(str(r[0]).encode()) % 3 == 0]
    assert [r for r in got if not r[-1]] == changed


def test_blocks_and_shuffled_joins(spark, monkeypatch):
    """Trees taller than a block, with few leaves a block, and without any broadcast."""
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(manifest, "BLOCK_RUNS", 8)
    rows = rows_of({"en": 1200, "de": 600, None: 65, "x": 1} | {f"l{k}": 2 for k in range(8)}, first=-50)
    check(spark, rows)
    monkeypatch.setattr(manifest, "joined_small", lambda rows, small, key: salted(rows, small, key, -1))
    monkeypatch.setattr(manifest, "BROADCAST_BYTES", -1)
    check(spark, rows)


salted = manifest.joined_small


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""), (1, "", "", 0, ""),
        (2, "-", "-", -5, "-"), (3, "1:a", "en", 10**18, "É:" * 200_000), (-4, "s", "en", 1, "A" * 300_000),
        (5, "s", "é", 1, "same id"), (5, "s", "é", 1, "Other text"), (6, "s", "é", None, None),
    ]
    check(spark, rows)
    check(spark, rows * 30)


def test_an_empty_table_and_other_columns(spark):
    empty = manifest.verify_documents(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = rows_of({"en": 20, "de": 3})
    docs = spark.createDataFrame(rows, SCHEMA)
    odd = docs.select("*", F.lit(1).alias("tree"), F.lit(2).alias("place"), F.lit("x").alias("leaf"), F.create_map(F.lit(1), F.lit(2)).alias("group"))
    assert sorted(map(tuple, manifest.verify_documents(odd).collect()), key=str) == plain(rows)


def test_any_change_is_seen(spark):
    """A manifest tells rows apart whose columns only together are alike."""
    for a, b in (((1, "ab", "c", 1, "t"), (1, "a", "bc", 1, "t")), ((1, None, "c", 1, "t"), (1, "-", "c", 1, "t"))):
        roots = {r["root"] for row in (a, b) for r in manifest.verify_documents(spark.createDataFrame([row], SCHEMA)).collect()}
        assert len(roots) == 2


def test_row_limit_is_put_back(spark):
    spark.conf.set(manifest.ROW_LIMIT, "10")
    try:
        check(spark, rows_of({"en": 300}))
        assert spark.conf.get(manifest.ROW_LIMIT) == "10"
    finally:
        spark.conf.unset(manifest.ROW_LIMIT)



@pytest.mark.parametrize("size, height", [(1, 0), (2, 1), (8, 1), (9, 2), (64, 2), (65, 3), (8**12, 12), (8**12 + 1, 13)])
def test_height_of_size(spark, size, height):
    assert spark.range(1).select(manifest.heights(F.lit(size))).first()[0] == height
