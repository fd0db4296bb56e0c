"""Mixing, against targets worked out by resharing and against subset sums by trial."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import mixing


def targets(sizes, weights=mixing.WEIGHTS, epochs=mixing.EPOCHS, most=mixing.MOST):
    """Share, stop at the most, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    got, open_ = dict.fromkeys(names, 0.0), set(names)
    left = epochs * sum(sizes.values())
    while left > 1e-9 and open_:
        total = sum(weight[n] for n in open_)
        over = 0.0
        for name in list(open_):
            got[name] += left * weight[name] / total
            if got[name] >= most * sizes[name]:
                over += got[name] - most * sizes[name]
                got[name] = most * sizes[name]
                open_.discard(name)
        left = over
    return got


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 900, "c": 10, None: 50}, {"a": 5}, {"a": 0, "b": 10}, {"a": 7, "b": 7, "c": 7, "d": 7},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets(sizes))


def test_fit_finds_the_nearest_sum():
    draw = np.random.default_rng(4)
    for _ in range(60):
        sizes = np.sort(draw.choice(np.arange(1, 40), 4, replace=False))
        counts = draw.integers(1, 4, 4)
        budget = int(draw.integers(0, (sizes * counts).sum() + 1))
        taken = mixing.fit_counts(sizes, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all()
        sums = [int(np.dot(n, sizes)) for n in product(*(range(c + 1) for c in counts))]
        assert abs(int(taken @ sizes) - budget) == min(abs(s - budget) for s in sums)


def test_fit_is_exact_with_many_sizes():
    draw = np.random.default_rng(5)
    sizes = np.unique(draw.integers(1, 3000, 800))
    counts = draw.integers(1, 30, len(sizes))
    for share in (0.01, 0.4, 0.77, 0.999):
        budget = int((sizes * counts).sum() * share)
        assert int(mixing.fit_counts(sizes, counts, budget) @ sizes) == budget


@pytest.mark.parametrize("seed", range(3))
def test_fit_is_exact_with_large_sparse_sizes(seed):
    """Thousands of even sizes up to ten million, a text each, and an odd budget: a table of
    all sums would take gigabytes, and the nearest sum misses by one."""
    draw = np.random.default_rng(seed)
    sizes = np.unique(draw.integers(1, 5_000_000, 4000) * 2)
    for share in (0.3, 0.5, 0.9):
        budget = int(sizes.sum() * share) | 1
        taken = mixing.fit_counts(sizes, np.ones(len(sizes), dtype=int), budget)
        assert set(taken) <= {0, 1} and abs(int(taken @ sizes) - budget) == 1


def test_fit_with_gaps():
    """Sums that lie far apart: no pool of few sizes says that a nearer one is missing."""
    draw = np.random.default_rng(1)
    for _ in range(40):
        sizes = np.unique(np.append(draw.choice(np.arange(2, 9), 3) * 100, draw.choice([601, 1, 977])))
        counts = draw.integers(1, 4, len(sizes))
        budget = int(draw.integers(1, (sizes * counts).sum() + 1))
        taken = mixing.fit_counts(sizes, counts, budget)
        assert (0 <= taken).all() and (taken <= counts).all()
        sums = [int(np.dot(n, sizes)) for n in product(*(range(c + 1) for c in counts))]
        assert abs(int(taken @ sizes) - budget) == min(abs(s - budget) for s in sums)


def test_columns_of_any_kind(spark, make_docs):
    docs = make_docs(docs_rows()).withColumn("bag", F.create_map(F.lit(1), F.col("doc_id")))
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.mix(docs).count() == mixing.mix(docs.drop("bag")).count()


def docs_rows():
    words = ["w " * n for n in range(1, 60)]
    rows = [(k, words[k % 59], f"s{k % 4}") for k in range(400)]
    rows += [(k, "same words here", "s0") for k in range(400, 700)]
    return rows + [(700, None, "s1"), (701, "", None), (702, "a b c", None), (None, "x y", "s2")]


def test_mix(spark, make_docs):
    docs = make_docs(docs_rows())
    rows = mixing.mix_digests(docs).collect()
    assert len(rows) == 704
    for source_size in {r["source_size"] for r in rows}:
        own = [r for r in rows if r["source_size"] == source_size]
        assert sum(r["size"] for r in own) == source_size
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 1
    assert all(r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 2 * r["size"] for r in rows)
    again = mixing.mix_digests(docs.repartition(7).sortWithinPartitions("text")).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    times = {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["size"]}
    mixed = mixing.mix(docs).groupBy("doc_id").count().collect()
    for r in mixed:
        if r["doc_id"] in times:
            assert r["count"] == times[r["doc_id"]]


def test_repeated_rows_and_clashing_names(spark, make_docs):
    rows = [(1, "a b c", "s", 9) for _ in range(60)] + [(2, "d e", "t", 9) for _ in range(90)]
    docs = make_docs(rows, ", _size bigint").withColumn("size", F.lit(3)).withColumn("draw", F.lit(4))
    digests = mixing.mix_digests(docs).collect()
    for source, size in (("s", 180), ("t", 180)):
        own = [r for r in digests if r["doc_id"] == (1 if source == "s" else 2)]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["taken"] // r["size"] for r in digests)


def test_shuffled_join(spark, make_docs, monkeypatch):
    docs = make_docs(docs_rows())
    want = sorted(map(str, mixing.mix_digests(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert sorted(map(str, mixing.mix_digests(docs).collect())) == want


def test_empty(make_docs):
    docs = make_docs([])
    assert mixing.mix_digests(docs).count() == mixing.mix(docs).count() == 0
