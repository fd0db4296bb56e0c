"""Small-world graphs, against all cosines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import graphs

VECTORS = "vec_id bigint, embedding array<float>, label int"


def clustered(draw, n, size=16, groups=12, noise=0.25):
    centres = draw.normal(0, 1, (groups, size))
    return centres[draw.integers(0, groups, n)] + draw.normal(0, noise, (n, size))


def expected(rows, least=graphs.COSINE):
    """{row: (n_links, component_id, kept)} by comparing all with all."""
    usable = []
    for k, (_, vector, label) in enumerate(rows):
        good = vector and None not in vector and np.isfinite(vector).all() and np.any(vector)
        if good and label is not None:
            usable.append(k)
    links = {k: set() for k in usable}
    for i, a in enumerate(usable):
        for b in usable[:i]:
            (_, x, k), (_, y, m) = rows[a], rows[b]
            if k == m and len(x) == len(y):
                x, y = np.array(x, np.float32).astype(float), np.array(y, np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a].add(b)
                    links[b].add(a)
    found = {}
    for k, (vec_id, _, _) in enumerate(rows):
        reached, open_ = {k}, [k]
        while open_:
            for other in links.get(open_.pop(), ()):
                if other not in reached:
                    reached.add(other)
                    open_.append(other)
        ids = [rows[j][0] for j in reached if rows[j][0] is not None]
        low = min(ids, default=None)
        found[k] = (vec_id, len(links.get(k, ())), low, vec_id is not None and vec_id == low)
    return sorted(map(str, found.values()))


def test_graph_recall_and_beams():
    draw = np.random.default_rng(5)
    vectors = graphs.unit(clustered(draw, 1500))
    graph = graphs.Graph.build(vectors)
    truth = vectors @ vectors.T >= 0.9
    found = graphs.search_all(graph, vectors, 0.9)
    assert not (found & ~truth).any()
    assert found.sum() / truth.sum() >= 0.99
    narrow = graphs.search_all(graph, vectors, 0.9, beam=1, audits=1500, recall=1.0)
    assert (narrow == truth).all()  # beams are widened until the audit passes


def hide(graph, nodes):
    """No walk reaches ``nodes`` any more."""
    for layer in graph.layers:
        layer[np.isin(layer, nodes)] = -1


def test_audits_see_rare_links_beside_a_dense_group():
    draw = np.random.default_rng(11)
    dense = draw.normal(0, 1, 32) + draw.normal(0, 0.02, (900, 32))
    pairs = np.repeat(draw.normal(0, 1, (20, 32)), 2, axis=0) + draw.normal(0, 0.02, (40, 32))
    vectors = graphs.unit(np.concatenate([dense, pairs]))
    graph = graphs.Graph.build(vectors)
    hide(graph, np.arange(900, 940))
    graph.entry = 0
    truth = vectors @ vectors.T >= 0.93
    assert (graphs.search_all(graph, vectors, 0.93, own=True) | np.eye(940, dtype=bool) == truth).all()


@pytest.mark.parametrize("linked", [1, 700, 1499])
def test_audits_see_the_only_link(linked):
    draw = np.random.default_rng(12)
    vectors, queries = graphs.unit(draw.normal(0, 1, (300, 32))), graphs.unit(draw.normal(0, 1, (1500, 32)))
    graph = graphs.Graph.build(vectors)
    node = (graph.entry + 1) % 300
    hide(graph, [node])
    queries[linked] = vectors[node]
    assert np.argwhere(graphs.search_all(graph, queries, 0.93)).tolist() == [[linked, node]]


def test_audits_cost_the_same_however_rare_links_are():
    """Without a single link as many queries are drawn and planted as with many."""
    draw = np.random.default_rng(13)
    for vectors in (graphs.unit(draw.normal(0, 1, (2000, 32))), graphs.unit(clustered(draw, 2000))):
        graph = graphs.Graph.build(vectors)
        few, many, planted = graphs.audited(graph, vectors, 0.93, 100, own=True)
        assert len(few[0]) + len(many[0]) <= 100 and len(planted[0]) == graphs.PLANTED
        cosines = [vectors[node] @ query for query, (node,) in zip(*planted)]
        assert min(cosines) >= 0.93 and max(cosines) < 0.96


def test_planted_links_widen_the_beam():
    """Nodes that only a wide beam finds make it wider, though no drawn query has a link."""
    draw = np.random.default_rng(14)
    vectors = graphs.unit(draw.normal(0, 1, (1500, 24)))
    graph = graphs.Graph.build(vectors, neighbours=2, beam=3)
    queries = graphs.unit(0.94 * vectors[:300] + 0.34 * graphs.unit(draw.normal(0, 1, (300, 24))))
    truth = queries @ vectors.T >= 0.9
    assert graphs.search_all(graph, queries, 0.9).sum() >= 0.99 * truth.sum() > 200


def test_packed_graphs_are_the_same():
    vectors = graphs.unit(clustered(np.random.default_rng(6), 300))
    graph = graphs.Graph.build(vectors)
    again = graphs.unpack(graphs.pack(graph), vectors)
    assert again.entry == graph.entry and len(again.layers) == len(graph.layers)
    assert all((a == b).all() for a, b in zip(again.layers, graph.layers))


def test_one_and_two_vectors():
    for n in (1, 2, 3):
        vectors = graphs.unit(np.eye(4)[:n] + 0.01)
        assert len(graphs.Graph.build(vectors).within(vectors[0], 0.99, 4)) == 1


def test_roots():
    draw = np.random.default_rng(7)
    links = draw.random((60, 60)) < 0.015
    links |= links.T
    roots = graphs.roots_of(links)
    reach = np.linalg.matrix_power((links | np.eye(60, dtype=bool)).astype(float), 60) > 0
    assert (roots == reach.argmax(axis=1)).all()


@pytest.mark.parametrize("shard_vectors", [8192, 40])
def test_near_vectors(spark, shard_vectors):
    draw = np.random.default_rng(8)
    rows = [(k, v.tolist(), int(draw.integers(0, 3))) for k, v in enumerate(clustered(draw, 260, noise=0.15))]
    rows += [(1000 + k, rows[4][1], rows[4][2]) for k in range(50)]  # copies
    rows += [(1100 + k, rows[4][1], 7) for k in range(3)] + [(1200, rows[4][1], None), (1201, rows[4][1], None)]
    rows += [(1300, None, 1), (1301, [], 1), (1302, [0.0] * 16, 1), (1303, [0.0] * 16, 1), (1304, [None] + [1.0] * 15, 1),
             (1305, [float("nan")] + [1.0] * 15, 1), (1306, [float("inf")] + [1.0] * 15, 1), (1307, [1.0] * 5, 1),
             (1308, [1.0] * 5, 1), (1309, [1e-40] * 16, 2), (1310, [3e38] * 16, 2), (1311, [-0.0] + [1.0] * 15, 1),
             (1312, [0.0] + [1.0] * 15, 1)]
    rows += [(None, rows[9][1], rows[9][2]), (7, rows[9][1], rows[9][2]), (7, rows[7][1], rows[7][2])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS + ", id int, links int")
    got = graphs.near_vectors(df.withColumn("shard", F.lit(3)), shard_vectors=shard_vectors)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(rows)


def test_empty(spark):
    assert graphs.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    only = spark.createDataFrame([(1, None, 1)], VECTORS)
    assert [tuple(r) for r in graphs.near_vectors(only).collect()] == [(1, 0, 1, True)]
