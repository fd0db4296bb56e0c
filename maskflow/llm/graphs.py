"""Embedding near-duplicates: small-world graphs per shard, every shard searched."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import BROADCAST_BYTES, bytes_of, stored
from maskflow.llm.components import components

COSINE = 0.93
# Distinct vectors of one graph. A task holds two graphs, about 700 bytes a vector of
# 64 numbers, and a table of found links with a byte for every pair.
SHARD_VECTORS = 8192
NEIGHBOURS = 12
BUILD_BEAM = 40
BEAM = 32
# Audits: queries of a task that are also answered by brute force, queries planted beside
# stored vectors, whose link is known, and the share of links, and of queries with all
# links, that a search must find.
AUDITS = 256
PLANTED = 64
RECALL = 0.995
FEW = 4
SALTS = 16


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, safe from overflow."""
    vectors = np.asarray(vectors, dtype=np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


class Graph:
    """Hierarchical navigable small world over unit vectors.

    ``layers[k]`` has a row of neighbours for every vector, filled up with -1;
    layer 0 has twice the places of the others. Vectors reach layer k with
    probability NEIGHBOURS**-k.
    """

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self.seen = np.zeros(len(vectors), dtype=np.int64)
        self.round = 0

    @classmethod
    def build(cls, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM, seed: int = 3) -> Graph:
        size = len(vectors)
        draw = np.random.default_rng(seed)
        tops = np.minimum((-np.log(draw.random(size) + 1e-300) / np.log(neighbours)).astype(int), 6)
        layers = [
            np.full((size, neighbours * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(tops.max() + 1)
        ]
        graph = cls(vectors, layers, 0)
        top = int(tops[0])
        for node in range(1, size):
            start = np.array([graph.entry])
            for k in range(top, int(tops[node]), -1):
                start = graph._beam(vectors[node], start, k, 1)[0][:1]
            for k in range(min(top, int(tops[node])), -1, -1):
                near, closeness = graph._beam(vectors[node], start, k, beam)
                graph._connect(node, near[:beam], closeness[:beam], k, neighbours)
                start = near[: max(1, beam // 4)]
            if tops[node] > top:
                top, graph.entry = int(tops[node]), node
        return graph

    def _beam(self, query: np.ndarray, start: np.ndarray, layer: int, beam: int,
              reach: float = 2.0) -> tuple[np.ndarray, np.ndarray]:
        """Nodes seen and their cosines, closest first, walking from ``start`` until all
        of the ``beam`` closest, and all at least ``reach`` close, have been left.

        All such nodes are left at once, so a walk is a few array operations.
        """
        self.round += 1
        links, seen, mark = self.layers[layer], self.seen, self.round
        seen[start] = mark
        nodes, closeness = start, self.vectors[start] @ query
        done = np.zeros(len(nodes), dtype=bool)
        while True:
            if len(nodes) > beam:
                least = np.partition(closeness, len(nodes) - beam)[len(nodes) - beam]
                leave = ~done & ((closeness >= least) | (closeness >= reach))
            else:
                leave = ~done
            if not leave.any():
                break
            done |= leave
            new = links[nodes[leave]].ravel()
            new = new[new >= 0]
            new = np.unique(new[seen[new] != mark])
            if not len(new):
                continue
            seen[new] = mark
            nodes = np.concatenate([nodes, new])
            closeness = np.concatenate([closeness, self.vectors[new] @ query])
            done = np.concatenate([done, np.zeros(len(new), dtype=bool)])
        order = np.argsort(-closeness, kind="stable")
        return nodes[order], closeness[order]

    def _choose(self, near: np.ndarray, closeness: np.ndarray, places: int) -> np.ndarray:
        """Neighbours, closest first: those closer to the node than to any chosen before,
        then the closest of the rest."""
        if len(near) <= places:
            return near
        between = self.vectors[near] @ self.vectors[near].T
        chosen, rest = [], []
        nearest = np.full(len(near), -2.0)
        for k in range(len(near)):
            if nearest[k] < closeness[k]:
                chosen.append(k)
                if len(chosen) == places:
                    break
                np.maximum(nearest, between[k], out=nearest)
            else:
                rest.append(k)
        return near[chosen + rest[: places - len(chosen)]]

    def _connect(self, node: int, near: np.ndarray, closeness: np.ndarray, layer: int, neighbours: int) -> None:
        links = self.layers[layer]
        places = links.shape[1]
        chosen = self._choose(near, closeness, neighbours)
        links[node, : len(chosen)] = chosen
        for other in chosen:
            row = links[other]
            free = int((row >= 0).sum())
            if free < places:
                row[free] = node
                continue
            all_ = np.append(row, np.int32(node))
            closeness = self.vectors[all_] @ self.vectors[other]
            order = np.argsort(-closeness, kind="stable")
            kept = self._choose(all_[order], closeness[order], places)
            row[: len(kept)] = kept
            row[len(kept) :] = -1

    def within(self, query: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Nodes found with a cosine of at least ``least``: descent to layer 0, then a
        walk that also leaves every node that close."""
        start = np.array([self.entry])
        for k in range(len(self.layers) - 1, 0, -1):
            start = self._beam(query, start, k, 1)[0][:1]
        nodes, closeness = self._beam(query, start, 0, beam, least)
        return nodes[: int(np.searchsorted(-closeness, -least, side="right"))]


def stranded(graph: Graph) -> np.ndarray:
    """Nodes that no walk on layer 0 from the entry reaches."""
    reached = np.zeros(len(graph.vectors), dtype=bool)
    frontier = np.array([graph.entry])
    while len(frontier):
        reached[frontier] = True
        near = graph.layers[0][frontier].ravel()
        near = np.unique(near[near >= 0])
        frontier = near[~reached[near]]
    return np.flatnonzero(~reached)


def audited(graph: Graph, queries: np.ndarray, least: float, audits: int, own: bool) -> list[tuple[np.ndarray, list]]:
    """Queries with the nodes a search must find for them, in groups that are judged apart:
    queries drawn that have at most ``FEW`` links, drawn ones with more, and planted ones.

    Drawn queries are answered by brute force; there are ``audits`` of them whatever they
    find, so that the price does not depend on how rare links are. Rare ones are stood for by
    stored vectors turned to a cosine from ``least`` up: each must find the vector it is of.
    Cosines that rounding could put below ``least`` are left out.
    """
    draw = np.random.default_rng(0)
    drawn = draw.permutation(len(queries))[:audits]
    truth = queries[drawn] @ graph.vectors.T >= least + 1e-9
    if own:
        truth[np.arange(len(drawn)), drawn] = False
    counts = truth.sum(axis=1)
    groups = [
        (queries[drawn[at]], [np.flatnonzero(truth[k]) for k in np.flatnonzero(at)])
        for at in ((counts > 0) & (counts <= FEW), counts > FEW)
    ]
    if graph.vectors.shape[1] > 1:  # numbers alone cannot be turned
        nodes = draw.permutation(len(graph.vectors))[:PLANTED]
        vectors = graph.vectors[nodes]
        aside = draw.normal(size=vectors.shape)
        aside -= (aside * vectors).sum(axis=1, keepdims=True) * vectors
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
        cosine = least + 1e-6 + (1 - least) * 0.3 * draw.random((len(nodes), 1))
        turned = cosine * vectors + np.sqrt(1 - cosine**2) * aside
        groups.append((turned, [np.array([node]) for node in nodes]))
    return groups


def search_all(graph: Graph, queries: np.ndarray, least: float, beam: int = BEAM, audits: int = AUDITS,
               recall: float = RECALL, own: bool = False) -> np.ndarray:
    """Table (queries, nodes) of verified links found in a graph; ``own`` if the queries
    are the graph's vectors, whose links with themselves are not audited.

    The beam is doubled until searches find all links of ``recall`` of the audited
    queries, and ``recall`` of their links, every group apart. As wide as the graph it
    gives way to brute force. Nodes that no walk reaches are compared with every query.
    Cosines are verified in double precision.
    """
    size = len(graph.vectors)
    loose = least - 1e-9

    def verified(query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return nodes[graph.vectors[nodes] @ query >= least]

    def passes(group: tuple[np.ndarray, list]) -> bool:
        total = np.array([len(nodes) for nodes in group[1]])
        hits = np.array([np.isin(nodes, graph.within(q, loose, beam)).sum() for q, nodes in zip(*group)])
        return (hits == total).sum() >= recall * len(total) and hits.sum() >= recall * total.sum()

    links = np.zeros((len(queries), size), dtype=bool)
    apart = stranded(graph)
    if beam < size:
        reached = np.setdiff1d(np.arange(size), apart)
        groups = [
            (own_queries, [np.intersect1d(nodes, reached) for nodes in truth])
            for own_queries, truth in audited(graph, queries, least, audits, own)
        ]
        while beam < size and not all(map(passes, groups)):
            beam *= 2
    if beam < size:
        for k, query in enumerate(queries):
            links[k, verified(query, graph.within(query, loose, beam))] = True
    else:
        apart = np.arange(size)
    for start in range(0, len(queries) if len(apart) else 0, AUDITS):
        near = queries[start : start + AUDITS] @ graph.vectors[apart].T >= loose
        for k, row in enumerate(near, start):
            links[k, verified(queries[k], apart[row])] = True
    return links


def roots_of(links: np.ndarray) -> np.ndarray:
    """Smallest index of the component of every index, given a symmetric table."""
    roots = np.full(len(links), -1)
    for first in range(len(links)):
        if roots[first] >= 0:
            continue
        roots[first] = first
        frontier = np.array([first])
        while len(frontier):
            reached = np.zeros(len(links), dtype=bool)
            for part in range(0, len(frontier), 512):
                reached |= links[frontier[part : part + 512]].any(axis=0)
            frontier = np.flatnonzero(reached & (roots < 0))
            roots[frontier] = first
    return roots


def pack(graph: Graph) -> bytes:
    """Layers of a graph as bytes: entry, number of layers, then the tables."""
    head = np.array([graph.entry, len(graph.layers), len(graph.vectors), graph.layers[-1].shape[1]], dtype=np.int64)
    return head.tobytes() + b"".join(layer.tobytes() for layer in graph.layers)


def unpack(data: bytes, vectors: np.ndarray) -> Graph:
    entry, count, size, _ = np.frombuffer(data, np.int64, 4)
    rest = np.frombuffer(data, np.int32, offset=32)
    # Layer 0 is twice as wide as each of the others.
    width = len(rest) // size // (count + 1)
    layers, at = [], 0
    for k in range(count):
        cells = size * width * (2 if k == 0 else 1)
        layers.append(rest[at : at + cells].reshape(size, -1))
        at += cells
    return Graph(vectors, layers, int(entry))


def link_shards(rows: pd.DataFrame, least: float, **search) -> pd.DataFrame:
    """Links of one shard with itself, or of two with each other, as (id, links, root):
    the number of vectors linked to, copies counted, and a class that holds
    together all classes linked here."""
    ids = [np.frombuffer(data, np.int64) for data in rows["ids"]]
    copies = [np.frombuffer(data, np.int64) for data in rows["copies"]]
    vectors = [np.frombuffer(v, np.float64).reshape(len(i), -1) for v, i in zip(rows["vectors"], ids)]
    graphs = [unpack(data, v) for data, v in zip(rows["graph"], vectors)]
    if len(rows) == 1:
        links = search_all(graphs[0], vectors[0], least, own=True, **search)
        links |= links.T
        np.fill_diagonal(links, False)
        counts, roots, all_ids = links @ copies[0], roots_of(links), ids[0]
    else:
        links = search_all(graphs[1], vectors[0], least, **search)
        links |= search_all(graphs[0], vectors[1], least, **search).T
        counts = np.concatenate([links @ copies[1], links.T @ copies[0]])
        some = [np.flatnonzero(links.any(axis=axis)) for axis in (1, 0)]
        part = links[np.ix_(*some)]
        a, b = part.shape
        both = np.zeros((a + b, a + b), dtype=bool)
        both[:a, a:] = part
        both[a:, :a] = part.T
        linked = np.concatenate([some[0], len(ids[0]) + some[1]])
        roots = np.arange(len(ids[0]) + len(ids[1]))
        roots[linked] = linked[roots_of(both)]
        all_ids = np.concatenate(ids)
    keep = np.flatnonzero(counts)
    return pd.DataFrame({"id": all_ids[keep], "links": counts[keep], "root": all_ids[roots[keep]]})


def near_vectors(vectors: DataFrame, least: float = COSINE, shard_vectors: int = SHARD_VECTORS, **search) -> DataFrame:
    """``vectors`` (vec_id, embedding, label) as (vec_id, n_links, component_id, kept).

    Vectors with equal labels that are not null are linked if their cosine is
    found and verified to be at least ``least``. Vectors that are null, empty,
    zero or hold null or non-finite numbers link with nothing; vectors of
    different lengths never link; repeated rows count as vectors of their own;
    null vec_ids are never the smallest, and such rows are not kept.

    Equal vectors of a label are one class, counted in partial aggregates. The
    classes of a label are dealt to shards of about ``shard_vectors``; every
    shard gets a graph and is searched with the vectors of every shard of its
    label. A task holds two shards, whatever the size of a label.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    limit = F.lit(float("inf"))
    usable = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.select(
        "vec_id", "embedding", "label", "usable",
        F.xxhash64("label", "embedding").alias("h1"),
        F.xxhash64(F.lit(1), "embedding", "label").alias("h2"),
    )
    classes = (
        rows.where("usable").groupBy("h1", "h2", "label")
        .agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    )
    classes = stored(classes.select("*", F.monotonically_increasing_id().alias("id")), "classes")
    cells = classes.withColumn("length", F.size("embedding"))
    # Labels of more than one shard: at most one in shard_vectors classes.
    sizes = cells.groupBy("label", "length").agg(F.count(F.lit(1)).alias("n"))
    large = stored(
        sizes.where(F.col("n") > shard_vectors).select(
            "label", "length", F.ceil(F.col("n") / shard_vectors).cast("int").alias("shards")
        ),
        "large-labels",
    )
    groups = sizes.agg(F.sum(F.ceil(F.col("n") / shard_vectors))).first()[0] or 1
    few = large if bytes_of(large) > BROADCAST_BYTES else F.broadcast(large)
    placed = cells.join(few, ["label", "length"], "left").withColumn(
        "shards", F.coalesce("shards", F.lit(1))
    )
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    key = ["label", "length", "shard", "shards"]
    kinds = {field.name: field.dataType.simpleString() for field in placed.schema}

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        units = unit(np.array(group["embedding"].tolist()))
        return group[key].head(1).assign(
            ids=group["id"].to_numpy(np.int64).tobytes(),
            copies=group["copies"].to_numpy(np.int64).tobytes(),
            vectors=units.tobytes(),
            graph=pack(Graph.build(units)),
        )

    spread = int(min(4 * groups, 20_000))
    typed = ", ".join(f"{name} {kinds[name]}" for name in key)
    graphs = stored(
        placed.select(*key, "id", "copies", "embedding").repartition(spread, *key).groupBy(*key)
        .applyInPandas(build, f"{typed}, ids binary, copies binary, vectors binary, graph binary"),
        "graphs",
    )
    pairs = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(
        "*", F.least("shard", "other").alias("one"), F.greatest("shard", "other").alias("two")
    )
    pair = ["label", "length", "one", "two"]

    def link(group: pd.DataFrame) -> pd.DataFrame:
        return link_shards(group.sort_values("shard"), least, **search)

    found = stored(
        pairs.repartition(spread, *pair).groupBy(*pair).applyInPandas(link, "id bigint, links bigint, root bigint"),
        "links",
    )
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups_of = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    answers = classes.join(counts, "id", "left").join(groups_of, "id", "left").select(
        "h1", "h2", "low",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "id").alias("group"),
    )
    lows = answers.groupBy("group").agg(F.min("low").alias("component"))
    answers = answers.join(lows, "group").select(
        "h1", "h2", "n_links", "component", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = rows.select(
        "vec_id", "usable", F.when(F.col("usable"), F.col("h1")).otherwise(F.xxhash64("vec_id")).alias("h1"),
        "h2", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    met = salted.join(answers, ["h1", "h2", "salt"], "left")
    own = F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
    return met.select(
        "vec_id",
        F.when(F.col("usable"), F.col("n_links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
