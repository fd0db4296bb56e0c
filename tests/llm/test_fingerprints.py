"""SimHash fingerprints and BK-trees, against plain Python."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from maskflow.llm import fingerprints as fp


def plain_print(text, shingle=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [words] if len(words) < shingle else [words[k : k + shingle] for k in range(len(words) - shingle + 1)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [None, "", " \t\n", "One", "one two", "One Two\tThree four", "É é Ä\x85 x y z", "a a a a a a", "x " * 5000]


@pytest.mark.parametrize("text", TEXTS)
def test_print(text):
    assert fp.fingerprint(text) == plain_print(text)


def test_print_is_that_of_the_jvm_hash(spark):
    df = spark.createDataFrame([("one two three",), ("é",)], "t string")
    for r in df.select("t", F.xxhash64("t").alias("h")).collect():
        assert fp.fingerprint(r["t"]) == r["h"] % (1 << 64)


def test_tree_finds_all_within():
    draw = random.Random(3)
    values = [draw.getrandbits(64) for _ in range(300)]
    values += [v ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for v in values[:150]]
    tree = fp.Tree()
    for v in values + values[:20]:
        tree.add(v)
    assert sorted(tree.values) == sorted(set(values))
    for v in values[:60] + [0]:
        for radius in (0, 1, 3, 20):
            want = sorted({x for x in values if (x ^ v).bit_count() <= radius})
            assert sorted(tree.within(v, radius)) == want


def groups(prints, radius=3):
    """Component of every fingerprint, by comparing all with all."""
    values = sorted(set(prints))
    low = {v: v for v in values}

    def root(v):
        while low[v] != v:
            v = low[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius and root(a) != root(b):
                low[root(a)] = root(b)
    return {v: root(v) for v in values}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("tree_size", [4096, 4])
def test_components(spark, tree_size, monkeypatch):
    monkeypatch.setattr(fp.near_links, "__defaults__", (fp.RADIUS, tree_size))
    draw = random.Random(8)
    values = [draw.getrandbits(64) for _ in range(200)] + [0, 0, 0, (1 << 64) - 1]
    for _ in range(400):  # chains of near fingerprints
        v = draw.choice(values)
        for _ in range(draw.randrange(0, 6)):
            v ^= 1 << draw.randrange(64)
        values.append(v)
    rows = [(k, signed(v)) for k, v in enumerate(values)] + [(None, signed(values[5])), (5, signed(values[5]))]
    draw.shuffle(rows)
    prints = spark.createDataFrame(rows, "doc_id bigint, fp bigint")
    got = fp.with_components(prints).collect()
    assert len(got) == len(rows)
    group = groups(values)
    low = {}
    for k, v in enumerate(values):
        low[group[v]] = min(low.get(group[v], k), k)
    for r in got:
        assert r["component_id"] == low[group[r["fp"] % (1 << 64)]]


def test_more_blocks_for_more_fingerprints():
    assert fp.blocks_needed(10) == 4 and fp.blocks_needed(10**8) == 5


@pytest.mark.parametrize("blocks,keys", [(4, 4), (5, 10), (6, 20)])
def test_keys(spark, blocks, keys):
    draw = random.Random(blocks)
    rows = []
    for _ in range(50):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), 3):
            b ^= 1 << bit
        rows.append((signed(a), signed(b)))
    columns = fp.key_columns(blocks)
    assert len(columns) == keys
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    a = df.select(F.col("a").alias("fp")).select(*columns).collect()
    b = df.select(F.col("b").alias("fp")).select(*columns).collect()
    assert all(any(x == y for x, y in zip(p, q)) for p, q in zip(a, b))


def test_one_of_each(make_docs):
    text = "so many words stand in this one text that a small change of it moves few bits " * 20
    rows = [(7, text, "s"), (3, text, "t"), (9, text + "more", "s"), (4, "quite another text", "s")]
    rows += [(None, None, "s"), (12, "", "s"), (11, " ", "s"), (None, "a lonely text without id", "u")]
    rows += [(4, "quite another text", "s")] * 3
    docs = make_docs([(*r, 1) for r in rows], ", fp int")
    kept = fp.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [
        (-1, "a lonely text without id"), (3, text), (4, "quite another text"), (11, " "),
    ]
    assert fp.one_of_each(make_docs([])).count() == 0
