"""Decontamination: search against brute-force BM25, leaks against plain containment."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from maskflow.llm import contamination as c
from maskflow.llm.queries import QUERIES

VOCABULARY = [f"w{k}" for k in range(60)] + ["the", "of", "and"] * 3


def sentence(draw, n):
    return " ".join(draw.choice(VOCABULARY) for _ in range(n))


def test_search_finds_what_brute_force_finds():
    draw = random.Random(6)
    items = [c.Item.of(str(k), sentence(draw, draw.randrange(4, 90))) for k in range(120)]
    index = c.Index(items)
    assert len(index.owners) > len(items)  # long items have several pieces
    blocks = index.bounds.shape[1]
    for _ in range(40):
        terms = sorted({index.vocabulary[w] for w in sentence(draw, 50).split() if w in index.vocabulary})
        for least in (0.2, 0.5, 0.8):
            want = {}
            for block in range(blocks):
                for term in terms:
                    for place, impact in index.postings.get((term, block), ()):
                        want[place] = want.get(place, 0.0) + impact
            want = {p: s for p, s in want.items() if s >= least}
            got = {p: s for b in range(blocks) for p, s in index.search(terms, b, least)}
            assert got.keys() == want.keys()
            assert all(math.isclose(got[p], want[p]) for p in got)


def test_bounds_hold_and_own_scores_are_one():
    draw = random.Random(7)
    index = c.Index([c.Item.of(str(k), sentence(draw, 30)) for k in range(40)])
    own = Counter()
    for (term, block), postings in index.postings.items():
        assert max(i for _, i in postings) <= index.bounds[term, block]
        own.update(dict(postings))
    assert all(math.isclose(s, 1.0) for s in own.values())


def plain(text, item):
    """Whether a whole text holds question and answer of an item, or an item of prose as one."""
    words = c.words_of(text)

    def holds(part):
        grams = c.grams_of(part)
        size = len(next(iter(grams))) if grams else 0
        present = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        return not grams or len(grams & present) / len(grams) >= c.OVERLAP

    apart = holds(item.question) and holds(item.answer)
    return bool(item.question) and (apart or (item.prose and holds(item.question + item.answer)))


@pytest.mark.parametrize("index_bytes", [1 << 20, 600])
def test_leaks(spark, make_docs, index_bytes, monkeypatch):
    monkeypatch.setattr(c.build_indexes, "__defaults__", (index_bytes,))
    draw = random.Random(8)
    texts = [sentence(draw, draw.randrange(6, 50)) + "\n" + sentence(draw, draw.randrange(1, 9)) for _ in range(20)]
    texts += [sentence(draw, 20), "one two", "", None, "!!", sentence(draw, 150) + "\nlast line of it here", texts[0]]
    items = [(k, t) for k, t in enumerate(texts)]
    rows = [(None, None, "s"), (1, "", "s")]
    for k in range(120):
        text = sentence(draw, draw.randrange(0, 300))
        if k % 3:
            item = draw.choice([t for t in texts if t])
            part = item if k % 2 else item.partition("\n")[0]  # half of them lack the answer
            if k % 5 == 0:
                part = part.upper().replace(" ", ",  ")
            text = text + " " + part + " " + sentence(draw, draw.randrange(0, 300))
        rows.append((k + 10, text, "s"))
    rows.append((999, sentence(draw, 40_000) + " " + texts[3] + " " + sentence(draw, 500), "s"))
    rows.append(rows[5])
    docs = make_docs([(*r, 3) for r in rows], ", item_id int").withColumn("score", F.lit(1))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in c.find_leaks(docs, benchmark).collect())
    parsed = [(k, c.Item.of(str(k), t)) for k, t in items]
    want = sorted((d, k) for d, text, _ in rows for k, item in parsed if plain(text, item))
    assert got == want and (999, 3) in got
    clean = c.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == sum(1 for d, text, _ in rows if not any(plain(text, i) for _, i in parsed))


def test_one_word_edits_in_a_short_last_line(spark, make_docs):
    draw = random.Random(9)
    first, last = sentence(draw, 30) + ".", "Ann saw the red boat."
    around = sentence(draw, 100), sentence(draw, 100)
    items = [(1, f"{first}\n{last}"), (2, f"{first[:-1]}?\n{last}"), (3, f"{first}\n{last[:-1]}")]
    rows, words = [], last.split()
    for k in range(len(words)):
        near = words[:k] + ["other"] + words[k + 1 :]
        rows.append((k, " ".join([around[0], first, *near, around[1]]), "s"))
    rows.append((10, " ".join([around[0], first, last, around[1]]), "s"))
    rows.append((11, " ".join([around[0], *first.split()[:20], around[1]]), "s"))
    docs = make_docs(rows)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in c.find_leaks(docs, benchmark).collect())
    # Prose is one passage; questions that lack their answer are no leaks.
    assert got == [(k, 1) for k in range(len(words))] + [(10, 1), (10, 2), (10, 3)]
    left = c.without_leaks(docs, benchmark.where("item_id = 1")).collect()
    assert [r["doc_id"] for r in left] == [11]


def test_empty(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs([(1, "some text", "s")])
    assert c.find_leaks(docs, none).count() == 0 and c.without_leaks(docs, none).count() == 1
    some = spark.createDataFrame([(1, "some text")], "item_id bigint, text string")
    assert c.find_leaks(make_docs([]), some).count() == 0
    assert c.find_leaks(docs, some).count() == 1


def test_query_against_plain_containment(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    parsed = [(r["item_id"], c.Item.of(str(r["item_id"]), r["text"])) for r in items]
    want = sorted((d["doc_id"], k) for d in docs for k, item in parsed if plain(d["text"], item))
    got = QUERIES["op5_decontamination"](spark, folder).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == want


def test_windows_hold_every_passage():
    draw = random.Random(10)
    for n in (0, 1, 63, 64, 65, 300, 1000):
        words = sentence(draw, n).split()
        for size in (128, 256):
            windows = list(c.windows_of(" ".join(words), size))
            joined = windows[0] if windows else []
            for window in windows[1:]:
                assert len(window) > c.PIECE and window[: c.PIECE] == joined[-c.PIECE :]
                joined = joined + window[c.PIECE :]
            assert joined == words and all(len(window) <= size for window in windows)


def test_windows_change_nothing(monkeypatch):
    draw = random.Random(11)
    items = [c.Item.of(str(k), sentence(draw, draw.randrange(5, 200))) for k in range(30)]
    index = c.Index(items)
    for k in range(20):
        parts = [sentence(draw, draw.randrange(0, 400)), " ".join(items[k].question), sentence(draw, 300)]
        text = " ".join(parts)
        monkeypatch.setattr(c.windows_of, "__defaults__", (1 << 30,))
        whole = index.matches(text)
        monkeypatch.setattr(c.windows_of, "__defaults__", (2 * c.PIECE,))
        assert index.matches(text) == whole and str(k) in {m["item_id"] for m in whole}


def test_long_texts_take_bounded_memory():
    """A million words against a full index: beside the text at most 64 MB."""
    import tracemalloc

    draw = random.Random(12)
    words = [f"w{k}" for k in range(3000)]
    items = [c.Item.of(str(k), " ".join(draw.choices(words, k=45))) for k in range(1000)]
    index = c.Index(items)
    text = " ".join(draw.choices(words, k=500_000) + items[7].question + draw.choices(words, k=500_000))
    tracemalloc.start()
    found = index.matches(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [m["item_id"] for m in found] == ["7"] and peak < 64 << 20


def test_indexes_are_files(spark):
    """The driver holds names; an index read back searches as it did."""
    draw = random.Random(13)
    rows = [(k, sentence(draw, 40)) for k in range(200)] + [(None, sentence(draw, 40)), (5, None), (6, "?!")]
    paths = c.build_indexes(spark.createDataFrame(rows, "item_id bigint, text string"), 4000)
    assert len(paths) >= 8 and all(isinstance(path, str) for path in paths)
    index = c.Index([c.Item.of(str(k), text) for k, text in rows if text])
    again = c.Index.unpacked(index.packed())
    text = rows[3][1] + " " + sentence(draw, 100)
    assert again.matches(text) == index.matches(text) != []
