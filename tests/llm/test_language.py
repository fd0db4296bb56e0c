"""Language identification: n-grams against plain counting, clusters, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import language
from maskflow.llm.queries import QUERIES

WORDS = {
    "en": "the and of that with from this have which there would about".split(),
    "de": "und der die nicht eine auch sich über können für zwischen".split(),
    "fr": "les des une dans pour qui être avec élève où français".split(),
}


def text(lang, k, n=40):
    words = WORDS[lang]
    return " ".join(words[(k * 7 + j * j) % len(words)] for j in range(n))


def plain_counts(text):
    letters = " " + " ".join(language.WORD.findall(text.lower())) + " "
    mask = (1 << 64) - 1
    mix = [int(m) for m in language.MIX]
    counts = np.zeros(language.BUCKETS, dtype=int)
    for n in (1, 2, 3):
        for k in range(len(letters) - n + 1):
            mixed = n * mix[3] + sum(ord(letters[k + j]) * mix[j] for j in range(n)) & mask
            mixed ^= mixed >> 29
            counts[(mixed * mix[1] & mask) >> 52] += 1
    return counts


@pytest.mark.parametrize("text", ["a", "It is, Été 99!", "naïve\n\tÜber", "x" * 50])
def test_counts(text, monkeypatch):
    assert (language.ngram_counts(text) == plain_counts(text)).all()
    monkeypatch.setattr(language, "PIECE", 5)
    assert (language.ngram_counts(text) == plain_counts(text)).all()


@pytest.mark.parametrize("text", [None, "", "12 34 !?", " \n", "_"])
def test_no_letters(text):
    assert language.ngram_counts(text) is None


def test_clusters_part_what_is_apart():
    draw = np.random.default_rng(3)
    axes = np.eye(6)[[0, 2, 4]]
    vectors = np.concatenate([a + draw.normal(0, 0.02, (30, 6)) for a in axes])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centroids, radii = language.cluster(vectors, 3)
    assert (centroids @ axes.T).max(axis=0).min() > 0.99 and (radii < 0.2).all()
    same, _ = language.cluster(np.tile(vectors[:1], (5, 1)), 4)
    assert len(same) == 1


def test_wrong_labels_get_no_centroid():
    draw = np.random.default_rng(4)
    own = np.eye(6)[0] + draw.normal(0, 0.05, (97, 6))
    wrong = np.eye(6)[3] + draw.normal(0, 0.05, (3, 6))
    vectors = np.concatenate([own, wrong])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    centroids, _ = language.cluster(vectors, 3)
    assert len(centroids) and (centroids[:, 0] > 0.9).all()


def test_small_clusters_go_only_if_nearer_to_another_language(spark, make_docs):
    words = "это которая после только можно время человек потому сейчас через".split()
    second = [" ".join(words[(k * 3 + j * j) % len(words)] for j in range(40 + k)) for k in range(8)]
    rows = [(text("en", k, 40 + k), "en") for k in range(200)] + [(text("de", k, 40 + k), "de") for k in range(200)]
    rows += [(t, "en") for t in second[:4]] + [(text("fr", k, 40 + k), "fr") for k in range(200)]
    rows += [(text("fr", k, 300 + k), "de") for k in range(4)]  # wrongly labelled
    model = language.train(spark.createDataFrame(rows, "text string, lang string"))
    found = model.identify(second[4:] + [text("fr", k, 305 + k) for k in range(4)])
    assert list(found["lang"]) == ["en"] * 4 + ["fr"] * 4 and not found["rejected"].any()


@pytest.fixture(scope="module")
def model(spark):
    rows = [(text(lang, k), lang) for lang in WORDS for k in range(60)]
    rows += [(None, "en"), ("some text", None), ("", "xx")] + rows[:1] * 40
    return language.train(spark.createDataFrame(rows, "text string, lang string"), sample=30, clusters=2)


def test_identify(make_docs, model):
    assert sorted(set(model.languages)) == sorted(WORDS)
    rows = [(k, text(lang, 100 + k), lang) for lang in WORDS for k in range(10)]
    special = [(900, None, "s"), (901, "1 2 3", "s"), (902, "", None), (903, text("de", 3, 60_000), "de"),
               (904, "ΑΒΓΔ ЖЗИЙ зигзаг", "s"), (None, text("fr", 1), "fr")]
    docs = make_docs([(*r, 1, 2) for r in rows + special + special], ", language int, found int")
    got = language.identify(docs, model)
    assert got.columns == [c for c in docs.columns if c != "language"] + ["language"]
    for r in got.collect():
        found = r["language"]
        if r["doc_id"] in (900, 901, 902):
            assert found.asDict() == {"lang": "und", "nearest": "und", "score": 0.0, "rejected": True}
        elif r["doc_id"] == 904:
            assert found["lang"] == "und" and found["nearest"] in WORDS and found["rejected"]
        else:
            assert found["lang"] == found["nearest"] == r["source"] and 0 < found["score"] <= 1


def test_nothing_learnt(spark, make_docs):
    empty = language.train(spark.createDataFrame([], "text string, lang string"))
    docs = make_docs([(1, "some words", "s")])
    assert [r["language"]["lang"] for r in language.identify(docs, empty).collect()] == ["und"]
    assert language.identify(make_docs([]), empty).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op1_language_id"](spark, folder).join(truth, "doc_id")
    own = rows.where("held_out and lang is not null")
    assert rows.count() == truth.count()
    assert own.where(F.col("lang") == F.col("lang_pred")).count() >= 0.98 * own.count()


def test_query_against_plain_cosines(spark, folder):
    """Every answer of the query, by counting n-grams one by one and comparing with all
    centroids of the model learnt from the documents that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.train(docs.where(~language.held_out("doc_id")))
    whole = 1 << 64

    def bucket(gram):
        mixed = (len(gram) * int(language.MIX[3]) + sum(ord(c) * int(m) for c, m in zip(gram, language.MIX))) % whole
        return ((mixed ^ mixed >> 29) * int(language.MIX[1]) % whole) >> 52

    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, folder).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for doc_id, text in rows:
        words = re.findall(r"[^\W\d_]+", (text or "").lower())
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        if not words:
            assert got[doc_id]["lang_pred"] == "und" and got[doc_id]["score"] == 0
            continue
        letters = f" {' '.join(words)} "
        counts = Counter(bucket(letters[k : k + n]) for n in (1, 2, 3) for k in range(len(letters) - n + 1))
        vector = {b: c * float(model.idf[b]) for b, c in counts.items()}
        length = math.sqrt(sum(x * x for x in vector.values()))
        closeness = [sum(x * float(centroid[b]) for b, x in vector.items()) / length for centroid in model.vectors]
        best = max(range(len(closeness)), key=closeness.__getitem__)
        assert got[doc_id]["score"] == pytest.approx(min(1.0, max(0.0, closeness[best])), abs=1e-4)
        near = {model.languages[k] for k, c in enumerate(closeness) if c > closeness[best] - 1e-4}
        assert got[doc_id]["lang_pred"] in near


def test_languages_are_bounded(spark):
    rows = [(f"w{k} some words of text {k}", f"l{k % 7}") for k in range(70)] + [("more words here", "l3")] * 2
    model = language.train(spark.createDataFrame(rows, "text string, lang string"), languages=3)
    assert len(set(model.languages)) <= 3
