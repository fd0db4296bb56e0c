"""Quality classifier: statistics, discriminant against a plain formula, held-out accuracy."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import quality
from maskflow.llm.queries import QUERIES

TEXTS = [None, "", " \n\t", "a", "é" * 10, "word " * 200_000, "#$% ||| !!!", "\x00\x01", "one\n\n\ntwo", "1234"]


@pytest.mark.parametrize("text", TEXTS)
def test_features_are_finite(text):
    got = quality.text_features(text)
    assert len(got) == len(quality.FEATURES) and all(map(math.isfinite, got))


def moments(rows):
    return len(rows), rows.sum(axis=0), rows.T @ rows


def test_scores_are_density_ratios():
    draw = np.random.default_rng(2)
    size = len(quality.FEATURES)
    data = {k: draw.normal(k, 1 + k, (400, size)) @ draw.normal(0, 1, (size, size)) for k in (0, 1)}
    model = quality.fit_discriminant({k: moments(v) for k, v in data.items()}, shrinkage=0.0, ridge=1e-6)
    x = np.concatenate([data[0][:20], data[1][:20]])
    logs = []
    for k in (0, 1):
        lower = np.linalg.inv(model.factors[k])
        covariance = lower @ lower.T
        off = x - data[k].mean(axis=0)
        assert np.allclose(model.means[k], data[k].mean(axis=0))
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off)
                    - 0.5 * np.linalg.slogdet(covariance)[1] + math.log(401 / 802))
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


def test_covariances_are_shrunk():
    size = len(quality.FEATURES)
    one = np.ones((1, size))
    model = quality.fit_discriminant({0: moments(one), 1: moments(2 * one)})
    assert np.isfinite(model.scores(np.zeros((3, size)))).all()
    assert quality.fit_discriminant({}).scores(np.zeros((2, size))) == pytest.approx([0.5, 0.5])
    only = quality.fit_discriminant({1: moments(np.random.default_rng(1).normal(0, 1, (50, size)))})
    assert np.isfinite(only.scores(np.ones((2, size)))).all()


def corpus(n):
    good = ["The little boat went round the bend, and all of them waved at it.", "Rain fell for days on end."]
    bad = ["BUY NOW!! " * 9, "||| --- ||| " * 20, "same same same same same same"]
    rows, labels = [], []
    for k in range(n):
        source = good if k % 3 else bad
        rows.append((k, " ".join(source[(k + j) % len(source)] for j in range(1 + k % 5)), "s"))
        labels.append((k, int(k % 3 > 0)))
    return rows, labels


def test_keep_good(spark, make_docs):
    rows, labels = corpus(120)
    labels = spark.createDataFrame(labels + [(1, None), (None, 1), (4, 7), (2, 1), (2, 1)], "doc_id bigint, quality int")
    extra = [(None, rows[1][1], "s"), (900, None, "s"), (901, "", None)]
    docs = make_docs([(*r, 5) for r in rows + extra + rows[:2]], ", score int").withColumn("features", F.lit(2))
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert all(k is None or k >= 900 or k % 3 for k in ids)
    assert {k for k in range(120) if k % 3} <= set(ids) and ids.count(1) == 2 and None in ids


def test_keep_good_keeps_all_if_nothing_is_learnt(spark, make_docs):
    rows, labels = corpus(30)
    docs = make_docs(rows)
    held = [r["doc_id"] for r in docs.where(quality.held_out("doc_id")).collect()]
    assert held
    for few in ([], [(k + 1000, one) for k, one in labels], [(k, one) for k, one in labels if k in held],
                [(1, None), (None, 1), (1, 7)]):
        few = spark.createDataFrame(few, "doc_id bigint, quality int")
        kept = quality.keep_good(docs, few)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(30))


def test_empty(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality.keep_good(make_docs([]), labels).count() == 0
    features = make_docs([(1, "a", "s")]).select("doc_id", quality.features_of("text").alias("features"))
    assert [r["score"] for r in quality.score_documents(features, labels).collect()] == [0.5]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    scored = QUERIES["op8_quality"](spark, folder)
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = scored.join(truth, "doc_id").where("held_out").collect()
    for label, least in ((0, 0.9), (1, 0.95)):
        own = [r for r in rows if r["quality"] == label]
        assert own and sum(r["predicted"] == label for r in own) / len(own) >= least


def test_query_against_plain_densities(spark, folder):
    """Every score of the query, from means and covariances worked out row by row."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    stats = {k: np.array(quality.text_features(t)) for k, t in texts.items()}
    held = {k for k in texts if zlib.crc32(str(k).encode()) % 4 == 2}
    known = [(r["doc_id"], r["quality"]) for r in labels if r["doc_id"] in texts and r["doc_id"] not in held]
    size = len(quality.FEATURES)
    both = np.array([stats[k] for k, label in known if label in (0, 1)])
    spread = np.diag(np.maximum(both.var(axis=0), 1e-6))
    densities = []
    for label in (0, 1):
        rows = np.array([stats[k] for k, own in known if own == label])
        off = rows - rows.mean(axis=0)
        own = off.T @ off / len(rows)
        part = max((0.1 * size + 0.1 * len(rows)) / (size + len(rows)), size / (size + len(rows)))
        own = (1 - part) * own + part * np.diag(np.maximum(np.diag(own), 1e-6)) + 1e-3 * spread
        inverse, (_, volume) = np.linalg.inv(own), np.linalg.slogdet(own)
        share = math.log((len(rows) + 1) / (len(both) + 2))
        densities.append({
            k: share - 0.5 * volume - 0.5 * (x - rows.mean(axis=0)) @ inverse @ (x - rows.mean(axis=0))
            for k, x in stats.items()
        })
    got = QUERIES["op8_quality"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        difference = densities[0][r["doc_id"]] - densities[1][r["doc_id"]]
        want = 1 / (1 + math.exp(min(700, max(-700, difference))))
        assert r["score"] == pytest.approx(want, abs=1e-5) and r["held_out"] == (r["doc_id"] in held)
        assert r["predicted"] == int(r["score"] >= 0.7)


def test_same_documents_stay_however_labels_are_met(spark, make_docs, monkeypatch):
    rows, labels = corpus(90)
    docs, labels = make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    kept = sorted(r["doc_id"] for r in quality.keep_good(docs, labels).collect())
    monkeypatch.setattr(quality, "BROADCAST_BYTES", -1)
    assert sorted(r["doc_id"] for r in quality.keep_good(docs, labels).collect()) == kept != []
