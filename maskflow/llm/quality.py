"""Quality classifier: a regularised quadratic discriminant over text statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import BROADCAST_BYTES, bytes_of, stored

FEATURES = (
    "log words",
    "log mean word length",
    "log words per line",
    "distinct words",
    "top word share",
    "repeated neighbours",
    "distinct lines",
    "symbol share",
    "punctuation share",
    "digit share",
    "capital share",
    "odd words",
)

# Typical prose added to every text before shares are taken, so that those of short
# texts do not scatter more than those of long ones.
CALM_WORDS = 60
CALM_BYTES = 300

SYMBOLS = np.frombuffer(b"#$%&*|!~^<>{}[]\\=_@/+", np.uint8)
PUNCTUATION = np.frombuffer(b".,;:?!'\"()-", np.uint8)
DIGITS = np.arange(48, 58)
CAPITALS = np.arange(65, 91)
SMALL = np.arange(97, 123)


def text_features(text: str | None) -> list[float]:
    """Transformed statistics of one whole text, finite for every text.

    Shares enter as square roots and counts as logarithms, which makes them
    closer to normal. A null text counts as empty.
    """
    data = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n = len(words)
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    lines = data.split(b"\n")
    visible = sum(map(len, words))
    letters = counts[CAPITALS].sum() + counts[SMALL].sum()
    again = sum(map(eq, words, words[1:])) if n > 1 else 0
    odd = sum(c for w, c in tally.items() if not w[0:1].isalpha() and w[0] < 128)
    words_in, visible_in = n + CALM_WORDS, visible + CALM_BYTES
    return [
        math.log(words_in),
        math.log((visible + 5 * CALM_WORDS) / words_in),
        math.log((n + CALM_WORDS) / (len(lines) + 1)),
        math.log(len(tally) + CALM_WORDS) / math.log(words_in),
        math.sqrt((max(tally.values(), default=0) + 0.05 * CALM_WORDS) / words_in),
        math.sqrt(again / words_in),
        (len(set(lines)) + 6) / (len(lines) + 6),
        math.sqrt(counts[SYMBOLS].sum() / visible_in),
        math.sqrt((counts[PUNCTUATION].sum() + 0.03 * CALM_BYTES) / visible_in),
        math.sqrt(counts[DIGITS].sum() / visible_in),
        math.sqrt((counts[CAPITALS].sum() + 0.03 * CALM_BYTES) / (letters + CALM_BYTES)),
        math.sqrt(odd / words_in),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Class means, Cholesky factors of inverse-ready covariances, and log priors."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray  # log prior - half the log determinant
    rows: int = 0  # labelled rows learnt from

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the log densities."""
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            # The factors hold inverse Cholesky factors, so no system is solved per row.
            scaled = (features - mean) @ factor.T
            logs.append(offset - 0.5 * np.einsum("ij,ij->i", scaled, scaled))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit_discriminant(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], shrinkage: float = 0.1,
                     ridge: float = 1e-3) -> Discriminant:
    """From (rows, sum, sum of outer products) by class 0 and 1.

    A class covariance is shrunk towards the diagonal of the pooled covariance
    and gets ``ridge`` times that diagonal plus a floor, so it can be factored
    whatever the rows; a class without rows takes the pooled moments.
    """
    size = len(FEATURES)
    empty = (0, np.zeros(size), np.zeros((size, size)))
    classes = [moments.get(label, empty) for label in (0, 1)]
    rows = sum(c[0] for c in classes)
    if not rows:
        return Discriminant(np.zeros((2, size)), np.stack([np.eye(size)] * 2), np.zeros(2))
    pooled_mean = sum(c[1] for c in classes) / rows
    pooled = sum(c[2] for c in classes) / rows - np.outer(pooled_mean, pooled_mean)
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    means, factors, offsets = [], [], []
    for n, total, products in classes:
        mean = total / n if n else pooled_mean
        own = products / n - np.outer(mean, mean) if n else pooled
        part = (shrinkage * size + shrinkage * n) / (size + n)  # few rows shrink no less
        part = max(part, size / (size + n))
        covariance = (1 - part) * own + part * np.diag(np.maximum(np.diag(own), 1e-6)) + ridge * spread
        lower = np.linalg.cholesky((covariance + covariance.T) / 2 + 1e-9 * np.eye(size))
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        offsets.append(math.log((n + 1) / (rows + 2)) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(offsets), rows)


def _features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([text_features(t if isinstance(t, str) else None) for t in texts])


def features_of(text) -> F.Column:
    """Column of ``FEATURES`` of a text column."""
    return F.pandas_udf(_features, "array<double>")(text)


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    found: dict[int, list] = {}
    for batch in batches:
        for label, rows in batch.groupby("label"):
            values = np.array(rows["features"].tolist(), dtype=float)
            old = found.setdefault(int(label), [0, 0.0, 0.0])
            old[0] += len(values)
            old[1] = old[1] + values.sum(axis=0)
            old[2] = old[2] + values.T @ values
    for label, (n, total, products) in found.items():
        moments = np.concatenate([total, products.ravel()])
        yield pd.DataFrame(
            {"label": label, "n": n, "place": np.arange(len(moments)), "value": moments}
        )


def train(labelled: DataFrame, **options) -> Discriminant:
    """From rows (features, label); rows with another label than 0 or 1 are left out.

    Every row counts: partitions send their sums, whose size is that of the
    features alone, and the sums of the sums reach the driver.
    """
    sums = (
        labelled.where("label in (0, 1) and features is not null")
        .mapInPandas(_moments, "label int, n bigint, place int, value double")
        .groupBy("label", "place")
        .agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
        .collect()
    )
    size, moments = len(FEATURES), {}
    for label in {row["label"] for row in sums}:
        values = np.zeros(size + size * size)
        for row in sums:
            if row["label"] == label:
                values[row["place"]], n = row["value"], row["n"]
        moments[label] = (n, values[:size], values[size:].reshape(size, size))
    return fit_discriminant(moments, **options)


def score_of(model: Discriminant, features) -> F.Column:
    """Column of the probability of class 1 given a column of features."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            values = np.array(rows.tolist(), dtype=float).reshape(len(rows), len(FEATURES))
            yield pd.Series(model.scores(values))

    return F.pandas_udf(run, "double")(features)


def held_out(doc_id) -> F.Column:
    """Whether labels of a document may not be learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def score_documents(features: DataFrame, labels: DataFrame) -> DataFrame:
    """``features`` (doc_id, features, ...) with ``score``; learns from ``labels``
    (doc_id, quality) of documents that are not held out.

    Null and unknown labels teach nothing; repeated labels count repeatedly; a
    document with a null doc_id is scored but not learnt from; without any
    label every score is 0.5; a ``score`` the table has is replaced; an empty
    table stays empty.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    labelled = features.where(~held_out("doc_id")).select("doc_id", "features").join(known, "doc_id")
    return features.withColumn("score", score_of(train(labelled), F.col("features")))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.7) -> DataFrame:
    """The documents whose score is at least ``least``, with all their columns.

    All documents, if there is no label to learn from (none at all, or of other or
    held-out documents alone): what cannot be told apart is not filtered. Statistics are
    taken of the labelled documents for training, stored narrow, and of all in the filter,
    so no text is shuffled. Other columns may have any name.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label in (0, 1)")
    learnt = docs.where(~held_out("doc_id")).select("doc_id", "text")
    ids = stored(known.select("doc_id").distinct(), "labelled")
    if bytes_of(ids) <= BROADCAST_BYTES:  # texts without a label teach nothing
        learnt = learnt.join(F.broadcast(ids), "doc_id", "left_semi")
    features = stored(learnt.select("doc_id", features_of("text").alias("features")), "features")
    model = train(features.join(known, "doc_id"))
    if not model.rows:
        return docs
    return docs.where(score_of(model, features_of("text")) >= least)
