"""Language identification by nearest centroids of character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import stored

UNKNOWN = "und"
BUCKETS = 4096
# Documents of a language that the model is fitted on at most.
SAMPLE = 400
# Languages learnt from at most.
LANGUAGES = 1000
CLUSTERS = 4
PIECE = 1 << 20

WORD = re.compile(r"[^\W\d_]+")
# Odd multipliers that mix 64-bit numbers, one for each place in an n-gram.
MIX = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64
)


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the 1- to 3-grams of a whole text by hash bucket; None without letters.

    Letters only, in lower case, words parted by one space. Long texts are
    hashed piece by piece, with two characters of overlap.
    """
    words = WORD.findall((text or "").lower())
    if not words:
        return None
    letters = f" {' '.join(words)} "
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, len(letters), PIECE):
        piece = letters[start : start + PIECE + 2].encode("utf-32-le", "replace")
        codes = np.frombuffer(piece, dtype=np.uint32).astype(np.uint64)
        for n in (1, 2, 3):
            size = min(PIECE, len(codes) - n + 1)
            if size <= 0:
                continue
            mixed = np.full(size, n, dtype=np.uint64) * MIX[3]
            for k in range(n):
                mixed += codes[k : k + size] * MIX[k]
            mixed ^= mixed >> np.uint64(29)
            mixed *= MIX[1]
            counts += np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=BUCKETS)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as TF-IDF vectors of length 1; all zero stays zero."""
    vectors = counts * idf
    lengths = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1.0)


def cluster(vectors: np.ndarray, clusters: int = CLUSTERS, rounds: int = 12,
            least_share: float = 0.05, others: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from farthest-first seeds: (centroids, distance radii).

    Clusters with less than ``least_share`` of the vectors are given up with their
    members and the rest run once more: farthest-first finds texts under a wrong
    label, which are to have no centroid. With ``others``, centroids and radii of other
    languages, a small cluster is given up only if it lies within the radius of one of
    them and nearer to it than to the large clusters here; a distinct form of the
    language stays. A radius is the distance (1 - cosine) that 98 % of
    the members keep, widened by half.
    """
    seeds = [int(np.argmax(vectors @ vectors.sum(axis=0)))]
    while len(seeds) < min(clusters, len(vectors)):
        nearest = (vectors @ vectors[seeds].T).max(axis=1)
        if nearest.min() > 1 - 1e-9:
            break
        seeds.append(int(np.argmin(nearest)))
    centroids = vectors[seeds]
    for step in range(2 * rounds):
        home = np.argmax(vectors @ centroids.T, axis=1)
        if step == rounds:
            sizes = np.bincount(home, minlength=len(centroids))
            kept = sizes >= min(least_share * len(vectors), sizes.max())
            if others is not None:
                own = (centroids @ centroids[kept].T).max(axis=1, keepdims=True)
                near = centroids @ others[0].T
                kept |= (sizes > 0) & ~((near > own) & (1 - near <= others[1])).any(axis=1)
            vectors, centroids = vectors[kept[home]], centroids[kept]
            home = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.array([vectors[home == k].sum(axis=0) for k in range(len(centroids))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1.0), centroids)
    closeness = vectors @ centroids.T
    home = np.argmax(closeness, axis=1)
    radii = [
        np.quantile(1 - closeness[home == k, k], 0.98) if (home == k).any() else 0.0
        for k in range(len(centroids))
    ]
    return centroids, np.minimum(1.5 * np.array(radii) + 0.05, 0.99)


@dataclass(frozen=True)
class Centroids:
    """Clustered centroids with their languages and radii, and the n-grams' IDF."""

    languages: list[str]
    vectors: np.ndarray
    radii: np.ndarray
    idf: np.ndarray

    def identify(self, texts: list[str | None]) -> pd.DataFrame:
        """(lang, score, rejected) of whole texts; ``score`` is the best cosine."""
        lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        for start in range(0, len(texts), 256):
            rows = [(k, c) for k in range(start, min(start + 256, len(texts)))
                    if (c := ngram_counts(texts[k])) is not None]
            if not rows or not self.languages:
                continue
            vectors = weighted(np.array([c for _, c in rows], dtype=np.float32), self.idf)
            closeness = vectors @ self.vectors.T
            best = np.argmax(closeness, axis=1)
            for (k, _), row, b in zip(rows, closeness, best):
                lang[k], score[k] = self.languages[b], min(1.0, max(0.0, float(row[b])))
                rejected[k] = 1 - row[b] > self.radii[b]
        return pd.DataFrame({"lang": lang, "score": score, "rejected": rejected})


def train(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, languages: int = LANGUAGES) -> Centroids:
    """From rows (text, lang): up to ``sample`` texts of each language, drawn by a hash
    of the text; equal texts count once. Null languages and texts are left out, and of
    more than ``languages`` languages those with the fewest texts.

    Samples are clustered language by language on executors, first by their large
    clusters alone, then once more in sight of those of the other languages; IDF sums
    and centroids, as large as the number of languages, reach the driver.
    """
    rows = labelled.where("lang is not null and text is not null").select(
        "text", "lang", F.xxhash64("text").alias("draw")
    )
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n"))
    # Bounds what the driver collects and sends along: some 100 KB a language.
    counts = stored(counts.orderBy(F.desc("n"), "lang").limit(languages), "languages")
    # Twice the sample on average, so that the lowest draws below hold all of it.
    share = F.lit(2.0 * sample) / F.col("n") * F.lit(2.0**63)
    drawn = (
        rows.join(F.broadcast(counts), "lang")  # a row per language: texts are not moved
        .where(F.shiftrightunsigned("draw", 1).cast("double") < share)
        .groupBy("lang", "draw")
        .agg(F.min("text").alias("text"))
    )

    # Texts are counted before a language's sample meets in one task, so that its size
    # does not depend on their lengths, and handed on in small parts.
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 128):
                part = batch.iloc[start : start + 128]
                found = [
                    (lang, draw, c.astype(np.int32).tobytes())
                    for lang, draw, text in zip(part["lang"], part["draw"], part["text"])
                    if (c := ngram_counts(text)) is not None
                ]
                yield pd.DataFrame(found, columns=["lang", "draw", "counts"])

    def lowest(group: pd.DataFrame) -> pd.DataFrame:
        return group.sort_values("draw").head(sample)[["lang", "counts"]]

    sampled = stored(
        drawn.select("lang", "draw", "text")
        .mapInPandas(counted, "lang string, draw bigint, counts binary")
        .groupBy("lang").applyInPandas(lowest, "lang string, counts binary"),
        "ngrams",
    )

    def table(group: pd.DataFrame) -> np.ndarray:
        return np.array([np.frombuffer(c, np.int32) for c in group["counts"]])

    def present(group: pd.DataFrame) -> pd.DataFrame:
        df = (table(group) > 0).sum(axis=0).astype(np.int64)
        return pd.DataFrame([(len(group), df.tobytes())], columns=["n", "df"])

    sums = sampled.groupBy("lang").applyInPandas(present, "n bigint, df binary").collect()
    total = sum(row["n"] for row in sums)
    df = sum((np.frombuffer(row["df"], np.int64) for row in sums), np.zeros(BUCKETS))
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)

    def clustered(large: list[tuple[str, np.ndarray, float]] | None) -> list:
        """Rows of centroids; ``large`` holds (lang, vector, radius) of large clusters."""

        def centroids(group: pd.DataFrame) -> pd.DataFrame:
            lang, others = group["lang"].iloc[0], None
            if large is not None:
                far = [(vector, radius) for other, vector, radius in large if other != lang]
                others = np.array([v for v, _ in far]).reshape(-1, BUCKETS), np.array([r for _, r in far])
            found, radii = cluster(weighted(table(group), idf), clusters, others=others)
            return pd.DataFrame({"lang": lang, "k": range(len(found)),
                                 "vector": [v.astype(np.float32).tobytes() for v in found], "radius": radii})

        return sorted(
            sampled.groupBy("lang")
            .applyInPandas(centroids, "lang string, k int, vector binary, radius double")
            .collect(),
            key=lambda row: (row["lang"], row["k"]),
        )

    large = [(row["lang"], np.frombuffer(row["vector"], np.float32), row["radius"]) for row in clustered(None)]
    rows = clustered(large)
    found = [np.frombuffer(row["vector"], np.float32) for row in rows]
    return Centroids(
        [row["lang"] for row in rows],
        np.array(found).reshape(len(rows), BUCKETS),
        np.array([row["radius"] for row in rows]),
        idf,
    )


def language_of(model: Centroids, text) -> F.Column:
    """Column (lang, score, rejected) of a text column: the nearest centroid's language,
    its cosine, and whether the text lies outside the centroid's radius.

    Null texts and texts without letters are ``und`` with score 0, rejected; so
    is every text if nothing was learnt. Equal cosines go to the language that
    sorts first.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield model.identify([t if isinstance(t, str) else None for t in texts])

    return F.pandas_udf(run, "lang string, score double, rejected boolean")(text)


def identify(docs: DataFrame, model: Centroids, out: str = "language") -> DataFrame:
    """``docs`` with the struct ``out``; a language it rejects is ``und`` there, the one it
    would have been stays as ``nearest``. One projection, no shuffle."""
    found = language_of(model, F.col("text"))
    packed = docs.drop(out).select(F.struct("*").alias("doc"), found.alias("found"))
    return packed.select(
        "doc.*",
        F.struct(
            F.when(F.col("found.rejected"), F.lit(UNKNOWN)).otherwise(F.col("found.lang")).alias("lang"),
            F.col("found.lang").alias("nearest"),
            F.col("found.score").alias("score"),
            F.col("found.rejected").alias("rejected"),
        ).alias(out),
    )


def held_out(doc_id: str) -> F.Column:
    """Whether the language of a document may not be learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))
