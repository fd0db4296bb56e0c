"""Benchmark decontamination: BM25 over test items, searched by block-max WAND."""

from __future__ import annotations

import math
import pickle
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskflow.llm.common import stored
from maskflow.llm.warc import open_store
from maskflow.sources.shared import new_path

# Words of an indexed piece of an item; passages are twice as long and start at
# every multiple of it, so every piece that occurs lies in one passage whole.
PIECE = 64
BLOCK = 4
SCORE = 0.6
OVERLAP = 0.8
GRAM = 5
K1, B = 1.2, 0.75
# Words of a text that are searched together; windows share a piece, so that every passage
# lies in one.
WINDOW = 256 * PIECE
# Bytes of items in one index, of which a task holds one at a time, and of its table of
# bounds; blocks hold more pieces where the table would be larger.
INDEX_BYTES = 256 << 10
BOUNDS_BYTES = 64 << 20

WORD = re.compile(r"\w+")
# A last line that ends a sentence, and lines that ask for an answer.
SENTENCE = re.compile(r"[.!…。！][\"'”’»)\]]*\Z")
ASKS = re.compile(r"[?？:：]\W*$|^\W*(?:q|question|problem)\s*[:.]|^\W*(?:a|answer|solution)\s*:", re.I | re.M)
MATCHES = "array<struct<item_id: string, score: double, question_overlap: double, answer_overlap: double>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def windows_of(text: str, size: int = WINDOW) -> Iterator[list[str]]:
    """The words of a text in windows of ``size`` that share a piece with the next."""
    words = (match.group() for match in WORD.finditer(text.lower()))
    window = list(islice(words, size))
    while window:
        yield window
        more = list(islice(words, size - PIECE))
        window = window[-PIECE:] + more if more else []


def grams_of(words: list[str], size: int = GRAM) -> set[tuple[str, ...]]:
    """Shingles of ``size`` words; fewer words are one shingle, no words none."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


@dataclass(frozen=True)
class Item:
    """A test item: its last line is the answer, what comes before the question; an
    item of one line is all question. ``prose`` says that the last line is a sentence
    and no line asks for an answer, so that the item may be one passage."""

    item_id: str
    question: list[str]
    answer: list[str]
    prose: bool = False

    @classmethod
    def of(cls, item_id: str, text: str | None) -> Item:
        whole = (text or "").rstrip()
        question, _, answer = whole.rpartition("\n")
        if not words_of(question):
            question, answer = answer, ""
        prose = bool(answer and SENTENCE.search(answer)) and not ASKS.search(whole)
        return cls(item_id, words_of(question), words_of(answer), prose)

    def wanted(self) -> list[set[tuple[str, ...]]]:
        """Shingles of the question, of the answer, and of a passage of prose as a whole."""
        whole = self.question + self.answer if self.prose else []
        return [grams_of(words) for words in (self.question, self.answer, whole)]


class Index:
    """Inverted index of item pieces with impacts as shares of a piece's own score.

    A passage that holds all words of a piece scores 1 for it, so one threshold
    serves pieces of every length. Pieces are numbered so that those with alike
    common words are neighbours, and dealt to blocks of consecutive numbers;
    ``bounds`` holds the largest impact of every term in every block.
    """

    def __init__(self, items: list[Item]):
        self.items = items
        pieces: list[tuple[int, Counter]] = []
        for number, item in enumerate(items):
            words = item.question + item.answer
            pieces += [(number, Counter(words[k : k + PIECE])) for k in range(0, len(words), PIECE)]
        frequency = Counter(word for _, terms in pieces for word in terms)
        self.vocabulary = {word: k for k, word in enumerate(sorted(frequency))}
        common = {w: k for k, (w, _) in enumerate(sorted(frequency.items(), key=lambda x: (-x[1], x[0])))}
        pieces.sort(key=lambda piece: sorted(common[word] for word in piece[1])[:8])
        self.owners = [number for number, _ in pieces]
        table = 4 * (len(self.vocabulary) + 1) * len(pieces)
        size = max(BLOCK, -(-table // BOUNDS_BYTES))
        blocks = -(-len(pieces) // size)
        self.bounds = np.zeros((len(self.vocabulary) + 1, blocks), dtype=np.float32)
        self.postings: dict[tuple[int, int], list[tuple[int, float]]] = {}
        mean = sum(sum(t.values()) for _, t in pieces) / max(1, len(pieces))
        for place, (_, terms) in enumerate(pieces):
            length = sum(terms.values())
            weights = {}
            for word, tf in terms.items():
                df = frequency[word]
                idf = math.log(1 + (len(pieces) - df + 0.5) / (df + 0.5))
                weights[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
            own, block = sum(weights.values()), place // size
            for word, weight in weights.items():
                term, impact = self.vocabulary[word], weight / own
                self.postings.setdefault((term, block), []).append((place, impact))
                # Rounded up, so that a bound in single precision stays a bound.
                bound = np.nextafter(np.float32(impact), np.float32(2))
                self.bounds[term, block] = max(self.bounds[term, block], bound)

    def search(self, terms: list[int], block: int, least: float) -> list[tuple[int, float]]:
        """Pieces of a block scoring at least ``least`` for distinct terms, by WAND: the
        pivot is the first piece that the lists' bounds could lift that far."""
        lists = [
            [0, self.postings[term, block], float(self.bounds[term, block])]
            for term in terms
            if (term, block) in self.postings
        ]
        found = []
        while lists:
            lists.sort(key=lambda entry: entry[1][entry[0]][0])
            # Lists before the pivot move up to it; a list at the pivot is scored.
            total, pivot = 0.0, None
            for at, postings, bound in lists:
                total += bound
                if total >= least - 1e-6:
                    pivot = postings[at][0]
                    break
            if pivot is None:
                return found
            if lists[0][1][lists[0][0]][0] == pivot:
                score = math.fsum(p[at][1] for at, p, _ in lists if p[at][0] == pivot)
                if score >= least:
                    found.append((pivot, score))
                goal = pivot + 1
            else:
                goal = pivot
            for entry in lists:
                while entry[0] < len(entry[1]) and entry[1][entry[0]][0] < goal:
                    entry[0] += 1
            lists = [entry for entry in lists if entry[0] < len(entry[1])]
        return found

    def candidates(self, words: list[str], least: float = SCORE) -> dict[int, float]:
        """Best score by item of all passages, for items that reach ``least`` in one."""
        unknown = len(self.vocabulary)
        get = self.vocabulary.get
        ids = np.fromiter(map(get, words, repeat(unknown)), dtype=np.int64, count=len(words))
        at = np.flatnonzero(ids < unknown)
        if not len(at):
            return {}
        keys = np.unique(at // PIECE * (unknown + 1) + ids[at])
        pieces, terms = np.divmod(keys, unknown + 1)
        numbers, starts = np.unique(pieces, return_index=True)
        sums = np.add.reduceat(self.bounds[terms], starts, axis=0)
        # A passage is a piece of the text and the next one; bounds add up.
        bounds = sums.copy()
        follows = np.flatnonzero(np.diff(numbers) == 1)
        bounds[follows] += sums[follows + 1]
        ends = np.append(starts[1:], len(terms))
        best: dict[int, float] = {}
        for row in np.flatnonzero((bounds >= least - 1e-3).any(axis=1)):
            last = row + 1 if row + 1 < len(numbers) and numbers[row + 1] == numbers[row] + 1 else row
            distinct = np.array(sorted(set(terms[starts[row] : ends[last]].tolist())))
            # Terms of both halves now count once.
            exact = bounds[row] if last == row else self.bounds[distinct].sum(axis=0)
            for block in np.flatnonzero(exact >= least - 1e-3).tolist():
                own = distinct[self.bounds[distinct, block] > 0].tolist()
                for place, score in self.search(own, block, least):
                    owner = self.owners[place]
                    best[owner] = max(best.get(owner, 0.0), score)
        return best

    def matches(self, text: str | None, least: float = SCORE, overlap: float = OVERLAP) -> list[dict]:
        """Items found in a whole text whose overlap is verified: that of question and
        answer each or, for prose, that of the item as a whole. The text is gone through
        in windows, so memory beside it does not grow with its length."""
        best: dict[int, float] = {}
        for words in windows_of(text or ""):
            for owner, score in self.candidates(words, least).items():
                best[owner] = max(best.get(owner, 0.0), score)
        if not best:
            return []
        wanted = {n: self.items[n].wanted() for n in best}
        sizes = {len(g) for parts in wanted.values() for grams in parts for g in grams}
        needed = {g for parts in wanted.values() for grams in parts for g in grams}
        present = set()
        for words in windows_of(text):
            for size in sizes:
                present.update(needed.intersection(zip(*(words[k:] for k in range(size)))))
        found = []
        for number in sorted(best):
            shares = [len(g & present) / len(g) if g else 1.0 for g in wanted[number]]
            if min(shares[:2]) >= overlap or (self.items[number].prose and shares[2] >= overlap):
                found.append(
                    {"item_id": self.items[number].item_id, "score": best[number],
                     "question_overlap": shares[0], "answer_overlap": shares[1]}
                )
        return found

    def packed(self) -> bytes:
        items = [(item.item_id, item.question, item.answer, item.prose) for item in self.items]
        return pickle.dumps((items, self.owners, self.vocabulary, self.bounds, self.postings), protocol=5)

    @classmethod
    def unpacked(cls, data: bytes) -> Index:
        index = cls.__new__(cls)
        items, index.owners, index.vocabulary, index.bounds, index.postings = pickle.loads(data)
        index.items = [Item(*item) for item in items]
        return index


def build_indexes(benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> list[str]:
    """Files of indexes, one for every ``index_bytes`` of items (item_id, text), built by a
    task each and written to the shared folder; none grows with the benchmark, and the
    driver holds their names alone. Items without words are left out; equal items all count.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text")
    ).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, -(-size // index_bytes))))
    folder = new_path(spark, "benchmark-indexes")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(zip(group["item_id"], group["text"]), key=lambda row: (row[0] is not None, row[0] or "", row[1]))
        parsed = [Item.of(item_id, text) for item_id, text in rows]
        parsed = [item for item in parsed if item.question]
        if not parsed:
            return pd.DataFrame({"part": [], "path": []}).astype({"part": "int64", "path": "str"})
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name = f"index-{uuid.uuid4().hex}"
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(Index(parsed).packed())
        return pd.DataFrame({"part": [int(group["part"].iloc[0])], "path": [f"{folder}/{name}"]})

    built = items.withColumn("part", part).groupBy("part").applyInPandas(build, "part bigint, path string")
    return [row["path"] for row in stored(built, "indexes").orderBy("part").collect()]


def matches_of(paths: list[str], text, least: float = SCORE, overlap: float = OVERLAP) -> F.Column:
    """Column of the verified matches of a text column, over all indexes: every batch of texts
    passes one index after the other, of which one is in memory."""
    if not paths:
        return F.array().cast(MATCHES)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held, index = None, None
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            found: list[list[dict]] = [[] for _ in texts]
            for path in paths:
                if path != held:
                    index = None  # before the next one is read
                    store, name = open_store(path)
                    with store.open_input_stream(name) as file:
                        index = Index.unpacked(file.read())
                    held = path
                for own, each in zip(found, texts):
                    own += index.matches(each, least, overlap)
            yield pd.Series(found)

    return F.pandas_udf(run, MATCHES)(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) for every item that a
    document holds.

    One pass over the texts, no shuffle. Null and empty texts and
    items match nothing; repeated rows are reported repeatedly; a text counts
    whole, however long.
    """
    matches = matches_of(build_indexes(benchmark), F.col("text"), **options)
    kind = benchmark.schema["item_id"].dataType
    return (
        docs.select("doc_id", F.explode(matches).alias("match"))
        .select("doc_id", F.col("match.item_id").cast(kind).alias("item_id"),
                "match.score", "match.question_overlap", "match.answer_overlap")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    matches = matches_of(build_indexes(benchmark), F.col("text"), **options)
    return docs.where(F.size(matches) == 0)
