"""Fill-in-the-middle: texts cut at drawn token boundaries found by a learned rank index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the transformation: markers, and shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
SEED = 1

# Largest distance, in code points, of a boundary from its segment's line; it fits a byte.
ERROR = 120
# Code points that are looked at together; a segment ends where they end.
BLOCK = 1 << 20
WINDOW = 256

PARTS = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def boundaries(codes: np.ndarray, more: bool) -> np.ndarray:
    """Offsets behind the tokens ``[A-Za-z]+|[^A-Za-z]`` of a block of code points whose last
    one is only looked ahead at if ``more``."""
    lower = codes | 0x20
    letter = (lower >= 97) & (lower <= 122)
    ends = np.ones(len(codes), dtype=bool)
    ends[:-1] = ~(letter[:-1] & letter[1:])
    return np.flatnonzero(ends[: len(codes) - more]) + 1


class RankIndex:
    """From rank k to the offset of the k-th boundary of a text: lines and residuals.

    A segment holds consecutive ranks whose offsets lie within ``error`` of a line through
    its first one; it is as long as a line can be found (the cone of fitting slopes stays
    open). The residual of every rank is one byte, so that predicted and stored parts give
    the offset exactly.
    """

    def __init__(self, error: int = ERROR):
        if not 1 <= error <= 126:
            raise ValueError("error must be between 1 and 126")
        self.error = error
        self.count = 0
        self.starts: list[int] = []
        self.origins: list[int] = []
        self.slopes: list[float] = []
        self.residuals: list[np.ndarray] = []

    @classmethod
    def of(cls, text: str, error: int = ERROR, block: int = BLOCK) -> RankIndex:
        """The index of a text's boundaries, rank 0 being the text's start, read block by
        block: what is held is a block and a byte for every token."""
        index = cls(error)
        for start in range(0, len(text), block):
            # One code point further, as a token may go on there.
            part = text[start : start + block + 1]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            index.add(boundaries(codes, len(part) > block) + start)
        index.close()
        return index

    def add(self, offsets: np.ndarray) -> None:
        """Append boundaries with ascending offsets, in segments of their own."""
        at = 0
        while at < len(offsets):
            length, slope = self._segment(offsets, at)
            self.starts.append(self.count + 1)
            self.origins.append(int(offsets[at]))
            self.slopes.append(slope)
            line = np.rint(slope * np.arange(length)).astype(np.int64)
            self.residuals.append((offsets[at : at + length] - offsets[at] - line).astype(np.int8))
            self.count += length
            at += length

    def _segment(self, offsets: np.ndarray, at: int) -> tuple[int, float]:
        """How many offsets from ``at`` on one line fits, and its slope: the cone of slopes that
        stay within the error is narrowed window by window until it is empty."""
        low, high, length, width = -np.inf, np.inf, 1, WINDOW
        while at + length < len(offsets):
            steps = np.arange(length, min(length + width, len(offsets) - at))
            rise = offsets[at + steps] - offsets[at]
            lows = np.maximum.accumulate(np.maximum((rise - self.error) / steps, low))
            highs = np.minimum.accumulate(np.minimum((rise + self.error) / steps, high))
            fits = int(np.searchsorted(lows > highs, True))
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
                length += fits
            if fits < len(steps):
                break
            width *= 2
        return length, (low + high) / 2 if length > 1 else 0.0

    def close(self) -> None:
        self._starts = np.array(self.starts, dtype=np.int64)
        self._residuals = np.concatenate(self.residuals) if self.residuals else np.zeros(0, np.int8)

    def offset(self, rank: int) -> int:
        """Code points before the ``rank``-th boundary: predicted, then corrected."""
        if rank == 0:
            return 0
        k = int(np.searchsorted(self._starts, rank, side="right")) - 1
        predicted = self.origins[k] + int(np.rint(self.slopes[k] * (rank - self.starts[k])))
        return predicted + int(self._residuals[rank - 1])


def transform(text: str | None, digest: str, error: int = ERROR) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text under the draws of a digest.

    Null counts as empty. Texts that are empty or hold a marker, and those drawn so, stay
    plain. Else both cuts are drawn among the n + 1 boundaries.
    """
    text = text if isinstance(text, str) else ""
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    index = RankIndex.of(text, error)
    n = index.count
    if not text or h3 % 100 >= PLAIN_FROM or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = (index.offset(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def draws_of(doc_id: str | Column, seed: int = SEED) -> Column:
    """Hex digest a document's draws are read from; a null doc_id draws as an empty one."""
    key = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))
    return F.sha2(F.concat(F.lit(f"{seed}:"), key), 256)


def restore(output: str | Column, form: str | Column) -> Column:
    """The text an output was made of, from output and form alone: a marker's first
    occurrence is the one that was put in, as no text that was cut holds one."""

    def parts(output: Column, first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        """What follows each of three markers."""
        rest = F.substring(output, F.lit(len(first) + 1), F.length(output))
        head = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.length(head) + len(second) + 1, F.length(rest))
        body = F.substring_index(rest, third, 1)
        return head, body, F.substring(rest, F.length(body) + len(third) + 1, F.length(rest))

    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    prefix, suffix, middle = parts(output, PREFIX, SUFFIX, MIDDLE)
    tail, head, between = parts(output, SUFFIX, PREFIX, MIDDLE)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(head, between, tail))
        .otherwise(output)
    )


def fill_in_middle(docs: DataFrame, seed: int = SEED, error: int = ERROR, out: str = "middle") -> DataFrame:
    """``docs`` with the struct column ``out``: n, form, prefix_chars, middle_chars, output.

    One pass, no shuffle. Draws follow from doc_id alone, so reruns and repeated rows give
    equal outputs. Null texts count as empty and are plain; lengths are code points; a column
    named ``out`` that the table has is replaced; an empty table stays empty.
    """

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, digests in batches:
            rows = [transform(text, digest, error) for text, digest in zip(texts, digests)]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    names = [part.split()[0] for part in PARTS.split(", ")]
    return docs.withColumn(out, F.pandas_udf(run, PARTS)(F.col("text"), draws_of("doc_id", seed)))
