"""Fill-in-the-middle: the rank index and cuts against plain Python."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskflow.llm import middle

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def offsets(text):
    return [0] + [m.end() for m in TOKEN.finditer(text)]


def plain(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    ends = offsets(text)
    n = len(ends) - 1
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = (ends[k] for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    pieces = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, "<S>{2}<P>{0}<M>{1}".format(*pieces)
    return n, "psm", a, b - a, "<P>{0}<S>{2}<M>{1}".format(*pieces)


@given(st.text(alphabet="ab Z.é\n😀<PSM>", max_size=300), st.integers(1, 126), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_every_rank_is_exact(text, error, block):
    index = middle.RankIndex.of(text, error, block)
    assert [index.offset(k) for k in range(index.count + 1)] == offsets(text)


def test_segments_are_bounded_and_few():
    """Long texts of words need few segments, each within its error, and a byte a token."""
    draw = np.random.default_rng(2)
    text = " ".join("x" * k for k in draw.integers(1, 12, 200_000)) + "é" * 50_000 + "y" * 100_000
    for error in (4, 120):
        index = middle.RankIndex.of(text, error)
        found = np.array([index.offset(k) for k in range(0, index.count + 1, 97)])
        assert (found == np.array(offsets(text))[::97]).all()
        assert np.abs(index._residuals.astype(int)).max() <= error + 1
        assert index._residuals.nbytes == index.count == len(offsets(text)) - 1
        assert len(index.starts) < index.count / (2 * error)
    with pytest.raises(ValueError):
        middle.RankIndex(127)


ROWS = [
    (0, None), (1, ""), (2, "a"), (3, "One two, three.\nFour"), (4, "é😀 ß"), (5, "has <P> in it"), (6, "<S>"), (7, "x<M>"),
    (8, "< P> <p> <M"), (None, "no id at all"), (9, "<<S <<M <P"), (10, "word " * 60_000), (11, "z" * 300_000), (12, "é" * 100_000),
    *((k, f"text {k} with some <S words> & marks <M< P>") for k in range(13, 113)), (113, "same"), (113, "same"),
]


def test_against_plain_python(spark):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").repartition(3)
    docs = docs.withColumns({"middle": F.lit(5), "form": F.lit(6), "bag": F.create_map(F.lit(1), F.lit(2))})
    cut = middle.fill_in_middle(docs)
    assert cut.columns == ["doc_id", "text", "middle", "form", "bag"]
    rows = cut.select("doc_id", "text", "middle", middle.restore("middle.output", "middle.form").alias("back")).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, ROWS))
    for row in rows:
        assert tuple(row["middle"]) == plain(row["doc_id"], row["text"])
        assert row["back"] == (row["text"] or "")
    assert {r["middle"]["form"] for r in rows} == {"plain", "psm", "spm"}


@given(st.text(alphabet="<>PSMa ", max_size=12), st.integers(0, 400))
@settings(max_examples=15, deadline=None)
def test_round_trip(spark, text, first):
    rows = [(k, text) for k in range(first, first + 40)]
    cut = middle.fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = cut.select(middle.restore("middle.output", "middle.form").alias("back"), "middle.form", "doc_id").collect()
    assert all(r["back"] == text and r["form"] == plain(r["doc_id"], text)[1] for r in found)


def test_empty_table(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
