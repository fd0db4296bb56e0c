"""Personal data: patterns against the plain ones, the tagger against enumeration."""

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskflow.llm import personal as p
from maskflow.llm.queries import QUERIES

# The patterns as they are stated; only their matches are filtered.
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    values = [int(d) for d in digits[::-1]]
    return sum(values[::2] + [sum(divmod(2 * v, 10)) for v in values[1::2]]) % 10 == 0


def plain_spans(text):
    spans = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(v) > 255 for v in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((m.start(), m.end(), kind))
    return sorted(spans, key=lambda s: (s[0], list(STATED).index(s[2])))


def test_patterns():
    draw = random.Random(4)
    pieces = ["a@b.c", "a@b.c_x@d.e", "@", "a@b", "x.y+z@q-r.s.t", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "0000000255.1.1.1",
              "4111 1111 1111 1111", "4111-1111-1111-1111", "79927398713", "+1 (415) 555-0100", "+12", "+1((((", " ", "  ", "-",
              ".", "7", "42", "é", "\n", "+49.30.123456789", "999999999999999999999", "a", "_", "@@", ".."]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 9)))
        assert p.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 150_000])
def test_long_runs_take_linear_time(text):
    assert p.base_spans(text + "@") is not None


def test_gradients_and_decoding_against_enumeration():
    draw = np.random.default_rng(1)
    tagger = p.Tagger.fresh(hidden=3, embedding=2)
    tagger.weights["transition"] = draw.normal(0, 1, (p.TAGS, p.TAGS))
    codes = draw.integers(0, p.SYMBOLS, (2, 4))
    tags = np.array([[0, 1, 2, 0], [3, 4, 4, 0]])
    scores, _ = tagger._forward(codes)
    transition = tagger.weights["transition"] + p.allowed()

    def path(row, way):
        steps = sum(scores[t, row, k] for t, k in enumerate(way)) + p.allowed()[0][way[0]]
        return steps + sum(transition[a, b] for a, b in zip(way, way[1:]))

    best, loss = tagger.decode(codes), 0.0
    for row in range(2):
        ways = list(product(range(p.TAGS), repeat=4))
        totals = np.array([path(row, w) for w in ways])
        assert tuple(best[row]) == ways[int(totals.argmax())]
        loss += np.log(np.exp(totals - totals.max()).sum()) + totals.max() - path(row, tags[row])
    got, grads = tagger.gradients(codes, tags)
    assert got == pytest.approx(loss / 2)
    for name, value in tagger.weights.items():
        for place in list(np.ndindex(value.shape))[:: max(1, value.size // 7)]:
            kept = value[place]
            value[place] = kept + 1e-5
            up = tagger.gradients(codes, tags)[0]
            value[place] = kept - 1e-5
            down = tagger.gradients(codes, tags)[0]
            value[place] = kept
            assert grads[name][place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_windows_and_reconciling():
    text = "x" * 500 + "a@b.cd" + "y" * 200
    starts = p.windows_of(text)
    assert all(s % p.STRIDE == 0 and p.SIGNAL.search(text[s : s + p.WINDOW]) for s in starts) and len(starts) == 2
    assert p.windows_of("no sign of it") == p.windows_of("") == []
    assert p.windows_of("7") == [0]
    # Every window tags what it sees of the span; the deepest one decides.
    for length in (3, 20, 90):
        span = (490, 490 + length, "phone")
        own = list(range(0, 700, p.STRIDE))
        tags = np.array([p.tags_of(p.WINDOW, [span], s) for s in own])
        for k, s in enumerate(own):  # a window that the span runs into sees it go on
            if span[0] < s < span[1]:
                tags[k, 0] = 2 + 2 * p.KINDS.index("phone")
        assert p.reconcile(700, own, tags) == [span]


@pytest.fixture(scope="module")
def halves(spark):
    """Texts of documents with even ids, which the tagger learns from, and with odd ids."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    return [[r["text"][:4000] for r in rows if r["doc_id"] % 2 == k] for k in (0, 1)]


@pytest.fixture(scope="module")
def tagger(halves):
    tagger = p.Tagger.fresh()
    losses = tagger.fit(*p.training_windows(halves[0]))
    assert losses[-1] < 0.05 * losses[0]
    return tagger


def test_held_out_windows(tagger, halves):
    codes, tags = p.training_windows(halves[1], 400, seed=77)
    found = tagger.decode(codes)
    assert (found == tags).mean() > 0.98 and (found == tags).all(axis=1).mean() > 0.85


def test_the_model_adds_and_keeps(tagger):
    side = "call +1 (415) 555-0100 4111111111111111 soon"
    (base, spans), (none, also_none) = p.find_all(tagger, [side, "nothing here, not 1 thing"])
    assert base == [] and [s[2] for s in spans] == ["phone", "card"]
    assert [side[s:e] for s, e, _ in spans] == ["+1 (415) 555-0100", "4111111111111111"]
    assert none == also_none == []
    mail = "write to ann.lee@mail.example.com or 10.0.0.7 now"
    ((base, spans),) = p.find_all(tagger, [mail])
    assert spans == base and len(base) == 2
    assert p.redact(mail, spans) == "write to <email> or <ip> now"


def test_column(spark, make_docs, tagger):
    long = "word " * 60_000 + "a.b@c.de " + "word " * 60_000
    rows = [(1, None, "s"), (2, "", "s"), (3, "mail a.b@c.de now", "s"), (3, "mail a.b@c.de now", "s"),
            (None, "é 10.0.0.7", None), (5, long, "s")]
    docs = make_docs([(*r, 4) for r in rows], ", base int").withColumn("personal", F.lit(1))
    got = p.find_personal_data(docs, tagger)
    assert got.columns == docs.columns
    for r in got.collect():
        base = [(s["start"], s["end"], s["kind"]) for s in r["personal"]["base"]]
        spans = [(s["start"], s["end"], s["kind"]) for s in r["personal"]["spans"]]
        assert base == plain_spans(r["text"] or "") and set(base) <= set(spans)
    assert p.find_personal_data(make_docs([]), tagger).count() == 0


def test_training_on_tables(spark, make_docs):
    for rows in ([], [(1, None, "s")], [(k, f"word {k} " * 30, "s") for k in range(30)]):
        assert p.train(make_docs(rows), sample=10, windows=20, steps=2).weights["tag"].shape == (2 * p.HIDDEN, p.TAGS)


def test_query(spark, folder, monkeypatch):
    monkeypatch.setattr(p.Tagger.fit, "__defaults__", (60, 48, 0.02, 11))
    got = {r["doc_id"]: r for r in QUERIES["op4_personal_data"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        base, r = plain_spans(d["text"] or ""), got[d["doc_id"]]
        text = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in p.KINDS] == [sum(s[2] == k for s in base) for k in p.KINDS]
        assert set(text.split(",")) <= set(r["spans"].split(","))
