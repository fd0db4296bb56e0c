"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in the order they are listed in.
KINDS = ("email", "ip", "card", "phone")

# Documents the model's windows are cut from, and training windows, at most.
SAMPLE_DOCUMENTS = 2000
TRAIN_WINDOWS = 1024

WINDOW = 64
STRIDE = 32
HIDDEN = 24
EMBEDDING = 12

# -- patterns

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SIGNAL = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    """Whether a number passes the Luhn check."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From the @ signs, so that a long run of letters is read once: the longest run
    of local characters before one, from the end of the last match at most."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the fixed patterns, in code points, sorted by start and kind."""
    if not SIGNAL.search(text):
        return []
    spans = [(s, e, "email") for s, e in emails(text)]
    for found in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            spans.append((*found.span(), "ip"))
    for found in CARD.finditer(text):
        digits = only_digits(found[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((*found.span(), "card"))
    for found in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(only_digits(found[0])) <= 15:
            spans.append((*found.span(), "phone"))
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def written(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# -- model

# Tags: outside, and begin and inside of every kind.
TAGS = 1 + 2 * len(KINDS)
SYMBOLS = 97  # printable ASCII, other white space or padding, letters beyond ASCII


def symbols(text: str) -> np.ndarray:
    """Characters as numbers below ``SYMBOLS``."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    return np.where((codes >= 32) & (codes < 127), codes - 32, np.where(codes < 32, 95, 96))


def allowed() -> np.ndarray:
    """Penalties of tag pairs: inside must follow begin or inside of its kind."""
    penalty = np.zeros((TAGS, TAGS))
    for kind in range(len(KINDS)):
        inside = 2 + 2 * kind
        penalty[:, inside] = -1e4
        penalty[inside - 1, inside] = penalty[inside, inside] = 0.0
    return penalty


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def lstm(inputs: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, 2, N, H) of both ways, given input parts of the gates
    (T, 2, N, 4H) and recurrent weights (2, H, 4H); second: what the way back needs."""
    steps, ways, rows, _ = inputs.shape
    hidden = weight.shape[1]
    h = c = np.zeros((ways, rows, hidden), dtype=inputs.dtype)
    states, kept = np.empty((steps, ways, rows, hidden), dtype=inputs.dtype), []
    for t in range(steps):
        gates = inputs[t] + h @ weight
        open_ = _sigmoid(gates[..., : 3 * hidden])
        i, f, o = (open_[..., k * hidden : (k + 1) * hidden] for k in range(3))
        g = np.tanh(gates[..., 3 * hidden :])
        before, past = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        kept.append((i, f, o, g, before, squashed, past))
    return states, kept


def lstm_back(grad: np.ndarray, kept: list, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gates' input parts and of the recurrent weights."""
    down = np.empty((*grad.shape[:-1], 4 * grad.shape[-1]), dtype=grad.dtype)
    dh = dc = np.zeros(grad.shape[1:], dtype=grad.dtype)
    dw = np.zeros_like(weight)
    turned = weight.transpose(0, 2, 1)
    for t in reversed(range(len(grad))):
        i, f, o, g, before, squashed, past = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - squashed * squashed)
        down[t] = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g * g)],
            axis=-1,
        )
        dw += past.transpose(0, 2, 1) @ down[t]
        dh = down[t] @ turned
        dc = dc * f
    return down, dw


@dataclass
class Tagger:
    """Embedding, one LSTM each way, tag scores and CRF transitions."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int = 7, hidden: int = HIDDEN, embedding: int = EMBEDDING) -> Tagger:
        draw = np.random.default_rng(seed)

        def some(*shape: int) -> np.ndarray:
            return draw.normal(0, 1 / np.sqrt(shape[0]), shape)

        weights = {"embedding": draw.normal(0, 0.5, (SYMBOLS, embedding))}
        # The first index of these three is the way: on, back. Forget gates start open.
        weights["in"] = np.stack([some(embedding, 4 * hidden) for _ in range(2)])
        weights["bias"] = np.tile(np.repeat([0.0, 1.0, 0.0, 0.0], hidden), (2, 1, 1))
        weights["state"] = np.stack([some(hidden, 4 * hidden) for _ in range(2)])
        weights["tag"] = some(2 * hidden, TAGS)
        weights["tag_bias"] = np.zeros(TAGS)
        weights["transition"] = np.zeros((TAGS, TAGS))
        return cls(weights)

    def _forward(self, codes: np.ndarray):
        """Tag scores (T, N, tags) of symbol rows (N, T), and what training needs."""
        w = self.weights
        order = np.stack([codes.T, codes.T[::-1]], axis=1)
        by_symbol = w["embedding"] @ w["in"] + w["bias"]
        gates = np.stack([by_symbol[way][order[:, way]] for way in range(2)], axis=1)
        states, kept = lstm(gates, w["state"])
        joined = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        return joined @ w["tag"] + w["tag_bias"], (order, joined, kept)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Best tags (N, T) under tag scores and transitions, by Viterbi."""
        scores, _ = self._forward(codes)
        transition = self.weights["transition"] + allowed()
        best = scores[0] + allowed()[0]
        came = []
        for t in range(1, len(scores)):
            paths = best[:, :, None] + transition[None]
            came.append(paths.argmax(axis=1))
            best = paths.max(axis=1) + scores[t]
        tags = np.empty(codes.shape, dtype=np.int64)
        tags[:, -1] = best.argmax(axis=1)
        rows = np.arange(len(codes))
        for t in range(len(scores) - 2, -1, -1):
            tags[:, t] = came[t][rows, tags[:, t + 1]]
        return tags

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags, and its gradients."""
        w = self.weights
        scores, (order, joined, kept) = self._forward(codes)
        steps, rows, _ = scores.shape
        transition, first = w["transition"] + allowed(), allowed()[0]
        ahead = np.empty_like(scores)
        ahead[0] = scores[0] + first
        for t in range(1, steps):
            ahead[t] = _log_sum(ahead[t - 1][:, :, None] + transition[None], 1) + scores[t]
        behind = np.zeros_like(scores)
        for t in range(steps - 2, -1, -1):
            behind[t] = _log_sum(transition[None] + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        whole = _log_sum(ahead[-1], 1)
        grad = np.exp(ahead + behind - whole[None, :, None])
        pairs = np.zeros_like(transition)
        for t in range(1, steps):
            pairs += np.exp(
                ahead[t - 1][:, :, None] + transition[None] + (scores[t] + behind[t])[:, None, :]
                - whole[:, None, None]
            ).sum(axis=0)
        gold, each = tags.T, np.arange(rows)
        likelihood = np.zeros(rows)
        for t in range(steps):
            likelihood += scores[t, each, gold[t]] + (first[gold[t]] if t == 0 else transition[gold[t - 1], gold[t]])
            grad[t, each, gold[t]] -= 1
            if t:
                np.add.at(pairs, (gold[t - 1], gold[t]), -1)
        grad /= rows
        found = {"transition": pairs / rows, "tag_bias": grad.sum(axis=(0, 1))}
        found["tag"] = joined.reshape(-1, joined.shape[2]).T @ grad.reshape(-1, TAGS)
        down = grad @ w["tag"].T
        half = w["state"].shape[1]
        down = np.stack([down[..., :half], down[::-1, :, half:]], axis=1)
        gates, found["state"] = lstm_back(down, kept, w["state"])
        found["in"], found["bias"] = np.zeros_like(w["in"]), np.zeros_like(w["bias"])
        found["embedding"] = np.zeros_like(w["embedding"])
        for way in range(2):
            marks = np.zeros((steps * rows, SYMBOLS))
            marks[np.arange(steps * rows), order[:, way].ravel()] = 1.0
            by_symbol = marks.T @ gates[:, way].reshape(steps * rows, -1)
            found["in"][way] = w["embedding"].T @ by_symbol
            found["bias"][way] = by_symbol.sum(axis=0)
            found["embedding"] += by_symbol @ w["in"][way].T
        return float((whole - likelihood).mean()), found

    def fit(self, codes: np.ndarray, tags: np.ndarray, steps: int = 240, batch: int = 64,
            rate: float = 0.02, seed: int = 11) -> list[float]:
        """Adam over shuffled batches, gradients clipped; the losses."""
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            rows = draw.choice(len(codes), size=min(batch, len(codes)), replace=False)
            loss, grads = self.gradients(codes[rows], tags[rows])
            norm = np.sqrt(sum((g**2).sum() for g in grads.values()))
            slower = rate * (1.0 if step < 0.6 * steps else 0.25)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / (norm + 1e-12))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g**2
                self.weights[k] = self.weights[k] - slower * (mean[k] / (1 - 0.9**step)) / (
                    np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8
                )
            losses.append(loss)
        return losses


# -- labelled windows

def _spoken_like(kind: str, draw: np.random.Generator) -> str:
    """One made-up value of a kind, in the usual and in looser notations."""
    digits = lambda n: "".join(map(str, draw.integers(0, 10, n)))
    word = lambda: "".join(draw.choice(list("abcdefghilmnoprstuvz"), draw.integers(2, 9)))
    if kind == "email":
        name = word() + draw.choice(["", ".", "_", "-"]) + draw.choice([word(), digits(2), ""])
        at = draw.choice(["@", "@", "@", " @ ", "@ ", "(@)", "[@]"])
        return name + at + word() + draw.choice(["", digits(1)]) + draw.choice([".com", ".org", ".example.com", ".co.uk"])
    if kind == "ip":
        dot = draw.choice([".", ".", ".", " . ", "[.]"])
        return dot.join(str(v) for v in draw.integers(0, 256, 4))
    if kind == "card":
        number = digits(15)
        number += next(d for d in "0123456789" if luhn(number + d))
        gap = draw.choice(["", "", " ", "-", ".", "  "])
        return gap.join(number[k : k + 4] for k in range(0, 16, 4)) if gap else number
    country = draw.choice(["+1 ", "+49 ", "+33 ", "+", "00", "(+44) "])
    return country + draw.choice([
        f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}",
        f"{digits(3)} {digits(3)} {digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"{digits(3)}/{digits(6)}",
    ])


def _harmless(draw: np.random.Generator) -> str:
    """Made-up text with digits or signs that is no personal data."""
    digits = lambda n: "".join(map(str, draw.integers(0, 10, n)))
    return str(draw.choice([
        f"version {draw.integers(0, 20)}.{draw.integers(0, 20)}", f"{draw.integers(1900, 2100)}", digits(3),
        f"{digits(2)}:{digits(2)}", f"{draw.integers(1, 29)}/{draw.integers(1, 13)}/{draw.integers(1990, 2030)}",
        f"@{'ab' + digits(1)}", f"{digits(1)},{digits(3)},{digits(3)}", f"${digits(3)}.{digits(2)}", f"{digits(8)}",
        f'"{"".join(draw.choice(list("0123456789abcdef"), 24))}"', f"[{digits(2)}]", f"v{digits(1)}.{digits(1)}.{digits(1)}",
    ]))


def tags_of(length: int, spans: list[tuple[int, int, str]], start: int = 0) -> np.ndarray:
    """Tags of a window of ``length`` characters from ``start``; a span that begins
    before the window goes on inside it."""
    tags = np.zeros(length, dtype=np.int64)
    for first, last, kind in spans:
        inside = 2 + 2 * KINDS.index(kind)
        if first < start + length and last > start:
            tags[max(0, first - start) : last - start] = inside
            tags[max(0, first - start)] = inside - 1
    return tags


def training_windows(texts: list[str], windows: int = TRAIN_WINDOWS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of windows of ``WINDOW`` characters.

    Labelled spans are those the fixed patterns find in the texts, plus made-up
    values in usual and looser notations, and harmless numbers, put between
    words of windows without any.
    """
    draw = np.random.default_rng(seed)
    found, plain = [], []
    for text in texts:
        spans = base_spans(text)
        for first, _, _ in spans[:8]:
            start = max(0, first - int(draw.integers(0, WINDOW - 8)))
            found.append((text[start : start + WINDOW], tags_of(WINDOW, spans, start)))
        for start in draw.integers(0, max(1, len(text) - WINDOW), 3):
            part = text[start : start + WINDOW]
            if not SIGNAL.search(part):
                plain.append(part)
    plain = plain or ["and so it goes on and on "]
    draw.shuffle(found)
    codes, tags = [], []
    for k in range(windows):
        if k < min(len(found), windows // 3):
            text, own = found[k]
        else:
            text = plain[int(draw.integers(0, len(plain)))]
            cuts = [m.start() for m in re.finditer(r"\s", text[: WINDOW - 16])] or [0]
            cut = cuts[int(draw.integers(0, len(cuts)))]
            value, own = "", []
            # One value, two side by side, or a harmless number.
            for n in range(0 if k % 5 == 0 else 1 + (k % 3 == 0)):
                kind = KINDS[(k + n * int(draw.integers(0, 4))) % 4]
                first, value = len(value) + (n > 0), value + " " * (n > 0) + _spoken_like(kind, draw)
                own.append((cut + 1 + first, cut + 1 + len(value), kind))
            value = value or _harmless(draw)
            text = f"{text[:cut]} {value}{draw.choice(['', '', '.', ','])} {text[cut:]}"[:WINDOW]
            own = tags_of(WINDOW, own)
        codes.append(symbols(text.ljust(WINDOW, "\n")))
        tags.append(own)
    return np.array(codes), np.array(tags)


def train(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS, windows: int = TRAIN_WINDOWS, **fit) -> Tagger:
    """A tagger fitted to windows of about ``sample`` documents, drawn by a hash of the
    text. Only pieces of at most 4,000 characters reach the driver."""
    texts = docs.select("text").where("text is not null")
    rows = docs.count()  # null texts included, as files know it without a scan
    if rows:
        share = F.lit(min(1.0, sample / rows) * 2.0**63)
        drawn = texts.where(F.shiftrightunsigned(F.xxhash64("text"), 1).cast("double") <= share)
        # Around the first sign of personal data, else from the start.
        at = F.greatest(F.regexp_instr("text", F.lit("[0-9@]")) - 400, F.lit(1))
        parts = drawn.select(F.substring("text", at, F.lit(4000)).alias("part")).distinct()
        found = [row["part"] for row in parts.orderBy(F.xxhash64("part"), "part").limit(sample).collect()]
    else:
        found = []
    tagger = Tagger.fresh()
    tagger.fit(*training_windows(found, windows), **fit)
    return tagger


# -- decoding

def windows_of(text: str) -> list[int]:
    """Starts of the windows to decode: of a grid of overlapping windows, those that
    hold a digit or @. A span must hold one, so the others give none."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    starts: set[int] = set()
    for found in SIGNAL.finditer(text):
        at = found.start()
        for k in range(max(0, (at - WINDOW) // STRIDE + 1), min(last, at // STRIDE) + 1):
            starts.add(k * STRIDE)
    return sorted(starts)


def reconcile(length: int, starts: list[int], tags: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of a whole text from the tags of its windows: every character takes the
    tag of the window in which it lies deepest, then runs are read off."""
    spans, open_, last_end = [], None, -1
    index = {start: k for k, start in enumerate(starts)}
    marked = {start + int(k) for start, row in zip(starts, tags) for k in np.flatnonzero(row)}
    depth: dict[int, int] = {}
    for at in marked:
        best = -1
        for start in range(max(0, (at - WINDOW) // STRIDE + 1) * STRIDE, at + 1, STRIDE):
            if start in index and at < length:
                left = at - start if start else WINDOW
                right = start + WINDOW - 1 - at if start + WINDOW < length else WINDOW
                if min(left, right) > best:
                    best = min(left, right)
                    depth[at] = int(tags[index[start], at - start])
    for at in sorted(depth):
        tag = depth[at]
        kind = (tag - 1) // 2 if tag else None
        begins = tag and tag % 2 == 1
        if open_ and (at != last_end or kind != open_[1] or begins):
            spans.append((open_[0], last_end, KINDS[open_[1]]))
            open_ = None
        if tag and not open_:
            open_ = (at, kind)
        last_end = at + 1
    if open_:
        spans.append((open_[0], last_end, KINDS[open_[1]]))
    return spans


def plausible(text: str, start: int, end: int, kind: str) -> tuple[int, int, str] | None:
    """A span without outer white space and punctuation, if it has what its kind needs."""
    part = text[start:end]
    lead = len(part) - len(part.lstrip(" \t\n\r.,;:"))
    part = part.strip(" \t\n\r.,;:")
    digits = len(only_digits(part))
    fits = {
        "email": re.fullmatch(r"\S+\s?[(\[]?@[)\]]?\s?[^\s@]+\.[^\s@]+", part) is not None,
        "ip": len(re.findall(r"[0-9]+", part)) == 4 and all(int(v[:4]) <= 255 for v in re.findall(r"[0-9]+", part)),
        "card": 12 <= digits <= 19 and luhn(only_digits(part)),
        "phone": 9 <= digits <= 15 and not re.search(r"[A-Za-z]", part),
    }[kind]
    start, end = start + lead, start + lead + len(part)
    # A value does not begin or end within a word.
    whole = not (start and text[start - 1].isalnum()) and not text[end : end + 1].isalnum()
    return (start, end, kind) if fits and whole else None


def find_all(tagger: Tagger, texts: list[str]) -> list[tuple[list, list]]:
    """Base spans and all spans of whole texts; the model adds spans that overlap no
    base span."""
    starts = [windows_of(text) for text in texts]
    codes = [
        symbols(text[start : start + WINDOW].ljust(WINDOW, "\n"))
        for text, own in zip(texts, starts) for start in own
    ]
    tags = [tagger.decode(np.array(codes[k : k + 512])) for k in range(0, len(codes), 512)]
    tags = np.concatenate(tags) if tags else np.zeros((0, WINDOW), dtype=np.int64)
    found, at = [], 0
    for text, own in zip(texts, starts):
        base = base_spans(text)
        spans = list(base)
        for start, end, kind in reconcile(len(text), own, tags[at : at + len(own)]):
            span = plausible(text, start, end, kind)
            if span and all(span[1] <= s or span[0] >= e for s, e, _ in spans):
                spans.append(span)
        at += len(own)
        found.append((base, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))))
    return found


SPANS = "array<struct<start: int, end: int, kind: string>>"


def spans_of(tagger: Tagger, text) -> F.Column:
    """Column (base, spans) of a text column: spans by the fixed patterns, and all spans.

    Null and empty texts have none; texts count whole, however long; offsets
    are code points, ends exclusive.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            base, spans = [], []
            whole = [t if isinstance(t, str) else "" for t in texts]
            for start in range(0, len(whole), 256):
                for own, all_ in find_all(tagger, whole[start : start + 256]):
                    base.append([{"start": s, "end": e, "kind": k} for s, e, k in own])
                    spans.append([{"start": s, "end": e, "kind": k} for s, e, k in all_])
            yield pd.DataFrame({"base": base, "spans": spans})

    return F.pandas_udf(run, f"struct<base: {SPANS}, spans: {SPANS}>")(text)


def find_personal_data(docs: DataFrame, tagger: Tagger, out: str = "personal") -> DataFrame:
    """``docs`` with the struct ``out`` (base, spans). One projection, no shuffle; repeated
    rows get equal spans, an ``out`` the table has is replaced."""
    return docs.drop(out).withColumn(out, spans_of(tagger, F.col("text")))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with spans replaced by their kind in angle brackets; of overlapping
    spans the first counts."""
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
            at = end
    return "".join(parts) + text[at:]
