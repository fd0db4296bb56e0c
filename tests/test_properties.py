"""Strategies and fixed-width lines against plain Python on arbitrary input."""

import datetime as dt
import re

from support import AS_OF, make_policy
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from maskflow import MaskOptions, deidentify
from maskflow.functions.vocabulary import SHIFT_DAYS
from maskflow.sources.fixedwidth import Field, format_lines, split_lines

few = settings(max_examples=6, deadline=None, phases=[Phase.generate])

dates = st.dates(dt.date(1850, 1, 1), dt.date(2150, 12, 31))
date_texts = st.one_of(
    st.none(),
    dates.map(lambda d: d.isoformat()),
    dates.map(lambda d: f"{d.month}/{d.day}/{d.year:04d}"),
    dates.map(lambda d: f"{d:%m/%d/%Y}"),
    st.datetimes(dt.datetime(1850, 1, 1), dt.datetime(2150, 1, 1)).map(
        lambda t: t.isoformat(" ", "milliseconds")
    ),
    st.datetimes(dt.datetime(1850, 1, 1), dt.datetime(2150, 1, 1)).map(
        lambda t: t.isoformat("T", "seconds")
    ),
    st.from_regex(r"\A\d{1,4}[-/]\d{1,2}[-/]\d{1,4}\Z"),
    st.sampled_from(["", " ", "NULL", "null", "2001", "2001-02", "2001-2-3", " 2001-02-03", "2001-02-30"]),
    # whole dates with something behind them
    st.tuples(dates, st.sampled_from([" soon", "Tgarbage", " 10:11:12 x", " 25:00:00", "x", " ", "T"])).map(
        lambda pair: f"{pair[0]:%Y-%m-%d}{pair[1]}"
    ),
).filter(lambda text: "0000" not in (text or ""))  # Python has no year 0


def python_stamp(text):
    """The instant a text stands for, or None."""
    if text is None:
        return None
    iso = re.fullmatch(r"(\d{4})-(\d{2})-(\d{2})(?:[ T](\d{2}):(\d{2}):(\d{2})(?:\.(\d+))?)?", text, re.A)
    slash = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{4})", text, re.A)
    try:
        if iso:
            y, m, d, *time = iso.groups()
            micros = int((time[3] or "0").ljust(6, "0")[:6])
            return dt.datetime(int(y), int(m), int(d), *(int(t or 0) for t in time[:3]), micros)
        if slash:
            m, d, y = map(int, slash.groups())
            return dt.datetime(y, m, d)
    except ValueError:
        return None
    return None


@few
@given(st.lists(st.tuples(date_texts, st.sampled_from([f"p{i}" for i in range(10)])), min_size=30, max_size=60))
def test_date_strategies(spark, salts, rows):
    df = spark.createDataFrame(
        [(i, t, t, t, t, t, p) for i, (t, p) in enumerate(rows)],
        "i int, year string, day string, time string, shift string, stamp string, patientid string",
    )
    policy = make_policy(
        {"i": "Identity", "year": "Year", "day": "DateDay", "time": "DateTimeDay", "shift": "DateShift",
         "stamp": "DateTimeShift"}
    )
    out = deidentify(df, policy, salts, MaskOptions(as_of_year=AS_OF)).orderBy("i").collect()
    for row, (text, patient) in zip(out, rows):
        at = python_stamp(text)
        if at is None:
            assert tuple(row)[1:] == (None,) * 5, text
            continue
        days = dt.timedelta(days=SHIFT_DAYS[int(patient[-1])])
        assert row["year"] == dt.datetime(max(at.year, AS_OF - 90), 1, 1), text
        assert row["day"] == dt.datetime(max(at.year, AS_OF - 89), 1, 1), text
        assert row["time"] == dt.datetime.combine(dt.date(max(at.year, AS_OF - 89), 1, 1), at.time()), text
        assert row["shift"] == at.date() + days, text
        assert row["stamp"] == at + days, text


LAYOUT = [Field("n", 8, "9"), Field("t", 7, "X"), Field("d", 10, "YYYY-MM-DD"), Field("x", 24, "-9.99")]
words = st.text(st.characters(min_codepoint=0x21, max_codepoint=0x2FF, exclude_categories=["Z", "C"]), max_size=7)


@few
@given(
    st.lists(
        st.tuples(
            st.integers(-9_999_999, 99_999_999),
            words,
            st.one_of(st.none(), st.dates(dt.date(1, 1, 1), dt.date(9999, 12, 31))),
            st.floats(allow_nan=False, allow_infinity=False, width=32),
        ),
        min_size=20,
        max_size=60,
    )
)
def test_fixed_width_roundtrip(spark, rows):
    df = spark.createDataFrame(rows, "n bigint, t string, d date, x double").coalesce(1)
    lines = format_lines(df, LAYOUT)
    for mode in ("FAILFAST", "PERMISSIVE"):
        back = split_lines(lines, LAYOUT, mode).select("n", "t", "d", "x").collect()
        assert [tuple(row) for row in back] == rows


def python_tokens(line):
    """What the rules say about a line: values, or None for a faulty one."""
    if len(line) < 49:
        return None
    blanks = "".join(map(chr, range(33)))
    parts, start = [], 0
    for item in LAYOUT:
        parts.append(line[start : start + item.length].strip(blanks))
        start += item.length
    number, text, day, amount = parts
    value = int(number) if re.fullmatch(r"[+-]?\d+", number, re.A) else 0
    if day:
        dash = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)", day, re.A)
        slash = re.fullmatch(r"(\d{1,2})/(\d{1,2})/(\d{2,4})", day, re.A)
        try:
            if dash:
                day = dt.date(*map(int, dash.groups()))
            elif slash:
                day = dt.date(int(slash[3]), int(slash[1]), int(slash[2]))
            else:
                return None
        except ValueError:
            return None
    if amount == "Z":
        amount = 0.0
    else:
        if not re.fullmatch(r"[+-]?\d+(\.\d*)?", amount, re.A):
            return None
        amount = float(amount)
    return value, text, day or None, amount


def padded(values, width):
    return values.map(lambda v: v[:width].ljust(width))


number_tokens = st.one_of(st.integers(-999, 99999).map(str), st.sampled_from(["", "~", "12a", "+7", "1.5", "\t3"]))
day_tokens = st.one_of(
    dates.map(str), dates.map(lambda d: f"{d.month}/{d.day}/{d.year}"), dates.filter(lambda d: d.year % 100).map(lambda d: f"{d:%m/%d/%y}"),  # no year 0
    st.sampled_from(["", "\t", "soon", "13/01/2001", "2001-02-30", "1/2/3", "1000-01-01"]),
)
amount_tokens = st.one_of(
    st.integers(0, 99999).map(lambda n: f"{n / 100:.2f}"), st.sampled_from(["Z", "ten", "", "-5", "3."])
)
random_lines = st.builds(
    lambda *parts: "".join(parts),
    padded(number_tokens, 8), padded(words, 7), padded(day_tokens, 10), padded(amount_tokens, 24),
    st.sampled_from(["", "", "tail"]),
)


@few
@given(st.lists(st.one_of(random_lines, random_lines.map(lambda v: v[:40])), min_size=30, max_size=60))
def test_random_lines(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    out = split_lines(df, LAYOUT, "PERMISSIVE").collect()
    for row, line in zip(out, lines):
        want = python_tokens(line)
        assert (row["_corrupt_record"] is None) == (want is not None), line
        if want is not None:
            assert tuple(row)[:4] == want, line
        else:
            assert row["_corrupt_record"] == line
