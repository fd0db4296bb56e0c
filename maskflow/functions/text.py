"""Text: literals, line-break cleansing, salted hashes and key derivation."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """A text as an SQL literal."""
    value = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c >= " " else f"\\u{ord(c):04x}" for c in value) + "'"


def literals(values: Iterable[str]) -> str:
    return ", ".join(literal(value) for value in values)


# The characters trimmed as white space around tokens and
# before key derivation, U+0000 to U+0020.
BLANKS = literal("".join(map(chr, range(0x21))))


def secret(spark: SparkSession, value: str) -> Column:
    """A text constant that plans, explain() and event logs do not show.

    It is read through a scalar subquery over a one-row local table, which
    costs no job and is evaluated once per query.
    """
    return spark.createDataFrame(pa.table({"value": [value]})).select("value").scalar()


def clean_lines(c: str) -> str:
    """Every line feed and carriage return becomes a space.

    Two replacements are several times faster than one ``translate``.
    """
    return rf"replace(replace({c}, '\n', ' '), '\r', ' ')"


def strip_blanks(c: str) -> str:
    return f"btrim({c}, {BLANKS})"


def salted_hash(c: str, salt: str, bits: int = 512, is_text: bool = True) -> str:
    """Hex SHA-2 of the text without surrounding spaces, followed by the salt.

    Null stays null and the empty text stays empty. For numbers and dates cast
    to text (``is_text`` unset) there is nothing to trim and no empty text.
    """
    if not is_text:
        return f"sha2(concat({c}, {salt}), {bits})"
    return f"CASE WHEN {c} = '' THEN {c} ELSE sha2(concat(trim({c}), {salt}), {bits}) END"


def pbkdf2_udf(salts: list[str]):
    """Pandas UDF of (place in ``salts``, text): hex PBKDF2-HMAC-SHA1, 2016 rounds, 512 bits.

    It is defined locally so that executors need no copy of this package. A
    task keeps the keys it has derived, up to a bound on its memory.
    """

    @F.pandas_udf("string")
    def pbkdf2(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import hashlib

        keys = [salt.encode("utf-8") for salt in salts]
        known: dict[tuple[int, str], str] = {}
        for places, values in batches:
            if len(known) > 100_000:
                known.clear()
            found = []
            for pair in zip(places, values):
                if pair[1] is None:
                    found.append(None)
                    continue
                if pair not in known:
                    known[pair] = hashlib.pbkdf2_hmac(
                        "sha1", pair[1].encode("utf-8"), keys[pair[0]], 2016, 64
                    ).hex()
                found.append(known[pair])
            yield pd.Series(found, dtype=object)

    return pbkdf2
