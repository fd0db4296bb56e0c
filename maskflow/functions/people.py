"""People: replacement names, age and year caps, ethnic groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from maskflow.functions.text import literal, literals
from maskflow.functions.vocabulary import (
    ETHNIC_GROUPS,
    PACIFIC_LABEL_COMPAT,
    PACIFIC_TERMS,
)


def keyed_chance(value: str, salt: str) -> str:
    """A number from 0 up to 1 that depends on the value and the salt only."""
    digest = f"md5(concat_ws('|', {salt}, coalesce({value}, '')))"
    return f"(CAST(conv(substring({digest}, 1, 8), 16, 10) AS BIGINT) / {2**32}D)"


def _at(listed: str, chance: str, size: int | str) -> str:
    return f"get({listed}, CAST(floor({chance} * {size}) AS INT))"


def pick(names: Sequence[str], chance: str) -> str:
    """The name at ``chance`` of the way through the list."""
    return _at(f"array({literals(names)})", chance, len(names))


def given_name(
    name: str,
    gender: str,
    female: Sequence[str],
    male: Sequence[str],
    first: str,
    second: str,
) -> str:
    """A first name from the list of the gender, drawn once more if it came out equal."""
    is_female = f"coalesce(lower({gender}) = 'female', false)"
    names = f"if({is_female}, array({literals(female)}), array({literals(male)}))"
    size = f"if({is_female}, {len(female)}, {len(male)})"
    drawn = _at(names, first, size)
    return (
        f"CASE WHEN {name} IS NULL THEN NULL WHEN lower({drawn}) = lower({name}) "
        f"THEN {_at(names, second, size)} ELSE {drawn} END"
    )


def cap_age(c: str, dtype: T.DataType) -> str:
    """At most 90; null and NaN become null. Text is read as whole years."""
    if isinstance(dtype, T.StringType):
        c = f"floor(nanvl(try_cast({c} AS DOUBLE), CAST(NULL AS DOUBLE)))"
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = f"CASE WHEN NOT isnan({c}) THEN {c} END"
    elif not isinstance(dtype, T.NumericType):
        raise ValueError(f"Age cannot read {dtype.simpleString()}")
    return f"CASE WHEN {c} IS NOT NULL THEN least({c}, 90) END"


def floor_year(c: str, dtype: T.DataType, as_of: int) -> str:
    """A numeric year, at least 90 years back."""
    if isinstance(dtype, T.StringType):
        c = f"try_cast({c} AS INT)"
    elif not isinstance(dtype, T.NumericType):
        raise ValueError(f"MaxYear cannot read {dtype.simpleString()}")
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({c}, {as_of - 90}) END"


def ethnic_group(c: str, other: str = "White", compat: bool = False) -> str:
    """Group label of a term in any case; ``other`` for terms on no list.

    The lists are all looked at in an array of hits, as the lower-case term is
    then made once; branches of a CASE would each make it again.
    """
    labels = [
        PACIFIC_LABEL_COMPAT if compat and terms is PACIFIC_TERMS else label
        for label, terms in ETHNIC_GROUPS
    ]
    hits = ", ".join(f"lower({c}) IN ({literals(terms)})" for _, terms in ETHNIC_GROUPS)
    first = f"CAST(array_position(array({hits}), true) AS INT)"
    null = "''" if compat else "NULL"
    return (
        f"CASE WHEN {c} IS NULL THEN {null} "
        f"ELSE get(array({literal(other)}, {literals(labels)}), {first}) END"
    )
