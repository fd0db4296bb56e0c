"""Places: zip areas."""

from __future__ import annotations

from pyspark.sql import types as T

from maskflow.functions.text import literals
from maskflow.functions.vocabulary import RESTRICTED_ZIP3


def zip_text(c: str, dtype: T.DataType) -> str:
    """A zip as text; whole numbers get back the leading zeros they lost."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.IntegralType):
        digits = f"CAST({c} AS STRING)"
        return f"lpad({digits}, CASE WHEN length({digits}) <= 5 THEN 5 ELSE 9 END, '0')"
    raise ValueError(f"a zip strategy cannot read {dtype.simpleString()}")


def zip3(c: str) -> str:
    """First three digits and "00", or "00000" for restricted areas.

    Shorter texts are filled up with zeros; null and the word "null" give null.
    """
    area, restricted = f"substring({c}, 1, 3)", literals(RESTRICTED_ZIP3)
    return (
        f"CASE WHEN length({c}) = 4 AND lower({c}) = 'null' THEN NULL "
        f"WHEN {area} IN ({restricted}) THEN '00000' "
        f"WHEN length({c}) >= 3 THEN concat({area}, '00') "
        f"WHEN rpad({c}, 3, '0') IN ({restricted}) THEN '00000' "
        f"ELSE rpad({c}, 5, '0') END"
    )
