"""The value functions as temporary SQL functions of a session.

They take text, which Spark also makes of dates and numbers passed in, and are
expanded into the calling query like a view, so they run as built-in
expressions. Only the key derivation is a (vectorized) Python function.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.functions import dates, people, places, text
from maskflow.functions.vocabulary import FIRST_NAMES, LAST_NAMES, default_given_names
from maskflow.operators.cities import NOT_A_ZIP, UNKNOWN, numbered_cities, table_bytes
from maskflow.plans.salts import Salts

STRING = T.StringType()


def _redrawn(values) -> str:
    """A value drawn at random, and once more if it equals ``c``. The lambda
    holds the first draw, which is looked at twice."""
    listed = f"array({text.literals(values)})"
    return (
        f"get(transform(array(CAST(floor(rand() * {len(values)}) AS INT)), i -> "
        f"CASE WHEN lower(get({listed}, i)) = lower(c) THEN {people.pick(values, 'rand()')} "
        f"ELSE get({listed}, i) END), 0)"
    )


def register_sql(
    spark: SparkSession,
    as_of_year: int | None = None,
    given_names: dict | None = None,
    cities: DataFrame | None = None,
    salts: Salts | None = None,
    salt_keys: Iterable[str] = (),
    broadcast_bytes: int = 64 << 20,
) -> list[str]:
    """Create the functions in the session; returns their names.

    ``CityTransform`` needs the postal table ``cities`` (zip, city), and
    ``PBEKeyHash(value, salt_key)`` the ``salts`` under ``salt_keys``: they are
    bound to the function here, and queries name them by their keys alone.
    """
    as_of = as_of_year or datetime.date.today().year
    given = given_names or default_given_names()
    day, stamp = dates.text_to_date("c"), dates.text_to_stamp("c")
    days = dates.shift_days("patient", "rand()")
    functions = {
        "CleanseData(c STRING) RETURNS STRING": text.clean_lines("c"),
        "Zip3(c STRING) RETURNS STRING": places.zip3("c"),
        "Ethnicity(c STRING) RETURNS STRING": people.ethnic_group("c"),
        "DateScrub(c STRING) RETURNS TIMESTAMP_NTZ": dates.year_only("c", STRING, as_of),
        "DateDayTransform(c STRING) RETURNS TIMESTAMP_NTZ": dates.day_cut("c", STRING, as_of),
        "DateTimeDayTransform(c STRING) RETURNS TIMESTAMP_NTZ": (
            dates.day_cut_keep_time("c", STRING, as_of)
        ),
        "DateShiftTransform(c STRING, patient STRING) RETURNS DATE": dates.shift_date(day, days),
        "DateTimeShiftTransform(c STRING, patient STRING) RETURNS TIMESTAMP_NTZ": (
            dates.shift_stamp(stamp, days)
        ),
        "EpochStart(c STRING) RETURNS DATE": dates.epoch_start(day, "rand()"),
        "FirstName(c STRING) RETURNS STRING": people.pick(FIRST_NAMES, "rand()"),
        "LastName(c STRING) RETURNS STRING": people.pick(LAST_NAMES, "rand()"),
        "oncoemrFirstName(c STRING, gender STRING) RETURNS STRING": (
            f"CASE WHEN c IS NOT NULL THEN CASE WHEN lower(gender) = 'female' "
            f"THEN {_redrawn(given['female'])} ELSE {_redrawn(given['male'])} END END"
        ),
    }
    if cities is not None:
        # Two lookups, of an area's size and of one place in it.
        known = cities.where(F.length("zip") >= 3)
        sizes, numbered = numbered_cities(known, table_bytes(known, "city") > broadcast_bytes)
        sizes.createOrReplaceTempView("maskflow_areas")
        numbered.createOrReplaceTempView("maskflow_places")
        functions["maskflow_area_size(area STRING) RETURNS BIGINT"] = (
            "(SELECT max(n) FROM maskflow_areas WHERE zip3 = area)"
        )
        functions["maskflow_city_at(area STRING, at BIGINT) RETURNS STRING"] = (
            "(SELECT max(city) FROM maskflow_places WHERE zip3 = area AND place = at)"
        )
        area = "CASE WHEN length(c) >= 3 THEN left(c, 3) END"
        drawn = f"CAST(floor(rand() * maskflow_area_size({area})) AS BIGINT)"
        functions["CityTransform(c STRING) RETURNS STRING"] = (
            f"CASE WHEN c IS NULL THEN NULL WHEN length(c) < 3 THEN '{NOT_A_ZIP}' "
            f"ELSE coalesce(maskflow_city_at({area}, {drawn}), '{UNKNOWN}') END"
        )
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    names = [signature.split("(")[0] for signature in functions]
    if salts is not None:
        spark.udf.register("PBEKeyHash", pbe_key_hash_udf(salts.resolve(salt_keys)))
        names.append("PBEKeyHash")
    return [name for name in names if not name.startswith("maskflow_")]


def pbe_key_hash_udf(salts: dict[str, str]):
    """PBEKeyHash(value, salt_key) for SQL; null and empty texts stay as they are.

    A task keeps the keys it has derived, up to a bound on its memory.
    """

    @F.pandas_udf("string")
    def pbe_key_hash(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        import hashlib

        blanks = "".join(map(chr, range(0x21)))
        known: dict[tuple[str, str], str] = {}
        for values, names in batches:
            if len(known) > 100_000:
                known.clear()
            for value, name in set(zip(values, names)) - known.keys():
                if name not in salts:
                    raise KeyError(f"no salt bound under key {name!r}")
                if value is None or value == "":
                    known[value, name] = value
                else:
                    known[value, name] = hashlib.pbkdf2_hmac(
                        "sha1", value.strip(blanks).encode(), salts[name].encode(), 2016, 64
                    ).hex()
            yield pd.Series([known[pair] for pair in zip(values, names)], dtype=object)

    return pbe_key_hash
