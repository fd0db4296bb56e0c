"""Synthetic patients, encounters and heart rates.

Every value is picked by a digest of seed, field and row id. Rows thus depend
neither on partitioning nor on retries, and any range of ids can be made by
itself. Ids come as a DataFrame: a range, or the keys of an existing table. As
one id can make hundreds of rows, ids of few partitions should be spread over
more of them first (``repartition``), which moves the ids only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOTES = "Seen in clinic today.\nVital signs stable, no acute complaints.\nReturn as needed."


@dataclass(frozen=True)
class Cohort:
    """What is picked from; spans are (first, number of values)."""

    # The lists and spans of the standard cohort.
    first_names: tuple[str, ...] = ("Sam", "Leslie", "Regan", "Alex", "Sasha")
    last_names: tuple[str, ...] = ("Lung", "Chiu", "Rosenblum", "Kindy", "O'Riordan", "Allen")
    genders: tuple[str, ...] = ("F", "M")
    races: tuple[str, ...] = ("Hispanic", "Eskimo")
    visit_types: tuple[str, ...] = ("Office Visit", "Test", "ER")
    record_numbers: tuple[int, int] | None = (1_000_000, 8_999_999)
    zips: tuple[int, int] = (10_000, 89_999)
    zip_as_text: bool = True
    birth_years: tuple[int, int] = (1950, 49)
    visit_years: tuple[int, int] = (2000, 16)
    months: tuple[int, int] = (1, 11)
    days: tuple[int, int] = (1, 27)
    staff_ids: tuple[int, int] = (1_000_000, 8_999_999)
    rates: tuple[int, int] = (40, 60)
    readings: int = 361
    step_millis: int = 60


# The batch cohort, whose ids are random and whose readings
# follow the encounters.
BATCH_COHORT = Cohort(
    first_names=("Sam", "Leslie", "Regan", "Alex", "Sean"),
    genders=("M", "F"),
    record_numbers=None,
    zips=(10_000, 90_000),
    zip_as_text=False,
    birth_years=(1950, 50),
    visit_years=(2000, 17),
    months=(1, 12),
    days=(1, 28),
    staff_ids=(1_000_000, 99_000_000),
    rates=(40, 61),
    readings=24,
    step_millis=10_000,
)
BATCH_IDS = (1, 99_999_999)


class _Picker:
    def __init__(self, seed: int, row: Column):
        self.seed, self.row = seed, row

    def number(self, field: str, span: tuple[int, int], *more: Column) -> Column:
        first, size = span
        parts = [F.lit(f"{self.seed}|{field}"), self.row.cast("string")]
        parts += [c.cast("string") for c in more]
        digest = F.md5(F.concat_ws("|", *parts))
        draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
        return draw % F.lit(size).cast("bigint") + F.lit(first).cast("bigint")

    def one_of(self, field: str, choices: tuple[str, ...]) -> Column:
        listed = F.array(*[F.lit(choice) for choice in choices])
        return F.get(listed, self.number(field, (0, len(choices))).cast("int"))

    def date(self, field: str, years: tuple[int, int], cohort: Cohort) -> Column:
        return F.make_date(
            self.number(f"{field}_year", years).cast("int"),
            self.number(f"{field}_month", cohort.months).cast("int"),
            self.number(f"{field}_day", cohort.days).cast("int"),
        )


def id_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Patient ids 1 to n."""
    ids = spark.range(1, n + 1, numPartitions=partitions)
    return ids.select(F.col("id").alias("patient_id"))


def batch_ids(
    spark: SparkSession, n: int, seed: int, partitions: int | None = None
) -> DataFrame:
    """n patient ids picked at random, some of which may come twice, with their row 0 to n-1."""
    picker = _Picker(seed, F.col("id"))
    rows = spark.range(0, n, numPartitions=partitions)
    return rows.select(
        picker.number("patient", BATCH_IDS).alias("patient_id"), F.col("id").alias("row")
    )


def patients(ids: DataFrame, seed: int, cohort: Cohort = Cohort()) -> DataFrame:
    """One patient per row of ``ids`` (patient_id)."""
    pick = _Picker(seed, F.col("patient_id"))
    record = []
    if cohort.record_numbers:
        number = pick.number("record", cohort.record_numbers)
        record.append(number.cast("string").alias("patient_mrn"))
    zip_code = pick.number("zip", cohort.zips)
    return ids.select(
        "patient_id",
        *record,
        pick.one_of("first_name", cohort.first_names).alias("first_name"),
        pick.one_of("last_name", cohort.last_names).alias("last_name"),
        pick.date("birth", cohort.birth_years, cohort).alias("dob"),
        pick.one_of("gender", cohort.genders).alias("gender"),
        pick.one_of("race", cohort.races).alias("race"),
        (zip_code.cast("string") if cohort.zip_as_text else zip_code).alias("zip"),
    )


def encounters(
    ids: DataFrame, per_patient: int, seed: int, cohort: Cohort = Cohort()
) -> DataFrame:
    """``per_patient`` encounters for every row of ``ids``."""
    visit = F.explode(F.sequence(F.lit(1), F.lit(per_patient)))
    pick = _Picker(seed, F.concat_ws("-", F.col("patient_id"), F.col("visit")))
    return ids.select("patient_id", visit.alias("visit")).select(
        "patient_id",
        pick.number("physician", cohort.staff_ids).alias("physician_id"),
        pick.number("location", cohort.staff_ids).alias("location_id"),
        pick.one_of("visit_type", cohort.visit_types).alias("visit_type"),
        pick.date("visit", cohort.visit_years, cohort).alias("encounter_date"),
        F.lit(NOTES).alias("notes"),
    )


def _readings(starts: DataFrame, pick: _Picker, cohort: Cohort) -> DataFrame:
    """Readings at even steps from each (patient_id, start)."""
    reading = F.explode(F.sequence(F.lit(0), F.lit(cohort.readings - 1)))
    passed = F.col("reading") * F.lit(cohort.step_millis)
    return starts.select("*", reading.alias("reading")).select(
        "patient_id",
        (
            F.col("start").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), passed / F.lit(1000))
        ).alias("timestamp"),
        pick.number("rate", cohort.rates, F.col("reading")).alias("heartrate"),
    )


def heart_rates(ids: DataFrame, seed: int, cohort: Cohort = Cohort()) -> DataFrame:
    """A series of readings for every row of ``ids``, from a day of its own."""
    pick = _Picker(seed, F.col("patient_id"))
    start = pick.date("series", cohort.visit_years, cohort)
    return _readings(ids.select("patient_id", start.alias("start")), pick, cohort)


def heart_rates_of(visits: DataFrame, seed: int, cohort: Cohort = BATCH_COHORT) -> DataFrame:
    """A series of readings for every encounter, from midnight of its date."""
    starts = visits.select(
        "patient_id", F.col("encounter_date").alias("start"), "physician_id", "location_id"
    )
    row = F.concat_ws("-", F.col("patient_id"), F.col("physician_id"), F.col("location_id"))
    return _readings(starts, _Picker(seed, row), cohort)
