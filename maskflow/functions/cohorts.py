"""Synthetic cohorts as SQL table functions.

    SELECT p.* FROM people, LATERAL patients(people.id, 7) p

A function makes the rows of one id; beside a table of ids it becomes part of the query's
plan, a projection or an explode where the ids are, so the table's partitions are kept.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from maskflow.functions.text import literal, literals
from maskflow.operators.generate import NOTES, Cohort


def _number(field: str, span: tuple[int, int], row: str, more: str = "") -> str:
    """A whole number of a span, by digest of seed, field and row."""
    first, size = span
    more = f", {more}" if more else ""
    text = f"concat_ws('|', concat(seed, {literal('|' + field)}), {row}{more})"
    return f"(cast(conv(substr(md5({text}), 1, 8), 16, 10) AS bigint) % {size}L + {first}L)"


def _one_of(field: str, choices: tuple[str, ...], row: str) -> str:
    return f"get(array({literals(choices)}), cast({_number(field, (0, len(choices)), row)} AS int))"


def _date(field: str, years: tuple[int, int], cohort: Cohort, row: str) -> str:
    spans = {"year": years, "month": cohort.months, "day": cohort.days}
    parts = [f"cast({_number(f'{field}_{part}', span, row)} AS int)" for part, span in spans.items()]
    return f"make_date({', '.join(parts)})"


def cohort_functions(cohort: Cohort = Cohort()) -> dict[str, str]:
    """Parameters, columns and body of ``patients(id, seed)``, ``encounters(id, per_patient,
    seed)`` and ``heart_rates(id, seed)``: the rows that the generators of a cohort make for
    the patient id."""
    row = "cast(id AS string)"
    record = f"cast({_number('record', cohort.record_numbers, row)} AS string)," if cohort.record_numbers else ""
    zip_code = _number("zip", cohort.zips, row)
    visit = "concat_ws('-', id, visit)"
    return {
        "patients": f"""(id BIGINT, seed BIGINT) RETURNS TABLE(
            patient_id BIGINT, {"patient_mrn STRING," if record else ""} first_name STRING, last_name STRING,
            dob DATE, gender STRING, race STRING, zip {"STRING" if cohort.zip_as_text else "BIGINT"})
            RETURN SELECT id, {record} {_one_of("first_name", cohort.first_names, row)},
            {_one_of("last_name", cohort.last_names, row)}, {_date("birth", cohort.birth_years, cohort, row)},
            {_one_of("gender", cohort.genders, row)}, {_one_of("race", cohort.races, row)},
            {f"cast({zip_code} AS string)" if cohort.zip_as_text else zip_code}""",
        "encounters": f"""(id BIGINT, per_patient INT, seed BIGINT) RETURNS TABLE(
            patient_id BIGINT, physician_id BIGINT, location_id BIGINT, visit_type STRING,
            encounter_date DATE, notes STRING)
            RETURN SELECT id, {_number("physician", cohort.staff_ids, visit)},
            {_number("location", cohort.staff_ids, visit)}, {_one_of("visit_type", cohort.visit_types, visit)},
            {_date("visit", cohort.visit_years, cohort, visit)}, {literal(NOTES)}
            FROM explode(sequence(1, per_patient)) AS visits(visit)""",
        "heart_rates": f"""(id BIGINT, seed BIGINT) RETURNS TABLE(
            patient_id BIGINT, timestamp TIMESTAMP_NTZ, heartrate BIGINT)
            RETURN SELECT id, cast({_date("series", cohort.visit_years, cohort, row)} AS timestamp_ntz)
            + make_dt_interval(0, 0, 0, reading * {cohort.step_millis} / 1000),
            {_number("rate", cohort.rates, row, "cast(reading AS string)")}
            FROM explode(sequence(0, {cohort.readings - 1})) AS series(reading)""",
    }


def register_cohorts(spark: SparkSession, cohort: Cohort = Cohort(), prefix: str = "") -> None:
    """Register the table functions in the session, each name behind ``prefix``."""
    for name, body in cohort_functions(cohort).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body}")
