"""Synthetic cohorts, one patient per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskflow.catalog.registry import load, query, sql_list
from maskflow.functions.cohorts import register_cohorts
from maskflow.operators.generate import (
    BATCH_COHORT,
    BATCH_IDS,
    NOTES,
    Cohort,
    batch_ids,
    encounters,
    heart_rates,
    heart_rates_of,
    patients,
)

SEED = 7
COHORT = Cohort()


def sql_number(field: str, span: tuple[int, int], row: str, more: str = "") -> str:
    first, size = span
    text = f"'{SEED}|{field}|' || {row}" + (f" || '|' || {more}" if more else "")
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % {size} + {first})"


def sql_one_of(field: str, choices, row: str) -> str:
    return f"{sql_list(choices)}[1 + {sql_number(field, (0, len(choices)), row)}]"


def sql_date(field: str, years, cohort: Cohort, row: str) -> str:
    parts = (("year", years), ("month", cohort.months), ("day", cohort.days))
    return f"make_date({', '.join(sql_number(f'{field}_{p}', span, row) for p, span in parts)})"


def customer_ids(spark, folder):
    """Ids from the customers, spread over the cluster before rows are made of them."""
    ids = load(spark, folder, "customer").select((F.col("c_custkey") + 1).alias("patient_id"))
    return ids.repartition(spark.sparkContext.defaultParallelism, "patient_id")


IDS = "SELECT c_custkey + 1 AS patient_id FROM customer"


def sql_patients(cohort: Cohort) -> str:
    row = "CAST(patient_id AS VARCHAR)"
    record = ""
    if cohort.record_numbers:
        number = sql_number("record", cohort.record_numbers, row)
        record = f"CAST({number} AS VARCHAR) AS patient_mrn,"
    zip_code = sql_number("zip", cohort.zips, row)
    return f"""
        SELECT patient_id, {record}
               {sql_one_of("first_name", cohort.first_names, row)} AS first_name,
               {sql_one_of("last_name", cohort.last_names, row)} AS last_name,
               {sql_date("birth", cohort.birth_years, cohort, row)} AS dob,
               {sql_one_of("gender", cohort.genders, row)} AS gender,
               {sql_one_of("race", cohort.races, row)} AS race,
               {f"CAST({zip_code} AS VARCHAR)" if cohort.zip_as_text else zip_code} AS zip
        FROM ({IDS})
    """


def sql_encounters(cohort: Cohort, per_patient: int) -> str:
    row = "CAST(patient_id AS VARCHAR) || '-' || CAST(visit AS VARCHAR)"
    notes = NOTES.replace("'", "''").replace("\n", "' || chr(10) || '")
    return f"""
        SELECT patient_id, {sql_number("physician", cohort.staff_ids, row)} AS physician_id,
               {sql_number("location", cohort.staff_ids, row)} AS location_id,
               {sql_one_of("visit_type", cohort.visit_types, row)} AS visit_type,
               {sql_date("visit", cohort.visit_years, cohort, row)} AS encounter_date,
               '{notes}' AS notes
        FROM ({IDS}), (SELECT unnest(range(1, {per_patient + 1})) AS visit)
    """


def sql_readings(starts: str, cohort: Cohort, row: str) -> str:
    return f"""
        SELECT patient_id,
               CAST(start AS TIMESTAMP) + to_milliseconds(reading * {cohort.step_millis})
               AS timestamp,
               {sql_number("rate", cohort.rates, row, "CAST(reading AS VARCHAR)")} AS heartrate
        FROM ({starts}), (SELECT unnest(range(0, {cohort.readings})) AS reading)
    """


@query("generate_patients", sql_patients(COHORT))
def generate_patients(spark, folder):
    return patients(customer_ids(spark, folder), SEED)


@query("generate_patients_batch", sql_patients(BATCH_COHORT))
def generate_patients_batch(spark, folder):
    return patients(customer_ids(spark, folder), SEED, BATCH_COHORT)


@query("generate_encounters", sql_encounters(COHORT, 3))
def generate_encounters(spark, folder):
    return encounters(customer_ids(spark, folder), 3, SEED)


@query(
    "generate_heart_rates",
    sql_readings(
        f"SELECT patient_id, {sql_date('series', COHORT.visit_years, COHORT, 'CAST(patient_id AS VARCHAR)')} AS start FROM ({IDS})",
        COHORT,
        "CAST(patient_id AS VARCHAR)",
    ),
)
def generate_heart_rates(spark, folder):
    return heart_rates(customer_ids(spark, folder), SEED, COHORT)


def lateral(spark, folder, call: str, prefix: str, cohort: Cohort = COHORT):
    """Rows that a table function makes beside the ids of all customers."""
    register_cohorts(spark, cohort, prefix)
    return spark.sql(f"SELECT made.* FROM {{ids}} ids, LATERAL {prefix}{call} made", ids=customer_ids(spark, folder))


@query("sql_patients", sql_patients(COHORT))
def patients_by_sql(spark, folder):
    return lateral(spark, folder, f"patients(patient_id, {SEED})", "standard_")


@query("sql_patients_batch", sql_patients(BATCH_COHORT))
def batch_patients_by_sql(spark, folder):
    return lateral(spark, folder, f"patients(patient_id, {SEED})", "batch_", BATCH_COHORT)


@query("sql_encounters", sql_encounters(COHORT, 3))
def encounters_by_sql(spark, folder):
    return lateral(spark, folder, f"encounters(patient_id, 3, {SEED})", "standard_")


@query(
    "sql_heart_rates",
    sql_readings(
        f"SELECT patient_id, {sql_date('series', COHORT.visit_years, COHORT, 'CAST(patient_id AS VARCHAR)')} AS start FROM ({IDS})",
        COHORT,
        "CAST(patient_id AS VARCHAR)",
    ),
)
def heart_rates_by_sql(spark, folder):
    return lateral(spark, folder, f"heart_rates(patient_id, {SEED})", "standard_")


@query(
    "generate_heart_rates_batch",
    sql_readings(
        f"SELECT patient_id, physician_id, location_id, encounter_date AS start FROM ({sql_encounters(BATCH_COHORT, 1)})",
        BATCH_COHORT,
        "patient_id || '-' || physician_id || '-' || location_id",
    ),
)
def generate_heart_rates_batch(spark, folder):
    visits = encounters(customer_ids(spark, folder), 1, SEED, BATCH_COHORT)
    return heart_rates_of(visits, SEED)


@query(
    "generate_batch_ids",
    f"""
    SELECT c_custkey, {sql_number("patient", BATCH_IDS, "CAST(c_custkey AS VARCHAR)")} AS patient_id
    FROM customer
    """,
)
def generate_batch_ids(spark, folder):
    """As many random, repeating ids as there are customers, beside their numbers."""
    customers = load(spark, folder, "customer")
    ids = batch_ids(spark, customers.count(), SEED)
    numbered = ids.withColumn("c_custkey", F.col("row"))
    return customers.select("c_custkey").join(numbered, "c_custkey").select("c_custkey", "patient_id")
