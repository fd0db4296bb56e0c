"""SQL table functions of cohorts against the generators."""

import pytest
from pyspark.sql import functions as F

from maskflow.functions.cohorts import register_cohorts
from maskflow.operators import generate
from maskflow.operators.generate import BATCH_COHORT, Cohort

ODD = Cohort(first_names=("D'Arcy", "back\\slash", "é"), readings=3, months=(2, 1), days=(28, 1), birth_years=(2000, 1))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("cohort", [Cohort(readings=5), BATCH_COHORT, ODD])
@pytest.mark.parametrize("seed", [1, -7])
def test_functions_make_the_generators_rows(spark, cohort, seed):
    register_cohorts(spark, cohort, "t_")
    ids = generate.id_range(spark, 60)
    pairs = [
        (f"t_patients(patient_id, {seed})", generate.patients(ids, seed, cohort)),
        (f"t_encounters(patient_id, 2, {seed})", generate.encounters(ids, 2, seed, cohort)),
        (f"t_heart_rates(patient_id, {seed})", generate.heart_rates(ids, seed, cohort)),
    ]
    for call, made in pairs:
        found = spark.sql(f"SELECT made.* FROM {{ids}} ids, LATERAL {call} made", ids=ids)
        assert found.dtypes == made.dtypes and rows(found) == rows(made)


def test_one_id_and_plans_without_a_shuffle(spark):
    register_cohorts(spark, prefix="t_")
    one = spark.sql("SELECT * FROM t_patients(5, 7)")
    assert rows(one) == rows(generate.patients(spark.range(5, 6).select(F.col("id").alias("patient_id")), 7))
    assert spark.sql("SELECT * FROM t_encounters(5, 4, 7)").count() == 4
    ids = spark.range(0, 1000, 1, 6).select(F.col("id").alias("patient_id"))
    for call in ("t_patients(patient_id, 7)", "t_heart_rates(patient_id, 7)"):
        found = spark.sql(f"SELECT made.* FROM {{ids}} ids, LATERAL {call} made", ids=ids)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and found.rdd.getNumPartitions() == 6
