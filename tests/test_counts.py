"""Figures of tables taken while they are written, and tables in buckets."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from support import make_policy

from maskflow import MaskOptions
from maskflow.plans import jobs
from maskflow.sources.sinks import csv_sink, parquet_sink, table_sink

RULES = {"id": "Identity", "name": {"type": "Hash", "salt_key": "k"}}
SCHEMA = "id bigint, name string, `odd ``name` string, rest int"


@pytest.fixture
def table(spark):
    return spark.createDataFrame([(k, None if k % 4 == 0 else f"n{k}", "x", k) for k in range(100)], SCHEMA)


def job(tables, sink, salts, count=True, rules=RULES):
    policies = [replace(make_policy(rules), name=name) for name in tables]
    return jobs.deidentify_dataset(tables, policies, sink, salts, MaskOptions(hash_bits=256), count=count)


@pytest.mark.parametrize("kind", ["parquet", "csv", "table"])
def test_counts_of_what_was_written(spark, table, tmp_path, salts, kind):
    out = str(tmp_path / "out")
    sink = {"parquet": parquet_sink(out), "csv": csv_sink(out), "table": table_sink("default", folder=out)}[kind]
    rules = {**RULES, "odd `name": "Clear"}
    empty = table.where("id < 0")
    outcome = job({"people_a": table, "people_b": empty}, sink, salts, rules=rules)
    assert sorted(outcome.written) == ["people_a", "people_b"]
    assert outcome.counts["people_a"] == jobs.TableCounts(100, {"id": 0, "name": 25, "odd `name": 0}, ["rest"])
    assert outcome.counts["people_b"] == jobs.TableCounts(0, {"id": 0, "name": 0, "odd `name": 0}, ["rest"])
    if kind == "table":
        for name in ("people_a", "people_b"):
            spark.sql(f"DROP TABLE default.{name}")


def test_no_second_job(spark, table, tmp_path, salts):
    """Counting adds no job to a write."""
    found = {}
    for count in (False, True):
        group = f"counting-{count}"
        spark.sparkContext.setJobGroup(group, group)
        job({"people": table}, parquet_sink(str(tmp_path / group)), salts, count=count)
        found[count] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[True] == found[False]


def test_tables_left_and_sinks_that_run_nothing(table, tmp_path, salts, monkeypatch):
    monkeypatch.setattr(jobs, "FIGURES_WITHIN", 1)
    sink = parquet_sink(str(tmp_path / "out"))
    assert job({"people": table}, sink, salts).counts["people"].rows == 100
    again = job({"people": table}, sink, salts)
    assert again.skipped == ["people"] and again.counts == {}
    kept = []
    outcome = job({"people": table}, lambda name, df: kept.append(df), salts)
    assert outcome.written == ["people"] and outcome.counts == {} and kept[0].count() == 100
    assert job({"people": table}, lambda name, df: kept.append(df), salts, count=False).counts == {}


def test_outcomes_compare_by_names():
    assert jobs.Outcome(["a"], []) == jobs.Outcome(["a"], [], {"a": jobs.TableCounts(1, {}, [])})


def test_buckets_join_and_group_without_a_shuffle(spark, tmp_path):
    rows = spark.range(2000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), "id")
    sink = table_sink("default", folder=str(tmp_path), buckets={"left_b": (4, ["key"]), "right_b": (4, ["key"])})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for name in ("left_b", "right_b", "plain_b"):
            sink(name, rows)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

        def shuffles(a, b):
            counts = [spark.table(f"default.{t}").groupBy("key").agg(F.count("id").alias(t)) for t in (a, b)]
            joined = counts[0].join(counts[1], "key")
            assert joined.count() == 2000
            return joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

        assert shuffles("left_b", "right_b") == 0
        assert shuffles("left_b", "plain_b") >= 1
        assert len(list((tmp_path / "left_b").glob("*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("left_b", "right_b", "plain_b"):
            spark.sql(f"DROP TABLE IF EXISTS default.{name}")
