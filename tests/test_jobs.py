import json

import pytest
from support import AS_OF, make_policy
from pyspark.sql import functions as F

from maskflow import MaskOptions, Salts, load_policies
from maskflow.plans.jobs import (
    Outcome,
    deidentify_dataset,
    mask_csv_folder,
    mask_database,
    mask_fixed_width_folder,
)
from maskflow.plans.policy import TablePolicy
from maskflow.sources import jdbc
from maskflow.sources.fixedwidth import Field, write_fixed_width
from maskflow.sources.sinks import csv_sink, parquet_sink

OPTIONS = MaskOptions(as_of_year=AS_OF)


def named(name, columns):
    return TablePolicy(name, make_policy(columns).strategies)


def collector():
    written = {}
    return written, lambda name, df: written.__setitem__(name, sorted(df.collect()))


def test_dataset(spark, salts):
    tables = {
        "old_people": spark.createDataFrame([("a", 1)], "name string, x int"),
        "visits": lambda: spark.createDataFrame([("b", 2)], "note string, y int"),
    }
    policies = [named("people", {"name": "Clear"}), named("VISITS", {"note": "Identity", "y": "Identity"})]
    written, sink = collector()
    assert deidentify_dataset(tables, policies, sink, salts, OPTIONS) == Outcome(["people", "VISITS"], [])
    assert written == {"people": [(" ",)], "VISITS": [("b", 2)]}
    assert deidentify_dataset({}, policies, sink) == Outcome([], [])


def test_dataset_matches_before_writing(spark, salts):
    df = spark.range(1)
    written, sink = collector()
    with pytest.raises(ValueError, match="no policy"):
        deidentify_dataset({"t": df, "u": df}, [named("t", {"id": "Identity"})], sink)
    with pytest.raises(ValueError, match="several tables"):
        deidentify_dataset({"t1": df, "t2": df}, [named("t", {"id": "Identity"})], sink)
    assert written == {}


def test_dataset_errors_surface(spark):
    def fail(name, df):
        raise OSError("disk full")

    with pytest.raises(OSError):
        deidentify_dataset({"t": spark.range(1)}, [named("t", {"id": "Identity"})], fail)


def test_csv_folder(spark, salts, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "demographics_1.csv").write_text("patient_id,zip,dob,extra\n1,01234,2001-05-06,x\n")
    (raw / "demographics_2.csv").write_text("patient_id,zip,dob,extra\n2,03601,NULL,x\n")
    (raw / "encounters.csv").write_text('patient_id,notes\n1,"hello"\n')
    document = {
        "demographics": {
            "patient_id": {"strategy": [{"type": "Hash", "salt_key": "k"}]},
            "zip": {"strategy": [{"type": "Zip3Digit"}]},
            "dob": {"strategy": [{"type": "Year"}]},
        },
        "encounters": {
            "patient_id": {"strategy": [{"type": "Hash", "salt_key": "k"}]},
            "notes": {"strategy": [{"type": "Identity"}]},
        },
    }
    path = tmp_path / "policies.json"
    path.write_text(json.dumps(document))
    policies = load_policies(str(path), spark)
    out = tmp_path / "out"
    outcome = mask_csv_folder(spark, str(raw), policies, parquet_sink(str(out)), salts, OPTIONS)
    assert sorted(outcome.written) == ["demographics", "encounters"] and outcome.skipped == []
    people = spark.read.parquet(str(out / "demographics"))
    assert people.columns == ["patient_id", "zip", "dob"]
    assert sorted(r["zip"] for r in people.collect()) == ["00000", "01200"]
    assert people.where("dob is null").count() == 1
    visits = spark.read.parquet(str(out / "encounters"))
    assert people.join(visits, "patient_id").count() == 1
    # all columns as text: the same result from one pass over the files
    text = tmp_path / "text"
    mask_csv_folder(spark, str(raw), policies, csv_sink(str(text)), salts, OPTIONS, infer_types=False)
    again = spark.read.csv(str(text / "demographics"), header=True)
    assert sorted(r["patient_id"] for r in again.collect()) == sorted(r["patient_id"] for r in people.collect())


def test_fixed_width_folder(spark, salts, tmp_path):
    layout = [Field("id", 4, "9"), Field("name", 5, "X")]
    df = spark.createDataFrame([(1, "ann"), (2, "bob")], "id int, name string")
    write_fixed_width(df, str(tmp_path / "raw" / "cclfx_members.fil"), layout)
    policies = [named("members", {"name": {"type": "Hash", "salt_key": "k"}})]
    written, sink = collector()
    mask_fixed_width_folder(
        spark, str(tmp_path / "raw"), policies, sink, salts, OPTIONS, layouts={"cclfx": layout}
    )
    assert len(written["members"]) == 2 and len(written["members"][0][0]) == 128
    with pytest.raises(ValueError, match="layout"):
        mask_fixed_width_folder(spark, str(tmp_path / "raw"), policies, sink, salts, OPTIONS)


def test_database(spark, salts, monkeypatch):
    asked = []

    def fake(spark, connection, name, column, partitions, cuts):
        asked.append((name, column, partitions, cuts))
        return spark.range(2).select(F.col("id"))

    monkeypatch.setattr("maskflow.plans.jobs.read_jdbc", fake)
    policies = [
        TablePolicy("people", make_policy({"id": "Identity"}).strategies, "id"),
        named("visits", {"id": "Identity"}),
    ]
    connection = jdbc.JdbcConnection("u")
    written, sink = collector()
    mask_database(
        spark, connection, policies, sink, salts, OPTIONS, partitions=3, cuts={"people": [5, 9]}
    )
    assert sorted(asked) == [("people", "id", 3, [5, 9]), ("visits", None, 3, None)]
    assert set(written) == {"people", "visits"}
    asked.clear()
    mask_database(spark, connection, policies, sink, salts, OPTIONS, tables=["VISITS"])
    assert asked == [("visits", None, None, None)]


def test_salts_can_be_made_during_a_job(spark, tmp_path):
    path = tmp_path / "salts.json"
    df = spark.createDataFrame([("a",)], "c string")
    policies = [named("t", {"c": {"type": "Hash", "salt_key": "new"}})]
    results = []
    for create in (True, False):
        written, sink = collector()
        deidentify_dataset({"t": df}, policies, sink, Salts.load(path, create), OPTIONS)
        results.append(written)
    assert results[0] == results[1]


def test_salts_are_made_once_by_many_threads(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = tmp_path / "salts.json"
    salts = Salts.load(path, create=True)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda k: (k % 20, salts.get(f"key {k % 20}")), range(400)))
    assert len(set(got)) == 20 == len({salt for _, salt in got})
    assert all(Salts.load(path).get(f"key {k}") == salt for k, salt in got)
    assert [file.name for file in tmp_path.iterdir()] == ["salts.json"]
    assert path.stat().st_mode & 0o777 == 0o600


@pytest.mark.parametrize("round_", range(4))
def test_jobs_of_many_tables_make_their_salts(spark, tmp_path, round_):
    path = tmp_path / "salts.json"
    df = spark.createDataFrame([("a",)], "c string")
    names = [f"table{chr(97 + k) * 3}" for k in range(6)]
    rules = {"c": {"type": "Hash", "salt_key": "shared"}}
    own = [named(name, rules | {f"c{k}": {"type": "Hash", "salt_key": f"own {k}"}}) for k, name in enumerate(names)]
    tables = {name: df.withColumn(f"c{k}", F.lit("b")) for k, name in enumerate(names)}
    written, sink = collector()
    outcome = deidentify_dataset(tables, own, sink, Salts.load(path, create=True), OPTIONS, at_once=6)
    assert sorted(outcome.written) == names
    assert len({rows[0][0] for rows in written.values()}) == 1
    assert len({rows[0][1] for rows in written.values()}) == 6
    assert len(json.loads(path.read_text())) == 7


@pytest.mark.parametrize("make", [csv_sink, parquet_sink])
def test_unfinished_output_is_written_anew(spark, tmp_path, make):
    out = tmp_path / "out"
    (out / "t" / "_temporary" / "0").mkdir(parents=True)
    policies = [named("t", {"id": "Identity"})]
    runs = [
        deidentify_dataset({"t": spark.range(n)}, policies, make(str(out)), None, OPTIONS) for n in (3, 5)
    ]
    assert runs == [Outcome(["t"], []), Outcome([], ["t"])]
    read = spark.read.csv(str(out / "t"), header=True) if make is csv_sink else spark.read.parquet(str(out / "t"))
    assert read.count() == 3
    again = deidentify_dataset({"t": spark.range(5)}, policies, make(str(out), mode="overwrite"), None, OPTIONS)
    assert again.written == ["t"]
