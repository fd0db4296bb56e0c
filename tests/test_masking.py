"""The table-level transform: default-deny, chains, references, plans."""

import contextlib
import hashlib
import io
import logging

import pytest
from support import AS_OF, make_policy
from pyspark.sql import functions as F

from maskflow import MaskOptions, Salts, deidentify, policy_coverage
from maskflow.operators import keys


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(True)
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "ann", "2001-01-01", "x"), (2, None, "2002-02-02", "y")],
        "Id int, name string, born string, secret string",
    )


def test_unlisted_columns_are_removed(table, mask, caplog):
    with caplog.at_level(logging.WARNING):
        out = mask(table, {"ID": "Identity", "NAME": {"type": "Hash", "salt_key": "k"}})
    assert out.columns == ["Id", "name"]
    assert "secret" in caplog.text


def test_empty_policy_keeps_nothing(table, mask):
    out = mask(table, {})
    assert out.columns == [] and out.count() == 2


def test_column_without_strategies_is_removed(table, mask):
    assert mask(table, {"id": "Identity", "name": []}).columns == ["Id"]


def test_output_is_within_the_policy(table, mask):
    columns = {"id": "Identity", "born": ["Duplicate", "Year"], "name": "Drop"}
    assert set(mask(table, columns).columns) <= {"Id", "born"}


def test_missing_columns(table, mask):
    out = mask(table, {"id": "Identity", "none": "Identity", "gone": "Drop", "new": "Clear", "first": "FixedFirstName"})
    assert out.columns == ["Id", "new", "first"]
    assert out.collect()[0][1:] == (" ", "FirstName")
    with pytest.raises(ValueError, match="none"):
        mask(table, {"none": "Hash"})
    assert mask(table, {"id": "Identity", "none": "Hash"}, on_missing="warn").columns == ["Id"]


def test_coverage(table):
    policy = make_policy(
        {"ID": "Duplicate", "id_duplicate": "Identity", "nmae": "Hash", "born": "EpochStart", "epoch_start": "Clear"}
    )
    found = policy_coverage(table, policy)
    assert found.treated == ["Id", "born"]
    assert found.removed == ["name", "secret"]
    assert found.missing == ["nmae"]


def test_draws_need_no_readable_value(spark, mask):
    df = spark.sql("select array(1) as a, named_struct('x', 1) as s")
    row = mask(df, {"a": "RandomFirstName", "s": "RandomLastName"}).collect()[0]
    assert all(isinstance(value, str) for value in row)


def test_odd_column_names(spark, mask):
    df = spark.createDataFrame([("a", "b", "c")], ["x.y", "q`r", "s t"])
    out = mask(df, {"x.y": "Identity", "q`r": "Clear", "s t": "Duplicate", "s t_duplicate": "Identity"})
    assert out.columns == ["x.y", "q`r", "s t", "s t_duplicate"]
    assert out.collect()[0] == ("a", " ", "c", "c")


def test_chain_runs_in_order(table, mask):
    out = mask(table, {"name": ["FixedFirstName", "Duplicate", "FixedLastName"], "name_duplicate": "Identity"})
    assert out.collect()[0] == ("LastName", "FirstName")


def test_drop_ends_a_chain(table, mask):
    assert mask(table, {"id": "Identity", "name": ["Duplicate", "Drop"]}).columns == ["Id"]


def test_derived_columns_need_a_listing(table, mask):
    columns = {"id": "Duplicate", "born": "EpochStart"}
    assert mask(table, columns).columns == ["Id", "born"]
    kept = mask(table, columns, keep_derived=True).columns
    assert {c.lower() for c in kept} == {"id", "born", "id_duplicate", "epoch_start"}
    listed = mask(table, {**columns, "epoch_START": "Identity"}).columns
    assert [c.lower() for c in listed] == ["id", "born", "epoch_start"]


def test_duplicate_of_a_duplicate(table, mask):
    columns = {"id": "Duplicate", "id_duplicate": ["Duplicate", "Clear"], "id_duplicate_duplicate": "Identity"}
    assert mask(table, columns).collect()[0] == (1, " ", 1)


def test_derived_column_replaces_a_source_column(spark, mask):
    df = spark.createDataFrame([("2001-01-01", "raw")], "d string, epoch_start string")
    row = mask(df, {"d": ["EpochStart", "Drop"], "EPOCH_START": "Identity"}).collect()[0]
    assert row[0] != "raw" and row[0].year in range(1999, 2004)


def test_epoch_start_and_days_from_it_agree(spark, mask):
    """One draw serves both columns, whichever order they are listed in."""
    df = spark.range(500).select(F.lit("2001-01-01").alias("d"), F.lit("2001-03-01").alias("visit"))
    columns = {
        "visit": {"type": "DateEpoch", "date_epoch": "epoch_start"},
        "d": "EpochStart",
        "EPOCH_START": "Identity",
    }
    out = mask(df, columns, seed=1)
    days = F.datediff(F.lit("2001-03-01"), F.col("EPOCH_START"))
    assert out.where(F.col("visit") != days).count() == 0
    assert out.select("EPOCH_START").distinct().count() > 100


def test_references_read_the_source(spark, mask):
    """Hashing the patient id or moving the epoch does not change what refers to them."""
    rows = [("2004-03-10", "2004-03-01", "p5")]
    df = spark.createDataFrame(rows, "seen string, start string, patientid string")
    columns = {
        "patientid": {"type": "Hash", "salt_key": "k"},
        "start": "DateShift",
        "seen": {"type": "DateEpoch", "date_epoch": "start"},
    }
    for order in (columns, dict(reversed(columns.items()))):
        row = mask(df, order).collect()[0]
        assert str(row["start"]) == "2004-03-09" and row["seen"] == 9


def test_strategies_on_masked_types(spark, mask):
    """The second strategy of a chain sees the type the first one gives."""
    df = spark.createDataFrame([("2001-05-06", "p4")], "d string, patientid string")
    row = mask(df, {"d": ["Year", "DateShift"]}).collect()[0]
    assert str(row["d"]) == "2000-12-28"
    row = mask(df, {"d": ["DateShift", {"type": "Hash", "salt_key": "k"}]}).collect()[0]
    assert row["d"] == hashlib.sha512(b"2001-05-02salt-k").hexdigest()


def test_same_salt_same_pseudonym(spark, salts):
    a = spark.createDataFrame([("7",)], "patient string")
    b = spark.createDataFrame([(7,)], "person int")
    hashed = [
        deidentify(df, make_policy({df.columns[0]: {"type": "Hash", "salt_key": "k"}}), salts).collect()
        for df in (a, b)
    ]
    assert hashed[0][0][0] == hashed[1][0][0]
    by_column = Salts({"patient": "1", "person": "2"})
    options = MaskOptions(salt_by="column")
    hashed = [
        deidentify(df, make_policy({df.columns[0]: {"type": "Hash", "salt_key": "k"}}), by_column, options).collect()
        for df in (a, b)
    ]
    assert hashed[0][0][0] != hashed[1][0][0]


def test_unknown_salt_key(table, mask):
    with pytest.raises(KeyError):
        mask(table, {"name": {"type": "Hash", "salt_key": "nope"}})


def test_plan_hides_salts_and_stays_compiled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.col("id").cast("string").alias("name"), F.lit(1).alias("x")).write.parquet(path)
    salts = Salts({"k": "very-secret-salt"})
    policy = make_policy(
        {"id": "Identity", "name": [{"type": "Hash", "salt_key": "k"}], "y": "Clear"}
    )
    out = deidentify(spark.read.parquet(path), policy, salts).where("id > 990")
    text = plan(out)
    assert "very-secret-salt" not in text
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,990)]" in text
    assert "ReadSchema: struct<id:bigint,name:string>" in text
    assert "Exchange" not in text and "Python" not in text
    assert text.split("Formatted")[0].count("FileScan") <= 1
    assert out.count() == 9


def test_uniform_draws_repeat_with_a_seed(spark, mask):
    df = spark.range(200).select(F.col("id").cast("string").alias("c"))
    first = mask(df, {"c": "RandomFirstName"}, seed=1).collect()
    assert first == mask(df, {"c": "RandomFirstName"}, seed=1).collect()
    assert first != mask(df, {"c": "RandomFirstName"}, seed=2).collect()
    assert mask(df, {"c": "RandomFirstName"}).collect() != mask(df, {"c": "RandomFirstName"}).collect()


def test_columns_draw_independently(spark, mask):
    df = spark.range(2000).select(F.lit("x").alias("a"), F.lit("x").alias("b"))
    out = mask(df, {"a": "RandomFirstName", "b": "RandomFirstName"}, seed=1)
    assert out.where("a = b").count() < 300


# -- key derivation over distinct values


def kdf(value, salt="salt-k"):
    return hashlib.pbkdf2_hmac("sha1", value.encode(), salt.encode(), 2016, 64).hex()


@pytest.fixture
def shuffled_joins(spark):
    """Joins shuffle as they would on large tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_keys_by_broadcast_and_by_shuffle(spark, mask, shuffled_joins, monkeypatch, limit):
    """A third of the rows share one value, a third are null; the hot set is small."""
    monkeypatch.setattr(keys, "HOT_VALUES", 2)
    raw = ["hot"] * 100 + [None] * 100 + [f"v{i % 30}" for i in range(97)] + ["", " hot ", "\t"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, c string").repartition(4)
    pbe = {"type": "PBEKeyHash", "salt_key": "k"}
    out = mask(df, {"i": "Identity", "c": ["Duplicate", pbe], "c_duplicate": pbe}, broadcast_bytes=limit)
    rows = sorted(out.collect())
    blanks = "".join(map(chr, range(33)))
    want = [v if not v else kdf(v.strip(blanks)) for v in raw]
    assert [(r["i"], r["c"]) for r in rows] == list(enumerate(want))
    assert all(r["c"] == r["c_duplicate"] for r in rows)
    text = plan(out)
    assert ("SortMergeJoin" in text) == (limit == 0)


def test_derivation_is_dealt_out_over_all_cores(spark):
    """Whatever the shuffle partitions, which adaptive execution would merge."""
    from maskflow.functions.text import secret

    before = spark.conf.get("spark.sql.shuffle.partitions")
    values = spark.range(300).select(F.lit(1).alias("salt_id"), (F.col("id") % 40).cast("string").alias("value"))
    try:
        for partitions in (8, 16, 32):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            derived = keys.derive_distinct(values, ["r", "s"], secret(spark, "run"))
            sizes = derived.groupBy(F.spark_partition_id()).count().collect()
            assert len(sizes) == max(16, partitions) and max(r["count"] for r in sizes) <= 16
            assert derived.count() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fillers_spread_rows_that_need_no_key(spark, shuffled_joins, monkeypatch):
    """Null and hot rows do not meet in one partition of the shuffled join."""
    monkeypatch.setattr(keys, "HOT_VALUES", 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 64).select(
            "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "cold").alias("c")
        )
        # by the whole row, and by the key alone, as where all rows are copies
        for spread_on, most in ((["id", "c"], 600), (["c"], 1000)):
            out = keys.add_derived_keys(df, {"out": ("c", "s")}, spread_on, 0)
            idle = out.where("c is null or c = 'hot'")
            sizes = idle.groupBy(F.spark_partition_id()).count().collect()
            assert len(sizes) == 8 and max(r["count"] for r in sizes) < most
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_chained_lookups(spark, mask):
    """A looked-up city is itself a value to derive a key of."""
    cities = spark.createDataFrame([("10001", "Aville")], "zip string, city string")
    df = spark.createDataFrame([("10099",), ("777",), (None,)], "c string")
    out = mask(df, {"c": ["City", {"type": "PBEKeyHash", "salt_key": "k"}]}, cities=cities)
    assert {r[0] for r in out.collect()} == {kdf("Aville"), kdf("unknown"), None}


def test_keys_reach_the_shared_folder(spark, mask, table):
    from maskflow.sources.shared import shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    out = mask(table, {"name": {"type": "PBEKeyHash", "salt_key": "k"}})
    assert {r[0] for r in out.collect()} == {kdf("ann"), None}


def test_year_is_an_option(spark, mask):
    df = spark.createDataFrame([("1990-01-01",)], "c string")
    assert mask(df, {"c": "Year"}, as_of_year=2085).collect()[0][0].year == 1995
    assert mask(df, {"c": "Year"}, as_of_year=AS_OF).collect()[0][0].year == 1998


def test_all_salts_are_derived_in_one_pass(spark, mask, monkeypatch):
    calls = []
    derive = keys.derive_distinct

    def counted(values, salts, run_key):
        calls.append(salts)
        return derive(values, salts, run_key)

    monkeypatch.setattr(keys, "derive_distinct", counted)
    df = spark.createDataFrame([("ann", "ann", "ann", "bob"), ("bob", None, "", "ann")], "a string, b string, c string, d string")
    salted = {name: {"type": "PBEKeyHash", "salt_key": key} for name, key in zip("abcd", ("k", "c", "zip", "k"))}
    got = {tuple(r) for r in mask(df, salted).collect()}
    assert calls == [["salt-k", "salt-c", "salt-zip"]]

    def key(value, salt):
        return hashlib.pbkdf2_hmac("sha1", value.encode(), salt.encode(), 2016, 64).hex()

    assert got == {
        (key("ann", "salt-k"), key("ann", "salt-c"), key("ann", "salt-zip"), key("bob", "salt-k")),
        (key("bob", "salt-k"), None, "", key("ann", "salt-k")),
    }


def test_filters_on_text_reach_the_scan(spark, salts, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("F", 1), ("O", 2)], "status string, n int").write.parquet(path)
    df = spark.read.parquet(path)
    rules = make_policy({"status": "Identity", "n": "Identity"})
    out = deidentify(df, rules, salts, MaskOptions(as_of_year=AS_OF), where=F.col("status") == "F")
    plan = out._jdf.queryExecution().toString()
    assert "EqualTo(status,F)" in plan.split("PushedFilters")[1].split("\n")[0]
    assert out.collect() == [("F", 1)]


@pytest.mark.parametrize("dtype", ["tinyint", "smallint", "int", "bigint", "decimal(3,1)", "float", "double"])
def test_capped_numbers_keep_their_type(spark, mask, dtype):
    df = spark.sql(f"select cast(95 as {dtype}) age, cast(20 as {dtype}) young")
    out = mask(df, {"age": "Age", "young": "Age"})
    assert [f.dataType.simpleString() for f in out.schema.fields] == [dtype, dtype]
    assert [float(v) for v in out.first()] == [90.0, 20.0]
