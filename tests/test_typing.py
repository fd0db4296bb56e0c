"""Types of CSV columns, against Spark's own inference."""

from itertools import combinations, product
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.sources import typing
from maskflow.sources.files import read_csv

FOLDER = Path("/root/testdata/sf0.001")
CELLS = [
    "5", "+5", "-5", " 5", "5 ", "007", "2147483647", "2147483648", "-2147483648", "-2147483649", "9" * 19, "9" * 20,
    "0" * 30 + "7", "9" * 38, "9" * 39, "1,234", "123.", "1.5", ".5", "1e5", "1E-3", "1d", "1.5f", "NaN", "Inf", "-Inf",
    "Infinity", "-Infinity", "+Infinity", "nan", "inf", "0x1p3", "0x10", "2024", "2024-01", "2024-1-1", "2024-01-01", "2024-13-01",
    "2024-02-30", "2024-01-01 ", "2024-01-01T00:00:00", "2024-01-01 10:32", "2024-01-01 10:32:11.123456",
    "2024-01-01T00:00:00Z", "2024-01-01T00:00:00.000+02:00", "10:32", "12024-01-01", "true", "TRUE", "false", "yes",
    "abc", "1_000", "--5", "+", "-", ".", "e5", "1 2", "01/02/2024", "20240101", "-2024-01-01", "é", "", None,
]


def own_inference(spark, path, **options):
    reader = spark.read.options(header=True, nullValue="", mode="PERMISSIVE", enforceSchema=False, inferSchema=True, **options)
    return [(f.name, f.dataType) for f in reader.csv(path).schema]


def written(spark, columns, path):
    """CSV with a column for each list of cells."""
    rows = list(zip(*columns))
    df = spark.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(len(columns))))
    df.coalesce(1).write.csv(path, header=True, nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def types(spark, path):
    return [(f.name, f.dataType) for f in read_csv(spark, path).schema]


def test_single_cells(spark, tmp_path):
    path = written(spark, [[cell] for cell in CELLS] + [["x"]], str(tmp_path / "a"))
    assert types(spark, path) == own_inference(spark, path)


def test_pairs_in_which_order_does_not_matter(spark, tmp_path):
    """Spark's own result where it is the same both ways; where it depends on the order of
    the rows, one of its results or text."""
    cells = ["5", "2147483648", "9" * 20, "9" * 38, "1.5", "2024-01-01", "2024-01-01T10:00:00", "true", "abc", "12."]
    pairs = list(combinations(cells, 2))
    ways = [
        written(spark, [list(p[::step]) for p in pairs], str(tmp_path / f"p{step}"))
        for step in (1, -1)
    ]
    own = [own_inference(spark, path) for path in ways]
    got = [types(spark, path) for path in ways]
    assert got[0] == got[1]
    alike = [k for k in range(len(pairs)) if own[0][k] == own[1][k]]
    assert len(alike) > 35 and [got[0][k] for k in alike] == [own[0][k] for k in alike]
    text = [(f"c{k}", T.StringType()) for k in range(len(pairs))]
    assert all(got[0][k] in (own[0][k], own[1][k], text[k]) for k in range(len(pairs)))


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize(
    "table", "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()
)
def test_every_table(spark, tmp_path, table):
    df = spark.read.parquet(str(FOLDER / f"{table}.parquet"))
    path = str(tmp_path / "t")
    df.repartition(3).write.csv(path, header=True, nullValue="", quoteAll=False, escape='"')
    got = [(f.name, f.dataType) for f in read_csv(spark, path, multi_line=True).schema]
    assert got == own_inference(spark, path, multiLine=True)


def test_sets_merge_in_any_order(spark):
    rows = [(c, k % 3) for k, c in enumerate(["1", "2147483648", None, "9" * 25, "-3", ""])]
    df = spark.createDataFrame(rows, "c string, part int")
    for parts in (1, 2, 5):
        assert typing.infer_types(df.select("c").repartition(parts))[0].dataType.simpleString() == "decimal(25,0)"


def test_kept_columns_and_odd_names(spark):
    df = spark.createDataFrame([("01", "2", "3.5")], "`Zip Code` string, `a.b``c` string, x string")
    found = typing.infer_types(df, keep=["ZIP code"])
    assert found.names == df.columns and [f.dataType.simpleString() for f in found] == ["string", "int", "double"]
    assert [f.dataType.simpleString() for f in typing.infer_types(df, keep=df.columns)] == ["string"] * 3
    assert typing.infer_types(df.where("x = ''"))[1].dataType.simpleString() == "string"


def test_types_are_one_native_aggregate(spark):
    df = spark.createDataFrame([("1", "a")], "a string, b string")
    kinds = df.agg(*[F.bit_or(typing.kind_of(F.col(c))) for c in df.columns])
    plan = kinds._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1


def test_digits_of_other_scripts_are_text(spark):
    df = spark.createDataFrame([("\uff11",)], "c string")
    assert typing.infer_types(df)[0].dataType.simpleString() == "string"


def test_all_kinds_are_told_apart():
    kinds = [typing.INT, typing.LONG, typing.DECIMAL, typing.DOUBLE, typing.DATE, typing.STAMP, typing.BOOLEAN, typing.STRING]
    found = {type(typing.type_of(a | b, 21)).__name__ for a, b in product(kinds, kinds)}
    assert found == {"IntegerType", "LongType", "DecimalType", "DoubleType", "DateType", "TimestampType", "BooleanType", "StringType"}
