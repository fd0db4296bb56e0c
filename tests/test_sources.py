"""Sources and sinks. JDBC is tested up to the options handed to Spark: reading
for real would need a database."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.sources import jdbc, sinks
from maskflow.sources.files import list_tables, read_csv, read_json
from maskflow.sources.fixedwidth import (
    Field,
    format_lines,
    layout_schema,
    layout_width,
    parse_layout,
    read_fixed_width,
    split_lines,
    write_fixed_width,
)
from maskflow.sources.layouts import CLAIM_LAYOUTS
from maskflow.sources.shared import new_path, shared_folder

# -- CSV, JSON, folders


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('id,zip,born,note\n007,01234,2001-01-02,"a, b"\n8,,NULL,\n')
    return str(path)


def test_csv_inferred(spark, csv_file):
    df = read_csv(spark, csv_file)
    assert dict(df.dtypes) == {"id": "int", "zip": "int", "born": "string", "note": "string"}
    assert df.collect() == [(7, 1234, "2001-01-02", "a, b"), (8, None, "NULL", None)]


def test_csv_text_columns(spark, csv_file):
    df = read_csv(spark, csv_file, text_columns=["ZIP", "other"])
    assert df.collect()[0][:2] == (7, "01234")


def test_csv_all_text(spark, csv_file):
    df = read_csv(spark, csv_file, infer_types=False)
    assert df.collect() == [("007", "01234", "2001-01-02", "a, b"), ("8", None, "NULL", None)]


def test_csv_bad_fields_are_null(spark, csv_file):
    df = read_csv(spark, csv_file, schema="id int, zip string, born date, note string")
    assert df.collect()[1] == (8, None, None, None)


def test_csv_multi_line(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text('a,b\n"x\ny",1\n')
    assert read_csv(spark, str(path), multi_line=True).collect() == [("x\ny", 1)]


def test_csv_roundtrip_keeps_blanks(spark, tmp_path):
    rows = [(" ", " a ", 'q"u,o', "back\\"), ("x", None, "é", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    sinks.csv_sink(str(tmp_path))("t", df)
    back = read_csv(spark, str(tmp_path / "t"), infer_types=False).collect()
    assert back == [(" ", " a ", 'q"u,o', "back\\"), ("x", None, "é", None)]


def test_json(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"a": 1, "b": "x"}\n{"a": null}\n')
    assert read_json(spark, str(path)).collect() == [(1, "x"), (None, None)]
    schema = T.StructType([T.StructField("a", T.StringType())])
    assert read_json(spark, str(path), schema).collect() == [("1",), (None,)]


def test_list_tables(spark, tmp_path):
    for name in ("b.csv", "a.csv", ".hidden", "_SUCCESS"):
        (tmp_path / name).write_text("x\n")
    (tmp_path / "folder").mkdir()
    found = list_tables(spark, str(tmp_path))
    assert list(found) == ["a.csv", "b.csv", "folder"]
    assert found["a.csv"].endswith("/a.csv")
    with pytest.raises(ValueError, match="no files"):
        list_tables(spark, str(tmp_path / "folder"))


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")
    assert new_path(spark, "x").startswith(shared_folder(spark))


# -- sinks


def test_sink_modes(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    for make, read in ((sinks.csv_sink, spark.read.csv), (sinks.parquet_sink, spark.read.parquet)):
        sink = make(str(tmp_path / make.__name__))
        sink("t", one)
        sink("t", two)
        path = str(tmp_path / make.__name__ / "t")
        rows = spark.read.option("header", True).format("csv" if "csv" in make.__name__ else "parquet").load(path)
        assert rows.count() == 1


def test_table_sink_overwrites(spark):
    sink = sinks.table_sink("default")
    sink("masked_t", spark.range(1))
    sink("masked_t", spark.range(3))
    assert spark.table("default.masked_t").count() == 3
    spark.sql("drop table default.masked_t")


def test_text_sink(spark, tmp_path):
    sinks.text_sink(str(tmp_path))("t", spark.createDataFrame([("a",), ("b c",)], "x string"))
    assert {r[0] for r in spark.read.text(str(tmp_path / "t")).collect()} == {"a", "b c"}


# -- JDBC


def test_connection_from_json():
    text = json.dumps({"connection_url": "jdbc:x:y", "username": "u", "password": "p"})
    found = jdbc.JdbcConnection.from_json(text)
    assert found.options() == {"url": "jdbc:x:y", "user": "u", "password": "p"}
    assert "'p'" not in repr(found)
    assert jdbc.JdbcConnection.from_json('{"connection_url": "u", "format": "jdbc"}').user == ""


@pytest.mark.parametrize("text", [None, "{", '{"connection_url": "u", "format": "ftp"}', "{}"])
def test_bad_connections(text):
    with pytest.raises(ValueError):
        jdbc.JdbcConnection.from_json(text)


def test_connection_from_properties():
    found = jdbc.JdbcConnection.from_properties({"url": "u", "schema": "s", "driver": "d"})
    assert found.table("t") == "s.t"
    assert found.read_options("t") == {
        "url": "u", "user": "", "password": "", "driver": "d", "dbtable": "s.t", "fetchsize": "10000",
    }
    assert found.write_options("t")["batchsize"] == "10000"


def test_range_options():
    assert jdbc.range_options("id", 1, 9, 4) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }
    assert jdbc.range_options("id", None, None, 4) == {}
    assert jdbc.bound_text(decimal.Decimal("12.0")) == "12"
    assert jdbc.bound_text(dt.date(2001, 2, 3)) == "2001-02-03"
    assert jdbc.bound_text(dt.datetime(2001, 2, 3, 4)) == "2001-02-03 04:00:00"
    assert "min(id)" in jdbc.bounds_query("t", "id") and "FROM t" in jdbc.bounds_query("t", "id")


def test_csv_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, paths, infer_types=False).collect()
    assert read_csv(spark, paths[:1]).select("y").collect() == [(2,)]


class FakeReader:
    """Stands in for spark.read: records options, answers the bounds query."""

    def __init__(self, bounds):
        self.bounds, self.loads = bounds, []

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.current = options
        return self

    def load(self):
        self.loads.append(self.current)
        return self

    def jdbc(self, url, table, predicates, properties):
        self.loads.append((url, table, predicates, properties))
        return self

    def first(self):
        return self.bounds


def test_read_jdbc_in_ranges(spark):
    class Session:
        read = FakeReader((3, 11))
        sparkContext = spark.sparkContext

    connection = jdbc.JdbcConnection("u", schema="s")
    jdbc.read_jdbc(Session, connection, "t", "id", partitions=4)
    query, table = Session.read.loads
    assert "FROM s.t" in query["dbtable"]
    assert table["dbtable"] == "s.t" and table["lowerBound"] == "3" and table["upperBound"] == "11"
    Session.read = FakeReader((None, None))
    jdbc.read_jdbc(Session, connection, "t", "id")
    assert "lowerBound" not in Session.read.loads[1]
    Session.read = FakeReader(None)
    jdbc.read_jdbc(Session, connection, "t")
    assert len(Session.read.loads) == 1
    Session.read = FakeReader(None)
    jdbc.read_jdbc(Session, connection, "t", "id", cuts=[5])
    url, table, predicates, properties = Session.read.loads[0]
    assert (url, table) == ("u", "s.t") and "url" not in properties
    assert predicates == ["id < 5 OR id IS NULL", "id >= 5"]


def test_write_jdbc():
    class Writer(FakeReader):
        def mode(self, mode):
            self.current["mode"] = mode
            return self

        def save(self):
            self.loads.append(self.current)

    class Table:
        write = Writer(None)

    jdbc.write_jdbc(Table, jdbc.JdbcConnection("u"), "t", "append")
    sinks.jdbc_sink(jdbc.JdbcConnection("u", schema="s"))("t", Table)
    first, second = Table.write.loads
    assert first["mode"] == "append" and first["dbtable"] == "t" and first["truncate"] == "false"
    assert second["mode"] == "overwrite" and second["dbtable"] == "s.t"
    assert second["numPartitions"] == "32"


DAYS = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(10)]
TIMES = [dt.datetime(2020, 1, 1, 5, 6, 7, 800) + dt.timedelta(hours=k) for k in range(10)]
PRICES = [decimal.Decimal(k) / 4 for k in range(10)]


@pytest.mark.parametrize(
    "dtype,values,cuts",
    [
        ("int", range(10), []),
        ("int", range(10), [5]),
        ("bigint", range(10), [2, 5, 5, 8]),
        ("double", [k / 8 for k in range(10)], [0.25, 0.9]),
        ("decimal(9,2)", PRICES, [PRICES[2], decimal.Decimal("1.30")]),
        ("date", DAYS, DAYS[3:6:2]),
        ("timestamp_ntz", TIMES, [TIMES[2], TIMES[7]]),
        ("string", [chr(ord("k") + k) + "'s" for k in range(10)], ["m", "o's", "zz"]),
    ],
)
def test_range_predicates_cover_every_row_once(spark, dtype, values, cuts):
    df = spark.createDataFrame([(v,) for v in [None, *values]], f"id {dtype}")
    tests = jdbc.range_predicates("id", cuts)
    parts = [{r["id"] for r in df.where(test).collect()} for test in tests]
    assert sum(map(len, parts)) == 11
    # a cut is the first value of its range
    for cut, part in zip(cuts, parts[1:]):
        assert all(v >= cut for v in part)
    assert len([part for part in parts if part]) == len(set(cuts)) + 1 or dtype in ("bigint", "string")


def test_cuts_have_a_type():
    assert jdbc.bound_literal(dt.date(2020, 1, 1)) == "DATE '2020-01-01'"
    assert jdbc.bound_literal("it's") == "'it''s'" and jdbc.bound_literal(decimal.Decimal("1E+2")) == "100"
    with pytest.raises(ValueError):
        jdbc.range_predicates("id", [None])


# -- fixed width

LAYOUT = [
    Field("id", 5, "9"),
    Field("name", 6, "X"),
    Field("amount", 8, "-9.99"),
    Field("day", 10, "YYYY-MM-DD"),
]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def cut(spark, *values, mode="FAILFAST", layout=LAYOUT):
    return [tuple(r) for r in split_lines(lines(spark, *values), layout, mode).collect()]


def test_layout_document():
    text = '[{"name": "a", "length": 3, "format": "X"}, {"name": "b", "length": 9, "format": "-9.9999"}]'
    layout = parse_layout(text)
    assert layout_schema(layout).simpleString() == "struct<a:string,b:double>"
    assert layout_width(layout) == 12
    with pytest.raises(ValueError, match="'Q'"):
        parse_layout('[{"name": "a", "length": 3, "format": "Q"}]')


def test_claim_layouts():
    sizes = {name: (len(layout), layout_width(layout)) for name, layout in CLAIM_LAYOUTS.items()}
    assert sizes == {
        "cclf1": (29, 176), "cclf2": (20, 150), "cclf3": (10, 82), "cclf4": (11, 80),
        "cclf5": (42, 307), "cclf6": (24, 216), "cclf7": (19, 171), "cclf8": (16, 155),
        "cclf9": (5, 54),
    }


def test_tokens(spark):
    assert cut(
        spark,
        "   42  ann    12.502001-02-03",
        "abc  \tb\t          Z5/6/2001  extra",
        "~          1e2     05/06/12  ",
    ) == [
        (42, "ann", 12.5, dt.date(2001, 2, 3)),
        (0, "b", 0.0, dt.date(2001, 5, 6)),
        (0, "", 100.0, dt.date(12, 5, 6)),
    ]


def test_blank_fields(spark):
    assert cut(spark, "           0                 ") == [(0, "", 0.0, None)]


def test_first_day_sentinel(spark):
    assert cut(spark, "    1x     0       1000-01-01") == [(1, "x", 0.0, dt.date(1000, 1, 1))]


def test_empty_layout(spark):
    assert split_lines(lines(spark, "abc"), []).columns == []


@pytest.mark.parametrize(
    "line, message",
    [
        ("123", "length at least 5; got one of length 3"),
        ("12345abcde", "length at least 11; got one of length 10"),
        ("", "length at least 5; got one of length 0"),
        ("    1ann   bad     2001-02-03", "unreadable value in field amount"),
        ("    1ann           2001-02-03", "unreadable value in field amount"),
        ("    1ann   1       2001/02/03", "unreadable value in field day"),
        ("    1ann   1       2001-13-03", "unreadable value in field day"),
    ],
)
def test_faulty_lines(spark, line, message):
    with pytest.raises(PySparkException, match=message):
        cut(spark, line)
    row = cut(spark, line, mode="PERMISSIVE")[0]
    assert row[-1] == line
    assert cut(spark, "    1ann   1       2001-02-03", mode="PERMISSIVE")[0][-1] is None


def test_unselected_columns_are_not_checked(spark):
    df = split_lines(lines(spark, "    1ann   bad     2001-02-03"), LAYOUT)
    assert df.select("id", "day").collect() == [(1, dt.date(2001, 2, 3))]


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        split_lines(lines(spark, ""), LAYOUT, "DROP")


def test_path_and_layout_are_needed(spark):
    with pytest.raises(ValueError, match="path"):
        read_fixed_width(spark, "", LAYOUT)
    with pytest.raises(ValueError, match="layout"):
        read_fixed_width(spark, "x", None)
    with pytest.raises(ValueError, match="path"):
        write_fixed_width(spark.range(1), "", LAYOUT)


SCHEMA = "id bigint, name string, amount double, day date"


def written(df, **options):
    return [r[0] for r in format_lines(df, LAYOUT, **options).collect()]


def test_written_lines(spark):
    rows = [(42, "ann", 12.5, dt.date(2001, 2, 3)), (None, None, None, None)]
    assert written(spark.createDataFrame(rows, SCHEMA)) == [
        "42   ann   12.5    02/03/2001",
        " " * 29,
    ]


def test_absent_columns(spark):
    assert written(spark.range(1).select(F.lit(1).alias("other"))) == ["0    0     0.0               "]


@pytest.mark.parametrize("row", [(123456, "a", 1.0, None), (1, "toolong", 1.0, None), (1, "a", 1234567.125, None)])
def test_values_too_wide(spark, row):
    df = spark.createDataFrame([row], SCHEMA)
    with pytest.raises(PySparkException, match="longer than field"):
        written(df)
    assert len(written(df, truncate=True)[0]) == 29


def test_types_must_fit(spark):
    for bad in ("'x' as id", "1.5d as id", "true as amount", "'2001-01-01' as day"):
        with pytest.raises(ValueError, match="field"):
            format_lines(spark.sql(f"select {bad}"), LAYOUT)
    df = spark.sql("select * from values ('x'), ('7'), (null) as t(id)")
    assert [v[:5] for v in written(df, zero_numbers=True)] == ["0    ", "7    ", "     "]


def test_timestamps_are_written_as_dates(spark):
    df = spark.sql("select timestamp_ntz'2001-02-03 04:05:06' as day, 1 as amount")
    assert written(df) == ["0    0     1.0     02/03/2001"]


def test_roundtrip(spark, tmp_path):
    rows = [(i, f"n{i}", i / 4, dt.date(2000, 1, 1) + dt.timedelta(days=i)) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "lines")
    write_fixed_width(df, path, LAYOUT)
    assert sorted(read_fixed_width(spark, path, LAYOUT).collect()) == rows
    with pytest.raises(PySparkException):
        write_fixed_width(df, path, LAYOUT)
    write_fixed_width(df, path, LAYOUT, mode="append")
    assert read_fixed_width(spark, path, LAYOUT).count() == 200
    write_fixed_width(df, path, LAYOUT, mode="ignore")
    assert read_fixed_width(spark, path, LAYOUT).count() == 200
    write_fixed_width(df, path, LAYOUT, mode="overwrite")
    assert read_fixed_width(spark, path, LAYOUT).count() == 100


def test_dates_read_from_lines_can_be_computed_with(spark):
    df = split_lines(lines(spark, "    1ann   1       2001-02-03"), LAYOUT)
    out = df.select(F.date_add("day", 5), F.datediff("day", F.lit("2001-01-01").cast("date")))
    assert out.collect() == [(dt.date(2001, 2, 8), 33)]


def test_claim_header_width_after_masking(spark, mask):
    layout = CLAIM_LAYOUTS["cclf1"]
    blank = {f.name: " " * f.length for f in layout}
    line = "".join(
        {"9": "7", "X": "a", "YYYY-MM-DD": "1995-10-21"}.get(f.format, "200.00").ljust(f.length) for f in layout
    )
    assert len(line) == 176 == sum(map(len, blank.values()))
    df = split_lines(lines(spark, line), layout)
    out = mask(df, {"CLM_TYPE_CD": "Identity", "CLM_FROM_DT": "Year", "BENE_HIC_NUM": "Clear"})
    got = [r[0] for r in format_lines(out, layout).collect()]
    assert len(got[0]) == 176
    back = split_lines(lines(spark, got[0]), layout).collect()[0]
    assert back["CLM_TYPE_CD"] == 7 and back["CLM_FROM_DT"] == dt.date(1998, 1, 1)
    assert back["PRVDR_OSCAR_NUM"] == "0" and back["BENE_HIC_NUM"] == ""


def test_hashed_numbers_in_claim_lines(spark, mask):
    """A hash fits no whole-number field: an error, or 0 where asked for."""
    layout = [Field("id", 6, "9"), Field("name", 10, "X")]
    df = spark.createDataFrame([(7, "ann")], "id bigint, name string")
    hashed = {"type": "Hash", "salt_key": "k"}
    out = mask(df, {"id": hashed, "name": hashed})
    with pytest.raises(ValueError, match="cannot hold string"):
        format_lines(out, layout)
    with pytest.raises(PySparkException, match="longer than field name"):
        format_lines(out, layout, zero_numbers=True).collect()
    line = format_lines(out, layout, truncate=True, zero_numbers=True).collect()[0][0]
    assert line[:6] == "0     " and len(line) == 16 and line[6:].isalnum()
