"""Sources and sinks: every query writes a given table and reads it back."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from maskflow.catalog.registry import (
    AS_OF,
    SALTS,
    load,
    masked,
    policy,
    query,
    salted,
    sql_floored,
    sql_hash,
    sql_zip3,
)
from maskflow.catalog.strategies import RAW_NAME, RAW_ZIP
from maskflow.functions.vocabulary import RESTRICTED_ZIP3
from maskflow.plans.jobs import mask_csv_folder, mask_fixed_width_folder
from maskflow.plans.options import MaskOptions
from maskflow.sources.files import read_csv, read_json
from maskflow.sources.fixedwidth import (
    CORRUPT,
    Field,
    read_fixed_width,
    split_lines,
    write_fixed_width,
)
from maskflow.sources.layouts import CLAIM_LAYOUTS
from maskflow.sources.shared import new_path
from maskflow.sources.sinks import csv_sink, fixed_width_sink, parquet_sink, table_sink, text_sink


@query(
    "csv_inferred",
    f"""
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey,
           CASE WHEN name = '' THEN NULL ELSE name END AS name,
           CASE WHEN zip = '' THEN NULL ELSE zip END AS zip, c_acctbal
    FROM (SELECT *, {RAW_NAME} AS name, {RAW_ZIP} AS zip FROM customer)
    """,
)
def csv_inferred(spark, folder):
    """Types are inferred, zips stay text; empty texts come back as null."""
    df = load(spark, folder, "customer").select(
        "c_custkey", F.expr(RAW_NAME).alias("name"), F.expr(RAW_ZIP).alias("zip"), "c_acctbal"
    )
    out = new_path(spark, "csv")
    csv_sink(out)("customer", df)
    return read_csv(spark, f"{out}/customer", text_columns=["ZIP"])


# Tables of plain columns, each written as CSV and typed anew.
TYPED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels")


@query(
    "csv_types",
    f"""
    SELECT table_name, column_name, CASE column_type WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
        WHEN 'DATE' THEN 'date' ELSE if(column_type LIKE '%INT%', 'int', 'timestamp') END AS type
    FROM ({" UNION ALL ".join(f"SELECT '{name}' AS table_name, column_name, column_type FROM (DESCRIBE {name})" for name in TYPED)})
    """,
)
def csv_types(spark, folder):
    """Types found in the cells of every table, the integers being small ones."""
    out = new_path(spark, "typed")
    write = csv_sink(out)
    found = []
    for name in TYPED:
        write(name, load(spark, folder, name))
        schema = read_csv(spark, f"{out}/{name}").schema
        found += [(name, field.name, field.dataType.simpleString()) for field in schema]
    return spark.createDataFrame(found, "table_name string, column_name string, type string")


@query(
    "csv_text",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate, o_orderpriority
    FROM orders
    """,
)
def csv_text(spark, folder):
    """Every column as text, in one pass."""
    out = new_path(spark, "csv")
    df = load(spark, folder, "orders")
    csv_sink(out)("orders", df.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    return read_csv(spark, f"{out}/orders", infer_types=False)


@query(
    "csv_skip_existing",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier",
)
def csv_skip_existing(spark, folder):
    """A folder that exists is left as it is."""
    out = new_path(spark, "csv")
    df = load(spark, folder, "supplier").select("s_suppkey", "s_name")
    csv_sink(out)("supplier", df)
    csv_sink(out)("supplier", df.withColumn("s_name", F.lit("second write")))
    return read_csv(spark, f"{out}/supplier", infer_types=False)


@query("json_lines", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_lines(spark, folder):
    out = new_path(spark, "json")
    load(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal").write.json(out)
    return read_json(spark, out)


@query(
    "catalog_table",
    f"SELECT c_custkey, {sql_hash('c_name', 'person')} AS c_name FROM customer",
)
def catalog_table(spark, folder):
    """The second write replaces the first."""
    out = new_path(spark, "tables")
    name = "customer_" + out.rsplit("-", 1)[-1]
    people = load(spark, folder, "customer").select("c_custkey", "c_name")
    sink = table_sink("default", folder=out)
    sink(name, people)
    rules = {"c_custkey": "Identity", "c_name": salted("Hash", "person")}
    sink(name, masked(people, rules, hash_bits=256))
    columns = spark.table(f"default.{name}").columns
    # The table is external: its files stay when the catalog forgets it.
    spark.sql(f"DROP TABLE default.{name}")
    return spark.read.parquet(f"{out}/{name}").select(*columns)


@query(
    "csv_folder_job",
    f"""
    SELECT {sql_hash("c_custkey", "person")} AS person,
           {sql_zip3("zip", RESTRICTED_ZIP3)} AS zip, n_orders, first_order
    FROM (SELECT c_custkey, nullif({RAW_ZIP}, '') AS zip FROM customer) AS people
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders,
                      min({sql_floored("year(o_orderdate)", 90)}) AS first_order
               FROM orders GROUP BY o_custkey) AS per_key
      ON o_custkey = c_custkey
    """,
)
def csv_folder_job(spark, folder):
    """A folder of CSV files masked under policies matched by name: two files of
    one table are read together. Empty texts of CSV files are null."""
    raw, out = new_path(spark, "raw"), new_path(spark, "masked")
    people = load(spark, folder, "customer").select("c_custkey", F.expr(RAW_ZIP).alias("zip"))
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    write = csv_sink(raw)
    write("people_of_even_keys.csv", people.where("c_custkey % 2 = 0"))
    write("people_of_odd_keys.csv", people.where("c_custkey % 2 = 1"))
    write("orders.csv", orders)
    mask_csv_folder(
        spark,
        raw,
        [
            policy({"c_custkey": salted("Hash", "person"), "zip": "Zip3Digit"}, "PEOPLE"),
            policy({"o_custkey": salted("Hash", "person"), "o_orderdate": "Year"}, "orders"),
        ],
        parquet_sink(out),
        SALTS,
        MaskOptions(as_of_year=AS_OF, hash_bits=256),
    )
    per_key = (
        spark.read.parquet(f"{out}/orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.min("o_orderdate").alias("first_order"))
    )
    masked_people = spark.read.parquet(f"{out}/PEOPLE")
    return masked_people.join(per_key, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("person"), "zip", "n_orders", "first_order"
    )


ITEM_LAYOUT = [
    Field("l_orderkey", 13, "9"),
    Field("l_linenumber", 3, "9"),
    Field("l_returnflag", 2, "X"),
    Field("l_shipdate", 10, "YYYY-MM-DD"),
    Field("l_extendedprice", 17, "-9.99"),
    Field("l_discount", 6, "-9.9999"),
    Field("absent_text", 4, "X"),
    Field("absent_number", 4, "9"),
    Field("absent_date", 10, "YYYY-MM-DD"),
]


@query(
    "fixed_width_roundtrip",
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           coalesce(l_returnflag, '') AS l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate,
           l_extendedprice, l_discount, '0' AS absent_text, 0::BIGINT AS absent_number,
           NULL::DATE AS absent_date
    FROM lineitem
    """,
)
def fixed_width_roundtrip(spark, folder):
    out = new_path(spark, "lines")
    write_fixed_width(load(spark, folder, "lineitem"), out, ITEM_LAYOUT)
    return read_fixed_width(spark, out, ITEM_LAYOUT)


FAULTY_LAYOUT = [
    Field("id", 8, "9"),
    Field("amount", 9, "-9.99"),
    Field("day", 10, "YYYY-MM-DD"),
    Field("note", 4, "X"),
]
# Lines made of orders: whole ones, ones too short, ones with faulty fields.
FAULTY_LINE = """
    CASE o_orderkey % 8 WHEN 0 THEN substr(line, 1, 20)
         WHEN 1 THEN 'abc     ' || substr(line, 9) WHEN 2 THEN substr(line, 1, 8) || 'Z        ' || substr(line, 18)
         WHEN 3 THEN substr(line, 1, 8) || 'ten      ' || substr(line, 18)
         WHEN 4 THEN substr(line, 1, 17) || '          ' || substr(line, 28)
         WHEN 5 THEN substr(line, 1, 17) || '13/45/2010' || substr(line, 28)
         WHEN 6 THEN line || ' and more' ELSE line END
"""


@query(
    "fixed_width_faults",
    f"""
    WITH parts AS (
        SELECT o_orderkey, o_totalprice, o_orderdate,
               rpad(CAST(o_orderkey AS VARCHAR), 8, ' ')
               || rpad(CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR), 9, ' ')
               || strftime(o_orderdate, '%m/%d/%Y') || ' ab ' AS line
        FROM orders),
    lines AS (SELECT *, {FAULTY_LINE} AS value FROM parts)
    SELECT CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE o_orderkey END AS id,
           CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 2 THEN 0.0 WHEN 3 THEN NULL
                ELSE floor(o_totalprice) END AS amount,
           CASE WHEN o_orderkey % 8 IN (0, 4, 5) THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
           CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'ab' END AS note,
           CASE WHEN o_orderkey % 8 IN (0, 3, 5) THEN value END AS _corrupt_record
    FROM lines
    """,
)
def fixed_width_faults(spark, folder):
    """Faulty lines read with PERMISSIVE keep the line; blank dates and unreadable
    whole numbers are no faults."""
    line = F.concat(
        F.rpad(F.col("o_orderkey").cast("string"), 8, " "),
        F.rpad(F.floor("o_totalprice").cast("string"), 9, " "),
        F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.lit(" ab "),
    )
    lines = load(spark, folder, "orders").select("o_orderkey", line.alias("line"))
    lines = lines.select(F.expr(FAULTY_LINE).alias("value"))
    out = split_lines(lines, FAULTY_LAYOUT, "PERMISSIVE")
    return out.select("id", "amount", "day", "note", CORRUPT)


MEMBER_POLICY = {
    "BENE_HIC_NUM": salted("Hash", "person"),
    "BENE_ZIP_CD": "Zip3Digit",
    "BENE_DOB": "Year",
    "BENE_AGE": "Age",
    "BENE_SEX_CD": "Identity",
    "BENE_1ST_NAME": "FixedFirstName",
    "BENE_LAST_NAME": "FixedLastName",
}


@query(
    "claims_folder_job",
    f"""
    SELECT {sql_hash("lpad(CAST(c_custkey AS VARCHAR), 11, '0')", "person")} AS BENE_HIC_NUM,
           {sql_zip3("zip", RESTRICTED_ZIP3)} AS BENE_ZIP_CD,
           {sql_floored("year(birth)", 90)} AS BENE_DOB,
           least(c_custkey % 120, 90) AS BENE_AGE, '1' AS BENE_SEX_CD,
           'FirstName' AS BENE_1ST_NAME, 'LastName' AS BENE_LAST_NAME
    FROM (SELECT c_custkey, coalesce({RAW_ZIP}, '') AS zip,
                 DATE '1990-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS birth
          FROM customer)
    """,
)
def claims_folder_job(spark, folder):
    """Member lines of the claim feed, made of customers: written by their layout,
    masked as a folder job, layout and policy found by file name."""
    people = load(spark, folder, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("BENE_HIC_NUM"),
        F.expr(RAW_ZIP).alias("BENE_ZIP_CD"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 9000).cast("int")).alias(
            "BENE_DOB"
        ),
        F.lit("1").alias("BENE_SEX_CD"),
        (F.col("c_custkey") % 120).alias("BENE_AGE"),
        F.col("c_name").alias("BENE_LAST_NAME"),
    )
    raw, out = new_path(spark, "claims"), new_path(spark, "masked")
    name = "cclf8_members.fil"
    fixed_width_sink(raw, {name: CLAIM_LAYOUTS["cclf8"]})(name, people)
    mask_fixed_width_folder(
        spark,
        raw,
        [policy(MEMBER_POLICY, "cclf8")],
        parquet_sink(out),
        SALTS,
        MaskOptions(as_of_year=AS_OF, hash_bits=256),
    )
    return spark.read.parquet(f"{out}/cclf8")


@query(
    "masked_fixed_width",
    "SELECT 69 AS width, count(*) AS n_lines, count(*) AS without_flag FROM lineitem",
)
def masked_fixed_width(spark, folder):
    """Lines keep their width although masking dropped columns; a dropped text
    column reads 0."""
    out = new_path(spark, "lines")
    items = masked(
        load(spark, folder, "lineitem"),
        {"l_orderkey": "Identity", "l_shipdate": "Year", "l_extendedprice": "Age"},
    )
    write_fixed_width(items, out, ITEM_LAYOUT)
    return (
        spark.read.text(out)
        .groupBy(F.length("value").alias("width"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.count_if(F.substring("value", 17, 2) == "0 ").alias("without_flag"),
        )
    )


@query(
    "save_modes",
    """
    SELECT 'append' AS mode, 2 * count(*) AS n_lines FROM nation
    UNION ALL SELECT 'ignore', count(*) FROM nation
    UNION ALL SELECT 'overwrite', count(*) FROM nation
    UNION ALL SELECT 'error', count(*) FROM nation
    UNION ALL SELECT 'error, refused', count(*) FROM nation
    """,
)
def save_modes(spark, folder):
    """Lines after writing nations twice under each mode; under ``error`` the second
    write must fail and leave the first as it is."""
    nations = load(spark, folder, "nation")
    layout = [Field("n_nationkey", 4, "9"), Field("n_name", 25, "X")]
    counts = None
    for mode in ("append", "ignore", "overwrite", "error"):
        out = new_path(spark, f"lines-{mode}")
        write_fixed_width(nations, out, layout, mode=mode)
        labels = [mode]
        try:
            write_fixed_width(nations, out, layout, mode=mode)
        except AnalysisException:
            labels.append(f"{mode}, refused")
        for label in labels:
            count = spark.read.text(out).agg(
                F.lit(label).alias("mode"), F.count(F.lit(1)).alias("n_lines")
            )
            counts = count if counts is None else counts.unionAll(count)
    return counts


@query(
    "text_dump",
    """
    SELECT concat_ws(chr(9), page_id, url, replace(replace(html, chr(10), ' '), chr(13), ' ')) AS value
    FROM pages
    """,
)
def text_dump(spark, folder):
    """Whole pages, a line each with tabs between the columns."""
    out = new_path(spark, "text")
    pages = masked(
        load(spark, folder, "pages"), {"page_id": "Identity", "url": "Identity", "html": "Identity"}
    )
    lines = pages.select(F.concat_ws("\t", "page_id", "url", "html").alias("value"))
    text_sink(out)("pages", lines)
    return spark.read.text(f"{out}/pages")
