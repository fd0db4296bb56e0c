"""Table-level masking: chains, derived columns, datasets, streams."""

from __future__ import annotations

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
from maskflow.catalog.strategies import RAW_NAME, RAW_ZIP, sql_shift, with_raw_name
from maskflow.functions.vocabulary import RESTRICTED_ZIP3
from maskflow.plans.jobs import deidentify_dataset
from maskflow.plans.options import MaskOptions
from maskflow.sources.shared import new_path
from maskflow.sources.sinks import parquet_sink
from maskflow.streaming.masking import deidentify_stream, write_stream

ORDERS_POLICY = {
    "O_ORDERKEY": "Identity",
    "o_custkey": salted("Hash", "person"),
    "o_orderstatus": ["Identity"],
    "o_orderdate": "Year",
    "o_orderpriority": "FixedFirstName",
}
ORDERS_SQL = f"""
    SELECT o_orderkey, {sql_hash("o_custkey", "person")} AS o_custkey, o_orderstatus,
           {sql_floored("year(o_orderdate)", 90)} AS o_orderdate,
           'FirstName' AS o_orderpriority
    FROM orders
"""


@query("deidentify_orders", ORDERS_SQL)
def deidentify_orders(spark, folder):
    """Default-deny: o_totalprice has no strategy and is gone."""
    return masked(load(spark, folder, "orders"), ORDERS_POLICY, hash_bits=256)


@query(
    "filter_through_masking",
    f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderstatus = 'F'",
)
def filter_through_masking(spark, folder):
    """Rows are picked below the masking, where the filter reaches the scan."""
    return masked(
        load(spark, folder, "orders"),
        ORDERS_POLICY,
        where=F.col("o_orderstatus") == "F",
        hash_bits=256,
    )


@query(
    "deidentify_lineitem",
    f"""
    SELECT {sql_hash("l_orderkey", "event")} AS l_orderkey,
           {sql_hash("l_suppkey", "person")} AS l_suppkey,
           l_linenumber, l_quantity, least(l_extendedprice, 90) AS l_extendedprice,
           l_returnflag, ' ' AS l_linestatus,
           CAST(l_shipdate AS DATE) + {sql_shift("l_suppkey", "0")} AS l_shipdate
    FROM lineitem
    """,
)
def deidentify_lineitem(spark, folder):
    return masked(
        load(spark, folder, "lineitem"),
        {
            "l_orderkey": salted("Hash", "event"),
            "l_suppkey": salted("Hash", "person"),
            "l_linenumber": "Identity",
            "l_quantity": "Identity",
            "l_extendedprice": "Age",
            "l_returnflag": "Identity",
            "l_linestatus": "Clear",
            "l_shipdate": "DateShift",
        },
        hash_bits=256,
        patient_column="l_suppkey",
    )


@query(
    "strategy_chains",
    f"""
    SELECT c_custkey,
           {sql_hash("(" + sql_zip3("zip", RESTRICTED_ZIP3) + ")", "place")} AS zip,
           {sql_hash("replace(replace(c_name, chr(10), ' '), chr(13), ' ')", "person")} AS c_name,
           c_name AS c_name_duplicate
    FROM (SELECT *, {RAW_ZIP} AS zip FROM customer)
    """,
)
def strategy_chains(spark, folder):
    """Lists of strategies run in order; a duplicate is of the value at its place."""
    df = load(spark, folder, "customer").withColumn("zip", F.expr(RAW_ZIP))
    return masked(
        df,
        {
            "c_custkey": "Identity",
            "zip": ["Zip3Digit", salted("Hash", "place")],
            "c_name": ["Identity", "Duplicate", salted("Hash", "person")],
            "c_name_duplicate": "Identity",
        },
        hash_bits=256,
    )


@query(
    "derived_columns",
    f"""
    SELECT o_orderkey, {sql_floored("year(o_orderdate)", 90)} AS o_orderdate,
           {sql_hash("o_custkey", "person")} AS o_custkey_duplicate,
           o_totalprice AS o_totalprice_duplicate
    FROM orders
    """,
)
def derived_columns(spark, folder):
    """A derived column is kept if listed, under strategies of its own, or with
    keep_derived; its source can be dropped."""
    return masked(
        load(spark, folder, "orders"),
        {
            "o_orderkey": "Identity",
            "o_custkey": ["Duplicate", "Drop"],
            "o_custkey_duplicate": salted("Hash", "person"),
            "o_totalprice": ["Duplicate", "Drop"],
            "o_orderdate": "Year",
        },
        keep_derived=True,
        hash_bits=256,
    )


@query(
    "cross_column_references",
    f"""
    SELECT event_id, {sql_hash("user_id", "person")} AS user_id,
           CAST(date_diff('day', started, ts) AS INTEGER) AS since,
           ts + to_days({sql_shift("user_id", "0")}) AS ts,
           {sql_floored("year(started)", 90)} AS started
    FROM (SELECT *, ts - to_years(CAST(event_id % 30 AS INTEGER)) AS started FROM events)
    """,
)
def cross_column_references(spark, folder):
    """Shifts and day counts read the other columns as the table has them, though
    those are masked too."""
    years = F.make_ym_interval((F.col("event_id") % 30).cast("int"))
    df = load(spark, folder, "events")
    df = df.withColumn("started", F.col("ts") - years).withColumn("since", F.col("ts"))
    return masked(
        df,
        {
            "event_id": "Identity",
            "user_id": salted("Hash", "person"),
            "started": "Year",
            "since": {"type": "DateEpoch", "date_epoch": "started"},
            "ts": "DateTimeShift",
        },
        hash_bits=256,
        patient_column="user_id",
    )


@query(
    "deidentify_dataset",
    f"""
    SELECT {sql_hash("c_custkey", "person")} AS c_custkey, c_mktsegment, count(*) AS n_orders,
           max({sql_floored("year(o_orderdate)", 89)}) AS last_order
    FROM customer JOIN orders ON c_custkey = o_custkey
    GROUP BY ALL
    """,
)
def masked_dataset(spark, folder):
    """Two tables masked by one job and written; differently named keys under one
    salt key still join."""
    out = new_path(spark, "dataset")
    deidentify_dataset(
        {name: load(spark, folder, name) for name in ("customer", "orders")},
        [
            policy(
                {"c_custkey": salted("Hash", "person"), "c_mktsegment": "Identity"}, "customer"
            ),
            policy({"o_custkey": salted("Hash", "person"), "o_orderdate": "DateDay"}, "orders"),
        ],
        parquet_sink(out),
        SALTS,
        MaskOptions(as_of_year=AS_OF, hash_bits=256),
    )
    people = spark.read.parquet(f"{out}/customer")
    # Orders are counted per key before the join, where a hot key is one row.
    per_key = (
        spark.read.parquet(f"{out}/orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order"))
    )
    return people.join(per_key, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey", "c_mktsegment", "n_orders", "last_order"
    )


@query(
    "dataset_counts",
    f"""
    SELECT 'customer' AS table_name, count(*) AS n_rows, 'c_name' AS column_name,
           count_if({RAW_NAME} IS NULL)::BIGINT AS n_nulls, 'c_acctbal,c_mktsegment,c_nationkey' AS dropped
    FROM customer
    UNION ALL
    SELECT 'orders', count(*), 'o_orderdate', count_if(o_orderkey % 9 = 0)::BIGINT, '' FROM orders
    """,
)
def dataset_counts(spark, folder):
    """Rows, nulls and dropped columns of two tables, counted while they were written."""
    people = with_raw_name(load(spark, folder, "customer"))
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    orders = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")))
    outcome = deidentify_dataset(
        {"customer": people, "orders": orders},
        [
            policy({"c_custkey": salted("Hash", "person"), "c_name": salted("Hash", "person")}, "customer"),
            policy({"o_orderkey": salted("Hash", "person"), "o_orderdate": "Year"}, "orders"),
        ],
        parquet_sink(new_path(spark, "counted")),
        SALTS,
        MaskOptions(as_of_year=AS_OF, hash_bits=256),
        count=True,
    )
    names = {"customer": "c_name", "orders": "o_orderdate"}
    rows = [
        (table, counts.rows, names[table], counts.nulls[names[table]], ",".join(sorted(counts.dropped)))
        for table, counts in outcome.counts.items()
    ]
    return spark.createDataFrame(
        rows, "table_name string, n_rows bigint, column_name string, n_nulls bigint, dropped string"
    )


@query(
    "masked_stream",
    f"""
    SELECT event_id, {sql_hash("user_id", "person")} AS user_id, event_type,
           ts + to_days({sql_shift("user_id", "0")}) AS ts, value
    FROM events
    """,
)
def masked_stream(spark, folder):
    """The events read, masked and written as a stream, in whole."""
    schema = load(spark, folder, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    )
    rules = policy(
        {
            "event_id": "Identity",
            "user_id": salted("Hash", "person"),
            "event_type": "Identity",
            "ts": "DateTimeShift",
            "value": "Identity",
        }
    )
    options = MaskOptions(as_of_year=AS_OF, hash_bits=256, patient_column="user_id")
    out = new_path(spark, "stream")
    running = write_stream(
        deidentify_stream(stream, rules, SALTS, options),
        f"{out}/rows",
        f"{out}/progress",
        available_now=True,
    )
    running.awaitTermination()
    return spark.read.parquet(f"{out}/rows")
