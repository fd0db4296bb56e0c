"""Filters, projections, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskflow.catalog.registry import load, query
from maskflow.catalog.strategies import RAW_NAME
from maskflow.operators import relational
from maskflow.operators.ranges import even_cuts, range_sizes
from maskflow.sources.files import read_json
from maskflow.sources.jdbc import column_bounds
from maskflow.sources.shared import new_path


@query(
    "not_null_select",
    f"SELECT name FROM (SELECT {RAW_NAME} AS name FROM customer) WHERE name IS NOT NULL",
)
def not_null_select(spark, folder):
    named = load(spark, folder, "customer").withColumn("name", F.expr(RAW_NAME))
    return relational.not_null(named, "name").select("name")


@query(
    "null_or_empty",
    f"""
    SELECT c_custkey, name FROM (SELECT c_custkey, {RAW_NAME} AS name FROM customer)
    WHERE name IS NULL OR name = ''
    """,
)
def null_or_empty(spark, folder):
    named = load(spark, folder, "customer").withColumn("name", F.expr(RAW_NAME))
    return relational.null_or_empty(named, "name").select("c_custkey", "name")


@query(
    "sum_columns",
    "SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_discount + l_tax AS sum FROM lineitem",
)
def sum_columns(spark, folder):
    items = load(spark, folder, "lineitem")
    return relational.with_sum(
        items.select("l_orderkey", "l_linenumber", "l_discount", "l_tax"), "l_discount", "l_tax"
    )


@query(
    "days_since_epoch",
    """
    SELECT o_orderdate, days AS since_epoch, CAST(o_orderdate AS DATE) + days AS moved
    FROM (SELECT o_orderdate,
                 CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)
                 AS days
          FROM orders WHERE o_orderdate IS NOT NULL)
    """,
)
def days_since_epoch(spark, folder):
    dated = relational.not_null(load(spark, folder, "orders"), "o_orderdate")
    days = relational.days_since_epoch(F.col("o_orderdate"))
    return (
        dated.select("o_orderdate")
        .withColumn("since_epoch", days)
        .withColumn("moved", F.date_add("o_orderdate", F.col("since_epoch")))
    )


@query(
    "join_two_sources",
    """
    SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def join_two_sources(spark, folder):
    """Parquet orders joined with customers kept as JSON lines."""
    customers = load(spark, folder, "customer")
    path = new_path(spark, "customers-json")
    customers.write.json(path)
    people = read_json(spark, path, customers.schema)
    joined = relational.join_on(load(spark, folder, "orders"), people, "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    "join_chain_count",
    """
    SELECT c_mktsegment, count(*) AS count
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY c_mktsegment
    """,
)
def join_chain_count(spark, folder):
    return relational.count_through_chain(
        load(spark, folder, "customer"),
        load(spark, folder, "orders"),
        load(spark, folder, "lineitem"),
        name="c_mktsegment",
        named_key="c_custkey",
        linked_to_named="o_custkey",
        linked_key="o_orderkey",
        fact_key="l_orderkey",
    )


@query(
    "group_count",
    "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
)
def group_count(spark, folder):
    return load(spark, folder, "events").groupBy("event_type").count()


@query(
    "column_bounds",
    "SELECT min(l_orderkey) AS min_id, max(l_orderkey) AS max_id FROM lineitem",
)
def bounds(spark, folder):
    return column_bounds(load(spark, folder, "lineitem"), "l_orderkey")


# Keys as tables have them, crowded at one end, texts that begin alike, days, and stamps.
RANGE_KEYS = {
    "orderkey": "l_orderkey",
    # As a double, since a third power of keys in the millions is beyond a bigint.
    "crowded": "cast(l_orderkey AS double) * l_orderkey * l_orderkey * l_linenumber",
    "text": "concat('order-', lpad(cast(l_orderkey AS string), 12, '0'), '-', l_linenumber)",
    "day": "cast(l_shipdate AS date)",
    "price": "l_extendedprice",
}
RANGES = 16


@query(
    "even_ranges",
    " UNION ALL ".join(
        f"SELECT '{name}' AS key, count(*) AS n_rows, true AS even FROM lineitem" for name in RANGE_KEYS
    ),
)
def even_ranges(spark, folder):
    """Ranges of keys of several kinds: every row is in one, and none holds more than its
    share and a hundredth of all rows."""
    found = None
    for name, expression in RANGE_KEYS.items():
        keys = load(spark, folder, "lineitem").select(F.expr(expression).alias("key"))
        sizes = range_sizes(keys, "key", even_cuts(keys, "key", RANGES))
        even = F.max("n_rows") <= F.sum("n_rows") * (1 / RANGES + 0.01)
        row = sizes.agg(F.lit(name).alias("key"), F.sum("n_rows").alias("n_rows"), even.alias("even"))
        found = row if found is None else found.unionAll(row)
    return found
