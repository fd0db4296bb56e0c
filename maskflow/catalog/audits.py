"""Checks that masking is complete and keeps joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskflow.catalog.registry import load, masked, policy, query, salted, sql_hash
from maskflow.operators.audit import join_size, joins_preserved, leak_report, leaked_values
from maskflow.operators.masking import deidentify
from maskflow.plans.options import MaskOptions
from maskflow.plans.salts import Salts
from maskflow.sources.shared import new_path
from maskflow.sources.sinks import table_sink


def _masked_orders(spark, folder, **options):
    return masked(
        load(spark, folder, "orders"),
        {
            "o_orderkey": "Identity",
            "o_custkey": salted("Hash", "person"),
            "o_orderpriority": "Clear",
        },
        hash_bits=256,
        **options,
    )


@query(
    "leaked_values",
    f"""
    SELECT value FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS value FROM orders
        INTERSECT SELECT {sql_hash("o_custkey", "person")} FROM orders)
    """,
)
def leaked(spark, folder):
    """Raw ids found among the masked ones: none."""
    raw = load(spark, folder, "orders")
    return leaked_values(raw, _masked_orders(spark, folder), "o_custkey", "o_custkey")


@query(
    "planted_leaks",
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def planted(spark, folder):
    """Ids that a faulty masking has let through, those of urgent orders, among all others."""
    raw = load(spark, folder, "orders")
    hidden = masked(
        raw,
        {"o_custkey": ["Duplicate", salted("Hash", "person")], "o_orderpriority": "Identity"},
        hash_bits=256,
        keep_derived=True,
    )
    faulty = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey_duplicate").cast("string"))
    faulty = hidden.withColumn("o_custkey", F.coalesce(faulty, "o_custkey"))
    return leaked_values(raw, faulty, "o_custkey", "o_custkey")


@query(
    "leak_report",
    """
    SELECT 'o_orderkey' AS column, count(DISTINCT o_orderkey) AS raw_values,
           count(DISTINCT o_orderkey) AS masked_values, count(DISTINCT o_orderkey) AS leaked_values
    FROM orders
    UNION ALL
    SELECT 'o_custkey', count(DISTINCT o_custkey), count(DISTINCT o_custkey), 0 FROM orders
    UNION ALL
    SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), 1, 0 FROM orders
    """,
)
def report(spark, folder):
    raw = load(spark, folder, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return leak_report(raw, _masked_orders(spark, folder), names)


@query(
    "joins_preserved",
    """
    SELECT count(*) AS raw_rows, count(*) AS masked_rows
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def preserved(spark, folder):
    """Differently named keys under one salt key join as the raw ones do."""
    people, orders = load(spark, folder, "customer"), load(spark, folder, "orders")
    hidden = masked(people, {"c_custkey": salted("Hash", "person")})
    hidden_orders = masked(orders, {"o_custkey": salted("Hash", "person")})
    return joins_preserved((people, orders), (hidden, hidden_orders), "c_custkey", "o_custkey")


@query(
    "joins_preserved_bucketed",
    """
    SELECT count(*) AS raw_rows, count(*) AS masked_rows
    FROM customer JOIN orders ON c_custkey = o_custkey
    """,
)
def preserved_in_buckets(spark, folder):
    """The same for masked tables bucketed by their pseudonyms, which join without a shuffle."""
    people, orders = load(spark, folder, "customer"), load(spark, folder, "orders")
    hidden = bucketed(spark, people, orders)
    return joins_preserved((people, orders), hidden, "c_custkey", "o_custkey")


def bucketed(spark, people, orders, number=8):
    """Customers and orders masked into tables of ``number`` buckets, which the catalog then
    forgets; their files stay."""
    out = new_path(spark, "buckets")
    mark = out.rsplit("-", 1)[-1]
    names = f"customer_{mark}", f"orders_{mark}"
    keys = "c_custkey", "o_custkey"
    sink = table_sink("default", folder=out, buckets={name: (number, [key]) for name, key in zip(names, keys)})
    for name, key, df in zip(names, keys, (people, orders)):
        sink(name, masked(df, {key: salted("Hash", "person")}, hash_bits=256))
    tables = tuple(spark.table(f"default.{name}") for name in names)
    for name in names:
        spark.sql(f"DROP TABLE default.{name}")
    return tables


@query("salt_by_column", "SELECT 0::BIGINT AS masked_rows")
def salt_by_column(spark, folder):
    """Salted by column name instead, they no longer join."""
    salts = Salts({"c_custkey": "salt-a", "o_custkey": "salt-b"})
    people, orders = (
        deidentify(
            load(spark, folder, table),
            policy({column: salted("Hash", "person")}),
            salts,
            MaskOptions(salt_by="column"),
        )
        for table, column in (("customer", "c_custkey"), ("orders", "o_custkey"))
    )
    size = join_size(people, orders, "c_custkey", "o_custkey")
    return size.select(F.col("n_rows").alias("masked_rows"))
