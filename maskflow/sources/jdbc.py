"""JDBC tables: plain and range-partitioned reads, overwrite and append."""

from __future__ import annotations

import datetime
import decimal
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskflow.operators.ranges import even_cuts


@dataclass(frozen=True)
class JdbcConnection:
    """Where a database is. Credentials never appear in its repr.

    ``write_connections`` bounds how many tasks write at a time: a cluster has
    more cores than a database takes connections.
    """

    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str | None = None
    schema: str = ""
    fetch_size: int = 10_000
    batch_size: int = 10_000
    write_connections: int = 32

    @classmethod
    def from_json(cls, text: str) -> JdbcConnection:
        """Connection of a document with connection_url, username, password, format."""
        if text is None:
            raise ValueError("connection text is None")
        document = json.loads(text)
        if document.get("format") not in (None, "jdbc"):
            raise ValueError(f"unknown connection format {document['format']!r}")
        if not document.get("connection_url"):
            raise ValueError("a connection needs connection_url")
        return cls(
            document["connection_url"],
            document.get("username") or "",
            document.get("password") or "",
            document.get("driver"),
            document.get("schema") or "",
        )

    @classmethod
    def from_properties(cls, properties: dict[str, str]) -> JdbcConnection:
        """Connection of job properties: url, schema, user, password, driver."""
        return cls(
            properties["url"],
            properties.get("user") or "",
            properties.get("password") or "",
            properties.get("driver"),
            properties.get("schema") or "",
        )

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def options(self) -> dict[str, str]:
        options = {"url": self.url, "user": self.user, "password": self.password}
        if self.driver:
            options["driver"] = self.driver
        return options

    def read_options(self, name: str, bounds: dict[str, str] | None = None) -> dict[str, str]:
        return {
            **self.options(),
            "dbtable": self.table(name),
            "fetchsize": str(self.fetch_size),
            **(bounds or {}),
        }

    def write_options(self, name: str) -> dict[str, str]:
        return {
            **self.options(),
            "dbtable": self.table(name),
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.write_connections),
        }


def bounds_query(table: str, column: str) -> str:
    """Derived table with the least and greatest value, computed by the database."""
    return f"(SELECT min({column}) AS min_id, max({column}) AS max_id FROM {table}) bounds"


def column_bounds(df: DataFrame, column: str) -> DataFrame:
    """The same over a DataFrame: one row (min_id, max_id)."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))


def bound_text(value) -> str:
    """A bound of a numeric, date or timestamp key as Spark's range reader takes it."""
    if isinstance(value, decimal.Decimal):
        return str(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return str(value)


def bound_literal(value) -> str:
    """A cut as an SQL literal of its type: quoted unless it is a number, and whole."""
    if isinstance(value, bool) or value is None:
        raise ValueError("cuts are numbers, texts, dates or timestamps")
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_options(column: str, low, high, partitions: int) -> dict[str, str]:
    """Reader options of a range-partitioned read; none for an empty table."""
    if low is None or high is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": bound_text(low),
        "upperBound": bound_text(high),
        "numPartitions": str(partitions),
    }


def range_predicates(column: str, cuts: list) -> list[str]:
    """One condition per partition, split at ``cuts``; every row meets exactly one.

    For keys whose values crowd: cuts at quantiles give even partitions where
    equal ranges would not. Cuts may be numbers, texts, dates or timestamps.
    """
    cuts = [bound_literal(cut) for cut in cuts]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *between, f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    connection: JdbcConnection,
    name: str,
    partition_column: str | None = None,
    partitions: int | None = None,
    cuts: list | None = None,
) -> DataFrame:
    """A table, in parallel ranges of ``partition_column`` if one is given.

    Ranges are of equal width between the least and the greatest value, or
    split at ``cuts`` for keys whose values crowd.
    """
    if partition_column and cuts:
        options = connection.read_options(name)
        url, table = options.pop("url"), options.pop("dbtable")
        predicates = range_predicates(partition_column, cuts)
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    bounds = None
    if partition_column:
        query = bounds_query(connection.table(name), partition_column)
        row = spark.read.format("jdbc").options(**connection.options(), dbtable=query).load().first()
        # Databases differ in the case of unquoted result names: go by position.
        partitions = partitions or spark.sparkContext.defaultParallelism
        bounds = range_options(partition_column, row[0], row[1], partitions)
    return spark.read.format("jdbc").options(**connection.read_options(name, bounds)).load()


def table_cuts(
    spark: SparkSession,
    connection: JdbcConnection,
    name: str,
    column: str,
    partitions: int,
    eps: float = 0.01,
) -> list:
    """Cuts for ``read_jdbc`` that part a table into ranges of about as many rows.

    The one column is read in ranges of equal width and sketched where it is read, so the
    database sends a column more, and no task holds more than a sketch.
    """
    read = read_jdbc(spark, connection, name, column, partitions)
    return even_cuts(read.select(column), column, partitions, eps)


def write_jdbc(
    df: DataFrame,
    connection: JdbcConnection,
    name: str,
    mode: str = "overwrite",
    truncate: bool = False,
) -> None:
    """Overwrite or append; inserts are sent in batches.

    ``truncate`` empties an existing table in place of making it anew.
    """
    options = {**connection.write_options(name), "truncate": str(truncate).lower()}
    df.write.format("jdbc").options(**options).mode(mode).save()
