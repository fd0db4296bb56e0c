"""Sinks: where the tables of a job go.

Each is called with (name, table) and returns False if it left the table out
because it is there already.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from maskflow.sources.files import exists
from maskflow.sources.fixedwidth import Field, write_fixed_width
from maskflow.sources.jdbc import JdbcConnection, write_jdbc

Sink = Callable[[str, DataFrame], bool | None]


def _under(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def _written_unless_complete(
    spark: SparkSession, folder: str, mode: str, write: Callable[[str, str], None]
) -> bool:
    """Call ``write(folder, mode)``; under ``ignore`` only where no write has been completed.

    A folder without the mark of a completed write is what a write that failed
    has left, and is written anew.
    """
    if mode == "ignore":
        if exists(spark, f"{folder}/_SUCCESS"):
            return False
        mode = "overwrite"
    write(folder, mode)
    return True


def csv_sink(folder: str, mode: str = "ignore") -> Sink:
    """CSV folders with a header. A completed folder is left as it is by default.

    Blanks around values are kept: a cleared column is a blank, not a null.
    """

    def sink(name: str, df: DataFrame) -> bool:
        def write(path: str, mode: str) -> None:
            df.write.mode(mode).csv(
                path,
                header=True,
                nullValue="",
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
            )

        return _written_unless_complete(df.sparkSession, _under(folder, name), mode, write)

    return sink


def parquet_sink(folder: str, mode: str = "ignore") -> Sink:
    """Parquet folders. A completed folder is left as it is by default."""

    def sink(name: str, df: DataFrame) -> bool:
        return _written_unless_complete(
            df.sparkSession,
            _under(folder, name),
            mode,
            lambda path, mode: df.write.mode(mode).parquet(path),
        )

    return sink


def table_sink(
    database: str,
    mode: str = "overwrite",
    folder: str | None = None,
    buckets: Mapping[str, tuple[int, list[str]]] | None = None,
) -> Sink:
    """Catalog tables ``database.name``; ``folder`` makes them external tables there.

    ``buckets`` has, by table name, a number of buckets and the columns to bucket and sort
    by: tables bucketed alike by a pseudonym join and group by it without a shuffle. Rows
    are dealt out by bucket first, so every bucket is one file.
    """

    def write(name: str, df: DataFrame) -> None:
        if buckets and name in buckets:
            number, columns = buckets[name]
            writer = df.repartition(number, *columns).write.bucketBy(number, *columns).sortBy(*columns).mode(mode)
        else:
            writer = df.write.mode(mode)
        if folder:
            writer = writer.option("path", _under(folder, name))
        writer.saveAsTable(f"{database}.{name}")

    return write


def jdbc_sink(connection: JdbcConnection, mode: str = "overwrite") -> Sink:
    return lambda name, df: write_jdbc(df, connection, name, mode)


def text_sink(folder: str, mode: str = "error") -> Sink:
    """Tables of one text column, one line per row."""
    return lambda name, df: df.write.mode(mode).text(_under(folder, name))


def fixed_width_sink(
    folder: str,
    layouts: Mapping[str, list[Field]],
    mode: str = "error",
    truncate: bool = False,
    zero_numbers: bool = False,
) -> Sink:
    """Fixed-width lines, every table under the layout of its name."""
    return lambda name, df: write_fixed_width(
        df, _under(folder, name), layouts[name], mode, truncate, zero_numbers
    )
