"""File sources: CSV, JSON lines, and folders holding one table per file."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from maskflow.sources.typing import infer_types as infer_schema


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    infer_types: bool = True,
    text_columns: Iterable[str] = (),
    schema: T.StructType | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header line; empty fields are null, bad fields too.

    Files read together must agree in their headers; they are compared.

    ``infer_types`` finds the types by one native aggregate over the cells, except for
    ``text_columns``, which stay text so that zips and ids keep their zeros and are
    not looked at.
    Without it every column is text and one pass is enough; strategies read
    dates and numbers from text.
    """
    reader = spark.read.options(header=True, nullValue="", mode="PERMISSIVE", multiLine=multi_line)
    path = path if isinstance(path, str) else list(path)
    if schema is not None:
        return reader.schema(schema).csv(path)
    reader = reader.option("enforceSchema", False)
    if not infer_types:
        return reader.csv(path)
    # The header gives the names; the scan for the types reads the cells as text.
    return reader.schema(infer_schema(reader.csv(path), text_columns)).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; the schema is inferred in one more pass if none is given."""
    return spark.read.schema(schema).json(path) if schema else spark.read.json(path)


def list_tables(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of every entry of a folder, hidden ones left out.

    Not recursive: a folder within it (such as one written by Spark) is one
    table. Only names travel to the driver.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    listing = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    found = {}
    for entry in listing:
        name = entry.getPath().getName()
        if not name.startswith((".", "_")):
            found[name] = entry.getPath().toString()
    if not found:
        raise ValueError(f"no files in {folder}")
    return dict(sorted(found.items()))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this session has made and needs no more."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)
