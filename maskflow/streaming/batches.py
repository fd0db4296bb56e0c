"""Masked streams into tables, a batch at a time, that survive a restart.

Every batch is masked as a table and committed under its batch id. A batch that was written
before the query stopped, and is run again from the checkpoint, takes the place of what it
wrote, so every row is there once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from maskflow.functions.text import literal, quoted
from maskflow.operators.masking import deidentify
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import TablePolicy
from maskflow.plans.salts import Salts
from maskflow.sources.fixedwidth import Field, read_fixed_width, write_fixed_width

BATCH = "batch_id"

# Called with a batch's rows and its id; a second call with the id replaces the first.
BatchSink = Callable[[DataFrame, int], None]


def mask_batches(
    stream: DataFrame,
    policy: TablePolicy,
    sink: BatchSink,
    checkpoint: str,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Mask a stream and hand every batch to ``sink``; restarts go on from ``checkpoint``.

    As a batch is a table, keys are derived once per distinct value of it, and with
    ``options.key_dictionary`` once per distinct value of the stream. ``available_now``
    stops when all input there is now is done.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(deidentify(batch, policy, salts, options), batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _folder_of(folder: str, batch_id: int) -> str:
    return f"{folder.rstrip('/')}/{BATCH}={batch_id}"


def _without_batch_column(df: DataFrame) -> None:
    if BATCH in {name.lower() for name in df.columns}:
        raise ValueError(f"a column is named {BATCH!r}, which names the batches")


def parquet_batches(folder: str) -> BatchSink:
    """A Parquet folder with a folder in it for each batch."""

    def sink(df: DataFrame, batch_id: int) -> None:
        _without_batch_column(df)
        df.write.mode("overwrite").parquet(_folder_of(folder, batch_id))

    return sink


def read_parquet_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all batches in a folder."""
    return spark.read.parquet(folder).drop(BATCH)


def table_batches(database: str, name: str, folder: str | None = None) -> BatchSink:
    """A catalog table ``database.name`` partitioned by batch, made by the first batch;
    ``folder`` makes it an external table there. Only the batch's partition is replaced."""
    table = f"{quoted(database)}.{quoted(name)}"

    def sink(df: DataFrame, batch_id: int) -> None:
        _without_batch_column(df)
        spark = df.sparkSession
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
        place = f"LOCATION {literal(folder)}" if folder else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({fields}, {BATCH} bigint) USING parquet "
            f"PARTITIONED BY ({BATCH}) {place}"
        )
        # The partition is named, not found in the rows: a batch may have none this time.
        columns = ", ".join(quoted(c) for c in df.columns)
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH} = {int(batch_id)}) SELECT {columns} FROM {{batch}}",
            batch=df,
        )

    return sink


def fixed_width_batches(folder: str, layout: list[Field], truncate: bool = False) -> BatchSink:
    """Fixed-width lines, a folder for each batch."""

    def sink(df: DataFrame, batch_id: int) -> None:
        write_fixed_width(df, _folder_of(folder, batch_id), layout, "overwrite", truncate)

    return sink


def read_fixed_width_batches(spark: SparkSession, folder: str, layout: list[Field]) -> DataFrame:
    """Rows of the lines of all batches in a folder."""
    return read_fixed_width(spark, f"{folder.rstrip('/')}/{BATCH}=*", layout)
