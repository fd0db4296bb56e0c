"""Masking streams: strategies keep no state, so a stream is masked row by row, but that
derived keys may be kept."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from maskflow.operators.masking import deidentify
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import TablePolicy
from maskflow.plans.salts import Salts


def deidentify_stream(
    stream: DataFrame,
    policy: TablePolicy,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
) -> DataFrame:
    """The masked stream. Keys are derived within the scan, as distinct values
    of a stream are never complete, or with the option ``key_derivation="state"`` once and
    kept in the stream's state; City joins the stream with its static table."""
    options = options or MaskOptions()
    if options.key_derivation != "state":
        options = replace(options, key_derivation="inline")
    return deidentify(stream, policy, salts, options)


def write_stream(
    masked: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """Write to files, exactly once; ``available_now`` stops when all input is done."""
    writer = masked.writeStream.format(format).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
