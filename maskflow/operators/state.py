"""Key derivation in the state of a stream: a value's key is derived once and kept."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.functions.text import quoted, secret

# The state store that keyed state needs; a setting of the session that starts the stream.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Rows of a value in a task of the scan that go to one group; further ones go to the next
# of the groups that a value has at most. So a hot value is spread over many tasks, each
# of which derives its key once in the stream's life, and any other has one group.
HOT_ROWS = 1000
COPIES = 8
# Counters of a task, shared by values with equal hashes.
COUNTERS = 1 << 16
# Groups that the rows of nulls are dealt to.
NULLS = 64


def add_state_key(frame: DataFrame, value: str, salt: str, out: str, spread_on: list[str]) -> DataFrame:
    """A stream with ``out``, the derived key of the column ``value``, or null.

    Rows meet by a digest of the value under the salt; the state holds the digest and the
    key, never the value. It is part of the checkpoint, so a restarted stream derives only
    values it has not met.
    """
    group = f"{out}_group"
    salt_column = secret(frame.sparkSession, salt)
    digest = F.sha2(F.concat(salt_column, F.lit("/"), F.col(value), F.lit("/"), salt_column), 256)
    row = F.xxhash64(*[quoted(name) for name in spread_on], value)
    place = F.pmod(F.xxhash64(value), F.lit(COUNTERS)).cast("int")
    copy = F.when(F.col(value).isNull(), F.pmod(row, F.lit(NULLS))).otherwise(_copy(place))
    name = F.concat_ws("/", F.coalesce(digest, F.lit("-")), copy.cast("string"))
    keyed = frame.withColumn(group, name)
    schema = T.StructType([*keyed.schema.fields, T.StructField(out, T.StringType())])
    derived = keyed.groupBy(group).transformWithState(
        statefulProcessor=_deriving(value, salt, out), outputStructType=schema, outputMode="append", timeMode="none"
    )
    return derived.drop(group)


def _copy(place: Column) -> Column:
    """Number of the group of its value that a row goes to, by the rows with the same ``place``
    that its task has met before."""
    hot_rows, copies, counters = HOT_ROWS, COPIES, COUNTERS

    @F.pandas_udf("int")
    def copy(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        met = np.zeros(counters, dtype=np.int64)
        for places in batches:
            before = met[places] + places.groupby(places).cumcount().to_numpy()
            met += np.bincount(places, minlength=counters)
            yield pd.Series(before // hot_rows % copies, dtype="int32")

    return copy(place)


def _deriving(value: str, salt: str, out: str):
    """The processor, defined here so that executors need no copy of this package."""
    from pyspark.sql.streaming import StatefulProcessor

    class Deriving(StatefulProcessor):
        def init(self, handle) -> None:
            self.key = handle.getValueState("derived", "derived string")

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, the interface's name
            import hashlib

            from pyspark.sql import Row

            found, masked = None, None
            for row in rows:
                if masked is None:
                    # Of a group all rows have the same value, or none has one.
                    masked = Row(*row.__fields__, out)
                    if row[value] is not None:
                        kept = self.key.get()
                        if kept is None:
                            raw, salted = row[value].encode("utf-8"), salt.encode("utf-8")
                            kept = (hashlib.pbkdf2_hmac("sha1", raw, salted, 2016, 64).hex(),)
                            self.key.update(kept)
                        found = kept[0]
                yield masked(*row, found)

        def close(self) -> None:
            pass

    return Deriving()
