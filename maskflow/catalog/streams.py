"""Streams stopped between a batch's write and its commit, and keys kept between runs."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from maskflow.catalog.registry import (
    AS_OF,
    SALTS,
    load,
    masked,
    policy,
    query,
    salted,
    sql_hash,
)
from maskflow.catalog.strategies import sql_pbkdf2, sql_shift
from maskflow.operators.dictionary import KeyDictionary
from maskflow.operators.state import PROVIDER, ROCKSDB
from maskflow.plans.options import MaskOptions
from maskflow.sources.fixedwidth import Field
from maskflow.sources.shared import new_path
from maskflow.streaming.batches import (
    fixed_width_batches,
    mask_batches,
    parquet_batches,
    read_fixed_width_batches,
    read_parquet_batches,
    table_batches,
)
from maskflow.streaming.masking import deidentify_stream, write_stream

# Stands for a secret that a user keeps as salts are kept.
DIGEST_KEY = "digest-key"
EVENT_KEYS = {
    "event_id": "Identity",
    "user_id": salted("PBEKeyHash", "person"),
    "event_type": "Identity",
}
EVENT_KEYS_SQL = f"""
    WITH RECURSIVE {sql_pbkdf2("SELECT CAST(user_id AS VARCHAR) AS value FROM events", "salt-person")}
    SELECT event_id, derived AS user_id, event_type
    FROM events JOIN keys ON raw = CAST(user_id AS VARCHAR)
"""


class Stopped(Exception):
    pass


def stopping(sink, batches: int):
    """A sink after whose ``batches``-th write the query stops, before it is committed."""
    done = []

    def run(df, batch_id):
        sink(df, batch_id)
        done.append(batch_id)
        if len(done) == batches:
            raise Stopped

    return run


def stop_and_restart(spark, folder, sink, rules, options, out) -> None:
    """Mask all events, read as a stream of four files a batch each: the query stops with its
    second batch written and not committed, and a new one goes on from the checkpoint."""
    load(spark, folder, "events").repartition(4).write.parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema

    def run(into):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/source")
        mask_batches(
            stream, policy(rules), into, f"{out}/progress", SALTS, options, available_now=True
        ).awaitTermination()

    try:
        run(stopping(sink, 2))
    except StreamingQueryException:
        run(sink)


@query(
    "restarted_stream_parquet",
    f"""
    SELECT event_id, {sql_hash("user_id", "person")} AS user_id, event_type,
           ts + to_days({sql_shift("user_id", "0")}) AS ts, value
    FROM events
    """,
)
def restarted_stream_parquet(spark, folder):
    rules = {
        "event_id": "Identity",
        "user_id": salted("Hash", "person"),
        "event_type": "Identity",
        "ts": "DateTimeShift",
        "value": "Identity",
    }
    out = new_path(spark, "stream")
    options = MaskOptions(as_of_year=AS_OF, hash_bits=256, patient_column="user_id")
    stop_and_restart(spark, folder, parquet_batches(f"{out}/rows"), rules, options, out)
    return read_parquet_batches(spark, f"{out}/rows")


@query("restarted_stream_table", EVENT_KEYS_SQL)
def restarted_stream_table(spark, folder):
    """Into a catalog table; keys are derived once for all batches."""
    out = new_path(spark, "stream")
    name = "events_" + out.rsplit("-", 1)[-1]
    options = MaskOptions(key_dictionary=KeyDictionary(f"{out}/keys", DIGEST_KEY))
    sink = table_batches("default", name, f"{out}/rows")
    stop_and_restart(spark, folder, sink, EVENT_KEYS, options, out)
    # The table is external: its files stay when the catalog forgets it.
    spark.sql(f"DROP TABLE default.{name}")
    return read_parquet_batches(spark, f"{out}/rows")


EVENT_LAYOUT = [
    Field("event_id", 13, "9"),
    Field("user_id", 64, "X"),
    Field("event_type", 20, "X"),
    Field("ts", 10, "YYYY-MM-DD"),
]


@query(
    "restarted_stream_fixed_width",
    f"""
    SELECT event_id, {sql_hash("user_id", "person")} AS user_id, event_type, CAST(ts AS DATE) AS ts
    FROM events
    """,
)
def restarted_stream_fixed_width(spark, folder):
    rules = {"event_id": "Identity", "user_id": salted("Hash", "person"), "event_type": "Identity", "ts": "Identity"}
    out = new_path(spark, "stream")
    sink = fixed_width_batches(f"{out}/rows", EVENT_LAYOUT)
    stop_and_restart(spark, folder, sink, rules, MaskOptions(hash_bits=256), out)
    return read_fixed_width_batches(spark, f"{out}/rows", EVENT_LAYOUT)


@query(
    "stream_keys_derived",
    "SELECT count(DISTINCT user_id) AS n_keys, count(DISTINCT user_id) AS n_digests FROM events",
)
def stream_keys_derived(spark, folder):
    """Keys that all batches of a restarted stream have derived together: one a user."""
    out = new_path(spark, "stream")
    keys = KeyDictionary(f"{out}/keys", DIGEST_KEY)
    sink = parquet_batches(f"{out}/rows")
    stop_and_restart(spark, folder, sink, EVENT_KEYS, MaskOptions(key_dictionary=keys), out)
    derived = keys.versions(spark).agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_keys"))
    return derived.crossJoin(keys.keys(spark).agg(F.count(F.lit(1)).alias("n_digests")))


# Events of the first two-hundredth of the time they span are there at the first run.
EARLY = "ts < (SELECT min(ts) + (max(ts) - min(ts)) / 200 FROM events)"


def two_runs(spark, folder):
    """The dictionary and the masked rows of the second run, over events that have grown."""
    events = load(spark, folder, "events")
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    early = span.select((F.col("low") + (F.col("high") - F.col("low")) / 200).alias("early")).scalar()
    keys = KeyDictionary(f"{new_path(spark, 'keys')}/dictionary", DIGEST_KEY)
    masked(events.where(F.col("ts") < early), EVENT_KEYS, key_dictionary=keys)
    return keys, masked(events, EVENT_KEYS, key_dictionary=keys)


@query("pbe_key_dictionary", EVENT_KEYS_SQL)
def pbe_key_dictionary(spark, folder):
    """All events, after a run over the early ones has left its keys."""
    _, rows = two_runs(spark, folder)
    return rows


@query(
    "key_dictionary_growth",
    f"""
    WITH early AS (SELECT DISTINCT user_id FROM events WHERE {EARLY} AND user_id IS NOT NULL),
    versions AS (
        SELECT 1 AS version, count(*) AS n_keys FROM early
        UNION ALL
        SELECT 2, count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT user_id FROM early)
        UNION ALL SELECT 3, 0)
    SELECT version, n_keys FROM versions WHERE n_keys > 0
    """,
)
def key_dictionary_growth(spark, folder):
    """Keys each run has derived: those of early users, then those of new users alone; a
    third run over the same events derives none."""
    keys, _ = two_runs(spark, folder)
    masked(load(spark, folder, "events"), EVENT_KEYS, key_dictionary=keys)
    return keys.versions(spark)


@query("stateful_stream_keys", EVENT_KEYS_SQL)
def stateful_stream_keys(spark, folder):
    """Events masked as a stream of four files a batch each, keys kept in its state."""
    out = new_path(spark, "stream")
    load(spark, folder, "events").repartition(4).write.parquet(f"{out}/source")
    schema = spark.read.parquet(f"{out}/source").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/source")
    masked_rows = deidentify_stream(stream, policy(EVENT_KEYS), SALTS, MaskOptions(key_derivation="state"))
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        write_stream(masked_rows, f"{out}/rows", f"{out}/progress", available_now=True).awaitTermination()
    finally:
        spark.conf.set(PROVIDER, before)
    return spark.read.parquet(f"{out}/rows")
