"""Key derivation over whole tables, once per distinct value.

One derivation costs some milliseconds, so the distinct values are derived in
a stage of their own and joined back. The derived table is checkpointed: its
size is then known, which decides how it is joined, and a lost executor does
not repeat the derivation. It holds a keyed digest in place of the raw value.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskflow.functions.text import pbkdf2_udf, quoted, secret
from maskflow.operators.dictionary import KeyDictionary
from maskflow.sources.shared import shared_folder

# Rows of the derived table that are handled apart as possible hot values. No
# value outside the N most frequent ones holds 1/N of all rows.
HOT_VALUES = 1024

# Estimated bytes per row of a broadcast derived table: two fixed-length hex
# texts (64 and 128), the count, and the hash map around them.
ROW_BYTES = 320


def _digest(salt_id: Column, c: Column, key: Column) -> Column:
    return F.sha2(F.concat(salt_id.cast("string"), F.lit("/"), c, key), 256)


def _digest_of(
    salt_id: Column, c: Column, salts: list[str], run_key: Column, dictionary: KeyDictionary | None
) -> Column:
    """Digest of a value and its salt under the run's key, or under that of the dictionary."""
    if dictionary is None:
        return _digest(salt_id, c, run_key)
    labels = F.array(*(F.lit(dictionary.label(salt)) for salt in salts))
    return dictionary.digest(F.get(labels, salt_id), c, run_key)


def derive_distinct(
    values: DataFrame, salts: list[str], run_key: Column, dictionary: KeyDictionary | None = None
) -> DataFrame:
    """``values`` has columns ``salt_id``, a place in ``salts``, and ``value``; gives
    (digest, derived, n_rows), the digest being that of both.

    The count lets equal values meet in partial aggregates, so a hot value is
    shuffled once per task. Derivation is pure computation, which the small
    byte size of its input hides from adaptive coalescing: its input is dealt
    out over a fixed number of tasks. (Repartitioned by value it would not be,
    as Spark drops a repartitioning that the grouping already provides.)

    Keys that a dictionary has are taken from it; the others are added to it.
    """
    spark = values.sparkSession
    shared_folder(spark)
    tasks = max(
        2 * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    counted = (
        values.where(F.col("value").isNotNull())
        .groupBy("salt_id", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    digest = _digest_of(F.col("salt_id"), F.col("value"), salts, run_key, dictionary)
    if dictionary is None:
        derived = counted.repartition(tasks).select(
            digest.alias("digest"), pbkdf2_udf(salts)("salt_id", "value").alias("derived"), "n_rows"
        )
        return derived.checkpoint()
    known = dictionary.keys(spark).withColumnRenamed("derived", "known")
    met = counted.withColumn("digest", digest).join(known, "digest", "left").repartition(tasks)
    missing = F.when(F.col("known").isNull(), F.col("value"))
    derived = met.select(
        "digest",
        F.coalesce("known", pbkdf2_udf(salts)("salt_id", missing)).alias("derived"),
        "n_rows",
        F.col("known").isNull().alias("is_new"),
    ).checkpoint()
    dictionary.append(derived.where("is_new"))
    return derived.drop("is_new")


def _join_broadcast(frame: DataFrame, keys: DataFrame, key: str, out: str) -> DataFrame:
    """Left join of ``keys`` by ``key``, adding ``derived`` as ``out``."""
    small = keys.select(F.col("digest").alias(key), F.col("derived").alias(out))
    return frame.join(F.broadcast(small), key, "left")


def _join_shuffled(
    frame: DataFrame, keys: DataFrame, key: str, out: str, spread_on: list[str]
) -> DataFrame:
    """The same for more keys than are broadcast.

    The most frequent values, a fixed number of fixed-length rows, are looked up
    by broadcast. They and null keys then take part in the shuffle under fillers
    that match nothing. A filler comes from the row and its partition: it stays
    the same when a task is repeated, and copies of a row spread as well.
    """
    cold = keys.select(F.col("digest").alias(key), F.col("derived").alias(f"{out}_cold"))
    hot = keys.orderBy(F.desc("n_rows"), "digest").limit(HOT_VALUES)
    hot = hot.select(F.col("digest").alias(key), F.col("derived").alias(f"{out}_hot"))
    row = F.xxhash64(F.spark_partition_id(), *[quoted(name) for name in spread_on])
    filler = F.concat(F.lit("-"), row.cast("string"))
    joined = (
        frame.join(F.broadcast(hot), key, "left")
        .withColumn(
            key, F.when(F.col(f"{out}_hot").isNull() & F.col(key).isNotNull(), F.col(key))
        )
        .withColumn(key, F.coalesce(F.col(key), filler))
        .join(cold, key, "left")
    )
    return joined.withColumn(out, F.coalesce(f"{out}_hot", f"{out}_cold")).drop(
        f"{out}_hot", f"{out}_cold"
    )


def add_derived_keys(
    frame: DataFrame,
    inputs: dict[str, tuple[str, str]],
    spread_on: list[str],
    broadcast_bytes: int,
    dictionary: KeyDictionary | None = None,
) -> DataFrame:
    """Add one column per entry of ``inputs``, the derived key of the column and under
    the salt that it names.

    All columns and salts share one derived table, filled in one scan. Salts are
    numbered; they themselves are in no row. Digests are under a key of this run,
    or under that of the dictionary, which keeps them for later runs.
    """
    run_key = secret(frame.sparkSession, dictionary.digest_key if dictionary else secrets.token_hex(32))
    salts = list(dict.fromkeys(salt for _, salt in inputs.values()))
    pairs = [
        F.struct(F.lit(salts.index(salt)).alias("salt_id"), F.col(c).alias("value"))
        for c, salt in inputs.values()
    ]
    values = frame.select(F.explode(F.array(*pairs)).alias("pair")).select("pair.*")
    if dictionary is None:
        keys = derive_distinct(values, salts, run_key)
    else:
        keys = derive_distinct(values, salts, run_key, dictionary)
    small = keys.count() * ROW_BYTES <= broadcast_bytes
    for out, (c, salt) in inputs.items():
        key = f"{out}_key"
        digest = _digest_of(F.lit(salts.index(salt)), F.col(c), salts, run_key, dictionary)
        keyed = frame.withColumn(key, digest)
        if small:
            frame = _join_broadcast(keyed, keys, key, out).drop(key)
        else:
            frame = _join_shuffled(keyed, keys, key, out, spread_on).drop(key)
    return frame
