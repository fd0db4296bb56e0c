"""Even ranges of keys, and leak checks by bitmap, against plain Python."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from maskflow.catalog import QUERIES
from maskflow.operators import audit, ranges
from maskflow.sources.jdbc import range_predicates


def sizes(spark, df, cuts):
    return {r["range"]: r["n_rows"] for r in ranges.range_sizes(df, "key", cuts).collect()}


KEYS = {
    "even": "id",
    "crowded": "cast(pow(id, 3) AS bigint)",
    "negative": "-id * id",
    "fraction": "1 / (id + 1.0D)",
    "decimal": "cast(id AS decimal(30, 3)) * 7",
    "day": "date_add(date '1800-01-01', cast(id AS int))",
    "stamp": "timestamp_micros(id * id * 1000)",
    "text": "concat('a common beginning of all the keys ', id)",
    "unicode": "concat('é', char(cast(id % 26 + 97 AS int)), id)",
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_no_range_holds_more_than_its_share(spark, kind, n):
    df = spark.range(0, 20_000, 1, 7).select(F.expr(KEYS[kind]).alias("key"))
    cuts = ranges.even_cuts(df, "key", n)
    assert len(cuts) == n - 1 and cuts == sorted(set(cuts))
    found = sizes(spark, df, cuts)
    assert sum(found.values()) == 20_000 and max(found.values()) <= 20_000 * (1 / n + 0.01)


def test_sampled_texts(spark, monkeypatch):
    """Fewer rows than the table has are looked at, equal ones as often as they occur."""
    monkeypatch.setattr(ranges, "ODDS", 0.1)  # 2,000 rows
    df = spark.range(0, 50_000, 1, 5).select(F.concat(F.lit("k"), F.pow("id", F.lit(2)).cast("bigint")).alias("key"))
    found = sizes(spark, df, ranges.even_cuts(df, "key", 10))
    assert sum(found.values()) == 50_000 and max(found.values()) < 50_000 * 0.15
    heavy = spark.range(0, 30_000, 1, 5).select(F.when(F.col("id") % 3 == 0, "m").otherwise(F.col("id").cast("string")).alias("key"))
    found = sizes(spark, heavy, ranges.even_cuts(heavy, "key", 10))
    assert max(found.values()) <= 30_000 * (1 / 3 + 0.15) and len(found) >= 6


def test_values_that_repeat_nulls_and_empty_tables(spark):
    rows = [(None,)] * 30 + [(5,)] * 60 + [(k,) for k in range(10)]
    df = spark.createDataFrame(rows, "key int")
    cuts = ranges.even_cuts(df, "key", 10)
    assert cuts == sorted(set(cuts)) and sum(sizes(spark, df, cuts).values()) == 100
    for kind in ("int", "string"):
        empty = spark.createDataFrame([], f"key {kind}")
        assert ranges.even_cuts(empty, "key", 5) == [] and sizes(spark, empty, []) == {}
    one = spark.createDataFrame([("x",), (None,)], "key string")
    assert sizes(spark, one, ranges.even_cuts(one, "key", 3)) == {0: 1, 1: 1}
    nan = spark.createDataFrame([(float("nan"),)] * 50 + [(float(k),) for k in range(50)], "key double")
    assert all(cut == cut for cut in ranges.even_cuts(nan, "key", 10))
    for bad in ("array<int>", "boolean"):
        with pytest.raises(ValueError, match="no ranges"):
            ranges.even_cuts(spark.createDataFrame([], f"key {bad}"), "key", 2)
    with pytest.raises(ValueError):
        ranges.even_cuts(df, "key", 0)


def test_cuts_feed_range_reads(spark):
    """The predicates of a range read part the rows as the cuts do."""
    for expression in ("cast(id * id AS decimal(20, 2))", "concat('o''k', id)", "timestamp_micros(id * 123456789)"):
        df = spark.range(3000).select(F.expr(expression).alias("key"))
        cuts = ranges.even_cuts(df, "key", 6)
        assert isinstance(cuts[0], (decimal.Decimal, str, datetime.datetime))
        predicates = range_predicates("key", cuts)
        counts = df.agg(*[F.count_if(F.expr(p.replace("''", "\\'"))).alias(f"n{k}") for k, p in enumerate(predicates)]).first()
        assert list(counts) == [sizes(spark, df, cuts)[k] for k in range(6)]


def test_even_ranges_of_large_keys(spark, tmp_path):
    """Keys whose third power is beyond a bigint have even ranges as well."""
    items = spark.range(9_000_000, 9_005_000).selectExpr(
        "id AS l_orderkey", "cast(1 + id % 7 AS int) AS l_linenumber",
        "timestamp_seconds(86400 * (id - 9000000)) AS l_shipdate", "id / 7 AS l_extendedprice",
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = sorted(map(tuple, QUERIES["even_ranges"](spark, str(tmp_path)).collect()))
    assert got == [(name, 5000, True) for name in ("crowded", "day", "orderkey", "price", "text")]


def leaks(spark, raw, masked):
    df = [spark.createDataFrame([(v,) for v in values], "c string") for values in (raw, masked)]
    found = [r["value"] for r in audit.leaked_values(*df, "c", "c").collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_planted_leaks_are_found_exactly(spark, monkeypatch):
    draw = random.Random(4)
    raw = [f"id-{draw.randrange(10**6)}" for _ in range(3000)] + ["", "é", " ", None] * 3
    masked = [f"pseudonym {k}" for k in range(4000)] + draw.sample(raw, 40) + [None, "", "é", "É"]
    want = (set(raw) & set(masked)) - {None}
    assert leaks(spark, raw, masked) == want and len(want) > 20
    # A filter far too small lets nearly all pass, and the result is the same.
    monkeypatch.setattr(audit, "MOST_BITS", 8)
    monkeypatch.setattr(audit, "LEAST_BITS", 8)
    assert leaks(spark, raw, masked) == want
    monkeypatch.setattr(audit, "SURVIVOR_BYTES", -1)
    assert leaks(spark, raw, masked) == want


def test_filter_has_no_false_negatives_and_few_positives(spark):
    raw = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("value"))
    other = spark.range(20_000).select(F.concat(F.lit("m"), "id").alias("value"))
    bits = 1 << 17
    bitmaps = audit.value_filter(raw, bits)
    assert bitmaps.count() <= bits // audit.BITMAP_BITS
    assert audit.passing(raw, bitmaps, bits).distinct().count() == 5000
    assert audit.passing(other, bitmaps, bits).count() < 20_000 * 0.08


def test_values_are_not_shuffled(spark):
    """Between the scan of the masked values and the filter is no exchange, and the raw values
    meet the few that passed by broadcast."""
    raw = spark.range(5000).select(F.concat(F.lit("r"), "id").alias("value"))
    plan = audit.passing(raw, audit.value_filter(raw, 1 << 17), 1 << 17)._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "hashpartitioning" not in above
    found = audit.leaked_values(raw, raw.limit(3), "value", "value")
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    assert leaks(spark, [], ["a"]) == leaks(spark, ["a"], []) == leaks(spark, [None], [None]) == set()
