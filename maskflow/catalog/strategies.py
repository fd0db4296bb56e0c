"""One query per column strategy."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskflow.catalog.digests import sql_sha512
from maskflow.catalog.registry import (
    AS_OF,
    SALTS,
    load,
    masked,
    query,
    salted,
    sql_chance,
    sql_floored,
    sql_hash,
    sql_in,
    sql_pick,
    sql_zip3,
)
from maskflow.functions.vocabulary import (
    ETHNIC_GROUPS,
    FIRST_NAMES,
    LAST_NAMES,
    PACIFIC_LABEL_COMPAT,
    PACIFIC_TERMS,
    RESTRICTED_ZIP3,
    SHIFT_DAYS,
    default_given_names,
)
from maskflow.functions.sql import register_sql
from maskflow.operators.cities import cities_by_area, numbered_cities

# -- text


@query(
    "identity_cleanse",
    """
    SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text,
           lang, source, n_chars
    FROM documents
    """,
)
def identity_cleanse(spark, folder):
    return masked(
        load(spark, folder, "documents"),
        {name: "Identity" for name in ("doc_id", "text", "lang", "source", "n_chars")},
    )


@query(
    "identity_conversations",
    """
    SELECT conv_id, turn, role, replace(replace(text, chr(10), ' '), chr(13), ' ') AS text
    FROM conversations
    """,
)
def identity_conversations(spark, folder):
    return masked(
        load(spark, folder, "conversations"),
        {name: "Identity" for name in ("conv_id", "turn", "role", "text")},
    )


# Names with the cases that a hash tells apart: null, empty, blanks around.
RAW_NAME = """
    CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  '
         WHEN 3 THEN ' ' || c_name || '  ' ELSE c_name END
"""


def with_raw_name(df: DataFrame) -> DataFrame:
    return df.withColumn("c_name", F.expr(RAW_NAME))


@query(
    "hash_256",
    f"""
    SELECT {sql_hash("c_custkey", "person")} AS c_custkey,
           {sql_hash("raw_name", "person")} AS c_name, c_mktsegment
    FROM (SELECT *, {RAW_NAME} AS raw_name FROM customer)
    """,
)
def hash_256(spark, folder):
    return masked(
        with_raw_name(load(spark, folder, "customer")),
        {
            "c_custkey": salted("Hash", "person"),
            "c_name": salted("Hash", "person"),
            "c_mktsegment": "Identity",
        },
        hash_bits=256,
    )


def sql_sha512_of(c: str, salt: str) -> str:
    """The text that Hash digests, for a value that is neither null nor empty."""
    return f"CASE WHEN {c} <> '' THEN trim({c}, ' ') || '{salt}' END"


@query(
    "hash_512",
    f"""
    WITH RECURSIVE raw AS (
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {RAW_NAME} AS c_name FROM customer),
    texts AS (
        SELECT *, {sql_sha512_of("c_custkey", "salt-person")} AS key_text,
               {sql_sha512_of("c_name", "salt-person")} AS name_text
        FROM raw),
    {sql_sha512("SELECT key_text AS value FROM texts UNION ALL SELECT name_text FROM texts")}
    SELECT k.digest AS c_custkey, CASE WHEN c_name = '' THEN '' ELSE n.digest END AS c_name
    FROM texts JOIN sha512s k ON k.raw = key_text LEFT JOIN sha512s n ON n.raw = name_text
    """,
)
def hash_512(spark, folder):
    return masked(
        with_raw_name(load(spark, folder, "customer")),
        {"c_custkey": salted("Hash", "person"), "c_name": salted("Hash", "person")},
    )


def sql_pbkdf2(values: str, salt: str) -> str:
    """CTEs ending in ``keys(raw, derived)``: PBKDF2-HMAC-SHA1, 2016 rounds, 64 bytes.

    ``values`` selects the texts as ``value``. Each HMAC is two SHA-1 over the
    padded value; a recursion step is one round of all values and blocks.
    """

    def pad(byte: str) -> str:
        block = "encode(value) || unhex(repeat('00', CAST(64 - octet_length(encode(value)) AS INTEGER)))"
        return f"xor(CAST({block} AS BIT), CAST(unhex(repeat('{byte}', 64)) AS BIT))::BLOB"

    def hmac(message: str) -> str:
        return f"unhex(sha1(outside || unhex(sha1(inside || {message}))))"

    return f"""
    padded AS (
        SELECT value, {pad("36")} AS inside, {pad("5c")} AS outside
        FROM (SELECT DISTINCT value FROM ({values}) WHERE value IS NOT NULL)),
    blocks AS (
        SELECT value, inside, outside, block,
               {hmac(f"(encode('{salt}') || unhex(printf('%08x', block)))")} AS step
        FROM padded, (SELECT unnest([1, 2, 3, 4]) AS block)),
    rounds AS (
        SELECT value, inside, outside, block, step, CAST(step AS BIT) AS total, 1 AS n FROM blocks
        UNION ALL
        SELECT value, inside, outside, block, next, xor(total, CAST(next AS BIT)), n + 1
        FROM (SELECT *, {hmac("step")} AS next FROM rounds WHERE n < 2016)),
    keys AS (
        SELECT value AS raw, substr(string_agg(lower(hex(CAST(total AS BLOB))), '' ORDER BY block), 1, 128)
               AS derived
        FROM rounds WHERE n = 2016 GROUP BY value)
    """


@query(
    "pbe_key_hash",
    f"""
    WITH RECURSIVE {sql_pbkdf2("SELECT CAST(user_id AS VARCHAR) AS value FROM events", "salt-person")}
    SELECT event_id, derived AS user_id, event_type
    FROM events JOIN keys ON raw = CAST(user_id AS VARCHAR)
    """,
)
def pbe_key_hash(spark, folder):
    return masked(
        load(spark, folder, "events"),
        {
            "event_id": "Identity",
            "user_id": salted("PBEKeyHash", "person"),
            "event_type": "Identity",
        },
    )


@query(
    "pbe_key_hash_shuffled",
    f"""
    WITH RECURSIVE {sql_pbkdf2("SELECT CAST(l_suppkey AS VARCHAR) AS value FROM lineitem", "salt-person")}
    SELECT l_orderkey, l_linenumber, derived AS l_suppkey
    FROM lineitem LEFT JOIN keys ON raw = CAST(l_suppkey AS VARCHAR) AND l_linenumber > 1
    """,
)
def pbe_key_hash_shuffled(spark, folder):
    """Keys joined as where they are too many to broadcast; first lines have no supplier."""
    df = load(spark, folder, "lineitem")
    df = df.withColumn("l_suppkey", F.when(F.col("l_linenumber") > 1, F.col("l_suppkey")))
    return masked(
        df,
        {
            "l_orderkey": "Identity",
            "l_linenumber": "Identity",
            "l_suppkey": salted("PBEKeyHash", "person"),
        },
        broadcast_bytes=0,
    )


@query(
    "pbe_key_hash_three_salts",
    f"""
    WITH RECURSIVE {sql_pbkdf2("SELECT s_name AS value FROM supplier", "salt-person").replace("keys AS", "people AS").replace("padded", "padded_a").replace("blocks", "blocks_a").replace("rounds", "rounds_a")},
    {sql_pbkdf2("SELECT CAST(s_nationkey AS VARCHAR) AS value FROM supplier", "salt-place").replace("keys AS", "places AS").replace("padded", "padded_b").replace("blocks", "blocks_b").replace("rounds", "rounds_b")},
    {sql_pbkdf2("SELECT CAST(s_nationkey AS VARCHAR) AS value FROM supplier", "salt-event").replace("keys AS", "events_ AS").replace("padded", "padded_c").replace("blocks", "blocks_c").replace("rounds", "rounds_c")}
    SELECT s_suppkey, people.derived AS s_name, places.derived AS s_nationkey,
           events_.derived AS nation
    FROM supplier JOIN people ON people.raw = s_name
    JOIN places ON places.raw = CAST(s_nationkey AS VARCHAR)
    JOIN events_ ON events_.raw = CAST(s_nationkey AS VARCHAR)
    """,
)
def pbe_key_hash_three_salts(spark, folder):
    """Three columns under three salts, derived in one pass."""
    df = load(spark, folder, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.col("s_nationkey").alias("nation")
    )
    return masked(
        df,
        {
            "s_suppkey": "Identity",
            "s_name": salted("PBEKeyHash", "person"),
            "s_nationkey": salted("PBEKeyHash", "place"),
            "nation": salted("PBEKeyHash", "event"),
        },
    )


RAW_SUPPLIER = """
    CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || s_name || '  '
         ELSE s_name END
"""


@query(
    "pbe_key_hash_inline",
    f"""
    WITH RECURSIVE named AS (SELECT s_suppkey, {RAW_SUPPLIER} AS name FROM supplier),
    {sql_pbkdf2("SELECT trim(name) AS value FROM named", "salt-person")}
    SELECT s_suppkey, CASE WHEN name = '' THEN '' ELSE derived END AS s_name
    FROM named LEFT JOIN keys ON raw = trim(name)
    """,
)
def pbe_key_hash_inline(spark, folder):
    return masked(
        load(spark, folder, "supplier").withColumn("s_name", F.expr(RAW_SUPPLIER)),
        {"s_suppkey": "Identity", "s_name": salted("PBEKeyHash", "person")},
        key_derivation="inline",
    )


@query(
    "clear_fixed_drop_duplicate",
    """
    SELECT c_custkey, ' ' AS c_mktsegment, 'FirstName' AS c_name, 'LastName' AS c_acctbal,
           c_custkey AS c_custkey_duplicate
    FROM customer
    """,
)
def clear_fixed_drop_duplicate(spark, folder):
    return masked(
        load(spark, folder, "customer"),
        {
            "c_custkey": ["Identity", "Duplicate"],
            "c_custkey_duplicate": "Identity",
            "c_name": "FixedFirstName",
            "c_acctbal": "FixedLastName",
            "c_mktsegment": "Clear",
            "c_nationkey": "Drop",
        },
    )


# -- places

# Zips spread over all areas, with short, null and "null" ones between.
RAW_ZIP = """
    CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'NULL' WHEN 2 THEN 'null'
         WHEN 3 THEN substr(lpad(CAST((c_custkey * 67) % 100000 AS STRING), 5, '0'), 1, 2)
         WHEN 4 THEN '' ELSE lpad(CAST((c_custkey * 67) % 100000 AS STRING), 5, '0') END
"""


@query(
    "zip3_digit",
    f"""
    SELECT c_custkey, {sql_zip3("zip", RESTRICTED_ZIP3)} AS zip
    FROM (SELECT c_custkey, {RAW_ZIP} AS zip FROM customer)
    """,
)
def zip3_digit(spark, folder):
    df = load(spark, folder, "customer").withColumn("zip", F.expr(RAW_ZIP))
    return masked(df, {"c_custkey": "Identity", "zip": "Zip3Digit"})


@query(
    "zip3_digit_of_numbers",
    f"""
    SELECT o_orderkey, {sql_zip3("zip", RESTRICTED_ZIP3)} AS zip
    FROM (SELECT o_orderkey, lpad(CAST((o_custkey * 61) % 100000 AS VARCHAR), 5, '0') AS zip
          FROM orders)
    """,
)
def zip3_digit_of_numbers(spark, folder):
    df = load(spark, folder, "orders").withColumn("zip", F.expr("(o_custkey * 61) % 100000"))
    return masked(df, {"o_orderkey": "Identity", "zip": "Zip3Digit"})


POSTAL = "SELECT lpad(CAST((s_suppkey * 911) % 100000 AS VARCHAR), 5, '0') AS zip, s_name AS city FROM supplier"


def postal(spark, folder) -> DataFrame:
    """A postal table whose zips and cities come from the suppliers."""
    zip_code = F.lpad(((F.col("s_suppkey") * 911) % 100000).cast("string"), 5, "0")
    return load(spark, folder, "supplier").select(
        zip_code.alias("zip"), F.col("s_name").alias("city")
    )


CITY_KEYED = f"""
    WITH areas AS (
        SELECT substr(zip, 1, 3) AS zip3, city,
               row_number() OVER (PARTITION BY substr(zip, 1, 3) ORDER BY city) - 1 AS place,
               count(*) OVER (PARTITION BY substr(zip, 1, 3)) AS n
        FROM ({POSTAL})),
    raw AS (SELECT c_custkey, {RAW_ZIP} AS zip FROM customer),
    drawn AS (SELECT *, {sql_chance("zip", "place")} AS chance FROM raw)
    SELECT c_custkey,
           CASE WHEN zip IS NULL THEN NULL WHEN length(zip) < 3 THEN 'that is not a valid zipcode'
                ELSE coalesce(city, 'unknown') END AS city
    FROM drawn LEFT JOIN areas
      ON zip3 = substr(zip, 1, 3) AND length(zip) >= 3 AND place = floor(chance * n)
    """


def city_masked(spark, folder, **options):
    df = load(spark, folder, "customer").withColumn("city", F.expr(RAW_ZIP))
    return masked(
        df,
        {"c_custkey": "Identity", "city": salted("City", "place")},
        random="keyed",
        cities=postal(spark, folder),
        **options,
    )


@query("city_keyed", CITY_KEYED)
def city_keyed(spark, folder):
    return city_masked(spark, folder)


@query("city_keyed_shuffled", CITY_KEYED)
def city_keyed_shuffled(spark, folder):
    """The plan for postal tables that are not broadcast: same cities."""
    return city_masked(spark, folder, broadcast_bytes=0)


@query(
    "city_by_zip_column",
    CITY_KEYED.replace("coalesce(city, 'unknown') END AS city", "coalesce(city, 'unknown') END AS place_name"),
)
def city_by_zip_column(spark, folder):
    """A place name masked by the zip in another column."""
    df = load(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("place_name"), F.expr(RAW_ZIP).alias("zip")
    )
    return masked(
        df,
        {"c_custkey": "Identity", "place_name": salted("City", "place")},
        random="keyed",
        cities=postal(spark, folder),
        city_zip_column="zip",
    )


@query(
    "city_uniform",
    f"""
    WITH areas AS (SELECT DISTINCT substr(zip, 1, 3) AS zip3 FROM ({POSTAL})),
    raw AS (SELECT {RAW_ZIP} AS zip FROM customer)
    SELECT CASE WHEN zip IS NULL THEN 'none' WHEN length(zip) < 3 THEN 'invalid'
                WHEN zip3 IS NULL THEN 'unknown' ELSE 'of its area' END AS outcome,
           count(*) AS n
    FROM raw LEFT JOIN areas ON zip3 = substr(zip, 1, 3) AND length(zip) >= 3
    GROUP BY 1
    """,
)
def city_uniform(spark, folder):
    """Where a drawn city stands: rows per outcome, checked against the zip's area."""
    places = postal(spark, folder)
    df = load(spark, folder, "customer").withColumn("zip", F.expr(RAW_ZIP))
    df = df.withColumn("city", F.col("zip"))
    out = masked(df, {"zip": "Identity", "city": "City"}, cities=places)
    known = places.select(F.substring("zip", 1, 3).alias("zip3"), F.col("city")).distinct()
    checked = out.join(
        known.withColumn("found", F.lit(True)),
        (F.substring(out["zip"], 1, 3) == known["zip3"]) & (out["city"] == known["city"]),
        "left",
    )
    outcome = (
        F.when(out["city"].isNull(), "none")
        .when(F.col("found"), "of its area")
        .when(out["city"] == "unknown", "unknown")
        .when(out["city"] == "that is not a valid zipcode", "invalid")
        .otherwise("of another area")
    )
    return checked.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cities_by_area",
    f"""
    SELECT zip3, CAST(place // 3 AS INTEGER) AS part, string_agg(city, '|' ORDER BY city) AS cities,
           count(*) AS n
    FROM (SELECT substr(zip, 1, 3) AS zip3, city,
                 row_number() OVER (PARTITION BY substr(zip, 1, 3) ORDER BY city) - 1 AS place
          FROM ({POSTAL}))
    GROUP BY 1, 2
    """,
)
def cities_by_area_query(spark, folder):
    """Lists of at most three cities, so that areas have several parts."""
    lists = cities_by_area(postal(spark, folder), list_size=3)
    return lists.select(
        "zip3",
        "part",
        F.array_join("cities", "|").alias("cities"),
        F.size("cities").cast("bigint").alias("n"),
    )


@query(
    "numbered_cities",
    f"""
    SELECT substr(zip, 1, 3) AS zip3, city,
           row_number() OVER (PARTITION BY substr(zip, 1, 3) ORDER BY city) - 1 AS place,
           count(*) OVER (PARTITION BY substr(zip, 1, 3)) AS n
    FROM ({POSTAL})
    """,
)
def numbered_cities_query(spark, folder):
    sizes, numbered = numbered_cities(postal(spark, folder), large=True)
    return numbered.join(sizes, "zip3")


# -- dates


@query(
    "year_of_stamps",
    f"SELECT o_orderkey, {sql_floored('year(o_orderdate)', 90)} AS o_orderdate FROM orders",
)
def year_of_stamps(spark, folder):
    return masked(
        load(spark, folder, "orders"), {"o_orderkey": "Identity", "o_orderdate": "Year"}
    )


def date_text(c: Column, key: Column) -> Column:
    """Dates as text in the forms files have them, some missing and some unreadable."""
    return (
        F.when(key % 9 == 0, F.lit("NULL"))
        .when(key % 9 == 1, F.lit(None))
        .when(key % 9 == 2, F.date_format(c, "M/d/yyyy"))
        .when(key % 9 == 3, F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(key % 9 == 4, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 9 == 5, F.lit("soon"))
        .otherwise(F.date_format(c, "yyyy-MM-dd"))
    )


READABLE = "(o_orderkey % 9 NOT IN (0, 1, 5))"


@query(
    "year_of_text",
    f"""
    SELECT o_orderkey, CASE WHEN {READABLE}
           THEN {sql_floored('year(o_orderdate)', 90)} END AS o_orderdate
    FROM orders
    """,
)
def year_of_text(spark, folder):
    df = load(spark, folder, "orders")
    df = df.withColumn("o_orderdate", date_text(F.col("o_orderdate"), F.col("o_orderkey")))
    return masked(df, {"o_orderkey": "Identity", "o_orderdate": "Year"})


@query(
    "year_compat",
    f"""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 9 = 1 THEN NULL
                WHEN o_orderkey % 9 IN (0, 3, 4, 5) THEN make_timestamp({AS_OF}, 1, 1, 0, 0, 0.0)
                ELSE {sql_floored('year(o_orderdate)', 90)} END AS o_orderdate
    FROM orders
    """,
)
def year_compat(spark, folder):
    df = load(spark, folder, "orders")
    df = df.withColumn("o_orderdate", date_text(F.col("o_orderdate"), F.col("o_orderkey")))
    return masked(df, {"o_orderkey": "Identity", "o_orderdate": "Year"}, compat=True)


@query(
    "date_day",
    f"""
    SELECT o_orderkey, {sql_floored('year(o_orderdate)', 89)} AS o_orderdate,
           CASE WHEN o_orderkey % 9 NOT IN (0, 1, 5)
                THEN {sql_floored('year(o_orderdate)', 89)} END AS as_text
    FROM orders
    """,
)
def date_day(spark, folder):
    df = load(spark, folder, "orders")
    df = df.withColumn("as_text", date_text(F.col("o_orderdate"), F.col("o_orderkey")))
    return masked(
        df, {"o_orderkey": "Identity", "o_orderdate": "DateDay", "as_text": "DateDay"}
    )


@query(
    "date_time_day",
    f"""
    SELECT event_id,
           make_timestamp(greatest(year(past), {AS_OF - 89})::BIGINT, 1, 1, hour(past)::BIGINT,
                          minute(past)::BIGINT, (microsecond(past) / 1000000.0)::DOUBLE) AS ts
    FROM (SELECT event_id, ts - to_years(CAST(user_id % 40 AS INTEGER)) AS past FROM events)
    """,
)
def date_time_day(spark, folder):
    """Event times moved up to 39 years back, across the floor."""
    past = F.col("ts") - F.make_ym_interval((F.col("user_id") % 40).cast("int"))
    df = load(spark, folder, "events").withColumn("ts", past)
    return masked(df, {"event_id": "Identity", "ts": "DateTimeDay"})


def dirty_text(c: str, key: str) -> Column:
    """Date texts as files have them: with milliseconds, NULL, and dates with
    something behind them, which are no dates."""
    stamp, k = F.col(c), F.col(key)
    day = F.date_format(stamp, "yyyy-MM-dd")
    return (
        F.when(k % 11 == 0, F.concat(day, F.lit(" soon")))
        .when(k % 11 == 1, F.concat(day, F.lit("Tgarbage")))
        .when(k % 11 == 2, F.concat(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), F.lit(" x")))
        .otherwise(date_text(stamp, k))
    )


def sql_dirty(key: str, c: str) -> str:
    """The timestamp that a dirty text stands for, to milliseconds where it has a time."""
    return (
        f"CASE WHEN {key} % 11 < 3 OR {key} % 9 IN (0, 1, 5) THEN NULL "
        f"WHEN {key} % 9 = 3 THEN date_trunc('milliseconds', {c}) "
        f"WHEN {key} % 9 = 4 THEN date_trunc('second', {c}) ELSE date_trunc('day', {c}) END"
    )


def dirty_events(spark, folder) -> DataFrame:
    past = F.col("ts") - F.make_ym_interval((F.col("user_id") % 40).cast("int"))
    return load(spark, folder, "events").withColumn("past", past)


DIRTY_EVENTS = f"""
    (SELECT event_id, user_id, {sql_dirty("event_id", "past")} AS past
     FROM (SELECT *, ts - to_years(CAST(user_id % 40 AS INTEGER)) AS past FROM events))
"""


@query(
    "date_time_day_text",
    f"""
    SELECT event_id, CASE WHEN past IS NOT NULL THEN
           make_timestamp(greatest(year(past), {AS_OF - 89})::BIGINT, 1, 1, hour(past)::BIGINT,
                          minute(past)::BIGINT, (microsecond(past) / 1000000.0)::DOUBLE) END AS past
    FROM {DIRTY_EVENTS}
    """,
)
def date_time_day_text(spark, folder):
    df = dirty_events(spark, folder).withColumn("past", dirty_text("past", "event_id"))
    return masked(df, {"event_id": "Identity", "past": "DateTimeDay"})


def sql_shift(patient: str, chance: str) -> str:
    days = "[" + ", ".join(map(str, SHIFT_DAYS)) + "]"
    digit = f"CAST(right(CAST({patient} AS VARCHAR), 1) AS INTEGER)"
    return (
        f"{days}[1 + CASE WHEN {patient} IS NULL THEN CAST(floor({chance} * 10) AS INTEGER) "
        f"ELSE {digit} END]"
    )


@query(
    "date_shift",
    f"""
    SELECT l_orderkey, l_linenumber,
           CAST(l_shipdate AS DATE) + {sql_shift("l_suppkey", "0")} AS l_shipdate
    FROM lineitem
    """,
)
def date_shift(spark, folder):
    return masked(
        load(spark, folder, "lineitem"),
        {"l_orderkey": "Identity", "l_linenumber": "Identity", "l_shipdate": "DateShift"},
        patient_column="l_suppkey",
    )


@query(
    "date_shift_text",
    f"""
    SELECT event_id, CAST(past AS DATE) + {sql_shift("user_id", "0")} AS past
    FROM {DIRTY_EVENTS}
    """,
)
def date_shift_text(spark, folder):
    df = dirty_events(spark, folder).withColumn("past", dirty_text("past", "event_id"))
    return masked(df, {"event_id": "Identity", "past": "DateShift"}, patient_column="user_id")


@query(
    "date_time_shift_text",
    f"""
    SELECT event_id, past + to_days({sql_shift("user_id", "0")}) AS past
    FROM {DIRTY_EVENTS}
    """,
)
def date_time_shift_text(spark, folder):
    df = dirty_events(spark, folder).withColumn("past", dirty_text("past", "event_id"))
    return masked(df, {"event_id": "Identity", "past": "DateTimeShift"}, patient_column="user_id")


@query(
    "date_shift_by_hash",
    """
    SELECT count(*) AS n_rows, true AS by_shifts, true AS one_shift_per_patient FROM events
    """,
)
def date_shift_by_hash(spark, folder):
    """Patient ids that end in a letter pick their shift by digest: one of the shifts,
    the same for every row of a patient."""
    df = load(spark, folder, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("x")).alias("patientid"),
        F.col("ts").cast("date").alias("day"),
        "ts",
    )
    out = masked(
        df,
        {"patientid": "Identity", "day": "Identity", "ts": "DateShift"},
        on_bad_key="hash",
    )
    days = F.datediff("ts", "day")
    per_patient = out.groupBy("patientid").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(days).alias("least"),
        F.max(days).alias("most"),
    )
    return per_patient.agg(
        F.sum("n").alias("n_rows"),
        F.bool_and(F.col("least").isin(*SHIFT_DAYS)).alias("by_shifts"),
        F.bool_and(F.col("least") == F.col("most")).alias("one_shift_per_patient"),
    )


@query(
    "bad_dates_fail",
    "SELECT 'unreadable date text' AS error, count(*) AS readable FROM orders",
)
def bad_dates_fail(spark, folder):
    """Under ``on_bad_date="error"`` an unreadable text fails the query, without being
    shown; readable ones pass."""
    df = load(spark, folder, "orders")
    dirty = df.withColumn("o_orderdate", dirty_text("o_orderdate", "o_orderkey"))
    rules = {"o_orderkey": "Identity", "o_orderdate": "Year"}
    error = "none"
    try:
        masked(dirty, rules, on_bad_date="error").write.format("noop").mode("overwrite").save()
    except PySparkException as failure:
        error = "unreadable date text" if "unreadable date text" in str(failure) else "another"
    clean = df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return masked(clean, rules, on_bad_date="error").agg(
        F.lit(error).alias("error"), F.count("o_orderdate").alias("readable")
    )


# Event times shifted by user, with some users unknown.
UNKNOWN_USER = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END"


@query(
    "date_time_shift",
    f"""
    SELECT event_id,
           ts + to_days({sql_shift("patientid", sql_chance("strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE rtrim('.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0'), '0') END", "event"))}) AS ts
    FROM (SELECT *, {UNKNOWN_USER} AS patientid FROM events)
    """,
)
def date_time_shift(spark, folder):
    df = load(spark, folder, "events").withColumn("patientid", F.expr(UNKNOWN_USER))
    return masked(
        df, {"event_id": "Identity", "ts": salted("DateTimeShift", "event")}, random="keyed"
    )


@query(
    "date_epoch",
    """
    SELECT l_orderkey, l_linenumber,
           CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS l_shipdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def date_epoch(spark, folder):
    dated = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    df = load(spark, folder, "lineitem").join(dated, F.col("l_orderkey") == F.col("o_orderkey"))
    return masked(
        df,
        {
            "l_orderkey": "Identity",
            "l_linenumber": "Identity",
            "l_shipdate": {"type": "DateEpoch", "date_epoch": "o_orderdate"},
        },
    )


@query(
    "date_epoch_text",
    f"""
    SELECT event_id, CAST(date_diff('day', CAST(past AS DATE), CAST(ts AS DATE)) AS INTEGER) AS ts
    FROM {DIRTY_EVENTS} JOIN (SELECT event_id, ts FROM events) USING (event_id)
    """,
)
def date_epoch_text(spark, folder):
    df = dirty_events(spark, folder).withColumn("past", dirty_text("past", "event_id"))
    df = df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    return masked(
        df, {"event_id": "Identity", "ts": {"type": "DateEpoch", "date_epoch": "past"}}
    )


@query(
    "epoch_start_text",
    f"""
    SELECT event_id, CAST(past AS DATE) + CAST(floor({sql_chance("text", "event")} * 1460) - 730
           AS INTEGER) AS EPOCH_START
    FROM (SELECT event_id, {sql_dirty("event_id", "ts")} AS past,
                 CASE WHEN event_id % 9 = 2 THEN strftime(ts, '%-m/%-d/%Y')
                      WHEN event_id % 9 = 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g')
                      WHEN event_id % 9 = 4 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                      ELSE strftime(ts, '%Y-%m-%d') END AS text
          FROM events)
    """,
)
def epoch_start_text(spark, folder):
    df = load(spark, folder, "events").withColumn("ts", dirty_text("ts", "event_id"))
    return masked(
        df,
        {
            "event_id": "Identity",
            "ts": [salted("EpochStart", "event"), "Drop"],
            "EPOCH_START": "Identity",
        },
        random="keyed",
    )


@query(
    "epoch_start_compat",
    f"""
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + to_months(1) AS DATE)
           + CAST(dayofmonth(o_orderdate) - 1 AS INTEGER) + CAST(floor(
               {sql_chance("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "o_orderdate")} * 1460) - 730
               AS INTEGER) AS EPOCH_START
    FROM orders
    """.replace("salt-o_orderdate", "salt-event"),
)
def epoch_start_compat(spark, folder):
    """A month on first, as older outputs have it; salts go by column name then."""
    df = load(spark, folder, "orders").withColumnRenamed("o_orderdate", "event")
    return masked(
        df,
        {"o_orderkey": "Identity", "event": ["EpochStart", "Drop"], "EPOCH_START": "Identity"},
        random="keyed",
        compat=True,
    )


@query(
    "epoch_start_keyed",
    f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST(floor(
               {sql_chance("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "event")} * 1460) - 730
               AS INTEGER) AS EPOCH_START
    FROM orders
    """,
)
def epoch_start_keyed(spark, folder):
    return masked(
        load(spark, folder, "orders"),
        {
            "o_orderkey": "Identity",
            "o_orderdate": [salted("EpochStart", "event"), "Drop"],
            "EPOCH_START": "Identity",
        },
        random="keyed",
    )


@query(
    "epoch_start_uniform",
    "SELECT count(*) AS n_rows, true AS within_bounds, true AS both_sides FROM orders",
)
def epoch_start_uniform(spark, folder):
    """Drawn epoch starts lie within 730 days, on both sides, and agree with the
    days counted from them."""
    df = load(spark, folder, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    out = masked(
        df,
        {
            "day": "Identity",
            "o_orderdate": ["EpochStart", {"type": "DateEpoch", "date_epoch": "EPOCH_START"}],
            "EPOCH_START": "Identity",
        },
    )
    days = F.datediff("EPOCH_START", "day")
    within = days.between(-730, 729) & (F.col("o_orderdate") == -days)
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(within).alias("within_bounds"),
        ((F.min(days) < 0) & (F.max(days) > 0)).alias("both_sides"),
    )


# -- people


@query(
    "age",
    """
    SELECT p_partkey, least(p_size * 2, 90) AS p_size,
           CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN NULL
                ELSE least(p_retailprice / 10, 90) END AS p_retailprice
    FROM part
    """,
)
def age(spark, folder):
    price = F.when(F.col("p_partkey") % 7 == 0, F.lit(None)).when(
        F.col("p_partkey") % 7 == 1, F.lit(float("nan"))
    )
    df = load(spark, folder, "part").select(
        "p_partkey",
        (F.col("p_size") * 2).alias("p_size"),
        price.otherwise(F.col("p_retailprice") / 10).alias("p_retailprice"),
    )
    return masked(df, {"p_partkey": "Identity", "p_size": "Age", "p_retailprice": "Age"})


@query(
    "max_year",
    f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL
           ELSE CAST(greatest(year(o_orderdate), {AS_OF - 90}) AS INTEGER) END AS year
    FROM orders
    """,
)
def max_year(spark, folder):
    year = F.when(F.col("o_orderkey") % 10 != 0, F.year("o_orderdate"))
    df = load(spark, folder, "orders").withColumn("year", year)
    return masked(df, {"o_orderkey": "Identity", "year": "MaxYear"})


ALL_TERMS = [term for _, terms in ETHNIC_GROUPS for term in terms] + ["white", "martian"]


def sql_group(term: str, null: str, compat: bool = False) -> str:
    cases = []
    for label, terms in ETHNIC_GROUPS:
        if compat and terms is PACIFIC_TERMS:
            label = PACIFIC_LABEL_COMPAT
        cases.append(f"WHEN lower({term}) IN {sql_in(terms)} THEN '{label}'")
    return f"CASE WHEN {term} IS NULL THEN {null} {' '.join(cases)} ELSE 'White' END"


RAW_TERM = f"""
    SELECT c_custkey, CASE WHEN c_custkey % 131 = 130 THEN NULL
           WHEN c_custkey % 2 = 0 THEN upper(term) ELSE term END AS term
    FROM (SELECT c_custkey,
                 ['{"', '".join(ALL_TERMS)}'][1 + c_custkey % {len(ALL_TERMS)}] AS term
          FROM customer)
"""


def with_term(df: DataFrame) -> DataFrame:
    terms = F.array(*[F.lit(term) for term in ALL_TERMS])
    term = F.get(terms, (F.col("c_custkey") % len(ALL_TERMS)).cast("int"))
    written = F.when(F.col("c_custkey") % 2 == 0, F.upper(term)).otherwise(term)
    return df.withColumn("term", F.when(F.col("c_custkey") % 131 != 130, written))


@query(
    "ethnicity",
    f"SELECT c_custkey, {sql_group('term', 'NULL')} AS term FROM ({RAW_TERM})",
)
def ethnicity(spark, folder):
    df = with_term(load(spark, folder, "customer"))
    return masked(df, {"c_custkey": "Identity", "term": "Ethnicity"})


@query(
    "ethnicity_compat",
    f"SELECT c_custkey, {sql_group('term', chr(39) * 2, True)} AS term FROM ({RAW_TERM})",
)
def ethnicity_compat(spark, folder):
    df = with_term(load(spark, folder, "customer"))
    return masked(df, {"c_custkey": "Identity", "term": "Ethnicity"}, compat=True)


GIVEN = default_given_names()
RAW_GENDER = """
    CASE c_custkey % 4 WHEN 0 THEN 'female' WHEN 1 THEN 'FEMALE' WHEN 2 THEN 'male' END
"""


def sql_given_name(name: str) -> str:
    def draw(label: str) -> str:
        chance = sql_chance(name, "person", label)
        female, male = sql_pick(GIVEN["female"], chance), sql_pick(GIVEN["male"], chance)
        return f"CASE WHEN lower(gender) = 'female' THEN {female} ELSE {male} END"

    return (
        f"CASE WHEN {name} IS NULL THEN NULL WHEN lower({draw('1')}) = lower({name}) "
        f"THEN {draw('2')} ELSE {draw('1')} END"
    )


@query(
    "names_keyed",
    f"""
    SELECT c_custkey, {sql_pick(FIRST_NAMES, sql_chance("name", "person"))} AS first_name,
           {sql_pick(LAST_NAMES, sql_chance("name", "person"))} AS last_name,
           {sql_given_name("given")} AS given_name
    FROM (SELECT *, {RAW_NAME} AS name,
                 {sql_pick(FIRST_NAMES, sql_chance("c_custkey", "event"))} AS given,
                 {RAW_GENDER} AS gender
          FROM customer)
    """,
)
def names_keyed(spark, folder):
    """Replacement names set by the name and the salt. Given names start from
    names of the list, so that some are drawn again."""
    df = load(spark, folder, "customer").select(
        "c_custkey",
        F.expr(RAW_NAME).alias("first_name"),
        F.expr(RAW_NAME).alias("last_name"),
        F.col("c_custkey").alias("given_name"),
        F.expr(RAW_GENDER).alias("gender"),
    )
    df = masked(
        df,
        {
            "c_custkey": "Identity",
            "first_name": "Identity",
            "last_name": "Identity",
            "given_name": salted("RandomFirstName", "event"),
            "gender": "Identity",
        },
        random="keyed",
    )
    return masked(
        df,
        {
            "c_custkey": "Identity",
            "first_name": salted("RandomFirstName", "person"),
            "last_name": salted("RandomLastName", "person"),
            "given_name": salted("oncoemrFirstName", "person"),
        },
        random="keyed",
    )


@query(
    "names_uniform",
    f"""
    SELECT count(*) AS n_rows, true AS in_lists,
           (count(*) FILTER ({RAW_NAME} IS NULL))::BIGINT AS n_null FROM customer
    """,
)
def names_uniform(spark, folder):
    df = load(spark, folder, "customer").select(
        F.col("c_name").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.expr(RAW_NAME).alias("given_name"),
        F.expr(RAW_GENDER).alias("gender"),
    )
    out = masked(
        df,
        {
            "first_name": "RandomFirstName",
            "last_name": "RandomLastName",
            "given_name": "oncoemrFirstName",
            "gender": "Identity",
        },
    )
    female = F.coalesce(F.lower("gender") == "female", F.lit(False))
    in_lists = (
        F.col("first_name").isin(*FIRST_NAMES)
        & F.col("last_name").isin(*LAST_NAMES)
        & (
            F.col("given_name").isNull()
            | F.when(female, F.col("given_name").isin(*GIVEN["female"])).otherwise(
                F.col("given_name").isin(*GIVEN["male"])
            )
        )
    )
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(in_lists).alias("in_lists"),
        F.count_if(F.col("given_name").isNull()).alias("n_null"),
    )


# -- the strategies as SQL functions


@query(
    "sql_functions",
    f"""
    SELECT c_custkey, {sql_zip3("zip", RESTRICTED_ZIP3)} AS zip,
           {sql_group("term", "NULL")} AS term,
           replace(replace(c_name, chr(10), ' '), chr(13), ' ') AS name
    FROM (SELECT c_custkey, c_name, {RAW_ZIP} AS zip FROM customer)
    JOIN ({RAW_TERM}) AS terms USING (c_custkey)
    """,
)
def sql_functions(spark, folder):
    register_sql(spark, AS_OF)
    df = with_term(load(spark, folder, "customer")).withColumn("zip", F.expr(RAW_ZIP))
    return df.selectExpr(
        "c_custkey", "Zip3(zip) AS zip", "Ethnicity(term) AS term", "CleanseData(c_name) AS name"
    )


@query(
    "sql_date_functions",
    f"""
    SELECT l_orderkey, l_linenumber,
           {sql_floored("year(l_shipdate)", 90)} AS year,
           {sql_floored("year(l_shipdate)", 89)} AS day_cut,
           CAST(l_shipdate AS DATE) + {sql_shift("l_suppkey", "0")} AS shifted,
           l_shipdate + to_days({sql_shift("l_suppkey", "0")}) AS stamp_shifted
    FROM lineitem
    """,
)
def sql_date_functions(spark, folder):
    register_sql(spark, AS_OF)
    return load(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "DateScrub(l_shipdate) AS year",
        "DateDayTransform(l_shipdate) AS day_cut",
        "DateShiftTransform(l_shipdate, l_suppkey) AS shifted",
        "DateTimeShiftTransform(l_shipdate, l_suppkey) AS stamp_shifted",
    )


@query(
    "sql_random_functions",
    """
    SELECT count(*) AS n_rows, true AS first_names, true AS last_names, true AS given_names,
           true AS epoch_starts, true AS times_kept FROM events
    """,
)
def sql_random_functions(spark, folder):
    """Drawn names come from their lists, drawn dates lie within bounds, times stay."""
    register_sql(spark, AS_OF)
    out = load(spark, folder, "events").selectExpr(
        "FirstName(event_type) AS first_name",
        "LastName(event_type) AS last_name",
        "oncoemrFirstName(event_type, if(user_id % 2 = 0, 'Female', 'x')) AS given_name",
        "user_id % 2 = 0 AS female",
        "datediff(EpochStart(ts), to_date(ts)) AS days",
        "DateTimeDayTransform(ts) AS cut",
        "ts",
    )
    given = F.when(F.col("female"), F.col("given_name").isin(*GIVEN["female"])).otherwise(
        F.col("given_name").isin(*GIVEN["male"])
    )
    year = F.greatest(F.year("ts"), F.lit(AS_OF - 89))
    time_of_day = F.date_format("cut", "HH:mm:ss.SSSSSS") == F.date_format("ts", "HH:mm:ss.SSSSSS")
    new_year = (F.year("cut") == year) & (F.dayofyear("cut") == 1)
    return out.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("first_name").isin(*FIRST_NAMES)).alias("first_names"),
        F.bool_and(F.col("last_name").isin(*LAST_NAMES)).alias("last_names"),
        F.bool_and(given).alias("given_names"),
        F.bool_and(F.col("days").between(-730, 729)).alias("epoch_starts"),
        F.bool_and(time_of_day & new_year).alias("times_kept"),
    )


@query(
    "sql_city_function",
    f"""
    WITH areas AS (SELECT DISTINCT substr(zip, 1, 3) AS zip3 FROM ({POSTAL})),
    raw AS (SELECT {RAW_ZIP} AS zip FROM customer)
    SELECT CASE WHEN zip IS NULL THEN 'none' WHEN length(zip) < 3 THEN 'invalid'
                WHEN zip3 IS NULL THEN 'unknown' ELSE 'of its area' END AS outcome,
           count(*) AS n
    FROM raw LEFT JOIN areas ON zip3 = substr(zip, 1, 3) AND length(zip) >= 3
    GROUP BY 1
    """,
)
def sql_city_function(spark, folder):
    places = postal(spark, folder)
    register_sql(spark, AS_OF, cities=places)
    out = load(spark, folder, "customer").selectExpr(f"{RAW_ZIP} AS zip")
    out = out.selectExpr("zip", "CityTransform(zip) AS city")
    known = places.select(F.substring("zip", 1, 3).alias("zip3"), F.col("city").alias("there"))
    known = known.distinct().withColumn("found", F.lit(True))
    checked = out.join(
        known, (F.substring("zip", 1, 3) == F.col("zip3")) & (F.col("city") == F.col("there")), "left"
    )
    outcome = (
        F.when(F.col("city").isNull(), "none")
        .when(F.col("found"), "of its area")
        .when(F.col("city") == "unknown", "unknown")
        .when(F.col("city") == "that is not a valid zipcode", "invalid")
        .otherwise("of another area")
    )
    return checked.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sql_key_function",
    f"""
    WITH RECURSIVE named AS (SELECT s_suppkey, {RAW_SUPPLIER} AS name FROM supplier),
    {sql_pbkdf2("SELECT trim(name) AS value FROM named", "salt-person")}
    SELECT s_suppkey, CASE WHEN name = '' THEN '' ELSE derived END AS s_name
    FROM named LEFT JOIN keys ON raw = trim(name)
    """,
)
def sql_key_function(spark, folder):
    """The salt is bound to the function; the query names its key."""
    register_sql(spark, AS_OF, salts=SALTS, salt_keys=["person"])
    named = load(spark, folder, "supplier").withColumn("s_name", F.expr(RAW_SUPPLIER))
    return named.selectExpr("s_suppkey", "PBEKeyHash(s_name, 'person') AS s_name")
