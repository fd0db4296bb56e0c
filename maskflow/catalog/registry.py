"""The registry, and pieces that queries and their SQL share."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from maskflow.operators.masking import deidentify
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import TablePolicy, parse_table_policy
from maskflow.plans.salts import Salts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The year that floors count back from: its floors fall within the order dates.
AS_OF = 2088

SALTS = Salts({"person": "salt-person", "place": "salt-place", "event": "salt-event"})


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL if there is one."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def salted(type_: str, key: str) -> dict[str, str]:
    return {"type": type_, "salt_key": key}


def policy(columns: dict, name: str = "") -> TablePolicy:
    """Policy from {column: strategy or list of strategies}; a strategy is a type
    or the JSON object of one."""
    document = {}
    for column, chain in columns.items():
        chain = chain if isinstance(chain, list) else [chain]
        document[column] = {
            "strategy": [{"type": item} if isinstance(item, str) else item for item in chain]
        }
    return parse_table_policy(json.dumps(document), name)


def masked(df: DataFrame, columns: dict, where=None, **options) -> DataFrame:
    options.setdefault("as_of_year", AS_OF)
    return deidentify(df, policy(columns), SALTS, MaskOptions(**options), where)


# -- SQL text

def sql_hash(value: str, key: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {text} = '' THEN '' ELSE sha256(trim({text}, ' ') || 'salt-{key}') END"


def sql_chance(value: str, key: str, label: str = "") -> str:
    text = f"'salt-{key}|{label}' || coalesce(CAST({value} AS VARCHAR), '')"
    return f"(('0x' || substr(md5({text}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + value.replace("'", "''") + "'" for value in values) + "]"


def sql_in(values) -> str:
    return "(" + sql_list(values)[1:-1] + ")"


def sql_pick(values, chance: str) -> str:
    return f"{sql_list(values)}[1 + CAST(floor({chance} * {len(values)}) AS INTEGER)]"


def sql_floored(year: str, back: int) -> str:
    """January 1 of a year, at least ``back`` years before AS_OF."""
    return f"make_timestamp(greatest({year}, {AS_OF - back})::BIGINT, 1, 1, 0, 0, 0.0)"


def sql_zip3(value: str, restricted) -> str:
    area = f"rpad(substr({value}, 1, 3), 3, '0')"
    return (
        f"CASE WHEN {value} IS NULL OR lower({value}) = 'null' THEN NULL "
        f"WHEN {area} IN {sql_in(restricted)} THEN '00000' ELSE {area} || '00' END"
    )
