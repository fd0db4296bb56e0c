"""Masking policies: which strategy applies to which column of which table.

A policy document is JSON. For many tables::

    {"visits": {"_meta": {"partitioningColumn": "visit_id"},
                "patient_id": {"strategy": [{"type": "Hash", "salt_key": "patient"}]}}}

For a single table the outer level is left out. Keys other than those shown
are ignored, so documents may carry notes of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession

# The names of strategies that policies use.
STRATEGY_TYPES = frozenset(
    {
        "Identity",
        "Hash",
        "PBEKeyHash",
        "City",
        "Clear",
        "Drop",
        "Duplicate",
        "Zip3Digit",
        "EpochStart",
        "Year",
        "Age",
        "DateEpoch",
        "DateTimeDay",
        "DateDay",
        "DateShift",
        "DateTimeShift",
        "RandomFirstName",
        "RandomLastName",
        "oncoemrFirstName",
        "FixedFirstName",
        "FixedLastName",
        "Ethnicity",
        "MaxYear",
    }
)

# Strategies whose input must reach them as text: an inferred numeric type
# would already have lost leading zeros.
TEXT_STRATEGIES = frozenset({"Zip3Digit", "City", "Hash", "PBEKeyHash"})

# Strategies whose result has the type of their input.
TYPE_KEEPING = frozenset({"Identity", "Duplicate", "Age", "MaxYear"})


@dataclass(frozen=True)
class Strategy:
    """One treatment of one column."""

    column: str
    type: str
    salt_key: str | None = None
    date_epoch: str | None = None


@dataclass(frozen=True)
class TablePolicy:
    """All treatments of one table, in document order."""

    name: str
    strategies: tuple[Strategy, ...]
    partition_column: str | None = None

    def chains(self) -> dict[str, list[Strategy]]:
        """Strategies per column in list order; columns differing in case are one."""
        names: dict[str, str] = {}
        chains: dict[str, list[Strategy]] = {}
        for strategy in self.strategies:
            name = names.setdefault(strategy.column.lower(), strategy.column)
            chains.setdefault(name, []).append(strategy)
        return chains

    def text_columns(self) -> list[str]:
        """Columns a reader should keep as text whatever their values look like."""
        return [s.column for s in self.strategies if s.type in TEXT_STRATEGIES]

    def keeps_types(self) -> bool:
        """Whether the types a reader finds can show in the masked table."""
        return any(s.type in TYPE_KEEPING for s in self.strategies)

    def check(self) -> None:
        for strategy in self.strategies:
            if strategy.type not in STRATEGY_TYPES:
                raise ValueError(
                    f"unknown strategy type {strategy.type!r} for column {strategy.column!r}"
                )
            if strategy.type == "DateEpoch" and not strategy.date_epoch:
                raise ValueError(f"DateEpoch on {strategy.column!r} needs date_epoch")


def _column_strategies(columns: Mapping) -> tuple[Strategy, ...]:
    found = []
    for column, block in columns.items():
        if not isinstance(block, Mapping):
            raise ValueError(f"column {column!r}: expected an object")
        for item in block.get("strategy") or []:
            if not isinstance(item, Mapping) or not isinstance(item.get("type"), str):
                raise ValueError(f"column {column!r}: every strategy needs a type")
            found.append(
                Strategy(column, item["type"], item.get("salt_key"), item.get("date_epoch"))
            )
    return tuple(found)


def _object(text: str) -> Mapping:
    if text is None:
        raise ValueError("policy text is None")
    document = json.loads(text)
    if not isinstance(document, Mapping):
        raise ValueError("a policy document must be a JSON object")
    return document


def parse_policies(text: str) -> list[TablePolicy]:
    """Policies of a many-table document."""
    policies = []
    for table, block in _object(text).items():
        if not isinstance(block, Mapping):
            raise ValueError(f"table {table!r}: expected an object")
        meta = block.get("_meta") or {}
        columns = {name: body for name, body in block.items() if name != "_meta"}
        policies.append(
            TablePolicy(table, _column_strategies(columns), meta.get("partitioningColumn"))
        )
    return policies


def parse_table_policy(text: str, name: str = "") -> TablePolicy:
    """The policy of a single-table document."""
    return TablePolicy(name, _column_strategies(_object(text)))


def read_document(path: str, spark: SparkSession | None = None) -> str:
    """Text of a small document, from any file system Spark can reach."""
    if spark is None:
        return Path(path).read_text(encoding="utf-8")
    rows = spark.read.text(path, wholetext=True).head(1)
    if not rows:
        raise ValueError(f"empty document: {path}")
    return rows[0][0]


def load_policies(path: str, spark: SparkSession | None = None) -> list[TablePolicy]:
    return parse_policies(read_document(path, spark))


def best_name(name: str, choices: Iterable[str]) -> str | None:
    """The choice equal to ``name``, else the longest one contained in it (any case)."""
    lowered = name.lower()
    choices = list(choices)
    for choice in choices:
        if choice.lower() == lowered:
            return choice
    contained = [choice for choice in choices if choice and choice.lower() in lowered]
    return max(contained, key=len, default=None)


def match_policy(name: str, policies: Iterable[TablePolicy]) -> TablePolicy:
    """The policy for a table or file name."""
    by_name = {policy.name: policy for policy in policies}
    found = best_name(name, by_name)
    if found is None:
        raise ValueError(f"no policy matches {name!r}")
    return by_name[found]
