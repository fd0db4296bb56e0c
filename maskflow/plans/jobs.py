"""Jobs over whole sets of tables: match a policy, read, mask, write."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from maskflow.functions.text import quoted
from maskflow.operators.masking import DRAWN, SALTED, deidentify
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import TablePolicy, best_name, match_policy
from maskflow.plans.salts import Salts
from maskflow.sources.files import list_tables, read_csv
from maskflow.sources.fixedwidth import Field, read_fixed_width
from maskflow.sources.jdbc import JdbcConnection, read_jdbc
from maskflow.sources.layouts import CLAIM_LAYOUTS
from maskflow.sources.sinks import Sink

logger = logging.getLogger(__name__)


# Seconds that the figures of a write may come after it.
FIGURES_WITHIN = 60


@dataclass(frozen=True)
class TableCounts:
    """What was written of a table: rows, nulls by column, and the columns left out."""

    rows: int
    nulls: dict[str, int]
    dropped: list[str]


@dataclass(frozen=True)
class Outcome:
    """Names of the tables a job wrote, and of those its sink left as they were; figures of
    the written ones, by name, where the job was asked to count."""

    written: list[str]
    skipped: list[str]
    counts: dict[str, TableCounts] = field(default_factory=dict, compare=False)


class Counting:
    """Counts rows and nulls of a table while it is written, without a job of its own."""

    def __init__(self, raw: DataFrame, masked: DataFrame):
        kept = {name.lower() for name in masked.columns}
        self.columns = masked.columns
        self.dropped = [name for name in raw.columns if name.lower() not in kept]
        self.observation = Observation()
        nulls = [F.count_if(F.col(quoted(name)).isNull()).alias(f"nulls_{k}") for k, name in enumerate(self.columns)]
        self.df = masked.observe(self.observation, F.count(F.lit(1)).alias("n_rows"), *nulls)

    def result(self) -> TableCounts | None:
        """The figures; None if the sink ran nothing that would have given them."""
        found: list[dict] = []
        # Waits for the write, which a sink may never run: in a thread that ends with the program.
        waiting = threading.Thread(target=lambda: found.append(self.observation.get), daemon=True)
        waiting.start()
        waiting.join(FIGURES_WITHIN)
        if not found:
            return None
        nulls = {name: found[0][f"nulls_{k}"] for k, name in enumerate(self.columns)}
        return TableCounts(found[0]["n_rows"], nulls, self.dropped)


def deidentify_dataset(
    tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
    policies: Iterable[TablePolicy],
    sink: Sink,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    at_once: int = 4,
    count: bool = False,
) -> Outcome:
    """Mask every table under the policy matching its name and hand it to the sink.

    Each table is one write, named after its policy; up to ``at_once`` writes
    share the cluster, so small tables do not wait for a large one. All
    policies are matched, and salts that are to be made are made, before
    anything is written. ``count`` gives rows and nulls of every table, counted as it
    is written.
    """
    policies = list(policies)
    matched = {name: match_policy(name, policies) for name in tables}
    names = [policy.name for policy in matched.values()]
    twice = {name for name in names if names.count(name) > 1}
    if twice:
        raise ValueError(f"several tables match the policies {sorted(twice)}")

    if salts is not None and salts.creates:
        salts.resolve(_salt_keys(matched.values(), options or MaskOptions()))

    counts: dict[str, TableCounts] = {}

    def run(name: str) -> bool:
        table = tables[name]
        df = table() if callable(table) else table
        masked = deidentify(df, matched[name], salts, options)
        counting = Counting(df, masked) if count else None
        wrote = sink(matched[name].name, counting.df if counting else masked) is not False
        if wrote and counting:
            found = counting.result()
            if found is not None:
                counts[matched[name].name] = found
        logger.info("%s %s", "wrote" if wrote else "left", matched[name].name)
        return wrote

    if not tables:
        return Outcome([], [])
    session = SparkSession.active()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        waiting = [
            pool.submit(inheritable_thread_target(session)(run), name) for name in tables
        ]
        wrote = [task.result() for task in waiting]
    return Outcome(
        [name for name, new in zip(names, wrote) if new],
        [name for name, new in zip(names, wrote) if not new],
        counts,
    )


def _salt_keys(policies: Iterable[TablePolicy], options: MaskOptions) -> list[str]:
    """Keys of the salts that masking under these policies looks up."""
    salted = SALTED | (DRAWN if options.random == "keyed" else set())
    return [
        options.salt_key(strategy.column, strategy.salt_key)
        for policy in policies
        for strategy in policy.strategies
        if strategy.type in salted
    ]


def _paths_by_policy(
    spark: SparkSession, folder: str, policies: list[TablePolicy]
) -> dict[str, list[str]]:
    """Files of a folder grouped by policy: parts of one table are read together."""
    grouped: dict[str, list[str]] = {}
    for name, path in list_tables(spark, folder).items():
        grouped.setdefault(match_policy(name, policies).name, []).append(path)
    return grouped


def mask_csv_folder(
    spark: SparkSession,
    folder: str,
    policies: Iterable[TablePolicy],
    sink: Sink,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    infer_types: bool | None = None,
    multi_line: bool = False,
    at_once: int = 4,
    count: bool = False,
) -> Outcome:
    """Every CSV file of a folder. Columns whose text must stay as it is, are text.

    Types are inferred, at the price of reading the files once more, where the
    policy passes some on; ``infer_types`` sets it for all tables.
    ``multi_line`` allows line breaks within quotes; such files are read by one
    task each.
    """
    policies = list(policies)
    by_name = {policy.name: policy for policy in policies}

    def reader(name: str, paths: list[str]) -> Callable[[], DataFrame]:
        policy = by_name[name]
        infer = policy.keeps_types() if infer_types is None else infer_types
        text = policy.text_columns()
        return lambda: read_csv(spark, paths, infer, text, multi_line=multi_line)

    grouped = _paths_by_policy(spark, folder, policies)
    tables = {name: reader(name, paths) for name, paths in grouped.items()}
    return deidentify_dataset(tables, policies, sink, salts, options, at_once, count)


def mask_fixed_width_folder(
    spark: SparkSession,
    folder: str,
    policies: Iterable[TablePolicy],
    sink: Sink,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    layouts: Mapping[str, list[Field]] = CLAIM_LAYOUTS,
    mode: str = "FAILFAST",
    at_once: int = 4,
    count: bool = False,
) -> Outcome:
    """Every fixed-width file of a folder, its layout found by file name."""
    policies = list(policies)
    tables = {}
    for name, paths in _paths_by_policy(spark, folder, policies).items():
        found = {best_name(path.rsplit("/", 1)[-1], layouts) for path in paths}
        if len(found) != 1 or None in found:
            raise ValueError(f"no single layout matches the files of {name!r}")
        tables[name] = read_fixed_width(spark, paths, layouts[found.pop()], mode)
    return deidentify_dataset(tables, policies, sink, salts, options, at_once, count)


def mask_database(
    spark: SparkSession,
    connection: JdbcConnection,
    policies: Iterable[TablePolicy],
    sink: Sink,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    tables: Iterable[str] | None = None,
    partitions: int | None = None,
    cuts: Mapping[str, list] | None = None,
    at_once: int = 4,
    count: bool = False,
) -> Outcome:
    """Database tables, read in ranges where the policy names a partitioning column.

    ``tables`` picks some by name; otherwise every policy is a table. ``cuts``
    has, by policy name, where to cut the ranges of a column whose values crowd.
    """
    policies = list(policies)
    names = list(tables) if tables is not None else [policy.name for policy in policies]

    def reader(policy: TablePolicy) -> Callable[[], DataFrame]:
        return lambda: read_jdbc(
            spark, connection, policy.name, policy.partition_column, partitions,
            (cuts or {}).get(policy.name),
        )

    matched = [match_policy(name, policies) for name in names]
    readers = {policy.name: reader(policy) for policy in matched}
    return deidentify_dataset(readers, policies, sink, salts, options, at_once, count)
