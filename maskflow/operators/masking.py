"""Masking one table: every policy column treated, every other column removed.

A policy compiles to one projection of built-in expressions, so scans keep
column pruning and whole-stage code generation. Only two strategies look values
up in another table (``PBEKeyHash`` and ``City``) and add joins below that
projection. Salts are columns right below it, and random draws columns below
the joins, since an expression naming a draw twice must see the same number.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskflow.functions import dates, people, places, text
from maskflow.functions.text import quoted
from maskflow.functions.vocabulary import FIRST_NAMES, LAST_NAMES
from maskflow.operators.cities import add_city
from maskflow.operators.keys import add_derived_keys
from maskflow.operators.state import add_state_key
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import Strategy, TablePolicy
from maskflow.plans.salts import Salts

logger = logging.getLogger(__name__)

STRING, DATE, INT, LONG = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()
STAMP = T.TimestampNTZType()

# Strategies that need no value and so also work on a column the table lacks.
CONSTANTS = {"Clear": " ", "FixedFirstName": "FirstName", "FixedLastName": "LastName"}
EPOCH_START = "EPOCH_START"

# Strategies that use a salt, and those that do when draws are keyed.
SALTED = {"Hash", "PBEKeyHash"}
DRAWN = {
    "City", "EpochStart", "DateShift", "DateTimeShift",
    "RandomFirstName", "RandomLastName", "oncoemrFirstName",
}


@dataclass(frozen=True)
class Value:
    """An SQL expression and the type it has."""

    sql: str
    dtype: T.DataType
    level: int = 0  # lookups that must run one after another before it exists

    def text(self) -> str:
        if isinstance(self.dtype, T.StringType):
            return self.sql
        if isinstance(self.dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise ValueError(f"strategy needs a plain value, not {self.dtype.simpleString()}")
        return f"CAST({self.sql} AS STRING)"


@dataclass
class Lookup:
    """A step below the final projection that adds the column ``out``."""

    kind: str
    out: str
    input: str
    level: int
    salt: str | None = None
    chance: str = "0"


@dataclass
class Masking:
    """Compiles a table's policy: expressions, draws and lookups."""

    df: DataFrame
    salts: Salts
    options: MaskOptions
    source: dict[str, Value] = field(default_factory=dict)
    derived: dict[str, tuple[str, Value]] = field(default_factory=dict)
    draws: list[tuple[str, int]] = field(default_factory=list)
    lookups: list[Lookup] = field(default_factory=list)
    used: set[str] = field(default_factory=set)
    secrets: dict[str, tuple[str, Column]] = field(default_factory=dict)

    def __post_init__(self):
        for item in self.df.schema.fields:
            self.source[item.name.lower()] = Value(quoted(item.name), item.dataType)

    # -- inputs of strategies

    def salt(self, strategy: Strategy) -> str:
        return self.salts.get(self.options.salt_key(strategy.column, strategy.salt_key))

    def secret_salt(self, strategy: Strategy) -> str:
        """Name of the column that holds the salt."""
        key = self.options.salt_key(strategy.column, strategy.salt_key)
        if key not in self.secrets:
            salt = text.secret(self.df.sparkSession, self.salts.get(key))
            self.secrets[key] = (f"__salt_{len(self.secrets)}", salt)
        return self.secrets[key][0]

    def chance(self, strategy: Strategy, value: Value, label: str = "") -> str:
        """A number from 0 up to 1: drawn anew per row, or set by value and salt."""
        if self.options.random == "keyed":
            tagged = f"concat('{label}', coalesce({value.text()}, ''))"
            return people.keyed_chance(tagged, self.secret_salt(strategy))
        name = f"__draw_{len(self.draws)}"
        seed = self.options.draw_seed(f"{strategy.column}/{strategy.type}/{len(self.draws)}")
        self.draws.append((name, seed))
        return name

    def other(self, name: str, strategy: Strategy) -> Value:
        """Another column as the table has it; only derived names give derived values."""
        found = self.derived.get(name.lower())
        if found is not None:
            return found[1]
        if name.lower() not in self.source:
            raise ValueError(
                f"{strategy.type} on {strategy.column!r} needs column {name!r}, which is missing"
            )
        self.used.add(name.lower())
        return self.source[name.lower()]

    # -- strategies

    def apply(self, s: Strategy, v: Value) -> Value:
        """The value after one strategy. Drop and the deriving types are the caller's."""
        o = self.options
        if s.type in CONSTANTS:
            return Value(text.literal(CONSTANTS[s.type]), STRING)
        match s.type:
            case "Identity":
                if isinstance(v.dtype, T.StringType):
                    return Value(text.clean_lines(v.sql), STRING)
                return v
            case "Hash":
                salt = self.secret_salt(s)
                is_text = isinstance(v.dtype, T.StringType)
                return Value(text.salted_hash(v.text(), salt, o.hash_bits, is_text), STRING)
            case "PBEKeyHash":
                return self.derive_key(s, v)
            case "City":
                return self.city(s, v)
            case "Zip3Digit":
                return Value(places.zip3(places.zip_text(v.sql, v.dtype)), STRING)
            case "Year":
                if o.compat:
                    return Value(dates.year_only_compat(v.sql, v.dtype, o.year), STAMP)
                return Value(dates.year_only(v.sql, v.dtype, o.year, o.on_bad_date), STAMP)
            case "DateDay":
                return Value(dates.day_cut(v.sql, v.dtype, o.year, o.on_bad_date), STAMP)
            case "DateTimeDay":
                return Value(
                    dates.day_cut_keep_time(v.sql, v.dtype, o.year, o.on_bad_date), STAMP
                )
            case "DateEpoch":
                start = self.other(s.date_epoch, s)
                days = dates.days_between(
                    dates.as_date(v.sql, v.dtype, o.on_bad_date),
                    dates.as_date(start.sql, start.dtype, o.on_bad_date),
                )
                return Value(days, INT, start.level)
            case "DateShift":
                shifted = dates.as_date(v.sql, v.dtype, o.on_bad_date)
                return Value(dates.shift_date(shifted, self.shift(s, v)), DATE)
            case "DateTimeShift":
                shifted = dates.as_stamp(v.sql, v.dtype, o.on_bad_date)
                return Value(dates.shift_stamp(shifted, self.shift(s, v)), STAMP)
            case "Age":
                is_text = isinstance(v.dtype, T.StringType)
                return _as_was(people.cap_age(v.sql, v.dtype), LONG if is_text else v.dtype)
            case "MaxYear":
                is_text = isinstance(v.dtype, T.StringType)
                capped = people.floor_year(v.sql, v.dtype, o.year)
                return _as_was(capped, INT if is_text else v.dtype)
            case "Ethnicity":
                group = people.ethnic_group(v.text(), o.ethnicity_default, o.compat)
                return Value(group, STRING)
            case "RandomFirstName":
                return Value(people.pick(FIRST_NAMES, self.chance(s, v)), STRING)
            case "RandomLastName":
                return Value(people.pick(LAST_NAMES, self.chance(s, v)), STRING)
            case "oncoemrFirstName":
                return Value(self.given_name(s, v), STRING)
        raise ValueError(f"unknown strategy type {s.type!r} for column {s.column!r}")

    def shift(self, s: Strategy, v: Value) -> str:
        """Days to shift by; the patient id of a null date is not looked at."""
        patient = self.other(self.options.patient_column, s).text()
        days = dates.shift_days(patient, self.chance(s, v), self.options.on_bad_key)
        return f"CASE WHEN {v.sql} IS NOT NULL THEN {days} END"

    def given_name(self, s: Strategy, v: Value) -> str:
        gender = self.other(self.options.gender_column, s).text()
        names = self.options.given_names
        first, second = self.chance(s, v, "1"), self.chance(s, v, "2")
        return people.given_name(v.text(), gender, names["female"], names["male"], first, second)

    def lookup(self, kind: str, value: str, level: int, **extra) -> Value:
        out = f"__lookup_{len(self.lookups)}"
        self.lookups.append(Lookup(kind, out, value, level, **extra))
        return Value(out, STRING, level + 1)

    def derive_key(self, s: Strategy, v: Value) -> Value:
        value = v.text()
        chosen = self.options.key_derivation
        if chosen == "state" and self.df.isStreaming:
            kind = "state key"
        else:
            kind = "inline key" if chosen == "inline" or self.df.isStreaming else "key"
        found = self.lookup(kind, text.strip_blanks(value), v.level, salt=self.salt(s))
        lost = "raise_error('the table changed while keys were derived')"
        key = (
            f"CASE WHEN {value} = '' THEN '' "
            f"WHEN {value} IS NOT NULL THEN coalesce({found.sql}, {lost}) END"
        )
        return replace(found, sql=key)

    def city(self, s: Strategy, v: Value) -> Value:
        if self.options.cities is None:
            raise ValueError(f"City on {s.column!r} needs the option cities")
        if self.options.city_zip_column:
            v = self.other(self.options.city_zip_column, s)
        zip_code = places.zip_text(v.sql, v.dtype)
        chance = self.chance(s, Value(zip_code, STRING))
        return self.lookup("city", zip_code, v.level, chance=chance)

    def epoch_start(self, s: Strategy, v: Value) -> Value:
        day = dates.as_date(v.sql, v.dtype, self.options.on_bad_date)
        chance = self.chance(s, v)
        return Value(dates.epoch_start(day, chance, self.options.compat), DATE)

    def chain(self, strategies: list[Strategy], value: Value | None) -> Value | None:
        """The value after all strategies in list order; None if it is dropped."""
        for strategy in strategies:
            if strategy.type == "Drop":
                return None
            if value is None and strategy.type not in CONSTANTS:
                raise ValueError(f"column {strategy.column!r} is missing from the table")
            if strategy.type == "Duplicate":
                name = f"{strategy.column}_duplicate"
                self.derived[name.lower()] = (name, value)
            elif strategy.type == "EpochStart":
                derived = replace(self.epoch_start(strategy, value), level=value.level)
                self.derived[EPOCH_START.lower()] = (EPOCH_START, derived)
            else:
                before = value.level if value is not None else 0
                value = self.apply(strategy, value)
                value = replace(value, level=max(value.level, before))
        return value

    def reads_derived(self, strategies: list[Strategy]) -> bool:
        """Whether a chain refers to a column that another chain derives."""
        refers = {s.date_epoch.lower() for s in strategies if s.type == "DateEpoch"}
        return EPOCH_START.lower() in refers or any(r not in self.source for r in refers)

    # -- the frame below the projection

    def with_values(self, frame: DataFrame, values: dict[str, str]) -> DataFrame:
        """Add columns, the salts being at hand for their expressions."""
        salts = [salt.alias(name) for name, salt in self.secrets.values()]
        return frame.select("*", *salts).selectExpr(
            *[quoted(name) for name in frame.columns],
            *[f"{value} AS {quoted(name)}" for name, value in values.items()],
        )

    def lower_frame(self) -> DataFrame:
        """The needed columns with draws and looked-up values added."""
        kept = [name for name in self.df.columns if name.lower() in self.used]
        frame = self.df.selectExpr(
            *[quoted(name) for name in kept],
            *[f"rand({seed}L) AS {name}" for name, seed in self.draws],
        )
        spread_on = [
            item.name
            for item in self.df.schema.fields
            if item.name in kept and _hashable(item.dataType)
        ]
        for level in sorted({lookup.level for lookup in self.lookups}):
            todo = [lookup for lookup in self.lookups if lookup.level == level]
            inputs = {f"{lookup.out}_input": lookup.input for lookup in todo}
            chances = {f"{x.out}_chance": x.chance for x in todo if x.kind == "city"}
            frame = self.with_values(frame, inputs | chances)
            keys = {x.out: (f"{x.out}_input", x.salt) for x in todo if x.kind == "key"}
            if keys:
                frame = add_derived_keys(
                    frame, keys, spread_on, self.options.broadcast_bytes, self.options.key_dictionary
                )
            for lookup in todo:
                value, chance = f"{lookup.out}_input", f"{lookup.out}_chance"
                if lookup.kind == "inline key":
                    key = text.pbkdf2_udf([lookup.salt])(F.lit(0), F.col(value))
                    frame = frame.withColumn(lookup.out, key)
                elif lookup.kind == "state key":
                    frame = add_state_key(frame, value, lookup.salt, lookup.out, spread_on)
                elif lookup.kind == "city":
                    frame = add_city(
                        frame, value, chance, self.options.cities, lookup.out,
                        self.options.broadcast_bytes, spread_on,
                    )
            frame = frame.drop(*inputs, *chances)
        return frame


def _as_was(sql: str, dtype: T.DataType) -> Value:
    """A number in the type it came in, which comparing it with a bound may widen."""
    return Value(f"CAST({sql} AS {dtype.simpleString()})", dtype)


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def deidentify(
    df: DataFrame,
    policy: TablePolicy,
    salts: Salts | None = None,
    options: MaskOptions | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """The table under its policy. Columns without a strategy are removed.

    ``where`` picks rows by the columns as the table has them. It reaches the
    scan, which a filter on a masked text does not: cleansing wraps its column.

    Column names match in any case. ``EPOCH_START`` and ``*_duplicate`` columns
    that strategies add are kept where the policy lists them too (or with
    ``keep_derived``); strategies listed for them apply to the added values.
    """
    policy.check()
    if where is not None:
        df = df.where(where)
    masking = Masking(df, salts or Salts(), options or MaskOptions())
    chains = {name.lower(): (name, strategies) for name, strategies in policy.chains().items()}
    masked: dict[str, Value | None] = {}

    # Chains that refer to derived columns come after those that derive them.
    # A derived column takes the place of a source column of its name.
    deriving = {f"{s.column}_duplicate".lower() for s in policy.strategies if s.type == "Duplicate"}
    if any(s.type == "EpochStart" for s in policy.strategies):
        deriving.add(EPOCH_START.lower())
    on_source = [key for key in chains if key in masking.source and key not in deriving]
    on_source.sort(key=lambda key: masking.reads_derived(chains[key][1]))
    for key in on_source:
        masking.used.add(key)
        masked[key] = masking.chain(chains[key][1], masking.source[key])

    waiting = [key for key in chains if key not in masked]
    while ready := [key for key in waiting if key in masking.derived]:
        for key in ready:
            masked[key] = masking.chain(chains[key][1], masking.derived[key][1])
        waiting = [key for key in chains if key not in masked]

    added = {}
    for key in waiting:
        name, strategies = chains[key]
        value = _missing(name, strategies, masking)
        if value is not None:
            added[name] = value

    out = []
    for name in df.columns:
        if name.lower() not in chains:
            logger.warning("no strategy for column %s, dropping it", name)
        elif masked.get(name.lower()) is not None:
            out.append((name, masked[name.lower()].sql))
    for key, (name, value) in masking.derived.items():
        if key in chains:
            if masked.get(key) is not None and key not in masking.source:
                out.append((name, masked[key].sql))
        elif masking.options.keep_derived:
            out.append((name, value.sql))
    out += [(name, value.sql) for name, value in added.items()]

    frame = masking.lower_frame() if masking.draws or masking.lookups else df
    if masking.secrets:
        frame = frame.select("*", *[salt.alias(name) for name, salt in masking.secrets.values()])
    return frame.selectExpr(*[f"{sql} AS {quoted(name)}" for name, sql in out])


@dataclass(frozen=True)
class Coverage:
    """How a policy and a table fit: columns treated, removed, and policy columns
    that the table lacks, which often are misspelt."""

    treated: list[str]
    removed: list[str]
    missing: list[str]


def policy_coverage(df: DataFrame, policy: TablePolicy) -> Coverage:
    """Compare a policy with a table's columns without reading the table."""
    listed = {name.lower(): name for name in policy.chains()}
    present = {name.lower() for name in df.columns}
    derived = {f"{s.column}_duplicate".lower() for s in policy.strategies if s.type == "Duplicate"}
    if any(s.type == "EpochStart" for s in policy.strategies):
        derived.add(EPOCH_START.lower())
    return Coverage(
        [name for name in df.columns if name.lower() in listed],
        [name for name in df.columns if name.lower() not in listed],
        [name for key, name in listed.items() if key not in present | derived],
    )


def _missing(name: str, strategies: list[Strategy], masking: Masking) -> Value | None:
    """Treatment of a policy column that the table lacks.

    Identity and Drop leave it out, constants create it, and the strategies
    that need a value fail.
    """
    logger.warning("policy column %s is missing from the table", name)
    types = {strategy.type for strategy in strategies}
    if masking.options.on_missing == "warn" or types <= {"Identity", "Drop"}:
        return None
    return masking.chain([s for s in strategies if s.type != "Identity"], None)
