"""Options of a masking run."""

from __future__ import annotations

import datetime
import secrets
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from maskflow.functions.vocabulary import default_given_names
from maskflow.operators.dictionary import KeyDictionary


@dataclass(frozen=True)
class MaskOptions:
    """How strategies behave where a policy leaves it open.

    as_of_year      year that the 89/90-year floors count back from; None is this year
    random          "uniform": every row draws anew, results cannot be linked;
                    "keyed": a salted digest of the value picks, results repeat
    seed            seed of the uniform draws; None takes a fresh one
    hash_bits       512, or 256 for a shorter Hash
    salt_by         "key": columns naming one salt_key share a salt;
                    "column": the column name is the salt key
    compat          keep the historical quirks of Year, EpochStart and Ethnicity
                    and salt by column
    patient_column  column whose last digit sets the date shift
    gender_column   column that selects the list of replacement first names
    on_bad_key      patient ids not ending in a digit: "error", or "hash" to
                    pick a shift from a digest of the id
    on_bad_date     unreadable date text: "null" or "error"
    on_missing      policy columns absent from the table: "error" where the
                    strategy needs a value, or "warn" to leave all of them out
    keep_derived    keep EPOCH_START and *_duplicate though no policy lists them
    key_derivation  "distinct" derives once per distinct value and joins back,
                    "inline" derives within the scan (as streams do), "state" keeps the
                    keys of a stream in its state, which needs the RocksDB state store
    key_dictionary  where "distinct" looks keys up and keeps new ones for later runs
    cities          postal table (zip, city) for City
    city_zip_column column holding the zip when City masks a place name
    given_names     {"female": [...], "male": [...]} for oncoemrFirstName
    broadcast_bytes largest lookup side that is broadcast
    """

    as_of_year: int | None = None
    random: str = "uniform"
    seed: int | None = None
    hash_bits: int = 512
    salt_by: str = "key"
    compat: bool = False
    patient_column: str = "patientid"
    gender_column: str = "gender"
    on_bad_key: str = "error"
    on_bad_date: str = "null"
    on_missing: str = "error"
    ethnicity_default: str = "White"
    keep_derived: bool = False
    key_derivation: str = "distinct"
    key_dictionary: KeyDictionary | None = None
    cities: DataFrame | None = None
    city_zip_column: str | None = None
    given_names: Mapping[str, Sequence[str]] = field(default_factory=default_given_names)
    broadcast_bytes: int = 64 << 20

    def __post_init__(self):
        allowed = {
            "random": ("uniform", "keyed"),
            "hash_bits": (256, 512),
            "salt_by": ("key", "column"),
            "on_bad_key": ("error", "hash"),
            "on_bad_date": ("error", "null"),
            "on_missing": ("error", "warn"),
            "key_derivation": ("distinct", "inline", "state"),
        }
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {values}")
        for gender in ("female", "male"):
            if not self.given_names.get(gender):
                raise ValueError(f"given_names lacks {gender!r} names")

    @property
    def year(self) -> int:
        return self.as_of_year or datetime.date.today().year

    def salt_key(self, column: str, salt_key: str | None) -> str:
        if self.compat or self.salt_by == "column":
            return column
        return salt_key or column

    def draw_seed(self, label: str) -> int:
        """Seed of one column's draws, different for every label."""
        if self.seed is None:
            return secrets.randbits(62)
        return (self.seed << 32) ^ zlib.crc32(label.encode())
