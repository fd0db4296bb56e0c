"""Masking of sensitive columns in Spark tables, driven by JSON policies."""

from maskflow.operators.masking import deidentify, policy_coverage
from maskflow.plans.options import MaskOptions
from maskflow.plans.policy import (
    Strategy,
    TablePolicy,
    load_policies,
    match_policy,
    parse_policies,
    parse_table_policy,
)
from maskflow.plans.salts import Salts

__all__ = [
    "MaskOptions",
    "Salts",
    "Strategy",
    "TablePolicy",
    "deidentify",
    "load_policies",
    "match_policy",
    "parse_policies",
    "parse_table_policy",
    "policy_coverage",
]
