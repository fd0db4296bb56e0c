"""What tests share beside the fixtures."""

import json

from maskflow import parse_table_policy

AS_OF = 2088


def make_policy(columns):
    """Policy from {column: type or [type or strategy object, ...]}."""
    document = {}
    for name, chain in columns.items():
        chain = chain if isinstance(chain, list) else [chain]
        document[name] = {
            "strategy": [{"type": item} if isinstance(item, str) else item for item in chain]
        }
    return parse_table_policy(json.dumps(document))
