"""Table operators: masking, lookups, joins, audits and generators."""
