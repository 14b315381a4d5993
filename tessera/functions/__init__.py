"""Column-level functions (all native Spark expressions)."""

from tessera.functions.columns import (
    DAY_PARTS,
    NA_SENTINELS,
    UNKNOWN_FILL,
    UNKNOWN_SENTINELS,
    day_part,
    entity_age,
    hash_bucket,
    not_missing,
    null_to_unknown,
    parse_date,
    sentinel_to_null,
    to_int,
    to_int_typed,
)

__all__ = [
    "DAY_PARTS",
    "NA_SENTINELS",
    "UNKNOWN_FILL",
    "UNKNOWN_SENTINELS",
    "day_part",
    "entity_age",
    "hash_bucket",
    "not_missing",
    "null_to_unknown",
    "parse_date",
    "sentinel_to_null",
    "to_int",
    "to_int_typed",
]
