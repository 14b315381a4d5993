"""Row filters and column rewrites of the cleaning phase.

Each rewrite of many columns is a single ``withColumns`` (one projection in
the plan, not one per column), and every predicate is a native expression, so
Catalyst can push it into the scan or below a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import (
    NA_SENTINELS,
    UNKNOWN_FILL,
    UNKNOWN_SENTINELS,
    day_part,
    not_missing,
    to_int_typed,
)
from tessera.functions.columns import null_to_unknown as _null_to_unknown
from tessera.functions.columns import sentinel_to_null as _sentinel_to_null
from tessera.session import quoted


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """``cols`` that are columns of ``df`` (case-insensitive, frame spelling)."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for c in cols:
        hit = by_lower.get(c.lower())
        if hit is not None and hit not in out:
            out.append(hit)
    return out


def plain_names(df: DataFrame, cols: Iterable[str]) -> dict[str, str]:
    """Stand-in names for those of ``cols`` that ML stages would misread (they take a
    dot for a struct field)."""
    return {c: f"__plain_{i}" for i, c in enumerate(cols) if "." in c or "`" in c}


def _string_cols(df: DataFrame, cols: Iterable[str]) -> list[str]:
    types = dict(df.dtypes)
    return [c for c in present(df, cols) if types[c] == "string"]


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns by name; absent names are ignored, matching is case-insensitive."""
    return df.drop(*present(df, cols))


def require_columns(df: DataFrame, cols: Iterable[str], sentinels: Iterable[str] = ()) -> DataFrame:
    """Keep rows where every column is non-NULL and not one of ``sentinels``."""
    cond = None
    for c in present(df, cols):
        p = not_missing(c, sentinels)
        cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)


def drop_missing_target(df: DataFrame, target: str, sentinels: Iterable[str] = NA_SENTINELS) -> DataFrame:
    """Drop rows whose target is NULL or a sentinel."""
    if not present(df, [target]):
        raise ValueError(f"target column {target!r} not in frame")
    return require_columns(df, [target], sentinels)


def filter_flag(df: DataFrame, col: str, value: int = 0) -> DataFrame:
    """Keep rows whose flag, read as an int like a legacy cast would, equals ``value``.

    ``"0"``, ``"0.00"`` and ``"0.4"`` all match 0; text and NULL are dropped.
    """
    (c,) = present(df, [col]) or [None]
    if c is None:
        return df
    return df.filter(to_int_typed(c, dict(df.dtypes)[c]) == F.lit(value))


def filter_upper(df: DataFrame, bounds: Mapping[str, float]) -> DataFrame:
    """Keep rows with ``col <= bound`` for every given column (NULL is dropped)."""
    cond = None
    for name, bound in bounds.items():
        for c in present(df, [name]):
            p = quoted(c) <= F.lit(bound)
            cond = p if cond is None else cond & p
    return df if cond is None else df.filter(cond)


def cast_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Cast columns to int; bad text -> NULL (never an ANSI error)."""
    types = dict(df.dtypes)
    return df.withColumns({c: to_int_typed(c, types[c]) for c in present(df, cols)})


def sentinel_to_null(df: DataFrame, cols: Iterable[str], sentinels: Iterable[str] = NA_SENTINELS) -> DataFrame:
    """Turn sentinel text into NULL in the string columns among ``cols``."""
    s = tuple(sentinels)
    return df.withColumns({c: _sentinel_to_null(c, s) for c in _string_cols(df, cols)})


def null_to_unknown(
    df: DataFrame,
    cols: Iterable[str],
    sentinels: Iterable[str] = UNKNOWN_SENTINELS,
    fill: str = UNKNOWN_FILL,
) -> DataFrame:
    """NULL and placeholder text -> ``fill`` in the given (string) columns."""
    s = tuple(sentinels)
    cols = present(df, cols)
    return df.withColumns({c: _null_to_unknown(quoted(c).cast("string"), s, fill) for c in cols})


def day_parts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace HHMM clock columns by their day-part label."""
    return df.withColumns({c: day_part(c) for c in present(df, cols)})
