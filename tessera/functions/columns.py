"""Native column expressions.

Every function here returns a ``Column`` built from Spark's own expressions,
so it stays inside whole-stage codegen and lets filters pass below it. None of
them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.session import quoted

# --- fixed values (must equal the reference's for identical results) -------
# Text that counts as "missing" for a target / join attribute.
NA_SENTINELS: tuple[str, ...] = ("NA",)
# Text that the categorical clean-up turns into the fill value.
UNKNOWN_SENTINELS: tuple[str, ...] = ("Unknow", "None", "", " ")
UNKNOWN_FILL = "unknown"
# Day parts of an HHMM clock value: (label, lower bound incl., upper bound excl.);
# the last interval includes 2400. Out of range gives "" and NULL stays NULL.
DAY_PARTS: tuple[tuple[str, int, int], ...] = (
    ("lateNight", 0, 500),
    ("earlyMorning", 500, 800),
    ("lateMorning", 800, 1200),
    ("earlyAfternoon", 1200, 1400),
    ("lateAfternoon", 1400, 1700),
    ("earlyEvening", 1700, 1900),
    ("lateEvening", 1900, 2100),
    ("earlyNight", 2100, 2400),
)
DAY_PART_OUT_OF_RANGE = ""
DEFAULT_DATE_FORMAT = "M/d/y"
# ---------------------------------------------------------------------------

# Text that the legacy (non-ANSI) string -> int cast accepts: optional sign,
# digits with an optional fraction, or a bare fraction. Exponents, NaN,
# Infinity and words give NULL.
_NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def _col(c: str | Column) -> Column:
    return quoted(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Text -> int the way a non-ANSI cast does it, without ever throwing.

    ``"5.0"`` -> 5, ``"-3.7"`` -> -3 (truncation), ``" 7 "`` -> 7, ``"NA"`` /
    ``"1e3"`` / overflow -> NULL. Plain ``cast`` throws under ANSI and a bare
    ``try_cast("int")`` rejects ``"5.0"``, hence the two-step cast.
    """
    c = _col(c)
    return (
        F.when(F.trim(c.cast("string")).rlike(_NUMERIC_TEXT), c.cast("string"))
        .try_cast("double")
        .try_cast("int")
    )


def to_int_typed(c: str | Column, dtype: str) -> Column:
    """``to_int`` for string columns, a non-throwing int cast for numeric ones."""
    c = _col(c)
    if dtype == "string":
        return to_int(c)
    return c.try_cast("int")


def not_missing(c: str | Column, sentinels: Iterable[str] = NA_SENTINELS) -> Column:
    """``c IS NOT NULL AND c NOT IN sentinels`` (a NULL row is dropped)."""
    c = _col(c)
    sentinels = tuple(sentinels)
    if not sentinels:
        return c.isNotNull()
    return c.isNotNull() & ~c.isin(*sentinels)


def sentinel_to_null(c: str | Column, sentinels: Iterable[str] = NA_SENTINELS) -> Column:
    """Sentinel text -> NULL, anything else unchanged."""
    c = _col(c)
    return F.when(~c.isin(*tuple(sentinels)), c)


def null_to_unknown(
    c: str | Column,
    sentinels: Iterable[str] = UNKNOWN_SENTINELS,
    fill: str = UNKNOWN_FILL,
) -> Column:
    """NULL or one of the sentinels -> ``fill``; other text unchanged."""
    c = _col(c)
    return F.when(c.isNull() | c.isin(*tuple(sentinels)), F.lit(fill)).otherwise(c)


def day_part(c: str | Column) -> Column:
    """HHMM int -> one of eight day-part labels; NULL stays NULL."""
    c = _col(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    last = len(DAY_PARTS) - 1
    for i, (label, lo, hi) in enumerate(DAY_PARTS):
        upper = (c <= hi) if i == last else (c < hi)
        expr = expr.when((c >= lo) & upper, F.lit(label))
    return expr.otherwise(F.lit(DAY_PART_OUT_OF_RANGE))


def parse_date(c: str | Column, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """Text -> date with ``fmt``; unparsable text -> NULL instead of an error."""
    return F.try_to_date(_col(c).cast("string"), fmt)


def entity_age(year: str | Column, date_text: str | Column, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """``year - year(parse_date(date_text))`` clamped below at 0; NULL stays NULL."""
    age = _col(year).try_cast("int") - F.year(parse_date(date_text, fmt))
    return F.when(age < 0, F.lit(0)).otherwise(age)


def hash_bucket(keys: Sequence[str | Column], seed: int, buckets: int = 1000) -> Column:
    """Deterministic bucket in ``[0, buckets)`` from md5 of the key text and a seed.

    Independent of partitioning and of row order, so a split or a fold that uses
    it is reproduced exactly when a lost task is recomputed. A NULL key part is
    a value of its own.
    """
    if not keys:
        raise ValueError("a hash bucket needs at least one key column")
    parts = [F.coalesce(_col(k).cast("string"), F.lit("\u0000")) for k in keys] + [F.lit(str(seed))]
    digest = F.md5(F.concat_ws("#", *parts))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))
