"""Column expressions shared by the jobs.

All helpers return ``Column``s made of built-in functions, so they stay inside
whole-stage codegen and behave the same in batch and in micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType, StringType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp_non_negative(x) -> Column:
    """``CASE WHEN x < 0 THEN 0 ELSE x END``: negatives to 0, NULL stays NULL.

    ``greatest(x, 0)`` would turn NULL into 0, which the cleaning rule does not.
    """
    x = _c(x)
    return F.when(x < 0, F.lit(0)).otherwise(x)


#: Text of a decimal number whose DOUBLE rounds to the same whole number.
FEW_DIGITS = r"\A-?[0-9]{1,9}[.][0-9]{1,6}\z"


def to_long_rounded(x, source: DataType | None = None) -> Column:
    """Numeric/text → BIGINT rounding half away from zero (``'3.7'`` → 4).

    Junk text and overflow give NULL instead of failing the load.  The value
    goes through DECIMAL, which holds every BIGINT exactly (a double does not
    beyond 2**53).  A known ``source`` type takes a shorter way to the same value:
    whole numbers are kept, doubles are split at their point (exact), text of plain
    digits is read as it is, and text of few digits with a point (``'12.0'``) is read as
    a DOUBLE, which is nearer to it than the closest half is.
    """
    x = _c(x)
    if isinstance(source, IntegralType):
        return x.cast("bigint")
    by_decimal = F.round(x.try_cast("decimal(38,18)")).try_cast("bigint")
    if isinstance(source, FractionalType) and not isinstance(source, DecimalType):
        size = F.abs(x)
        below = F.floor(size)
        whole = below + (size - below >= 0.5).cast("bigint")
        return F.when(size < 2.0 ** 52, F.when(x < 0, -whole).otherwise(whole)).otherwise(by_decimal)
    if isinstance(source, StringType):
        nearest = F.floor(F.abs(x.try_cast("double")) + 0.5)
        return F.when(x.rlike(FEW_DIGITS), F.when(x.startswith("-"), -nearest).otherwise(nearest)).otherwise(
            F.coalesce(x.try_cast("bigint"), by_decimal))
    return by_decimal


def to_double(x) -> Column:
    """Numeric/text → DOUBLE; junk text gives NULL."""
    return _c(x).try_cast("double")


def concat_strict(*cols) -> Column:
    """``a || b``: NULL if any part is NULL (``concat_ws`` would skip NULLs)."""
    return F.concat(*[_c(c) for c in cols])


def ts_from_date_and_time(date_text, time_text_col) -> Column:
    """``(date || ' ' || time)::TIMESTAMP`` as TIMESTAMP_NTZ; NULL on junk."""
    return concat_strict(date_text, F.lit(" "), time_text_col).try_cast("timestamp_ntz")


def time_text(ts) -> Column:
    """``CAST(ts AS TIME)`` rendered as ``'HH:mm:ss'`` text."""
    return F.date_format(_c(ts), "HH:mm:ss")


def tz_offset_text() -> Column:
    """``TO_VARCHAR(CURRENT_TIMESTAMP(), 'TZHTZM')``: the session's offset, e.g. ``+0000``."""
    return F.date_format(F.current_timestamp(), "xx")


# Rounding to 2 places for presentation.  Spark rounds the shortest decimal
# text of a double half-up, other engines round the binary value, so an exact
# tie (2.675, stored as 2.67499999…) can land on different sides.  Nudging
# the value away from zero by more than its representation error —
# max(1e-9, |x|·1e-14), i.e. tens of ulps at any magnitude — moves ties off
# the boundary the same way everywhere: "half away from zero".  The SQL
# oracle uses the same form.
ROUND_NUDGE_ABS = 1e-9
ROUND_NUDGE_REL = 1e-14


def round_half_away(x, scale: int = 2) -> Column:
    x = _c(x)
    nudge = F.greatest(F.lit(ROUND_NUDGE_ABS), F.abs(x) * F.lit(ROUND_NUDGE_REL))
    # "+ 0.0" maps a rounded -0.0 to 0.0 (IEEE), so no engine prints "-0.0"
    return F.round(x + F.signum(x) * nudge, scale) + F.lit(0.0)


# Money sums are accumulated exactly in DECIMAL and returned as DOUBLE: a
# DOUBLE sum depends on the order rows meet in each task, which changes with
# the cluster's partitioning, and ~1% of money sums sit exactly on a
# rounding boundary.  The partial/final hash aggregate is kept (no measured
# cost at sf0.1).
EXACT_SUM_TYPE = "decimal(38,8)"


def exact_sum(x) -> Column:
    """Exact sum of all values.  Values that the decimal cannot hold (NaN, infinite, 1e30 and
    beyond) are summed beside it as DOUBLE and added, so that none is left out of a total."""
    x = _c(x)
    exact = x.try_cast(EXACT_SUM_TYPE)
    rest = F.sum(F.when(exact.isNull(), x.cast("double")))
    total = F.sum(exact).cast("double")
    return F.when(rest.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + rest)


def file_base_name(path) -> Column:
    """Last path segment of a path or URL (query string and fragment removed)."""
    p = F.regexp_replace(_c(path), r"[?#].*$", "")
    return F.regexp_extract(p, r"([^/]*)/?$", 1)


def file_extension(name) -> Column:
    """Lower-cased extension with the dot (``'.json'``), ``''`` when none.

    Same rule as ``os.path.splitext`` on a base name: leading dots are part
    of the stem (``'.env'`` has none), else everything from the last dot.
    """
    stem = F.regexp_replace(_c(name), r"^\.+", "")
    return F.lower(F.regexp_extract(stem, r"(\.[^.]*)$", 1))


def file_identity(*parts) -> Column:
    """Deterministic id of a landed file: md5 of its identifying parts.

    Each part is written with its length, and NULL as a mark of its own, so that
    different parts never give one text."""
    marked = []
    for p in parts:
        s = _c(p).cast("string")
        marked.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("~")))
    return F.md5(F.concat_ws("|", *marked))


def file_path_id(host, path) -> Column:
    """Id of a file by where it lies: md5 of host and path together; NULL if either is."""
    return F.md5(F.concat(_c(host), _c(path)))
