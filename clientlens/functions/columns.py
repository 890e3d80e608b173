"""Column -> Column building blocks.

Every function here returns a native Catalyst expression, so it stays inside
whole-stage codegen; the reference's Python UDFs (age groups, 5-year bands)
are re-expressed as ``when`` chains and arithmetic.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientlens.schema import MONTH_QUARTER, MONTHS, PDAYS_NEVER, UNKNOWN_MONTH_ORDINAL


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def month_name(ts: str | Column) -> Column:
    """Lower-case English month abbreviation of a date/timestamp (``jan``)."""
    return F.lower(F.date_format(_col(ts), "MMM"))


def quarter_of(month: str | Column) -> Column:
    """Month name -> ``Q1``..``Q4`` through a map literal; unmapped -> NULL."""
    return _literal_map(MONTH_QUARTER)[_col(month)]


def month_ordinal(month: str | Column, unknown: int | None = UNKNOWN_MONTH_ORDINAL) -> Column:
    """Month name -> 1..12. Unknown names give ``unknown`` (99 like the
    map/reduce jobs), or NULL like the SQL ``CASE`` when ``unknown=None``."""
    ordinal = _literal_map({m: i + 1 for i, m in enumerate(MONTHS)})[_col(month)]
    return ordinal if unknown is None else F.coalesce(ordinal, F.lit(unknown))


# Age-group edges and labels.
AGE_YOUNG_BELOW = 30
AGE_SENIOR_ABOVE = 60


def age_group(age: str | Column) -> Column:
    """NULL -> ``unknown``, below 30 -> ``<30``, 30..60 inclusive -> ``30-60``,
    above -> ``>60``."""
    a = _col(age)
    return (F.when(a.isNull(), "unknown").when(a < AGE_YOUNG_BELOW, "<30")
            .when(a <= AGE_SENIOR_ABOVE, "30-60").otherwise(">60"))


def _floor_to(a: Column, width: int) -> Column:
    # floor division like Python's ``//`` (also for negatives), as BIGINT
    return (F.floor(a / width) * width).cast("bigint")


def band5(age: str | Column, width: int = 5) -> Column:
    """Fixed-width band label ``"30-34"``; NULL -> ``unknown``."""
    a = _col(age)
    lower = _floor_to(a, width)
    return F.when(a.isNull(), "unknown").otherwise(
        F.concat(lower.cast("string"), F.lit("-"), (lower + (width - 1)).cast("string")))


def decade(age: str | Column) -> Column:
    """Decade label ``"30s"`` (NULL stays NULL)."""
    return F.concat(_floor_to(_col(age), 10).cast("string"), F.lit("s"))


def parse_int(text: str | Column) -> Column:
    """Python ``int(x)`` on a trimmed string: ``"12.5"`` and ``"abc"`` -> NULL."""
    return _try_cast(F.trim(_col(text)), "int")


def parse_double(text: str | Column) -> Column:
    """Python ``float(x)`` on a trimmed string; unparsable -> NULL (no ANSI error)."""
    return _try_cast(F.trim(_col(text)), "double")


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def replace_sentinel(c: str | Column, sentinel=PDAYS_NEVER, value=0) -> Column:
    """``sentinel`` -> ``value``; keeps the column type."""
    x = _col(c)
    return F.when(x == sentinel, F.lit(value)).otherwise(x)


def exact_sum(units: Column) -> Column:
    """Sum of BIGINTs as DECIMAL(38,0), without overflow for 2^39 rows of any
    size: three parts of up to 24 bits are summed as BIGINT."""
    part = F.lit((1 << 20) - 1).cast("bigint")
    low, mid, high = units.bitwiseAND(part), F.shiftright(units, 20).bitwiseAND(part), F.shiftright(units, 40)
    wide = [F.sum(x).cast("decimal(20,0)") for x in (low, mid, high)]
    total = wide[0] + wide[1] * F.lit(1 << 20).cast("decimal(8,0)") + wide[2] * F.lit(1 << 40).cast("decimal(14,0)")
    return total.cast("decimal(38,0)")


def rounded_ratio(total: Column, count: Column, scale: int, digits: int) -> Column:
    """``total / 10^scale / count`` as DOUBLE, rounded half away from zero to
    ``digits`` decimals by integer arithmetic; NULL for a zero count."""
    if digits < scale:
        raise ValueError("digits must be >= scale")
    t = total.cast("decimal(38,0)") * F.lit(10 ** (digits - scale)).cast("decimal(10,0)")
    n = F.when(count > 0, count).cast("decimal(20,0)")
    above = F.abs(t) * F.lit(2).cast("decimal(1,0)") + n
    twice = n * F.lit(2).cast("decimal(1,0)")
    units = ((above - above % twice).cast("decimal(38,0)") / twice).cast("double")
    return F.signum(t) * F.round(units, 0) / F.lit(float(10 ** digits))


def fixed_point_mean(c: str | Column, scale: int = 2, digits: int = 2) -> Column:
    """Mean of a column whose values carry ``scale`` decimals (money in
    cents, integer counts with ``scale=0``), rounded half away from zero to
    ``digits`` decimals (``digits >= scale``).

    The values are summed exactly as integers and the mean is rounded by
    integer arithmetic, so the result is the same bit pattern whatever order
    rows are added in: any partition layout, any engine. A float mean differs
    in its last bits with the summation order, and a decimal tie such as
    27.72125 is not representable in binary, so two engines can round it
    differently.
    """
    units = F.round(_col(c) * F.lit(float(10 ** scale))).cast("bigint")
    return rounded_ratio(exact_sum(units), F.count(units), scale, digits)


def percent(part: str | Column, whole: str | Column, digits: int | None = 2) -> Column:
    """``part * 100 / whole`` in DOUBLE, rounded half away from zero to
    ``digits``; NULL when ``whole`` is 0.

    For counts the rounding is exact: the percentage is computed in units of
    ``10^-digits`` (``part * 10^(digits+2) / whole``), where a decimal tie
    such as 1.005 % becomes the exact binary value 100.5. It is therefore
    rounded the same way in every engine, whereas ``round(1.005, 2)`` on a
    double depends on the engine's rounding of a value binary cannot hold.
    """
    w = _col(whole).cast("double")
    if digits is None:
        return F.try_divide(_col(part).cast("double") * 100.0, w)
    units = F.try_divide(_col(part).cast("double") * F.lit(float(10 ** (digits + 2))), w)
    return F.round(units, 0) / F.lit(float(10 ** digits))


def joined(sep: str, *cols: str | Column) -> Column:
    """Join strings with a separator, skipping NULLs."""
    return F.concat_ws(sep, *[_col(c) for c in cols])


def upper(c: str | Column) -> Column:
    return F.upper(_col(c))


def with_event_time(c: str | Column = "event_time", ntz: bool = False) -> Column:
    """Default a missing event time to processing time (``ntz`` for a
    TIMESTAMP_NTZ column: the session-local wall clock)."""
    return F.coalesce(_col(c), F.localtimestamp() if ntz else F.current_timestamp())


def winsorized(c: str | Column, lo: Column, hi: Column) -> Column:
    """Clip to [lo, hi] as DOUBLE; NULL stays NULL."""
    x = _col(c).cast("double")
    return F.when(x < lo, lo).when(x > hi, hi).otherwise(x)
