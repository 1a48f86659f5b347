"""Column-expression helpers: everything here stays inside the JVM (codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_key(c: str | Column) -> Column:
    """Keys are compared as text; null stays null (the cast keeps it)."""
    return _c(c).cast("string")


def normalise_numeric_key(c: str | Column) -> Column:
    """All-digit keys without leading zeros ('00040' -> '40', '000' -> '0');
    other keys only trimmed.  For sources that disagree on zero padding
    (one read as integers, one as text); off unless asked for."""
    s = F.trim(_c(c).cast("string"))
    return F.when(s.rlike(r"^[0-9]+$"), F.regexp_replace(s, r"^0+(?=[0-9])", "")).otherwise(s)


def parse_yyyymmdd(c: str | Column) -> Column:
    """Dates given as integer-like YYYYMMDD text (or ISO yyyy-MM-dd).

    Anything else becomes null; never raises under ANSI mode. Years beyond
    2262 are kept (DateType covers them).
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(F.try_to_date(s, "yyyyMMdd"), F.try_to_date(s, "yyyy-MM-dd"))


def money(c: str | Column, scale: int = 4) -> Column:
    """Money kept as an exact decimal so sums do not depend on order."""
    return _c(c).cast(f"decimal(18,{scale})")


def zero_if_null_sum(c: str | Column) -> Column:
    """Sum where an all-null group gives 0, not null."""
    return F.coalesce(F.sum(_c(c)), F.lit(0).cast("decimal(1,0)"))


def pair_complete(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """Both values only where both are present (pairwise-complete rows)."""
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    both = xc.isNotNull() & yc.isNotNull()
    return F.when(both, xc), F.when(both, yc)


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over pairwise-complete rows; null (not an error)
    when either side is constant."""
    xp, yp = pair_complete(x, y)
    return F.try_divide(F.covar_samp(xp, yp), F.stddev_samp(xp) * F.stddev_samp(yp))


def round_exact(c: str | Column, digits: int = 2, via_scale: int = 6) -> Column:
    """Round half-up on the decimal value: the double is first fixed to
    ``via_scale`` decimals, so binary representation error cannot move a
    value across a rounding boundary.  Returns double."""
    return F.round(_c(c).cast(f"decimal(38,{via_scale})"), digits).cast("double")
