"""Numeric guards and score tiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Score tiers (lower edges) and the share of rows they stand for.
ACCOUNT_TIERS = [("Critical", 0.8), ("High", 0.6), ("Medium", 0.3)]
EVENT_TIERS = [("Critical", 0.6), ("High", 0.4), ("Medium", 0.2)]
Z_TIERS = [("critical", 8.0), ("high", 5.0), ("medium", 3.0)]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value on either side; NULL stays NULL (``least`` alone would turn it into the bound)."""
    base = out = _col(c)
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(base.isNotNull(), out)


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def filter_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def tier(c: str | Column, cuts: Sequence[tuple[str, float]] = ACCOUNT_TIERS, lowest: str = "Low") -> Column:
    """Name of the highest tier whose lower edge the value reaches; the edge itself is inside."""
    out = F.lit(lowest)
    for name, edge in reversed(list(cuts)):
        out = F.when(_col(c) >= edge, F.lit(name)).otherwise(out)
    return out


def tier_right(c: str | Column) -> Column:
    """Right-closed bins: a score of exactly 0.3 is still Low."""
    v = _col(c)
    return (F.when(v <= 0.3, "Low").when(v <= 0.6, "Medium").when(v <= 0.8, "High").when(v <= 1.0, "Critical"))


def tier_z(c: str | Column) -> Column:
    return tier(c, Z_TIERS, "low")
