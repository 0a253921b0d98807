"""Null and number rules of the original pandas code, as Spark columns.

* ``ne``      - pandas ``a != b``: true when either side is null (N1).
* ``truthy``  - pandas comparison used as a mask: null counts as false (N2).
* ``any_flag``- pandas ``any`` over a group: null-only groups are false (N5).
* ``money``   - money kept in DECIMAL, rounded half-up, DOUBLE only at the end (N8).
* ``ratio``   - division where x/0 gives null instead of an error (N9).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ne(a, b) -> Column:
    """pandas ``a != b``; null on either side counts as different."""
    return F.coalesce(col(a) != col(b), F.lit(True))


def truthy(cond: Column) -> Column:
    """A mask where null means False (pandas comparisons with NaN)."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """0/1 integer flag from a condition, null counting as 0."""
    return F.when(truthy(cond), F.lit(1)).otherwise(F.lit(0))


def any_flag(cond: Column) -> Column:
    """Group-level ``any``: false when the group holds only nulls."""
    return F.coalesce(F.bool_or(cond), F.lit(False))


def sum0(c) -> Column:
    """pandas group sum: all-null group gives 0."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def ratio(num, den) -> Column:
    """Double division with null for a zero or null divisor."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def dec(value: str, precision: int = 12, scale: int = 4) -> Column:
    """A decimal literal (money parameters are given as text)."""
    return F.lit(value).cast(f"decimal({precision},{scale})")


def round_ratio(c, digits: int) -> Column:
    """Round a DOUBLE ratio half-up: through DECIMAL(18,6), then DOUBLE."""
    return F.round(col(c).cast("decimal(18,6)"), digits).cast("double")


def money(c, digits: int = 2) -> Column:
    """Round a DECIMAL money value half-up and hand it out as DOUBLE."""
    return F.round(col(c), digits).cast("double")


def money_text(c, thousands: bool = True) -> Column:
    """``'{:,.2f}'`` (or ``'{:.2f}'``) of a money value; null stays null."""
    rounded = F.round(col(c).cast("decimal(38,6)"), 2)
    if thousands:
        return F.format_number(rounded, 2)
    return rounded.cast("decimal(38,2)").cast("string")


def parse_date(c) -> Column:
    """``to_datetime(errors='coerce')``: unparsable text becomes null."""
    return F.try_to_date(col(c).cast("string"))


def fresh_key(df: DataFrame, key: str) -> DataFrame:
    """The same rows under a computed text key, for the per-group side of a join
    with rows. AQE splits a hot key only where both join sides are shuffled for
    that join; an aggregate already lies by its key and would not be, but under
    a computed key its few rows are shuffled once more."""
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))
