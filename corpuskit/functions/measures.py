"""Money in DECIMAL: sums are exact, so row order and partitioning cannot change them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _col(c).cast("decimal(12,2)")


def rate(c: Column | str) -> Column:
    return _col(c).cast("decimal(4,2)")


def discounted(price: Column | str, discount: Column | str) -> Column:
    """price * (1 - discount)."""
    return money(price) * (F.lit(1).cast("decimal(4,2)") - rate(discount))


def charge(price: Column | str, discount: Column | str, tax: Column | str) -> Column:
    """price * (1 - discount) * (1 + tax)."""
    return discounted(price, discount) * (F.lit(1).cast("decimal(4,2)") + rate(tax))


def extended(total: Column | str) -> Column:
    """A finished decimal total, rounded half-up to cents, as double."""
    return F.round(_col(total), 2).cast("double")
