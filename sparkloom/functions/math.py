"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def discounted(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return F.col(price) * (1 - F.col(discount))


def charge(price: str = "l_extendedprice", discount: str = "l_discount", tax: str = "l_tax") -> Column:
    return discounted(price, discount) * (1 + F.col(tax))


def offensive_efficiency(made: Column, assists: Column, tried: Column, rebounds: Column, lost: Column) -> Column:
    """Plays that scored or helped to, per play used; null where none was used."""
    return F.try_divide(made + assists, tried - rebounds + assists + lost)


def order_total(amount: Column, discount: Column, tax: Column, shipping: Column) -> Column:
    return amount - discount + tax + F.coalesce(shipping, F.lit(0))


def z_score(value: Column, mean: Column, std: Column) -> Column:
    return F.try_divide(value - mean, std)


def min_max(value: Column, low: Column, high: Column) -> Column:
    return F.try_divide(value - low, high - low)


def clip(value: Column, low, high) -> Column:
    """Bound a value; nulls stay null."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))
