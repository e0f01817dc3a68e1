"""Array and map column expressions: vector algebra, lookups with fallback."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def add(a: Column, b: Column) -> Column:
    """Element-wise sum; the shorter vector is padded with zero."""
    return F.zip_with(a, b, lambda x, y: F.coalesce(x, F.lit(0.0)).cast("double") + F.coalesce(y, F.lit(0.0)).cast("double"))


def scale(a: Column, k: float) -> Column:
    return F.transform(a, lambda x: x.cast("double") * k)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))


def merge_maps(first: Column, second: Column) -> Column:
    """Union of two maps; the second wins where both hold a key."""
    kept = F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k))
    return F.map_concat(kept, second)


def lookup(key: Column, *maps: Column, default=None) -> Column:
    """Value from the first map that holds the key."""
    found = [F.try_element_at(m, key) for m in maps]
    return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)
