"""Typed reads from a VARIANT document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(document: Column, path: str, dtype: str, strict: bool = True) -> Column:
    """Value at ``path`` as ``dtype``; NULL where the path is absent or JSON null.

    ``int`` rounds a fractional number (2.7 becomes 3) instead of cutting it.
    A value of another type fails the query when ``strict``, else gives NULL.
    """
    get = F.variant_get if strict else F.try_variant_get
    if dtype == "int":
        rounded = F.round(get(document, path, "double"))
        return rounded.cast("int") if strict else rounded.try_cast("int")
    return get(document, path, dtype)
