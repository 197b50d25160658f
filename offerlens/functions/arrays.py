"""Array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import entry_key, lookup


def size_or(arr: Column, default: int) -> Column:
    """Length of an array; ``default`` for NULL."""
    return F.coalesce(F.array_size(arr), F.lit(default))


def array_lookup(
    arr: Column, mapping: dict[str, str], key: Callable[[Column], Column] = entry_key
) -> Column:
    """Canonical names of the known elements, in order of first appearance.

    For dictionaries small enough to travel in the plan; see
    ``operators.lookup.canonical_items`` for any size.
    """
    keys = F.transform(arr, key)
    found = F.transform(keys, lambda k: lookup(mapping, k))
    return F.array_distinct(F.filter(found, lambda name: name.isNotNull()))
