"""Exact distinct counts over any period: bitmaps of numbered ids that are merged, where counts could not be added.

A table of bitmaps has one row for each group (say, month and technology) and bucket of 32,768 ids, with one bit for
each id. The union of any groups is a bitwise or, so any period is answered from this table alone, without the ids.
Ids are numbered in the order of a column such as their first month, so a group's ids lie in few buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import materialize


def numbered(df: DataFrame, key: str, order: Column, known: DataFrame | None = None) -> DataFrame:
    """Rows (key, numero): a number for each non-null key of ``df``, by the smallest ``order`` of its rows.

    Keys in ``known``, an earlier result, keep their number, and new ones come after them all. Numbers have gaps
    between the tasks that gave them, which cost nothing. The result is written once.
    """
    ids = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_o"))
    base = F.lit(0)
    if known is not None:
        ids = ids.join(known.select(key), key, "left_anti")
        base = F.lit((known.agg(F.max("numero")).first()[0] or 0) + 1)
    placed = ids.repartitionByRange("_o", key).sortWithinPartitions("_o", key)
    new = placed.select(key, (F.monotonically_increasing_id() + base).cast("long").alias("numero"))
    return materialize(new if known is None else known.unionByName(new))


def id_bitmaps(df: DataFrame, number: str, *keys: str) -> DataFrame:
    """Rows (keys, cubo, mapa): the numbers of each group as bits. Repeated rows set a bit once, null numbers none;
    tasks merge what they have before it is shuffled."""
    rows = df.filter(F.col(number).isNotNull())
    return rows.groupBy(*keys, F.bitmap_bucket_number(number).alias("cubo")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("mapa")
    )


def merged(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """The bitmaps of coarser groups: the union of their rows for each bucket."""
    return bitmaps.groupBy(*keys, "cubo").agg(F.bitmap_or_agg("mapa").alias("mapa"))


def distinct_ids(bitmaps: DataFrame, *keys: str, out: str = "num_ofertas") -> DataFrame:
    """Rows (keys, out): how many different ids the rows of each group have, equal to a distinct count of them."""
    found = merged(bitmaps, *keys)
    return found.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("mapa")), F.lit(0)).cast("long").alias(out))
