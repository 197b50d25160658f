"""One row per key. Every ranking ends in a total order, so a recomputed task picks the same row.

``row_number() = 1`` is planned with a group limit in front of the shuffle: each
task sends at most one row per key, so a key that holds a large share of all
rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import size_or
from ..functions.dates import month_start, year_month
from ..functions.text import surrogate_key


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _top_row(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by)).filter("_rank = 1").drop("_rank")


def _rest(df: DataFrame, known: set[str]) -> list[Column]:
    return [
        F.col(f.name).desc_nulls_last()
        for f in df.schema.fields
        if f.name not in known and _sortable(f.dataType)
    ]


def latest_by(
    df: DataFrame,
    keys: list[str],
    order_by: list[Column],
    tie_break: list[Column] | None = None,
    ordered: tuple[str, ...] = (),
) -> DataFrame:
    """First row of each key in ``order_by``; remaining ties fall to the other columns.

    ``ordered`` names columns that ``order_by`` already decides, so they are not sorted again.
    """
    ties = _rest(df, {*keys, *ordered}) if tie_break is None else tie_break
    return _top_row(df, list(keys), [*order_by, *ties])


def first_per_key(df: DataFrame, key: str, order_by: list[Column]) -> DataFrame:
    """First occurrence of each non-null key in a stated order."""
    return latest_by(df.filter(F.col(key).isNotNull()), [key], order_by)


def repost_key(title: Column, company: Column, date: Column, row_id: Column) -> Column:
    """Title, company and month when both texts are known, else the row's own id."""
    month = F.coalesce(year_month(month_start(date)), F.lit(""))
    known = title.isNotNull() & company.isNotNull()
    return F.when(known, surrogate_key(F.lower(title), F.lower(company), month)).otherwise(row_id)


def repost_dedup(
    df: DataFrame, title: str, company: str, date: str, row_id: str, items: str
) -> DataFrame:
    """One row per re-posted advert: longest list, then latest date, then lowest id."""
    key = repost_key(F.col(title), F.col(company), F.col(date), F.col(row_id))
    order = [
        size_or(F.col(items), -1).desc(),
        F.col(date).desc_nulls_last(),
        F.col(row_id).asc(),
    ]
    return _top_row(df, [key], order)
