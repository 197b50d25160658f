"""Lookups in dictionaries, whose size is measured before they are sent to every task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import array_lookup
from ..functions.text import term_key

MAX_INLINE_ENTRIES = 5_000
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.001


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Count rows and bytes of ``df`` (one distributed aggregate) against the limits."""
    width = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.AtomicType) and not isinstance(field.dataType, T.StringType):
            width = width + F.lit(8)
        else:
            width = width + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return found.n <= max_rows and found.b <= max_bytes


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, with ``_hot``, the partitions to spread them
    over: one per ``share`` held. At most ``1 / share`` such keys can exist."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    part = F.lit(share) * counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") > part).select(
        key, F.ceil(F.col("_n") / part).cast("bigint").alias("_hot")
    )


def lookup_join(
    rows: DataFrame,
    dictionary: DataFrame,
    key: str,
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join (inner or left) of many rows to a dictionary sharing the column ``key``.

    A dictionary within the limits is broadcast and the rows stay where they
    are. A larger one is shuffled; rows of a hot key are then spread over partitions in
    proportion to its share of all rows, and only the hot entries are copied to all of
    theirs. Rows without a key are spread freely.
    """
    if fits_broadcast(dictionary, max_rows):
        return rows.join(F.broadcast(dictionary), key, how)
    others = [
        c.name
        for c in rows.schema.fields
        if c.name != key and not isinstance(c.dataType, (T.MapType, T.VariantType))
    ]
    hot = F.broadcast(hot_keys(rows, key))
    # the partition spreads rows that are equal in every column too, and is the same when a task is run again
    spread = F.xxhash64(*others, F.spark_partition_id())
    salt = (
        F.when(F.col(key).isNull(), spread)  # matches nothing, so it may go anywhere
        .when(F.col("_hot").isNotNull(), F.pmod(spread, F.col("_hot")))
        .otherwise(F.lit(0))
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_hot", F.lit(1).cast("bigint")) - 1)
    copies = every
    salted_rows = rows.join(hot, key, "left").withColumn("_salt", salt.cast("bigint"))
    salted_entries = dictionary.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return (
        salted_rows.drop("_hot").join(salted_entries.drop("_hot"), [key, "_salt"], how).drop("_salt")
    )


def array_lookup_join(
    df: DataFrame,
    items: str,
    catalog: DataFrame,
    out: str,
    key: Callable[[Column], Column] = term_key,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Add ``out``: canonical names of the array's known elements, in order of first appearance.

    For catalogues of any size; equal rows stay separate rows. The rows are numbered and
    written once, then only numbers and terms move, and known names come back by number.
    A repeated variant gives all its names. NULL arrays stay NULL, arrays without a known
    element become empty.
    """
    from .tables import materialize  # which uses this module

    columns = df.columns
    entries = catalog.select(
        F.col("variante").alias("_key"), F.col("nombre_canonico").alias("_name")
    ).dropna().distinct()
    numbered = materialize(df.withColumn("_row", F.monotonically_increasing_id()))
    terms = numbered.select("_row", F.posexplode(items).alias("_pos", "_item"))
    known = lookup_join(terms.withColumn("_key", key(F.col("_item"))), entries, "_key", "inner", max_rows)
    hits = known.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", "_name"))).alias("_hits"))
    names = F.array_distinct(F.transform("_hits", lambda h: h["_name"]))
    found = numbered.join(hits, "_row", "left")
    none = F.array().cast("array<string>")
    return found.select(
        *columns, F.when(F.col(items).isNotNull(), F.coalesce(names, none)).alias(out)
    )


def inline_entries(catalog: DataFrame, max_entries: int = MAX_INLINE_ENTRIES) -> dict[str, str] | None:
    """The catalogue as a dictionary; None when it is too large or a variant repeats."""
    rows = catalog.select("variante", "nombre_canonico").limit(max_entries + 1).collect()
    entries = {r.variante: r.nombre_canonico for r in rows}
    return entries if len(rows) <= max_entries and len(entries) == len(rows) else None


def canonical_items(
    df: DataFrame,
    items: str,
    catalog: DataFrame | dict[str, str],
    out: str,
    key: Callable[[Column], Column] = term_key,
    max_entries: int = MAX_INLINE_ENTRIES,
) -> DataFrame:
    """Add ``out`` as in ``array_lookup_join``, row by row when the catalogue allows it.

    A catalogue of up to ``max_entries`` travels in the plan, so no row is copied
    or moved; a larger one is joined.
    """
    entries = catalog if isinstance(catalog, dict) else inline_entries(catalog, max_entries)
    if entries is None:
        return array_lookup_join(df, items, catalog, out, key)
    named = {k: v for k, v in entries.items() if k is not None and v is not None}
    return df.withColumn(out, array_lookup(F.col(items), named, key))


def matched(left: DataFrame, right: DataFrame, key: str, flag: str) -> DataFrame:
    """Keep every left row and say whether its key occurs on the right."""
    present = right.select(key).distinct().withColumn(flag, F.lit(True))
    return left.join(present, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
