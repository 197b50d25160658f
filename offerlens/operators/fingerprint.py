"""Content fingerprint: independent of row order and layout, sensitive to every value.

A table that is partitioned on disk has a tree of them: a leaf for each partition, and the table's own from the leaves,
so a change is found by hashing the changed partitions alone."""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import materialize

_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _encode(field: T.StructField) -> Column:
    """Length-prefixed text of a value, so that no two rows share an encoding."""
    c = F.col(f"`{field.name}`")
    nested = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType))
    text = F.to_json(F.struct(c), _JSON) if nested else c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (n, h1, h2): row count and two sums of row-hash slices.

    Sums commute, so partial results combine anywhere; no sort, no row leaves
    its task. Sixty-bit slices cannot overflow 38 digits.
    """
    return _hashed(df).agg(*_sums())


def fingerprint_by(df: DataFrame, *by: str) -> DataFrame:
    """Leaves of a fingerprint tree: rows (by, n, h1, h2), one for each value of the columns ``by``."""
    return _hashed(df, *by).groupBy(*by).agg(*_sums())


def combined(leaves: DataFrame) -> DataFrame:
    """The row that ``fingerprint`` gives for the whole table, from its leaves."""
    part = lambda c: F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).cast("string").alias(c)
    return leaves.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), part("h1"), part("h2"))


def _hashed(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.md5(F.concat(*[_encode(f) for f in df.schema.fields])).alias("_h"))


def _sums() -> list[Column]:
    def part(start: int) -> Column:
        number = F.conv(F.substring("_h", start, 15), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("string")

    return [F.count(F.lit(1)).alias("n"), part(1).alias("h1"), part(17).alias("h2")]


def partition_files(stored: DataFrame, *by: str) -> DataFrame:
    """Rows (by, archivos): a signature of the files that a partition of a file table consists of.

    No data column is read. A file's name, size and time stand for its contents, as stored files are never
    written over in place.
    """
    file = F.struct("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    files = stored.select(*by, F.to_json(file, _JSON).alias("_f")).distinct()
    return files.groupBy(*by).agg(F.md5(F.array_join(F.sort_array(F.collect_list("_f")), "\n")).alias("archivos"))


def refreshed_leaves(stored: DataFrame, known: DataFrame | None, *by: str) -> tuple[DataFrame, list[tuple]]:
    """The leaves (by, archivos, n, h1, h2) of a table that is partitioned by the columns ``by``, and the partitions
    that had to be hashed.

    ``known`` are the leaves of an earlier state. Partitions whose files are the same keep their leaf; the others are
    hashed again, and the scan lists no more than these. Partitions that went away lose their leaf. Only the values
    of changed partitions come to the driver. The leaves are written once.
    """
    now = materialize(partition_files(stored, *by))
    if known is None:
        kept, changed = None, now.select(*by)
    else:
        same = reduce(and_, [F.col(f"now.{c}").eqNullSafe(F.col(f"old.{c}")) for c in (*by, "archivos")])
        kept = known.alias("old").join(now.alias("now"), same, "left_semi")
        changed = now.alias("now").join(known.alias("old"), same, "left_anti").select(*by)
    hashed = [tuple(r) for r in changed.orderBy(*by).collect()]
    of_one = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, values)]) for values in hashed]
    fresh = fingerprint_by(stored.filter(reduce(or_, of_one, F.lit(False))), *by)
    fresh = now.alias("now").join(
        fresh.alias("new"), reduce(and_, [F.col(f"now.{c}").eqNullSafe(F.col(f"new.{c}")) for c in by])
    ).select("now.*", "new.n", "new.h1", "new.h2")
    return materialize(fresh if kept is None else kept.unionByName(fresh)), hashed


def fingerprint_all(tables: dict[str, DataFrame]) -> str:
    """SHA-256 over the names and fingerprints of all tables (one small row per table)."""
    parts = [fingerprint(df).select(F.lit(name).alias("t"), "n", "h1", "h2") for name, df in tables.items()]
    rows = sorted(tuple(r) for r in reduce(DataFrame.unionAll, parts).collect())
    return hashlib.sha256("\n".join("|".join(map(str, r)) for r in rows).encode()).hexdigest()
