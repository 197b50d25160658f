"""Table lifecycle: additive schema changes, idempotent appends, work tables.

A table with a key is laid out by hash bucket of that key: the directories ``cubos`` (how many buckets the writer
used) and ``cubo`` (which one). A batch then reads the keys of the buckets it touches and of no other. Buckets of
another number stay readable, they are only not pruned; so the number may be changed at any time. A table without
this layout is read whole and stays as it is.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dedup import first_per_key
from .lookup import fits_broadcast


#: Partition columns of a table laid out by its key, and the number of buckets unless another is given.
LAYOUT = ("cubos", "cubo")
BUCKETS = 64


def ensure_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns ``df`` lacks, as typed NULLs; present columns stay as they are."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table at ``path`` under a fixed schema; empty when it does not exist yet.

    Files written before a column was added read it as NULL.
    """
    return with_layout(spark, path, schema).select(*schema.names)


def with_layout(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``read_table`` with the columns of its layout, if it has one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def bucket(key: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a key; NULL keys share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched(stored: DataFrame, keys: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows of ``stored`` that can hold one of ``keys``: partitions without any are not listed in the plan.

    At most ``buckets`` numbers come to the driver.
    """
    if LAYOUT[1] not in stored.columns:
        return stored
    used = [r[0] for r in keys.select(bucket(F.col(key), buckets)).distinct().collect()]
    count, number = (F.col(c) for c in LAYOUT)
    return stored.filter((count != buckets) | number.isin(used))


def append_new(
    existing: DataFrame, batch: DataFrame, key: str, order_by: list[Column], buckets: int = BUCKETS
) -> DataFrame:
    """Rows of ``batch`` whose key is new, first occurrence each; stored rows never change.

    The batch is evaluated once: its first occurrences are written and read from then
    on. Of a table laid out by the key, only the buckets of the batch are read. The usual
    batch is tiny next to them: its keys are then broadcast to filter the scan, and only
    keys that are already there move.
    """
    fresh = materialize(first_per_key(batch, key, order_by))
    keys = fresh.select(key)
    stored = touched(existing, keys, key, buckets).select(key)
    if fits_broadcast(keys):
        stored = stored.join(F.broadcast(keys), key, "left_semi")
    return fresh.join(stored.distinct(), key, "left_anti")


def is_flat(stored: DataFrame) -> bool:
    """Whether a table has rows but no layout."""
    return LAYOUT[1] not in stored.columns and not stored.isEmpty()


def append_rows(rows: DataFrame, path: str, key: str | None, buckets: int = BUCKETS) -> int:
    """Append to the table at ``path``, laid out by ``key``; without one, as they are. Returns how many rows.

    Adaptive execution joins small buckets into one task and splits large ones. Without it, as in a stream, that hint
    is ignored, and each task would write a file in each bucket; rows are then dealt out by bucket. Rows are counted
    while they are written, above the exchange: an empty exchange would take the count with it.
    """
    written = Observation()
    if key is not None:
        placed = rows.withColumns({LAYOUT[0]: F.lit(buckets), LAYOUT[1]: bucket(F.col(key), buckets)})
        adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
        rows = placed.hint("rebalance", LAYOUT[1]) if adaptive else placed.repartition(LAYOUT[1])
    writer = rows.observe(written, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer if key is None else writer.partitionBy(*LAYOUT)).parquet(path)
    return written.get["n"]


def work_dir(spark: SparkSession) -> str:
    """New folder for intermediate tables, in the shared checkpoint folder, else in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/offerlens/{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors."""
    path = path or work_dir(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
