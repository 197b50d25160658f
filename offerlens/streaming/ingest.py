"""Incremental ingest of landed pages, idempotent by offer id over the whole history.

The source re-sends offers for days, so ids must never be forgotten: there is no watermark. A batch run compares its
ids with the buckets of the table they fall in. A stream keeps the ids it has seen in its state store instead (RocksDB,
on disk) and reads no history: each landed page and each file of the table passes through the state once. Files of the
table are a second source, so that ids written by others, or before the checkpoint existed, are known as well.

``foreachBatch`` repeats a batch whose end was not recorded. A batch therefore leaves a mark before it writes; one
that finds its mark compares itself with the table, like a batch run, and adds what is missing.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.tables import BUCKETS, append_new, append_rows, is_flat, read_table, with_layout
from ..sources.offer_pages import SOURCE, explode_pages, flatten_offers, page_key, read_offer_pages

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MARKS = T.StructType([T.StructField("tanda", T.LongType())])
#: What a row of a micro-batch says: an offer, an id that the state did not know, an id that is in the table.
OFFER, UNSEEN, STORED = 0, 1, 2


def ingest_batch(
    spark: SparkSession,
    offers: DataFrame,
    table: str,
    order_by: list[Column],
    ts: datetime | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Append the offers (id, oferta, ...) that ``table`` lacks; returns their number.

    The batch is read once, and the new rows are counted while they are written.
    """
    stored = with_layout(spark, table, schemas.RAW_OFFERS)
    return _written(append_new(stored, offers, "id", order_by, buckets), stored, table, ts, buckets)


def _written(offers: DataFrame, stored: DataFrame, table: str, ts: datetime | None, buckets: int) -> int:
    return append_rows(flatten_offers(offers, SOURCE, ts), table, None if is_flat(stored) else "id", buckets)


def ingest_pages(spark: SparkSession, landing: str, table: str, ts: datetime | None = None) -> int:
    """Batch ingest of all pages under ``landing``."""
    offers = read_offer_pages(spark, landing)
    return ingest_batch(spark, offers, table, [F.col("id")], ts)


def unseen_offers(batch: DataFrame) -> DataFrame:
    """First offer of each id that a micro-batch of ``stream_rows`` shows to be new.

    One aggregate, with one row per id and task before the shuffle; the batch is evaluated once.
    """
    offer = F.when(F.col("dice") == OFFER, F.struct("oferta"))
    place = F.when(F.col("dice") == OFFER, F.col("lugar"))
    found = batch.groupBy("id").agg(
        F.min_by(offer, place).alias("primera"),
        F.max(F.col("dice") == UNSEEN).alias("nueva"),
        F.max(F.col("dice") == STORED).alias("guardada"),
    )
    return found.filter("nueva and not guardada and primera is not null").select("id", "primera.oferta")


def stream_rows(spark: SparkSession, landing: str, table: str, multi_line: bool = True) -> DataFrame:
    """Streaming rows (id, oferta, lugar, dice): offers, ids in the table, and ids that neither had brought before."""
    pages = spark.readStream.schema(schemas.OFFER_PAGE).option("multiLine", multi_line).json(landing)
    offers = explode_pages(pages).select("id", "oferta", page_key().alias("lugar"), F.lit(OFFER).alias("dice"))
    kept = spark.readStream.schema(schemas.RAW_OFFERS).parquet(table).select("id")
    ids = offers.select("id").union(kept).filter("id is not null").dropDuplicates(["id"])

    def saying(rows: DataFrame, what: int) -> DataFrame:
        return rows.select("id", F.lit(what).alias("dice"))

    return offers.unionByName(saying(ids, UNSEEN), True).unionByName(saying(kept, STORED), True)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    multi_line: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Ingest the pages that landed since the last run, then stop.

    ``multi_line=False`` reads files with one page per line, which can be split.
    """
    if with_layout(spark, table, schemas.RAW_OFFERS).isEmpty():
        # the folder must exist to be a source; no file is written, as it would have no bucket
        append_rows(spark.createDataFrame([], schemas.RAW_OFFERS), table, "id", buckets)

    def append(batch: DataFrame, number: int) -> None:
        session, mark = batch.sparkSession, f"{checkpoint}/marks/{number}"
        stored = with_layout(session, table, schemas.RAW_OFFERS)
        repeated = not read_table(session, mark, MARKS).isEmpty()
        session.createDataFrame([(number,)], MARKS).write.mode("overwrite").parquet(mark)
        offers = unseen_offers(batch)
        if repeated:
            offers = append_new(stored, offers, "id", [F.col("id")], buckets)
        _written(offers, stored, table, None, buckets)

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return (
            stream_rows(spark, landing, table, multi_line)
            .writeStream.foreachBatch(append)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
