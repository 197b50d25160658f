"""Staging kept up to date: late offers and attempts change only the months they touch.

Two tables are stored, both partitioned by month of publication: every offer joined to its best attempt, and staging,
which keeps one of each re-posted advert. Re-posts share a month, so a month can be ranked on its own. A change set is
a set of offer ids. Their rows are made anew from the raw tables; the months these offers were in and are in now are
ranked again and overwritten, all others are neither read nor written.

Each written month has one row without an id, so that a month that loses all its offers is overwritten as well. Staging
is written before the joined table that tells which months an offer was in: an update that was cut short is repeated
with the same ids and gives the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start, year_month
from ..operators.dedup import repost_dedup
from ..operators.lookup import canonical_items, fits_broadcast
from ..operators.tables import materialize
from .staging import CANONICAL, STAGED, latest_attempts, latest_offers, offers_with_attempts

MONTH = "mes"
UNDATED = "sin_fecha"
#: Columns that the stored tables carry: descriptions are most of the bytes and no mart reads them.
COLUMNS = [c for c in STAGED if c != "descripcion"]


def _month(date: Column) -> Column:
    return F.coalesce(year_month(month_start(date)), F.lit(UNDATED))


def joined_offers(offers: DataFrame, attempts: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """One row per offer with its best attempt and its month; re-posts are still there."""
    best = latest_attempts(attempts)
    if catalog is not None:
        best = canonical_items(best, "tecnologias", catalog, CANONICAL)
    joined = offers_with_attempts(latest_offers(offers, with_description=False), best)
    kept = [c for c in [*COLUMNS, CANONICAL] if c in joined.columns]
    return joined.select(*kept, _month(F.col("fecha_publicacion")).alias(MONTH))


def _staged(joined: DataFrame) -> DataFrame:
    return repost_dedup(joined, "titulo", "empresa", "fecha_publicacion", "id_oferta", "tecnologias").select(
        *joined.columns
    )


def _write(rows: DataFrame, months: DataFrame, path: str) -> None:
    """Overwrite ``months`` at ``path``; a row without an id stands in each."""
    empty = months.select(*[F.col(c) if c == MONTH else F.lit(None).alias(c) for c in rows.columns])
    marked = rows.unionByName(empty).hint("rebalance", MONTH)
    writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; months stay texts, whatever they look like."""
    found = spark.read.parquet(path)
    return found.withColumn(MONTH, F.col(MONTH).cast("string")).filter("id_oferta is not null")


def read_staging(spark: SparkSession, root: str) -> DataFrame:
    """Staging without descriptions, with canonical names where it was built with a catalogue."""
    return _read(spark, f"{root}/stg_ofertas").drop(MONTH)


def build_staging(
    spark: SparkSession, offers: DataFrame, attempts: DataFrame, catalog: DataFrame | None, root: str
) -> None:
    """Store both tables in full, at a new place."""
    joined = materialize(joined_offers(offers, attempts, catalog))
    months = joined.select(MONTH).distinct()
    _write(_staged(joined), months, f"{root}/stg_ofertas")
    _write(joined, months, f"{root}/ofertas_unidas")


def _of(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of the given ids; few ids (measured) are sent to the rows."""
    wanted = ids.select(F.col("id_oferta").alias("_id"))
    if fits_broadcast(wanted):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, F.col(column).cast("string") == F.col("_id"), "left_semi")


def update_staging(
    spark: SparkSession,
    offers: DataFrame,
    attempts: DataFrame,
    catalog: DataFrame | None,
    changed: DataFrame,
    root: str,
) -> list[str]:
    """Bring both tables up to date with the raw tables for the offers ``changed (id_oferta)``; returns the months
    that were ranked again.

    ``offers`` and ``attempts`` are the raw tables with everything that arrived. Months reach the driver, no ids.
    """
    ids = materialize(changed.select(F.col("id_oferta").cast("string")).dropna().distinct())
    new = materialize(joined_offers(_of(offers, ids, "id"), _of(attempts, ids, "id_oferta"), catalog))
    stored = _read(spark, f"{root}/ofertas_unidas")
    old = _of(stored, ids, "id_oferta").select(MONTH)
    touched = [r[0] for r in old.union(new.select(MONTH)).distinct().collect()]
    if not touched:
        return []
    months = spark.createDataFrame([(m,) for m in touched], f"{MONTH} string")
    rest = stored.filter(F.col(MONTH).isin(touched)).join(ids, "id_oferta", "left_anti")
    joined = materialize(rest.select(*new.columns).unionByName(new))
    _write(_staged(joined), months, f"{root}/stg_ofertas")
    _write(joined, months, f"{root}/ofertas_unidas")
    return sorted(touched)
