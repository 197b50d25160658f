"""The extraction work queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import size_or
from ..functions.replies import json_list
from ..operators.dedup import latest_by

# Fixed value: the version that attempts without one count as.
FIRST_VERSION = "1"


def last_success(attempts: DataFrame) -> DataFrame:
    """(id_oferta, num_tecnologias, version_prompt) of each offer's latest success.

    Ties are broken by list and reply, as in staging, so both see the same one.
    """
    good = attempts.filter(F.col("error").isNull() & F.col("id_oferta").isNotNull()).select(
        F.col("id_oferta").cast("string").alias("id_oferta"),
        "fecha_extraccion",
        "tecnologias",
        "respuesta_llm",
        "version_prompt",
    )
    latest = latest_by(good, ["id_oferta"], [F.col("fecha_extraccion").desc_nulls_last()], ordered=("fecha_extraccion",))
    listed = F.coalesce(json_list(F.col("respuesta_llm"), "tecnologias"), F.col("tecnologias"))
    return latest.select(
        "id_oferta",
        size_or(listed, 0).alias("num_tecnologias"),
        F.coalesce("version_prompt", F.lit(FIRST_VERSION)).alias("version_prompt"),
    )


def pending_offers(
    offers: DataFrame,
    attempts: DataFrame,
    prompt_version: str,
    limit: int | None = None,
    reprocess_empty: bool = False,
) -> DataFrame:
    """Offers without a success, newest first; with ``limit``, at most so many per run.

    ``reprocess_empty`` adds those whose last success found nothing under another
    prompt version; it ends by itself, as each such offer gets the new version.
    """
    state = last_success(attempts).withColumn("_done", F.lit(True))
    rows = offers.select(
        F.col("id").cast("string").alias("id_oferta"), "titulo", "descripcion", "fecha_publicacion"
    )
    pending = F.col("_done").isNull()
    if reprocess_empty:
        pending = pending | (
            (F.col("num_tecnologias") == 0) & (F.col("version_prompt") != prompt_version)
        )
    queue = rows.join(state, "id_oferta", "left").filter(pending)
    queue = queue.select(*rows.columns).orderBy(
        F.col("fecha_publicacion").desc_nulls_last(), F.col("id_oferta")
    )
    return queue if limit is None else queue.limit(limit)
