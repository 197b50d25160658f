"""Staging: one clean row per offer, joined to its latest successful extraction.

Plan: two shuffles by offer id (one per raw table) that the join reuses, and one
by re-post key. Canonical names are looked up row by row and cost no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import safe_date
from ..functions.numbers import gate, prefer_pair, safe_double
from ..functions.replies import json_list
from ..functions.text import canonical_level, canonical_mode, sql_trim, surrogate_key, term_key
from ..operators.dedup import latest_by, repost_dedup
from ..operators.lookup import canonical_items, lookup_join

STAGED = [
    "id_oferta",
    "titulo",
    "descripcion",
    "fecha_publicacion",
    "empresa",
    "tecnologias",
    "seniority",
    "modalidad",
    "fuente_salario",
    "salario_min",
    "salario_max",
]
CANONICAL = "tecnologias_canonicas"


def clean_offers(offers: DataFrame, with_description: bool = True) -> DataFrame:
    """Typed, trimmed offers with gated salaries; duplicates of an id are still there."""
    columns = [
        F.col("id").cast("string").alias("id_oferta"),
        sql_trim(F.col("titulo")).alias("titulo"),
        safe_date(F.col("fecha_publicacion")).alias("fecha_publicacion"),
        sql_trim(F.col("empresa")).alias("empresa"),
        gate(F.col("salario_min_anunciado")).alias("salario_min_publicado"),
        gate(F.col("salario_max_anunciado")).alias("salario_max_publicado"),
    ]
    if with_description:
        # last, so that it is also the last tie-break between copies of an id
        columns.append(F.col("descripcion"))
    return offers.filter(F.col("id").isNotNull()).select(*columns)


def latest_offers(offers: DataFrame, with_description: bool = True) -> DataFrame:
    """One row per offer id, latest publication date first."""
    return latest_by(
        clean_offers(offers, with_description),
        ["id_oferta"],
        [F.col("fecha_publicacion").desc_nulls_last()],
        ordered=("fecha_publicacion",),
    )


def clean_attempts(attempts: DataFrame) -> DataFrame:
    """Typed fields of successful attempts; the raw reply's list wins over the stored one."""
    return attempts.select(
        "id_oferta",
        F.coalesce(json_list(F.col("respuesta_llm"), "tecnologias"), F.col("tecnologias")).alias(
            "tecnologias"
        ),
        canonical_level(F.col("seniority")).alias("seniority"),
        canonical_mode(F.col("modalidad")).alias("modalidad"),
        safe_double(F.col("salario_min")).alias("salario_min"),
        safe_double(F.col("salario_max")).alias("salario_max"),
    )


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """Latest success per offer; a later failure never hides it.

    Ranked before it is cleaned, so only the winning replies are parsed.
    """
    good = attempts.filter(F.col("error").isNull() & F.col("id_oferta").isNotNull()).select(
        F.col("id_oferta").cast("string").alias("id_oferta"),
        "fecha_extraccion",
        "tecnologias",
        "respuesta_llm",
        "seniority",
        "modalidad",
        "salario_min",
        "salario_max",
    )
    latest = latest_by(good, ["id_oferta"], [F.col("fecha_extraccion").desc_nulls_last()], ordered=("fecha_extraccion",))
    return clean_attempts(latest)


def offers_with_attempts(offers: DataFrame, attempts: DataFrame) -> DataFrame:
    """Left join of unique offers to unique attempts, choosing one salary source per offer."""
    joined = offers.join(
        attempts.withColumnsRenamed({"salario_min": "_llm_min", "salario_max": "_llm_max"}),
        "id_oferta",
        "left",
    )
    source, low, high = prefer_pair(
        F.col("_llm_min"),
        F.col("_llm_max"),
        F.col("salario_min_publicado"),
        F.col("salario_max_publicado"),
        ("llm", "adzuna"),
    )
    columns = [c for c in [*STAGED, CANONICAL] if c in joined.columns]
    return joined.select(
        *columns,
        source.alias("fuente_salario"),
        low.alias("salario_min"),
        high.alias("salario_max"),
    )


def stg_offers(
    offers: DataFrame,
    attempts: DataFrame,
    catalog: DataFrame | None = None,
    with_description: bool = True,
) -> DataFrame:
    """Staging. With a catalogue it also carries ``tecnologias_canonicas`` for the marts,
    NULL for unclassified offers and empty when nothing known was found."""
    best = latest_attempts(attempts)
    if catalog is not None:
        best = canonical_items(best, "tecnologias", catalog, CANONICAL)
    joined = offers_with_attempts(latest_offers(offers, with_description), best)
    kept = repost_dedup(joined, "titulo", "empresa", "fecha_publicacion", "id_oferta", "tecnologias")
    return kept.select(*[c for c in [*STAGED, CANONICAL] if c in kept.columns])


def offer_technologies(stg: DataFrame, catalog: DataFrame | None = None) -> DataFrame:
    """(offer, technology) pairs of staging.

    Uses the canonical lists staging carries; with a catalogue it looks the raw
    terms up instead, which costs one shuffle for the distinct pairs.
    """
    if catalog is None:
        pairs = stg.select("id_oferta", F.explode(CANONICAL).alias("tecnologia"), "fecha_publicacion")
    else:
        terms = stg.select("id_oferta", "fecha_publicacion", F.explode("tecnologias").alias("_t"))
        entries = catalog.select(
            F.col("variante").alias("_key"), F.col("nombre_canonico").alias("tecnologia")
        )
        found = lookup_join(terms.withColumn("_key", term_key(F.col("_t"))), entries, "_key")
        pairs = found.select("id_oferta", "tecnologia", "fecha_publicacion").distinct()
    return pairs.select(
        surrogate_key(F.col("id_oferta"), F.col("tecnologia")).alias("id_oferta_tecnologia"),
        "id_oferta",
        "tecnologia",
        "fecha_publicacion",
    )
