"""Technology catalogue: variant to canonical name, supplied by the caller as CSV."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import blank_to_null, entry_key, strip
from ..operators.quality import require_columns

#: A comma outside of quotes.
_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
#: Different headers that the files of one folder may have.
MAX_HEADERS = 100


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(archivo, columnas): the first line of each CSV file at ``path``, a file, a folder or a pattern.

    Only the first block of a file can hold it; within a block, lines keep their order.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("archivo"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
        F.regexp_replace("value", "^\ufeff", "").alias("value"),
    )
    first = lines.filter("_start = 0").groupBy("archivo").agg(F.min_by("value", "_row").alias("value"))
    names = F.transform(F.split("value", _COMMA), lambda c: F.regexp_replace(F.btrim(c), '^"|"$', ""))
    return first.select("archivo", names.alias("columnas"))


def missing_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """(archivo, faltan): the files at ``path`` whose header lacks some of ``columns``, and which ones."""
    wanted = F.array(*[F.lit(c) for c in columns])
    lacking = F.array_sort(F.array_except(wanted, "columnas"))
    return headers(spark, path).select("archivo", lacking.alias("faltan")).filter(F.size("faltan") > 0)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The CSV files at ``path`` as they are, all text; fails and names the files that lack a required column.

    Files of one folder may have their columns in different orders.
    """
    bad = missing_columns(spark, path, schemas.CATALOG.names).orderBy("archivo").limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r.archivo}: missing columns {r.faltan}" for r in bad))
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    kinds = headers(spark, path).groupBy("columnas").agg(F.sort_array(F.collect_list("archivo")).alias("archivos"))
    groups = kinds.orderBy("archivos").limit(MAX_HEADERS + 1).collect()
    if len(groups) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers at {path}")
    if len(groups) < 2:
        return require_columns(reader.csv(path), schemas.CATALOG.names)
    parts = [reader.csv(list(g.archivos)) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def build_catalog(raw: DataFrame, order: str, self_variants: bool = True) -> DataFrame:
    """Normalized (variante, nombre_canonico) from raw entries with an ordering column.

    Blank entries are skipped and the last entry of a variant wins. Every
    canonical name also names itself, unless an entry already uses that key;
    among canonical names sharing a key the first wins.
    """
    entries = raw.select(
        F.col(order).alias("_o"),
        blank_to_null(strip(F.col("variante"))).alias("_v"),
        blank_to_null(strip(F.col("nombre_canonico"))).alias("nombre_canonico"),
    ).dropna(subset=["_v", "nombre_canonico"])
    listed = entries.select(entry_key(F.col("_v")).alias("variante"), "nombre_canonico", "_o")
    if self_variants:
        # rank 0: listed entries, last first; rank 1: canonical names, first first
        own = entries.select(
            entry_key(F.col("nombre_canonico")).alias("variante"), "nombre_canonico", F.col("_o")
        )
        listed = listed.select("*", F.lit(0).alias("_r"), (-F.col("_o")).alias("_p")).unionByName(
            own.select("*", F.lit(1).alias("_r"), F.col("_o").alias("_p"))
        )
    else:
        listed = listed.select("*", F.lit(0).alias("_r"), (-F.col("_o")).alias("_p"))
    best = Window.partitionBy("variante").orderBy("_r", "_p")
    return (
        listed.withColumn("_n", F.row_number().over(best))
        .filter("_n = 1")
        .select("variante", "nombre_canonico")
    )


def load_catalog(spark: SparkSession, path: str, self_variants: bool = True) -> DataFrame:
    """Catalogue from a CSV file, whose row order decides between repeated variants."""
    raw = read_seed(spark, path).withColumn("_row", F.monotonically_increasing_id())
    return build_catalog(raw, "_row", self_variants)
