"""Schemas of the raw tables. Published column names are a data contract."""

from pyspark.sql import types as T

# Names and order of the published columns.
RAW_OFFERS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("titulo", T.StringType()),
        T.StructField("descripcion", T.StringType()),
        T.StructField("fecha_publicacion", T.StringType()),
        T.StructField("empresa", T.StringType()),
        T.StructField("ubicacion", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("categoria", T.StringType()),
        T.StructField("salario_min_anunciado", T.DoubleType()),
        T.StructField("salario_max_anunciado", T.DoubleType()),
        T.StructField("fuente", T.StringType()),
        T.StructField("fecha_ingesta", T.TimestampNTZType()),
        T.StructField("payload", T.StringType()),
    ]
)

RAW_ATTEMPTS = T.StructType(
    [
        T.StructField("id_oferta", T.StringType()),
        T.StructField("tecnologias", T.ArrayType(T.StringType())),
        T.StructField("seniority", T.StringType()),
        T.StructField("modalidad", T.StringType()),
        T.StructField("salario_min", T.DoubleType()),
        T.StructField("salario_max", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("respuesta_llm", T.StringType()),
        T.StructField("proveedor_llm", T.StringType()),
        T.StructField("modelo_llm", T.StringType()),
        T.StructField("fecha_extraccion", T.TimestampNTZType()),
        T.StructField("version_prompt", T.StringType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("variante", T.StringType()),
        T.StructField("nombre_canonico", T.StringType()),
    ]
)

# A landed page keeps every offer as a map of variants, so that fields this
# library does not know about still reach the stored payload.
OFFER_PAGE = "count BIGINT, results ARRAY<MAP<STRING, VARIANT>>"
