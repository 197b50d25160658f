"""Landed result pages: one JSON document ``{count, results: [offer, ...]}`` per file."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import utc_stamp
from ..functions.numbers import safe_double
from ..functions.text import clean_url, html_text
from ..operators.dedup import latest_by

# The source label, and the keys that identify the caller.
SOURCE = "adzuna"
PRIVATE_KEYS = ("adref", "__CLASS__")


def field(offer: Column, name: str, path: str = "$", kind: str = "string") -> Column:
    """A value inside an offer; NULL when it, or an object on the way, is missing."""
    return F.try_variant_get(F.try_element_at(offer, F.lit(name)), path, kind)


def file_place(file: Column) -> list[Column]:
    """(stem, number) of a file's name: the digits before its extension are the number; without extension, empty.

    Of compressed pages, the codec's suffix belongs to the extension (``p12.json.gz``). Plain functions, as this is
    computed for each offer and a pattern would take longer than its parse.
    """
    extension = F.substring_index(file, ".", -1)
    named = F.contains(file, F.lit(".")) & ~F.contains(extension, F.lit("/"))
    name = F.when(named, F.left(file, F.length(file) - F.length(extension) - 1)).otherwise(F.lit(""))
    name = F.when(F.endswith(name, F.lit(".json")), F.left(name, F.length(name) - len(".json"))).otherwise(name)
    stem = F.rtrim(name, F.lit("0123456789"))
    return [stem.alias("stem"), F.substr(name, F.length(stem) + 1).try_cast("long").alias("number")]


def content_hash() -> Column:
    return F.xxhash64(F.to_json("oferta"))


def page_place() -> Column:
    """Place of an offer: files by name, numerically by a trailing page number, then position in the page."""
    return F.struct(*file_place(F.col("_file")), F.col("_pos"))


def page_key() -> Column:
    """``page_place``, and content last, for files that hold several pages."""
    return F.struct(*file_place(F.col("_file")), F.col("_pos"), content_hash().alias("_hash"))


def explode_pages(pages: DataFrame) -> DataFrame:
    """Columns (id, oferta, _file, _pos) of every offer that has an id, duplicates included."""
    offers = pages.select(
        F.col("_metadata.file_path").alias("_file"), F.posexplode("results").alias("_pos", "oferta")
    )
    return offers.select(
        field(F.col("oferta"), "id").alias("id"), "oferta", "_file", "_pos"
    ).filter("id IS NOT NULL")


def first_offers(offers: DataFrame) -> DataFrame:
    """First of each id of ``explode_pages`` by ``page_key``; contents are hashed only where places are equal."""
    same_id = Window.partitionBy("id")
    first = offers.withColumn("_rank", F.rank().over(same_id.orderBy(page_place()))).filter("_rank = 1")
    tied = first.withColumn("_tied", F.count(F.lit(1)).over(same_id))
    return latest_by(tied, ["id"], [F.when(F.col("_tied") > 1, content_hash())], tie_break=[])


def read_offer_pages(spark: SparkSession, path: str) -> DataFrame:
    """Offers (id, oferta) of all pages, one page per file, first occurrence of each id."""
    return read_pages(spark, path, multi_line=True)


def read_pages(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """``read_offer_pages``; without ``multi_line``, of files with one page per line, which can be split."""
    pages = spark.read.schema(schemas.OFFER_PAGE).option("multiLine", multi_line).json(path)
    return first_offers(explode_pages(pages)).select("id", "oferta")


def flatten_offers(
    offers: DataFrame,
    source: str = SOURCE,
    ts: datetime | None = None,
    drop: tuple[str, ...] = PRIVATE_KEYS,
) -> DataFrame:
    """Raw rows from (id, oferta); the payload keeps every key but ``drop``."""
    o = F.col("oferta")
    url = clean_url(field(o, "redirect_url"))
    kept = F.map_filter(o, lambda k, _: ~k.isin(*drop, "redirect_url"))
    bare_url = F.create_map(F.lit("redirect_url"), F.try_parse_json(F.to_json(F.array(url))))
    link = F.transform_values(bare_url, lambda _, v: F.try_variant_get(v, "$[0]", "variant"))
    values = {
        "id": F.col("id"),
        "titulo": html_text(field(o, "title")),
        "descripcion": html_text(field(o, "description")),
        "fecha_publicacion": field(o, "created"),
        "empresa": field(o, "company", "$.display_name"),
        "ubicacion": field(o, "location", "$.display_name"),
        "url": url,
        "categoria": field(o, "category", "$.tag"),
        "salario_min_anunciado": safe_double(field(o, "salary_min")),
        "salario_max_anunciado": safe_double(field(o, "salary_max")),
        "fuente": F.lit(source),
        "fecha_ingesta": utc_stamp(ts),
        "payload": F.to_json(F.map_concat(kept, link), {"ignoreNullFields": "false"}),
    }
    return offers.select(*[values[f.name].alias(f.name) for f in schemas.RAW_OFFERS.fields])
