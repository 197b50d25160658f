"""Every operator as a query over whole benchmark tables: ``f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import dates, numbers, replies, text
from ..operators import aggregates, bitmaps, dedup, fingerprint, lookup, quality, tables
from ..plans import build, extraction, incremental, marts, queue, reports, staging
from ..sources import catalog as catalogs
from ..sources import journal, offer_pages, snapshots
from ..streaming import ingest
from .views import PERIOD, attempts_base, catalog, raw_attempts, raw_offers, staged, table

LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def _joined_list(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


# --- sources, sinks, table lifecycle ---------------------------------------------------------


def s1_first_per_key(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem")
    rest = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"]
    rest += ["l_tax", "l_returnflag", "l_linestatus"]
    order = [F.col(c).asc_nulls_last() for c in rest]
    return dedup.latest_by(lines, ["l_orderkey", "l_linenumber"], order, tie_break=[])


def s2_catalog_load(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    noun = F.element_at(F.split("p_name", " "), 2)
    blank = F.when(F.col("p_size") > 45, F.lit(" "))
    padded = part.select(
        F.col("p_partkey").alias("pos"),
        F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("variante"),
        F.coalesce(blank, F.concat(noun, F.lit(" "), "p_type")).alias("nombre_canonico"),
    )
    short = part.select(
        (-F.col("p_partkey") - 1).alias("pos"),
        F.element_at(F.split("p_name", " "), 1).alias("variante"),
        F.col("p_type").alias("nombre_canonico"),
    )
    return catalogs.build_catalog(padded.unionByName(short), "pos")


def s4_add_columns(spark: SparkSession, d: str) -> DataFrame:
    wanted = T.StructType.fromDDL("c_custkey BIGINT, version_prompt STRING, salario_min DOUBLE")
    customer = table(spark, d, "customer").select("c_custkey", "c_name")
    return tables.ensure_schema(tables.ensure_schema(customer, wanted), wanted)


def s5_append_new(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'")
    existing = stored.select(F.col("c_custkey").alias("o_custkey"))
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    history = f"{tables.work_dir(spark)}/history"
    tables.append_rows(existing, history, "o_custkey")
    laid_out = tables.with_layout(spark, history, existing.schema)
    return tables.append_new(laid_out, table(spark, d, "orders"), "o_custkey", order)


def s6_attempt_rows(spark: SparkSession, d: str) -> DataFrame:
    fresh = raw_attempts(spark, d).drop("fecha_extraccion", "version_prompt")
    stamped = extraction.record_attempts(fresh, "local", "regla", "2", datetime(2026, 9, 20, 6))
    return stamped.select(
        "id_oferta",
        "error",
        "respuesta_llm",
        "proveedor_llm",
        "modelo_llm",
        "fecha_extraccion",
        "version_prompt",
    )


def s9_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Publish, try to publish the same again, load: what each table and step yields."""
    root = tables.work_dir(spark)
    source = {name: table(spark, d, name) for name in ("orders", "customer")}
    first = snapshots.publish_if_changed(source, root)
    again = snapshots.publish_if_changed(source, root)
    loaded, _, stale = snapshots.load_if_changed(spark, root)
    counts = [
        df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("filas"))
        for name, df in loaded.items()
    ]
    steps = {"publicado": F.lit(first), "repetido": F.lit(again), "obsoleto": F.lit(stale)}
    return counts[0].unionByName(counts[1]).withColumns(steps)


def _hashed_orders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"),
    )


def s10_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint.fingerprint(_hashed_orders(spark, d))


def s10_fingerprint_tree(spark: SparkSession, d: str) -> DataFrame:
    """Leaves by year of a table whose last year arrives late: the second state hashes that year alone."""
    path = f"{tables.work_dir(spark)}/orders"
    orders = _hashed_orders(spark, d).withColumn("anio", F.year("day"))
    last = orders.agg(F.max("anio")).first()[0]
    schema = orders.schema
    known = None
    for part in (orders.filter(F.col("anio") < last), orders.filter(F.col("anio") == last)):
        part.write.mode("append").partitionBy("anio").parquet(path)
        known, hashed = fingerprint.refreshed_leaves(spark.read.schema(schema).parquet(path), known, "anio")
    again = F.col("anio").isin([year for (year,) in hashed])
    return known.select("anio", "n", "h1", "h2", again.alias("calculada"))


def _landed_offers(spark: SparkSession, d: str) -> DataFrame:
    """Orders as nested offer objects (id, oferta), as the source would send them."""
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    orders = table(spark, d, "orders").join(customers, "o_custkey").join(nations, "c_nationkey")
    offer = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("token-"), F.col("o_orderkey")).alias("adref"),
        F.lit("Job").alias("__CLASS__"),
        F.concat(F.lit("<strong>"), "o_orderpriority", F.lit("</strong> &amp;\n"), "o_orderstatus").alias(
            "title"
        ),
        F.struct(F.concat(F.lit("N"), F.col("c_nationkey")).alias("display_name")).alias("company"),
        F.struct(F.col("n_name").alias("display_name")).alias("location"),
        F.struct(F.lit("it-jobs").alias("tag")).alias("category"),
        F.concat(
            F.lit("HTTPS://jobs.example.org/"), F.col("o_orderkey"), F.lit("?utm_source=app#top")
        ).alias("redirect_url"),
        F.col("o_orderdate").cast("date").cast("string").alias("created"),
        F.col("o_totalprice").alias("salary_min"),
        F.when(F.col("o_orderstatus") == "F", F.lit("41000.5")).otherwise(F.lit("a convenir")).alias(
            "salary_max"
        ),
        F.concat(F.lit("ñ"), F.col("o_orderkey")).alias("extra"),
    )
    return orders.select("o_orderkey", offer.alias("offer"))


_LANDED = ["id", "titulo", "empresa", "ubicacion", "url", "fecha_publicacion"]
_LANDED += ["salario_min_anunciado", "salario_max_anunciado", "fuente"]


def p7_flatten_offers(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json(F.to_json("offer"), "MAP<STRING, VARIANT>").alias("oferta")
    offers = _landed_offers(spark, d).select(F.col("o_orderkey").cast("string").alias("id"), parsed)
    flat = offer_pages.flatten_offers(offers)
    keys = F.array_join(F.array_sort(F.json_object_keys("payload")), ",")
    return flat.select(
        "id",
        "titulo",
        "empresa",
        "ubicacion",
        "url",
        "fecha_publicacion",
        "salario_min_anunciado",
        "salario_max_anunciado",
        "categoria",
        "fuente",
        keys.alias("claves_payload"),
        F.get_json_object("payload", "$.redirect_url").alias("url_payload"),
        F.get_json_object("payload", "$.extra").alias("extra_payload"),
    )


def _land(pages: DataFrame, folder: str, most: int) -> None:
    """Add files of at most ``most`` pages, one a line: compressed, as landed pages are many times the tables; a
    compressed file can't be split, so it must be small."""
    pages.write.mode("append").option("maxRecordsPerFile", most).json(folder, compression="gzip")


def s1_read_pages(spark: SparkSession, d: str) -> DataFrame:
    """Land all orders twice as pages of JSON and read them: the first occurrence of each id."""
    folder = f"{tables.work_dir(spark)}/landing"
    offers = _landed_offers(spark, d).select("offer")
    pages = offers.select(F.lit(2).alias("count"), F.array("offer", "offer").alias("results"))
    for _ in range(2):
        _land(pages, folder, 1000)
    found = offer_pages.read_pages(spark, folder, multi_line=False)
    return offer_pages.flatten_offers(found).select(*_LANDED)


def a8_ingest_count(spark: SparkSession, d: str) -> DataFrame:
    """How many offers three ingests of the same landed orders add."""
    root = tables.work_dir(spark)
    offers = _landed_offers(spark, d).withColumn("id", F.col("o_orderkey").cast("string"))
    parsed = offers.select("id", F.from_json(F.to_json("offer"), "MAP<STRING, VARIANT>").alias("oferta"))
    half = parsed.filter("cast(id as bigint) % 2 = 0")
    added = [
        ingest.ingest_batch(spark, batch, f"{root}/raw", [F.col("id")]) for batch in (half, parsed, parsed)
    ]
    stored = tables.read_table(spark, f"{root}/raw", schemas.RAW_OFFERS)
    return stored.agg(F.count(F.lit(1)).alias("guardadas")).select(
        "guardadas", *[F.lit(n).cast("long").alias(f"tanda_{i}") for i, n in enumerate(added, 1)]
    )


def t1_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Land all orders as pages, ingest them as a stream, land them again: nothing is added."""
    root = tables.work_dir(spark)
    offers = _landed_offers(spark, d)
    pages = offers.select(F.lit(1).alias("count"), F.array("offer").alias("results"))
    for _ in range(2):
        _land(pages, f"{root}/landing", 10_000)
        ingest.stream_ingest(
            spark, f"{root}/landing", f"{root}/raw", f"{root}/state", multi_line=False
        ).awaitTermination()
    stored = tables.read_table(spark, f"{root}/raw", schemas.RAW_OFFERS)
    return stored.select(*_LANDED)


# --- projections, joins, aggregates, windows ---------------------------------------------------


def p1_clean_offers(spark: SparkSession, d: str) -> DataFrame:
    return staging.clean_offers(raw_offers(spark, d))


def p2_range_gate(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        numbers.gate(price).alias("salario_min"),
        numbers.gate(price * F.lit(1.25)).alias("salario_max"),
    )


def _joined(spark: SparkSession, d: str) -> DataFrame:
    """Offers with their latest extraction, re-posts still there."""
    return staging.offers_with_attempts(
        staging.latest_offers(raw_offers(spark, d), with_description=False),
        staging.latest_attempts(raw_attempts(spark, d)),
    )


def p4_prefer_pair(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select("id_oferta", "fuente_salario", "salario_min", "salario_max")


def p5_midpoint(spark: SparkSession, d: str) -> DataFrame:
    salary = numbers.midpoint(F.col("salario_min"), F.col("salario_max")).alias("salario")
    return _joined(spark, d).select("id_oferta", salary).filter("salario IS NOT NULL")


def p6_period_filter(spark: SparkSession, d: str) -> DataFrame:
    return reports.in_period(m1_demand(spark, d), *PERIOD)


def j1_offers_attempts(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select(
        "id_oferta", "titulo", "fecha_publicacion", _joined_list("tecnologias"), "seniority", "modalidad"
    )


def _plain_staging(spark: SparkSession, d: str) -> DataFrame:
    return staging.stg_offers(raw_offers(spark, d), raw_attempts(spark, d), with_description=False)


def j2_catalog_join(spark: SparkSession, d: str) -> DataFrame:
    return staging.offer_technologies(_plain_staging(spark, d), catalog(spark, d))


def j3_counts_and_totals(spark: SparkSession, d: str) -> DataFrame:
    """Distinct offers per (technology, month) joined to the month's distinct offers."""
    pairs = m0_offer_tech(spark, d).filter("fecha_publicacion IS NOT NULL")
    pairs = tables.materialize(pairs.select("id_oferta", "tecnologia", "fecha_publicacion"))
    monthly = pairs.withColumn("mes", dates.month_start(F.col("fecha_publicacion")))
    counts = aggregates.distinct_count_by(monthly, "id_oferta", "tecnologia", "mes")
    totals = aggregates.distinct_count_by(
        monthly, "id_oferta", "mes", out="total_ofertas_con_tecnologia_mes"
    )
    return counts.join(totals, "mes")


def j4_technology_salaries(spark: SparkSession, d: str) -> DataFrame:
    stg = tables.materialize(staged(spark, d, with_description=False))
    salary = numbers.midpoint(F.col("salario_min"), F.col("salario_max")).alias("salario")
    paid = stg.select("id_oferta", salary).filter("salario IS NOT NULL")
    pairs = staging.offer_technologies(stg).select("id_oferta", "tecnologia")
    return pairs.join(paid, "id_oferta")


def j5_match_counts(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    flagged = lookup.matched(customers, table(spark, d, "orders"), "o_custkey", "pide")
    return aggregates.match_rate(flagged, ~F.col("pide"), "c_mktsegment")


def j9_array_lookup(spark: SparkSession, d: str) -> DataFrame:
    items = F.array(
        F.upper("p_type"), F.concat(F.lit("  "), "p_name"), "p_brand", "p_name", F.lit("nada")
    )
    lists = table(spark, d, "part").select("p_partkey", items.alias("items"))
    named = lookup.canonical_items(lists, "items", catalog(spark, d), "nombres", key=text.entry_key)
    return named.select("p_partkey", _joined_list("nombres"))


def _order_months(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn(
        "mes", dates.month_start(F.col("o_orderdate").cast("date"))
    )


def a1_distinct_by_month(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.distinct_count_by(_order_months(spark, d), "o_custkey", "mes", out="num_clientes")


def a1_any_period(spark: SparkSession, d: str) -> DataFrame:
    """Orders with each return flag in each year and, as year 0, in all of them, from monthly bitmaps alone."""
    month = F.date_trunc("month", "l_shipdate")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", month.alias("mes"))
    numbers = bitmaps.numbered(items, "l_orderkey", F.col("mes"))
    monthly = bitmaps.id_bitmaps(items.join(numbers, "l_orderkey"), "numero", "l_returnflag", "mes")
    mart = tables.materialize(monthly)
    years = mart.withColumn("anio", F.explode(F.array(F.year("mes"), F.lit(0))))
    return bitmaps.distinct_ids(years, "l_returnflag", "anio", out="pedidos")


def a2_distinct_by_key_month(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.distinct_count_by(
        _order_months(spark, d), "o_custkey", "o_orderpriority", "mes", out="num_clientes"
    )


def a4_mean_median(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.mean_median_by(
        table(spark, d, "lineitem"), "l_extendedprice", "l_returnflag", "l_linestatus"
    )


def a5_conditional_ratio(spark: SparkSession, d: str) -> DataFrame:
    counts = aggregates.match_rate(table(spark, d, "lineitem"), F.col("l_discount") > 0.05, "l_returnflag")
    counts = counts.withColumnRenamed("sin_coincidencia", "con_descuento")
    return counts.withColumn("pct", numbers.pct(F.col("con_descuento"), F.col("total")))


def w1_latest_by_id(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest_by(
        table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc_nulls_last()]
    )


def w2_latest_success(spark: SparkSession, d: str) -> DataFrame:
    latest = staging.latest_attempts(raw_attempts(spark, d))
    return latest.withColumn("tecnologias", F.array_join("tecnologias", ","))


def w3_repost_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _plain_staging(spark, d).select("id_oferta", "titulo", "empresa", "fecha_publicacion")


def w4_share_of_month(spark: SparkSession, d: str) -> DataFrame:
    counts = _order_months(spark, d).groupBy("mes", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    total = aggregates.total_of("n", "mes")
    return counts.withColumn("pct", numbers.pct(F.col("n"), total))


def o2_pending(spark: SparkSession, d: str) -> DataFrame:
    found = queue.pending_offers(raw_offers(spark, d), raw_attempts(spark, d), "2")
    return found.select("id_oferta", "titulo", "fecha_publicacion")


def o2_pending_reprocess(spark: SparkSession, d: str) -> DataFrame:
    found = queue.pending_offers(
        raw_offers(spark, d), raw_attempts(spark, d), "2", limit=None, reprocess_empty=True
    )
    return found.select("id_oferta", "titulo", "fecha_publicacion")


# --- expressions -------------------------------------------------------------------------------


def f1_safe_date(spark: SparkSession, d: str) -> DataFrame:
    day, paid = F.col("o_orderdate"), F.col("o_orderstatus") == "F"
    shape = F.col("o_orderpriority")
    sent = (
        F.when(shape == "1-URGENT", F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(shape == "2-HIGH", F.date_format(day, "yyyy/MM/dd"))
        .when((shape == "3-MEDIUM") & paid, F.lit("2026-02-30"))
        .when(shape == "3-MEDIUM", F.date_format(day, "yyyy-MM"))
        .when((shape == "4-NOT SPECIFIED") & paid, F.date_format(day, "dd-MM-yyyy"))
        .when(shape == "4-NOT SPECIFIED", F.lit("ayer"))
        .when(~paid, F.date_format(day, "yyyy-M-d"))
    )
    return table(spark, d, "orders").select("o_orderkey", dates.safe_date(sent).alias("fecha"))


def f2_month(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        "o_orderkey", dates.month_start(day).alias("mes"), dates.year_month(day).alias("anio_mes")
    )


def f4_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    parts = F.col("o_orderkey").cast("string"), F.nullif("o_orderpriority", F.lit("1-URGENT"))
    return table(spark, d, "orders").select("o_orderkey", text.surrogate_key(*parts).alias("clave"))


def f5_term_key(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("\t "), "p_type", F.lit(" "))
    return table(spark, d, "part").select("p_partkey", text.term_key(raw).alias("clave"))


def f6_canonical_mode(spark: SparkSession, d: str) -> DataFrame:
    return raw_attempts(spark, d).select(
        "id_oferta",
        "fecha_extraccion",
        text.canonical_mode(F.col("modalidad")).alias("modalidad"),
        text.canonical_level(F.col("seniority")).alias("seniority"),
    )


def _replies(spark: SparkSession, d: str) -> DataFrame:
    names = ["tecnologias", "seniority", "modalidad", "salario_min", "salario_max"]
    found = replies.reply_fields(F.col("reply"), *names)
    return attempts_base(spark, d).select(*LINE, found.alias("r")).select(*LINE, "r.is_object", F.col("r.fields").alias("v"))


def f7_alias_map(spark: SparkSession, d: str) -> DataFrame:
    level = replies.text_field(F.col("v.seniority"), "$")
    mode = replies.text_field(F.col("v.modalidad"), "$")
    return _replies(spark, d).select(
        *LINE,
        text.alias_map(level, text.SENIORITY_ALIASES).alias("seniority"),
        text.alias_map(mode, text.WORK_MODE_ALIASES).alias("modalidad"),
    )


def f8_salary_parse(spark: SparkSession, d: str) -> DataFrame:
    return _replies(spark, d).select(
        *LINE,
        replies.lenient_salary(F.col("v.salario_min"), "$").alias("salario_min"),
        replies.lenient_salary(F.col("v.salario_max"), "$").alias("salario_max"),
    )


def f9_order_bounds(spark: SparkSession, d: str) -> DataFrame:
    low = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    high = F.when(F.col("l_linestatus") == "O", F.col("l_quantity") * 1000).otherwise(F.lit(0.0))
    first, second = numbers.ordered_bounds(low, high)
    return table(spark, d, "lineitem").select(
        *LINE, first.alias("salario_min"), second.alias("salario_max")
    )


def f10_json_repair(spark: SparkSession, d: str) -> DataFrame:
    return _replies(spark, d).select(
        *LINE,
        F.coalesce("is_object", F.lit(False)).alias("valido"),
        F.try_variant_get("v.tecnologias", "$[1]", "string").alias("segunda"),
    )


def f11_json_list(spark: SparkSession, d: str) -> DataFrame:
    listed = replies.json_list(F.col("respuesta_llm"), "tecnologias")
    return raw_attempts(spark, d).select(
        "id_oferta",
        "fecha_extraccion",
        "respuesta_llm",
        F.array_join(F.coalesce(listed, "tecnologias"), ",").alias("tecnologias"),
    )


def f13_explode(spark: SparkSession, d: str) -> DataFrame:
    latest = staging.latest_attempts(raw_attempts(spark, d))
    return latest.select("id_oferta", F.explode("tecnologias").alias("tecnologia"))


def f14_clean_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.clean_url(F.col("url")).alias("url"))


def f15_html_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.html_text(F.col("html")).alias("texto"))


def f16_safe_double(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        numbers.safe_double(F.get_json_object("props", "$.k")).alias("k"),
        numbers.safe_double(F.col("event_type")).alias("tipo"),
    )


TEMPLATE = "Oferta: {titulo}\n{descripcion}"


def f17_prompt(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        "doc_id", text.prompt(F.col("source"), F.col("text"), TEMPLATE).alias("prompt")
    )


def f18_rounding(spark: SparkSession, d: str) -> DataFrame:
    ratio = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        *LINE,
        numbers.round_half_away(ratio, 2).alias("dos"),
        numbers.round_half_away(ratio, 0).alias("cero"),
        numbers.round_half_even(ratio, 1).alias("par"),
    )


# --- composite products --------------------------------------------------------------------------


def m0_staging(spark: SparkSession, d: str) -> DataFrame:
    stg = staging.stg_offers(raw_offers(spark, d), raw_attempts(spark, d))
    return stg.withColumns(
        {"n": F.size("tecnologias").cast("long"), "tecnologias": F.array_join("tecnologias", ",")}
    )


def t2_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Staging built without the late rows, then brought up to date with two late batches."""
    root = tables.work_dir(spark)
    offers, attempts = raw_offers(spark, d), raw_attempts(spark, d)
    # every seventh offer is late, and so are the attempts of every fifth, in two batches
    late_offer, late_attempt = F.col("id").cast("long") % 7, F.col("id_oferta").cast("long") % 5
    batches = [
        (offers.filter(late_offer != 0), attempts.filter(late_attempt > 1)),
        (offers, attempts.filter(late_attempt > 0)),
        (offers, attempts),
    ]
    incremental.build_staging(spark, *batches[0], catalog(spark, d), root)
    ids = offers.filter(late_offer == 0).select(F.col("id").alias("id_oferta"))
    changes = [
        ids.unionByName(attempts.filter(late_attempt == 1).select("id_oferta")),
        attempts.filter(late_attempt == 0).select("id_oferta"),
    ]
    for (known, tried), changed in zip(batches[1:], changes):
        incremental.update_staging(spark, known, tried, catalog(spark, d), changed, root)
    stg = incremental.read_staging(spark, root).select(*incremental.COLUMNS)
    return stg.withColumn("tecnologias", F.array_join("tecnologias", ","))


def m0_offer_tech(spark: SparkSession, d: str) -> DataFrame:
    return staging.offer_technologies(staged(spark, d))


def m1_demand(spark: SparkSession, d: str) -> DataFrame:
    return marts.monthly_demand(staged(spark, d))


def m2_salaries(spark: SparkSession, d: str) -> DataFrame:
    return marts.salaries_by_technology(staged(spark, d))


def m3_trend(spark: SparkSession, d: str) -> DataFrame:
    return marts.work_mode_trend(_plain_staging(spark, d))


def m4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return marts.extraction_coverage(staged(spark, d))


def r1_kpis(spark: SparkSession, d: str) -> DataFrame:
    stg = tables.materialize(staged(spark, d))
    return reports.kpis(marts.extraction_coverage(stg), marts.monthly_demand(stg), *PERIOD)


def r2_ranking(spark: SparkSession, d: str) -> DataFrame:
    return reports.technology_ranking(m1_demand(spark, d), 15, *PERIOD)


def r3_mode_split(spark: SparkSession, d: str) -> DataFrame:
    return reports.work_mode_split(m3_trend(spark, d), *PERIOD)


def r4_tech_series(spark: SparkSession, d: str) -> DataFrame:
    return reports.tech_series(m1_demand(spark, d), "widget")


def r5_salary_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.salary_summary(m2_salaries(spark, d), *PERIOD)


def r6_tech_totals(spark: SparkSession, d: str) -> DataFrame:
    return reports.tech_totals(m1_demand(spark, d))


def r7_months(spark: SparkSession, d: str) -> DataFrame:
    return reports.months(m4_coverage(spark, d))


def r8_coverage_series(spark: SparkSession, d: str) -> DataFrame:
    return reports.coverage_series(m4_coverage(spark, d), *PERIOD)


# --- quality and extraction ----------------------------------------------------------------------


def q1_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_null(_plain_staging(spark, d), "modalidad").select("id_oferta", "titulo")


def q2_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


def q3_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.accepted_values(table(spark, d, "orders"), "o_orderstatus", ["F", "O"])


def q4_relationships(spark: SparkSession, d: str) -> DataFrame:
    solvent = table(spark, d, "customer").filter("c_acctbal >= 0")
    return quality.relationships(table(spark, d, "orders"), "o_custkey", solvent, "c_custkey")


def q5_salary_range(spark: SparkSession, d: str) -> DataFrame:
    bad = quality.salary_range(_plain_staging(spark, d), 30000, 200000)
    return bad.select("id_oferta", "fuente_salario", "salario_min", "salario_max")


def q6_catalog_normalized(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    good = part.select(F.col("p_name").alias("variante"), F.col("p_type").alias("nombre_canonico"))
    return quality.catalog_normalized(
        good.unionByName(good.withColumn("variante", F.concat("variante", F.lit("  "))))
    )


def q7_check_summary(spark: SparkSession, d: str) -> DataFrame:
    """All declared checks; staging and marts are written first, as in a build."""
    root = tables.work_dir(spark)
    stg = tables.materialize(staged(spark, d), f"{root}/stg_ofertas")
    built = {
        name: tables.materialize(builder(stg), f"{root}/{name}")
        for name, builder in marts.BUILDERS.items()
    }
    return quality.run_checks(
        {
            "raw_ofertas": raw_offers(spark, d),
            "raw_ofertas_clasificadas": raw_attempts(spark, d),
            "catalogo_tecnologias": catalog(spark, d),
            "stg_ofertas": stg,
            "int_tecnologias_por_oferta": staging.offer_technologies(stg),
            **built,
        }
    )


def s8_built_marts(spark: SparkSession, d: str) -> DataFrame:
    """Build everything, load the published marts and read two of them side by side."""
    root = tables.work_dir(spark)
    entries = catalog(spark, d)
    build.build_all(spark, raw_offers(spark, d), raw_attempts(spark, d), entries, root, checks=False)
    loaded = build.load_marts(spark, root)
    demand = loaded["demanda_tecnologias_mensual"].select("id_tecnologia_mes", "mes", "num_ofertas")
    salaries = loaded["salarios_por_tecnologia"].select("id_tecnologia_mes", "salario_mediano")
    return demand.join(salaries, "id_tecnologia_mes", "left")


def _length_extractor(prompt: str) -> str:
    """Stands for a model: replies with the prompt's length, and fails on some prompts."""
    n = len(prompt)
    if n % 3 == 0:
        raise ValueError(n)
    return f'{{"salario_min": {n}}}'


def x1_run_extractor(spark: SparkSession, d: str) -> DataFrame:
    prompt = text.prompt(F.col("source"), F.col("text"), TEMPLATE, max_chars=None).alias("prompt")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id_oferta"), prompt)
    return tables.materialize(extraction.run_extractor(docs, _length_extractor))


def _long_texts_only(prompt: str) -> str:
    """Stands for a model whose quota ends with the first short prompt."""
    if len(prompt) < 2000:
        raise extraction.QuotaExhausted(len(prompt))
    return _length_extractor(prompt)


def x1_shared_quota(spark: SparkSession, d: str) -> DataFrame:
    """All documents, longest first, to eight callers that share one quota."""
    prompt = text.prompt(F.col("source"), F.col("text"), TEMPLATE, max_chars=None).alias("prompt")
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id_oferta"), prompt)
    dealt = extraction.deal(docs.orderBy(F.length("prompt").desc(), "id_oferta"), 8)
    record = journal.open_journal(f"{tables.work_dir(spark)}/journal")
    return tables.materialize(extraction.run_in_rounds(dealt, _long_texts_only, record, calls=32))


def a12_attempt_counts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts processed and failed; raises if all have failed."""
    processed, failed = extraction.assert_not_all_failed(raw_attempts(spark, d))
    return spark.createDataFrame([(processed, failed)], "procesadas long, fallidas long")


def q8_header_contract(spark: SparkSession, d: str) -> DataFrame:
    """Parts as four CSV files, two of which lack columns of the catalogue."""
    root = tables.work_dir(spark)
    names = [("variante", "nombre_canonico"), ("variante", "nombre"), ("nombre_canonico", "variante"), ("a", "b")]
    for lot, (name, kind) in enumerate(names):
        rows = table(spark, d, "part").filter(F.col("p_partkey") % 4 == lot)
        rows = rows.select(F.col("p_name").alias(name), F.col("p_type").alias(kind))
        rows.coalesce(1).write.option("header", True).csv(f"{root}/seeds/lote{lot}")
    bad = catalogs.missing_columns(spark, f"{root}/seeds/*/*.csv", schemas.CATALOG.names)
    lot = F.regexp_extract("archivo", r"/(lote\d)/", 1).alias("lote")
    return bad.select(lot, F.array_join("faltan", ",").alias("faltan"))


def x2_parse_replies(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    key = F.concat_ws("-", *LINE[:4], F.col("l_quantity").cast("long"), cents)
    made = attempts_base(spark, d).select(
        key.alias("id_oferta"),
        F.col("reply").alias("respuesta_llm"),
        F.lit(None).cast("string").alias("call_error"),
    )
    parsed = extraction.parse_replies(made, catalog(spark, d))
    return parsed.withColumn("tecnologias", F.array_join("tecnologias", ","))


_QUERIES = (
    s1_first_per_key,
    s2_catalog_load,
    s4_add_columns,
    s5_append_new,
    s6_attempt_rows,
    s9_snapshot,
    s10_fingerprint,
    s10_fingerprint_tree,
    s1_read_pages,
    s8_built_marts,
    a8_ingest_count,
    t1_stream_ingest,
    p1_clean_offers,
    p2_range_gate,
    p4_prefer_pair,
    p5_midpoint,
    p6_period_filter,
    p7_flatten_offers,
    j1_offers_attempts,
    j2_catalog_join,
    j3_counts_and_totals,
    j4_technology_salaries,
    j5_match_counts,
    j9_array_lookup,
    a1_distinct_by_month,
    a1_any_period,
    a2_distinct_by_key_month,
    a4_mean_median,
    a5_conditional_ratio,
    w1_latest_by_id,
    w2_latest_success,
    w3_repost_dedup,
    w4_share_of_month,
    o2_pending,
    o2_pending_reprocess,
    f1_safe_date,
    f2_month,
    f4_surrogate_key,
    f5_term_key,
    f6_canonical_mode,
    f7_alias_map,
    f8_salary_parse,
    f9_order_bounds,
    f10_json_repair,
    f11_json_list,
    f13_explode,
    f14_clean_url,
    f15_html_text,
    f16_safe_double,
    f17_prompt,
    f18_rounding,
    m0_staging,
    t2_late_rows,
    m0_offer_tech,
    m1_demand,
    m2_salaries,
    m3_trend,
    m4_coverage,
    r1_kpis,
    r2_ranking,
    r3_mode_split,
    r4_tech_series,
    r5_salary_summary,
    r6_tech_totals,
    r7_months,
    r8_coverage_series,
    q1_not_null,
    q2_unique,
    q3_accepted_values,
    q4_relationships,
    q5_salary_range,
    q6_catalog_normalized,
    q7_check_summary,
    q8_header_contract,
    a12_attempt_counts,
    x1_run_extractor,
    x1_shared_quota,
    x2_parse_replies,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}
