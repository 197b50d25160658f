"""Offer-shaped views over the benchmark tables.

Orders stand for offers and line items for extraction attempts; part names are the
catalogue. The SQL twins of these views are in ``oracle.py``. The joins are left to
Spark, which broadcasts by measured size and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.staging import stg_offers

PERIOD = ("1996-01-01", "1998-12-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw offers: repeated titles and companies, unreadable dates, prices beyond the salary gate."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey")
    undated = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    unnamed = (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("o_orderstatus") == "F")
    day = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T08:00:00Z"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" "), "o_orderstatus").alias("titulo"),
        F.concat("c_name", F.lit(" / "), "c_mktsegment").alias("descripcion"),
        F.when(undated, F.lit("sin fecha")).otherwise(day).alias("fecha_publicacion"),
        F.when(~unnamed, F.concat(F.lit("N"), F.col("c_nationkey"), F.lit(" "))).alias("empresa"),
        F.col("o_totalprice").alias("salario_min_anunciado"),
        (F.col("o_totalprice") * F.lit(1.25)).alias("salario_max_anunciado"),
    )


def _reply() -> Column:
    """Reply text by line number: plain JSON, empty list, prose, fenced, trailing text, fields."""
    names = F.concat(
        F.lit('["'), "p_type", F.lit('", "  '), F.upper("p_name"), F.lit(' ", "'), "p_brand", F.lit('", 7]')
    )
    listed = F.concat(F.lit('{"tecnologias": '), names)
    line = F.col("l_linenumber")
    amount = F.floor("l_extendedprice").cast("string")
    return (
        F.when(line == 7, F.lit("not json"))
        .when(line == 6, F.lit('{"tecnologias": []}'))
        .when(line == 5, F.concat(F.lit("```json\n"), listed, F.lit("}\n```")))
        .when(line == 4, F.concat(F.lit("Claro: "), listed, F.lit(', "seniority": " Senior "}')))
        .when(
            line == 3,
            F.concat(listed, F.lit(', "salario_min": "'), amount, F.lit(',50 €", "modalidad": "Remote"}')),
        )
        .when(
            line == 2,
            F.concat(listed, F.lit(', "salario_min": '), amount, F.lit(', "salario_max": "30k"}')),
        )
        .otherwise(F.concat(listed, F.lit(', "seniority": "semi-senior", "salario_min": true}')))
    )


def attempts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part and a reply text."""
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    lines = table(spark, sf_dir, "lineitem").join(parts, "l_partkey")
    return lines.withColumn("reply", _reply())


def raw_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw attempts: several per offer, failures included, some with unusable replies."""
    size = F.col("p_size") % 4
    mode = (
        F.when(size == 0, F.lit("remoto"))
        .when(size == 1, F.lit(" Híbrido"))
        .when(size == 2, F.lit("presencial"))
        .otherwise(F.lit(""))
    )
    low = F.when(F.col("l_discount") >= 0.08, F.col("l_extendedprice"))
    high = F.when(F.col("l_discount") >= 0.09, F.col("l_extendedprice") * F.lit(1.1))
    return attempts_base(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("id_oferta"),
        F.array("p_type").alias("tecnologias"),
        F.when(F.col("l_linestatus") == "O", F.lit("Senior ")).alias("seniority"),
        mode.alias("modalidad"),
        low.alias("salario_min"),
        high.alias("salario_max"),
        F.when(F.col("l_returnflag") == "R", F.lit("llm_error")).alias("error"),
        F.col("reply").alias("respuesta_llm"),
        F.col("l_shipdate").alias("fecha_extraccion"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit("2")).alias("version_prompt"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types and part names as variants; brands stay unknown."""
    part = table(spark, sf_dir, "part")
    types = part.select(F.lower("p_type").alias("variante"), F.col("p_type").alias("nombre_canonico"))
    names = part.select(
        F.lower("p_name").alias("variante"),
        F.element_at(F.split("p_name", " "), 2).alias("nombre_canonico"),
    )
    return types.unionByName(names).distinct()


def staged(spark: SparkSession, sf_dir: str, with_description: bool = False) -> DataFrame:
    return stg_offers(
        raw_offers(spark, sf_dir),
        raw_attempts(spark, sf_dir),
        catalog(spark, sf_dir),
        with_description,
    )
