"""Helpers shared by the operators of this subpackage: work tables, row keys and links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``[\x20\x09-\x0D]``, the white space of every operator; ``bytes.split`` and ``bytes.isspace`` use the same set
WHITE = b" \t\n\x0b\x0c\r"


def work_folder(spark: SparkSession) -> str:
    """The shared folder for work tables: ``spark.checkpoint.dir``, else the session's warehouse folder."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")


def store(df: DataFrame, label: str, codec: str = "snappy", options: dict | None = None) -> DataFrame:
    """Write a work table to the shared folder and read it back: lineage ends here, and a task that is run
    again after a lost executor reads the same rows. Nothing deletes it; expire the folder like checkpoints.
    ``options`` are the writer's."""
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.options(compression=codec, **options or {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, name: str, kind: str, alias: str | None = None):
    """Column ``name`` cast to ``kind``, or NULL of that type where the table lacks it."""
    if name in df.columns:
        return F.col(f"`{name}`").cast(kind).alias(alias or name)
    return F.lit(None).cast(kind).alias(alias or name)


def keyed(documents: DataFrame, *more) -> DataFrame:
    """``(row, doc_id, text)`` and ``more``. ``row`` tells apart rows with equal or null ids; it depends on the
    input's files alone. Extra columns, whatever their names, are left behind here."""
    return documents.select(
        F.monotonically_increasing_id().alias("row"),
        pick(documents, "doc_id", "long"),
        pick(documents, "text", "string"),
        *more,
    )


def components(links: DataFrame) -> DataFrame:
    """``(v, label)`` for every end of ``links (x, y)``: the smallest end reachable.

    Each round gives every end the smallest label around it, follows that label's own label, and contracts the
    links to those between different labels, so later rounds are small. Every round is written and never
    recomputed. A hub's links are reduced by partial minima before they are shuffled, and joins on labels are
    plain equi-joins of two shuffled tables, which adaptive execution splits where one key is large."""
    links = store(links.select("x", "y").distinct(), "links")
    labels = None
    while True:
        ends = links.select(F.col("x").alias("v"), F.col("y").alias("near")).union(links.select("y", "x"))
        least = store(
            ends.groupBy("v").agg(F.min("near").alias("near")).select("v", F.least("v", "near").alias("label")), "least"
        )
        # a label has a label itself: that of a smaller neighbour, or its own
        jumps = least.select(F.col("v").alias("label"), F.col("label").alias("to"))
        here = store(least.join(jumps, "label").select("v", F.col("to").alias("label")), "here")
        if labels is None:
            labels = here
        else:
            step = here.select(F.col("v").alias("label"), F.col("label").alias("to"))
            labels = labels.join(step, "label", "left").select("v", F.coalesce("to", "label").alias("label"))
            labels = store(labels, "labels")
        left = links.join(here.select(F.col("v").alias("x"), F.col("label").alias("a")), "x")
        both = left.join(here.select(F.col("v").alias("y"), F.col("label").alias("b")), "y").where("a <> b")
        links = store(both.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).distinct(), "links")
        if links.isEmpty():
            return labels


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels (v, label)`` of components, after more ``links (x, y)``, whose ends may be new."""
    at = lambda v, label: labels.select(F.col("v").alias(v), F.col("label").alias(label))
    known = links.join(at("x", "a"), "x", "left").join(at("y", "b"), "y", "left")
    known = store(known.select("x", "y", F.coalesce("a", "x").alias("a"), F.coalesce("b", "y").alias("b")), "known")
    merged = components(known.select(F.col("a").alias("x"), F.col("b").alias("y")))
    new = known.select(F.explode(F.array("x", "y")).alias("v")).distinct().join(labels, "v", "left_anti")
    every = labels.unionByName(new.withColumn("label", F.col("v")))
    step = merged.select(F.col("v").alias("label"), F.col("label").alias("to"))
    return store(every.join(step, "label", "left").select("v", F.coalesce("to", "label").alias("label")), "labels")

