r"""License scans by diagonal voting, in built-in functions only.

All word bigrams of every text are joined by hash (and by content, so a collision never counts) to their positions
in the templates, a fixed list that is broadcast. A match votes for the diagonal ``text position - template
position``; votes of a diagonal are one bit per template position. A phrase stands exactly where a diagonal has
all its bits. Neighbouring diagonals of a template, where words were put in or left out, are merged, and the
merged span is accepted if enough of the template's positions are verified.

One shuffle moves the matches, a few per document; texts and bigrams stay where they were read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.llm.common import keyed

# fixed values: the phrases whose every place counts, and their labels
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# fixed values: wording of published licences and of the usual notices, and labels of our own
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "unless required by applicable law or agreed to in writing software distributed under the license": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution 4 0 international license": "cc-by-4.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
}
#: lower-cased text is cut into words of ASCII digits and letters and everything beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: diagonals so far apart are neighbours; share of a template's bigrams that a merged span needs
REACH, SHARE = 2, 0.8
_MARK = -1


def template_rows() -> list[tuple[int, int, str]]:
    """``(template, position, bigram)`` of every template, and the mark that every document carries."""
    rows = [(_MARK, 0, "")]
    for number, phrase in enumerate([*PHRASES, *NOTICES]):
        words = phrase.split()
        if not 2 <= len(words) <= 63:
            raise ValueError("a template has 2 to 63 words")
        rows += [(number, i, f"{words[i]} {words[i + 1]}") for i in range(len(words) - 1)]
    return rows


def _templates(spark: SparkSession) -> DataFrame:
    rows = F.array(
        *[F.struct(F.lit(t).alias("template"), F.lit(i).alias("at"), F.lit(g).alias("known")) for t, i, g in template_rows()]
    )
    return spark.range(1).select(F.inline(rows)).withColumn("hash", F.xxhash64("known"))


def license_spans(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, n_words, template, bits, places, first_word, last_word)``: the merged spans of every
    document and one row with template -1 for each. ``bits`` marks verified template positions; ``places`` counts
    diagonals with all of them, and the words are their smallest and largest start.

    The whole text is read; a null text counts as empty and an empty one has no words."""
    # the Kelvin sign is no A-Z, but would become k
    text = F.lower(F.replace(F.coalesce("text", F.lit("")), F.lit("K"), F.lit("ĸ")))
    words = keyed(documents).select("row", "doc_id", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    pair = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda w, i: F.concat(w, F.lit(" "), F.col("words")[i + 1]),
    )
    grams = words.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit("")), pair)).alias("place", "gram"),
    ).withColumn("hash", F.xxhash64("gram"))
    matches = grams.join(F.broadcast(_templates(documents.sparkSession)), "hash").where("gram = known")
    diagonal = (F.col("place") - 1 - F.col("at")).cast("long")
    votes = (
        matches.select("row", "doc_id", "n_words", "template", "at", diagonal.alias("diagonal"))
        .repartition("row")
        .groupBy("row", "doc_id", "n_words", "template", "diagonal")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > REACH
    spans = votes.withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    spans = spans.withColumn("span", F.sum("apart").over(along))
    full = F.bit_count("bits") == _lengths()
    return spans.groupBy("row", "doc_id", "n_words", "template", "span").agg(
        F.bit_or("bits").alias("bits"),
        F.count(F.when(full, 1)).alias("places"),
        F.min(F.when(full, F.col("diagonal"))).alias("first_word"),
        F.max(F.when(full, F.col("diagonal"))).alias("last_word"),
    )


def _lengths():
    """Bigrams of the row's template."""
    lengths = [len(p.split()) - 1 for p in [*PHRASES, *NOTICES]]
    return F.coalesce(F.get(F.array(*map(F.lit, lengths)), F.col("template")), F.lit(99))


def scan_licenses(documents: DataFrame) -> DataFrame:
    """``(row, doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)``: one row per document.

    ``n_base`` counts all places of the base phrases. ``labels`` adds those of notices found to ``SHARE`` or more;
    ``score`` is the largest verified share of any template, 0 without any."""
    names = F.array(*map(F.lit, [*PHRASES.values(), *NOTICES.values()]))
    label = F.get(names, F.col("template"))
    base = (F.col("template") >= 0) & (F.col("template") < len(PHRASES)) & (F.col("places") > 0)
    share = F.when(F.col("template") >= 0, F.bit_count("bits") / _lengths())
    found = base | ((F.col("template") >= len(PHRASES)) & (share >= SHARE))
    joined = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, label))), ",")
    return license_spans(documents).groupBy("row", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(base, F.col("places"))), F.lit(0)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("last_word"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(found).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
    )
