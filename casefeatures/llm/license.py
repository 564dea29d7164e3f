"""Licence statements by a trained classifier of passages, with DataFrame and SQL functions only.

Paragraphs end at blank lines, so wrapped lines are one. Within a paragraph every passage is looked at that holds enough of a template's
words within about its length, wherever it stands: prose before and after it has no say. Passages become sparse vectors of hashed word
1- and 2-grams, and a multinomial logistic regression gives each licence family and the class ``unknown`` a probability. It is trained on
the licence wordings below, against passages of the corpus that share no phrase with any. How sure it must be of a
family is calibrated on passages and statements it was not trained on. A prediction counts once a template of its family confirms it; of passages that overlap the surest counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefeatures.sources.files import scratch_path, written

#: Wordings of each family, as licences ask them to be stated.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": ("licensed under the apache license, version 2.0", "you may obtain a copy of the apache license at", "distributed under the apache license"),
    "mit": ("released under the mit license", "licensed under the mit license", "permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "gpl": ("licensed under the gnu general public license", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license, version 3"),
    "lgpl": ("licensed under the gnu lesser general public license", "under the terms of the gnu lesser general public license"),
    "bsd": ("licensed under the bsd license", "redistribution and use in source and binary forms, with or without modification, are permitted"),
    "mpl": ("subject to the terms of the mozilla public license", "licensed under the mozilla public license"),
    "cc-by": ("licensed under a creative commons attribution 4.0 international license", "licensed under cc by 4.0"),
    "cc-by-sa": ("licensed under a creative commons attribution-sharealike license", "licensed under cc by-sa 4.0"),
    "cc-by-nc": ("licensed under a creative commons attribution-noncommercial license", "licensed under cc by-nc 4.0"),
    "cc0": ("dedicated to the public domain under cc0", "licensed under cc0 1.0 universal"),
    "reserved": ("all rights reserved", "copyright all rights reserved"),
}
#: Openings a statement may have.
OPENINGS = ("", "this work is ", "this software is ", "the text is ", "content ", "this file is ", "unless stated otherwise, ")
ENDINGS = ("", ".", " see the file license for details.")
UNKNOWN = "unknown"
#: Paragraphs of the corpus learned from, about; buckets of the hashed n-grams.
SAMPLE, BUCKETS = 4000, 1 << 14
#: In calibration, share of unknown passages that a family may take wrongly, and of its statements that may be missed, which goes first.
WRONG, MISSED = 0.001, 0.01
#: Share of a template's words that a passage must hold, and words it may be longer than the template.
CONFIRM, SLACK = 0.8, 4
#: Words of the corpus in a passage learned from, at least and at most.
SHORTEST, LONGEST = 3, 20
#: Long paragraphs are searched in pieces of so many words, with so many on both sides that the next piece has as well.
PIECE, MARGIN = 384, 64


def words_of(text: Column) -> Column:
    """Lower-case words: letters, digits, and hyphens between them."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*)"))


def grams_of(words: Column) -> Column:
    """Words and pairs of neighbouring words."""
    pairs = F.transform(F.arrays_zip(F.slice(words, 1, F.size(words) - 1).alias("a"), F.slice(words, 2, F.size(words)).alias("b")), lambda x: F.concat_ws(" ", x["a"], x["b"]))
    return F.when(F.size(words) > 1, F.concat(words, pairs)).otherwise(words)


def paragraphs(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``n_paragraphs`` of the text, ``par`` and ``words`` of every paragraph with a word; a text without any has one row with null words."""
    split = F.transform(F.split(F.coalesce("text", F.lit("")), r"\n\s*\n"), words_of)
    found = docs.select(*keys, F.filter(split, lambda w: F.size(w) > 0).alias("found"))
    return found.select(*keys, F.size("found").alias("n_paragraphs"), F.posexplode_outer("found").alias("par", "words"))


def _statements(spark: SparkSession) -> DataFrame:
    """``family``, ``words`` of every wording with every opening and ending, and whether it is ``held`` out, as a third of them are."""
    around = [(o, e) for o in OPENINGS for e in ENDINGS]
    rows = [(f, o + t + e, i % 3 == 2) for f, texts in TEMPLATES.items() for j, t in enumerate(texts) for i, (o, e) in enumerate(around, j)]
    return spark.createDataFrame(rows, "family string, text string, held boolean").select("family", words_of(F.col("text")).alias("words"), "held")


def thresholds(held: DataFrame) -> list[float]:
    """From ``label`` and ``p`` (of every class) of held-out rows, the probability from which each family counts: the lowest that lets at most
    a share of WRONG of the unknown pass, but none that misses more than a share of MISSED of its own statements; 0.5 at least."""
    each = held.select("label", F.posexplode("p").alias("place", "p")).where(f"place < {len(TEMPLATES)}")
    unknown, own = (f"percentile_disc({share}) WITHIN GROUP (ORDER BY p) FILTER (WHERE label = {label})" for share, label in ((1 - WRONG, len(TEMPLATES)), (MISSED, "place")))
    found = {r["place"]: (r["u"], r["s"]) for r in each.groupBy("place").agg(F.expr(unknown).alias("u"), F.expr(own).alias("s")).collect()}
    known = [found.get(i, (None, None)) for i in range(len(TEMPLATES))]
    return [max(0.5, min(u or 0.0, 1.0 if s is None else s - 1e-9)) for u, s in known]


def _templates() -> Column:
    """(family, words, n) of every template, as a literal: its distinct words and how many it has in all."""
    found = [(f, re.findall(r"[a-z0-9]+(?:-[a-z0-9]+)*", t)) for f, texts in TEMPLATES.items() for t in texts]
    return F.array(*[F.struct(F.lit(f).alias("family"), F.lit(list(dict.fromkeys(w))).alias("words"), F.lit(len(w)).alias("n")) for f, w in found])


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of the value, which is computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def _held(words: Column, share: float) -> Column:
    """Whether this share of some template's words is among the words."""
    return F.exists(_templates(), lambda t: F.size(F.array_intersect(t["words"], words)) >= F.lit(share) * F.size(t["words"]))


def confirmed(words: Column, family: Column, share: float = CONFIRM) -> Column:
    """Whether a template of the family has at least this share of its words in the passage."""
    return F.exists(_templates(), lambda t: (t["family"] == family) & (F.size(F.array_intersect(t["words"], words)) >= F.lit(share) * F.size(t["words"])))


def _passages(words: Column) -> Column:
    """(first, n) of every passage that holds enough of a template: from a word of it to where enough are met, and to where all are that it holds."""

    def of(t: Column) -> Column:
        enough = F.ceil(F.lit(CONFIRM) * F.size(t["words"])).cast("int")

        def ends(met: Column) -> Column:
            return F.when(F.size(met) >= enough, F.array_distinct(F.array(F.get(met, enough - 1), F.get(met, F.size(met) - 1))))

        def at(i: Column) -> Column:
            places = _let(F.slice(words, i, t["n"] + SLACK), lambda w: F.transform(t["words"], lambda x: F.array_position(w, x)))
            met = F.array_sort(F.filter(places, lambda p: p > 0))
            return F.transform(_let(met, ends), lambda n: F.struct(i.alias("first"), n.cast("int").alias("n")))

        starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_contains(t["words"], F.get(words, i - 1)))
        return F.flatten(F.filter(F.transform(starts, at), lambda x: x.isNotNull()))

    return F.array_distinct(F.flatten(F.transform(_templates(), of)))


def candidates(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``n_paragraphs``, ``par``, ``own`` (the piece's first word), ``first``, ``words`` of every passage that holds enough of a template.

    Every text has at least one row; where it has no passage ``words`` is null.
    """
    known = F.array_distinct(F.flatten(F.transform(_templates(), lambda t: t["words"])))
    holds = F.coalesce(_let(F.array_intersect(known, F.col("words")), lambda met: _held(met, CONFIRM)), F.lit(False))
    rows = paragraphs(docs, *keys).withColumn("holds", holds).where("holds OR coalesce(par, 0) = 0")
    words, start = F.col("words"), lambda own: F.greatest(own - MARGIN, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), F.size(words) - 1, F.lit(PIECE)), lambda own: F.struct(own.alias("own"), F.slice(words, start(own) + 1, F.lit(PIECE + 2 * MARGIN)).alias("words"))
    )
    keys = (*keys, "n_paragraphs", "par")
    rows = rows.select(*keys, F.explode_outer(F.when(F.col("holds"), pieces)).alias("piece")).select(*keys, "piece.own", "piece.words")
    rows = rows.withColumn("at", F.explode_outer(F.when(words.isNotNull(), _passages(words))))
    return rows.select(*keys, "own", (start(F.col("own")) + F.col("at.first") - 1).alias("first"), F.slice(words, F.col("at.first"), F.col("at.n")).alias("words"))


def trained(docs: DataFrame, sample: int = SAMPLE) -> tuple[PipelineModel, list[str], list[float]]:
    """The model, its classes in order, and the probability from which each family counts.

    Of the corpus about ``sample`` passages, drawn by hash, stand for ``unknown``, without those that hold a template's words; half
    of them are learned from, the others and the statements held out give the thresholds.
    """
    spark = docs.sparkSession
    n = docs.count()
    few = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < min(1.0, sample / max(1, n)) * 1_000_000)
    drawn = paragraphs(few, "doc_id").where("words IS NOT NULL")
    total = drawn.count()
    keep = F.pmod(F.xxhash64("words"), F.lit(1_000_000))
    drawn = drawn.where(keep < min(1.0, sample / max(1, total)) * 1_000_000)
    # One passage of each, of a length that licence statements have.
    n, at = (F.pmod(F.xxhash64("words", F.lit(salt)), x).cast("int") for salt, x in ((2, F.lit(LONGEST - SHORTEST + 1)), (3, F.size("words"))))
    drawn = drawn.withColumn("words", F.slice("words", at + 1, n + SHORTEST)).where(~_held(F.col("words"), 0.6))
    drawn = written(drawn.select(F.lit(UNKNOWN).alias("family"), "words", (F.pmod(F.xxhash64("words", F.lit(1)), F.lit(2)) == 0).alias("held")), scratch_path(spark, "unknown"))
    rows = _statements(spark).unionByName(drawn)
    classes = [*TEMPLATES, UNKNOWN]
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))]), F.col("family"))
    rows = rows.withColumn("label", place).withColumn("grams", grams_of(F.col("words")))
    hashing = HashingTF(inputCol="grams", outputCol="features", numFeatures=BUCKETS, binary=True)
    fit = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=60, probabilityCol="probability")
    model = PipelineModel([hashing, fit.fit(hashing.transform(rows.where(~F.col("held"))))])
    held = model.transform(rows.where(F.col("held"))).select("label", vector_to_array("probability").alias("p"))
    return model, classes, thresholds(held)


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``families`` (sorted, confirmed), ``family`` (the surest; ``none`` where there is none), ``score`` (its probability, else 0),
    ``n_statements``, ``n_paragraphs`` of every row.

    Null and empty texts have no paragraphs. Repeated rows are rows of their own. Further columns are not read.
    """
    model, classes, least = trained(docs, sample)
    rows = candidates(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "row", "doc_id")
    grams = F.coalesce(grams_of(F.col("words")), F.array().cast("array<string>"))
    found = model.transform(rows.withColumn("grams", grams)).withColumn("p", F.array_max(vector_to_array("probability")))
    place = F.col("prediction").cast("int")
    family, least = F.get(F.array(*[F.lit(c) for c in classes]), place), F.get(F.array(*[F.lit(x) for x in least]), place)
    found = found.withColumn("family", family)
    sure = F.col("words").isNotNull() & (F.col("prediction") != len(TEMPLATES)) & (F.col("p") > least) & confirmed(F.col("words"), F.col("family"))
    passage = F.when(sure, F.struct("p", F.size("words").alias("n"), "first", "family"))
    pieces = found.groupBy("row", "doc_id", "n_paragraphs", "par", "own").agg(F.sort_array(F.collect_list(passage), False).alias("all"))

    def apart(taken: Column, x: Column) -> Column:
        met = F.exists(taken, lambda y: (y["first"] < x["first"] + x["n"]) & (x["first"] < y["first"] + y["n"]))
        return F.when(met, taken).otherwise(F.concat(taken, F.array(x)))

    taken = pieces.withColumn("taken", F.aggregate("all", F.slice("all", 1, 0), apart))
    taken = taken.withColumn("taken", F.filter("taken", lambda x: (x["first"] >= F.col("own")) & (x["first"] < F.col("own") + PIECE)))
    best = F.when(F.size("taken") > 0, F.array_max(F.transform("taken", lambda x: F.struct(x["p"].alias("p"), x["family"].alias("family")))))
    taken = taken.withColumns({"best": best, "families": F.array_sort(F.array_distinct(F.transform("taken", lambda x: x["family"])))})
    grouped = taken.groupBy("row", "doc_id", "n_paragraphs").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"),
        F.max("best").alias("best"),
        F.sum(F.greatest(F.size("taken"), F.lit(0))).alias("n_statements"),
    )
    score = F.coalesce("best.p", F.lit(0.0)).alias("score")
    return grouped.select("doc_id", "families", F.coalesce("best.family", F.lit("none")).alias("family"), score, "n_statements", F.col("n_paragraphs").cast("long").alias("n_paragraphs"))
