"""Licence scans by a positional index of rare words.

The base finds the places where the words of a few fixed phrases stand consecutively. The index adds licences by their
notices: template texts are kept as postings (word, template, position). All licence words of a document are looked up in the
postings, and postings that agree on the relative position (place in the document minus place in the template) vote for a
notice standing there, however many other notices the document has. A candidate becomes a
label when enough of the template's words stand in place and each mandatory key phrase of the template is found where
the template has it, give or take ``SLACK`` words.

Everything is DataFrame expressions. One pass over the texts keeps only the places of licence words; the votes work on
those. Postings are as many as the templates' words, so they are broadcast.

A-Z alone are lower-cased. Null and empty text: no words, no labels, null places. Rows that repeat a document get the same
answer; rows of one id with different texts each get their own. Labels with equal support all stay. A text of any length is
scanned whole. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm.common import ascii_lower, cut, table

WORD7 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase and label.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices of public licences: label, notice, key phrases that must stand in it.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ("permission is hereby granted", "associated documentation files")),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license you may obtain a copy of the license at", ("you may not use this file", "in compliance with the license")),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("you can redistribute it", "free software foundation")),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("copy modify and", "with or without fee")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("mozilla public license",)),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)
#: Words too common in any prose to be looked up.
FUNCTION_WORDS = frozenset("a an and any are as at be by can for from if in into is it not of on one or that the this to under was with without you your may".split())
LEAST_VOTES = 3
COVERAGE = 0.7
SLACK = 2


def _words(text: str) -> list[str]:
    return re.findall(WORD7, text.lower())


def _case(phrases: list[str]) -> str:
    tests = []
    for p in phrases:
        own = _words(p)
        tests.append("WHEN w = '%s' AND %s THEN '%s'" % (own[0], " AND ".join("get(words, i + %d) = '%s'" % (k, x) for k, x in enumerate(own) if k), p))
    return f"CASE {' '.join(tests)} END"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    posted = [(w, t, k) for t, (_, notice, _) in enumerate(templates) for k, w in enumerate(_words(notice)) if w not in FUNCTION_WORDS]
    keyed = [(p, t, k) for t, (_, notice, keys) in enumerate(templates) for p in keys for k in range(len(_words(notice))) if _words(notice)[k : k + len(_words(p))] == _words(p)]
    postings = spark.createDataFrame(posted, "term string, template int, at int")
    phrases = sorted({p for p, _, _ in keyed})
    rare = ", ".join(f"'{w}'" for w in sorted({w for w, _, _ in posted}))

    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.regexp_extract_all(text, F.lit(WORD7), F.lit(0)).alias("words"))
    found = F.expr(
        f"""filter(transform(words, (w, i) -> struct(i AS pos, if(w IN ({rare}), w, NULL) AS term, {_case(list(BASE))} AS base, {_case(phrases)} AS phrase)),
            x -> x.term IS NOT NULL OR x.base IS NOT NULL OR x.phrase IS NOT NULL)"""
    )
    spots = cut(words.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), found.alias("spots")))

    key = ["doc_id", "text_hash"]
    hits = spots.where(F.exists("spots", lambda x: x["term"].isNotNull())).dropDuplicates(key).select(*key, F.explode("spots").alias("s")).select(*key, "s.*")
    terms = hits.where("term IS NOT NULL")
    placed = terms.select(*key, "pos", "term").join(F.broadcast(postings), "term")
    placed = placed.withColumn("shift", F.col("pos") - F.col("at"))
    votes = placed.groupBy(*key, "template", "shift").agg(F.count_distinct("term").alias("votes"), F.count_distinct("at").alias("in_place"))
    sizes = {t: sum(1 for _, u, _ in posted if u == t) for t in range(len(templates))}
    size_of = F.element_at(F.array(*[F.lit(max(1, sizes[t])) for t in range(len(templates))]), F.col("template") + 1)
    candidates = votes.where(F.col("votes") >= LEAST_VOTES).withColumn("share", F.col("in_place") / size_of).where(F.col("share") >= coverage)

    mandatory = spark.createDataFrame(keyed, "phrase string, template int, at int")
    needed = {t: len({p for p, u, _ in keyed if u == t}) for t in range(len(templates))}
    needs = F.element_at(F.array(*[F.lit(needed[t]) for t in range(len(templates))]), F.col("template") + 1)
    told = hits.where("phrase IS NOT NULL").join(F.broadcast(mandatory), "phrase").select(*key, "pos", "phrase", F.col("template").alias("of"), "at")
    c, p = candidates.alias("c"), told.alias("p")
    met = c.join(
        p,
        F.col("c.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("c.text_hash") == F.col("p.text_hash")) & (F.col("c.template") == F.col("p.of"))
        & (F.abs(F.col("p.pos") - F.col("p.at") - F.col("c.shift")) <= SLACK),
    )
    met = met.groupBy("c.doc_id", "c.text_hash", "c.template", "c.shift", "c.share").agg(F.count_distinct("phrase").alias("phrases")).where(F.col("phrases") == needs)
    label_of = F.element_at(F.array(*[F.lit(label) for label, _, _ in templates]), F.col("template") + 1)
    more = met.groupBy("doc_id", "text_hash").agg(F.collect_set(label_of).alias("more"), F.max("share").alias("share"))

    base = F.filter("spots", lambda x: x["base"].isNotNull())
    named = F.transform("base", lambda x: F.element_at(F.create_map(*[F.lit(v) for pair in BASE.items() for v in pair]), x["base"]))
    rows = spots.select(*key, "n_words", base.alias("base")).withColumn("own", F.array_sort(F.array_distinct(named)))
    rows = rows.join(more.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"}), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.get("base", F.lit(0))["pos"].cast("long").alias("first_word"),
        F.try_element_at("base", F.lit(-1))["pos"].cast("long").alias("last_word"),
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", F.coalesce("more", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
