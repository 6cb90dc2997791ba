"""License scans by diagonal voting, in DataFrame operations only.

Every run of ``GRAM`` words of a document is hashed and joined with the places of the same run in license templates; a hit counts
only if its words are the same, not just the hash. A hit's diagonal is its place in the document minus that in the template: all
runs of an unchanged copy lie on one diagonal. Hits are added up by document, template and diagonal; diagonals within a
template's ``slack`` of each other (words left out or put in) are taken together, and a span holds if the template's words found
on them are at least ``percent`` of all its words. Phrases have no slack and 100 percent, so their spans are the exact places.

One pass reads the documents; only hits are shuffled, by document. Templates are broadcast if they have at most
``BROADCAST_GRAMS`` runs (they are counted); beyond that runs meet them by a shuffle that deals frequent ones to many tasks.

Edge cases
    Null and word-less documents have no words, no spans and score 0. A null doc_id is a document like others; repeated documents
    each get a row. Of spans of one template whose diagonals lie within its slack (ties) one is returned, with the largest
    coverage. Templates of fewer words than a run are refused. An empty table gives an empty result. Very long texts are
    searched whole. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few_rows, join_dimension
from .decontam import words

#: Words of a run.
GRAM = 3
#: Runs of templates that are broadcast at most.
BROADCAST_GRAMS = 100_000
#: Templates of so many words are texts, which may be changed in places; shorter ones must stand word by word.
TEXT_WORDS = 16
#: Part of a text's words that must be found, and words of a text for one word of slack.
PERCENT, SLACK_EVERY = 70, 12


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def slack(self) -> int:
        return 0 if self.base or len(self.words) < TEXT_WORDS else len(self.words) // SLACK_EVERY

    @property
    def percent(self) -> int:
        return 100 if self.base or len(self.words) < TEXT_WORDS else PERCENT


#: Phrases of the contract.
PHRASES = [Template("mit", "under the mit license", True), Template("apache-2", "apache license version 2", True), Template("cc-by-nc", "cc by nc", True)]

#: Usual notices of public licenses, and sentences of their texts.
NOTICES = [
    Template("agpl-3", "gnu affero general public license version 3"),
    Template("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    Template("cc-by", "creative commons attribution 4 0 international"),
    Template("cc-by-nc", "creative commons attribution noncommercial"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "creative commons zero"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("gpl-2", "gnu general public license version 2"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("mpl-2", "mozilla public license version 2"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: Template number of the row that each document has besides its hits.
END = -1


def _index(spark, templates: list[Template], gram: int) -> DataFrame:
    """h, off, tw, template, label, base, len, slack, percent: the templates' runs."""
    rows = []
    for k, t in enumerate(templates):
        w = t.words
        if len(w) < gram:
            raise ValueError(f"a template has fewer than {gram} words: {t.text}")
        rows += [(off, w[off : off + gram], k, t.label, t.base, len(w), t.slack, t.percent) for off in range(len(w) - gram + 1)]
    index = spark.createDataFrame(rows, "off int, tw array<string>, template int, label string, base boolean, len int, slack int, percent int")
    end = spark.createDataFrame([(0, [""] * gram, END, None, False, 0, 0, 0)], index.schema)
    return index.withColumn("h", F.xxhash64(*[F.col("tw")[i] for i in range(gram)])).union(end.withColumn("h", F.lit(0).cast("long")))


def _hits(docs: DataFrame, index: DataFrame, gram: int, broadcast_grams: int) -> DataFrame:
    """rid, doc_id, n_words, pos and the index's columns: runs that stand in a template, and an END row for each document."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words(F.col("text")).alias("w"))
    places = rows.select("rid", "doc_id", "w", F.size("w").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("w"))).alias("pos"))
    run = [F.get("w", F.col("pos") + i) for i in range(gram)]
    at_end = F.col("pos") == F.col("n_words")
    h = F.when(F.col("pos") + gram <= F.col("n_words"), F.xxhash64(*run)).when(at_end, F.lit(0).cast("long"))
    runs = places.select("rid", "doc_id", "n_words", "pos", h.alias("h"), *[c.alias(f"w{i}") for i, c in enumerate(run)])
    same = F.lit(True)
    for i in range(gram):
        same = same & (F.col(f"w{i}") == F.col("tw")[i])
    hits = join_dimension(runs.filter(F.col("h").isNotNull()), index, "h", few_rows(index, broadcast_grams))
    return hits.filter(F.when(F.col("template") == END, at_end).otherwise(same)).drop("h", "tw", *[f"w{i}" for i in range(gram)])


def _voted(docs: DataFrame, templates: list[Template], gram: int, broadcast_grams: int) -> DataFrame:
    """Spans that hold, with END rows: rid, doc_id, n_words, template, label, base, start, end, coverage."""
    hits = _hits(docs, _index(docs.sparkSession, templates, gram), gram, broadcast_grams)
    of = ["rid", "doc_id", "n_words", "template", "label", "base", "len", "slack", "percent"]
    votes = hits.groupBy(*of, (F.col("pos") - F.col("off")).alias("diagonal")).agg(F.collect_list("off").alias("offs"))
    along = Window.partitionBy("rid", "template").orderBy("diagonal")
    widest = max([t.slack for t in templates], default=0)
    near = F.filter(F.collect_list(F.struct("diagonal", "offs")).over(along.rangeBetween(-widest, widest)), lambda x: F.abs(x["diagonal"] - F.col("diagonal")) <= F.col("slack"))
    found = F.array_distinct(F.flatten(F.flatten(F.transform("near", lambda x: F.transform(x["offs"], lambda o: F.sequence(o, o + gram - 1))))))
    merged = votes.withColumn("near", near).select(
        *of, "diagonal", F.when(F.col("template") == END, 0).otherwise(F.size(found)).alias("n_found"),
        F.array_min(F.transform("near", lambda x: x["diagonal"] + F.array_min(x["offs"]))).alias("start"),
        F.array_max(F.transform("near", lambda x: x["diagonal"] + F.array_max(x["offs"]) + gram)).alias("end"),
    )
    held = merged.filter(F.col("n_found") * 100 >= F.col("percent") * F.col("len"))
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > F.col("slack"), F.lit(True))
    spans = held.withColumn("new", new).withColumn("span", F.sum(F.col("new").cast("int")).over(along))
    return spans.groupBy(*of, "span").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("n_found").alias("n_found")).select(
        "rid", "doc_id", "n_words", "template", "label", "base", "start", "end", F.when(F.col("template") == END, 0.0).otherwise(F.col("n_found") / F.col("len")).alias("coverage")
    )


def spans(docs: DataFrame, templates: list[Template] | None = None, gram: int = GRAM, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """The spans of docs (doc_id, text) that hold a template: doc_id, label, base, start, end (words from 0, end exclusive), coverage."""
    templates = PHRASES + NOTICES if templates is None else templates
    return _voted(docs, templates, gram, broadcast_grams).filter(F.col("template") != END).select("doc_id", "label", "base", "start", "end", "coverage")


def _listed(label: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


def judge(docs: DataFrame, templates: list[Template] | None = None, gram: int = GRAM, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest coverage)."""
    templates = PHRASES + NOTICES if templates is None else templates
    at = F.when(F.col("base"), F.col("start").cast("long"))
    found = _voted(docs, templates, gram, broadcast_grams).groupBy("rid", "doc_id", "n_words").agg(
        F.count(at).alias("n_base"), F.min(at).alias("first_word"), F.max(at).alias("last_word"),
        _listed(F.when(F.col("base"), F.col("label"))).alias("base_labels"), _listed(F.col("label")).alias("labels"), F.max("coverage").alias("score"),
    )
    return found.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
