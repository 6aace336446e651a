"""Licence spans by diagonal voting, in DataFrame operations only.

All rolling word pairs and runs of four words of a text are hashed and joined to the places of the same runs in licence
templates: base phrases and short names by pairs, passages and whole licence texts by four words. Every hit is verified on
the words themselves. Hits of one document and template with the same offset lie on one diagonal, neighbouring diagonals
(words put in or left out) merge, and a span counts as far as the verified runs cover the template's words. A base phrase
must be covered whole, on one diagonal; so must a phrase that tells versions apart.

Null and empty texts have no words and score 0; rows that repeat an id are judged each by its own text; rows without an id
are judged too. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, Window

# Phrases that must stand whole, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Opening sentences, names, and texts of widely used licences, and their labels.
PASSAGES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
    "whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the software the software is provided as "
    "is without warranty of any kind express or implied including but not limited to the warranties of merchantability "
    "fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for "
    "any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
    "connection with the software or the use or other dealings in the software": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an "
    "as is basis without warranties or conditions of any kind either express or implied see the license for the specific "
    "language governing permissions and limitations under the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license": "gpl",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more "
    "details": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission": "bsd-3",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness in no event shall the author be liable for any special direct "
    "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an "
    "action of contract negligence or other tortious action arising out of or in connection with the use or performance of "
    "this software": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original "
    "software": "zlib",
    "all rights reserved": "all-rights-reserved",
}
# Phrases that tell versions apart and must stand whole, and their labels.
VERSIONS = {
    "gnu general public license as published by the free software foundation either version 2 of the license": "gpl-2",
    "gnu general public license as published by the free software foundation either version 3 of the license": "gpl-3",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "apache license version 2 0": "apache-2",
    "creative commons attribution sharealike 4 0 international license": "cc-by-sa",
}
#: Diagonals this far apart are one span, the share of a passage's words that a span must cover, words of a passage's runs.
GAP, COVERED, RUN = 3, 0.75, 4
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_places() -> list[tuple[int, bool, float, str, int, int, int, str]]:
    """(template, base, share needed, label, words, words of a run, place, run) of every template."""
    rows, kinds = [], [(BASE, True, 1.0), (PASSAGES, False, COVERED), (VERSIONS, False, 1.0)]
    templates = [(phrase, label, base, need) for some, base, need in kinds for phrase, label in some.items()]
    for number, (phrase, label, base, need) in enumerate(templates):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", phrase)
        k = 2 if base or len(words) < RUN else RUN
        rows += [(number, base, need, label, len(words), k, i, " ".join(words[i:i + k])) for i in range(len(words) - k + 1)]
    return rows


def lowered(text: Column) -> Column:
    """A-Z in lower case. Words are compared with ASCII words alone, so other letters may change too, save the two whose
    lower case holds an ASCII letter."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    odd = text.contains("K") | text.contains("İ")
    return F.when(odd, F.translate(text, letters, letters.lower())).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _covered(places: Column) -> Column:
    """Number of template words that runs at these places cover."""
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p, p + F.col("k") - 1)))))


def spans(docs: DataFrame) -> DataFrame:
    """(id, rid, template, base, need, label, start, words, coverage) of every span, from rows (id, rid, text)."""
    spark = docs.sparkSession
    places = F.broadcast(  # the templates above, some hundreds of rows
        spark.createDataFrame(template_places(), "template int, base boolean, need double, label string, length int, k int, place int, run string")
        .withColumn("w", F.split("run", " "))
        .withColumn("h", F.xxhash64(F.element_at("w", 1), F.element_at("w", 2)))
        .withColumn("h", F.when(F.col("k") == RUN, F.xxhash64("h", F.xxhash64(F.element_at("w", 3), F.try_element_at("w", F.lit(4)))))
                    .otherwise(F.col("h"))).drop("w"))
    words = docs.select("id", "rid", words_of(F.col("text")).alias("w")).where(F.size("w") > 1)
    pairs = words.withColumn("p", F.zip_with("w", F.slice("w", 2, F.size("w") - 1), lambda a, b: F.xxhash64(a, b)))
    runs = F.concat("p", F.zip_with("p", F.slice("p", 3, F.size("p")), lambda a, b: F.xxhash64(a, b)))
    at = F.col("at") % F.size("w")
    found = pairs.select("id", "rid", "w", F.posexplode(runs).alias("at", "h")).join(places, "h")
    # A hash names the run; the words decide.
    hits = found.where(F.concat_ws(" ", F.slice("w", at + 1, F.col("k"))) == F.col("run")).withColumn("at", at).drop("w", "h", "run")
    template = ["id", "rid", "template", "base", "need", "label", "length", "k"]
    diagonals = hits.groupBy(*template, (F.col("at") - F.col("place")).alias("diagonal")) \
        .agg(F.collect_set("place").alias("places"), F.min("at").alias("low"), F.max("at").alias("high"))
    out = ["id", "rid", "template", "base", "need", "label", "start", "words", "coverage"]
    by_template = Window.partitionBy("id", "rid", "template").orderBy("diagonal")
    apart = F.when(F.col("need") == 1, 0).otherwise(GAP)
    fresh = (F.col("diagonal") - F.lag("diagonal").over(by_template) > apart).cast("int")
    return diagonals.withColumn("fresh", F.coalesce(fresh, F.lit(1))) \
        .withColumn("span", F.sum("fresh").over(by_template)) \
        .groupBy(*template, "span") \
        .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min("low").alias("start"), F.max("high").alias("end")) \
        .withColumn("words", F.col("end") - F.col("start") + F.col("k")) \
        .withColumn("coverage", _covered(F.col("places")) / F.col("length")).select(*out) \
        .where("not base or coverage = 1")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("rid"),
                       F.col(text_col).alias("text"))
    sure = F.col("base") | (F.col("coverage") >= F.col("need"))
    found = spans(rows).groupBy("id", "rid").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set(F.when(sure, F.col("label")))), ",").alias("labels"),
        F.max("coverage").alias("score")).withColumnsRenamed({"id": "found_id", "rid": "found_rid"})
    counted = rows.select("id", "rid", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    same = (F.col("rid") == F.col("found_rid")) & F.col("id").eqNullSafe(F.col("found_id"))
    return counted.join(found, same, "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def _sql() -> str:
    """The same scan in SQL, over runs of words instead of their hashes."""
    values = ", ".join(f"({t}, {str(base).lower()}, {need}::DOUBLE, '{label}', {length}, {k}, {place}, '{run}')"
                       for t, base, need, label, length, k, place, run in template_places())
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH places(template, base, need, label, length, k, place, run) AS (VALUES {values}),
listed AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
positions AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM listed),
runs AS (
  SELECT doc_id, i - 1 AS pos, 2 AS k, w[i] || ' ' || w[i + 1] AS run FROM positions
  UNION ALL
  SELECT doc_id, i - 1, {RUN}, array_to_string(w[i:i + {RUN - 1}], ' ') FROM positions WHERE i <= len(w) - {RUN - 1}),
hits AS (SELECT doc_id, template, base, need, label, length, k, place, pos FROM runs JOIN places USING (k, run)),
diagonals AS (
  SELECT doc_id, template, base, need, label, length, k, pos - place AS diagonal, list(DISTINCT place) AS places, min(pos) AS low
  FROM hits GROUP BY ALL),
fresh AS (
  SELECT *, coalesce(CAST(diagonal - lag(diagonal) OVER d > CASE WHEN need = 1 THEN 0 ELSE {GAP} END AS INT), 1) AS fresh
  FROM diagonals WHERE NOT base WINDOW d AS (PARTITION BY doc_id, template ORDER BY diagonal)),
merging AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM fresh),
merged AS (
  SELECT doc_id, base, need, label, length, k, min(low) AS start, list_distinct(flatten(list(places))) AS places
  FROM merging GROUP BY doc_id, template, base, need, label, length, k, span),
spans AS (
  SELECT doc_id, base, need, label, diagonal AS start, 1.0::DOUBLE AS coverage FROM diagonals WHERE base AND len(places) = length - 1
  UNION ALL
  SELECT doc_id, base, need, label, start,
         len(list_distinct(flatten(list_transform(places, lambda p: range(p, p + k))))) / length FROM merged),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
         max(start) FILTER (base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (base OR coverage >= need)), ',') AS labels,
         max(coverage) AS score FROM spans GROUP BY doc_id)
SELECT l.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM listed l LEFT JOIN found f ON l.doc_id = f.doc_id"""


SQL = _sql()
