"""License scan: a positional index of rare license words.

Templates are word sequences of known notices with a mandatory key phrase; the base phrases are
templates that are nothing but their key phrase. The index holds, for the words of the key phrases,
their IDF, counted on the table itself, and their postings: the templates and the places in them. Of
each file the license words are taken that it has; they leave the templates whose key phrase it can
hold, and the rarest word of each, the highest by IDF, is looked up in the file, in one pass for all
templates. Its places, moved back by the posting's, propose starts; the second rarest word must stand
at the place that follows from its own posting, and then the key phrase word for word. A hit scores
the IDF share of template words at their places, so a base phrase always scores 1.

Base phrases and labels: see BASE. Labels of longer notices are added beside them. DataFrame
expressions only; a document never leaves its row, so nothing is shuffled but one count a word, and
the plan does not grow with the templates.

Nulls and edges: a null text is empty and has no words; null ids are carried; each row gives one
row, repeated or not; texts are read whole, whatever their length, in time that grows with the words
and the hits; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words)


# Base phrases with their labels, then notices with their key phrases and labels.
BASE = tuple(
    Template(label, phrase, phrase)
    for phrase, label in (
        ("gnu general public license", "gpl"),
        ("apache license", "apache"),
        ("cc by", "cc-by"),
        ("mit license", "mit"),
    )
)
NOTICES = (
    Template("agpl", "gnu affero general public license", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("apache-text", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "unless required by applicable law or agreed to in writing"),
    Template("artistic", "the artistic license 2 0", "artistic license 2 0"),
    Template("boost", "boost software license version 1 0", "boost software license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    Template("copyright", "all rights reserved", "all rights reserved"),
    Template("epl", "this program is made available under the terms of the eclipse public license", "eclipse public license"),
    Template("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gnu free documentation license"),
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license"),
    Template("gpl-program", "this program is free software you can redistribute it and or modify it", "this program is free software"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("lgpl", "gnu lesser general public license", "gnu lesser general public license"),
    Template("mit-notice", "released under the mit license", "under the mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors be held liable"),
)


def _idf(tokens: Column, docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of the (fixed) vocabulary over all rows."""
    listed = F.array(*[F.lit(w) for w in vocabulary])
    # A word of its own that each row holds counts the rows.
    rows = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(tokens, listed))).alias("w"))
    found = {r["w"]: r["n"] for r in rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = found.get("", 0)
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) + 1 for w in vocabulary}


def _index(templates: list[Template], idf: dict[str, float]) -> Column:
    """The templates as an array: label, base, words with their weights, the key phrase, its place and
    the postings of its two rarest words."""
    entries = []
    for t in templates:
        rare = sorted({*t.key_words}, key=lambda x: (-idf[x], x))
        places = lambda word: [t.key_at + i for i, x in enumerate(t.key_words) if x == word]  # noqa: B023, E731
        total = sum(idf[x] for x in t.words)
        entries.append(
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t in BASE).alias("base"),
                F.array(*map(F.lit, t.words)).alias("words"),
                F.array(*[F.lit(idf[x] / total) for x in t.words]).alias("weights"),
                F.array(*map(F.lit, t.key_words)).alias("key"),
                F.lit(t.key_at).alias("key_at"),
                F.lit(rare[0]).alias("rarest"),
                F.array(*map(F.lit, places(rare[0]))).alias("places"),
                F.lit(rare[min(1, len(rare) - 1)]).alias("second"),
                F.array(*map(F.lit, places(rare[min(1, len(rare) - 1)]))).alias("second_places"),
            )
        )
    return F.array(*entries)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row: id_col, n_words and hits, an array of start, label, base, n_words, score."""
    tokens = F.array_remove(
        F.split(common.fold_ascii(F.coalesce(F.col(text_col), F.lit(""))), WORD_BREAK), ""
    )
    templates = [*BASE, *NOTICES]
    idf = _idf(tokens, docs, sorted({w for t in templates for w in t.words}))
    keys = F.array(*[F.lit(w) for w in sorted({w for t in templates for w in t.key_words})])
    w = F.col("w")
    # Step by step in columns, as what stands in a lambda is computed anew for each element.
    split = docs.select(F.col(id_col).alias("id"), tokens.alias("w")).withColumn("held", F.array_intersect(w, keys))
    possible = F.filter(_index(templates, idf), lambda t: F.forall(t["key"], lambda x: F.array_contains("held", x)))
    listed = split.withColumn("possible", F.when(F.size("held") > 0, possible))
    wanted = listed.withColumn("rarest", F.array_distinct(F.transform("possible", lambda t: t["rarest"])))
    found = F.filter(common.upto(F.size(w)), lambda i: F.array_contains("rarest", F.get(w, i)))
    seen = wanted.withColumn("at", F.when(F.size("rarest") > 0, found))
    return seen.select(
        F.col("id").alias(id_col),
        F.size(w).cast("long").alias("n_words"),
        F.coalesce(F.array_sort(F.flatten(F.transform("possible", _hits))), F.array().cast(HITS)).alias("hits"),
    )


HITS = "array<struct<start:int,label:string,base:boolean,n_words:int,score:double>>"


def _hits(t: Column) -> Column:
    """Hits of one template in the words `w`, from the places `at` of all files' rarest words."""
    w = F.col("w")
    mine = F.filter("at", lambda i: F.get(w, i) == t["rarest"])
    starts = F.array_distinct(F.flatten(F.transform(t["places"], lambda o: F.transform(mine, lambda i: i - o))))
    first = lambda s: s + t["key_at"]
    agrees = lambda s: F.exists(t["second_places"], lambda o: F.get(w, s + o) == t["second"])
    verbatim = lambda s: F.slice(w, first(s) + 1, F.size(t["key"])) == t["key"]
    holds = F.filter(starts, lambda s: F.when((first(s) >= 0) & agrees(s), verbatim(s)).otherwise(F.lit(False)))

    def share(s: Column) -> Column:
        parts = F.zip_with(
            F.transform(t["words"], lambda x, j: F.coalesce(F.get(w, s + j) == x, F.lit(False))),
            t["weights"],
            lambda here, weight: F.when(here, weight).otherwise(0.0),
        )
        return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)

    return F.transform(
        holds,
        lambda s: F.struct(
            s.alias("start"),
            t["label"].alias("label"),
            t["base"].alias("base"),
            F.size(t["words"]).alias("n_words"),
            F.when(t["base"], 1.0).otherwise(F.least(F.lit(1.0), F.round(share(s), 9))).alias("score"),
        ),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: words, places of the base phrases, labels and the best score."""
    found = scan(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("hits", lambda h: h["base"])
    labels = lambda hits: F.array_join(
        F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ","
    )
    starts = F.transform(base, lambda h: h["start"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h["score"])), F.lit(0.0)).alias("score"),
    )


def _listed(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def op6_sql() -> str:
    """The same in DuckDB: every place is tried, and no index is kept."""
    templates = ",\n    ".join(
        f"('{t.label}', {str(t in BASE).lower()}, {_listed(t.words)}, {_listed(t.key_words)}, {t.key_at})"
        for t in (*BASE, *NOTICES)
    )
    return rf"""
WITH docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '{WORD_BREAK}'), lambda x: x <> '') AS w
  FROM documents
), template(label, base, words, key, key_at) AS (
  VALUES {templates}
), vocabulary AS (
  SELECT DISTINCT unnest(words) AS word FROM template
), frequency AS (
  SELECT word, count(DISTINCT rid) AS df
  FROM (SELECT rid, unnest(w) AS word FROM (SELECT w, row_number() OVER () AS rid FROM docs)) GROUP BY word
), idf AS (
  SELECT word, ln((1.0 + (SELECT count(*) FROM docs)) / (1.0 + coalesce(df, 0))) + 1 AS idf
  FROM vocabulary LEFT JOIN frequency USING (word)
), place AS (
  SELECT doc_id, w, t.*, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i:i + len(key) - 1] = key)) - key_at AS start
  FROM docs, (SELECT label, base, words, key, key_at, list(weight ORDER BY nth) AS weights
              FROM (SELECT t.label, t.base, t.words, t.key, t.key_at, i.idf AS weight, t.nth
                    FROM (SELECT *, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS nth FROM template) t
                    JOIN idf i ON i.word = t.word)
              GROUP BY label, base, words, key, key_at) t
  WHERE list_has_all(w, key)
), hit AS (
  SELECT doc_id, label, base, start - 1 AS start,
         CASE WHEN base THEN 1.0 ELSE least(1.0, round(list_sum(list_transform(range(1, len(words) + 1),
           lambda j: CASE WHEN start + j - 1 >= 1 AND w[start + j - 1] = words[j] THEN weights[j] / list_sum(weights) ELSE 0.0 END)), 9)) END AS score
  FROM place
), told AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
         max(start) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
  FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM docs LEFT JOIN told USING (doc_id)
"""
