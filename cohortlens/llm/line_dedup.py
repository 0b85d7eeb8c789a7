"""Line dedup: drop repeated runs of lines, found as overlapping three-line windows.

Every window of three consecutive lines that are not blank is hashed. A window that also starts
earlier, in a document with a smaller id or further up in the same document, is a repeat; the
positions that repeats cover are merged and their lines dropped. Blank lines neither form nor
break windows and stay. Built from DataFrame expressions only.

Nulls and edges: a null text has no lines and stays null; a text with fewer than three lines that
are not blank loses nothing; a null id counts as smaller than any other; rows that agree in id and
text are one document and give the same result; input columns stay as they are and come first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common

WINDOW_LINES = 3


#: Columns that the operator adds; columns of the input with these names give way.
TOLD = ("kept_text", "n_lines", "n_removed", "n_spans")


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_LINES
) -> DataFrame:
    """All rows of `docs`, with `kept_text`, `n_lines`, `n_removed` and `n_spans` added.

    Window hashes are 128 bits. They are counted after a partial aggregation, so a window that a
    third of all documents share costs one row a task, and joined back where AQE can split it.
    """
    # The input travels as one struct, so its column names cannot clash with the ones made here.
    base = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("th"),
        F.split(F.col(text_col), "\n", -1).alias("lines"),
    )
    numbered = F.transform("lines", lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    filled = F.filter(numbered, lambda x: F.length(F.regexp_replace(x["line"], r"\s+", "")) > 0)
    slim = base.select("id", "th", filled.alias("content"))
    line = lambda i, k: F.get(F.col("content"), i + k)["line"]
    hashed = F.transform(
        common.upto(F.size("content") - (window - 1)),
        lambda i: F.struct(
            i.alias("pos"),
            F.xxhash64(*[line(i, k) for k in range(window)]).alias("h1"),
            F.xxhash64(F.lit(1), *[line(i, k) for k in reversed(range(window))]).alias("h2"),
        ),
    )
    windows = slim.select("id", "th", F.explode(hashed).alias("w")).select("id", "th", "w.*")
    place = F.struct("id", "th", "pos")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("h1", "h2", "first")
    )
    covered = (
        windows.join(firsts, ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("starts"))
    )
    b, c = base.alias("b"), covered.alias("c")
    joined = b.join(
        c, F.col("b.id").eqNullSafe(F.col("c.id")) & (F.col("b.th") == F.col("c.th")), "left"
    ).select("b.row", "b.lines", "c.starts")
    hit = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (window - 1))))
    )
    merged = joined.withColumn("hit", F.coalesce(hit, F.array().cast("array<int>"))).withColumn(
        "content", F.when(F.size("hit") > 0, filled)
    )
    gone = F.transform("hit", lambda p: F.get(F.col("content"), p)["at"])
    stay = F.array_except(common.upto(F.size("lines")), gone)
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    return merged.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c not in TOLD],
        F.when(F.size("hit") > 0, kept).otherwise(F.col("row")[text_col]).alias("kept_text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.size("hit").cast("long").alias("n_removed"),
        F.size(F.array_except("hit", F.transform("hit", lambda p: p + 1))).cast("long").alias("n_spans"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, lines dropped, merged runs dropped, and a digest of what is left."""
    found = drop_repeats(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_removed", "n_spans", F.md5("kept_text").alias("kept_md5")
    )


OP2_SQL = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, i AS at, lines[i] AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
  WHERE length(regexp_replace(lines[i], '\s+', '', 'g')) > 0
), triple AS (
  SELECT a.doc_id, a.pos, a.line AS l1, b.line AS l2, c.line AS l3
  FROM line a
  JOIN line b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1
  JOIN line c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2
), ranked AS (
  SELECT doc_id, pos,
         row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS rk
  FROM triple
), hit AS (
  SELECT DISTINCT doc_id, pos + k AS pos
  FROM ranked, (VALUES (0), (1), (2)) AS s(k) WHERE rk > 1
), gone AS (
  SELECT h.doc_id, h.pos, l.at,
         CASE WHEN p.pos IS NULL THEN 1 ELSE 0 END AS opens
  FROM hit h
  JOIN line l ON l.doc_id = h.doc_id AND l.pos = h.pos
  LEFT JOIN hit p ON p.doc_id = h.doc_id AND p.pos = h.pos - 1
), counts AS (
  SELECT doc_id, count(*) AS n_removed, sum(opens) AS n_spans FROM gone GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, coalesce(string_agg(d.l, chr(10) ORDER BY d.i), '') AS kept_text
  FROM (SELECT doc_id, unnest(lines) AS l, unnest(range(1, len(lines) + 1)) AS i FROM docs) d
  LEFT JOIN gone g ON g.doc_id = d.doc_id AND g.at = d.i
  WHERE g.doc_id IS NULL
  GROUP BY d.doc_id
)
SELECT d.doc_id,
       CAST(coalesce(len(d.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.kept_text, '')) END AS kept_md5
FROM docs d
LEFT JOIN counts c ON c.doc_id = d.doc_id
LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
