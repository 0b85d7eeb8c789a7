"""From raw documents to packed training sequences.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a frame that
is written as Parquet and read again as the next one's docs. All but the last return the columns
of `documents`. SQL cannot express the classifier and the tokenizer, so ORACLE_SQL is None.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common, decontaminate, line_dedup, ngram_join, packing, quality
from cohortlens.session import prepare, remove_path, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the classifier keep.

    The classifier learns from the labelled rows of the documents that arrive here. Null and empty
    texts fail the base rules; rows are judged one by one, so a null or repeated id changes nothing;
    without usable labels the base rules alone decide; no rows give none.
    """
    model = quality.train(docs, common.read(spark, sf_dir, "labels"))
    judged = quality.judge(docs.select(*COLUMNS), model, COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones hold; those left without a word go.

    A null text stays as it is, and so does a text that loses nothing, even an empty one; a null id
    counts as the first; equal rows under one id lose the same lines; n_chars follows the text.
    """
    cut = line_dedup.drop_repeats(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    return (
        cut.where(~changed | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("n_chars", F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")))
        .withColumn("text", F.col("kept_text"))
        .select(*COLUMNS)
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id; the first one where ids repeat.

    Rows are compared one by one, whatever their ids: of equal rows under one id one stays, and so
    does one of equal rows without an id; a row with an id goes before one without. Null and empty
    texts have no copies and stay.
    """
    # Files are split alike in every scan of the stage's input, so rows keep their numbers.
    rows = docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id())
    groups = ngram_join.similar(rows.select("row", "text"), "row")
    placed = groups.join(rows.select("row", "doc_id"), "row")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    first = placed.groupBy("component_id").agg(F.min(order).alias("first")).select("first.row")
    later = common.checkpointed(groups.select("row").join(first, "row", "left_anti"))
    return rows.join(later, "row", "left_anti").select(*COLUMNS)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item nearly occurs; each row is judged by its own text.

    Null and empty texts hold no item and stay; null and repeated ids change nothing.
    """
    items = common.read(spark, sf_dir, "benchmark").select("item_id", "text")
    keyed = docs.select(*COLUMNS, F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("row"))
    found = decontaminate.contaminated(keyed.select("row", "text"), items, id_col="row").select("row").distinct()
    return keyed.join(found, "row", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of what is left, with a checksum of each piece's ids beside them.

    A null text is an empty one, of its closing id alone; null and repeated ids are carried along.
    """
    prepare(spark)
    return packing.pack(docs, packing.tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_items),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and reread.

    A stage's folder goes once the next one has been written; the last stays for the reader.
    """
    prepare(spark)
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        if done is not None:
            remove_path(spark, done)
        docs, done = spark.read.parquet(out), out
    return docs
