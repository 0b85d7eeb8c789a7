"""Benchmark decontamination: find item-sized windows of documents that nearly equal an item.

Texts are A-Z lower-cased words, shingles are five words (an item with fewer words is one shingle
of all its words). A document is contaminated by an item if one of its windows of the item's
length has a weighted Jaccard similarity of at least 0.75 with it, where a shingle weighs as often
as it occurs.

1. Lookup. A window above the threshold holds three quarters of the item's shingles, so it holds one
   of any set of them that weighs more than the rest. Of each item the shingles that the fewest items
   have are taken, just enough, and looked up in all documents.
2. Verification of the documents and items found. A shingle of the item at place p of the document
   counts for the windows that start from p - (the item's shingles) + 1 to p, later than the place
   where its surplus copy stands, if it occurs more often than in the item. Summing those ranges
   gives the shared weight of all windows at once, exactly, in time linear in the places, and with it
   the best window of each document and item. Every pair is found by its shared shingles, so no index
   of fingerprints is searched and no pair is dropped by their distance.
3. Fingerprints. Each best window and item gets a 64-bit SimHash of its weighted shingles; the bits
   in which the two differ are reported beside the similarity.

DataFrame expressions only. The item shingles are broadcast if they are few enough (checked), else
joined by shuffle; so are the keys of the documents found. Nulls and edges: null or empty texts and
items match nothing; null ids are carried along; repeated rows of a document or item are one;
different texts under one id, or under the null id, are compared each by itself and give one row with
the best window of them; items and documents may be of any length; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import common

BITS = 64
#: Item shingles that may be sent to every executor (about 60 bytes each), and keys of documents
#: that were found with their items (about 100); beyond, a shuffle join.
BROADCAST_SHINGLES = 200_000
BROADCAST_DOCS = 100_000

OWNER = ["doc", "item"]


def _row(id_col: str, text_col: str) -> Column:
    """A row's own key, never null: its id and the hash of its text."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"))


def _sized(spark: SparkSession, items: DataFrame) -> DataFrame:
    """Shingles of items: item, n (words), m (shingles), k (words a shingle), h, tf."""
    split = items.select(
        F.col("item"), common.words(common.fold_ascii(F.col("text"))).alias("w")
    ).select("item", "w", F.size("w").alias("n"))
    parts = [
        split.where("n >= 5" if k == common.SHINGLE_WORDS else f"n = {k}").select(
            "item", "n", F.lit(k).alias("k"), F.explode(common.shingle_hashes(F.col("w"), k)).alias("h")
        )
        for k in range(1, common.SHINGLE_WORDS + 1)
    ]
    every = reduce(DataFrame.unionByName, parts)
    counted = every.groupBy("item", "n", "k", "h").agg(F.count(F.lit(1)).alias("tf"))
    return counted.withColumn("m", (F.col("n") - F.col("k") + 1).cast("long"))


def _fingerprints(bags: DataFrame, key: list[str]) -> DataFrame:
    """SimHash of weighted shingles (h, tf) by key: the bits that more than half the weight sets."""
    ones = [
        F.sum(F.shiftrightunsigned("h", j).bitwiseAND(1) * F.col("tf")).alias(f"b{j}")
        for j in range(BITS)
    ]
    votes = bags.groupBy(*key).agg(F.sum("tf").alias("weight"), *ones)
    bits = [
        F.when(F.col(f"b{j}") * 2 > F.col("weight"), F.shiftleft(F.lit(1).cast("long"), j)).otherwise(0)
        for j in range(BITS)
    ]
    return votes.select(*key, "weight", reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fp"))


def _lookup(bags: DataFrame) -> DataFrame:
    """Of each item its rarest shingles, enough that every window above the threshold has one."""
    need = F.ceil(F.col("m") * common.NEAR_PERCENT / 100)
    rarity = bags.groupBy("k", "h").agg(F.count(F.lit(1)).alias("items"))
    in_item = Window.partitionBy("item").orderBy("items", "h")
    before = F.sum("tf").over(in_item) - F.col("tf")
    ranked = bags.join(rarity, ["k", "h"]).withColumn("before", before)
    return ranked.where(F.col("before") <= F.col("m") - need).select("k", "h", "item")


def _sliding(hits: DataFrame) -> DataFrame:
    """doc, item, k, m, weight (shingles of a window), start and shared, of the best window each.

    `hits` are the places `pos` of an item's shingles `h` in a document of `words` words.
    """
    pair = [*OWNER, "k", "m", "n", "words"]
    last = F.greatest(F.lit(0), F.col("words") - F.col("n"))
    places = hits.groupBy(*pair, "h", "tf").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    # The windows, by their starts, for which a place counts.
    ranges = F.transform(
        "at",
        lambda p, i: F.struct(
            F.greatest(
                F.when(i >= F.col("tf"), F.get("at", (i - F.col("tf")).cast("int")) + 1).otherwise(0),
                (p - F.col("m") + 1).cast("int"),
                F.lit(0),
            ).alias("low"),
            F.least(p, last).alias("high"),
        ),
    )
    step = lambda s, d: F.struct(s.alias("s"), F.lit(d).alias("d"))
    both = F.explode(F.array(step(F.col("r.low"), 1), step(F.col("r.high") + 1, -1)))
    counted = F.explode(F.filter(ranges, lambda r: r["low"] <= r["high"])).alias("r")
    steps = places.select(*pair, counted).select(*pair, both.alias("x"))
    changes = steps.groupBy(*pair, F.col("x.s").alias("s")).agg(F.sum("x.d").alias("d"))
    in_order = Window.partitionBy(*OWNER).orderBy("s")
    swept = changes.select(
        *OWNER, "k", "m",
        F.least(F.col("m"), F.col("words") - F.col("k") + 1).alias("weight"),
        # The last start of a stretch begins with a shingle of the item, or is the document's last.
        (F.lead("s").over(in_order) - 1).alias("start"),
        F.sum("d").over(in_order).alias("shared"),
    )
    best = F.max_by(F.struct("start", "shared"), F.struct("shared", -F.col("start")))
    return swept.groupBy(*OWNER, "k", "m", "weight").agg(best.alias("b")).select(*OWNER, "k", "m", "weight", "b.*")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_shingles: int = BROADCAST_SHINGLES,
    broadcast_docs: int = BROADCAST_DOCS,
) -> DataFrame:
    """One row for each document and item that nearly occurs in it, with its best window.

    Columns: id_col, item_col, start (word), n_words, shared and total (shingle weights),
    distance (bits).
    """
    spark = docs.sparkSession
    texts = items.select(
        _row(item_col, item_text_col).alias("item"), F.col(item_text_col).alias("text")
    ).distinct()
    bags = common.checkpointed(_sized(spark, texts))
    few = bags.count() <= broadcast_shingles
    small = F.broadcast if few else lambda df: df
    seeds = common.checkpointed(_lookup(bags))
    sizes = sorted(r["k"] for r in bags.select("k").distinct().collect())  # five values at most
    split = docs.select(
        _row(id_col, text_col).alias("doc"), common.words(common.fold_ascii(F.col(text_col))).alias("w")
    )
    found = [
        split.select("doc", F.explode(common.shingle_hashes(F.col("w"), k)).alias("h"))
        .join(small(seeds.where(F.col("k") == k).select("h", "item")), "h")
        .select("doc", "item")
        for k in sizes
    ] or [split.select("doc", F.lit(None).cast(texts.schema["item"].dataType).alias("item")).where(F.lit(False))]
    candidates = common.checkpointed(
        reduce(DataFrame.unionByName, found).groupBy("doc").agg(F.collect_set("item").alias("items"))
    )
    if candidates.count() <= broadcast_docs:
        candidates = F.broadcast(candidates)
    kept = common.checkpointed(split.join(candidates, "doc"))
    hits = [
        kept.select("doc", "items", F.size("w").alias("words"), F.posexplode(common.shingle_hashes(F.col("w"), k)).alias("pos", "h"))
        .join(small(bags.where(F.col("k") == k)), "h")
        .where(F.array_contains("items", F.col("item")))
        .drop("items")
        for k in sizes
    ] or [kept.select("doc", F.size("w").alias("words"), F.lit(0).alias("pos")).join(bags, F.lit(False))]
    total = F.col("weight") + F.col("m") - F.col("shared")
    close = common.checkpointed(
        _sliding(reduce(DataFrame.unionByName, hits))
        .withColumn("total", total)
        .where(100 * F.col("shared") >= common.NEAR_PERCENT * F.col("total"))
    )

    size = F.col("m") + F.col("k") - 1
    windows = (
        close.join(kept.select("doc", "w").dropDuplicates(["doc"]), "doc")
        .select(*OWNER, "k", F.slice("w", F.col("start") + 1, size.cast("int")).alias("win"))
    )
    hashes = reduce(
        lambda rest, k: F.when(F.col("k") == k, common.shingle_hashes(F.col("win"), k)).otherwise(rest),
        range(1, common.SHINGLE_WORDS + 1),
        F.array().cast("array<bigint>"),
    )
    cut = windows.select(*OWNER, F.size("win").alias("n_words"), F.explode(hashes).alias("h"))
    prints = _fingerprints(cut.groupBy(*OWNER, "n_words", "h").agg(F.count(F.lit(1)).alias("tf")), [*OWNER, "n_words"])
    item_fp = _fingerprints(bags, ["item"]).select("item", F.col("fp").alias("item_fp"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))).alias("distance")
    told = close.join(prints, OWNER).join(item_fp, "item")
    # Best similarity first; similarities are compared as fractions rounded in the same way.
    better = F.struct(F.col("shared") / F.col("total"), -F.col("start"))
    best = F.struct("start", "n_words", "shared", "total", distance)
    return (
        told.groupBy(F.col("doc.id").alias("doc"), F.col("item.id").alias("item"))
        .agg(F.max_by(best, better).alias("b"))
        .select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "b.*")
    )


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that nearly occurs in it."""
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, common.read(spark, sf_dir, "benchmark").select("item_id", "text"))
