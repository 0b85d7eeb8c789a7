"""Ranked lexical search: the best documents for each item of a query set, by integer term weights.

Terms are runs of ASCII letters and digits and of all other characters above U+007F, A-Z lower-cased.
With N documents that have a term, L terms in all, n terms in a document, df documents holding a term
and tf its times in the document:

    w = floor(1000 ln((2N + 2) / (2 df + 1)))      m = 100 - 25 + 25 n N div L
    score = sum over the item's terms, repeats included, of w (10^9 tf div (1000 tf + 12 m))

Method, bag deduplication: a document is restricted to the words of the items, since others cannot
change its score. Documents with the same restricted word counts and the same m score alike for every
item; they are found by hash, verified by the counts themselves, and scored once. The best classes of
an item, by score and then by smallest id, hold its best documents, so only they are expanded into
members, in the order of their ids.

Scale: every document is read once in full for each block of items; a block holds about
BLOCK_BYTES of item texts, so what is broadcast (its words and postings) is bounded whatever the number
of items. Counts N, L and df are summed by Spark over all documents. Of a class only the `limit`
smallest ids can be needed; Spark's window group limit drops the others before the shuffle, so a class
of any size sends `limit` rows a task. Tasks score their classes in pieces of a bounded number of
(class, item) cells and keep `limit` classes an item; what they tell is ranked by item.

Nulls and edges: a null text, an empty one and one without a term count in neither N nor L and are
never found; items without a term, or with a null text, find nothing; each row is an item, and a
document, of its own, so a repeated item id repeats its answer; a null document id is the smallest;
texts are read whole, whatever their length; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import common

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LIMIT = 20
#: Bytes of item texts in a block.
BLOCK_BYTES = 4_000_000
#: Cells of the tables that a task fills at a time.
CELLS = 4_000_000


def terms(text: bytes | None) -> list[bytes]:
    return TERM.findall(text.lower()) if text else []


def _restricted(vocabulary: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.value
        for batch in batches:
            sizes, bags = [], []
            for text in batch.column("text").cast(pa.large_binary()):
                found = terms(text.as_py())
                times = sorted(Counter(filter(None, map(place.get, found))).items())
                sizes.append(len(found))
                bags.append(np.array(times, "<u4").T.tobytes() if times else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())], ["doc", "n", "bag"]
            )

    return run


def _frequencies(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(words + 1, np.int64)
        for batch in batches:
            for bag in batch.column("bag").to_pylist():
                both = np.frombuffer(bag, "<u4")
                total[both[: len(both) // 2]] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], ["word", "df"])

    return run


def _postings(items: list[tuple], place: dict[bytes, int], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word, from `start[word]`, the items that hold it and its weight in each."""
    rows = [(place[t], i, k) for i, (_, text) in enumerate(items) for t, k in Counter(terms(text)).items()]
    word, item, times = np.array(sorted(rows), np.int64).reshape(-1, 3).T
    start = np.searchsorted(word, np.arange(len(weight) + 1))
    return start, item, times * weight[word]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of given lengths: the run of each place, and its place in the run."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _scores(bags: list[bytes], m: np.ndarray, start: np.ndarray, item: np.ndarray, worth: np.ndarray, items: int) -> np.ndarray:
    """Scores of some classes (rows) for all items of a block (columns)."""
    both = [np.frombuffer(bag, "<u4") for bag in bags]
    counts = np.array([len(x) // 2 for x in both])
    word = np.concatenate([x[: len(x) // 2] for x in both]).astype(np.int64)
    times = np.concatenate([x[len(x) // 2 :] for x in both]).astype(np.int64)
    owner, _ = _spread(counts)
    impact = 1_000_000_000 * times // (1_000 * times + 12 * m[owner])
    total = np.zeros(len(bags) * items, np.int64)
    often = start[word + 1] - start[word]
    cuts = np.searchsorted(np.cumsum(often), np.arange(CELLS, often.sum() + CELLS, CELLS))
    low = 0
    for high in (cuts + 1).tolist():
        which, at = _spread(often[low:high])
        which += low
        posting = start[word[which]] + at
        np.add.at(total, owner[which] * items + item[posting], impact[which] * worth[posting])
        low = high
    return total.reshape(len(bags), items)


def _best(found: pa.Table, limit: int) -> pa.Table:
    """The best classes of each item, by score and then by smallest id, null first."""
    item, score = found["item"].to_numpy(), found["score"].to_numpy()
    named, lead = found["named"].to_numpy(), found["lead"].to_numpy()
    order = np.lexsort((lead, named, -score, item))
    ranked = item[order]
    place = np.arange(len(ranked)) - np.searchsorted(ranked, ranked)
    return found.take(pa.array(order[place < limit]))


def _score_classes(told: Broadcast, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, item, worth, items = told.value
        best = None
        step = max(1, CELLS // max(1, items))
        for whole in batches:
            for low in range(0, whole.num_rows, step):
                batch = whole.slice(low, step)
                score = _scores(batch.column("bag").to_pylist(), batch.column("m").to_numpy(), start, item, worth, items)
                # The scores an item's classes must reach, from the classes at hand alone.
                floor = np.ones(items, np.int64)
                if len(score) > limit:
                    floor = np.maximum(floor, np.partition(score, len(score) - limit, axis=0)[len(score) - limit])
                row, column = np.nonzero(score >= floor)
                rows = pa.array(row)
                found = pa.table(
                    [
                        pa.array(column.astype(np.int64)),
                        pa.array(score[row, column]),
                        *[batch.column(c).take(rows) for c in ("named", "lead", "members")],
                    ],
                    names=["item", "score", "named", "lead", "members"],
                )
                best = _best(found if best is None else pa.concat_tables([best, found]), limit)
        if best is not None:
            yield from best.combine_chunks().to_batches()

    return run


def _block(docs: DataFrame, items: list[tuple], limit: int) -> DataFrame:
    """item (its place among `items`), rank, doc and score."""
    spark = docs.sparkSession
    known = sorted({t for _, text in items for t in terms(text)})
    # 0 is no word's number, so that a lookup tells it from a word that no item has.
    place = {t: i for i, t in enumerate(known, 1)}
    vocabulary = spark.sparkContext.broadcast(place)
    kind = docs.schema["doc"].dataType.simpleString()
    rows = common.checkpointed(docs.mapInArrow(_restricted(vocabulary), f"doc {kind}, n long, bag binary"))
    size = rows.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    held = rows.where("bag IS NOT NULL")
    df = np.zeros(len(place) + 1, np.int64)
    counted = held.select("bag").mapInArrow(_frequencies(len(place)), "word long, df long")
    for word, times in counted.groupBy("word").agg(F.sum("df")).collect():  # words of a block
        df[word] = times
    weight = np.array([math.floor(1000 * math.log((2 * size.docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    told = spark.sparkContext.broadcast((*_postings(items, place, weight), len(items)))

    m = F.lit(100 - 25) + F.expr(f"25 * n * {size.docs}L div {size.terms or 1}L")
    bags = held.select("doc", "bag", m.alias("m")).withColumn("hash", F.xxhash64("bag", "m"))
    same = ["hash", "bag", "m"]
    first = F.row_number().over(Window.partitionBy(*same).orderBy(F.col("doc").asc_nulls_first()))
    classes = (
        bags.withColumn("place", first)
        .where(F.col("place") <= limit)
        .groupBy(*same)
        .agg(F.sort_array(F.collect_list(F.struct("place", "doc"))).alias("members"))
        .select("bag", "m", "members", F.col("members")[0]["doc"].alias("lead"))
        .withColumn("named", F.col("lead").isNotNull().cast("int"))
    )
    lead = F.coalesce("lead", F.lit(0)).cast("long").alias("lead")
    members = f"array<struct<place:int,doc:{kind}>>"
    scored = classes.select("bag", "m", "members", "named", lead).mapInArrow(
        _score_classes(told, limit), f"item long, score long, named int, lead long, members {members}"
    )
    by_class = Window.partitionBy("item").orderBy(F.desc("score"), "named", "lead")
    by_doc = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_first())
    return (
        scored.withColumn("place", F.row_number().over(by_class))
        .where(F.col("place") <= limit)
        .select("item", "score", F.explode("members.doc").alias("doc"))
        .withColumn("rank", F.row_number().over(by_doc))
        .where(F.col("rank") <= limit)
        .select("item", "rank", "doc", "score")
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    limit: int = LIMIT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each item its `limit` best documents with a score above 0: item_col, rank, id_col, score.

    Ids of documents are integers; of equal scores the smaller id comes first.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType.simpleString()
    given = items.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("binary").alias("text")).where("text IS NOT NULL")
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    numbered = given.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc {texts.schema['doc'].dataType.simpleString()}, score long")
    for block in range(blocks):
        rows = [(x, bytes(t)) for x, t, _ in numbered.where(F.col("block") == block).collect()]  # a block's worth
        if not any(terms(t) for _, t in rows):
            continue
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], f"item long, item_id {kind}")
        ranked = _block(texts, rows, limit).join(F.broadcast(names), "item")
        found = found.unionByName(ranked.select("item_id", "rank", "doc", "score"))
    return found.select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for each benchmark item."""
    return search(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), item AS (
  SELECT item_id, row_number() OVER () AS q, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark
), numbered AS (
  SELECT row_number() OVER () AS d, doc_id, len(t)::BIGINT AS n, t FROM doc WHERE len(t) > 0
), size AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM numbered
), wanted AS (
  SELECT q, term, count(*) AS k FROM (SELECT q, unnest(t) AS term FROM item) GROUP BY q, term
), held AS (
  SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(t) AS term FROM numbered)
  WHERE term IN (SELECT term FROM wanted) GROUP BY d, term
), weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, size GROUP BY term, docs
), scored AS (
  SELECT q, d, sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM wanted JOIN held USING (term) JOIN weight USING (term) JOIN numbered USING (d), size GROUP BY q, d
), ranked AS (
  SELECT q, d, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank
  FROM scored JOIN numbered USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (q) JOIN numbered USING (d) WHERE rank <= 20
"""
