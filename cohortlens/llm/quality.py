"""Quality rules: counts of a text, then a calibrated linear classifier of hashed n-grams.

Base rules look at words, symbols, repeated lines and repeated three-word windows; a text that
fails them is rejected. The others are scored by a logistic regression trained on labelled rows.
Its features are the shares of hashed words, word pairs and byte 3- and 5-grams in FEATURES
buckets a family. A second logistic regression on rows the first has not seen turns the margin
into a probability (Platt scaling); a text below KEEP_FROM is rejected.

Bounds: the classifier is fitted on at most TRAIN_ROWS labelled rows, those with the smallest hash
of their id, a quarter of them for the calibration. Every text is scored whole, in Arrow batches.

Nulls and edges: a null text has no words; texts with the same content get the same verdict;
labels without a document, null labels and repeated labels are ignored (a document labelled both
ways counts as bad); without labelled rows of both kinds the base rules decide alone; an empty
table gives an empty result. Extra columns of the input stay where `judge` is asked for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common, vectors

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

#: Labelled rows the classifier is fitted on at most.
TRAIN_ROWS = 6_000
#: Hash buckets of each family of n-grams.
FEATURES = 512
FAMILIES = ("word", "word pair", "byte 3-gram", "byte 5-gram")
#: Probability of good quality from which a text is kept.
KEEP_FROM = 0.4
PART_BYTES = 2_000_000

_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


@dataclass(frozen=True)
class Model:
    """Margin weights by family and bucket, and the calibration of the margin."""

    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50)))


def _grams(w: vectors.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each run of `size` bytes that stays in one text, and where each text's runs begin."""
    data = w.data.astype(np.uint32)
    n = max(0, len(data) - size + 1)
    h = np.zeros(n, np.uint32)
    whole = np.ones(n, bool)
    behind = w.first_byte[1:] - 1  # the line feed after each text
    for k in range(size):
        h = (h ^ data[k : k + n]) * np.uint32(0x01000193)
        over = behind - k
        whole[over[(over >= 0) & (over < n)]] = False
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    counts = np.maximum(0, np.diff(w.first_byte) - size)
    return ((h >> np.uint32(16)) % np.uint32(FEATURES))[whole], np.concatenate([[0], np.cumsum(counts)])


def _families(w: vectors.Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family the buckets of all texts and the bounds of each text in them."""
    yield (w.hashes >> np.uint64(40)) % np.uint64(FEATURES), w.first_word
    pairs, owner = vectors.runs(w, 2)
    yield (pairs >> np.uint64(40)) % np.uint64(FEATURES), np.searchsorted(owner, np.arange(len(w.counts) + 1))
    yield _grams(w, 3)
    yield _grams(w, 5)


def _margins(w: vectors.Words, model: Model) -> np.ndarray:
    margin = np.full(len(w.counts), model.intercept)
    for weights, (bucket, bounds) in zip(model.weights, _families(w), strict=True):
        # Each text is summed by itself: differences of a running sum would round by its neighbours.
        owner = np.repeat(np.arange(len(w.counts)), np.diff(bounds))
        total = np.bincount(owner, weights=weights[bucket], minlength=len(w.counts))
        margin += total / np.maximum(1, np.diff(bounds))
    return margin


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shares of each bucket, families side by side."""
    for (label, fold), texts in common.texts_in_parts(batches, ["label", "fold"], "text", PART_BYTES):
        w = vectors.words(texts, fold=False)
        shares = []
        for bucket, bounds in _families(w):
            owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
            inside = bucket[bounds[0] : bounds[-1]].astype(np.int64)
            table = np.bincount(owner * FEATURES + inside, minlength=len(texts) * FEATURES)
            shares.append(table.reshape(len(texts), FEATURES) / np.maximum(1, np.diff(bounds))[:, None])
        rows = np.hstack(shares)
        flat = pa.ListArray.from_arrays(
            np.arange(len(texts) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel())
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.float64()), pa.array(fold, pa.int32()), flat], ["label", "fold", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most `rows` labelled documents; None without both labels in both folds."""
    key = F.xxhash64("doc_id")
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("label"))
        .orderBy(key, "doc_id")
        .limit(rows)
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)).cast("int"))
    )
    # At most `rows` short rows, so the documents need no shuffle.
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "fold", "text")
    table = common.checkpointed(
        known.mapInArrow(_features, "label double, fold int, x array<double>").withColumn(
            "x", array_to_vector("x")
        )
    )
    fit, rest = table.where("fold > 0"), table.where("fold = 0")
    seen = table.select("label", (F.col("fold") > 0).alias("fit")).distinct().count()
    if seen < 4:
        return None
    plain = dict(labelCol="label", maxIter=100, tol=1e-7)
    first = LogisticRegression(featuresCol="x", regParam=0.003, **plain).fit(fit)
    margin = first.setRawPredictionCol("m").setProbabilityCol("").setPredictionCol("").transform(rest)
    lone = margin.select("label", array_to_vector(F.array(F.get(vector_to_array("m"), F.lit(1)))).alias("m"))
    second = LogisticRegression(featuresCol="m", regParam=0.01, **plain).fit(lone)
    return Model(
        first.coefficients.toArray().reshape(len(FAMILIES), FEATURES),
        float(first.intercept),
        max(0.0, float(second.coefficients[0])),
        float(second.intercept),
    )


def _counts(w: vectors.Words, texts: list[bytes]) -> dict[str, np.ndarray]:
    """What the base rules look at, by text."""
    opens = (w.data & 0xC0) != 0x80
    char = opens & ~vectors.SPACE[w.data]
    repeated = np.zeros(len(w.hashes), bool)
    triples, owner = vectors.runs(w, 3)
    if len(triples):
        mixed = vectors.mix(triples + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, group, size = np.unique(mixed, return_inverse=True, return_counts=True)
        full = np.flatnonzero(w.owner[:-2] == w.owner[2:])
        twice = full[size[group] > 1]
        for k in range(3):
            repeated[twice + k] = True
    dup_lines = []
    for text in texts:
        lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
        dup_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": w.counts,
        "word_chars": vectors.sums(char, w.first_byte),
        "n_symbols": vectors.sums(_IS_SYMBOL[w.data], w.first_byte),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": vectors.sums(repeated, w.first_word),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of each row, the counts, base_failed, probability (null without a model) and
    kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in common.texts_in_parts(iter([batch]), [], "#text", PART_BYTES):
                rows = batch.slice(at, len(texts))
                at += len(texts)
                w = vectors.words(texts, fold=False)
                c = _counts(w, texts)
                failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                p = None if model is None else model.probability(_margins(w, model))
                good = ~failed if p is None else ~failed & (p >= KEEP_FROM)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[rows.column(i) for i in range(len(keep))],
                        *[pa.array(c[k], pa.int64()) for k in COUNTS],
                        pa.array(failed),
                        pa.nulls(len(texts), pa.float64()) if p is None else pa.array(p),
                        pa.array(good),
                    ],
                    [*keep, *[f"#{k}" for k in COUNTS], "#base_failed", "#probability", "#kept"],
                )

    added = [*[(k, "long") for k in COUNTS], ("base_failed", "boolean"), ("probability", "double"), ("kept", "boolean")]
    schema = docs.select(*keep).schema
    for name, kind in added:
        schema = schema.add(f"#{name}", kind)
    out = docs.select(*keep, F.col(text_col).alias("#text")).mapInArrow(run, schema)
    return out.select(*keep, *[F.col(f"#{name}").alias(name) for name, _ in added])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the counts, whether the base rules reject it, and the verdict."""
    docs = common.read(spark, sf_dir, "documents")
    model = train(docs, common.read(spark, sf_dir, "labels"))
    return judge(docs, model, ["doc_id"])
