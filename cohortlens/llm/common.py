"""Word rules, table access and batch helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir, prepare

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
#: Words in a shingle, and the similarity in hundredths from which texts are near-duplicates.
SHINGLE_WORDS = 5
NEAR_PERCENT = 75


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else, so that every engine agrees."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Words of a text; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def upto(last: Column) -> Column:
    """0..last-1, empty when last is not positive."""
    return F.when(last > 0, F.sequence(F.lit(0), (last - 1).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )


def shingle_hashes(tokens: Column, size: int) -> Column:
    """64-bit hash of every run of `size` words, in order; shorter lists give none."""
    return F.transform(
        upto(F.size(tokens) - (size - 1)),
        lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(size)]),
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder all executors share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def planned_bytes(df: DataFrame) -> int:
    """About how many bytes a frame reads, as the optimizer knows from its files; 0 if it does not."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def texts_in_parts(
    batches: Iterator[pa.RecordBatch], columns: list[str], text: str, part_bytes: int
) -> Iterator[tuple[list[list], list[bytes]]]:
    """Rows of Arrow batches in parts of about `part_bytes` of text: other columns, then texts.

    A null text is the empty text. One text is never cut, so a part may hold one that is longer.
    """
    for batch in batches:
        raw = batch.column(text).cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]) if len(raw) else np.zeros(0, np.int64)
        part = np.cumsum(sizes) // part_bytes if len(raw) else sizes
        start = 0
        for stop in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), len(raw)]:
            if stop > start:
                rows = [batch.column(c).slice(start, stop - start).to_pylist() for c in columns]
                yield rows, [x or b"" for x in raw.slice(start, stop - start).to_pylist()]
            start = stop
