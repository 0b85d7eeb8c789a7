"""Partial results of streams: compaction, replay and readers."""

import os

import pytest
from pyspark.sql import functions as F

from cohortlens.streaming import ledger

SCHEMA = "k bigint, n bigint"


def _merge(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def _batch(spark, i):
    return spark.createDataFrame([(i % 3, 1), (7, i)], SCHEMA).coalesce(1)


def _sums(frame):
    return {r.k: r.n for r in _merge(frame).collect()}


def _expected(count):
    told = {7: sum(range(count))}
    for i in range(count):
        told[i % 3] = told.get(i % 3, 0) + 1
    return told


def _files(path):
    return [n for _, _, names in os.walk(path) for n in names if n.endswith(".parquet")]


def test_files_stay_few_over_a_hundred_batches(spark, tmp_path):
    path, most = str(tmp_path), 0
    for i in range(100):
        ledger.append(spark, path, i, _batch(spark, i), SCHEMA, _merge)
        now = ledger._Folder(spark, path).current()
        assert now.batch == i and len(now.parts) <= 3 * (ledger.FAN_IN - 1)
        most = max(most, len(_files(path)))
    assert _sums(ledger.snapshot(spark, path, SCHEMA)) == _expected(100)
    # Live parts and those of the manifests that are kept for readers.
    assert most <= 3 * ledger.FAN_IN + ledger.KEEP * 2
    assert len(ledger._Folder(spark, path).versions()) <= ledger.KEEP + 3


def test_a_replayed_batch_counts_once(spark, tmp_path):
    path = str(tmp_path)
    for i in [0, 1, 1, 2, 0, 2, 3]:
        ledger.append(spark, path, i, _batch(spark, i), SCHEMA, _merge, fan_in=2)
    assert _sums(ledger.snapshot(spark, path, SCHEMA)) == _expected(4)


def test_a_reader_sees_the_old_answer_or_the_new_one(spark, tmp_path):
    path = str(tmp_path)
    assert ledger.snapshot(spark, path, SCHEMA).count() == 0
    for i in range(3):
        ledger.append(spark, path, i, _batch(spark, i), SCHEMA, _merge)
    old = ledger.snapshot(spark, path, SCHEMA)
    # A batch that fails before it is published leaves the answer as it was.
    with pytest.raises(ZeroDivisionError):
        ledger.append(spark, path, 3, _batch(spark, 3), SCHEMA, lambda rows: 1 / 0, fan_in=4)
    assert _sums(old) == _expected(3)
    # It had been published before its merge failed; its replay and the next batch merge again.
    ledger.append(spark, path, 3, _batch(spark, 3), SCHEMA, _merge, fan_in=4)
    ledger.append(spark, path, 4, _batch(spark, 4), SCHEMA, _merge, fan_in=4)
    assert _sums(old) == _expected(3) and _sums(ledger.snapshot(spark, path, SCHEMA)) == _expected(5)
    assert len(ledger._Folder(spark, path).current().parts) < 4


def test_what_a_failed_attempt_wrote_never_counts(spark, tmp_path):
    path = str(tmp_path)
    ledger.append(spark, path, 0, _batch(spark, 0), SCHEMA, _merge)
    _batch(spark, 9).write.parquet(ledger._Folder(spark, path).part("level0-batch1-torn"))
    assert _sums(ledger.snapshot(spark, path, SCHEMA)) == _expected(1)
    ledger.append(spark, path, 1, _batch(spark, 1), SCHEMA, _merge)
    assert _sums(ledger.snapshot(spark, path, SCHEMA)) == _expected(2)
    assert not os.path.exists(ledger._Folder(spark, path).part("level0-batch1-torn"))


def test_two_writers_are_told_apart(spark, tmp_path):
    folder = ledger._Folder(spark, str(tmp_path))
    folder.publish(ledger.Manifest(1, 0))
    with pytest.raises(RuntimeError, match="another writer"):
        folder.publish(ledger.Manifest(1, 0))
