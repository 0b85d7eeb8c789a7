"""The pipeline, stage by stage."""

import os
import sys

import duckdb
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from cohortlens.session import shared_dir  # noqa: E402

FUNCTIONS = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_do_what_their_operators_decide(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = duckdb.sql(f"SELECT item_id, text FROM '{data}/benchmark.parquet'").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, data).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert after.columns == COLUMNS
            rows = {r.doc_id: r for r in after.collect()}
            assert len(rows) == after.count()
        if name == "quality_rules":
            assert not any(brute.counted(r.text)[-1] for r in rows.values())
        elif name == "line_dedup":
            plain = {d: x[3] for d, x in brute.repeated_lines(before).items() if x[1] == 0 or x[3].strip()}
            assert {d: r.text for d, r in rows.items()} == plain
            assert all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "ngram_jaccard_join":
            assert set(rows) == {c for _, c in brute.near_copies(before).values()}
        elif name == "benchmark_decontamination":
            assert set(rows) == {d for d, _ in before} - {d for d, _ in brute.contaminated(before, items)}
        docs = after
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(rows)


def test_stages_take_nulls_and_clashing_columns(spark, data):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "s", len(text)), (2, text, None, None, None), (None, text, "en", "s", None), (3, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("kept", F.lit("x")).withColumn("component_id", F.lit(1)).withColumn("h", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, data).columns == COLUMNS
        assert stage(spark, docs.limit(0), data).count() == 0
    near = FUNCTIONS["ngram_jaccard_join"](spark, docs, data)
    assert sorted((r.doc_id or 0) for r in near.collect()) == [1, 3]


def test_one_row_of_each_group_of_copies_stays(spark, data):
    texts = [" ".join(f"{k}word{i}" for i in range(60)) for k in range(4)]
    near = texts[0].replace("0word9 ", "changed ")
    rows = [(9, near), (1, texts[0]), (1, texts[0]), (None, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[2])]
    rows += [(None, None), (None, ""), (4, ""), (4, ""), (5, texts[3])]
    docs = spark.createDataFrame([(i, x, "en", "s", 0) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = FUNCTIONS["ngram_jaccard_join"](spark, docs.repartition(5).sortWithinPartitions("text"), data).collect()
    told = sorted(((r.doc_id or 0), r.text or "") for r in left)
    assert told == sorted([(1, texts[0]), (1, texts[1]), (0, texts[2]), (0, ""), (0, ""), (4, ""), (4, ""), (5, texts[3])])


def test_items_are_taken_out_row_by_row(spark, data):
    item = duckdb.sql(f"SELECT text FROM '{data}/benchmark.parquet' ORDER BY length(text) DESC").fetchall()[0][0]
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(i, x, "en", "s", len(x)) for i in (None, 1) for x in (f"{text} {item}", text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = FUNCTIONS["benchmark_decontamination"](spark, docs, data).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, text), (1, text)]


def test_run_gives_the_last_stage(spark, data):
    packed = corpus_pipeline.run(spark, data)
    shared = shared_dir(spark).removeprefix("file:")
    assert [n.split("-")[1] for n in os.listdir(shared) if n.startswith("pipeline-")] == ["packing"]
    sizes = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("context").alias("c"))
    assert sizes.count() and sizes.where("n != c").count() == 0
