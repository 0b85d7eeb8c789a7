"""Manifest, lexical search and fingerprints against plain versions."""

import hashlib
import os
import random
import sys
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from cohortlens.llm import lexical_search, merkle, simhash  # noqa: E402

FULL = "doc_id long, source string, lang string, n_chars long, text string"
DOCS = "doc_id long, text string"


def table(data, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{data}/{name}.parquet'").fetchall()


def folder(spark, path, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# -- manifest --------------------------------------------------------------------------------

MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _manifest(spark, path):
    got = merkle.op11_merkle_manifest(spark, path)
    assert got.columns == MANIFEST
    return Counter(tuple(r) for r in got.collect())


def test_manifest_matches_a_plain_version(spark, data):
    docs = table(data, "documents", "doc_id, source, lang, n_chars, text")
    assert _manifest(spark, data) == Counter(brute.manifest(docs))


def test_manifest_edges(spark, tmp_path):
    rows = [(i, "s", "many", i, f"Text {i}") for i in range(1, 586)]
    rows += [(i, None, "nine", None, f"T{i}") for i in range(9)]
    rows += [(5, "s", "", 1, ""), (None, None, None, None, None), (7, "é", None, 3, "Ünï\n" * 50_000)]
    rows += [(8, "s", "same", 1, "A")] * 20 + [(8, "s", "same", 1, "B"), (None, "s", "same", 1, "B")]
    path = folder(spark, tmp_path, documents=(rows, FULL))
    expected = brute.manifest(rows)
    assert {r[-1] for r in expected} == {True, False}
    assert _manifest(spark, path) == Counter(expected)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 1, "A")], [(3, None, None, None, None)] * 9])
def test_manifest_of_small_tables(spark, tmp_path, rows):
    assert _manifest(spark, folder(spark, tmp_path, documents=(rows, FULL))) == Counter(brute.manifest(rows))


def test_manifest_keeps_columns_whatever_their_names(spark):
    rows = [(i, "x", hashlib.sha256(str(i).encode()).hexdigest(), i * 2) for i in range(70)]
    given = spark.createDataFrame(rows, "n long, pos string, h string, path2 long")
    got = merkle.manifest(given, "n", "pos", "h").orderBy("n").collect()
    assert [(r.n, r.pos, r.path2, r.position, r.n_leaves) for r in got] == [(i, "x", i * 2, i, 70) for i in range(70)]
    top, paths = brute._tree([r[2] for r in rows])
    assert {(r.subroot, r.root) for r in got} == {(top, top)}
    assert [[tuple(s) for s in r.path] for r in got] == paths


def test_manifest_shows_any_change(spark):
    rows = [(i, f"text {i}") for i in range(100)]
    leaf = merkle.leaf_digest([F.col("doc_id"), F.col("text")])
    first = spark.createDataFrame(rows, DOCS).select("doc_id", F.lit("g").alias("lang"), leaf.alias("leaf"))
    told = merkle.manifest(first, "doc_id", "lang")
    for moved in (0, 64, 99):
        folded = merkle.fold(F.when(F.col("doc_id") == moved, F.sha2(F.lit("x"), 256)).otherwise(F.col("leaf")), F.col("path"))
        wrong = told.where(folded != F.col("root")).collect()
        assert [r.doc_id for r in wrong] == [moved]


# -- lexical search --------------------------------------------------------------------------


def _searched(spark, docs, items, **more):
    found = lexical_search.search(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), **more
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_search_matches_a_plain_version(spark, data):
    docs, items = table(data, "documents", "doc_id, text"), table(data, "benchmark", "item_id, text")
    expected = sorted(brute.searched(docs, items), key=str)
    assert _searched(spark, docs, items) == expected
    # The same by blocks of items.
    assert _searched(spark, docs, items[:12], block_bytes=1_000) == sorted(brute.searched(docs, items[:12]), key=str)


def test_search_edges(spark):
    docs = [(i, "alpha beta gamma") for i in range(50, 0, -1)]  # one class of fifty
    docs += [(100 + i, "alpha " * (i % 7) + "délta z" + "9 " * i) for i in range(40)]
    docs += [(None, "alpha beta gamma"), (3, "Alpha-BETA_gamma"), (60, None), (61, ""), (62, ".,;- \x7f")]
    docs += [(63, "épsilon " * 30_000 + "alpha")]
    items = [(1, "alpha"), (2, "gamma gamma ALPHA"), (2, "DÉLTA délta z9"), (3, None), (4, ""), (5, "nowhere at all"), (None, "beta")]
    for limit in (20, 3, 100):
        expected = sorted(brute.searched(docs, items, limit), key=str)
        assert expected and _searched(spark, docs, items, limit=limit) == expected
    assert _searched(spark, docs, items[3:6]) == []
    assert _searched(spark, docs[:0], items) == []
    assert _searched(spark, docs, items[:0]) == []


def test_search_of_many_classes_in_small_pieces(spark, monkeypatch):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = [(i // 2, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for i in range(1500)]
    items = [(i, " ".join(draw.choices(words, k=9))) for i in range(25)]
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    place = {t.encode(): i for i, t in enumerate(sorted(words), 1)}
    weight = np.arange(61) * 7
    start, item, worth = lexical_search._postings([(i, t.encode()) for i, t in items], place, weight)
    bags, m, expected = [], [], []
    for _, text in docs[:90]:
        times = sorted(Counter(place[t.encode()] for t in text.split()).items())
        bags.append(np.array(times, "<u4").T.tobytes())
        m.append(75 + len(times))
        expected.append(
            [sum(int(weight[w]) * (10**9 * k // (1000 * k + 12 * m[-1])) * t.split().count(sorted(words)[w - 1]) for w, k in times) for _, t in items]
        )
    assert lexical_search._scores(bags, np.array(m), start, item, worth, len(items)).tolist() == expected
    assert _searched(spark, docs, items) == sorted(brute.searched(docs, items), key=str)


# -- fingerprints ----------------------------------------------------------------------------


def test_fingerprints_match_a_plain_version(spark, data, tmp_path):
    words = [f"w{i}" for i in range(3000)]
    long = [(1, " ".join(words) * 40), (2, "a b c"), (3, "A\tB\x0bc"), (4, None), (5, " \n"), (6, "é ü  x y z w")]
    for docs in (table(data, "documents", "doc_id, text"), long):
        path = folder(spark, tmp_path / str(len(docs)), documents=(docs, DOCS))
        prints = {d: brute.simhash(x) for d, x in docs}
        group = brute.close_prints(prints.values())
        least = {}
        for d, p in prints.items():
            least[group[p]] = min(least.get(group[p], d), d)
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op13_simhash(spark, path).collect()}
        assert got == {d: (f"{p:016x}", least[group[p]]) for d, p in prints.items()}


def test_null_and_repeated_ids(spark):
    docs = [(None, "one two three four five"), (4, "one two three four five"), (4, "other words stand in this row"),
            (9, "other words stand in this row"), (None, "alone alone"), (8, None), (2, "")]
    got = sorted(((r.doc_id, r.component_id, r.n_copies) for r in simhash.near_copies(spark.createDataFrame(docs, DOCS)).collect()), key=str)
    assert got == sorted([(None, 4, 2), (4, 4, 2), (4, 4, 2), (9, 4, 2), (None, None, 1), (8, 2, 2), (2, 2, 2)], key=str)
    assert simhash.near_copies(spark.createDataFrame([], DOCS)).count() == 0


def _some_prints(seed, count):
    """Fingerprints in tight groups, on lines of small steps and alone."""
    draw = random.Random(seed)
    out = {0, 2**64 - 1, 2**63}
    while len(out) < count:
        base = draw.getrandbits(64)
        for _ in range(draw.choice([1, 1, 5, 40])):
            out.add(base ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4))))
        for _ in range(draw.choice([0, 0, 12])):
            base ^= sum(1 << b for b in draw.sample(range(64), 4))
            out.add(base)
    return sorted(out)


def _components(spark, prints, **limits):
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.linked(spark.createDataFrame([(p,) for p in signed], "print long"), **limits).collect()
    return brute.components([(r.a % 2**64, r.b % 2**64) for r in links], prints)


def test_links_are_whole_however_groups_are_dealt(spark, monkeypatch):
    prints = _some_prints(1, 700)
    expected = brute.close_prints(prints)
    assert len(set(expected.values())) < len(prints) - 300
    assert _components(spark, prints) == expected
    # Groups so small that they are dealt again, and again.
    assert _components(spark, prints, group_variants=20_000, most_variants=3_000) == expected


def test_a_group_split_into_small_parts_has_the_same_links(monkeypatch):
    prints = np.array(_some_prints(2, 400), np.uint64)
    expected = brute.close_prints(prints.tolist())
    for most in (500_000, 3_000, 200):
        monkeypatch.setattr(simhash, "PART_VARIANTS", most)
        links = simhash.met(prints, np.full(len(prints), simhash.HALF), 0)
        assert np.bitwise_count(links[0] ^ links[1]).max() <= simhash.RADIUS
        assert brute.components([tuple(x) for x in links.T.tolist()], prints.tolist()) == expected


def test_many_close_fingerprints_make_few_links(spark):
    # All within two bits of one value, two million pairs; each group tells a forest.
    prints = sorted({int(m) ^ 0x0123456789ABCDEF for m in simhash._masks(64, 2)})
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    links = simhash.linked(spark.createDataFrame([(p,) for p in signed], "print long"))
    assert len(set(_components(spark, prints).values())) == 1
    assert links.count() < simhash._count(simhash.FIRST_BITS, 2) * len(prints)
