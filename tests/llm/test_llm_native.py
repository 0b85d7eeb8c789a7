"""Operators built from DataFrame expressions only, against plain versions."""

import hashlib
import os
import random
import sys
import time

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from cohortlens.llm import decontaminate, license_scan, line_dedup, pii  # noqa: E402

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def table(data, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{data}/{name}.parquet'").fetchall()


# -- line dedup ------------------------------------------------------------------------------

LINES = [
    (1, "a\nb\nc\nd"),
    (2, "x\na\nb\nc\nd\ny"),
    (3, "a\n\nb\n \nc"),
    (4, None),
    (5, ""),
    (6, "a\nb"),
    (7, "k\nk\nk\nk\nk"),
    (8, "\n\n\n\n"),
    (9, "a\nb\nc\nd"),
    (10, "\n".join(f"line {i % 700}" for i in range(3000))),
]


def test_line_dedup_matches_a_plain_version(spark, data):
    for docs in (LINES, table(data, "documents", "doc_id, text")):
        got = {
            r.doc_id: (r.n_lines, r.n_removed, r.n_spans, r.kept_text)
            for r in line_dedup.drop_repeats(frame(spark, docs)).collect()
        }
        assert got == brute.repeated_lines(docs)


def test_line_dedup_keeps_columns_and_repeated_rows(spark):
    rows = [(1, "a\nb\nc", "u"), (1, "a\nb\nc", "u"), (None, "a\nb\nc", "v"), (2, "a\nb\nc", "w")]
    docs = frame(spark, rows, "doc_id long, text string, starts string")
    got = sorted((r.starts, r.kept_text) for r in line_dedup.drop_repeats(docs).collect())
    # The null id is the smallest: its row keeps its lines.
    assert got == [("u", ""), ("u", ""), ("v", "a\nb\nc"), ("w", "")]
    assert line_dedup.drop_repeats(docs.limit(0)).count() == 0


def test_line_dedup_replaces_columns_of_its_own_names(spark):
    rows = [(1, "a\nb\nc", 7, "x"), (2, "a\nb\nc\nd", 8, "y")]
    found = line_dedup.drop_repeats(frame(spark, rows, "doc_id long, text string, n_lines int, kept_text string"))
    assert found.columns == ["doc_id", "text", "kept_text", "n_lines", "n_removed", "n_spans"]
    assert sorted((r.doc_id, r.kept_text, r.n_lines) for r in found.collect()) == [(1, "a\nb\nc", 3), (2, "d", 4)]


# -- decontamination -------------------------------------------------------------------------


def _found(spark, docs, items, **more):
    out = decontaminate.contaminated(frame(spark, docs), frame(spark, items, "item_id long, text string"), **more)
    return {(r.doc_id, r.item_id) for r in out.collect()}


def test_decontamination_matches_a_plain_version(spark, data):
    docs, items = table(data, "documents", "doc_id, text"), table(data, "benchmark", "item_id, text")
    expected = brute.contaminated(docs, items)
    assert expected and _found(spark, docs, items) == expected
    # The way without a broadcast gives the same.
    assert _found(spark, docs, items, broadcast_shingles=0) == expected


def test_decontamination_edges(spark):
    item = " ".join(f"w{i}" for i in range(40))
    changed = item.replace("w20 ", "other ")
    items = [(1, item), (2, "short one"), (3, None), (4, ""), (1, item), (5, "A b A b A b A b A b")]
    docs = [
        (10, f"before {item.upper()} after"),
        (11, "x " * 500 + changed),
        (12, " ".join(item.split()[:20])),
        (13, "a Short  ONE here"),
        (14, None),
        (15, ""),
        (16, "a b a b a b a b a b a b"),
        (17, "w0 w1 w2 w3 w4 " * 2000),
        (None, item),
        (10, f"before {item.upper()} after"),
    ]
    assert _found(spark, docs, items) == brute.contaminated(docs, items)
    assert _found(spark, docs, items[2:4]) == set()
    assert _found(spark, docs[:0], items) == set()
    assert _found(spark, docs, items[:0]) == set()


def test_no_pair_is_lost_by_its_fingerprints(spark):
    # Six of seven shingles are shared, just enough; some of the fingerprints are far apart.
    texts = [(i, f"a{i} b{i} " * 5) for i in range(1000)]
    items, docs = ([(i, x + last) for i, x in texts] for last in ("one", "other"))
    assert _found(spark, docs, items) == {(i, i) for i, _ in texts}


def test_decontamination_of_repetitive_texts_matches_a_plain_version(spark):
    draw = random.Random(6)
    text = lambda words, n: " ".join(draw.choices(words, k=n))
    few, more = ["a", "b"], [f"w{i}" for i in range(9)]
    items = [(i, text(few if i % 3 else more, draw.randint(1, 30))) for i in range(40)]
    docs = [(i, text(few if i % 2 else more, draw.randint(0, 60))) for i in range(80)]
    for i in range(80, 160):  # an item, changed a little, between other words
        words = items[i % 40][1].split()
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = draw.choice(few + more)
        docs.append((i, f"{text(more, draw.randint(0, 9))} {' '.join(words)} {text(few, draw.randint(0, 9))}"))
    expected = brute.contaminated(docs, items)
    assert len(expected) > 200 and _found(spark, docs, items) == expected
    assert _found(spark, docs, items, broadcast_shingles=0, broadcast_docs=0) == expected


def test_items_of_twenty_thousand_words(spark):
    item = [f"w{i}" for i in range(20_000)]
    changed = [w if i % 100 else "other" for i, w in enumerate(item)]
    docs = [(1, "a b " + " ".join(item) + " c"), (2, " ".join(changed)), (3, " ".join(item[:12_000])), (4, "x " * 30_000)]
    items = [(1, " ".join(item)), (2, "x " * 20_000)]
    begin = time.monotonic()
    assert _found(spark, docs, items) == {(1, 1), (2, 1), (4, 2)}
    assert time.monotonic() - begin < 60


def test_texts_under_one_id_are_compared_each_by_itself(spark):
    item = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    changed = item.replace("w20 ", "other ")
    docs = [(None, changed), (None, item.replace("w8 ", "x ")), (1, changed), (1, item.replace("w30 ", "y "))]
    items = [(7, item), (7, other), (None, item)]
    assert _found(spark, docs, items) == {(None, 7), (1, 7), (None, None), (1, None)}
    found = decontaminate.contaminated(
        frame(spark, [*docs, (2, "no item here")]), frame(spark, items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.shared, r.total) for r in found} == {(None, 31, 41), (1, 31, 41)}


# -- personal data ---------------------------------------------------------------------------

PERSONAL = [
    "a@b.c+d@e.f x@y", "a@b.c.d@e.f", None, "", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255 1..2.3.4",
    "+1+2 (555) 123-4567. +++12345678", "x@y@z.com é@ü.de 日本a@b.co",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112", "card 4111111111111111",
    "💳 4111111111111111 +1 23456789", "12.34.56.78.", "+1" + "(" * 3000, "1" * 2000,
]


def test_personal_data_matches_a_plain_version(spark, data):
    docs = table(data, "documents", "doc_id, text") + [(1_000_000 + i, x) for i, x in enumerate(PERSONAL)]
    rows = pii.find(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for row in rows:
        base = [s for s in row.spans if s.base]
        told = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in base)
        counts = [sum(s.kind == k for s in base) for k in brute.PII]
        assert (*counts, hashlib.sha256(told.encode()).hexdigest()) == brute.personal(texts[row.doc_id])
        assert all(texts[row.doc_id][s.start : s.end] == s.text for s in row.spans)


def test_very_long_runs_need_neither_deep_stacks_nor_long_times(spark):
    long = ["1" * 300_000, "a" * 300_000 + "@", "1-" * 100_000, "a." * 100_000 + "@" + "b." * 100_000]
    found = {r.doc_id: len(r.spans) for r in pii.find(frame(spark, list(enumerate(long)))).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 1}


def test_checksums_and_context_decide_about_added_kinds(spark):
    docs = [
        (1, "my iban GB82 WEST 1234 5698 7654 32 ok"), (2, "account DE89370400440532013000."),
        (3, "account DE89370400440532013001."), (4, "ssn 123-45-6789"), (5, "part 123-45-6789"),
        (None, "ssn 123-45-6789"), (4, "ssn 123-45-6789"),
    ]
    rows = pii.find(frame(spark, docs, "doc_id long, text string").selectExpr("doc_id", "text", "text AS spans")).collect()
    found = sorted((r.doc_id or 0, [s.kind for s in r.spans if not s.base]) for r in rows)
    assert found == [(0, ["ssn"]), (1, ["iban"]), (2, ["iban"]), (3, []), (4, ["ssn"]), (4, ["ssn"]), (5, [])]
    assert pii.find(frame(spark, docs[:0])).count() == 0


def test_secrets_need_an_even_mix_and_a_word_nearby(spark):
    key = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda"
    docs = [
        (0, f'x token = "{key}" y'),
        (1, f"checksum {key}"),
        (2, f"API_KEY: {key.upper()} and password {key[:24]}"),
        (3, "token aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1"),
        (4, "secret thisisonlyalongwordwithoutdigits"),
        (5, f"token {key[:19]}"),
        (6, "bearer " + "ab1" * 7 + " " + "x " * 30 + key),
        (7, "token " + key * 4000),
        (8, None),
    ]
    rows = pii.find(frame(spark, docs)).collect()
    found = {r.doc_id: [(s.start, s.end - s.start) for s in r.spans if s.kind == "secret"] for r in rows}
    expected = {0: [(11, 40)], 2: [(9, 40), (63, 24)], 7: [(6, 160_000)]}
    assert found == {d: expected.get(d, []) for d, _ in docs}


# -- licenses --------------------------------------------------------------------------------


def test_license_scan_matches_a_plain_version(spark, data):
    extra = [
        None, "", "MIT License", "mit-license CC BY cc  by", "GNU General\nPublic License v3, gnu general public",
        "ÄMIT licenses mit licensé", "apache " * 200 + "license", "cc by " * 2000,
    ]
    docs = table(data, "documents", "doc_id, text") + [(1_000_000 + i, x) for i, x in enumerate(extra)]
    texts = dict(docs)
    rows = license_scan.scan(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    for row in rows:
        base = [h for h in row.hits if h.base]
        starts = [h.start for h in base]
        labels = ",".join(sorted({h.label for h in base}))
        got = (row.n_words, len(base), min(starts, default=None), max(starts, default=None), labels)
        assert got == brute.licensed(texts[row.doc_id])
        assert all(0 <= h.score <= 1 for h in row.hits)


def test_notices_need_their_key_phrase(spark):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    docs = [(1, text), (1, text), (2, text.replace("granted", "denied")), (None, "All rights reserved")]
    found = sorted(
        (r.doc_id or 0, [h.label for h in r.hits], [h.score for h in r.hits])
        for r in license_scan.scan(frame(spark, docs)).collect()
    )
    assert found == [(0, ["copyright"], [1.0]), (1, ["mit-text"], [1.0]), (1, ["mit-text"], [1.0]), (2, [], [])]
    assert license_scan.scan(frame(spark, docs[:0])).count() == 0


def test_license_scan_of_long_texts(spark):
    texts = ["license " * 200_000 + "mit license", "the public license of mit " * 60_000, "cc by nc " * 60_000]
    begin = time.monotonic()
    rows = {r.doc_id: r for r in license_scan.scan(frame(spark, list(enumerate(texts)))).collect()}
    assert time.monotonic() - begin < 60
    assert [(h.start, h.label) for h in rows[0].hits] == [(200_000, "mit")]
    assert rows[1].hits == [] and rows[1].n_words == 300_000
    assert len(rows[2].hits) == 120_000 and {h.label for h in rows[2].hits} == {"cc-by", "cc-by-nc"}


@pytest.mark.parametrize("name", ["op2_line_dedup", "op4_pii", "op6_license_scan", "op10_decontaminate"])
def test_no_python_runs_on_the_executors(spark, data, name):
    from cohortlens.llm import queries

    plan = queries.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
