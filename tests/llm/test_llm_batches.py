"""Operators with numpy or a tokenizer in their tasks, against plain versions."""

import hashlib
import math
import os
import sys
import time
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from cohortlens.llm import components, html_text, language_id, ngram_join, packing, quality, suffix_dedup, vectors  # noqa: E402

DOCS = "doc_id long, text string"
PHRASE = "the quick brown fox jumps over the lazy dog again and again "


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def table(data, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{data}/{name}.parquet'").fetchall()


# -- word hashes -----------------------------------------------------------------------------


def test_words_hash_alike_wherever_they_stand():
    long = b"x" * 200_000
    w = vectors.words([b"a " + long, long + b" b", b"", b" \t", b"A a"], fold=True)
    assert w.counts.tolist() == [2, 2, 0, 0, 2]
    assert w.hashes[1] == w.hashes[2] and w.hashes[0] == w.hashes[4] == w.hashes[5]
    assert len(set(w.hashes.tolist())) == 3


# -- n-gram join -----------------------------------------------------------------------------


def _joined(spark, rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar(frame(spark, rows)).collect()}


def _family(size, words, changes, seed):
    """Near copies of one text, each with a few words of its own."""
    random = np.random.default_rng(seed)
    base = [f"{seed}w{i}" for i in range(words)]
    out = []
    for copy in range(size):
        mine = list(base)
        for at in random.integers(0, words, changes(copy) if callable(changes) else changes):
            mine[at] = f"{seed}c{copy}x{at}"
        out.append(" ".join(mine))
    return out


def test_join_matches_a_plain_version(spark, data):
    docs = table(data, "documents", "doc_id, text")
    assert _joined(spark, docs) == brute.near_copies(docs)


def test_join_of_hard_groups(spark):
    chain = [" ".join(f"v{j}" for j in range(4 * i, 4 * i + 60)) for i in range(30)]
    texts = [
        *chain,
        *_family(60, 80, 2, 1),
        *_family(40, 80, 3, 2),
        *[" ".join([PHRASE] * 3 + [f"own{i}"] * 2) for i in range(30)],
        "one two", "One  TWO", "one two three", None, "", "   ", PHRASE * 3000, PHRASE * 3000 + "end",
    ]
    docs = list(enumerate(texts))
    expected = brute.near_copies(docs)
    assert _joined(spark, docs) == expected
    assert len({c for _, c in expected.values()}) < len(docs)


def test_join_edges(spark):
    rows = [(3, PHRASE), (3, PHRASE), (2, PHRASE), (None, PHRASE), (9, None)]
    assert _joined(spark, rows) == {2: (8, 2), 3: (8, 2), 9: (0, 9)}
    assert _joined(spark, rows[:0]) == {}


def test_join_of_clusters_larger_than_a_block(spark, monkeypatch):
    # Many copies that link with the middle of their group or not at all, over many blocks.
    docs = list(enumerate([*_family(90, 120, lambda i: 1 + i % 3, 3), *_family(50, 60, 5, 4), *_family(5, 90, 1, 5)]))
    expected = brute.near_copies(docs)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "CELLS", 2_000)
    assert _joined(spark, docs) == expected
    groups = [c for _, c in expected.values()]
    assert max(map(groups.count, groups)) > 16 and len(set(groups)) > 20


@pytest.mark.parametrize("file_rows", [500_000, 40])
def test_components_of_links(spark, monkeypatch, file_rows):
    monkeypatch.setattr(components, "FILE_ROWS", file_rows)
    random = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in random.integers(0, 400, (230, 2)) if a != b]
    links += [(i, i + 1) for i in range(500, 600)] + [(-5, 0), (-5, 0)]
    frame_of = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.component for r in components.connect(frame_of).collect()}
    assert got == brute.components(links, {x for link in links for x in link})
    assert components.connect(frame_of.limit(0)).count() == 0


SETS = st.lists(st.frozensets(st.integers(0, 12), min_size=1), min_size=1, max_size=12)


@settings(max_examples=100, deadline=None)
@given(SETS, SETS)
def test_tree_join_finds_what_comparing_finds(probes, sets):
    as_arrays = lambda many: [np.array(sorted(s), np.uint64) for s in many]
    found = {(i, k) for i, linked in ngram_join.tree_join(as_arrays(probes), as_arrays(sets)) for k in linked.tolist()}
    near = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    assert found == {(i, k) for i, s in enumerate(sets) for k, p in enumerate(probes) if near(s, p)}


def test_rows_of_one_id_are_linked_by_any_of_their_texts(spark):
    own = [" ".join(f"{k}w{i}" for i in range(100)) for k in range(4)]
    short = " ".join(f"s{i}" for i in range(14))
    docs = [(1, short), (2, own[0]), (2, short), (3, own[1]), (4, own[1]), (4, own[2]), (5, own[2]), (5, None), (6, own[3]), (6, own[3])]
    expected = {1: (10, 1), 2: (96, 1), 3: (96, 3), 4: (96, 3), 5: (96, 3), 6: (96, 6)}
    assert _joined(spark, docs) == expected
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert {d: (n, c) for d, n, c in duck.execute(ngram_join.OP1_SQL).fetchall()} == expected


def test_a_subtree_that_cannot_reach_the_threshold_is_skipped(monkeypatch):
    random = np.random.default_rng(3)
    sets = [np.unique(random.integers(0, 60, random.integers(1, 40))).astype(np.uint64) for _ in range(120)]
    sets += [np.setdiff1d(sets[i], random.choice(sets[i], 1)) for i in range(60) if len(sets[i]) > 5]
    for cells in (ngram_join.CELLS, 500):
        monkeypatch.setattr(ngram_join, "CELLS", cells)
        found = {(i, k) for i, linked in ngram_join.tree_join(sets, sets) for k in linked.tolist()}
        expected = {
            (i, k) for i, x in enumerate(sets) for k, y in enumerate(sets)
            if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))
        }
        assert found == expected and len(expected) > len(sets)
    # Sets far too long for the probes are never walked to their ends.
    visited = []
    real = np.ix_
    monkeypatch.setattr(np, "ix_", lambda path, probes: visited.append(len(path) * len(probes)) or real(path, probes))
    long = [np.arange(k, k + 4_000, dtype=np.uint64) for k in range(0, 40, 2)]
    assert list(ngram_join.tree_join([np.arange(9, dtype=np.uint64)], long)) == []
    assert sum(visited) <= 4_000


# -- suffix arrays ---------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60) | st.text("ab", max_size=60).map(str.encode))
def test_two_stage_sort_orders_suffixes(text):
    order = suffix_dedup.suffix_order(np.frombuffer(text, np.uint8), len(text) + 1)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_dedup_matches_a_plain_version(spark, data):
    odd = [
        "a" * 200, "b" * 30 + "a" * 120, None, "", "x" * 49, PHRASE * 30, "é" * 100, "é" * 60 + "q",
        "\0" * 80, "\0" * 70 + "k", "lorem " + PHRASE * 4, PHRASE * 5000,
    ]
    for docs in (list(enumerate(odd)), table(data, "documents", "doc_id, text")):
        got = {
            r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
            for r in suffix_dedup.remove_repeats(frame(spark, docs)).collect()
        }
        assert got == brute.cut_repeats(docs)


def test_any_id_is_kept_and_null_stays_null(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 100)
    text, top = PHRASE * 4, 2**63 - 1
    docs = frame(spark, [(top, text), (None, text), (-top - 1, text[:120]), (0, "own " * 30), (None, "own " * 30)])
    found = {(r.doc_id, r.n_removed > 0) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert found == {(top, True), (None, True), (-top - 1, False), (0, False)}


def test_suffix_dedup_edges(spark):
    rows = [(2, PHRASE), (2, PHRASE), (None, PHRASE), (1, "other " + PHRASE)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "text AS part")
    found = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect())
    assert found == [(0, 59), (1, 0), (2, 59), (2, 59)] or found == [(0, 60), (1, 0), (2, 60), (2, 60)]
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    digest = suffix_dedup.remove_repeats(docs.where("doc_id = 1"), digest=True).first().kept
    assert bytes(digest) == hashlib.sha256(rows[3][1].encode()).digest()


# -- packing ---------------------------------------------------------------------------------

PATH = packing.tokenizer_path()
ODD_TEXTS = [
    None, "", " \n\t ", "a|b || c", "<|endoftext|> x<|startoftext|>y", "É é ́x \x1c\x1f y\xa0z",
    "it's 123 I'LL don't", "ΣΑΣ İ x\x85y​", "日本 語", "a" * 3000, "Œuvre naïve ÀÉ", PHRASE * 4000,
]


def _check_packing(rows, docs):
    whole = Tokenizer.from_file(PATH)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for doc, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, packing.END]
        at = 0
        for r in sorted(pieces.pop(doc), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[at : at + r.length]
            at += r.length
        assert at == len(ids)
    assert not pieces
    for rows_of in sequences.values():
        at = 0
        for r in sorted(rows_of, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == r.context and at <= packing.CONTEXTS[-1] and at & (at - 1) == 0
    groups = {}
    for s, rows_of in sequences.items():
        groups.setdefault(rows_of[0].step_group, []).append(rows_of[0].context)
    assert all(len(g) <= packing.GROUP and len(set(g)) == 1 for g in groups.values())


def test_packing_round_trip(spark, data):
    docs = table(data, "documents", "doc_id, text") + [(1_000_000 + i, x) for i, x in enumerate(ODD_TEXTS)]
    _check_packing(packing.pack(frame(spark, docs).repartition(3), PATH).collect(), docs)


def test_packing_edges(spark):
    rows = [(1, PHRASE), (1, PHRASE), (None, PHRASE)]
    docs = frame(spark, rows).selectExpr("doc_id", "text", "1 AS start", "2 AS ids")
    packed = packing.pack(docs, PATH).collect()
    assert sum(r.length for r in packed) == 3 * packed[0].doc_tokens
    assert {r.doc_id for r in packed} == {1, None}
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3)
    encoder, whole = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ("one two three four", "two five", "one"):
        expected = [*whole.encode(text, add_special_tokens=False).ids, packing.END]
        assert encoder.encode([text.encode()])[0].tolist() == expected


# -- language --------------------------------------------------------------------------------


def test_language_of_held_out_rows(spark):
    data = "/root/testdata/sf0.01"
    truth = dict(table(data, "documents", "doc_id, lang"))
    rows = language_id.op5_language_id(spark, data).collect()
    assert {r.doc_id for r in rows} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.97 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    rows = [(i, "le chat est sur la table avec des amis " * 3, "fr") for i in range(20)]
    rows += [(20 + i, "the cat is on the table with some friends " * 3, "en") for i in range(20)]
    rows += [(50, None, "fr"), (51, "", "en"), (52, "text without label", None)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    given = language_id.dictionaries(docs)
    assert set(given) == {"en", "fr"}
    asked = [(1, "avec des amis sur la table"), (1, "avec des amis sur la table"), (2, None), (3, ""),
             (4, "123 !?"), (5, "THE CAT is on"), (None, "the cat " * 50_000), (6, "日本語")]
    got = language_id.predict(frame(spark, asked).selectExpr("doc_id", "text", "1 AS score"), given, ["doc_id"]).collect()
    found = sorted((r.doc_id or 0, r.lang_pred) for r in got if r.doc_id != 6)
    assert found == [(0, "en"), (1, "fr"), (1, "fr"), (2, "und"), (3, "und"), (4, "und"), (5, "en")]
    assert language_id.predict(frame(spark, asked), {}, ["doc_id"]).where("lang_pred != 'und'").count() == 0
    assert language_id.dictionaries(docs.limit(0)) == {}
    assert language_id.predict(docs.limit(0), given, ["doc_id"]).count() == 0


# -- quality ---------------------------------------------------------------------------------


def test_quality_counts_match_a_plain_version(spark, data):
    odd = [None, "", "\n\n", "a b c a b c", "a\na\n a\na", "# * $ % & | < >", "é ü " * 60, "x " * 100_000, "\x0b\x0c\x1c y"]
    docs = table(data, "documents", "doc_id, text") + [(1_000_000 + i, x) for i, x in enumerate(odd)]
    texts = dict(docs)
    rows = quality.judge(frame(spark, docs), None, ["doc_id"]).collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute.counted(texts[r.doc_id])
        assert r.kept is not r.base_failed


def test_a_text_scores_alike_alone_and_between_others():
    random = np.random.default_rng(9)
    model = quality.Model(random.normal(size=(4, quality.FEATURES)), 0.1, 1.0, 0.0)
    texts = [b"", b"a", b"abcd", b"xyz", b"one\ntwo three", "näher".encode() * 40, b"", b"last words"]
    beside = quality._margins(vectors.words(texts, fold=False), model)
    assert beside.tolist() == [quality._margins(vectors.words([t], fold=False), model)[0] for t in texts]
    for size in (3, 5):
        bucket, bounds = quality._grams(vectors.words(texts, fold=False), size)
        assert np.diff(bounds).tolist() == [max(0, len(t) - size + 1) for t in texts]
        assert len(bucket) == bounds[-1]


def test_quality_verdicts_follow_the_labels(spark):
    data = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality.op9_quality(spark, data).collect()}
    labels = table(data, "labels", "doc_id, quality")
    good = [rows[d].kept for d, q in labels if q == 1 and not rows[d].base_failed]
    bad = [rows[d].kept for d, q in labels if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_without_usable_labels(spark):
    docs = frame(spark, [(1, PHRASE * 9), (1, PHRASE * 9), (None, "x"), (2, None)])
    for rows in ([], [(1, 1), (None, 0), (7, None)]):
        labels = frame(spark, rows, "doc_id long, quality int")
        assert quality.train(docs, labels) is None
    assert quality.judge(docs.limit(0), None, ["doc_id"]).count() == 0


def test_one_id_many_times_is_sampled_like_any_other(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 4)
    rows = [(None, f"mot {i} le la les", "fr") for i in range(300)] + [(7, f"word {i} the of", "en") for i in range(300)]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    seen = []
    real = language_id._dictionary
    monkeypatch.setattr(language_id, "_dictionary", lambda rows: seen.append(len(rows)) or real(rows))
    assert set(language_id.dictionaries(docs)) <= {"fr", "en"} and all(n <= 4 for n in seen)


# -- pages -----------------------------------------------------------------------------------

PAGES = {
    "": "",
    "plain text only": "plain text only",
    "<p>a < b and c &gt; d</p>": "a < b and c > d",
    "<article></article>": "",
    '<article><p>x<script>if(a<b){"</p>"}</script>y</p><form><input><p>send</p></form><p>z': "xy\nz",
    "<main><article><header><h1>T</h1></header><p>abc  def<br>g</p><div class='cookie-notice'>We use cookies"
    "</div><section class=comments><article><p>nice one</p></article></section></article><aside>x</aside></main>": "T\nabc def g",
    '<header><a href="/">Site</a></header><div class="page-with-sidebar"><div class="content"><h1>Title</h1>'
    "<p>Long text here, with many words in it to be dense enough for all.</p><p>Another <b>bold</b> "
    "para&nbsp;graph &amp; more words follow here.</p><ul><li>one item<li>two items</ul></div>"
    '<div class="sidebar"><p>side words here</p></div></div><div id="comments"><p>First! great article '
    "thanks for sharing this with all.</p></div><footer>foot</footer>": "Title\nLong text here, with many words in it to be "
    "dense enough for all.\nAnother bold para graph & more words follow here.\none item\ntwo items",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.main_text(page) == PAGES[page]


@pytest.mark.parametrize(
    "raw",
    [
        "<script>for(i=0;i<n;i++){f(i)}</script>",
        "<script>if(i<n){x='\"'}</SCRIPT >",
        "<script><!-- i<n </script>",
        "<style>a<b</style><title>a <b</title>",
        "<svg width='1'/><math/>",
        "<svg><path d='M0 0'/><text>label</text></svg>",
    ],
)
def test_text_behind_raw_elements_is_kept(raw):
    assert html_text.main_text(f"{raw}<article class='x'><p>one</p>{raw}<p>two</p></article>") == "one\ntwo"


def test_raw_elements_without_an_end_last_to_the_end():
    assert html_text.main_text("<article><p>one</p><script>if(i<n){</scripts><p>two</p>") == "one"


def test_pages_of_any_depth_and_length():
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(html_text.main_text("<article>" + "<p>word</p>" * 50_000)) == 50_000 * 5 - 1


SHAPES = {
    "unclosed tags": "<a " * 330_000,
    "unclosed tags before an end": "<a =\"'" * 160_000 + ">",
    "deep blocks": "<div>" * 200_000,
    "ends of what is not open": "<span>" * 100_000 + "</b>" * 100_000,
    "deep below a paragraph": "<p><td>" + "<div>" * 200_000,
    "lists in lists": "<ul><li>" * 120_000,
    "deep headings": "<div><h2>x</h2>" * 60_000,
    "many articles": "<h2>x</h2><article><p>y</p></article>" * 25_000,
    "quotes without an end": "<a x='\"> " * 110_000,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_malformed_pages_of_a_megabyte_take_seconds(shape):
    begin = time.monotonic()
    html_text.main_text(SHAPES[shape])
    assert time.monotonic() - begin < 8  # about one; a quadratic step takes minutes


TEXT = "<p>Words of the text, many of them, so that it is dense enough to be found by its weight.</p>"
MANY_LINKS = "".join(f"<p><a href=/{i}>link number {i} of the list</a></p>" for i in range(12))


def test_density_decides_whatever_the_elements_are_called():
    text = html_text.main_text(TEXT)
    links, words = f"<div>{MANY_LINKS}</div>", f"<div><h1>Head</h1>{TEXT * 3}</div>"
    for page in (links + words, words + links, f"<div>{links}</div><div>{words}</div>"):
        assert html_text.main_text(page) == "\n".join(["Head", *[text] * 3])
    # Even against the names.
    assert html_text.main_text(f"<article>{MANY_LINKS}</article>{words}") == "\n".join(["Head", *[text] * 3])


def test_densities_match_a_plain_version():
    page = f"<div><h2>a <a>b</a></h2>{TEXT}<div><a>x</a> yy</div></div><div>{MANY_LINKS}</div>"
    root = html_text.parse(page)
    html_text._measure(root)

    def plain(node):
        """(characters, those in links, tags, tags of links) of all below a node."""
        told = [0, 0, 0, 0]
        for x in node.inside:
            mine = [len(x.strip()), 0, 0, 0] if isinstance(x, str) else [a + b for a, b in zip(plain(x), (0, 0, 1, x.tag == "a"))]
            told = [a + b for a, b in zip(told, mine)]
        return (told[0], told[0], *told[2:]) if node.tag == "a" else tuple(told)

    c, lc, _, _ = plain(root)
    for node in html_text._ordered(root):
        chars, link, tags, link_tags = plain(node)
        link, tags, link_tags = (max(1, x) for x in (link, tags, link_tags))
        base = math.log(chars / max(1, chars - plain(node)[1]) * link + lc / c * chars + math.e)
        expected = chars / tags * math.log(chars / link * (tags / link_tags)) / math.log(base) if chars > link * link_tags / tags else 0
        assert node.density == pytest.approx(max(0, expected))
        assert node.total == pytest.approx(sum(x.density for x in node.inside if not isinstance(x, str)))


def test_all_articles_and_the_heading_before_are_kept():
    text = html_text.main_text(TEXT)
    page = f"<nav>x</nav><h1>Head</h1><article>{TEXT}</article><div>{MANY_LINKS}</div><article><h2>Two</h2>{TEXT * 2}</article>"
    assert html_text.main_text(page) == "\n".join(["Head", text, "Two", text, text])
    assert html_text.main_text(f"<article>{TEXT}</article><article>{TEXT * 4}</article>") == "\n".join([text] * 5)
    # A heading that does not outrank the text's own is not its.
    assert html_text.main_text(f"<h1>Site</h1><article><h1>Head</h1>{TEXT}</article>") == f"Head\n{text}"
    assert html_text.main_text(f"<h1>Head</h1><div><h2>Part</h2>{TEXT * 3}</div>").split("\n")[:2] == ["Head", "Part"]


def test_classes_are_read_as_words():
    text = html_text.main_text(TEXT)
    for kept in ("replies-from-experts", "share-price", "story-header", "page-without-sidebar"):
        assert html_text.main_text(f"<article><p class='{kept}'>kept</p>{TEXT}</article>") == f"kept\n{text}"
    for gone in ("notice", "cookie-notice", "related", "ad"):
        assert html_text.main_text(f"<article><p class='{gone}'>gone</p>{TEXT}</article>") == text
    for gone in ("main-sidebar-box", "newsletter-signup-form", "comments"):
        assert html_text.main_text(f"<article><div class='x {gone}'>gone</div>{TEXT}</article>") == text


def test_a_slash_at_the_end_of_a_value_closes_nothing():
    assert html_text.main_text("<article><a href=http://x/>link</a> text<br/><svg/>more</article>") == "link text more"


def test_page_rows(spark, data):
    rows = [(1, "u", "<p>a</p>", "t"), (1, "u", "<p>a</p>", "t"), (None, None, None, None)]
    pages = frame(spark, rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages, ["page_id", "url"]).collect())
    assert got == [(0, "", 0), (1, "a", 1), (1, "a", 1)]
    assert html_text.extract(pages.limit(0), ["page_id"]).count() == 0
    real = html_text.op8_html_text(spark, data).collect()
    assert real and all(r.text and "©" not in r.text and r.n_chars == len(r.text) for r in real)


def test_packing_remembers_the_words_that_come_again(monkeypatch):
    from cohortlens.llm import packing

    monkeypatch.setattr(packing, "CACHE_WORDS", 60)
    encoder = packing.Encoder(packing.tokenizer_path())
    common_words = " ".join(f"often{i}" for i in range(20))
    for n in range(12):
        text = f"{common_words} " + " ".join(f"once{n}x{i}" for i in range(25))
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert [x.tolist() for x in encoder.encode([text.encode(), b""])] == [[*whole, 1], [1]]
        assert len(encoder.place) <= 60 + 45 + 1 and len(encoder.hits) == len(encoder.sizes) == len(encoder.place)
        if n:
            assert "often0" in encoder.place
    assert "once0x0" not in encoder.place
