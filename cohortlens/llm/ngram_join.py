"""N-gram Jaccard join: prefix-tree join of shingle sets, and the components its links form.

A document's set is its distinct five-word shingles of A-Z lower-cased words, or its whole word
sequence if that is shorter. Two documents link when the Jaccard similarity of their sets is 0.75
or more. Steps, each exact (a pair that links passes all of them):

1. Shared shingles. A document that links shares three quarters of its set with others. Shingle
   hashes go to buckets; each bucket credits every document with its shingles that occur twice or
   more. Shingles that repeat within a part of a task are settled there and sent once, so a
   passage of every third document stays one entry a part. Few documents remain.
2. Equal sets are one from here on, by a 128-bit digest; step 1 is repeated among them.
3. Prefixes. Shingles are ordered by document frequency, rare first. Two sets that link share one
   of the first n - ceil(0.75 n) + 1 of each; those are written as rows (shingle, document), and
   documents that share one, directly or through others, are a cluster.
4. A cluster of up to BLOCK documents is one block, in which all are compared. In a larger one,
   documents whose smallest shared shingle is the same are first compared with one of them, which
   joins most near copies. Then the documents outside the largest component so far are compared
   with each other and with that component, chunk by chunk, so that a large group of near copies
   is never compared pair by pair, but no pair is left out that could change a component.

In a block, the sets form a prefix tree: sets ordered by one order of all shingles (frequent in the
block first) and sorted, each with the length it has in common with the one before. The traversal
carries the overlaps of the probes with the path down from fork to fork, so sets with the same prefix
share them. At each fork it knows the shortest and the longest set below; probes that the rest of the
longest cannot bring to what the shortest needs are passed no further, and a subtree without open
probes is skipped.

Nulls and edges: null or empty texts have an empty set and link with nothing; rows without an id
cannot be named and are left out; rows that repeat an id are one document, linked by any of its
texts, with the size of its largest set; texts are read whole, whatever their length; other columns
are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common, vectors
from cohortlens.llm.components import connect

PART_BYTES = 4_000_000
PART_SHINGLES = 700_000
#: Documents of a chunk; a block compares one chunk with itself or with another.
BLOCK = 1_024
#: Bytes of input for each bucket of shingles, beyond the shuffle partitions.
BUCKET_BYTES = 32_000_000
#: Cells of the table of shingles by probes that a block holds at a time.
CELLS = 32_000_000

SPREAD = "bucket int, docs binary, counts binary, hashes binary, twice binary, info binary"
_INFO = np.dtype([("doc", "<i8"), ("n", "<i8"), ("credit", "<i8"), ("fp1", "<i8"), ("fp2", "<i8")])


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct shingles."""
    w = vectors.words(texts, fold=True)
    hashes, owner = vectors.runs(w, common.SHINGLE_WORDS)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    for size in range(1, common.SHINGLE_WORDS):
        hashes, owner = vectors.runs(w, size)
        for i in np.flatnonzero(w.counts == size).tolist():
            # Its size goes into the hash: a short text's shingle is nobody else's.
            sets[i] = vectors.mix(hashes[np.searchsorted(owner, i)][None] + np.uint64(size))
    return sets


def _spread(ids: np.ndarray, sets: list[np.ndarray], buckets: int, settle: bool, home: int) -> pa.RecordBatch:
    """Hashes of some sets by bucket. With `settle`, those that occur twice among these sets are
    credited here and sent once."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    every = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    bucket = ((every >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    low = every.astype(np.uint32)
    alone = np.ones(len(every), bool)
    info = np.zeros(len(sets), _INFO)
    sent: dict[int, np.ndarray] = {}
    if settle:
        order = np.argsort(every)
        ranked = every[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        times = np.diff(np.append(first, len(ranked)))
        alone[order] = np.repeat(times, times) == 1
        info["credit"] = np.bincount(owner[~alone], minlength=len(sets))
        multiple = ranked[first[times > 1]]
        mb = ((multiple >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        place = np.argsort(mb, kind="stable")
        cuts = np.searchsorted(mb[place], np.arange(buckets + 1))
        low_multiple = multiple.astype(np.uint32)[place]
        sent = {b: low_multiple[cuts[b] : cuts[b + 1]] for b in np.unique(mb).tolist()}
        info["doc"], info["n"] = ids, sizes
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        info["fp1"] = vectors.sums(vectors.mix(every), bounds).view(np.int64)
        other = vectors.mix(every ^ np.uint64(0xD6E8FEB86659FD93))
        info["fp2"] = vectors.sums(other, bounds).view(np.int64)
    key = (bucket * len(sets) + owner)[alone]
    place = np.argsort(key, kind="stable")
    key, low = key[place], low[alone][place]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(edge, len(key))).astype(np.int32)
    groups = key[edge]
    doc = ids[groups % max(1, len(sets))]
    cuts = np.searchsorted(groups // max(1, len(sets)), np.arange(buckets + 1))
    ends = np.append(edge, len(key))
    rows = []
    for b in range(buckets):
        i, j = cuts[b], cuts[b + 1]
        also = sent.get(b)
        mine = info if settle and b == home % buckets else None
        if j > i or also is not None or mine is not None:
            rows.append(
                (
                    b,
                    doc[i:j].tobytes(),
                    counts[i:j].tobytes(),
                    low[ends[i] : ends[j]].tobytes(),
                    b"" if also is None else also.tobytes(),
                    b"" if mine is None else mine.tobytes(),
                )
            )
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    kinds = [pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["bucket", "docs", "counts", "hashes", "twice", "info"],
    )


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _by_home(homes: int, docs: np.ndarray, *values: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """Arrays split by the documents' homes, the groups in which what buckets say meets again."""
    home = np.mod(docs, homes)
    order = np.argsort(home, kind="stable")
    cuts = np.searchsorted(home[order], np.arange(homes + 1))
    for h, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if j > i:
            yield h, [x[order[i:j]].tobytes() for x in (docs, *values)]


def _credit(table: pa.Table) -> pa.Table:
    """Of one bucket: how many of its shingles each document shares; and what parts told."""
    homes = table["buckets"][0].as_py()
    hashes, twice = _joined(table["hashes"], np.uint32), _joined(table["twice"], np.uint32)
    docs = np.repeat(_joined(table["docs"], np.int64), _joined(table["counts"], np.int32))
    _, group, times = np.unique(np.concatenate([hashes, twice]), return_inverse=True, return_counts=True)
    shared, credit = np.unique(docs[times[group[: len(docs)]] > 1], return_counts=True)
    info = _joined(table["info"], _INFO)
    rows = [(h, x, y, b"") for h, (x, y) in _by_home(homes, shared, credit.astype(np.int64))]
    rows += [(h, b"", b"", x) for h, (_, x) in _by_home(homes, info["doc"], info)]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["home", "docs", "credits", "info"])


def _told(table: pa.Table) -> pa.Table:
    """Of one home: size, shared shingles and digest of each document."""
    info = _joined(table["info"], _INFO)
    info = info[np.lexsort((info["fp2"], info["fp1"], -info["n"], info["doc"]))]
    docs, first, group = np.unique(info["doc"], return_index=True, return_inverse=True)
    credit = np.zeros(len(docs), np.int64)
    np.add.at(credit, group, info["credit"])
    shared = _joined(table["docs"], np.int64)
    np.add.at(credit, np.searchsorted(docs, shared), _joined(table["credits"], np.int64))
    columns = [docs, info["n"][first], credit, info["fp1"][first], info["fp2"][first]]
    return pa.table([pa.array(np.ascontiguousarray(c)) for c in columns], names=["doc", "n", "credit", "fp1", "fp2"])


def _credited(spread: DataFrame, buckets: int) -> DataFrame:
    """doc, n, credit and digest of each document."""
    told = (
        spread.withColumn("buckets", F.lit(buckets))
        .groupBy("bucket")
        .applyInArrow(_credit, "home long, docs binary, credits binary, info binary")
    )
    return told.groupBy("home").applyInArrow(_told, "doc long, n long, credit long, fp1 long, fp2 long")


def _ids(values: list) -> np.ndarray:
    return np.array(values, np.int64)


def _spread_texts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ((ids,), texts) in enumerate(common.texts_in_parts(batches, ["doc"], "text", PART_BYTES)):
            yield _spread(_ids(ids), shingle_sets(texts), buckets, True, ids[0] + part)

    return run


def _parts_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    for batch in batches:
        ids, sets, held = [], [], 0
        for doc, raw in zip(batch.column("doc").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
            ids.append(doc)
            sets.append(np.frombuffer(raw, np.uint64))
            held += len(sets[-1])
            if held >= PART_SHINGLES:
                yield _ids(ids), sets
                ids, sets, held = [], [], 0
        if ids:
            yield _ids(ids), sets


def _spread_sets(buckets: int, settle: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _parts_of_sets(batches):
            yield _spread(ids, sets, buckets, settle, int(ids[0]))

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (ids,), texts in common.texts_in_parts(batches, ["doc"], "text", PART_BYTES):
        found = [s.tobytes() for s in shingle_sets(texts)]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.binary())], ["doc", "shingles"])


def _frequencies(table: pa.Table) -> pa.Table:
    """Of one bucket: the shingles that documents share, with their frequencies, by home."""
    bucket, buckets = table["bucket"][0].as_py(), table["buckets"][0].as_py()
    hashes, docs = _joined(table["hashes"], np.uint32), np.repeat(_joined(table["docs"], np.int64), _joined(table["counts"], np.int32))
    _, group, times = np.unique(hashes, return_inverse=True, return_counts=True)
    often = times[group]
    shared = often > 1
    docs, often = docs[shared], often[shared].astype(np.int32)
    tokens = hashes[shared].astype(np.int64) | bucket << 32
    rows = [(h, *x) for h, x in _by_home(buckets, docs, tokens, often)]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["home", "docs", "tokens", "often"])


def _prefixes(table: pa.Table, alive: pa.Table) -> pa.Table:
    """Of the documents of one home: their prefix shingles that others share; with each, the
    smallest shingle that the document shares and the part of its set that it shares."""
    docs, tokens, often = _joined(table["docs"], np.int64), _joined(table["tokens"], np.int64), _joined(table["often"], np.int32)
    order = np.lexsort((tokens, often, docs))
    docs, tokens = docs[order], tokens[order]
    known = alive["doc"].to_numpy()
    place = np.argsort(known)
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(docs)))
    n = alive["n"].to_numpy()[place][np.searchsorted(known[place], docs[first])]
    length = n - -(-n * common.NEAR_PERCENT // 100) + 1
    # Shingles of a document alone are the rarest and come first.
    routed = np.clip(length - (n - count), 0, count)
    keep = np.arange(len(docs)) - np.repeat(first, count) < np.repeat(routed, count)
    mixed = vectors.mix(tokens.view(np.uint64)).view(np.int64)
    smallest = np.minimum.reduceat(mixed, first) if len(first) else mixed
    spread = lambda values: pa.array(np.repeat(values, count)[keep])
    return pa.table(
        [pa.array(docs[keep]), pa.array(tokens[keep]), spread(smallest), spread(count / np.maximum(1, n))],
        names=["doc", "token", "smallest", "ratio"],
    )


def tree_join(probes: list[np.ndarray], sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the numbers of the probes whose Jaccard similarity with it reaches the
    threshold; all are arrays of distinct shingles."""
    known, times = np.unique(np.concatenate([*probes, *sets]), return_counts=True)
    rank = np.empty(len(known), np.int64)
    rank[np.argsort(-times, kind="stable")] = np.arange(len(known))
    paths = [np.sort(rank[np.searchsorted(known, x)]) for x in sets]
    order = sorted(range(len(sets)), key=lambda i: paths[i].astype(">u4").tobytes())
    # Length in common with the set before, and the length of each, in this order.
    shared = np.zeros(len(order), np.int64)
    for at, (i, j) in enumerate(zip(order, order[1:]), 1):
        m = min(len(paths[i]), len(paths[j]))
        apart = np.flatnonzero(paths[i][:m] != paths[j][:m])
        shared[at] = apart[0] if len(apart) else m
    length = np.array([len(paths[i]) for i in order], np.int64)
    step = max(1, CELLS // max(1, len(known)))
    for low in range(0, len(probes), step):
        some = probes[low : low + step]
        sizes = np.fromiter(map(len, some), np.int64, len(some))
        holds = np.zeros((len(known), len(some)), bool)
        for k, probe in enumerate(some):
            holds[rank[np.searchsorted(known, probe)], k] = True
        # Subtrees: a range of sets, the depth that has been walked, the probes still open there
        # and their overlaps with the path so far.
        subtrees = [(0, len(order), 0, np.arange(len(some)), np.zeros(len(some), np.int64))] if len(order) else []
        while subtrees:
            first, last, depth, open_probes, overlap = subtrees.pop()
            inner = shared[first + 1 : last]
            fork = int(inner.min()) if len(inner) else int(length[first])
            if fork > depth:
                path = paths[order[first]][depth:fork]
                overlap = overlap + holds[np.ix_(path, open_probes)].sum(axis=0)
            # The sets below are between the shortest and the longest long; no more than the rest of
            # the longest can still be in common.
            shortest, longest = length[first:last].min(), length[first:last].max()
            need = -(-common.NEAR_PERCENT * (shortest + sizes[open_probes]) // (100 + common.NEAR_PERCENT))
            still = overlap + longest - fork >= need
            open_probes, overlap = open_probes[still], overlap[still]
            if not len(open_probes):
                continue
            if last - first == 1:
                yield order[first], open_probes + low
                continue
            edges = [first, *(np.flatnonzero(inner == fork) + first + 1).tolist(), last]
            subtrees.extend((i, j, fork, open_probes, overlap) for i, j in zip(edges, edges[1:]))


def _compare(table: pa.Table) -> pa.Table:
    """Of one block: links that connect whatever its probes and the others connect."""
    docs = table["doc"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    probe = np.flatnonzero(table["probe"].to_numpy())
    other = np.flatnonzero(table["other"].to_numpy())
    label = np.arange(len(docs))
    a, b = [], []
    for i, linked in tree_join([sets[k] for k in probe], [sets[k] for k in other]):
        mine = label[other[i]]
        for group in np.unique(label[probe[linked]]).tolist():
            if group != mine:
                a.append(docs[group])
                b.append(docs[mine])
                label[label == group] = mine
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _links(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) found in blocks, rows of key (a struct), doc, probe and other."""
    filled = blocks.join(sets, "doc")
    return common.checkpointed(filled.groupBy("key").applyInArrow(_compare, "a long, b long"))


def _key(kind: int, *parts: Column | str) -> Column:
    names = ("x", "y", "z")
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    columns += [F.lit(0)] * (3 - len(columns))
    return F.struct(F.lit(kind).alias("kind"), *[c.cast("long").alias(n) for n, c in zip(names, columns)])


def _chunk(count: Column) -> Column:
    return F.pmod(F.xxhash64("doc"), F.ceil(count / BLOCK)).cast("int")


def _pivot_blocks(large: DataFrame) -> DataFrame:
    """Each document of a large cluster with one that has the same smallest shared shingle, the
    one that shares most of its set."""
    pivots = large.groupBy("smallest").agg(
        F.max_by("doc", F.struct("ratio", -F.col("doc"))).alias("pivot"), F.count(F.lit(1)).alias("k")
    )
    partners = large.join(pivots, "smallest").where("doc != pivot").withColumn("chunk", _chunk(F.col("k")))
    yes, no = F.lit(True), F.lit(False)
    key = _key(1, "pivot", "chunk").alias("key")
    return partners.select(key, "doc", no.alias("probe"), yes.alias("other")).unionByName(
        partners.select(key, F.col("pivot").alias("doc"), yes.alias("probe"), no.alias("other")).distinct()
    )


def _rest_blocks(large: DataFrame, found: DataFrame) -> DataFrame:
    """Blocks of the documents outside each large cluster's largest component, with each other
    and with that component."""
    placed = common.checkpointed(
        large.select("doc", "cluster")
        .join(found.withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn("component", F.coalesce("component", "doc"))
    )
    sizes = placed.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("k"))
    main = sizes.groupBy("cluster").agg(
        F.max_by("component", F.struct("k", -F.col("component"))).alias("main"),
        F.max("k").alias("inside"),
        (F.sum("k") - F.max("k")).alias("outside"),
    )
    told = placed.join(main.where("outside > 0"), "cluster")
    inside, outside = (F.ceil(F.col(c) / BLOCK) for c in ("inside", "outside"))
    rest = told.where("component != main").withColumn("chunk", _chunk(F.col("outside")))
    core = told.where("component = main").withColumn("chunk", _chunk(F.col("inside")))
    low, high = F.least("chunk", "to").alias("low"), F.greatest("chunk", "to").alias("high")
    yes, no = F.lit(True), F.lit(False)
    each_other = rest.withColumn("to", F.explode(common.upto(outside))).select(
        _key(2, "cluster", low, high).alias("key"), "doc",
        (F.col("chunk") <= F.col("to")).alias("probe"), (F.col("chunk") >= F.col("to")).alias("other"),
    )
    to_core = rest.withColumn("to", F.explode(common.upto(inside))).select(
        _key(3, "cluster", "chunk", "to").alias("key"), "doc", yes.alias("probe"), no.alias("other")
    )
    from_core = core.withColumn("to", F.explode(common.upto(outside))).select(
        _key(3, "cluster", "to", "chunk").alias("key"), "doc", no.alias("probe"), yes.alias("other")
    )
    return each_other.unionByName(to_core).unionByName(from_core)


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each id: id_col, n_shingles, component_id."""
    given = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    several = given.groupBy("doc").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    groups = _grouped(given) if several.isEmpty() else _grouped_rows(given)
    return groups.select(F.col("doc").alias(id_col), "n_shingles", "component_id")


def _grouped_rows(given: DataFrame) -> DataFrame:
    """Where rows repeat an id, each is compared by itself; then those of one id are one."""
    rows = common.checkpointed(given.withColumnRenamed("doc", "id").withColumn("doc", F.monotonically_increasing_id()))
    groups = common.checkpointed(_grouped(rows.select("doc", "text")))
    ids = rows.select("doc", "id")
    first = common.checkpointed(ids.groupBy("id").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1"))
    of_one_id = ids.join(first, "id").where("doc != a").select("a", F.col("doc").alias("b"))
    links = groups.where("doc != component_id").select(F.col("component_id").alias("a"), F.col("doc").alias("b"))
    found = connect(links.unionByName(of_one_id)).withColumnRenamed("node", "doc")
    placed = ids.join(groups, "doc").join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    placed = common.checkpointed(placed.select("id", "n_shingles", "component"))
    least = placed.groupBy("component").agg(F.min("id").alias("least"))
    named = placed.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component"))
    return named.join(least, "component").select(F.col("id").alias("doc"), "n_shingles", F.col("least").alias("component_id"))


def _grouped(given: DataFrame) -> DataFrame:
    """doc, n_shingles and component_id of rows (doc, text) with an id each."""
    spark = given.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(16, partitions, -(-common.planned_bytes(given) // BUCKET_BYTES))
    told = common.checkpointed(_credited(given.mapInArrow(_spread_texts(buckets), SPREAD), buckets))

    # Equal sets are one; those that share enough with others go on.
    near = lambda credit, n: 100 * credit >= common.NEAR_PERCENT * n
    classes = (
        told.where("n > 0")
        .groupBy("n", "fp1", "fp2")
        .agg(F.min("doc").alias("rep"), F.max("credit").alias("credit"), F.count(F.lit(1)).alias("copies"))
    )
    # Written, so that the join below is of plain reads and AQE splits a set that very many have.
    classes = common.checkpointed(classes)
    copied = (
        told.join(classes.where("copies > 1").select("n", "fp1", "fp2", "rep"), ["n", "fp1", "fp2"])
        .where("doc != rep")
        .select(F.col("rep").alias("a"), F.col("doc").alias("b"))
    )
    chosen = classes.where(near(F.col("credit"), F.col("n"))).select(F.col("rep").alias("doc"))
    sets = common.checkpointed(given.join(chosen, "doc", "left_semi").mapInArrow(_sets, "doc long, shingles binary"))
    alive = common.checkpointed(
        _credited(sets.mapInArrow(_spread_sets(buckets, True), SPREAD), buckets)
        .where((F.col("n") > 0) & near(F.col("credit"), F.col("n")))
        .select("doc", "n")
    )
    kept = sets.join(alive.select("doc"), "doc", "left_semi")

    shared = (
        kept.mapInArrow(_spread_sets(buckets, False), SPREAD)
        .withColumn("buckets", F.lit(buckets))
        .groupBy("bucket")
        .applyInArrow(_frequencies, "home long, docs binary, tokens binary, often binary")
    )
    homes = alive.withColumn("home", F.pmod("doc", F.lit(buckets)).cast("long"))
    rows = common.checkpointed(
        shared.groupBy("home")
        .cogroup(homes.groupBy("home"))
        .applyInArrow(_prefixes, "doc long, token long, smallest long, ratio double")
    )
    stars = rows.groupBy("token").agg(F.min("doc").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1")
    together = rows.join(stars, "token").where("a != doc").select("a", F.col("doc").alias("b"))
    clusters = connect(together).select(F.col("node").alias("doc"), F.col("component").alias("cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("g"))
    known = rows.groupBy("doc").agg(F.first("smallest").alias("smallest"), F.first("ratio").alias("ratio"))
    placed = common.checkpointed(clusters.join(sizes, "cluster").join(known, "doc"))
    small, large = placed.where(F.col("g") <= BLOCK), placed.where(F.col("g") > BLOCK)
    whole = small.select(_key(0, "cluster").alias("key"), "doc", F.lit(True).alias("probe"), F.lit(True).alias("other"))
    links = _links(whole.unionByName(_pivot_blocks(large)), sets)
    if not large.isEmpty():
        links = links.unionByName(_links(_rest_blocks(large, connect(links)), sets))

    found = connect(links.unionByName(copied))
    return (
        told.join(found.withColumnRenamed("node", "doc"), "doc", "left")
        .select(
            "doc",
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "doc").alias("component_id"),
        )
    )


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the size of its shingle set and its component."""
    return similar(common.read(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), shingle AS (
  SELECT DISTINCT r, unnest(
           CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM docs
), size AS (
  SELECT r, doc_id, count(s) AS n FROM docs LEFT JOIN shingle USING (r) GROUP BY r, doc_id
), pair AS (
  SELECT x.r AS a, y.r AS b, count(*) AS k
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.r < y.r GROUP BY 1, 2
), link AS (
  SELECT sa.doc_id AS a, sb.doc_id AS b FROM pair JOIN size sa ON sa.r = a JOIN size sb ON sb.r = b
  WHERE 100 * k >= 75 * (sa.n + sb.n - k)
), both_ways AS (
  SELECT a, b FROM link UNION ALL SELECT b, a FROM link
), reached AS (
  SELECT doc_id, doc_id AS other FROM size
  UNION
  SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.other
)
SELECT doc_id, CAST(max(n) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reached JOIN size USING (doc_id) GROUP BY doc_id
"""
