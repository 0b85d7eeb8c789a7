"""SimHash near-duplicates: fingerprints that differ in few bits, met in the middle.

A text's fingerprint has a bit set where over half of its four-word shingle hashes have it. Two
fingerprints link at RADIUS = 4 or fewer differing bits. They do exactly if some value lies within
two bits of both, so every fingerprint emits all values within two bits of itself, its variants, and
fingerprints that meet at a variant are linked. Fingerprints that share a variant are all within four
bits of each other; they are linked to the first of them, never pair by pair, and checked.

Scale: equal fingerprints are one from the start, counted with partial aggregation. The 2,081
variants of a fingerprint are shuffled by their first bits: a fingerprint is sent once to each of the
37 groups (at eight bits) in which it has variants, with the number of flips that are left for the
other bits, and writes out its variants there. A group splits its variants by further bits until a
part is small, and drops parts with one fingerprint, so memory does not depend on the group. The
number of first bits follows from the number of fingerprints. Groups that are still too large, as
where very many fingerprints lie close together, are dealt again by eight more bits, as often as
needed. Each group tells a spanning forest of its links; components come from rounds of joins.

Nulls and edges: a null text, an empty one and one of white space only have fingerprint zero and are
linked like any other; a text of fewer than four words is one shingle; texts are read whole, whatever
their length; rows that repeat an id are each a document of its own; a null id takes part and is
never the smallest, so a component of null ids only has a null one; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common
from cohortlens.llm.components import connect, forest

SHINGLE = 4
SEED = 42
RADIUS = 4
HALF = RADIUS // 2
#: Variants of a group on average, and the most a group may have before it is dealt again.
GROUP_VARIANTS = 16_000_000
MOST_VARIANTS = 128_000_000
#: Variants a task holds at a time.
PART_VARIANTS = 500_000
#: First bits that the groups share, at least and at most; further bits of a group dealt again.
FIRST_BITS, LAST_BITS, MORE_BITS = 8, 16, 8

_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)
DEALT = "depth int, prefix long, variants long, prints binary, flips binary"


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of the shingles of a UTF-8 text, as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate([len(w) + 1 for w in words]))
    last = max(1, len(words) - SHINGLE + 1)
    stops = ends[SHINGLE - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends[: last - 1]], stops, strict=True)]
    return int(majority(np.array(hashes, "<u8")).view(np.int64))


def majority(hashes: np.ndarray) -> np.uint64:
    """The bits set in over half of some hashes."""
    told = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 1 << 16):
        some = hashes[low : low + (1 << 16)]
        told += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return _BITS[2 * told > len(hashes)].sum(dtype=np.uint64)


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        found = [fingerprint(x.as_py() or b"") for x in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, pa.int64())], ["doc", "print"])


def _masks(bits: int, flips: int) -> np.ndarray:
    """All values of `bits` bits with up to `flips` set, fewest first."""
    chosen = [sum(1 << i for i in c) for k in range(min(flips, bits) + 1) for c in combinations(range(bits), k)]
    return np.array(chosen, np.uint64)


def _count(bits: int, flips: int) -> int:
    return [1, 1 + bits, 1 + bits + bits * (bits - 1) // 2][min(flips, 2)]


def _weight(flips: np.ndarray, rest: int) -> int:
    """Variants that fingerprints with some flips left have in the other `rest` bits."""
    times = np.bincount(flips, minlength=HALF + 1)
    return int(sum(int(t) * _count(rest, f) for f, t in enumerate(times)))


def _split(prints: np.ndarray, flips: np.ndarray, depth: int, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Fingerprints dealt by the next `bits` bits of their variants: (those bits, fingerprints,
    flips left)."""
    shift = np.uint64(64 - depth - bits)
    mine = (prints >> shift) & np.uint64((1 << bits) - 1)
    masks = _masks(bits, HALF)
    used = np.bitwise_count(masks)
    pick = [np.flatnonzero(flips >= u) for u in range(HALF + 1)]
    keys = np.concatenate([mine[pick[u]] ^ m for m, u in zip(masks, used, strict=True)])
    which = np.concatenate([pick[u] for u in used])
    left = np.concatenate([flips[pick[u]] - u for u in used])
    order = np.argsort(keys, kind="stable")
    keys, which, left = keys[order], which[order], left[order]
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)]):
        yield int(keys[a]), prints[which[a:b]], left[a:b]


def _dealt(depth: int, bits: int, prefix: int, prints: np.ndarray, flips: np.ndarray) -> list[tuple]:
    rest = 64 - depth - bits
    return [
        (depth + bits, prefix << bits | key, _weight(left, rest), some.tobytes(), left.astype(np.uint8).tobytes())
        for key, some, left in _split(prints, flips, depth, bits)
    ]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["depth", "prefix", "variants", "prints", "flips"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _deal(bits: int):
    """Distinct fingerprints to the groups of their variants' first bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64)
            yield _batch(_dealt(0, bits, 0, prints, np.full(len(prints), HALF)))

    return run


def _deal_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            prints, flips = np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["flips"], np.uint8).astype(np.int64)
            yield _batch(_dealt(row["depth"], min(MORE_BITS, 63 - row["depth"]), row["prefix"], prints, flips))


def _stars(prints: np.ndarray, flips: np.ndarray, rest: int) -> np.ndarray:
    """Links (2 x k) that connect the fingerprints that share a variant in their last bits."""
    low = prints & np.uint64((1 << rest) - 1)
    variants, owners = [], []
    for f in range(HALF + 1):
        mine = np.flatnonzero(flips == f)
        if len(mine):
            masks = _masks(rest, f)
            variants.append((low[mine][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(mine, len(masks)))
    every, owner = np.concatenate(variants), np.concatenate(owners)
    # Most values stand alone; a table of coarse hashes sorts them out.
    size = max(12, int(len(every)).bit_length() + 1)
    slot = (every * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size)
    often = np.bincount(slot.astype(np.int64), minlength=1 << size)[slot] > 1
    every, owner = every[often], owner[often]
    order = np.lexsort((prints[owner], every))
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    head = owner[first[np.cumsum(new) - 1]] if len(first) else owner
    links = np.stack([prints[head], prints[owner]])[:, ~new]
    links = links[:, np.bitwise_count(links[0] ^ links[1]) <= RADIUS]
    return np.unique(links, axis=1) if links.shape[1] else links


def met(prints: np.ndarray, flips: np.ndarray, depth: int) -> np.ndarray:
    """Links (2 x k) that connect the fingerprints of a group that share a variant."""
    if len(prints) < 2:
        return np.zeros((2, 0), np.uint64)
    rest = 64 - depth
    if _weight(flips, rest) <= PART_VARIANTS or rest <= MORE_BITS:
        return _stars(prints, flips, rest)
    parts = [met(p, f, depth + 4) for _, p, f in _split(prints, flips, depth, 4)]
    return np.unique(np.concatenate(parts, axis=1), axis=1)


def _links(table: pa.Table) -> pa.Table:
    prints = np.frombuffer(b"".join(table["prints"].to_pylist()), np.uint64)
    flips = np.frombuffer(b"".join(table["flips"].to_pylist()), np.uint8).astype(np.int64)
    links = met(prints, flips, table["depth"][0].as_py()).view(np.int64)
    a, b = forest(links[0], links[1])
    return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])


def linked(prints: DataFrame, group_variants: int = GROUP_VARIANTS, most_variants: int = MOST_VARIANTS) -> DataFrame:
    """Pairs (a, b) that connect whatever values of column `print`, all distinct, are linked."""
    total = prints.count() * _count(64, HALF)
    bits = min(LAST_BITS, max(FIRST_BITS, (total // group_variants).bit_length()))
    dealt = common.checkpointed(prints.select("print").mapInArrow(_deal(bits), DEALT))
    ready = []
    while True:
        sizes = dealt.groupBy("depth", "prefix").agg(F.sum("variants").alias("size"))
        large = common.checkpointed(sizes.where((F.col("size") > most_variants) & (F.col("depth") < 48)).select("depth", "prefix"))
        if large.isEmpty():
            ready.append(dealt)
            break
        ready.append(dealt.join(large, ["depth", "prefix"], "left_anti"))
        dealt = common.checkpointed(dealt.join(large, ["depth", "prefix"], "left_semi").mapInArrow(_deal_again, DEALT))
    groups = ready[0]
    for more in ready[1:]:
        groups = groups.unionByName(more)
    return groups.groupBy("depth", "prefix").applyInArrow(_links, "a long, b long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc and print of every row."""
    given = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["doc"].dataType.simpleString()
    return given.mapInArrow(_prints, f"doc {kind}, print long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """One row for each row: id_col, fingerprint, component_id and n_copies, the rows that have the
    same fingerprint."""
    told = common.checkpointed(fingerprints(docs, id_col, text_col))
    classes = common.checkpointed(
        told.groupBy("print").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("copies"))
    )
    found = connect(linked(classes, **limits)).select(F.col("node").alias("print"), "component")
    placed = classes.join(found, "print")
    smallest = placed.groupBy("component").agg(F.min("first").alias("least"))
    known = placed.join(smallest, "component").select("print", "least")
    # Both sides of the last join are plain reads, so AQE splits a fingerprint of very many rows.
    answer = common.checkpointed(
        classes.join(known, "print", "left").select("print", F.coalesce("least", "first").alias("component_id"), "copies")
    )
    return told.join(answer, "print").select(
        F.col("doc").alias(id_col),
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("copies").alias("n_copies"),
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its fingerprint and the smallest id of its component."""
    return near_copies(common.read(spark, sf_dir, "documents"))
