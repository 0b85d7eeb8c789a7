"""Suffix-array dedup: remove bytes of strings of LENGTH bytes that start in an earlier document.

A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller id.
Every step is exact; only the last one looks at more than hashes, and it decides.

1. Parts. Documents are gathered into compressed parts of a few megabytes, written once; what
   follows refers to parts by number, so a repeated task finds the same bytes.
2. Anchors. Of the GRAM-byte grams in each LENGTH-byte window, the one with the smallest hash (the
   leftmost if equal) is its anchor: equal windows have equal anchors at the same place. A part
   sends each anchor's hash once, to a bucket; the bucket tells which occur elsewhere or in two
   documents of the part. Windows of other anchors are unique.
3. Segments. The windows of a shared anchor are neighbours; the bytes that they span, some 50 to
   80, go to the anchor's bucket, equal ones of a part once, with their smallest document.
4. Suffix arrays. Each bucket joins its different segments to one text and sorts its suffixes in
   two stages: those smaller than their successors directly, by LENGTH bytes; the others follow
   from scanning the first-byte buckets in order, each suffix placing the one a byte before it.
   Adjacent common prefixes of LENGTH bytes make classes of equal windows, and each class has a
   smallest document, which goes back to the parts.
5. Each part marks the windows that start in an earlier document and cuts the bytes they cover.

A passage that a third of all documents hold is one segment a part, so no bucket grows with its
copies. The number of buckets follows from the bytes of the input, to bound memory.

Nulls and edges: a null text is empty; texts under LENGTH bytes lose nothing, those of any length are
read whole; a null id counts as the largest id there can be and stays null; rows with equal ids remove
nothing from each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import common, vectors

LENGTH = 50
GRAM = 20
PART_BYTES = 6_000_000
#: Buckets are at least so many times the shuffle partitions, and one for so many bytes of input.
BUCKETS_A_PARTITION = 3
BUCKET_BYTES = 64_000_000
#: The place of a null id among the others; what is told of it is told by a flag.
_NO_ID = np.iinfo(np.int64).max
_SPAN = LENGTH - GRAM + 1  # grams in a window


# -- suffix arrays ---------------------------------------------------------------------------


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the empty one is the smallest."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1:] = -1
    # Of equal bytes the next change decides.
    place = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(place[::-1])[::-1]] > 0


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes, sorted by their first `depth` bytes at least."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    rising = _smaller_than_next(text)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    direct = np.flatnonzero(rising)
    view = np.lib.stride_tricks.sliding_window_view(padded, depth)
    keys = np.ascontiguousarray(view[direct]).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys)]
    first = text[direct]
    # Zero bytes at the end compare as the end of the text, as they should: both are smallest.
    cuts = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([n - 1]))  # its successor, the empty suffix, comes first
    out = []
    for byte in range(256):
        # Suffixes that are larger than their successors; a run of the byte places one more each
        # time, in the order in which its own successor was placed.
        level = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        levels = []
        while len(level):
            levels.append(level)
            before = level[level > 0] - 1
            level = before[text[before] == byte]
        own = np.concatenate([*levels, direct[cuts[byte] : cuts[byte + 1]]])
        out.append(own)
        before = own[own > 0] - 1
        before = before[text[before] > byte]
        target = text[before]
        place = np.argsort(target, kind="stable")
        target, before = target[place], before[place]
        edges = np.flatnonzero(np.diff(target)) + 1
        for piece in np.split(before, edges) if len(before) else ():
            waiting[text[piece[0]]].append(piece)
    return np.concatenate(out)


def _smallest_documents(text: np.ndarray, starts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each window start, the smallest document of all windows with the same bytes."""
    owner = np.full(len(text), -1, np.int64)
    owner[starts] = np.arange(len(starts))
    order = suffix_order(text, LENGTH)
    order = owner[order]
    order = order[order >= 0]
    at = starts[order]
    words = np.ndarray((len(text) - 7,), np.dtype("<u8"), np.ascontiguousarray(text).data, strides=(1,))
    # The common prefix of neighbours, eight bytes at a time, as far as it matters.
    same = np.ones(max(0, len(at) - 1), bool)
    for offset in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        value = words[at + offset]
        same &= value[1:] == value[:-1]
    opens = np.flatnonzero(np.concatenate([[True], ~same])) if len(at) else np.zeros(0, np.int64)
    out = np.empty(len(starts), np.int64)
    if len(at):
        least = np.minimum.reduceat(docs[order], opens)
        out[order] = np.repeat(least, np.diff(np.append(opens, len(at))))
    return out


# -- parts -----------------------------------------------------------------------------------


PARTS = "part long, ids binary, named binary, sizes binary, texts binary"
_PART = ["part", "ids", "named", "sizes", "texts"]


def _write_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    pack = zstandard.ZstdCompressor(level=1).compress
    for number, ((ids,), texts) in enumerate(common.texts_in_parts(batches, ["doc"], "text", PART_BYTES)):
        known = np.array([_NO_ID if x is None else x for x in ids], np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        named = np.packbits([x is not None for x in ids])
        row = [first + number, known.tobytes(), named.tobytes(), sizes.tobytes(), pack(b"".join(texts))]
        kinds = [pa.int64(), *[pa.binary()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], _PART)


class Part:
    """A part's documents and the anchors of their windows."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.named = np.unpackbits(np.frombuffer(row["named"], np.uint8))[: len(self.ids)]
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        raw = zstandard.ZstdDecompressor().decompress(row["texts"]) if self.bounds[-1] else b""
        self.data = np.frombuffer(raw, np.uint8)
        n = len(self.data)
        inside = np.zeros(max(0, n - LENGTH + 1), bool)
        for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            inside[a : max(a, b - LENGTH + 1)] = True
        windows = np.flatnonzero(inside)
        if not len(windows):
            self.anchor = self.begin = self.end = self.owner = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, np.uint64)
            return
        grams = n - GRAM + 1
        value = lambda at: np.ndarray((grams,), np.dtype("<u8"), self.data.data, offset=at, strides=(1,))
        hashes = value(0) * np.uint64(0x9E3779B97F4A7C15)
        hashes ^= value(8) * np.uint64(0xC2B2AE3D27D4EB4F)
        hashes = vectors.mix(hashes ^ (hashes >> np.uint64(31)) ^ (value(GRAM - 8) * np.uint64(0x165667B19E3779F9)))
        # Hash above, place below: the smallest value is the smallest hash, the leftmost if equal.
        low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
        width = 1
        while width * 2 <= _SPAN:
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        low = np.minimum(low[: grams - _SPAN + 1], low[_SPAN - width :][: grams - _SPAN + 1])
        at = (low[windows] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # An anchor's windows are neighbours, and windows of two documents never share one.
        change = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        self.anchor, self.begin = at[change], windows[change]
        self.end = windows[np.append(change[1:], len(windows)) - 1] + LENGTH
        self.owner = np.searchsorted(self.bounds, self.begin, "right") - 1
        self.hashes = hashes[self.anchor]

    def distinct(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchor hashes by bucket, each anchor's number among them, whether two of the
        part's documents have it, and the bounds of the buckets."""
        key = _bucket(self.hashes, buckets).astype(np.uint64) << np.uint64(40) | self.hashes >> np.uint64(24)
        values, number = np.unique(key, return_inverse=True)
        most, least = np.full(len(values), -1), np.full(len(values), len(self.ids))
        np.maximum.at(most, number, self.owner)
        np.minimum.at(least, number, self.owner)
        # Rows with the same id are one document here.
        several = self.ids[np.maximum(most, 0)] != self.ids[np.minimum(least, len(self.ids) - 1)]
        several |= most - least > 1
        cuts = np.searchsorted(values >> np.uint64(40), np.arange(buckets + 1, dtype=np.uint64))
        return values, number, several, cuts

    def segments(self, shared: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Different segments of the shared anchors (bytes, smallest document, anchor hash) and the
        number of each shared anchor's segment."""
        raw = self.data.tobytes()
        known: dict[bytes, int] = {}
        spans = zip(self.begin[shared].tolist(), self.end[shared].tolist(), strict=True)
        number = np.fromiter(
            (known.setdefault(raw[a:b], len(known)) for a, b in spans), np.int64, len(shared)
        )
        docs = np.full(len(known), _NO_ID)
        np.minimum.at(docs, number, self.ids[self.owner[shared]])
        hashes = np.zeros(len(known), np.uint64)
        hashes[number] = self.hashes[shared]
        return list(known), docs, hashes, number


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(buckets)


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_KEYED = ["part", "bucket", "kind", "body"]
_KEYED_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
KEYED = "part long, bucket int, kind int, body binary"
_HASHES, _SHARED, _SEGMENTS, _LEAST = range(4)


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, _, several, cuts = Part(row).distinct(buckets)
                low, twice = values.astype(np.uint32), np.packbits(several)
                flags = np.unpackbits(twice)[: len(values)]
                rows = [
                    (row["part"], b, _HASHES, low[i:j].tobytes() + np.packbits(flags[i:j]).tobytes())
                    for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
                    if j > i
                ]
                yield _rows(rows, _KEYED, _KEYED_TYPES)

    return run


def _hash_count(body: bytes) -> int:
    """Of a body of n hashes and n bits: n."""
    return len(body) * 8 // 33


def _share(table: pa.Table) -> pa.Table:
    """Of one bucket: for each part, which of its hashes another document has."""
    bodies = table["body"].to_pylist()
    counts = [_hash_count(x) for x in bodies]
    low = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(bodies, counts, strict=True)])
    twice = np.concatenate(
        [np.unpackbits(np.frombuffer(x, np.uint8, offset=4 * n))[:n] for x, n in zip(bodies, counts, strict=True)]
    )
    _, group, times = np.unique(low, return_inverse=True, return_counts=True)
    shared = (times[group] > 1) | (twice > 0)
    ends = np.cumsum(counts)
    masks = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends.tolist(), counts, strict=True)]
    return pa.table(
        [table["part"], table["bucket"], pa.array([_SHARED] * len(masks), pa.int32()), pa.array(masks, pa.binary())],
        names=_KEYED,
    )


def _shared_anchors(part: Part, answers: list[dict], buckets: int) -> np.ndarray:
    """Numbers of the part's anchors that are shared."""
    values, number, _, cuts = part.distinct(buckets)
    shared = np.zeros(len(values), bool)
    for row in answers:
        if row["kind"] == _SHARED:
            i, j = cuts[row["bucket"]], cuts[row["bucket"] + 1]
            shared[i:j] = np.unpackbits(np.frombuffer(row["body"], np.uint8))[: j - i]
    return np.flatnonzero(shared[number])


def _send_segments(buckets: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            part = Part(row)
            texts, docs, hashes, _ = part.segments(_shared_anchors(part, right.to_pylist(), buckets))
            target = _bucket(hashes, buckets).astype(np.int64)
            order = np.argsort(target, kind="stable")
            cuts = np.searchsorted(target[order], np.arange(buckets + 1))
            pack = zstandard.ZstdCompressor(level=1).compress
            for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if j > i:
                    mine = [texts[k] for k in order[i:j].tolist()]
                    sizes = np.fromiter(map(len, mine), np.uint8, len(mine))
                    head = np.array([len(mine)], np.int64).tobytes()
                    body = head + docs[order[i:j]].tobytes() + sizes.tobytes() + b"".join(mine)
                    rows.append((row["part"], b, _SEGMENTS, pack(body)))
        return pa.Table.from_batches([_rows(rows, _KEYED, _KEYED_TYPES)])

    return run


def _join_suffixes(table: pa.Table) -> pa.Table:
    """Of one bucket: for each part's segments, the smallest document of each window."""
    unpack = zstandard.ZstdDecompressor().decompress
    known: dict[bytes, int] = {}
    numbers, docs = [], []
    for raw in map(unpack, table["body"].to_pylist()):
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        docs.append(np.frombuffer(raw, np.int64, n, 8))
        sizes = np.frombuffer(raw, np.uint8, n, 8 + 8 * n)
        ends = 8 + 9 * n + np.cumsum(sizes, dtype=np.int64)
        numbers.append(
            [known.setdefault(raw[e - s : e], len(known)) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        )
    least = np.full(len(known), _NO_ID)
    np.minimum.at(least, np.concatenate(numbers), np.concatenate(docs))
    sizes = np.fromiter(map(len, known), np.int64, len(known))
    text = np.frombuffer(b"".join(known), np.uint8)
    windows = sizes - LENGTH + 1
    ends = np.cumsum(windows)
    number = np.repeat(np.arange(len(sizes)), windows)
    starts = (np.cumsum(sizes) - sizes)[number] + np.arange(ends[-1]) - (ends - windows)[number]
    smallest = _smallest_documents(text, starts, least[number])
    pack = zstandard.ZstdCompressor(level=1).compress
    bodies = []
    for mine in numbers:
        chosen = np.array(mine)
        size = windows[chosen]
        total = np.cumsum(size)
        at = np.repeat((ends - windows)[chosen] - (total - size), size) + np.arange(total[-1])
        bodies.append(pack(smallest[at].tobytes()))
    return pa.table(
        [table["part"], table["bucket"], pa.array([_LEAST] * len(bodies), pa.int32()), pa.array(bodies, pa.binary())],
        names=_KEYED,
    )


RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept binary"
_RESULT = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]
_RESULT_TYPES = [*[pa.int64()] * 4, pa.binary()]


def _cut(buckets: int, digest: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            part, answers = Part(row), right.to_pylist()
            shared = _shared_anchors(part, answers, buckets)
            _, _, hashes, number = part.segments(shared)
            target = _bucket(hashes, buckets).astype(np.int64)
            order = np.argsort(target, kind="stable")
            cuts = np.searchsorted(target[order], np.arange(buckets + 1))
            windows = np.zeros(len(hashes), np.int64)
            windows[number] = part.end[shared] - part.begin[shared] - LENGTH + 1
            ends = np.cumsum(windows)
            least = np.zeros(ends[-1] if len(ends) else 0, np.int64)
            for answer in answers:
                if answer["kind"] == _LEAST:
                    mine = order[cuts[answer["bucket"]] : cuts[answer["bucket"] + 1]]
                    size = windows[mine]
                    total = np.cumsum(size)
                    at = np.repeat((ends - windows)[mine] - (total - size), size) + np.arange(total[-1])
                    least[at] = np.frombuffer(zstandard.ZstdDecompressor().decompress(answer["body"]), np.int64)
            # All windows of all shared anchors, with their document and the smallest one.
            size = windows[number]
            total = np.cumsum(size)
            step = np.arange(total[-1] if len(total) else 0) - np.repeat(total - size, size)
            start = np.repeat(part.begin[shared], size) + step
            smaller = least[np.repeat((ends - windows)[number], size) + step] < np.repeat(part.ids[part.owner[shared]], size)
            n = len(part.data)
            change = np.bincount(start[smaller], minlength=n + LENGTH + 1) - np.concatenate(
                [np.zeros(LENGTH, np.int64), np.bincount(start[smaller], minlength=n + 1)]
            )[: n + LENGTH + 1]
            gone = np.cumsum(change)[:n] > 0
            opens = gone & ~np.concatenate([[False], gone[:-1]])
            opens[part.bounds[:-1][part.sizes > 0]] = gone[part.bounds[:-1][part.sizes > 0]]
            removed, spans = vectors.sums(gone, part.bounds), vectors.sums(opens, part.bounds)
            for i, (a, b) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist(), strict=True)):
                kept = part.data[a:b][~gone[a:b]].tobytes()
                rows.append(
                    (
                        int(part.ids[i]) if part.named[i] else None,
                        b - a,
                        int(removed[i]),
                        int(spans[i]),
                        hashlib.sha256(kept).digest() if digest else kept,
                    )
                )
        return pa.Table.from_batches([_rows(rows, _RESULT, _RESULT_TYPES)])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row a row: id_col, n_bytes, n_removed, n_spans (maximal removed runs) and kept, the
    bytes that remain or, with `digest`, their SHA-256."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    parts = common.checkpointed(given.mapInArrow(_write_parts, PARTS))
    fewest = BUCKETS_A_PARTITION * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(fewest, -(-common.planned_bytes(given) // BUCKET_BYTES))
    shared = common.checkpointed(
        parts.mapInArrow(_send_anchors(buckets), KEYED).groupBy("bucket").applyInArrow(_share, KEYED)
    )
    by_part = parts.groupBy("part")
    segments = by_part.cogroup(shared.groupBy("part")).applyInArrow(_send_segments(buckets), KEYED)
    least = segments.groupBy("bucket").applyInArrow(_join_suffixes, KEYED)
    answers = shared.unionByName(least)
    cut = by_part.cogroup(answers.groupBy("part")).applyInArrow(_cut(buckets, digest), RESULT)
    return cut.withColumnRenamed("doc", id_col)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, bytes and runs removed, and a digest of the rest."""
    found = remove_repeats(common.read(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))
