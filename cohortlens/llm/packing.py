"""Best-fit packing of tokenized documents into full sequences, with cuts.

Each document becomes its token ids and one END id. Whole windows of the largest size are cut off
first. What is left of the documents fills further windows of that size, longest pieces first:
gaps are filled with the longest pieces that fit, and what remains is filled by cutting one more
piece, so windows are full. There are no windows of the smaller sizes but at the end of a
partition, where the pieces that are left make up further full windows and one sequence for each
power of two in the rest, so nothing is padded.

Sequences of one size in a partition are numbered in turn and joined to step groups of GROUP
sequences, each group with the same number of tokens (but for the last of a size and partition).

Partitions are packed on their own, in parts of PART_BYTES of text, with the pieces that are still
open carried over; nothing is shuffled, memory is bounded by a part and the longest document, and
a repeated task makes the same sequences, as long as its input comes in the same order.

Nulls and edges: a null or empty text is the END id alone; null and repeated ids are carried (each
row is a document of its own); other columns are ignored; an empty table gives no sequences.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType
from tokenizers import Tokenizer
from tokenizers.models import Model

from cohortlens.llm import common

END = 1
CONTEXTS = (256, 512, 1024, 2048)
GROUP = 8
PART_BYTES = 4_000_000
#: Distinct words a worker remembers with their ids before it drops those that did not come again.
CACHE_WORDS = 200_000
#: Words that Unicode normalization leaves alone.
PLAIN = re.compile("[\x21-\x7E\u00C0-\u00FF]+")
#: The characters that byte-level models use for bytes: printable ones stand for themselves, the
#: others, in order, for those from 256 on.
BYTE_CHARS = {
    b: 256 + n
    for n, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))
}
SCHEMA = (
    "`{id}` {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long, context long, step_group long"
)


class Parts(dict):
    """Ids of parts of words, by part; those not yet known are merged by the model."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, part: str) -> bytes:
        mapped = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = [t.id for t in self.model.tokenize(mapped)]
        known = self[part] = struct.pack(f"<{len(ids)}I", *ids)
        return known


class Encoder:
    """Token ids of many texts; words between white space are encoded once and remembered.

    The tokenizer drops white space and never joins what stands on both sides of it. Words of
    ASCII and Latin-1 letters, which Unicode normalization leaves alone, are lower-cased and cut by
    the tokenizer's own pattern here and merged by its model; all others take its full path.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        described = json.loads(self.tokenizer.to_str())
        self.cut = regex.compile(described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.place, self.parts = {"": 0}, Parts(self.tokenizer.model)
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.hits = np.zeros(1, np.int64)

    def _forget(self) -> None:
        """Drops the words that one part alone had, or none since the last time; half the room is left."""
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        again = np.flatnonzero(self.hits > 1)
        again = again[again > 0][: CACHE_WORDS // 2]
        words = list(self.place)
        self.place = {"": 0} | {words[w]: n for n, w in enumerate(again.tolist(), 1)}
        begins, sizes = (np.cumsum(self.sizes) - self.sizes)[again], self.sizes[again]
        self.ids = self.ids[np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        self.sizes = np.append(0, sizes)
        self.hits = np.ones(len(self.sizes), np.int64)

    def _learn(self, new: list[str]) -> None:
        found, sizes = [], []
        plain, cut, known = PLAIN.fullmatch, self.cut.findall, self.parts.__getitem__
        for word in new:
            if plain(word) and "<|" not in word:
                ids = b"".join(map(known, cut(word.lower())))
            else:
                ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
            found.append(ids)
            sizes.append(len(ids) // 4)
        self.place.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new)), strict=True))
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        self.sizes = np.concatenate([self.sizes, np.array(sizes, np.int64)])
        self.hits = np.concatenate([self.hits, np.zeros(len(new), np.int64)])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.sizes) > CACHE_WORDS:
            self._forget()
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        bounds = np.asarray(lists.offsets)
        coded = lists.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([w for w in distinct if w not in self.place])
        place = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        self.hits[place] += 1
        begins = (np.cumsum(self.sizes) - self.sizes)[place]
        words = np.asarray(coded.indices)
        size = self.sizes[place][words]
        ends = np.cumsum(size)
        flat = np.repeat(begins[words] - (ends - size), size)
        flat += np.arange(len(flat))
        cuts = np.concatenate([[0], ends])[bounds]
        tokens = self.ids[flat]
        return [
            np.append(tokens[a:b], np.uint32(END))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
        ]


#: Encoders by path; a worker that runs several tasks keeps its remembered words.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Tiers:
    """Open pieces by length; a piece is (document, start, ids, tokens of the document)."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.pieces: list[tuple] = []

    def add(self, piece: tuple) -> None:
        at = bisect.bisect_right(self.sizes, len(piece[2]))
        self.sizes.insert(at, len(piece[2]))
        self.pieces.insert(at, piece)

    def take(self, most: int) -> tuple | None:
        """The longest piece of at most `most` ids."""
        at = bisect.bisect_right(self.sizes, most) - 1
        if at < 0:
            return None
        self.sizes.pop(at)
        return self.pieces.pop(at)

    def cut(self, size: int) -> tuple:
        """`size` ids off the shortest piece; none is shorter than that."""
        self.sizes.pop(0)
        doc, start, ids, total = self.pieces.pop(0)
        if len(ids) > size:
            self.add((doc, start + size, ids[size:], total))
        return doc, start, ids[:size], total

    def window(self, size: int) -> list[tuple]:
        """Pieces that fill a window of `size`; at least as many ids are open."""
        chosen, gap = [], size
        while gap:
            piece = self.take(gap) or self.cut(gap)
            chosen.append(piece)
            gap -= len(piece[2])
        return chosen

    def tier(self, low: int) -> bool:
        """Whether a piece is longer than `low`."""
        return bool(self.sizes) and self.sizes[-1] > low


def _sequences(parts: Iterator[tuple[list, list[np.ndarray]]]) -> Iterator[list[tuple]]:
    """Pieces of each sequence."""
    largest = CONTEXTS[-1]
    tiers, waiting = Tiers(), 0
    for docs, texts in parts:
        for doc, ids in zip(docs, texts, strict=True):
            whole = len(ids) // largest * largest
            for start in range(0, whole, largest):
                yield [(doc, start, ids[start : start + largest], len(ids))]
            if whole < len(ids):
                tiers.add((doc, whole, ids[whole:], len(ids)))
                waiting += len(ids) - whole
        # Long tiers lead; the shortest pieces stay open, to fill gaps of the next part.
        for low in reversed((0, *CONTEXTS[:-1])):
            while tiers.tier(low) and waiting >= 8 * largest:
                yield tiers.window(largest)
                waiting -= largest
    while waiting:
        size = largest if waiting >= largest else 1 << (waiting.bit_length() - 1)
        yield tiers.window(size)
        waiting -= size


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of a document in a sequence, with its ids as 32-bit little-endian."""
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        parts = (
            (ids, encoder.encode(texts))
            for (ids,), texts in common.texts_in_parts(batches, [id_col], text_col, PART_BYTES)
        )
        first = TaskContext.get().partitionId() << 32
        made: dict[int, int] = {}
        rows: list[tuple] = []
        held = 0
        for number, pieces in enumerate(_sequences(parts)):
            context = sum(len(ids) for _, _, ids, _ in pieces)
            nth = made[context] = made.get(context, -1) + 1
            # Groups of different sizes never share a number: sizes are powers of two up to 2^11.
            group = first | (nth // GROUP) << 4 | context.bit_length()
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), ids.astype("<u4").tobytes(), total, first | number, offset, context, group))
                offset += len(ids)
            held += context
            if held >= 500_000:
                yield _batch(rows, id_col, id_type)
                rows, held = [], 0
        if rows:
            yield _batch(rows, id_col, id_type)

    schema = SCHEMA.format(id=id_col, id_type=id_type.simpleString())
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _batch(rows: list[tuple], id_col: str, id_type: DataType) -> pa.RecordBatch:
    long = pa.int64()
    kinds = [to_arrow_type(id_type), long, long, pa.binary(), *[long] * 5]
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step_group"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def tokenizer_path() -> str:
    """The vocabulary the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, with a checksum of its ids in place of the ids."""
    packed = pack(common.read(spark, sf_dir, "documents"), tokenizer_path())
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
