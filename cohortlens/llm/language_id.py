"""Language by compression: the language whose dictionary shortens a text most.

For each language a raw-content dictionary is cut from labelled rows. A text is split into chunks
of CHUNK_BYTES, so that a long one cannot learn its language from itself; each chunk is compressed
with every dictionary, and the language with the smallest total wins (ties: the one with more
training rows, then the smaller name). Case, digits and ASCII punctuation do not count. The
score is the runner-up's excess over the winner as a share of the runner-up; below MARGIN the
answer is `rejected`, but still given.

Bounds: each dictionary holds at most DICTIONARY_BYTES, of SAMPLE_ROWS training rows a language at
most (those with the smallest hash of their id), each of which gives an equal share from its
middle. The number of languages is that of the distinct labels.

Nulls and edges: rows without a label teach nothing; a null text or one without a letter is `und`
with score 0, and so is every text when there is nothing to learn from; with one language its
score is 1. Texts that are equal get the same answer. Only text and label of training rows are
used, and only the text of the row that is judged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import common

#: Training rows a language at most, and bytes of their dictionary.
SAMPLE_ROWS = 400
DICTIONARY_BYTES = 112_000
CHUNK_BYTES = 2_048
#: Short common words tell languages apart, so matches of four bytes count.
SETTINGS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=16, chain_log=16, search_log=3,
    compression_level=5, write_checksum=0, write_content_size=0, write_dict_id=0,
)
#: A score below this is rejected as too close to call.
MARGIN = 0.02
UNKNOWN = "und"
PART_BYTES = 4_000_000
LETTER = regex.compile(r"\p{L}")
#: ASCII characters that are no letters count as a space.
_LETTERS_ONLY = bytes(b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))


def _plain(text: str) -> bytes:
    return text.lower().encode().translate(_LETTERS_ONLY)


def dictionaries(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id"
) -> dict[str, bytes]:
    """Raw-content dictionaries by language, those with more rows first, from labelled rows."""
    known = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("string")).alias("key"),
    )
    rows = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Twice the wanted share of each language leaves SAMPLE_ROWS after the exact cut below.
    rate = F.lit(0.0)
    for lang, n in rows.items():
        rate = F.when(F.col("lang") == lang, 2 * SAMPLE_ROWS / n).otherwise(rate)
    size = F.length("text")
    share = 4 * DICTIONARY_BYTES // SAMPLE_ROWS
    begin = F.greatest(F.lit(1), F.floor(size / 2 - share / 2).cast("int"))
    sample = known.where(F.pmod("key", F.lit(1 << 32)) <= rate * (1 << 32)).select(
        "lang", "key", F.substr("text", begin, F.lit(share)).alias("piece")
    )
    # However often a key occurs, as where ids repeat or are null, only so many pieces are taken.
    first = Window.partitionBy("lang").orderBy("key", "piece")
    sample = sample.withColumn("place", F.row_number().over(first)).where(F.col("place") <= SAMPLE_ROWS)
    taught: dict[str, list] = {}
    for row in sample.collect():  # SAMPLE_ROWS short pieces a language at most
        taught.setdefault(row["lang"], []).append((row["key"], row["piece"]))
    return {lang: _dictionary(taught[lang]) for lang in sorted(taught, key=lambda x: (-rows[x], x))}


def _dictionary(rows: list[tuple[int, str]]) -> bytes:
    pieces = [_plain(text) for _, text in sorted(rows)]
    # An equal share of each; what short ones leave goes to the others.
    share = DICTIONARY_BYTES // len(pieces)
    spare = DICTIONARY_BYTES - sum(min(len(x), share) for x in pieces)
    longer = sum(len(x) > share for x in pieces)
    share += spare // longer if longer else 0
    return b"\n".join(x[:share] for x in pieces)[:DICTIONARY_BYTES]


def _compressors(given: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for lang in given:
        known = zstandard.ZstdCompressionDict(given[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=SETTINGS)
        out.append(zstandard.ZstdCompressor(compression_params=SETTINGS, dict_data=known))
    return out


def predict(docs: DataFrame, given: dict[str, bytes], keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns `keep` of each row, lang_pred, score and rejected."""
    langs = list(given)

    def judge(text: bytes, compressors: list) -> tuple[str, float]:
        decoded = text.decode()
        if not langs or not LETTER.search(decoded):
            return UNKNOWN, 0.0
        plain = _plain(decoded)
        chunks = [plain[i : i + CHUNK_BYTES] for i in range(0, len(plain), CHUNK_BYTES)]
        sizes = [sum(len(c.compress(x)) for x in chunks) for c in compressors]
        if len(sizes) == 1:
            return langs[0], 1.0
        best, second = np.argsort(sizes, kind="stable")[:2]
        return langs[best], (sizes[second] - sizes[best]) / sizes[second]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(given)
        for batch in batches:
            found = [
                judge(text, compressors)
                for _, texts in common.texts_in_parts(iter([batch]), [], "#text", PART_BYTES)
                for text in texts
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(keep))],
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([x for _, x in found], pa.float64()),
                    pa.array([x < MARGIN for _, x in found], pa.bool_()),
                ],
                [*keep, "#lang_pred", "#score", "#rejected"],
            )

    schema = docs.select(*keep).schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
        schema = schema.add(f"#{name}", kind)
    out = docs.select(*keep, F.col(text_col).alias("#text")).mapInArrow(run, schema)
    return out.select(*keep, *[F.col(f"#{n}").alias(n) for n in ("lang_pred", "score", "rejected")])


def held_out(id_col: str = "doc_id") -> Column:
    """A third of the rows, by a checksum of their id."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, the language, its score and whether it is close."""
    docs = common.read(spark, sf_dir, "documents")
    given = dictionaries(docs.where(~held_out() & F.col("lang").isNotNull()))
    flagged = docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    return predict(flagged, given, ["doc_id", "held_out"])
