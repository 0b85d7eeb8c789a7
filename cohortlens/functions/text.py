"""Message normalization, validation and intent rules, all as built-in expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_MESSAGE_LENGTH = 2000

# White space removed by trimming a message.
WHITESPACE = "".join(
    map(chr, [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])
)


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters for one ``translate`` call that removes accents.

    From the Unicode database: every character that decomposes to an ASCII letter plus marks
    U+0300..U+036F, paired with that letter. The marks themselves follow without a pair,
    which deletes them.
    """
    marks_alone = "".join(map(chr, range(0x300, 0x370)))
    accented, plain = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and base.isascii() and base.isalnum() and all(0x300 <= ord(m) <= 0x36F for m in marks):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented) + marks_alone, "".join(plain)


def normalize(text: Column, fold_d: bool = False) -> Column:
    """Lower case, accents removed, everything but ``a-z 0-9 %`` and space to a space, trimmed.

    The letter d with stroke has no decomposition and becomes a space unless ``fold_d``.
    """
    lowered = F.lower(text)
    if fold_d:
        lowered = F.translate(lowered, "đ", "d")
    plain = F.translate(lowered, *_accent_table())
    return F.trim(F.regexp_replace(plain, "[^a-z0-9% ]+", " "))


# Ordered intent rules; each rule needs one word of every group.
INTENT_RULES = [
    ("student_average", [["diem trung binh", "avg grade", "gpa", "average score"]]),
    (
        "lowest_course",
        [["mon", "subject", "course"], ["thap", "lowest", "kem", "bad", "yeu"]],
    ),
    (
        "study_tips",
        [["bi quyet", "cai thien", "tip", "goi y", "improve", "chien luoc"]],
    ),
]


def intent(normalized: Column) -> Column:
    """First matching rule of a normalized message, else null."""
    expr = F
    for name, groups in INTENT_RULES:
        matches = F.lit(True)
        for words in groups:
            any_word = F.lit(False)
            for word in words:
                any_word = any_word | normalized.contains(word)
            matches = matches & any_word
        expr = expr.when(matches, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def utf16_length(text: Column) -> Column:
    """Length in UTF-16 units: a character outside the basic plane counts twice."""
    return F.octet_length(F.encode(text, "UTF-16BE")) / 2


def reject_reason(text: Column, limit: int = MAX_MESSAGE_LENGTH) -> Column:
    """Why a message is refused; null when it is accepted."""
    body = trimmed(text)
    return (
        F.when(text.isNull(), "missing")
        .when(body == "", "empty")
        .when(utf16_length(body) > limit, "too_long")
    )
