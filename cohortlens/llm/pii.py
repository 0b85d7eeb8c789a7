"""Personal data: regular expressions propose spans, checksums confirm them, context adds score.

Base kinds, always kept once they pass their check: email, ip (parts up to 255), card (16 to 19
digits, Luhn), phone (8 to 15 digits). Kinds the method adds: iban (mod-97 confirms it), ssn and
secret, a run of SECRET_CHARS characters or more with letters and digits, as evenly mixed as a key is.
Neither of the last two has a checksum, so a word such as "ssn" or "token" must stand nearby. Each kind
is found on its own, leftmost and without overlaps; spans of different kinds may overlap.

A span scores 0.5 for its format, 0.3 for a checksum that can fail and holds, and 0.2 for a context
word within CONTEXT_CHARS; added kinds need ADDED_SCORE. Positions are code points, ends exclusive.

DataFrame expressions only. Splitting a text by a pattern and extracting the pattern's matches walk
the same matches, so the pieces between them give the positions. Only matches are shuffled, by row.

Nulls and edges: a null text is empty and has no spans; null ids are carried; each row of the input
gives one row, repeated or not; other columns are ignored. Patterns take possessive quantifiers and
start only where a run of their characters starts (or the last match ended): the same matches, but
neither deep recursion nor quadratic time on very long runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortlens.llm import common

CONTEXT_CHARS = 40
ADDED_SCORE = 0.7
#: A secret has so many characters at least, and its characters so many bits each on average.
SECRET_CHARS, SECRET_BITS = 20, 3.0


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A cheap test that every text with a match passes.
    hint: str
    context: tuple[str, ...]
    base: bool = True
    checksum: bool = False


# The kinds in their order, their patterns and context words.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        ("mail", "contact", "write"),
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        ("ip", "host", "server", "address"),
    ),
    Kind(
        "card",
        r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
        "",
        ("card", "visa", "credit", "payment"),
        checksum=True,
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", ("phone", "call", "tel", "mobile")),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "",
        ("iban", "account", "bank", "konto"),
        base=False,
        checksum=True,
    ),
    Kind(
        "ssn",
        r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
        "-",
        ("ssn", "social security"),
        base=False,
    ),
    Kind(
        "secret",
        rf"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{{{SECRET_CHARS},}}+",
        "",
        ("token", "secret", "passw", "pwd", "api.?key", "access.?key", "private.?key", "bearer", "credential"),
        base=False,
    ),
)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's sum over a string of digits ends in zero."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    parts = F.transform(
        F.filter(numbers, lambda d: d.isNotNull()),
        lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d),
    )
    return F.aggregate(parts, F.lit(0), lambda a, d: a + d) % 10 == 0


def _mod97(iban: Column) -> Column:
    """The rearranged account number leaves 1 modulo 97; letters count from A = 10."""
    flat = F.regexp_replace(iban, r"\x20", "")
    turned = F.concat(F.substr(flat, F.lit(5)), F.substr(flat, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    step = lambda a, v: (F.when(v > 9, a * 100).otherwise(a * 10) + v) % 97
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, value), F.lit(0), step) == 1


def _bits(text: Column) -> Column:
    """Entropy of a text's characters, in bits a character."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    shares = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars))
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p))


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    small = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
    return (
        F.when(kind == "ip", match.rlike(small))
        .when(kind == "card", F.length(digits).between(16, 19) & _luhn(digits))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .when(kind == "iban", _mod97(match))
        .when(kind == "secret", match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (_bits(match) >= SECRET_BITS))
        .otherwise(F.lit(True))
    )


def _proposed(text: Column, number: int, kind: Kind) -> Column:
    """Matches of a kind: number, index, code points since the last match, match, surroundings."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    # Arrays are put side by side, as what stands in a lambda is computed anew for each match.
    before = F.zip_with(matches, pieces, lambda m, x: F.struct(m.alias("m"), x.alias("before")))
    beside = F.zip_with(before, F.slice(pieces, 2, 2**31 - 1), lambda x, y: F.struct(x["m"].alias("m"), x["before"].alias("before"), y.alias("after")))
    found = F.transform(
        F.filter(beside, lambda x: x["m"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(number).alias("number"),
            i.alias("at"),
            F.length(x["before"]).alias("gap"),
            x["m"].alias("match"),
            F.lower(
                F.concat_ws(" ", F.right(x["before"], F.lit(CONTEXT_CHARS)), F.left(x["after"], F.lit(CONTEXT_CHARS)))
            ).alias("around"),
        ),
    )
    present = text.rlike(kind.pattern)
    return F.when(text.contains(kind.hint) & present, found) if kind.hint else F.when(present, found)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: id_col and spans, an array of kind number, kind, start, end, text,
    score and base, sorted by kind and start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = "array<struct<number:int,at:int,gap:int,match:string,around:string>>"
    itself = F.array(F.struct(F.lit(-1), F.lit(0), F.lit(0), F.lit(None), F.lit(None))).cast(none)
    proposed = F.concat(
        itself, *[F.coalesce(_proposed(text, n, k), F.array().cast(none)) for n, k in enumerate(KINDS)]
    )
    # Rows are numbered by their place in the input, so that one shuffle by row serves both steps.
    rows = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), proposed.alias("p"))
        .select("row", "id", F.explode("p").alias("p"))
        .select("row", "id", "p.*")
        .repartition("row")
    )
    length = F.coalesce(F.length("match"), F.lit(0))
    order = Window.partitionBy("row", "number").orderBy("at")
    end = F.sum(F.col("gap") + length).over(order.rowsBetween(Window.unboundedPreceding, 0))
    kind = F.get(F.array(*[F.lit(k.name) for k in KINDS]), F.col("number"))
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("number"))
    context = pick("|".join(k.context) for k in KINDS)
    score = (
        F.lit(0.5)
        + F.when(pick(k.checksum for k in KINDS), 0.3).otherwise(0.0)
        + F.when(F.regexp(F.col("around"), context), 0.2).otherwise(0.0)
    )
    placed = rows.withColumns({"end": end, "kind": kind, "base": pick(k.base for k in KINDS)})
    checked = placed.withColumns({"score": score, "start": F.col("end") - length}).withColumn(
        "stays",
        (F.col("number") >= 0)
        & _valid(F.col("kind"), F.col("match"))
        & (F.col("base") | (F.col("score") >= ADDED_SCORE)),
    )
    span = F.struct("number", "kind", "start", "end", F.col("match").alias("text"), "score", "base")
    return (
        checked.groupBy("row")
        .agg(
            F.first("id").alias(id_col),
            F.array_sort(F.collect_list(F.when(F.col("stays"), span))).alias("spans"),
        )
        .drop("row")
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, all spans, and how many of
    them there are and are secrets."""
    found = find(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        "doc_id",
        *[count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(told(base), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
        count("secret").alias("n_secret"),
    )
