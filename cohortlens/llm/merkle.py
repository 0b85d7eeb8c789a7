"""Merkle manifest of a table: a hash tree for each group of rows, and one over the groups' roots.

Every row is a leaf, the digest of its fields. Leaves of a group stand in the order of their ids;
level by level, each run of eight consecutive nodes becomes the digest of their digests, until one,
the subroot, is left. The subroots in the order of their groups make the same kind of tree, up to
the root. A row's proof is, for each level, what stands to the left and to the right of its node
in the run: whoever has the row and its proof can compute the root, and any change shows.

Method: three levels are one window, over blocks of 512 nodes. Per level, lag and lead columns at the
fixed offsets 1 to 7, times 8 or 64 on the upper levels, masked by the node's slot and the length of
its run, supply the siblings, and the row of the run's first child hashes the run into the parent.
The blocks' digests are the nodes of the next three levels, and are checkpointed. Then proofs are
handed down, the nodes of a block joined with the proof of the block.

Scale: the position of a leaf in its group comes from a range-partitioned sort, so that a group of
any size is spread over all tasks. Windows and joins are keyed by (group, block): no key has more
than 512 rows. Texts are read once and never shuffled, digests and ids only. Rounds grow with the
logarithm of the largest group; the driver sees one number, the size of that group.

Nulls and edges: a null field is written as `-`, an empty one as `0:`; a null group is a group of its
own and the first one, a null id is the smallest; rows that repeat an id are leaves of their own,
ordered by their digests, and equal rows get equal leaves; a group of one row is its own subroot, a
table of one group has that subroot as its root; long texts are hashed whole; other columns are
ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.llm import common
from cohortlens.operators.ranking import rank_by_range

#: Nodes that become one of the next level.
FAN = 8
#: Levels that one window covers; a block of it has FAN ** TIER nodes at most.
TIER = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of strings written one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: for each field its length in bytes, a colon and its value, or `-`."""
    told = []
    for field in fields:
        value = field.cast("string")
        length = F.octet_length(value).cast("string")
        told.append(F.coalesce(F.concat(length, F.lit(":"), value), F.lit("-")))
    return digest(*told)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["left"], h, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """Nodes with `steps`, what stands left and right of them and of their ancestors inside their
    block, and `top`, on the first row of a block the digest of the block.

    Rows of all levels are the rows of the nodes: an ancestor's digest stands in the row of its
    first node, so that its siblings are 8, 64, ... rows away.
    """
    order = Window.partitionBy("grp", "block").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    none, pos = F.lit(""), F.col("pos")
    rows = nodes.withColumn("block", F.floor(pos / FAN**TIER)).withColumn("h0", F.col("h"))
    steps = []
    for level in range(TIER):
        apart, h = FAN**level, f"h{level}"
        place, count = F.floor(pos / apart), F.ceil(F.col("n") / apart)
        slot = place % FAN
        length = F.least(F.lit(FAN), count - (place - slot))
        left = [F.when(slot >= k, F.lag(h, k * apart).over(order)).otherwise(none) for k in range(FAN - 1, 0, -1)]
        right = [F.when(slot + k < length, F.lead(h, k * apart).over(order)).otherwise(none) for k in range(1, FAN)]
        first, further = pos % apart == 0, count > 1
        step = {"l": F.when(first, F.concat(*left)), "r": F.when(first, F.concat(*right))}
        rows = rows.withColumns({f"{side}{level}": x for side, x in step.items()})
        parent = F.when(further, digest(F.col(h), F.col(f"r{level}"))).otherwise(F.col(h))
        rows = rows.withColumn(f"h{level + 1}", F.when(pos % (apart * FAN) == 0, parent))
        # The last one told, for every row that of its own ancestor.
        mine = [F.last(f"{side}{level}", ignorenulls=True).over(so_far).alias(name) for side, name in (("l", "left"), ("r", "right"))]
        steps.append((further, mine))
    for level, (further, mine) in enumerate(steps):
        rows = rows.withColumn(f"step{level}", F.when(further, F.array(F.struct(*mine))).otherwise(F.array().cast(PATH)))
    told = F.concat(*[F.col(f"step{level}") for level in range(TIER)])
    return rows.select(*nodes.columns, "block", told.alias("steps"), F.col(f"h{TIER}").alias("top"))


def _tiers(leaves: DataFrame) -> list[DataFrame]:
    """Every TIER-th level of the trees, the leaves (grp, pos, n, h) first and the tops last; n is
    the level's size in its group."""
    tiers = [leaves]
    widest = leaves.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        nodes = _in_blocks(tiers[-1].select("grp", "pos", "n", "h")).where(F.col("pos") % FAN**TIER == 0)
        count = F.ceil(F.col("n") / FAN**TIER)
        tiers.append(common.checkpointed(nodes.select("grp", F.col("block").alias("pos"), count.alias("n"), F.col("top").alias("h"))))
        widest = -(-widest // FAN**TIER)
    return tiers


def _descend(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with `path` and the other columns of `tops`, one row (grp, path, ...) a tree."""
    told = [c for c in tops.columns if c not in ("grp", "path")]
    last = tiers[-1]
    below = last.join(tops, "grp").select(*last.columns, "path", *told)
    for tier in reversed(tiers[:-1]):
        above = below.select("grp", F.col("pos").alias("block"), "path", *told)
        path = F.concat("steps", "path").alias("path")
        below = _in_blocks(tier).join(above, ["grp", "block"]).select(*tier.columns, path, *told)
    return below


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `pos`, their place in their group, and `n`, its size."""
    columns = [c for c in rows.columns if c != "tie"]
    return rank_by_range(rows, ["grp"], [F.col(c) for c in order]).select(
        *columns, (F.col("rn") - 1).alias("pos"), F.col("total_count").alias("n")
    )


def manifest(rows: DataFrame, id_col: str = "id", group_col: str = "grp", leaf_col: str = "leaf") -> DataFrame:
    """Rows with position, n_leaves, subroot, root and path, the proof from the leaf to the root.

    `leaf_col` holds the leaves' digests. Columns of `rows` stay, with their names; they should be
    narrow, as rows are sorted by group and id.
    """
    kept = {f"c{i}": c for i, c in enumerate(rows.columns)}
    # One key of a sort in which null groups come first and groups stand in the order of their bytes.
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    named = rows.select(
        *[F.col(c).alias(k) for k, c in kept.items()], group.alias("grp"), F.col(id_col).alias("id"), F.col(leaf_col).alias("h")
    ).withColumn("tie", F.monotonically_increasing_id())
    leaves = _tiers(common.checkpointed(_placed(common.checkpointed(named), ["id", "h", "tie"])))
    tops = leaves[-1].select(F.lit("").alias("grp"), F.col("grp").alias("member"), "h")
    upper = _tiers(common.checkpointed(_placed(common.checkpointed(tops), ["member"])))
    root = upper[-1].select("grp", F.col("h").alias("root"), F.array().cast(PATH).alias("path"))
    subroots = _descend(upper, root).select(F.col("member").alias("grp"), F.col("h").alias("subroot"), "root", "path")
    return _descend(leaves, subroots).select(
        *[F.col(k).alias(c) for k, c in kept.items()], F.col("pos").alias("position"), F.col("n").alias("n_leaves"), "subroot", "root", "path"
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its leaf, its group's and the table's root, the digest of its proof, and whether
    the proof still holds after texts were lower-cased where 3 divides the checksum of the id."""
    docs = common.read(spark, sf_dir, "documents").select(*FIELDS)
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    lowered = leaf_digest([F.col(c) for c in FIELDS[:-1]] + [common.fold_ascii(F.col("text"))])
    touched = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(touched, lowered).alias("other"))
    told = manifest(rows, "doc_id", "lang")
    return told.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("other", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, lang, source, n_chars, text,
         CASE WHEN list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(
             list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))) IS NULL THEN NULL
         ELSE xor(4294967295::BIGINT, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(
             list_concat([xor(crc, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 3 = 0 END AS touched
  FROM documents
), written AS (
  SELECT doc_id, lang, touched,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS start,
         coalesce(strlen(text) || ':' || text, '-') AS body,
         coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM docs
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256(start || body) AS leaf,
         CASE WHEN touched THEN sha256(start || low) ELSE sha256(start || body) END AS shown,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256(start || body)) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM written
), node AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT g, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM node
  WHERE n > 1 GROUP BY g, lvl, n, pos // 8
), tops AS (
  SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
), upper_node AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_node
  WHERE n > 1 GROUP BY lvl, n, pos // 8
), every AS (
  SELECT g, lvl, pos, n, h FROM node UNION ALL SELECT 'upper', lvl, pos, n, h FROM upper_node
), beside AS (
  SELECT g, lvl, pos,
         coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY g, lvl, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM every WHERE n > 1
), walk AS (
  SELECT g AS tree, row_number() OVER () AS id, doc_id, g, leaf, 0 AS lvl, pos, n, shown AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT CASE WHEN w.n > 1 THEN w.tree ELSE 'upper' END, w.id, w.doc_id, w.g, w.leaf,
         CASE WHEN w.n > 1 THEN w.lvl + 1 ELSE 0 END,
         CASE WHEN w.n > 1 THEN w.pos // 8 ELSE t.pos END,
         CASE WHEN w.n > 1 THEN (w.n + 7) // 8 ELSE t.n END,
         CASE WHEN w.n > 1 THEN sha256(b.l || w.h || b.r) ELSE w.h END,
         CASE WHEN w.n > 1 THEN w.proof || b.l || b.r ELSE w.proof END
  FROM walk w JOIN tops t ON t.g = w.g
  LEFT JOIN beside b ON b.g = w.tree AND b.lvl = w.lvl AND b.pos = w.pos
  WHERE w.n > 1 OR w.tree <> 'upper'
)
SELECT w.doc_id, w.leaf, t.subroot, u.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = u.h AS verified
FROM walk w JOIN tops t ON t.g = w.g JOIN upper_node u ON u.n = 1
WHERE w.tree = 'upper' AND w.n = 1
"""
