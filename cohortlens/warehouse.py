"""The four warehouse tables as one input."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators import ranking
from cohortlens.sources import tables

PAIR = ["student_id", "course_id"]
#: Table of the pairs too large for one task, kept beside the facts by their writer.
HEAVY_PAIRS = "fact_heavy_pairs"


@dataclass(frozen=True)
class Warehouse:
    """Dimension ids must be unique; the cleaners guarantee it for all three dimensions."""

    facts: DataFrame
    students: DataFrame
    courses: DataFrame
    assignments: DataFrame
    heavy_rows: int = ranking.HEAVY_ROWS
    #: Whether ``listed`` holds the heavy pairs already (None: there are none), as their writer
    #: found them. A list that is out of date costs balance, never a result.
    is_listed: bool = False
    listed: DataFrame | None = None

    @cached_property
    def heavy_pairs(self) -> DataFrame | None:
        """(student, course) pairs too large for one task; counted once per warehouse, unless the
        writer of the facts has listed them."""
        if self.is_listed:
            return self.listed
        return ranking.heavy_groups(self.facts, PAIR, self.heavy_rows)


def publish_heavy_pairs(spark: SparkSession, heavy_rows: int = ranking.HEAVY_ROWS) -> None:
    """List the heavy pairs of the published facts, so that reports need no count of their own."""
    facts = spark.read.table("fact_submissions")
    heavy = ranking.heavy_groups(facts, PAIR, heavy_rows)
    listed = facts.select(*PAIR).limit(0) if heavy is None else heavy
    rows = 0 if heavy is None else heavy.count()
    tables.write_table(listed, HEAVY_PAIRS, properties={"rows": str(rows)})


def from_tables(spark: SparkSession) -> Warehouse:
    """The published tables; runs no job."""
    told = tables.properties_of(spark, HEAVY_PAIRS).get("rows")
    listed = None
    if told is not None and int(told):
        listed = spark.read.table(HEAVY_PAIRS)
        if int(told) <= ranking.BROADCAST_GROUPS:
            listed = F.broadcast(listed)
    return Warehouse(
        spark.read.table("fact_submissions"),
        spark.read.table("dim_students"),
        spark.read.table("dim_courses"),
        spark.read.table("dim_assignments"),
        is_listed=told is not None,
        listed=listed,
    )
