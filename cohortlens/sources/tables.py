"""Warehouse tables and exports."""

from __future__ import annotations

import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import schemas


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Parallel read of an external warehouse table, split on a numeric column."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper,
        numPartitions=partitions, properties=properties or {},
    )


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A table that was not built yet reads as no rows."""
    if spark.catalog.tableExists(name):
        return spark.read.table(name)
    return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame, name: str, schema: T.StructType | None = None, properties: dict[str, str] | None = None
) -> None:
    """Full refresh without a moment in which the table is missing.

    Rows are written once, to a new version; then the name, a view, is pointed at it. ``df``
    may read the table being replaced. The previous version is kept for running readers. A plain
    table of that name becomes a version itself; only for that one rename is the name free.
    ``properties`` are told with the name (``properties_of``) and change with the rows.
    """
    rows = schemas.conform(df, schema) if schema is not None else df
    version = _new_version(name)
    rows.write.mode("errorifexists").saveAsTable(version)
    _point(df.sparkSession, name, f"SELECT * FROM {version}", properties)
    _drop_old_versions(df.sparkSession, name)


def write_split(outcomes: DataFrame, name: str, schema: T.StructType) -> None:
    """Full refresh of a table and of its quarantine, in one pass over the rows.

    ``outcomes`` has the columns of ``schema``, ``record`` and ``reason``. One version, split by
    reason, holds them all: the view ``name`` shows the kept rows, ``<name>_rejects`` the others
    with their text and reason. Readers of either read their folders only.
    """
    spark = outcomes.sparkSession
    rows = schemas.conform(outcomes, T.StructType([*schema, *schemas.OUTCOME]))
    version = _new_version(name)
    rows.write.mode("errorifexists").partitionBy("reason").saveAsTable(version)
    columns = ", ".join(f"`{c}`" for c in schema.names)
    _point(spark, f"{name}_rejects", f"SELECT {columns}, record, reason FROM {version} WHERE reason <> 'kept'")
    _point(spark, name, f"SELECT {columns} FROM {version} WHERE reason = 'kept'")
    _drop_old_versions(spark, name)


def reason_counts(spark: SparkSession, name: str) -> DataFrame:
    """reason and rows of a table written by ``write_split``; reads the files' footers only."""
    counts = [spark.read.table(f"{name}_rejects").groupBy("reason"), spark.read.table(name).groupBy(F.lit("kept").alias("reason"))]
    rejected, kept = (c.agg(F.count("*").alias("rows")) for c in counts)
    return rejected.unionByName(kept)


def _new_version(name: str) -> str:
    return f"{name}__{time.time_ns()}"


def properties_of(spark: SparkSession, name: str) -> dict[str, str]:
    """Properties of a table by name, from the catalog alone; none of a table that was not built."""
    if not spark.catalog.tableExists(name):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _point(spark: SparkSession, name: str, query: str, properties: dict[str, str] | None = None) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__{0:019d}")
    told = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} {f'TBLPROPERTIES ({told})' if told else ''} AS {query}")


def _drop_old_versions(spark: SparkSession, name: str) -> None:
    listed = [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()]
    own = re.compile(re.escape(name.rpartition(".")[2].lower()) + r"__\d{19}")
    for old in sorted(t for t in listed if own.fullmatch(t))[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")


def create_or_replace_table(df: DataFrame, name: str) -> None:
    """Create from a query, replacing an older definition and its schema.

    The query may read the table that it replaces: the old rows stay until the new ones are
    written.
    """
    write_table(df, name)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Bucketed fact table: later joins and groupings on the key need no exchange."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def export_datasets(datasets: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One CSV folder per dataset, written in parallel parts; returns name to path."""
    paths = {}
    for name, df in datasets.items():
        paths[name] = os.path.join(folder, name)
        df.write.mode("overwrite").csv(paths[name], header=True)
    return paths
