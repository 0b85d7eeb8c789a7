"""Partial results of a stream in a folder, and the manifest that tells which of them count.

Each micro-batch adds one part, a folder of mergeable figures. A numbered manifest lists the live
parts and the last batch they hold; a new one appears by a rename, so a reader sees the old answer or
the new one and nothing between. Once FAN_IN parts of a level have gathered, they are merged into one
part of the next level, so the live parts, and with them the files, grow with the logarithm of the
number of batches. Parts that only older manifests list are removed after KEEP further manifests;
a reader that takes longer has to begin again. A folder has one writer, its stream.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from cohortlens.session import remove_path

FAN_IN = 8
KEEP = 12
ATTEMPTS = 5


@dataclass(frozen=True)
class Manifest:
    """Version, last batch, and the live parts as (level, folder name)."""

    version: int = 0
    batch: int = -1
    parts: tuple[tuple[int, str], ...] = ()


class _Folder:
    """The manifests and parts below a path, in whatever store it lies."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._jvm = spark._jvm
        self._fs = self._place("manifest").getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, *names))

    def _names(self, folder: str) -> list[str]:
        place = self._place(folder)
        if not self._fs.exists(place):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(place)]

    def versions(self) -> list[int]:
        found = [n.removesuffix(".json") for n in self._names("manifest")]
        return sorted(int(n) for n in found if n.isdigit())

    def read(self, version: int) -> Manifest:
        stream = self._fs.open(self._place("manifest", f"{version}.json"))
        try:
            told = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(version, told["batch"], tuple((level, name) for level, name in told["parts"]))

    def current(self) -> Manifest:
        for attempt in range(ATTEMPTS):
            versions = self.versions()
            if not versions:
                return Manifest()
            try:
                return self.read(versions[-1])
            except Py4JJavaError:  # removed since it was listed
                if attempt == ATTEMPTS - 1:
                    raise
        return Manifest()

    def publish(self, manifest: Manifest) -> None:
        place = self._place("manifest", f"{manifest.version}.json")
        if self._fs.exists(place):
            raise RuntimeError(f"{self.path} has another writer: version {manifest.version} exists")
        told = json.dumps({"batch": manifest.batch, "parts": manifest.parts})
        draft = self._place("manifest", f".{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(told.encode()))
        out.close()
        if not self._fs.rename(draft, place):
            raise RuntimeError(f"could not publish {place.toString()}")

    def part(self, name: str) -> str:
        return os.path.join(self.path, "data", name)

    def sweep(self) -> None:
        """Remove what no kept manifest lists."""
        versions = self.versions()
        kept = {name for v in versions[-KEEP:] for _, name in self.read(v).parts}
        for name in self._names("data"):
            if name not in kept:
                remove_path(self.spark, self.part(name))
        for version in versions[:-KEEP]:
            remove_path(self.spark, os.path.join(self.path, "manifest", f"{version}.json"))


def _read(folder: _Folder, names: list[str], schema: str) -> DataFrame:
    if not names:
        return folder.spark.createDataFrame([], schema)
    return folder.spark.read.schema(schema).parquet(*[folder.part(n) for n in names])


def snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The live parts as they are now; later batches do not change what this frame reads."""
    folder = _Folder(spark, path)
    return _read(folder, [name for _, name in folder.current().parts], schema)


def append(
    spark: SparkSession, path: str, batch: int, figures: DataFrame, schema: str,
    merge: Callable[[DataFrame], DataFrame], fan_in: int = FAN_IN,
) -> None:
    """Add the figures of a batch, and merge the parts of every level that is full.

    A batch that the manifest already holds is left out, so replaying it changes nothing; what a
    failed attempt wrote is in no manifest, and is removed by a later sweep.
    """
    folder = _Folder(spark, path)
    now = folder.current()
    if batch <= now.batch:
        return

    def add(rows: DataFrame, level: int, replaced: list[str]) -> Manifest:
        name = f"level{level}-batch{batch}-{uuid.uuid4().hex}"
        rows.write.parquet(folder.part(name))
        left = tuple(p for p in now.parts if p[1] not in replaced)
        then = Manifest(now.version + 1, batch, (*left, (level, name)))
        folder.publish(then)
        return then

    now = add(figures, 0, [])
    level = 0
    while len(full := [name for of, name in now.parts if of == level]) >= fan_in:
        now = add(merge(_read(folder, full, schema)), level + 1, full)
        level += 1
    folder.sweep()
