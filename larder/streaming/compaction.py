"""Merging the stored results of many batches while readers go on.

A *manifest* says what is live: one merged folder, and up to which batch of each stream it holds
everything. Batches beyond that are live by themselves. A new manifest is a new file, moved into
place under the next number in one step, which fails if that number is taken. A reader takes
the last manifest it finds and so sees each batch once: merged or by itself, never both.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.streaming.published import is_published

MANIFESTS, MERGED = "_manifests", "_merged"


class Folder:
    """A folder of batches: ``stream_id=.../batch_id=...``, or ``batch_id=...`` alone."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.at(self.path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        where = self.at(path)
        if not self.fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(where))

    def manifests(self) -> list[int]:
        return [int(name) for name in self.names(f"{self.path}/{MANIFESTS}") if name.isdigit()]

    def read(self, number: int) -> dict:
        stream = self.fs.open(self.at(f"{self.path}/{MANIFESTS}/{number}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def last(self) -> tuple[int, dict]:
        """The number and content of the manifest that counts."""
        numbers = self.manifests()
        return (max(numbers), self.read(max(numbers))) if numbers else (0, {"merged": None, "upto": {}, "made": 0})

    def swap(self, number: int, manifest: dict) -> None:
        """Put a manifest in place under its number; fails if another one has it."""
        draft = self.at(f"{self.path}/{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self.fs.create(draft)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(self.jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
        context.rename(draft, self.at(f"{self.path}/{MANIFESTS}/{number}"), options)

    def batches(self) -> list[tuple[str, int, str]]:
        """``(stream, batch, path)`` of every batch that is complete."""
        found = []
        for stream in ["", *[name for name in self.names(self.path) if name.startswith("stream_id=")]]:
            top = f"{self.path}/{stream}".rstrip("/")
            for name in self.names(top):
                number = re.fullmatch(r"batch_id=(\d+)", name)
                if number and is_published(self.spark, f"{top}/{name}"):
                    found.append((stream, int(number[1]), f"{top}/{name}"))
        return found

    def live(self) -> tuple[int, dict, list[tuple[str, int, str]]]:
        """The last manifest's number and content, and the batches beyond it."""
        number, manifest = self.last()
        beyond = [batch for batch in self.batches() if batch[1] > manifest["upto"].get(batch[0], -1)]
        return number, manifest, beyond

    def paths(self) -> list[str]:
        _, manifest, beyond = self.live()
        merged = [f"{self.path}/{MERGED}/{manifest['merged']}"] if manifest["merged"] else []
        return [*merged, *[path for _, _, path in beyond]]


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """All that is live under ``path``: the merged rows and those of later batches."""
    paths = Folder(spark, path).paths()
    return spark.read.parquet(*paths) if paths else spark.read.parquet(path)


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Merge what is live into one folder by ``merge`` and return how many batches that took in.

    Streams and readers go on meanwhile. ``merge`` must give the same from merged and
    further rows as from all at once, as sums do. Batches of a stream follow one another, so
    all up to the last complete one are taken in, and a batch that its stream repeats later is
    known to be. If two compactions meet, the second one fails and changes nothing. Without new batches
    nothing is done.
    """
    folder = Folder(spark, path)
    number, manifest, beyond = folder.live()
    if not beyond:
        return 0
    merged = [f"{folder.path}/{MERGED}/{manifest['merged']}"] if manifest["merged"] else []
    name = uuid.uuid4().hex
    merge(spark.read.parquet(*merged, *[batch for _, _, batch in beyond])).write.parquet(f"{folder.path}/{MERGED}/{name}")
    upto = dict(manifest["upto"])
    for stream, batch, _ in beyond:
        upto[stream] = max(batch, upto.get(stream, -1))
    folder.swap(number + 1, {"merged": name, "upto": upto, "made": time.time()})
    return len(beyond)


def tidy(spark: SparkSession, path: str, keep_seconds: float = 24 * 3600) -> int:
    """Delete what no manifest younger than ``keep_seconds`` needs; returns how many folders.

    Give the longest time that a reader may take: one that began before the last compaction still reads
    what that replaced.
    """
    folder = Folder(spark, path)
    numbers = sorted(folder.manifests())
    if not numbers:
        return 0
    manifests = {number: folder.read(number) for number in numbers}
    oldest = time.time() - keep_seconds
    # in use until the next manifest is old enough, too
    kept = [n for n, after in zip(numbers, [*numbers[1:], None]) if after is None or manifests[after]["made"] > oldest]
    needed = {manifests[n]["merged"] for n in kept}
    # a reader of the first one kept reads all batches beyond it
    upto = manifests[kept[0]]["upto"]
    if manifests[kept[0]]["made"] > oldest and kept[0] == numbers[0]:
        upto = {}  # a reader may have begun before there was any manifest
    replaced = {manifests[n]["merged"] for n in numbers} - needed
    old = [f"{folder.path}/{MERGED}/{name}" for name in sorted(replaced) if name]
    old += [where for stream, batch, where in folder.batches() if batch <= upto.get(stream, -1)]
    for where in old:
        folder.fs.delete(folder.at(where), True)
    for number in numbers:
        if number not in kept:
            folder.fs.delete(folder.at(f"{folder.path}/{MANIFESTS}/{number}"), False)
    return len(old)
