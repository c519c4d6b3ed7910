"""What several operators of this subpackage share."""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator
from sys import getsizeof
from typing import Any

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.landing import landed
from lakeops.paths import delete
from lakeops.session import scratch_path

ID, TEXT = "doc_id", "text"
#: Bytes that the word cache of a worker takes, and of a dictionary entry with its share of free places.
CACHE, _ENTRY = 160 << 20, 110


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null counts as empty), so other columns can have any name."""
    return docs.select(F.col(ID).cast("long").alias(ID), F.coalesce(F.col(TEXT), F.lit("")).alias(TEXT))


_LEFT: list[tuple[Any, Any]] = []


def _remove_left() -> None:
    for file_system, path in _LEFT:
        try:
            file_system.delete(path, True)
        except (Py4JError, OSError):  # the JVM has gone first
            return


def temporary_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the driver's process ends: for tables that a lazy result still reads."""
    path = scratch_path(spark, label)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not _LEFT:
        atexit.register(_remove_left)
    _LEFT.append((where.getFileSystem(spark._jsc.hadoopConfiguration()), where))
    return path


def temporary_table(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to a temporary path."""
    path = temporary_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Landings:
    """Tables written once to the shared folder, and their removal once nothing reads them any more."""

    def __init__(self, label: str):
        self.label, self.paths, self.spark = label, [], None

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.spark = df.sparkSession
        rows, path = landed(df, f"{self.label}-{name}")
        self.paths.append(path)
        return rows

    def drop_all(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths = []


class WordCache(dict):
    """Remembers a function of a word for the words seen lately.

    Two generations of at most half of ``limit`` bytes each bound the memory; a word that was thrown out is computed
    again, so the limit changes the speed and never a result. Words longer than ``longest`` are not kept.
    """

    def __init__(self, compute: Callable[[Any], Any], limit: int = CACHE, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest, self.old, self.held = compute, limit // 2, longest, {}, 0

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.compute(word)
            if len(word) > self.longest:
                return value
        return self.add(word, value)

    def add(self, word, value):
        if self.held >= self.half:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += getsizeof(word) + getsizeof(value) + _ENTRY
        self[word] = value
        return value


def per_worker(make: Callable[[], Any], key: str, kept: dict[str, Any] = {}) -> Any:  # noqa: B006
    """One object per Python worker, made at its first use and reused by later tasks until another key is asked for.

    Workers outlive the operators; only the last one's models and caches stay in memory.
    """
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def batches(frames: Iterator, rows: int) -> Iterator:
    """The same rows in frames of at most ``rows`` rows."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]
