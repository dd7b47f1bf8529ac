"""Which folders of a growing table count, so that readers list those and no others."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LAYOUT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("weight", T.LongType()),
    ]
)
_VERSION = "version"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
"""How Spark's writer names the folder of rows without a day."""


class Entry(NamedTuple):
    """Something that counts: a folder, a file, or one that is to be removed."""

    kind: str
    day: str | None
    item: str
    weight: int = 1


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark._jsc.hadoopConfiguration()), located


def exists(spark: SparkSession, path: str) -> bool:
    files, located = _located(spark, path)
    return files.exists(located)


def remove(spark: SparkSession, path: str) -> None:
    files, located = _located(spark, path)
    files.delete(located, True)


def read_folders(spark: SparkSession, folders: Iterable[str], layout: T.StructType) -> DataFrame:
    """The rows of some folders or files; of none, no rows."""
    listed = list(folders)
    if not listed:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(*listed)


def load(spark: SparkSession, path: str, before: int | None = None) -> tuple[int, list[Entry]]:
    """(version, entries) of the newest manifest, or the newest before a version; -1 without one."""
    newest: tuple[int, list[Entry]] = -1, []
    for slot in (0, 1):
        if exists(spark, f"{path}/slot={slot}"):
            rows = spark.read.schema(_LAYOUT).parquet(f"{path}/slot={slot}").collect()
            version = rows[0]["version"] if rows else -1
            if newest[0] < version and (before is None or version < before):
                newest = version, [Entry(*row[1:]) for row in rows if row["kind"] != _VERSION]
    return newest


def save(spark: SparkSession, path: str, version: int, entries: Iterable[Entry]) -> None:
    """Write a manifest in the place of the one two versions ago.

    The one before stays whole until the next is written, so a writer that is lost in between
    leaves a table that can be read, and runs the same version again.
    """
    rows = [(version, _VERSION, None, "", 0), *((version, *entry) for entry in entries)]
    table = spark.createDataFrame(rows, _LAYOUT).coalesce(1)
    table.write.mode("overwrite").parquet(f"{path}/slot={version % 2}")


def day_name(day) -> str:
    return NO_DAY if day is None else str(day)


def day_folder(column: str = "day"):
    """A date column as its folder is named."""
    return F.coalesce(F.col(column).cast("string"), F.lit(NO_DAY))
