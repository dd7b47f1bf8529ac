"""Message logs kept in files, in the same row shape as the Kafka source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickflow import schemas


def messages_from_files(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files: int | None = None,
    schema=schemas.MESSAGE,
    glob: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Parquet message files, whole or as a stream.

    A stream reads at most ``max_files`` files, or files of at most ``max_bytes`` (one file
    at least), per refresh; the bytes bound a refresh however uneven files are. Nothing is skipped.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("bound a refresh by files or by bytes, not both")
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if streaming and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if streaming and max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
