"""What a streaming query still holds, read from its checkpoint while it runs or after it ended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.functions import ratio


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per state store of a query: operatorId, operatorName, stateStoreName,
    numPartitions, minBatchId, maxBatchId."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select("operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


def held_windows(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None
) -> DataFrame:
    """The windows that a stream of ``vwap`` still holds, as metrics of what came so far.

    They are those the watermark has not passed: append mode has not given them yet, and trades
    for them still count. ``batch_id`` reads the state as it was after an earlier refresh, as far
    as the checkpoint keeps it. The store is read in as many tasks as it has partitions; nothing is
    written or moved on.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint)
    # Sums of decimals are kept with a flag each, sums of doubles alone; the names repeat.
    sums = [at for at, field in enumerate(held.schema["value"].dataType) if field.name == "sum"]
    if len(sums) != 2:
        raise ValueError("this operator's state is not that of vwap")
    names = [f"part{at}" for at in range(len(held.schema["value"].dataType))]
    renamed = ", ".join(
        f"{name}: {field.dataType.simpleString()}" for name, field in zip(names, held.schema["value"].dataType)
    )
    values = held.select("key", F.col("value").cast(f"struct<{renamed}>").alias("value"))
    notional, volume = (F.col(f"value.{names[at]}").cast("double") for at in sums)
    return values.select(
        F.col("key.window.end").alias("window_end"),
        F.col("key.symbol").alias("symbol"),
        ratio(notional, volume).alias("vwap"),
        volume.alias("total_volume"),
    )
