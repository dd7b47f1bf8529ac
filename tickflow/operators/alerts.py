"""First and last prices per window, and alerts on their percent change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions import percent_change
from tickflow.operators.metrics import arrival_key


def first_last(
    trades: DataFrame,
    length: str = schemas.ALERT_LENGTH,
    delay: str = schemas.WATERMARK_DELAY,
    order: str = "arrival",
    arrival: str = "offset",
) -> DataFrame:
    """First and last price per symbol and tumbling window, NULL prices included.

    ``arrival`` names a number that grows with arrival: the message offset, which is a total
    order per symbol where messages are keyed by symbol. The default order is by it alone;
    ``order='event_time'`` goes by event time and lets it decide between equal times. Both
    give the same answer on every run, unlike ``first``/``last`` after a shuffle.
    """
    if trades.isStreaming:
        trades = trades.withWatermark("event_time", delay)
    key = arrival_key(order, arrival)
    grouped = trades.groupBy(F.window("event_time", length).alias("window"), "symbol")
    return grouped.agg(
        F.min_by("price", key).alias("first_price"),
        F.max_by("price", key).alias("last_price"),
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        "first_price",
        "last_price",
    )


def first_last_from_panes(panes: DataFrame, length: str) -> DataFrame:
    """``first_last`` from panes whose width divides ``length``."""
    grouped = panes.groupBy(F.window("pane_start", length).alias("window"), "symbol")
    return grouped.agg(
        F.min_by("first_price", "first_at").alias("first_price"),
        F.max_by("last_price", "last_at").alias("last_price"),
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        "first_price",
        "last_price",
    )


def alerts_over(prices: DataFrame, threshold: float = schemas.ALERT_THRESHOLD) -> DataFrame:
    """Rows of ``first_last`` whose change exceeds ``threshold`` percent either way."""
    changed = prices.withColumn(
        "percent_change", percent_change(F.col("first_price"), F.col("last_price"))
    )
    return changed.filter(F.abs("percent_change") > threshold)


def volatility(
    trades: DataFrame,
    length: str = schemas.ALERT_LENGTH,
    threshold: float = schemas.ALERT_THRESHOLD,
    delay: str = schemas.WATERMARK_DELAY,
    order: str = "arrival",
    arrival: str = "offset",
) -> DataFrame:
    """Volatility alerts: windows whose price moved by more than ``threshold`` percent."""
    return alerts_over(first_last(trades, length, delay, order, arrival), threshold)
