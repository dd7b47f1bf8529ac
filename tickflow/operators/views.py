"""Views over accumulated results. Batch, or inside ``foreachBatch``, unless stated.

Picking a row per key uses ``max_by`` per column: on fixed-width columns that is a hash
aggregation with a map-side combine, where a struct or ``row_number`` would sort and send
every row of a key to one task. All columns of one aggregation come from the same row, as
they share one ordering.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions import alert_key, alert_line
from tickflow.operators.parse import drop_missing_window

_KEY = list(schemas.RESULT_KEY)


def _pick(rows: DataFrame, keys: Sequence[str], order: str, function) -> DataFrame:
    others = [name for name in rows.columns if name not in (*keys, order)]
    edge = F.min if function is F.min_by else F.max
    picked = rows.groupBy(*keys).agg(
        edge(order).alias(order), *(function(name, order).alias(name) for name in others)
    )
    return picked.select(*rows.columns)


def append_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches, matched by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def keep_last(rows: DataFrame, arrival: str, keys: Sequence[str] = _KEY) -> DataFrame:
    """The row that arrived last per key; NULL keys equal each other.

    ``arrival`` must be set, and distinct among the rows of one key.
    """
    return _pick(rows, list(keys), arrival, F.max_by)


def upsert(rows: DataFrame, arrival: str) -> DataFrame:
    """``keep_last`` where ``window_end`` counts as the raw text of the message.

    Takes decoded rows whose numbers are coerced and whose window end is not: one window
    end written in two ways makes two rows, which ``keep_last`` on timestamps would merge.
    """
    if dict(rows.dtypes)["window_end"] != "string":
        raise ValueError("upsert works on the raw text of window_end; see keep_last")
    return keep_last(rows, arrival)


def latest_rows(metrics: DataFrame) -> DataFrame:
    """The newest metric per symbol as it is, NULLs included, by symbol."""
    known = drop_missing_window(metrics).filter(F.col("symbol").isNotNull())
    newest = _pick(known.select(*schemas.METRIC_COLUMNS), ["symbol"], "window_end", F.max_by)
    return newest.select("symbol", "vwap", "total_volume", "window_end").orderBy("symbol")


def latest_values(metrics: DataFrame) -> DataFrame:
    """Per symbol the newest value of each column that is not NULL, by symbol.

    A value without a window end counts as the oldest.
    """
    age = F.coalesce(F.unix_micros("window_end"), F.lit(-(2**63)))

    def newest(name: str):
        present = F.when(F.col(name).isNotNull(), age)
        return F.max_by(name, present).alias(name)

    known = metrics.filter(F.col("symbol").isNotNull())
    return (
        known.groupBy("symbol")
        .agg(newest("vwap"), newest("total_volume"), F.max("window_end").alias("window_end"))
        .orderBy("symbol")
    )


def record_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("records"))


def series(metrics: DataFrame) -> DataFrame:
    """Metrics from oldest to newest window."""
    return metrics.orderBy(F.asc_nulls_last("window_end"), F.asc_nulls_last("symbol"))


def metric_listing(metrics: DataFrame) -> DataFrame:
    """Metrics from newest to oldest window."""
    return metrics.orderBy(F.desc_nulls_last("window_end"), F.asc_nulls_last("symbol"))


def known_symbols(metrics: DataFrame) -> list[str]:
    """The symbols in sorted order; more than ``spark.sql.pivotMaxValues`` is an error.

    This runs ``metrics`` once, so store or cache them first unless they are cheap.
    """
    bound = int(metrics.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    named = metrics.select("symbol").filter(F.col("symbol").isNotNull()).distinct()
    symbols = [row.symbol for row in named.limit(bound + 1).collect()]
    if len(symbols) > bound:
        raise ValueError(f"more than {bound} symbols do not fit a wide table")
    return sorted(symbols)


def wide_series(
    metrics: DataFrame,
    value: str,
    symbols: Sequence[str] | None = None,
    strict: bool = True,
    delay: str | None = None,
) -> DataFrame:
    """One row per window end and one column per symbol, missing cells NULL.

    Rows of other symbols than the listed ones, NULL among them, are left out before anything
    else, and so are window ends that only they have; without a list every symbol is in. Two
    metrics for one cell are an error; ``strict=False`` takes the larger. On streams this
    needs explicit ``symbols`` and aggregates each column by a condition. With a ``delay`` a
    stream in append mode gives each window end once, when no metric of it can come any more,
    and then forgets it; without one it needs complete mode, which keeps every row.
    """
    names = known_symbols(metrics) if symbols is None else list(symbols)
    listed = drop_missing_window(metrics).filter(F.col("symbol").isin(names))
    if metrics.isStreaming:
        if delay is not None:
            listed = listed.withWatermark("window_end", delay)
        cells = []
        for name in names:
            here = F.col("symbol") == name
            cell = F.max(F.when(here, F.col(value)))
            cells.append((_only(cell, F.count_if(here), value) if strict else cell).alias(name))
        return listed.groupBy("window_end").agg(*cells)
    cell = F.max(value)
    if strict:
        cell = _only(cell, F.count(F.lit(1)), value)
    single = listed.groupBy("window_end", "symbol").agg(cell.alias(value))
    return single.groupBy("window_end").pivot("symbol", names).agg(F.first(value))


def _only(cell: Column, rows: Column, value: str) -> Column:
    twice = F.raise_error(F.lit(f"several {value} values for one window and symbol"))
    return F.when(rows > 1, twice).otherwise(cell)


def recent_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts with a window end, newest first."""
    return (
        drop_missing_window(alerts)
        .select("window_end", "symbol", "percent_change", "first_price", "last_price")
        .orderBy(F.desc("window_end"), F.asc_nulls_last("symbol"))
    )


def alert_listing(alerts: DataFrame) -> DataFrame:
    """All alerts, newest first, those without a window end last."""
    columns = ["symbol", "percent_change", "first_price", "last_price", "window_end"]
    return alerts.select(*columns).orderBy(
        F.desc_nulls_last("window_end"), F.asc_nulls_last("symbol")
    )


def with_alert_key(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert_key", alert_key(F.col("symbol"), F.col("window_end")))


def new_alerts(alerts: DataFrame, seen: DataFrame) -> DataFrame:
    """Alerts whose (symbol, window_end) is not among the ``seen`` ones.

    No broadcast hint: the seen set grows with time, so the join strategy is left to the
    sizes that adaptive execution measures.
    """
    known = seen.select(*(F.col(name).alias(f"seen_{name}") for name in _KEY))
    same = [F.col(name).eqNullSafe(F.col(f"seen_{name}")) for name in _KEY]
    return alerts.join(known, reduce(lambda a, b: a & b, same), "left_anti")


def remember(seen: DataFrame, alerts: DataFrame) -> DataFrame:
    """The seen set after showing ``alerts``.

    Write it to a table or ``checkpoint`` it between refreshes, or its plan grows with each.
    """
    return seen.select(*_KEY).union(alerts.select(*_KEY)).distinct()


def first_shown(alerts: DataFrame, refresh: str) -> DataFrame:
    """Each alert once, in the earliest refresh that delivered it."""
    return _pick(alerts, _KEY, refresh, F.min_by)


def new_alert_counts(alerts: DataFrame, refresh: str) -> DataFrame:
    """How many alerts each refresh showed for the first time, zeros included."""
    shown = first_shown(alerts.select(*_KEY, refresh), refresh)
    marks = alerts.select(refresh, F.lit(0).alias("new"))
    marks = marks.union(shown.select(refresh, F.lit(1).alias("new")))
    return marks.groupBy(refresh).agg(F.sum("new").alias("new_alerts"))


def alert_lines(alerts: DataFrame) -> DataFrame:
    """Alerts as one line of text each, next to their identity."""
    columns = ("symbol", "percent_change", "first_price", "last_price", "window_end")
    return alerts.select(
        "window_end", "symbol", alert_line(*(F.col(name) for name in columns)).alias("line")
    )


def is_empty(rows: DataFrame) -> bool:
    """Whether a view has nothing to show; reads at most one row."""
    return rows.isEmpty()
