"""Result topics as typed streams for whatever displays them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickflow import schemas
from tickflow.operators import views
from tickflow.operators.parse import coerce, decode_payload
from tickflow.streaming import manifest
from tickflow.streaming.manifest import Entry
from tickflow.streaming.seen import SeenStore
from tickflow.streaming.sinks import start_batches, start_files

_DAY = "day"


def result_stream(messages: DataFrame, result: T.StructType) -> DataFrame:
    """Messages of a result topic as typed rows, for batch and stream alike.

    ``result`` is ``schemas.METRIC`` or ``schemas.ALERT``. The key stays, and the offset as
    arrival order for ``views.keep_last``.
    """
    rows = decode_payload(messages, result.fieldNames(), carry=["offset"])
    return coerce(
        rows,
        times=[f.name for f in result if isinstance(f.dataType, T.TimestampType)],
        numbers=[f.name for f in result if isinstance(f.dataType, T.DoubleType)],
    )


def start_new_alerts(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = schemas.REFRESH_INTERVAL,
    drain: bool = False,
) -> StreamingQuery:
    """Write each alert of a stream the first time it is delivered, however late.

    What was shown is the output itself: a refresh is compared with what earlier ones wrote
    for the days of its own alerts, so nothing is held in state and nothing forgotten. Per
    refresh the folder also gets its number of records and of new alerts. A refresh that is
    run again replaces what it wrote. ``read_shown`` and ``read_counts`` read the two; see
    ``SeenStore`` for how folders stay few.
    """
    columns = [c for c in alerts.columns if c != _DAY]
    layout = T.StructType([alerts.schema[name] for name in columns])
    store = SeenStore(alerts.sparkSession, path, layout)

    def show(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store.show(batch.select(*columns), batch_id)
        finally:
            batch.unpersist()

    return start_batches(alerts, show, checkpoint, every=every, drain=drain)


def read_shown(spark: SparkSession, path: str, result: T.StructType = schemas.ALERT) -> DataFrame:
    """The alerts that ``start_new_alerts`` wrote, with the refresh that showed them first."""
    return SeenStore(spark, path, result).shown()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per refresh of ``start_new_alerts``: batch_id, records, new_alerts."""
    return SeenStore(spark, path, schemas.ALERT).counts()


def start_log(
    results: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = schemas.REFRESH_INTERVAL,
    drain: bool = False,
    retention: str | None = None,
) -> StreamingQuery:
    """Keep the rows of a ``result_stream`` in files by day of the window end.

    The log takes the place of state that a display would hold in memory: it outlives the
    display, and each refresh only appends. Repeated deliveries stay in it and are left out
    when it is read. Every refresh leaves files of its own: ``compact_log`` gathers days
    elsewhere, and files older than ``retention`` ("7d") then leave the log.
    """
    dated = results.drop("key").withColumn(_DAY, F.to_date("window_end"))
    extra = {} if retention is None else {"retention": retention}
    return start_files(dated, path, checkpoint, every, drain, partition_by=[_DAY], extra=extra)


def _layout(result: T.StructType) -> T.StructType:
    return T.StructType([*result.fields, T.StructField("offset", T.LongType())])


def _log_files(spark: SparkSession, path: str, result: T.StructType) -> dict[str, str | None]:
    """Every file of a log by its name, with the day it is of."""
    files = spark.read.schema(T.StructType([*_layout(result).fields, T.StructField(_DAY, T.DateType())])).parquet(path).inputFiles()
    days = {name: name.rsplit("/", 2)[1].removeprefix(f"{_DAY}=") for name in files}
    return {name: None if day == manifest.NO_DAY else day for name, day in days.items()}


def _in_days(day: str | None, first: date | None, until: date | None) -> bool:
    """Whether a day is in a range; none is where there is no range."""
    if day is None:
        return first is None and until is None
    return (first is None or day >= str(first)) and (until is None or day < str(until))


def _archived(archive: str) -> str:
    return f"{archive.rstrip('/')}-manifest"


def compact_log(
    spark: SparkSession, path: str, archive: str, result: T.StructType, first: date, until: date
) -> None:
    """Gather the days from ``first`` on and before ``until`` of a log in an archive, once per
    symbol and window end, in few files.

    A manifest beside the archive says which of its folders count and which files of the log are
    in them. Running it again takes in what the log got since, and nothing that was archived is
    lost when files leave the log. Days without new files are left alone.
    """
    layout = _layout(result)
    version, entries = manifest.load(spark, _archived(archive))
    files = _log_files(spark, path, result)
    known = {e.item for e in entries if e.kind == "file"}
    fresh = {name: day for name, day in files.items() if name not in known and day is not None and _in_days(day, first, until)}
    if not fresh:
        return
    days = set(fresh.values())
    earlier = [e for e in entries if e.kind == "day" and e.day in days]
    rows = manifest.read_folders(spark, fresh, layout).unionByName(
        manifest.read_folders(spark, (f"{archive}/{e.item}" for e in earlier), layout)
    )
    version += 1
    kept = views.keep_last(rows, "offset").withColumn(_DAY, F.to_date("window_end")).withColumn("version", F.lit(version))
    kept = kept.repartition(_DAY, F.pmod(F.xxhash64("symbol"), F.lit(4)))
    writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("version", _DAY).parquet(archive)
    for entry in entries:
        if entry.kind == "gone":
            manifest.remove(spark, f"{archive}/{entry.item}")
    folders = {day: f"version={version}/{_DAY}={day}" for day in days}
    # Files that have left the log need not be remembered.
    manifest.save(spark, _archived(archive), version, [
        *(e for e in entries if e.kind == "day" and e.day not in days),
        *(e for e in entries if e.kind == "file" and e.item in files),
        *(Entry("day", day, item) for day, item in sorted(folders.items()) if manifest.exists(spark, f"{archive}/{item}")),
        *(Entry("file", day, name) for name, day in sorted(fresh.items())),
        *(Entry("gone", e.day, e.item) for e in earlier),
    ])


def read_log(
    spark: SparkSession,
    path: str,
    result: T.StructType,
    since: date | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The log with the last delivery per symbol and window end, as the views take it.

    With an ``archive``, what it holds is read from there and only the files that came since from
    the log, so no row is read twice.

    ``since`` leaves out older days before any file is opened, so a display of recent
    windows costs the same however long the log is. Rows without a window end have no day
    and are only part of the whole log.
    """
    if archive is None:
        dated = T.StructType([*_layout(result).fields, T.StructField(_DAY, T.DateType())])
        log = spark.read.schema(dated).parquet(path)
        if since is not None:
            log = log.filter(F.col(_DAY) >= F.lit(since))
        log = log.drop(_DAY)
    else:
        _, entries = manifest.load(spark, _archived(archive))
        known = {e.item for e in entries if e.kind == "file"}
        chosen = [name for name, day in _log_files(spark, path, result).items() if name not in known and _in_days(day, since, None)]
        chosen += [f"{archive}/{e.item}" for e in entries if e.kind == "day" and _in_days(e.day, since, None)]
        log = manifest.read_folders(spark, chosen, _layout(result))
    return views.keep_last(log, "offset").select(*result.fieldNames())


def display(
    metrics: DataFrame, alerts: DataFrame, seen: DataFrame, symbols: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Everything a display shows at one refresh, from two logs and the alerts shown before.

    Each view is a query of its own over its input, and without ``symbols`` the metrics are
    read twice more to find them: ``refresh`` keeps the inputs while the views are read. Symbols
    that are not listed are in no series.
    """
    new = views.new_alerts(alerts, seen)
    return {
        "latest_rows": views.latest_rows(metrics),
        "latest_values": views.latest_values(metrics),
        "vwap_series": views.wide_series(metrics, "vwap", symbols).orderBy("window_end"),
        "volume_series": views.wide_series(metrics, "total_volume", symbols).orderBy("window_end"),
        "metric_count": views.record_count(metrics),
        "recent_alerts": views.recent_alerts(alerts),
        "alert_count": views.record_count(alerts),
        "new_alert_lines": views.alert_lines(new),
        "new_alert_count": views.record_count(new),
        "seen": views.remember(seen, alerts),
    }


@contextmanager
def refresh(
    metrics: DataFrame, alerts: DataFrame, seen: DataFrame, symbols: Sequence[str] | None = None
) -> Iterator[dict[str, DataFrame]]:
    """``display`` over inputs that are read once and kept until the block ends.

    Read the views inside the block, and write ``seen`` to a table there if it is to last.
    """
    kept = [metrics.persist(), alerts.persist()]
    try:
        yield display(*kept, seen, symbols)
    finally:
        for rows in kept:
            rows.unpersist()
