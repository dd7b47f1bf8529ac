import pytest
from conftest import at, naive, rows_of
from pyspark.sql import functions as F

from tickflow.functions import alert_key, alert_line, number_text, percent_change
from tickflow.operators import views as vi
from tickflow.operators.messages import to_messages

METRIC = "window_end TIMESTAMP, symbol STRING, vwap DOUBLE, total_volume DOUBLE"
ALERT = (
    "window_start TIMESTAMP, window_end TIMESTAMP, symbol STRING, first_price DOUBLE, "
    "last_price DOUBLE, percent_change DOUBLE"
)


def when(seconds):
    return None if seconds is None else at(seconds)


def shown(seconds):
    return None if seconds is None else naive(at(seconds))


@pytest.fixture
def metrics(spark):
    def build(*rows, extra=""):
        full = [(when(end), *rest) for end, *rest in rows]
        return spark.createDataFrame(full, METRIC + extra)

    return build


@pytest.fixture
def alerts(spark):
    def build(*rows):
        full = [(None, when(end), symbol, 1.0, 2.0, change) for end, symbol, change in rows]
        return spark.createDataFrame(full, ALERT)

    return build


def test_append_batches_by_name(metrics):
    first = metrics((10, "A", 1.0, 2.0))
    second = first.select("total_volume", F.lit("B").alias("symbol"), F.lit(1).alias("added"))
    both = vi.append_batches(first, second)
    assert both.columns == ["window_end", "symbol", "vwap", "total_volume", "added"]
    assert set(rows_of(both, "symbol", "vwap", "added")) == {("A", 1.0, None), ("B", None, 1)}


def test_keep_last_takes_whole_rows(metrics):
    log = metrics(
        (10, "A", 1.0, 1.0, 5),
        (10, "A", None, 2.0, 9),
        (10, "A", 3.0, None, 7),
        (20, "A", 4.0, 4.0, 1),
        (10, None, 5.0, 5.0, 2),
        (10, None, 6.0, 6.0, 3),
        (None, "A", 7.0, 7.0, 4),
        (None, "A", 8.0, 8.0, 6),
        extra=", offset BIGINT",
    )
    kept = vi.keep_last(log, "offset")
    assert kept.columns == log.columns
    assert set(rows_of(kept)) == {
        (shown(10), "A", None, 2.0, 9),
        (shown(20), "A", 4.0, 4.0, 1),
        (shown(10), None, 6.0, 6.0, 3),
        (None, "A", 8.0, 8.0, 6),
    }


def test_upsert_distinguishes_texts_of_one_time(spark):
    texts = ["2024-01-01T00:00:10.000Z", "2024-01-01T00:00:10Z", "2024-01-01T00:00:10.000Z"]
    rows = [(t, "A", float(i), 1.0, i) for i, t in enumerate(texts)]
    ddl = "window_end STRING, symbol STRING, vwap DOUBLE, total_volume DOUBLE, offset BIGINT"
    log = spark.createDataFrame(rows, ddl)
    assert set(rows_of(vi.upsert(log, "offset"), "vwap")) == {(1.0,), (2.0,)}
    typed = log.withColumn("window_end", F.try_to_timestamp("window_end"))
    assert rows_of(vi.keep_last(typed, "offset"), "vwap") == [(2.0,)]
    with pytest.raises(ValueError):
        vi.upsert(typed, "offset")


def test_the_two_latest_views_differ(metrics):
    rows = metrics(
        (10, "B", 1.0, 1.0),
        (20, "A", 2.0, 2.0),
        (30, "A", None, 3.0),
        (None, "A", 9.0, 9.0),
        (40, None, 4.0, 4.0),
        (None, "C", 5.0, None),
    )
    assert rows_of(vi.latest_rows(rows)) == [
        ("A", None, 3.0, shown(30)),
        ("B", 1.0, 1.0, shown(10)),
    ]
    assert rows_of(vi.latest_values(rows)) == [
        ("A", 2.0, 3.0, shown(30)),
        ("B", 1.0, 1.0, shown(10)),
        ("C", 5.0, None, None),
    ]


def test_record_count_and_empty(metrics):
    rows = metrics((10, "A", 1.0, 1.0), (None, None, None, None))
    assert rows_of(vi.record_count(rows)) == [(2,)]
    assert not vi.is_empty(rows)
    assert vi.is_empty(rows.filter("symbol = 'none'"))


def test_sorting_puts_missing_windows_last(metrics, alerts):
    rows = metrics((20, "A", 1.0, 1.0), (None, "B", 1.0, 1.0), (10, "C", 1.0, 1.0))
    assert rows_of(vi.series(rows), "symbol") == [("C",), ("A",), ("B",)]
    assert rows_of(vi.metric_listing(rows), "symbol") == [("A",), ("C",), ("B",)]
    found = alerts((20, "A", 1.0), (None, "B", 1.0), (30, "C", 1.0))
    assert rows_of(vi.alert_listing(found), "symbol") == [("C",), ("A",), ("B",)]
    assert rows_of(vi.recent_alerts(found), "symbol") == [("C",), ("A",)]
    assert vi.recent_alerts(found).columns == [
        "window_end", "symbol", "percent_change", "first_price", "last_price",
    ]


def test_wide_series(metrics):
    rows = metrics(
        (10, "A", 1.0, 5.0), (10, "B", 2.0, 6.0), (20, "B", None, 7.0), (None, "A", 3.0, 3.0)
    )
    wide = vi.wide_series(rows, "vwap").orderBy("window_end")
    assert wide.columns == ["window_end", "A", "B"]
    assert rows_of(wide) == [(shown(10), 1.0, 2.0), (shown(20), None, None)]
    chosen = vi.wide_series(rows, "total_volume", ["B", "Z"]).orderBy("window_end")
    assert rows_of(chosen) == [(shown(10), 6.0, None), (shown(20), 7.0, None)]


def test_wide_series_refuses_two_values_per_cell(metrics):
    rows = metrics((10, "A", 1.0, 5.0), (10, "A", 2.0, 6.0))
    with pytest.raises(Exception, match="several vwap values"):
        vi.wide_series(rows, "vwap").collect()
    assert rows_of(vi.wide_series(rows, "vwap", strict=False), "A") == [(2.0,)]


@pytest.mark.parametrize("names", [1, 50, 51, 120])
def test_unlisted_symbols_mean_the_same_at_any_width(metrics, names):
    listed = [f"S{i}" for i in range(names)]
    rows = metrics((10, "S0", 1.0, 5.0), (10, "other", 2.0, 6.0), (10, "other", 3.0, 6.0), (10, None, 4.0, 1.0),
                   (10, None, 5.0, 1.0), (20, "other", 1.0, 1.0))
    (row,) = vi.wide_series(rows, "vwap", listed).collect()
    assert row.asDict() == {"window_end": shown(10), "S0": 1.0, **{name: None for name in listed[1:]}}


def test_wide_series_bounds_the_columns(spark, metrics):
    rows = metrics((10, "A", 1.0, 5.0), (10, "B", 2.0, 6.0), (10, "C", 2.0, 6.0))
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "2")
    try:
        with pytest.raises(ValueError, match="more than 2 symbols"):
            vi.wide_series(rows, "vwap")
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)


def test_new_alerts_and_memory(alerts):
    first = alerts((10, "A", 2.0), (None, "A", 2.0), (10, None, 2.0))
    second = alerts((10, "A", 5.0), (20, "A", 2.0), (None, "A", 3.0), (10, None, 2.0))
    nothing = first.filter("false")
    assert vi.new_alerts(first, nothing).count() == 3
    seen = vi.remember(nothing, first)
    assert rows_of(vi.new_alerts(second, seen), "window_end", "symbol") == [(shown(20), "A")]
    assert vi.new_alerts(second, vi.remember(seen, second)).count() == 0
    assert vi.remember(seen, first).count() == 3


def test_new_alerts_against_their_own_history(alerts):
    found = alerts((10, "A", 2.0), (20, "A", 3.0))
    assert vi.new_alerts(found, found.filter("percent_change > 2.5")).count() == 1


def test_new_alert_counts_include_idle_refreshes(alerts):
    log = vi.append_batches(
        alerts((10, "A", 2.0), (20, "A", 2.0)).withColumn("refresh", F.lit(1)),
        alerts((10, "A", 2.0)).withColumn("refresh", F.lit(2)),
        alerts((10, "A", 2.0), (30, "B", 2.0)).withColumn("refresh", F.lit(3)),
    )
    assert sorted(rows_of(vi.new_alert_counts(log, "refresh"))) == [(1, 2), (2, 0), (3, 1)]
    shown_first = vi.first_shown(log, "refresh")
    assert sorted(rows_of(shown_first, "refresh")) == [(1,), (1,), (3,)]
    assert shown_first.columns == log.columns


@pytest.mark.parametrize(
    "symbol, seconds, expected",
    [
        ("BTC", 10, "BTC_2024-01-01T00:00:10+00:00"),
        ("BTC", 10.5, "BTC_2024-01-01T00:00:10.500000+00:00"),
        ("BTC", None, "BTC_NaT"),
        (None, 10, "None_2024-01-01T00:00:10+00:00"),
    ],
)
def test_alert_key(spark, symbol, seconds, expected):
    row = spark.createDataFrame([(symbol, when(seconds))], "s STRING, w TIMESTAMP")
    assert rows_of(row.select(alert_key(F.col("s"), F.col("w")))) == [(expected,)]


@pytest.mark.parametrize("change", [2.675, 0.125, 0.375, -0.001, 1.005, 12345.678, -1.5, 1e-9])
def test_alert_line_rounds_like_two_decimal_formatting(spark, change):
    row = spark.createDataFrame(
        [("A", change, 100.0, 101.25, at(10))],
        "s STRING, c DOUBLE, f DOUBLE, l DOUBLE, w TIMESTAMP",
    )
    line = alert_line(*(F.col(c) for c in "scflw"))
    assert rows_of(row.select(line)) == [
        (f"A: {change:.2f}% change (100.0 -> 101.25) at 2024-01-01 00:00:10+00:00",)
    ]


def test_alert_line_defaults(spark):
    row = spark.createDataFrame(
        [(None, None, None, None, None)],
        "s STRING, c DOUBLE, f DOUBLE, l DOUBLE, w TIMESTAMP",
    )
    line = alert_line(*(F.col(c) for c in "scflw"))
    assert rows_of(row.select(line)) == [("UNKNOWN: 0.00% change (N/A -> N/A) at N/A",)]


@pytest.mark.parametrize(
    "value", [0.5, 100.0, 12345678.9, 1e7, 123456789012345.6, 0.0001, 0.00012345, 65000.01, -2e9]
)
def test_number_text_is_plain(spark, value):
    row = spark.createDataFrame([(value,)], "v DOUBLE")
    assert rows_of(row.select(number_text(F.col("v")))) == [(repr(value),)]


def test_percent_change(spark):
    pairs = [(100.0, 110.0), (0.0, 5.0), (None, 5.0), (5.0, None), (-0.0, 1.0), (8.0, 2.0)]
    rows = spark.createDataFrame(pairs, "f DOUBLE, l DOUBLE")
    changes = rows_of(rows.select(percent_change(F.col("f"), F.col("l"))))
    assert changes == [(10.0,), (0.0,), (None,), (None,), (0.0,), (-75.0,)]


def test_messages_leave_nulls_out(metrics):
    sent = to_messages(metrics((10, "A", None, 2.5)))
    assert rows_of(sent) == [
        ("A", '{"window_end":"2024-01-01T00:00:10.000Z","symbol":"A","total_volume":2.5}')
    ]
    assert sent.columns == ["key", "value"]
