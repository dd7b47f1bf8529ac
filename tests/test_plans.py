"""The shape of the physical plans, which is what decides their cost at scale."""

import re

import pytest
from conftest import TRADE_DDL
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import alerts as al
from tickflow.operators import metrics as me
from tickflow.operators import parse as pa
from tickflow.operators import views as vi
from tickflow.plans import catalog

PYTHON = ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "PythonMap")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Empty tables: plans need no rows."""
    path = str(tmp_path_factory.mktemp("stored"))
    spark.createDataFrame([], TRADE_DDL).write.parquet(f"{path}/trades")
    spark.createDataFrame([], schemas.MESSAGE).write.parquet(f"{path}/messages")
    read = spark.read.parquet
    return {"trades": read(f"{path}/trades"), "messages": read(f"{path}/messages")}


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def count(text, node):
    return len(re.findall(rf"\b{node}\b", text))


def test_metrics_multiply_panes_not_trades(stored):
    text = plan(me.vwap(stored["trades"]))
    # From the top down: windows are combined above the Expand, trades are summed below it.
    assert count(text, "Expand") == 1
    above, below = text.split("Expand", 1)
    assert above.count("HashAggregate") == 2 and below.count("HashAggregate") == 2
    assert count(text, "Exchange") == 2
    assert "partial_sum(CASE WHEN (abs(volume_price" in below and "SortAggregate" not in text


def test_metrics_read_only_what_they_need(stored):
    scan = plan(me.vwap(stored["trades"])).split("ReadSchema: ")[1]
    assert "price:double" not in scan.replace("volume_price:double", "")
    assert "offset" not in scan


def test_tumbling_metrics_shuffle_once(stored):
    text = plan(me.volume(stored["trades"]))
    assert count(text, "Exchange") == 1 and "Expand" not in text


@pytest.mark.parametrize("order", ["arrival", "event_time"])
def test_first_and_last_need_no_sort(stored, order):
    text = plan(al.volatility(stored["trades"], order=order))
    assert "Sort" not in text
    assert count(text, "Exchange") == 1
    assert "partial_min_by" in text


def test_symbol_filter_reaches_the_scan(stored):
    text = plan(me.vwap(pa.only_symbols(stored["trades"])))
    assert re.search(r"PushedFilters: \[.*In\(symbol, \[BNBUSDT", text)
    text = plan(me.vwap(stored["trades"]).filter("symbol = 'BTCUSDT'"))
    assert "EqualTo(symbol,BTCUSDT)" in text


@pytest.mark.parametrize(
    "build",
    [
        lambda m: me.vwap(pa.parse_trades(m)),
        lambda m: al.volatility(pa.parse_trades(m)),
        pa.quarantine,
        lambda m: pa.coerce_metrics(pa.decode_payload(m, schemas.METRIC_COLUMNS)),
    ],
)
def test_json_is_parsed_once(stored, build):
    text = plan(build(stored["messages"]))
    assert text.count("from_json(") == 1
    assert "ReadSchema: struct<" in text and "topic" not in text.split("ReadSchema")[1] or (
        build is pa.quarantine
    )


def test_envelopes_are_opened_once(stored):
    text = plan(pa.accepted(pa.unwrap(stored["messages"])).select("trade.s", "stream"))
    assert text.count("from_json(") == 1
    republished = plan(pa.republish(pa.accepted(pa.unwrap(stored["messages"]))))
    assert republished.count("from_json(") == 2  # and the payload text of accepted trades
    assert "Exchange" not in text + republished


def test_keep_last_combines_before_the_shuffle(stored):
    log = stored["trades"].select(
        F.col("event_time").alias("window_end"),
        "symbol",
        F.col("price").alias("vwap"),
        F.col("quantity").alias("total_volume"),
        "offset",
    )
    for view, exchanges in (
        (vi.keep_last(log, "offset"), 1),
        (vi.latest_values(log), 2),
        (vi.wide_series(log, "vwap", ["A", "B"]), 2),
    ):
        text = plan(view)
        assert count(text, "Exchange") == exchanges
        assert "partial_max" in text and "SortAggregate" not in text and "Window " not in text


def test_seen_alerts_are_not_forced_to_broadcast(spark, stored):
    alerts = al.volatility(stored["trades"], order="arrival")
    logical = vi.new_alerts(alerts, alerts)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in logical
    assert "LeftAnti" in logical


@pytest.mark.parametrize("name", sorted(catalog.BATCH))
def test_queries_stay_in_the_jvm(spark, name, sf_dir):
    text = plan(catalog.all_queries()[name](spark, sf_dir))
    assert not any(node in text for node in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window [" not in text and "RDDScan" not in text
