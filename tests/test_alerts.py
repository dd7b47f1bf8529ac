import pytest
from conftest import at, naive, rows_of

from tickflow.operators import alerts as al
from tickflow.operators import metrics as me


def prices(frame):
    return rows_of(frame, "symbol", "first_price", "last_price")


def test_columns_and_bounds(trades):
    alert = al.volatility(trades(("A", 1, 100.0, 1.0), ("A", 9.9, 102.0, 1.0)))
    assert alert.columns == [
        "window_start", "window_end", "symbol", "first_price", "last_price", "percent_change",
    ]
    assert rows_of(alert) == [(naive(at(0)), naive(at(10)), "A", 100.0, 102.0, 2.0)]


def test_arrival_order_is_the_default(trades):
    rows = trades(("A", 5, 1.0, 1.0, 10), ("A", 1, 2.0, 1.0, 11), ("A", 3, 3.0, 1.0, 12))
    assert prices(al.first_last(rows)) == [("A", 1.0, 3.0)]
    assert prices(al.first_last(rows, order="event_time")) == [("A", 2.0, 1.0)]


def test_equal_times_are_decided_by_arrival(trades):
    rows = trades(("A", 1, 1.0, 1.0, 7), ("A", 1, 2.0, 1.0, 5), ("A", 1, 3.0, 1.0, 6))
    assert prices(al.first_last(rows, order="event_time")) == [("A", 2.0, 1.0)]


@pytest.mark.parametrize("ids", [(-(2**63), 0, 2**63 - 1), (-5, -4, 3), (0, 10**18, 9 * 10**18)])
def test_any_arrival_number_orders(trades, ids):
    low, middle, high = ids
    rows = trades(("A", 1, 2.0, 1.0, middle), ("A", 1, 3.0, 1.0, high), ("A", 1, 1.0, 1.0, low))
    for order in ("event_time", "arrival"):
        assert prices(al.first_last(rows, order=order)) == [("A", 1.0, 3.0)]


def test_times_before_the_epoch_order(trades):
    base = -3_000_000_000
    rows = trades(("A", base + 1, 1.0, 1.0, 9), ("A", base + 2, 2.0, 1.0, 1))
    assert prices(al.first_last(rows, order="event_time")) == [("A", 1.0, 2.0)]


def test_null_prices_are_kept(trades):
    rows = trades(("A", 1, None, 1.0), ("A", 2, 5.0, 1.0), ("B", 1, 5.0, 1.0), ("B", 2, None, 1.0))
    assert sorted(prices(al.first_last(rows)), key=str) == [("A", None, 5.0), ("B", 5.0, None)]
    assert al.volatility(rows).count() == 0


def test_unknown_order_is_refused(trades):
    with pytest.raises(ValueError):
        al.first_last(trades(("A", 1, 1.0, 1.0)), order="price")


@pytest.mark.parametrize(
    "first, last, alerts",
    [
        (0.0, 50.0, 0),  # first price zero counts as no change
        (100.0, 101.0, 0),  # exactly the threshold
        (100.0, 99.0, 0),
        (100.0, 101.5, 1),
        (100.0, 98.5, 1),
    ],
)
def test_threshold_is_strict(trades, first, last, alerts):
    assert al.volatility(trades(("A", 1, first, 1.0), ("A", 2, last, 1.0))).count() == alerts


def test_single_trade_changes_nothing(trades):
    assert al.volatility(trades(("A", 1, 10.0, 1.0)), threshold=0.0).count() == 0


@pytest.mark.parametrize("order", ["arrival", "event_time"])
def test_panes_give_the_same_alerts(trades, order):
    rows = trades(
        *(("AB"[i % 2], (i * 37) % 120, float((i * 13) % 29), 1.0, i) for i in range(200)),
        partitions=4,
    )
    panes = me.trade_panes(rows, "10 seconds", order=order)
    direct = al.volatility(rows, "30 seconds", 1.0, order=order)
    via_panes = al.alerts_over(al.first_last_from_panes(panes, "30 seconds"), 1.0)
    assert sorted(rows_of(via_panes)) == sorted(rows_of(direct)) != []
    sums = me.vwap_from_panes(panes, "30 seconds", "10 seconds")
    assert sorted(rows_of(sums)) == sorted(rows_of(me.vwap(rows)))
