import datetime as dt
import math
from collections import defaultdict
from fractions import Fraction

import pytest
from conftest import at, naive, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickflow.functions.durations import common_pane, micros
from tickflow.operators import metrics as me


def ends(frame):
    return sorted(rows_of(frame, "window_end"))


@pytest.mark.parametrize("second", [0.0, 5.0, 10.0, 29.9])
def test_each_trade_is_in_three_windows(trades, second):
    start = int(second // 10) * 10
    expected = [(naive(at(start + 10 * i)),) for i in (1, 2, 3)]
    assert ends(me.vwap(trades(("A", second, 1.0, 1.0)))) == expected


def test_windows_are_half_open(trades):
    counted = me.vwap(trades(("A", 0, 1.0, 1.0), ("A", 30, 1.0, 5.0)))
    by_end = dict(rows_of(counted, "window_end", "total_volume"))
    assert by_end[naive(at(30))] == 1.0
    assert by_end[naive(at(40))] == 5.0


def test_vwap_value_and_columns(trades):
    metric = me.vwap(trades(("A", 1, 10.0, 1.0), ("A", 2, 20.0, 3.0)), "10 seconds", "10 seconds")
    assert metric.columns == ["window_end", "symbol", "vwap", "total_volume"]
    assert rows_of(metric) == [(naive(at(10)), "A", 17.5, 4.0)]


def test_zero_volume_gives_null(trades):
    metric = me.vwap(trades(("A", 1, 10.0, 0.0)), "10 seconds", "10 seconds")
    assert rows_of(metric, "vwap", "total_volume") == [(None, 0.0)]


def test_null_price_counts_as_volume_unless_valid_only(trades):
    rows = trades(("A", 1, None, 1.0), ("A", 2, 10.0, 1.0))
    metric = me.vwap(rows, "10 seconds", "10 seconds")
    assert rows_of(metric, "vwap", "total_volume") == [(5.0, 2.0)]
    valid = me.vwap(rows, "10 seconds", "10 seconds", valid_only=True)
    assert rows_of(valid, "vwap", "total_volume") == [(10.0, 1.0)]


def test_null_time_is_dropped_and_null_symbol_is_a_group(trades):
    rows = trades(("A", None, 1.0, 1.0), (None, 1, 1.0, 1.0), (None, 2, 3.0, 1.0))
    metric = me.vwap(rows, "10 seconds", "10 seconds")
    assert rows_of(metric, "symbol", "vwap") == [(None, 2.0)]


def test_times_before_the_epoch(spark, trades):
    rows = trades(("A", -dt.timedelta(days=365 * 60).total_seconds() - 1, 1.0, 1.0))
    assert me.vwap(rows).count() == 3


def test_exact_sums_do_not_depend_on_order(trades):
    rows = [("A", i % 10, round(0.1 + i / 7, 8), round(0.3 + i / 3, 8)) for i in range(500)]
    forward = me.vwap(trades(*rows, partitions=1), "10 seconds", "10 seconds", exact=True)
    backward = me.vwap(trades(*rows[::-1], partitions=3), "10 seconds", "10 seconds", exact=True)
    assert rows_of(forward) == rows_of(backward)


def test_exact_fails_rather_than_rounds(trades):
    for price, places in ((1e11, True), (0.000000001234, True), (0.123, 2), (1.0, 18)):
        with pytest.raises(Exception, match="price does not fit"):
            me.vwap(trades(("A", 1, price, 0.0)), exact=places).collect()
    fits = me.vwap(trades(("A", 1, 0.000000001234, 1.0)), exact=12)
    assert rows_of(fits, "vwap") == [(0.000000001234,)] * 3


@pytest.mark.parametrize("exact", [False, True])
def test_nan_and_infinite_numbers_are_missing(trades, exact):
    rows = [("A", 1, float("nan"), 2.0), ("A", 1, float("inf"), 3.0), ("A", 2, 4.0, 1.0), ("A", 3, 5.0, float("nan"))]
    assert rows_of(me.vwap(trades(*rows), "10 seconds", "10 seconds", exact=exact), "vwap", "total_volume") == [
        (4.0 / 6.0, 6.0)
    ]


def test_slide_beyond_the_window_is_refused(trades):
    for length, slide in (("10 seconds", "30 seconds"), ("20 seconds", "30 seconds")):
        with pytest.raises(ValueError, match="longer than window"):
            me.vwap(trades(("A", 1, 1.0, 1.0)), length, slide)
    one = me.vwap(trades(("A", 1, 1.0, 1.0)), "interval 30 seconds", "INTERVAL 10 seconds")
    assert one.count() == 3


def test_volume_sums_to_total(trades):
    rows = [("AB"[i % 2], i * 1.7, 1.0, float(i)) for i in range(50)]
    volume = me.volume(trades(*rows))
    assert math.isclose(sum(v for (v,) in rows_of(volume, "total_volume")), sum(range(50)))
    assert volume.columns == ["window_end", "symbol", "total_volume"]


@pytest.mark.parametrize(
    "length, slide, pane",
    [
        ("30 seconds", "10 seconds", 10),
        ("25 seconds", "10 seconds", 5),
        ("1 minute", "1 minute", 60),
        ("1 hour 30 minutes", "1 hour", 1800),
    ],
)
def test_common_pane(length, slide, pane):
    assert common_pane(length, slide) == f"{pane * 1_000_000} microseconds"


@pytest.mark.parametrize("text", ["", "1 month", "fast", "0 seconds", "1 second and more"])
def test_durations_without_fixed_length_are_refused(text):
    with pytest.raises(ValueError):
        micros(text)


def brute_force(rows, length, slide):
    sums = defaultdict(lambda: [Fraction(0), Fraction(0)])
    for symbol, second, price, quantity in rows:
        tenths = round(second * 10)
        start = tenths // (slide * 10) * slide * 10
        while start > tenths - length * 10:
            total = sums[(start + length * 10, symbol)]
            total[0] += Fraction(price) * Fraction(quantity)
            total[1] += Fraction(quantity)
            start -= slide * 10
    return {
        (naive(at(end / 10)), symbol): (float(n / q) if q else None, float(q))
        for (end, symbol), (n, q) in sums.items()
    }


@settings(max_examples=8, deadline=None, database=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(
            st.sampled_from("ABC"),
            st.integers(-600, 1200).map(lambda t: t / 10),
            st.integers(0, 64).map(lambda p: p / 4),
            st.integers(0, 16).map(lambda q: q / 4),
        ),
        min_size=1,
        max_size=30,
    ),
    window=st.sampled_from([(30, 10), (25, 10), (10, 10), (45, 20), (7, 3)]),
)
def test_sliding_windows_match_brute_force(trades, rows, window):
    length, slide = window
    metric = me.vwap(trades(*rows), f"{length} seconds", f"{slide} seconds")
    found = {(row[0], row[1]): (row[2], row[3]) for row in rows_of(metric)}
    expected = brute_force(rows, length, slide)
    assert found.keys() == expected.keys()
    for key, (vwap, volume) in expected.items():
        assert found[key][1] == volume
        assert found[key][0] == (None if vwap is None else pytest.approx(vwap, rel=1e-12))


def test_vwap_lies_between_extreme_prices(trades):
    rows = [("A", i % 40, 5.0 + i % 11, 0.5 + i % 3) for i in range(200)]
    for (vwap,) in rows_of(me.vwap(trades(*rows)), "vwap"):
        assert 5.0 <= vwap <= 15.0
