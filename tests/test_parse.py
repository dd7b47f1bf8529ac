import json

import pytest
from conftest import at, ms, naive, rows_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickflow.operators import parse as pa


def trade(**fields):
    return {"E": ms(1), "s": "BTC", "p": "10.5", "q": "2", **fields}


def test_parse_trades_types_and_product(messages):
    parsed = pa.parse_trades(messages(trade()))
    assert parsed.columns == [
        "symbol", "event_time", "price", "quantity", "volume_price", "offset",
    ]
    assert rows_of(parsed) == [("BTC", naive(at(1)), 10.5, 2.0, 21.0, 0)]


def test_parse_trades_keeps_milliseconds(messages):
    parsed = pa.parse_trades(messages(trade(E=ms(1) + 123)))
    assert rows_of(parsed, "event_time")[0][0].microsecond == 123_000


@pytest.mark.parametrize(
    "value, expected",
    [
        ("not json", (None, None, None, None)),
        ('[{"E":1,"s":"Z","p":"1","q":"1"}]', (None, None, None, None)),
        (None, (None, None, None, None)),
        ({"E": "x", "s": "ETH", "p": "1", "q": "1"}, ("ETH", None, 1.0, 1.0)),
        ({"E": 1000, "s": "N", "p": 5, "q": 1}, ("N", 1, 5.0, 1.0)),
        ({"E": 1000, "s": "A", "p": "abc", "q": "1"}, ("A", 1, None, 1.0)),
        ({"E": 2**62, "s": "F", "p": "1", "q": "1"}, ("F", None, 1.0, 1.0)),
        ({"E": 1000, "e": "trade", "s": "C", "p": "1", "q": "1", "T": 7}, ("C", 1, 1.0, 1.0)),
    ],
)
def test_parse_trades_bad_input(messages, value, expected):
    parsed = pa.parse_trades(messages(value))
    seconds = F.unix_seconds("event_time")
    assert rows_of(parsed, "symbol", seconds, "price", "quantity") == [expected]


def test_strict_numbers_fail(messages):
    with pytest.raises(PySparkException):
        pa.parse_trades(messages(trade(p="abc")), strict=True).collect()


def test_carry_nothing(messages):
    assert "offset" not in pa.parse_trades(messages(trade()), carry=()).columns


def envelope(**data):
    return {"stream": "btc@trade", "data": data}


def test_unwrap_and_validate(messages):
    feed = messages(
        envelope(E=1, s="BTC", p="1", q="2", t=7, extra={"deep": [1, 2]}),
        envelope(E=1, p="1", q="2"),
        envelope(),
        envelope(s=None),
        {"result": None, "id": 1},
        {"stream": "x", "data": "text"},
        {"stream": "x", "data": json.dumps({"s": "BTC"})},
        {"stream": "x", "data": [{"s": "BTC"}]},
        "not json",
        None,
    )
    opened = pa.unwrap(feed)
    assert rows_of(pa.accepted(opened), "offset", "stream", "trade.s") == [(0, "btc@trade", "BTC")]
    assert sorted(rows_of(pa.rejected(opened), "offset")) == [(i,) for i in range(1, 10)]


def test_mistyped_fields_of_a_trade_are_null(messages):
    opened = pa.unwrap(messages(envelope(E="soon", s="BTC", p=1.5, t=[1])))
    trade_fields = [f"trade.{name}" for name in "Espqt"]
    assert rows_of(pa.accepted(opened), *trade_fields) == [(None, "BTC", "1.5", None, "[1]")]


def test_republish_keeps_unknown_fields(messages):
    feed = messages(envelope(E=1, s="BTC", p="1", q="2", t=7, extra={"deep": [1, 2]}))
    out = pa.republish(pa.accepted(pa.unwrap(feed)))
    deep = F.get_json_object("value", "$.extra.deep[1]")
    assert rows_of(out, "key", deep) == [("BTC", "2")]
    assert out.columns == ["key", "value"]


def test_trade_summary_defaults(messages):
    feed = messages(envelope(s="BTC"), envelope(s="ETH", t=5, p="1.5", q="2"))
    assert sorted(rows_of(pa.trade_summary(pa.unwrap(feed)))) == [
        ("5", "ETH", "1.5", "2"),
        ("N/A", "BTC", "-1", "-1"),
    ]


def test_quarantine_reasons(messages):
    feed = messages(
        trade(),
        "not json",
        trade(s=None),
        trade(E=None),
        trade(p="abc"),
        trade(q=None),
        None,
        b"\xff\xfe",
        "{}",
    )
    assert sorted(rows_of(pa.quarantine(feed), "offset", "reason")) == [
        (1, "malformed"),
        (2, "no symbol"),
        (3, "no event time"),
        (4, "price is no number"),
        (5, "quantity is no number"),
        (6, "no text"),
        (7, "malformed"),
        (8, "no symbol"),
    ]


def test_decode_payload_drops_only_bad_rows(messages):
    feed = messages(
        {"symbol": "BTC", "vwap": 1.5, "key": "ignored"},
        "not json",
        "null",
        "5",
        "[1]",
        None,
        b"\xff",
        {"symbol": "ETH"},
        {"symbol": "BNB"},
        {"symbol": "SOL"},
        {"symbol": "XRP"},
        keys=["BTC", "a", "a", "a", "a", "a", "a", None, "", b"\xff", "XRP"],
    )
    decoded = pa.decode_payload(feed, ["symbol", "vwap"], carry=["offset"])
    assert sorted(rows_of(decoded, "offset", "symbol", "vwap", "key")) == [
        (0, "BTC", "1.5", "BTC"),
        (7, "ETH", None, None),
        (8, "BNB", None, None),
        (10, "XRP", None, "XRP"),
    ]


LOOSE = [
    '{"symbol":"A"} x',
    '{"symbol":"A"}}',
    '{"symbol":"A"}{"symbol":"B"}',
    '{"symbol":"A"}]}garbage',
    '{"symbol":"A"}],"list":[{"symbol":"B"}',
    '{"symbol":"A"}],"x":[]}',
    '{"symbol":"A"}],"x":[{"symbol":"B"}],"y":[]}',
    '{"symbol":"A"},{"symbol":"B"}',
    '{"symbol":"A"},"vwap":1',
    "{'symbol':'A'}",
    '{"symbol":"A",}',
    '{"symbol":/*c*/"A"}',
    '{"symbol":"A\n"}',
    '{"symbol":01}',
    '"{}"',
    "[{}]",
    "",
    " ",
    "{",
]
STRICT = ["{}", ' {"symbol":"A"} ', '{"symbol":"A","symbol":"B"}', '{"symbol":{"deep":[1]}}',
          '{"symbol":null}', '{"vwap":1e5}', '{"symbol":"\\u0041 \u00fc ]}"}', '{"other":[[1]]}']


@pytest.mark.parametrize("text", LOOSE + STRICT)
def test_decode_accepts_exactly_one_json_object(messages, text):
    try:
        expected = int(isinstance(json.loads(text), dict))
    except ValueError:
        expected = 0
    assert expected == (text in STRICT)
    assert pa.decode_payload(messages(text.encode()), ["symbol", "vwap"]).count() == expected


def test_decoded_text(messages):
    decoded = pa.decode_payload(messages(*STRICT), ["symbol", "vwap"], carry=["offset"])
    by_offset = {row.offset: row.symbol for row in decoded.collect()}
    assert by_offset == {
        0: None, 1: "A", 2: "B", 3: '{"deep":[1]}', 4: None, 5: None, 6: "A \u00fc ]}", 7: None
    }


def test_envelopes_are_as_strict(messages):
    good = '{"stream":"x","data":{"s":"A"}}'
    opened = pa.unwrap(messages(good, good + " x", good.replace('"', "'"), good + "," + good))
    assert rows_of(pa.accepted(opened), "offset") == [(0,)]
    assert rows_of(pa.rejected(opened), "stream", "payload") == [(None, None)] * 3


def test_coerce(spark):
    texts = ["1.5", "1e3", " 2 ", "abc", "", "1.5d", "2f", "NaN", "inf", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, vwap STRING")
    values = [v for _, v in sorted(rows_of(pa.coerce(rows, numbers=["vwap", "absent"])))]
    assert values == [1.5, 1000.0, 2.0, None, None, None, None, None, float("inf"), None]


def test_coerce_times_and_missing_window(spark):
    texts = ["2024-01-01T00:00:10.000Z", "2024-01-01T01:00:10+01:00", "soon", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "window_end STRING")
    typed = pa.coerce_metrics(rows)
    assert rows_of(pa.drop_missing_window(typed)) == [(naive(at(10)),)] * 2
    assert typed.count() == 5


def test_only_symbols(trades):
    kept = pa.only_symbols(trades(("BTCUSDT", 0, 1.0, 1.0), ("DOGE", 0, 1.0, 1.0)))
    assert rows_of(kept, "symbol") == [("BTCUSDT",)]
