import datetime as dt
import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

UTC = dt.timezone.utc


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> dt.datetime:
    """A moment of the test day."""
    return dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(seconds=seconds)


def ms(seconds: float) -> int:
    return int(at(seconds).timestamp() * 1000)


def naive(moment: dt.datetime) -> dt.datetime:
    """How ``collect`` shows an instant."""
    return moment.astimezone().replace(tzinfo=None)


TRADE_DDL = (
    "symbol STRING, event_time TIMESTAMP, price DOUBLE, quantity DOUBLE, "
    "volume_price DOUBLE, offset BIGINT"
)


@pytest.fixture
def trades(spark):
    """Builds typed trades from (symbol, seconds, price, quantity[, offset])."""

    def build(*rows, partitions=None):
        full = []
        for i, row in enumerate(rows):
            symbol, seconds, price, quantity, *offset = row
            product = None if price is None or quantity is None else price * quantity
            moment = None if seconds is None else at(seconds)
            full.append((symbol, moment, price, quantity, product, offset[0] if offset else i))
        frame = spark.createDataFrame(full, TRADE_DDL)
        return frame.repartition(partitions) if partitions else frame

    return build


@pytest.fixture
def messages(spark):
    """Builds messages from values: dicts become JSON, text is encoded, bytes and None stay."""

    def build(*values, keys=None):
        def encode(value):
            if value is None or isinstance(value, bytes):
                return value
            return (value if isinstance(value, str) else json.dumps(value)).encode()

        keys = keys or [None] * len(values)
        rows = [(encode(k), encode(v), i) for i, (k, v) in enumerate(zip(keys, values))]
        return spark.createDataFrame(rows, "key BINARY, value BINARY, offset BIGINT")

    return build


def rows_of(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return [tuple(row) for row in chosen.collect()]


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.is_dir():
        pytest.skip("the given tables are not here")
    return str(path)
