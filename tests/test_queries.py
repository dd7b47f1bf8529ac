"""Every named query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "scripts"))

check = pytest.importorskip("check_oracles")
driver = check.driver


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


def test_every_query_has_sql():
    assert set(driver.all_queries()) == set(driver.all_sql())


@pytest.mark.parametrize("name", sorted(driver.all_queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    good, note = check.compare(spark, con, sf_dir, name)
    assert good, note


def test_entry(spark, sf_dir):
    result = driver.entry(spark)
    assert result.columns == ["window_end", "symbol", "vwap", "total_volume"]
    assert result.count() > 0
