"""Named queries against their SQL, and the pipeline against its operators, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

check = pytest.importorskip("check_oracles")

import corpus_pipeline  # noqa: E402
from tickflow.llm import queries, toxicity  # noqa: E402
from tickflow.llm.components import components  # noqa: E402
from tickflow.llm.decontaminate import decontaminate  # noqa: E402
from tickflow.llm.near_dup import near_duplicates  # noqa: E402
from tickflow.llm.quality import quality_rules  # noqa: E402
from tickflow.llm.tables import least_hashed, read, settle  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.all_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    good, note = check.compare(spark, check.connect(sf_dir), sf_dir, name)
    assert good, note


def test_every_operator_is_registered(spark):
    found = check.driver.queries()
    assert [sum(name.startswith(f"op{n}_") for name in found) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in found and set(check.driver.oracle_sql()) <= set(found)


def test_pipeline_is_its_operators_in_turn(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    labels, items = read(spark, sf_dir, "labels"), read(spark, sf_dir, "benchmark")
    left = docs
    for judged in (
        lambda d: toxicity.toxicity(d, labels).filter("predicted = 0"),
        lambda d: quality_rules(d, labels).filter("kept"),
        lambda d: near_duplicates(d).filter("kept"),
        lambda d: decontaminate(d, items).filter("NOT contaminated"),
    ):
        left = settle(left.join(judged(left).select("doc_id"), "doc_id", "left_semi"), "left")
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_pieces", "ids", "decoded_chars", "decoded_sha256"]
    found = {r.doc_id: r.decoded_sha256 for r in got.collect()}
    assert found == {r.doc_id: r.sha for r in left.selectExpr("doc_id", "sha2(text, 256) AS sha").collect()}


def test_stages_keep_the_columns_and_empty_tables(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        assert result.columns == docs.columns and result.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, settle(docs, "none"), sf_dir).count() == 0


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (50, 100), (7, 7), (None, 3), (60, 61), (61, 62), (62, 60)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, 50: 50, 100: 50, 60: 60, 61: 60, 62: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_hashed_is_a_repeatable_sample(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    one, two = (sorted(r.doc_id for r in least_hashed(rows.repartition(n), 100).collect()) for n in (2, 7))
    assert one == two and len(one) == 100
    assert least_hashed(rows, 9000).count() == 5000
