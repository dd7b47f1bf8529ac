import pyarrow as pa
import pytest

import corpus_pipeline
from tickflow.llm import components, decontaminate, near_dup, quality, workers


@pytest.fixture
def many_partitions(spark):
    """A session that deals every shuffle to 24 partitions and leaves them so."""
    names = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture
def written(monkeypatch):
    """Files that each settled table has, by its name."""
    files = {}
    for module in (components, decontaminate, near_dup, quality):

        def settle(frame, name, *rest, whole=module.settle):
            table = whole(frame, name, *rest)
            files.setdefault(name, []).append(len(table.inputFiles()))
            return table

        monkeypatch.setattr(module, "settle", settle)
    return files


def test_components_write_one_file_a_round(spark, many_partitions, written):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)], "a long, b long").repartition(8)
    assert {tuple(row) for row in components.components(links).collect()} == {(k, 0) for k in range(61)}
    assert written["edges"] == [1] and set(written["labels"]) == {1}


def test_near_duplicates_write_few_files(spark, many_partitions, written):
    texts = [" ".join(f"w{(7 * k * (at + 3)) % 501}" for at in range(60)) for k in range(1, 31)]
    rows = [(k, texts[k // 2] + f" tail{k}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    kept = {row.doc_id for row in near_dup.near_duplicates(docs).filter("kept").collect()}
    assert kept == set(range(0, 60, 2))
    for name in ("classes", "shared", "members", "sets", "labelled", "open"):
        assert written[name] == [1], name


def test_keys_are_made_a_bounded_number_at_a_time(spark, written, monkeypatch):
    monkeypatch.setattr(near_dup, "_CLASSES_PER_PART", 10, raising=False)
    rows = [(k, " ".join(f"w{k}x{at}" for at in range(8))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert near_dup.near_duplicates(docs).filter("kept").count() == 40
    assert written["classes"] == [5] and written["keys"][0] > 1


def test_windows_and_labels_write_few_files(spark, many_partitions, written):
    item = " ".join(f"i{k}" for k in range(40))
    docs = spark.createDataFrame([(k, f"a b {item} c{k}" if k % 2 else f"clean {k}") for k in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([("x", item)], "item_id string, text string")
    assert decontaminate.drop_contaminated(docs, items).count() == 10
    for name in ("window-shingles", "tokens"):
        assert written[name] == [1], name
    labels = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    quality.keep_good(docs, labels)
    assert written["known"] == [1]


def test_workers_give_back_what_a_task_used(monkeypatch):
    given = []
    monkeypatch.setattr(workers, "give_back", lambda: given.append(1))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2], pa.int64()), "text": ["a b", None]})
    assert [len(found) for found in near_dup._sign(iter([batch]))] == [2]
    assert len(given) == 1
    # Also where the rows that come out are not all taken.
    found = near_dup._sign(iter([batch, batch]))
    next(found)
    found.close()
    assert len(given) == 2


def test_lean_functions_fail_as_before():
    @workers.lean
    def broken(batches):
        yield next(batches)
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        list(broken(iter([pa.RecordBatch.from_pydict({"x": [1]})])))


def test_stages_send_texts_some_megabytes_at_a_time(spark):
    """Ten thousand texts of 2 KB came as one batch before."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    docs = spark.range(5000).selectExpr("id AS doc_id", "repeat(cast(id AS string), 700) AS text").coalesce(1)
    try:
        corpus_pipeline.near_dedup(spark, docs.limit(3), "")
        found = [row.n for row in docs.mapInArrow(sizes, "n long").collect()]
        assert len(found) > 2 and max(found) < 2 * workers.BATCH_BYTES
    finally:
        spark.conf.set(name, before)
