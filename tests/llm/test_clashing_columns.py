import pytest

from tickflow.llm.decontaminate import drop_contaminated
from tickflow.llm.near_dup import keep_one
from tickflow.llm.quality import keep_good
from tickflow.llm.tables import free_names
from tickflow.llm.toxicity import drop_toxic

HELPERS = (
    "row known known_ lost Lost copied_id copied_text copied_text_ label n n_words kept score held_out digest signature rep key "
    "leader doc component shingle around lead row_id window item_id contaminated counted quality toxic at size"
).split()
NAMES = [name for k, name in enumerate(HELPERS) if name.lower() not in (x.lower() for x in HELPERS[:k])]


def test_free_names(spark):
    frame = spark.createDataFrame([(1, 2)], "known int, KNOWN_ int")
    assert free_names(frame, "known", "lost", "lost") == ["known__", "lost", "lost_"]


@pytest.mark.parametrize("stage", ["toxicity", "quality", "near_dup", "decontamination"])
def test_stages_keep_columns_of_any_name(spark, stage):
    clean = "It is a plain text of more than ten words, as one can see here at once"
    rows = [(1, clean), (2, clean), (3, "passage number one two three four five six seven eight nine"), (None, clean)]
    layout = "doc_id long, text string" + "".join(f", `{name}` string" for name in NAMES)
    docs = spark.createDataFrame([(*row, *NAMES) for row in rows], layout)
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([("i", rows[2][1])], "item_id string, text string")
    found = {
        "toxicity": lambda: drop_toxic(docs, labels),
        "quality": lambda: keep_good(docs, labels),
        "near_dup": lambda: keep_one(docs),
        "decontamination": lambda: drop_contaminated(docs, items),
    }[stage]()
    assert found.schema == docs.schema
    ids = {"near_dup": [1, 3, None], "decontamination": [1, 2, None]}.get(stage, [1, 2, 3, None])
    got = found.collect()
    assert sorted((r.doc_id for r in got), key=str) == sorted(ids, key=str)
    assert all(list(r)[2:] == NAMES for r in got)
