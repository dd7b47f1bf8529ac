import hashlib
import random

from pyspark.sql import functions as F

from tickflow.llm import chat

LAYOUT = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_of_nasty_texts(spark):
    rng = random.Random(4)
    pieces = ["<|im_start|>", "<|im_end|>", "<", "|", "\\", "<\\|", "\n", "a", "é", "😀", "%0A", "%", "$1"]
    rows = []
    for conversation in range(40):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choices(pieces, k=rng.randrange(0, 12)))
            role = rng.choice(["user", "assistant", "system", "a\nb%0A", "<|im_end|>", ""])
            rows.append((conversation, turn, role, text))
    rows.append((99, 0, "assistant", "x<|im_end|>" * 3000))
    formatted = chat.format_chats(spark.createDataFrame(rows, LAYOUT).repartition(3))
    found = formatted.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns")).collect()
    assert len(found) == 41
    for row in found:
        own = sorted((r for r in rows if r[0] == row.conv_id), key=lambda r: r[1])
        assert [tuple(t) for t in row.turns] == [(r[2], r[3]) for r in own]
        assert row.formatted.count("<|im_start|>") == row.formatted.count("<|im_end|>") == len(own)
    for row in chat.chat_digest(formatted).collect():
        own = sorted((r for r in rows if r[0] == row.conv_id), key=lambda r: r[1])
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        said = "".join(f"{r[2]}\n{r[3]}\n" for r in own)
        assert tuple(row[1:5]) == (len(own), digest(said), len(loss), digest(loss))


def test_fold_of_streamed_events(spark):
    log = [
        (1, 0, 1, "delta", None, "Hel"), (1, 0, 2, "delta", None, "lo"), (1, 0, 0, "open", "user", None),
        (1, 1, 0, "open", "assistant", None), (1, 1, 1, "delta", None, "bad"), (1, 1, 2, "regenerate", None, "lost"),
        (1, 1, 3, "delta", None, "go"), (1, 1, 4, "delta", None, None), (1, 1, 5, "delta", None, "od"),
        (1, 2, 0, "open", "user", None), (1, 2, 1, "delta", None, "typo"), (1, 2, 2, "edit", None, "fixed"),
        (1, 2, 3, "delta", None, "!"), (1, 3, 0, "open", "user", None), (1, 3, 1, "delete", None, None),
        (1, 3, 2, "delta", None, "ghost"), (1, 4, None, "delta", None, "no role"), (1, 4, 1, "unheard", None, "?"),
        (None, 0, 0, "open", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, turn long, seq int, event string, role string, text string")
    events = events.select("conv_id", F.struct("turn").alias("message"), "seq", "event", "role", "text").repartition(4)
    got = chat.final_messages(events)
    found = sorted(((r.conv_id, r.message.turn, r.role, r.text) for r in got.collect()), key=repr)
    assert found == [
        (1, 0, "user", "Hello"),
        (1, 1, "assistant", "good"),
        (1, 2, "user", "fixed!"),
        (1, 4, "", "no role"),
        (None, 0, "", ""),
    ]


def test_deltas_are_put_together_again(spark):
    rows = [(1, 0, "assistant", "aé😀" * 700), (1, 1, "user", ""), (1, 2, None, None)]
    frame = spark.createDataFrame(rows, LAYOUT)
    assert chat.message_events(frame).filter("event = 'delta'").count() > 5
    texts = {r.message.turn: (r.role, r.text) for r in chat.final_messages(chat.message_events(frame)).collect()}
    assert texts == {0: ("assistant", "aé😀" * 700), 1: ("user", ""), 2: ("", "")}


def test_ties_repeats_nulls_and_other_columns(spark):
    rows = [(1, 0, "user", "b", 1), (1, 0, "user", "b", 2), (1, 0, "assistant", "z", 3), (1, None, "user", "first", 4), (None, 1, "user", "n", 5)]
    frame = spark.createDataFrame(rows, LAYOUT + ", message int")
    got = {r.conv_id: r.formatted for r in chat.format_chats(frame).collect()}
    turn = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert got[1] == turn("user", "first") + turn("assistant", "z") + turn("user", "b") * 2
    assert got[None] == turn("user", "n")
    assert chat.chat_digest(chat.format_chats(frame.limit(0))).count() == 0


def test_long_conversations_are_joined_in_blocks(spark):
    rows = spark.range(1000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "cast(id AS string) AS text")
    (row,) = chat.format_chats(rows.repartition(5)).collect()
    assert row.formatted == "".join(f"<|im_start|>user\n{k}<|im_end|>\n" for k in range(1000))


def test_plan_is_native(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x")], LAYOUT)
    plan = chat.chat_digest(chat.format_chats(rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_time_grows_with_the_length_of_a_text(spark):
    import time

    text = "é日😀\n" * 1_000_000
    rows = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    start = time.time()
    found = chat.chat_digest(chat.format_chats(rows)).head()
    assert time.time() - start < 30
    assert found.loss_chars == 4_000_000
    assert found.loss_sha256 == digest(text)
