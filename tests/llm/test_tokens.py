import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickflow.llm import pieces, simple8b
from tickflow.llm.queries import tokenizer_path
from tickflow.llm.sentence_pieces import decode, encode
from tickflow.llm.token_files import read_token_files, token_files, write_token_files
from tickflow.settings import scratch_path

pytest.importorskip("public_tokenizers")
LAYOUT = "doc_id long, text string"
ODD = ["a", "B", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "#", "é", "×", "ß", "12", "日", "　", "\x1c", "\x85", "\x00", "😀"]
ODD += ["don't", "<|endoftext|>", "</s>", "▁", "the", " th", "ing", "é,", "__", "    "]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(6)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(0, 30))) for _ in range(600)]
    return list(enumerate([*texts, "", None, "ab " * 40_000, "x" * 2_000]))


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=150, deadline=None)
def test_simple8b_round_trip(ids):
    words, escapes = simple8b.encode(np.array(ids, dtype=np.uint64))
    assert simple8b.decode(words, escapes).tolist() == ids
    assert len(escapes) == sum(x >= 1 << 60 for x in ids)
    block = simple8b.pack_block([1, None], np.array([0, len(ids)]), np.array(ids, dtype=np.uint64))
    numbers, lengths, found = simple8b.unpack_block(block)
    assert (numbers, lengths.tolist(), found.tolist()) == ([1, None], [0, len(ids)], ids)


def test_simple8b_packs_as_many_as_fit():
    assert len(simple8b.encode(np.zeros(240, np.uint64))[0]) == 2
    assert len(simple8b.encode(np.full(60, 1, np.uint64))[0]) == 1
    assert len(simple8b.encode(np.full(9, 40_000, np.uint64))[0]) == 3
    with pytest.raises(ValueError):
        simple8b.unpack_block(b"XXXX" + bytes(30))


def test_token_files_equal_the_library(spark, odd_rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    path = scratch_path(spark, "test-tokens")
    frame = spark.createDataFrame(odd_rows, LAYOUT).repartition(5)
    write_token_files(frame, path, tokenizer_path("byte_bpe_50k.json"))
    found = sorted(read_token_files(spark, path).collect())
    assert [r.doc_id for r in found] == [number for number, _ in odd_rows]
    start = 0
    for row, (_, text) in zip(found, odd_rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert row.ids == ids and row.n_tokens == len(ids) and row.start == start
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_of_odd_tables(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    rows = [(5, "b", 1), (None, "n", 1), (5, "a", 1), (5, "a", 1), (1, None, 1)]
    frame = spark.createDataFrame(rows, LAYOUT + ", start int")
    got = token_files(frame, scratch_path(spark, "test-tokens"), path).orderBy("start")
    assert [(r.doc_id, r.start, r.n_tokens) for r in got.collect()] == [(None, 0, 2), (1, 2, 1), (5, 3, 2), (5, 5, 2), (5, 7, 2)]
    assert token_files(frame.limit(0), scratch_path(spark, "test-tokens"), path).count() == 0


def test_pieces_equal_the_library_and_decode(spark, odd_rows):
    import sentencepiece

    model = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    frame = spark.createDataFrame(odd_rows, LAYOUT).repartition(5)
    found = decode(encode(frame, model), model).collect()
    both = encode(frame, model, decoded=True)
    assert {r.doc_id: r.decoded for r in both.collect()} == {r.doc_id: r.decoded for r in found}
    assert len(found) == len(odd_rows)
    texts = dict(odd_rows)
    for row in found:
        text = texts[row.doc_id] or ""
        assert row.ids == library.encode(text), repr(text[:80])
        assert row.decoded == text.replace("▁", " ")


def test_pieces_of_odd_tables(spark):
    model = tokenizer_path("piece_bpe_32k.model")
    frame = spark.createDataFrame([(1, "a b", 2), (1, "a b", 2), (None, "a b", 2), (2, None, 2)], LAYOUT + ", unit int")
    got = sorted(map(tuple, encode(frame, model).collect()), key=repr)
    assert [row[0] for row in got] == [1, 1, 2, None] and got[0][1] == got[1][1] == got[3][1] and got[2][1] == []
    assert encode(frame.limit(0), model).count() == 0
    ids = spark.createDataFrame([(1, [0, 1, 3 + 0xFF, 2]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in decode(ids, model).collect()} == {1: "⁇ �", 2: "", 3: None}


def test_compatible_pairs_are_what_merging_leaves():
    known = pieces.load(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(1)
    listed = [text for text in known.halves if text.isascii()]
    for _ in range(3000):
        left, right = rng.choice(listed), rng.choice(listed)
        merged = known._merged(left + right)[0] == [left, right]
        assert known.compatible(known.ids[left], known.ids[right]) == merged, (left, right)


def test_remembered_pairs_stay_right_where_many_share_a_place(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BITS", 4)
    known = pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))
    numbers = np.array(sorted(known.ids[text] for text in known.halves))
    rng = np.random.default_rng(7)
    asked = numbers[rng.integers(0, len(numbers), size=(2, 400))]
    for _ in range(3):
        left, right = asked[:, rng.integers(0, 400, size=1_000)]
        right_answers = [known.compatible(a, b) for a, b in zip(left.tolist(), right.tolist())]
        assert known.beside(left, right).tolist() == right_answers
    assert known.beside(left[:0], right[:0]).tolist() == []
    assert len(known._answered) == 16
