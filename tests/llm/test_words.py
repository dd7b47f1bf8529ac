import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tickflow.llm import words
from tickflow.llm.near_dup import near_duplicates
from tickflow.llm.quality import statistics
from tickflow.llm.queries import tokenizer_path
from tickflow.llm.sentence_pieces import encode
from tickflow.llm.token_files import read_token_files, write_token_files
from tickflow.settings import scratch_path

# The Thue-Morse word and its complement: no power sum modulo 2**64 tells them apart.
BITS = [bin(at).count("1") & 1 for at in range(1024)]
TWINS = ["".join("ab"[bit] for bit in BITS), "".join("ba"[bit] for bit in BITS)]


def first_slice(texts, **options):
    return next(words.slices(pa.array(texts), **options))


def test_hashes_tell_power_sum_twins_apart():
    part = first_slice(TWINS)
    assert len(set(part.hashes(part.running()).tolist())) == 2


def test_hashes_are_of_bytes_wherever_they_stand():
    rng = random.Random(3)
    pool = ["".join(rng.choices("abé日", k=rng.randrange(1, 9))) for _ in range(300)]
    text = " ".join(rng.choices(pool, k=5000))
    part = first_slice([text[:777], text, None, "", text[5:]])
    hashes = part.hashes(part.running()).tolist()
    raw = [part.data[a:b].tobytes() for a, b in zip(part.starts, part.ends)]
    assert len(set(zip(raw, hashes))) == len(set(raw)) == len(set(hashes))


def test_long_texts_do_not_overflow(monkeypatch):
    text = "é" * 3000 + " word " + "z" * 500
    part = first_slice([text])
    plain = part.hashes(part.running())
    monkeypatch.setattr(words, "_PLAIN_BYTES", 10)
    assert (part.hashes(part.running()) == plain).all()


def test_distinct_compares_bytes(monkeypatch):
    part = first_slice(["abcabcabc-abcabcabd", "abcabcabc" + "x" * 100 + "y" * 100], is_word=None)
    starts, ends = np.array([0, 9, 10, 19, 28, 128]), np.array([9, 10, 19, 28, 128, 228])
    expected = ([0, 1, 2, 0, 3, 4], [0, 1, 2, 4, 5])
    assert tuple(x.tolist() for x in words.distinct(part, starts, ends)) == expected
    monkeypatch.setattr(words, "mix", lambda x: x * np.uint64(0))  # every hash meets every other
    assert tuple(x.tolist() for x in words.distinct(part, starts, ends)) == expected


@pytest.fixture(scope="module")
def twins(spark):
    return spark.createDataFrame(list(enumerate(TWINS)), "doc_id long, text string")


def test_twins_are_no_duplicates(twins):
    assert all(row.kept for row in near_duplicates(twins).collect())


def test_twin_lines_are_no_duplicates(spark, twins):
    both = spark.createDataFrame([("\n".join(TWINS),), ("\n".join([TWINS[0]] * 2),)], "text string")
    counts = statistics(both, both["text"]).collect()
    assert sorted(row.n_dup_lines for row in counts) == [0, 1]


def test_twins_have_their_own_tokens_and_pieces(spark, twins):
    pytest.importorskip("public_tokenizers")
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path = scratch_path(spark, "twins")
    write_token_files(twins.coalesce(1), path, tokenizer_path("byte_bpe_50k.json"))
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {row.doc_id: row.ids for row in read_token_files(spark, path).collect()}
    assert ids == {n: [*tokenizer.encode(text, add_special_tokens=False).ids, 0] for n, text in enumerate(TWINS)}
    model = tokenizer_path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=model)
    found = {row.doc_id: (row.ids, row.decoded) for row in encode(twins.coalesce(1), model, decoded=True).collect()}
    assert found == {n: (library.encode(text), text) for n, text in enumerate(TWINS)}
    assert len({hashlib.sha256(str(v).encode()).digest() for v in found.values()}) == 2
