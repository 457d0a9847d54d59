import hashlib
import random

import public_tokenizers
import pytest
from llm_rows import TEXTS
from tokenizers import Tokenizer

from tierwise.llm import bpe
from tierwise.llm.queries import VOCABULARY, op3_bpe


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids, lambda ids: tokenizer.decode(ids, skip_special_tokens=False)


def test_every_code_point_as_the_library(library):
    points = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000] + list(range(0x300))
    samples = [f"a{chr(c)}B 1{chr(c)}" for c in points]
    mine = bpe.WordBpe(VOCABULARY).encode_all(samples)
    assert [s for s, ids in zip(samples, mine, strict=True) if ids != library[0](s)] == []


def test_random_texts_as_the_library(library):
    rng = random.Random(3)
    samples = ["".join(rng.choice("aabcdeéèß 1'.<|>stendofx\n") for _ in range(rng.randint(0, 200))) for _ in range(400)]
    samples += ["x" * n for n in range(70)] + ["ab" * 5000, "<|endoftext|>" * 3]
    coder = bpe.WordBpe(VOCABULARY)
    for sample, ids in zip(samples, coder.encode_all(samples), strict=True):
        assert ids == library[0](sample)
        assert coder.decode(ids) == library[1](ids)


def test_one_tree_or_a_matrix_of_trees():
    coder, rng = bpe.WordBpe(VOCABULARY), random.Random(1)
    words = [bytes(rng.choice(b"thestionand") for _ in range(rng.randint(33, 64))) for _ in range(200)]
    assert coder.merge_many(words, 64) == [tuple(coder.merge_long(w)) for w in words]


def test_memory_is_emptied_without_effect(monkeypatch, texts):
    whole = bpe.WordBpe(VOCABULARY).encode_all(list(texts.values()))
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    small = bpe.WordBpe(VOCABULARY)
    assert [small.encode_all([t])[0] for t in texts.values()] == whole


def test_odd_rows(library, odd_docs, no_docs):
    rows = bpe.encode(odd_docs, VOCABULARY, tuple(bpe.OUTPUTS)).collect()
    expected = sorted((str(i), library[0](t or "")) for i, t in TEXTS)
    assert sorted((str(r.doc_id), r.ids) for r in rows) == expected
    for r in rows:
        assert r.n_tokens == len(r.ids) and r.decoded == library[1](r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.encode(no_docs, VOCABULARY).count() == 0


def test_decode_of_ids(spark, library):
    ids = library[0]("The end. <|endoftext|>")
    frame = spark.createDataFrame([(1, ids), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(frame, VOCABULARY).collect()} == {1: library[1](ids), 2: "", 3: ""}


def test_query(spark, library, texts):
    rows = op3_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library[0](texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library[1](ids).encode()).hexdigest()
