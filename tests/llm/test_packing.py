import random

import numpy as np
import pytest
from llm_rows import SF, TEXTS

from tierwise.llm import packing
from tierwise.llm.queries import BYTE_VOCABULARY, op5_packing


def test_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(300):
        size = rng.randint(1, 70)
        lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 90))]
        rows = packing.best_fit_decreasing(lengths, size)
        free = []
        for n in sorted(lengths, reverse=True):
            room = [(f, k) for k, f in enumerate(free) if f >= n]
            if room:
                free[min(room)[1]] -= n
            else:
                free.append(size - n)
        assert sorted(size - sum(lengths[i] for i in r) for r in rows) == sorted(free)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))


def check(rows, given, size):
    coder, found = BYTE_VOCABULARY.encoder(), {}
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u2")
        assert len(ids) == size and (ids[r.n_tokens :] == BYTE_VOCABULARY.eos).all()
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        places = packing.position_ids(r.cu_seqlens, size)
        assert len(places) == size and all(places[p] == 0 for p in r.position_resets)
        for i, n, at, a, b in zip(r.doc_ids, r.doc_numbers, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert 0 < b - a <= size
            found.setdefault((r.shard, n, i), []).append((at, ids[a:b].tolist()))
    made = []
    for (_, _, i), pieces in found.items():
        whole = [x for _, p in sorted(pieces) for x in p]
        assert [at for at, _ in sorted(pieces)] == list(range(0, len(whole), size))
        assert whole[-1] == BYTE_VOCABULARY.eos
        made.append((str(i), coder.decode(whole[:-1])))
    assert sorted(made) == sorted((str(i), t or "") for i, t in given)


@pytest.mark.parametrize("size", [16, 2048])
def test_round_trip(odd_docs, no_docs, size):
    check(packing.pack(odd_docs, BYTE_VOCABULARY, size, shard_tokens=3000).collect(), TEXTS, size)
    assert packing.pack(no_docs, BYTE_VOCABULARY, size).count() == 0


def test_unpack(docs, texts):
    packed = packing.pack(docs, BYTE_VOCABULARY, 256, shard_tokens=20_000)
    assert {r.doc_id: r.text for r in packing.unpack(packed, BYTE_VOCABULARY).collect()} == texts


def test_long_words_are_cut_without_loss():
    coder = BYTE_VOCABULARY.encoder()
    for text in ("a" * 100_000, " " * 9000 + "b", "é" * 5000 + "\n" * 5000):
        assert coder.decode(packing.encode(coder, text)) == text


def test_long_runs_have_the_vocabularys_own_ids():
    coder, rng = BYTE_VOCABULARY.encoder(), random.Random(2)
    joined = ",".join(f"item{i}" for i in range(600))
    spaces = ["".join(rng.choice(" \t\n\r\x85\u3000") for _ in range(n)) for n in (1999, 2000, 2001, 6000)]
    texts = [joined, "a" * 5000, "漢字" * 3000, "é=" * 3000, "x1" * 3000, "\x1c" * 5000 + "b", "it's" * 3000]
    texts += [f"{a}{s}{b}" for s in [" " * 2000, " " * 9000, "\n" * 5000, *spaces] for a in ("", "one ", "?") for b in ("", "two  2", "!", "\n")]
    texts.append(" ".join([joined, spaces[-1], joined, spaces[-2]]))
    for text in texts:
        assert packing.encode(coder, text) == coder.encode_ordinary(text)
    assert coder.decode(packing.encode(coder, " " * 1_000_000 + "b")) == " " * 1_000_000 + "b"


def test_files(spark, odd_docs, no_docs, tmp_path):
    path, width = str(tmp_path / "packed"), 64
    packing.write_packed(odd_docs, BYTE_VOCABULARY, path, width, shard_tokens=3000)
    rows = packing.read_packed(spark, path).collect()
    check(rows, TEXTS, width)
    assert sorted(rows) == sorted(packing.pack(odd_docs, BYTE_VOCABULARY, width, shard_tokens=3000).collect())
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, {})[r.row] = r
    files = [f for f in (tmp_path / "packed").glob("part-*") if f.stat().st_size]
    assert len(files) == len(by_shard) > 1
    for file in files:
        with np.load(file) as stored:
            own = by_shard.pop(str(stored["shard"]))
            assert stored["ids"].shape == (len(own), width) and stored["ids"].dtype == np.dtype("<u2")
            assert [i.tobytes() for i in stored["ids"]] == [own[k].ids for k in range(len(own))]
            assert stored["cu_seqlens"].tolist() == [x for k in range(len(own)) for x in own[k].cu_seqlens]
            assert stored["position_resets"].tolist() == [x for k in range(len(own)) for x in own[k].position_resets]
    packing.write_packed(no_docs, BYTE_VOCABULARY, str(tmp_path / "none"))
    assert packing.read_packed(spark, str(tmp_path / "none")).count() == 0


def test_query_writes_its_rows_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tierwise.llm.queries.work_dir", lambda _, label: str(tmp_path / label))
    rows = op5_packing(spark, SF).count()
    files = [f for f in (tmp_path / "packed").glob("part-*") if f.stat().st_size]
    assert files and sum(len(np.load(f)["ids"]) for f in files) == rows


def test_query(spark, texts):
    rows = op5_packing(spark, SF).collect()
    check(rows, list(texts.items()), 2048)
    assert sum(r.n_tokens for r in rows) / (2048 * len(rows)) > 0.97
