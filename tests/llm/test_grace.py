import hashlib
import os
import random
import re

from llm_rows import SF, TEXTS
from pyspark.sql import functions as F

from tierwise.llm import grace
from tierwise.llm.queries import op13_exact_dedup


def brute(rows):
    same = {}
    for doc_id, text in rows:
        same.setdefault(re.sub("[\x20\x09-\x0d]+", " ", text or ""), []).append(doc_id)
    made = []
    for text, ids in same.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = hashlib.sha256(text.encode()).hexdigest()
        made += [(i, ids[0], len(ids), at == 0, digest) for at, i in enumerate(ids)]
    return sorted(made, key=str)


def found(docs, **how):
    frame = grace.exact_duplicates(docs, **how)
    assert frame.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(map(tuple, frame.collect()), key=str)


def test_odd_rows(odd_docs, no_docs):
    assert found(odd_docs) == brute(TEXTS)
    assert found(no_docs) == []


def test_one_hash_for_all_contents(spark):
    """Contents are compared whole: a hash that is always the same, or nearly, changes nothing."""
    rng = random.Random(1)
    rows = [(rng.randrange(500), " ".join(rng.choices(["a", "b", "\t", "é" * 50], k=rng.randrange(1, 7)))) for _ in range(900)]
    rows += [(i, "the hot text  of a third") for i in range(450)] + [(None, "the hot text of\na third")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for budget in (1 << 26, 20_000):
        assert found(frame, budget=budget, hashed=lambda content: 7) == brute(rows)
        assert found(frame, budget=budget, hashed=lambda content: len(content) % 3 << 62 | len(content)) == brute(rows)


def test_small_tables(docs, texts):
    assert found(docs, budget=5_000) == brute(list(texts.items()))


def test_query(spark, texts):
    assert sorted(map(tuple, op13_exact_dedup(spark, SF).collect()), key=str) == brute(list(texts.items()))


def test_spill_files(tmp_path):
    rng = random.Random(3)
    words = [rng.randbytes(rng.randrange(200)) for _ in range(3000)]
    hashes = {w: rng.getrandbits(64) for w in words}
    levels = set()

    def records():
        for i, w in enumerate(rng.choices(words, k=20_000)):
            if i % 1000 == 0:
                levels.update(top.count(os.sep) for top, _, files in os.walk(tmp_path) if files)
            yield hashes[w], w, [i]

    got = [(c, n) for _, c, n in grace.grouped(records(), 30_000, str(tmp_path))]
    assert len(got) == len({c for c, _ in got}) and sorted(i for _, n in got for i in n) == list(range(20_000))
    assert len(levels) == 1 and os.listdir(tmp_path) == []


def test_a_content_moves_once_for_each_task(spark):
    frame = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text")).repartition(6)
    parts = grace.parts_of(frame, grace.TABLE_BYTES, lambda content: len(content))
    rows = parts.select("n", F.size("ids").alias("ids")).collect()
    assert len(rows) == 6 and sum(r.n for r in rows) == 30_000 and all(r.n == r.ids for r in rows)

