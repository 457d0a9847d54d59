import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from llm_rows import TEXTS
from pyspark.sql import functions as F

from tierwise.llm import quality
from tierwise.llm.queries import good_and_bad, op7_quality


def test_kth_largest(spark):
    rng = random.Random(3)
    keys = [rng.gauss(0, 1) ** 3 for _ in range(6000)] + [0.5] * 3000 + [1e9, -1e9]
    frame = spark.createDataFrame([(k,) for k in keys], "key double")
    ordered = sorted(keys, reverse=True)
    for k in (1, 2, 700, 2000, 4000, 8999, 9001):
        assert quality.kth_largest(frame, k) == ordered[k - 1]
    assert quality.kth_largest(frame, len(keys)) == -np.inf
    assert quality.kth_largest(frame, 0) == np.inf
    assert quality.kth_largest(frame.limit(0), 5) == -np.inf


def test_counts_and_weights_against_brute_force(spark, docs, texts):
    wanted = np.array(sorted(texts)[::3], dtype=np.int64)
    raw, target = quality.bucket_counts(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), wanted)
    expected = [np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)]
    for i, text in texts.items():
        words = quality.WORD.findall(text.lower())
        assert len(quality.ngrams(text)) == max(0, 2 * len(words) - 1)
        for bucket in quality.ngrams(text):
            expected[0][bucket] += 1
            expected[1][bucket] += i in set(wanted)
    assert (raw == expected[0]).all() and (target == expected[1]).all()


@pytest.fixture(scope="module")
def held_out(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found, sample = quality.resample(spark.read.parquet(f"{folder}/documents.parquet"), labels.filter("doc_id % 2 = 0"), **good_and_bad())
    return found.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect(), found, sample


def test_held_out_accuracy(held_out):
    rows, _, _ = held_out
    good = [r.selected for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.selected for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_sample_has_its_size(spark, docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    found, sample = quality.resample(docs, labels, **good_and_bad(), size=50)
    rows = found.collect()
    keys = sorted((r.key for r in rows), reverse=True)
    assert [r.selected for r in rows] == [r.key >= keys[49] for r in rows]
    kept = sample.keeps(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.selected}


def test_noise_is_gumbel(spark):
    noise = spark.range(20_000).select(F.lit(0.0).alias("w"), F.col("id").alias("doc_id"))
    values = [r[0] for r in noise.select(quality.gumbel_key("w", 7, 1.0)).collect()]
    assert abs(np.mean(values) - np.euler_gamma) < 0.03 and abs(np.var(values) - np.pi**2 / 6) < 0.06


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, None, None), (None, 1, 0), (5, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    found, sample = quality.resample(odd_docs, labels, **good_and_bad())
    assert sorted(str(r.doc_id) for r in found.collect()) == sorted(str(i) for i, _ in TEXTS)
    assert sample.keeps(odd_docs).columns == odd_docs.columns
    found, sample = quality.resample(odd_docs, labels.limit(0), **good_and_bad())
    assert all(r.selected and r.log_weight == 0 for r in found.collect())
    assert sample.keeps(odd_docs).count() == len(TEXTS)
    found, sample = quality.resample(no_docs, labels, **good_and_bad())
    assert found.count() == 0 and sample.keeps(no_docs).count() == 0


def test_query(spark, docs):
    assert op7_quality(spark, "/root/testdata/sf0.001").count() == docs.count()


M64 = (1 << 64) - 1


def plain_buckets(text):
    words = re.findall(r"\w+|[^\w\s]+", text.lower())
    one = [xxhash.xxh64_intdigest(w) for w in words]
    two = [((a * 0x9E3779B97F4A7C15 + b) * 0xBF58476D1CE4E5B9) & M64 for a, b in zip(one, one[1:], strict=False)]
    return [h >> 48 for h in one + two]


def engine_hash(value, *more):
    """The engine's hash of a long, then of ints or texts, unsigned."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", value), 42)
    for m in more:
        h = xxhash.xxh64_intdigest(m.encode() if isinstance(m, str) else struct.pack("<i", m), h)
    return h


def nearest_rank(values, share):
    return sorted(values)[max(0, math.ceil(share * len(values)) - 1)]


def test_whole_result_against_a_plain_version(spark):
    """Weights, noise, the size from the labels that had no part in the model, and what is selected."""
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    good, bad = set(), set()
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if r.quality == 1 and r.toxic == 0:
            good.add(r.doc_id)
        if r.quality == 0:
            bad.add(r.doc_id)
    buckets = {i: plain_buckets(t) for i, t in texts.items()}
    raw, target = np.ones(1 << 16), np.ones(1 << 16)
    for i, own in buckets.items():
        np.add.at(raw, own, 1)
        if i in good and engine_hash(i, "half") % 2 == 0:
            np.add.at(target, own, 1)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    weight = {i: ratio[own].sum() / (len(own) + 30) for i, own in buckets.items()}
    judged = [i for i in good | bad if i in texts and engine_hash(i, "half") % 2 == 1]
    reached = nearest_rank([weight[i] for i in judged if i in good], 0.005)
    ruled_out = nearest_rank([weight[i] for i in judged if i in bad], 0.9)
    if ruled_out < reached:
        reached = (reached + ruled_out) / 2
    size = sum(w >= reached for w in weight.values())
    uniform = {i: ((engine_hash(i, 7) >> 11) + 0.5) / 2**53 for i in texts}
    key = {i: weight[i] / 0.01 - math.log(-math.log(uniform[i])) for i in texts}
    chosen = set(sorted(texts, key=lambda i: -key[i])[:size])
    rows = op7_quality(spark, folder).collect()
    assert len(rows) == len(texts) and 0 < size < len(texts)
    for r in rows:
        assert r.n_grams == len(buckets[r.doc_id])
        assert r.log_weight == pytest.approx(weight[r.doc_id], abs=1e-9) and r.key == pytest.approx(key[r.doc_id], abs=1e-6)
    assert {r.doc_id for r in rows if r.selected} == chosen
