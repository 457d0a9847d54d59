"""Quality by importance resampling.

Two generative models of hashed word unigrams and bigrams, one of the target text (documents
labelled good) and one of all raw text, give every document an importance weight: the logarithm
of their ratio, per n-gram.  A sample without replacement in proportion to the (tempered) weights
is drawn by the Gumbel top-k rule: the k documents with the largest sum of weight and Gumbel noise.

The n-grams of all documents are counted.  At most ``MAX_LABELLED`` labelled rows are used, those
with the smallest hashes of their ids: one half gives the target's n-grams, the other half, which had
no part in the model, says how many documents to keep, unless a size is given: as many as reach the
weight halfway between the one that ``KEEP_GOOD`` of its good documents reach and the one that
``BELOW_BAD`` of its bad ones do not.  Noise depends on ``doc_id`` and the seed only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tierwise.llm.common import SLICE_ROWS, arrow_schema, free_name, id_and_text, map_arrow, written

#: Buckets that n-grams are hashed into, and the count that every bucket has beforehand.
BUCKETS, PRIOR = 1 << 16, 1.0
#: N-grams of weight zero that every document has besides its own, so that few say little.
SHRINK = 30
#: Labelled rows that are used, at most.
MAX_LABELLED = 100_000
#: Shares of good and of bad labelled documents above and below the two weights that set the size.
KEEP_GOOD, BELOW_BAD = 0.995, 0.9
#: Weights are divided by it before noise is added.
TEMPERATURE = 0.01
#: Parts of a range in the search of the k-th largest key, and keys that are looked at one by one.
PARTS, FEW = 512, 2000

WORD = re.compile(r"\w+|[^\w\s]+")


def ngrams(text: str) -> np.ndarray:
    """The buckets of a text's words and word pairs."""
    words = WORD.findall(text.lower())
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two *= np.uint64(0xBF58476D1CE4E5B9)
    return (np.concatenate([one, two]) >> np.uint64(48)).astype(np.int64) % BUCKETS


@dataclass(frozen=True)
class Ratio:
    """The logarithm of target to raw frequency, by bucket."""

    weights: np.ndarray

    def of(self, text: str) -> tuple[int, float]:
        buckets = ngrams(text)
        return len(buckets), float(self.weights[buckets].sum(dtype=np.float64) / (len(buckets) + SHRINK))


def labelled(labels: DataFrame, good: Column, bad: Column, limit: int, half: int) -> DataFrame:
    """(doc_id, good, bad) of one half of at most ``limit`` labelled documents."""
    rows = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    sides = rows.agg(F.coalesce(F.max(good), F.lit(False)).alias("good"), F.coalesce(F.max(bad), F.lit(False)).alias("bad"))
    chosen = sides.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return chosen.filter(F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == half)


def bucket_counts(rows: DataFrame, target_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket is in all rows and in the target's: a task sums its own first."""
    ids = rows.sparkSession.sparkContext.broadcast(target_ids)
    schema = "bucket int, raw long, target long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), set(ids.value.tolist())
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS).to_pydict()
                for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                    buckets = ngrams(text)
                    np.add.at(raw, buckets, 1)
                    if doc_id in wanted:
                        np.add.at(target, buckets, 1)
        found = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": found, "raw": raw[found], "target": target[found]}, schema=arrow)

    sums = map_arrow(rows, run, schema).groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, m in sums.collect():  # BUCKETS rows at most
        raw[bucket], target[bucket] = n, m
    return raw, target


def fit(docs: DataFrame, sample: DataFrame) -> Ratio:
    """The ratio of the text of ``sample``'s good documents to all text; all zero if there is none."""
    ids = np.array([r[0] for r in sample.filter("good").select("doc_id").collect()], dtype=np.int64)
    raw, target = bucket_counts(id_and_text(docs), ids)
    if not target.sum():
        return Ratio(np.zeros(BUCKETS))
    return Ratio(np.log((target + PRIOR) / (target + PRIOR).sum()) - np.log((raw + PRIOR) / (raw + PRIOR).sum()))


def with_weight(docs: DataFrame, model: Ratio, name: str, text_col: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` and the log importance weight of each row's whole text (0 for an empty or null one),
    and, if named, its number of n-grams."""
    at = docs.columns.index(text_col)
    ratio = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                found = [ratio.value.of(t or "") for t in part.column(at).to_pylist()]
                columns, names = list(part.columns), list(part.schema.names)
                columns.append(pa.array([w for _, w in found], type=pa.float64()))
                if count:
                    columns.append(pa.array([n for n, _ in found], type=pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=names + [name] + ([count] if count else []))

    added = [StructField(name, DoubleType())] + ([StructField(count, LongType())] if count else [])
    return map_arrow(docs, run, StructType([*docs.schema.fields, *added]))


def gumbel_key(weight: str, seed: int, temperature: float, id_col: str = "doc_id") -> Column:
    """Weight over temperature, plus Gumbel noise of the row's id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("long"), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    return F.col(weight) / F.lit(temperature) - F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, k: int) -> float:
    """The ``k``-th largest of a double column ``key``, by counting in ever smaller ranges."""
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if n == 0 or k >= n:
        return -np.inf
    if k <= 0:
        return np.inf
    while True:
        inside = keys.filter(F.col("key").between(low, high))
        if low == high:
            return low
        if n <= FEW:
            return sorted((r[0] for r in inside.select("key").collect()), reverse=True)[k - 1]
        part = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit((high - low) / PARTS)), F.lit(PARTS - 1))
        counts = inside.groupBy(part.alias("part")).agg(F.count("*"), F.min("key"), F.max("key")).collect()
        for _, n, low, high in sorted(counts, reverse=True):
            if k <= n:
                break
            k -= n


@dataclass(frozen=True)
class Sample:
    """A fitted model, and the key that a row of the sample has at least."""

    model: Ratio
    least_key: float
    seed: int
    temperature: float

    def keeps(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are in the sample, with their columns as they are."""
        weight = free_name(docs, "log_weight")
        key = gumbel_key(weight, self.seed, self.temperature)
        return with_weight(docs, self.model, weight).filter(key >= F.lit(self.least_key)).drop(weight)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    bad: Column,
    size: int | None = None,
    seed: int = 7,
    temperature: float = TEMPERATURE,
    limit: int = MAX_LABELLED,
) -> tuple[DataFrame, Sample]:
    """Weights and decisions of all rows, and the sample that was drawn.

    ``docs`` have doc_id and text, ``labels`` doc_id and what ``good`` and ``bad`` read; a document
    labelled more than once is what any of its labels says.  Gives doc_id, n_grams, log_weight, key and
    selected.  Rows whose keys are equal to the last one's are all in the sample (equal ids with
    equal texts, that is).  Without a good label every weight is 0 and, without ``size``, all rows are
    kept.  Null texts are empty ones; rows without an id share one noise.
    """
    model = fit(docs, labelled(labels, good, bad, limit, 0))
    scored = with_weight(id_and_text(docs), model, "log_weight", count="n_grams").select("doc_id", "n_grams", "log_weight")
    scored = written(scored.withColumn("key", gumbel_key("log_weight", seed, temperature)), "weights")
    if size is None:
        judged = scored.join(F.broadcast(labelled(labels, good, bad, limit, 1)), "doc_id")  # at most ``limit`` rows
        low_good = F.percentile_approx(F.when(F.col("good"), F.col("log_weight")), 1 - KEEP_GOOD, 10_000)
        high_bad = F.percentile_approx(F.when(F.col("bad"), F.col("log_weight")), BELOW_BAD, 10_000)
        reached, ruled_out = judged.agg(low_good, high_bad).first()
        if reached is None:
            reached = -np.inf
        elif ruled_out is not None and ruled_out < reached:
            reached = (reached + ruled_out) / 2
        size = scored.filter(F.col("log_weight") >= F.lit(reached)).count()
    sample = Sample(model, kth_largest(scored, size), seed, temperature)
    return scored.withColumn("selected", F.col("key") >= F.lit(sample.least_key)), sample
