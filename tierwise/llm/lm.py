"""Documents scored by masked pseudo-likelihood.

A small network sees the two words before and after a place and predicts the word at the place
from both sides; a document's score is the sum of its words' conditional log-probabilities.

* Words: the most frequent ones of the whole corpus by their counts, all others by hashed groups.
  Inside its group a word has the probability of its share of the group's words in the corpus (the
  tail of an adaptive softmax), so that every word of the corpus is predicted, not only its group.
  The counts stay a table: the documents' grouped words are joined to it.
* Network: an embedding for each word and side, summed; tanh; a softmax over classes of words, and
  one over the words of the class.
* Training: each task goes once over all words of its rows, in numpy and from the same start, by
  Adagrad; the corpus's network is the mean of the tasks' networks, weighted by their words.  Each
  task sends out its parameters, so that what is gathered grows with the corpus while the network
  that is sent back does not.

The tasks' shares depend on how the input is split, so scores are the same for the same files and
split size, whatever executors are lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import SLICE_ROWS, arrow_schema, id_and_text, map_arrow, written
from tierwise.llm.decontaminate import word_hashes, words_of

#: Classes, words of a class, and width of the network.
CLASSES, IN_CLASS, HIDDEN = 24, 24, 12
WORDS = CLASSES * IN_CLASS
#: Words with an id of their own; the other ids are groups of words.
FREQUENT = WORDS - 4 * IN_CLASS
SIDES = (-2, -1, 1, 2)
#: Words of a training step, its rate, and the seed of the start.
STEP, RATE, SEED = 16384, 0.1, 5
#: Different words that a task counts or remembers before it empties its memory.
REMEMBERED = 300_000


class WordIds:
    """Ids of words by their hashes: the given ones have one each, all others hashed groups."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.hashes = np.append(frequent[self.order], np.uint64(2**64 - 1))
        self.first_group = len(frequent)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One sequence of all texts' ids with two ends after each text, the places of the words in it,
        and the text that each is of."""
        return self.with_hashes(texts)[:3]

    def with_hashes(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What ``of`` gives, and the words' hashes."""
        parts = [word_hashes(words_of(t)) for t in texts]
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        hashes = np.concatenate([np.empty(0, np.uint64), *parts])
        at = np.searchsorted(self.hashes, hashes)
        known = (self.hashes[at] == hashes) & (at < self.first_group)
        groups = self.first_group + (hashes % np.uint64(WORDS - self.first_group)).astype(np.int64)
        ids = groups if not self.first_group else np.where(known, self.order[np.minimum(at, self.first_group - 1)], groups)
        of_text = np.repeat(np.arange(len(texts)), lengths)
        places = np.arange(len(of_text)) + 2 + 2 * of_text
        line = np.full(len(ids) + 2 * len(texts) + 2, WORDS, dtype=np.int64)
        line[places] = ids
        return line, places, of_text, hashes


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, where = np.unique(hashes, return_inverse=True)
    return different, np.bincount(where, counts, len(different)).astype(np.int64)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of the words' hashes over all rows; a task sums its own first."""
    schema = "word long, n long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                texts = batch.column("text").slice(start, SLICE_ROWS).to_pylist()
                new, n = np.unique(np.concatenate([word_hashes(words_of(t)) for t in texts]), return_counts=True)
                hashes, counts = summed(np.concatenate([hashes, new]), np.concatenate([counts, n]))
                if len(hashes) > REMEMBERED:
                    yield pa.RecordBatch.from_pydict({"word": hashes.view(np.int64), "n": counts}, schema=arrow)
                    hashes, counts = hashes[:0], counts[:0]
        yield pa.RecordBatch.from_pydict({"word": hashes.view(np.int64), "n": counts}, schema=arrow)

    return map_arrow(rows.select("text"), run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def start(seed: int = SEED) -> list[np.ndarray]:
    """The parameters before training."""
    rng = np.random.default_rng(seed)
    shapes = [(len(SIDES), WORDS + 1, HIDDEN), (HIDDEN,), (HIDDEN, CLASSES), (CLASSES,), (CLASSES, HIDDEN, IN_CLASS), (CLASSES, IN_CLASS)]
    return [rng.normal(0, 0.1, s).astype(np.float32) if len(s) > 1 else np.zeros(s, np.float32) for s in shapes]


def softmax(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log-probability of each row's chosen column; ``logits`` become probabilities."""
    logits -= logits.max(axis=1, keepdims=True)
    every = np.arange(len(logits))
    found = logits[every, chosen]
    np.exp(logits, out=logits)
    total = logits.sum(axis=1, keepdims=True)
    logits /= total
    return found - np.log(total[:, 0])


def run_step(
    parameters: list[np.ndarray], line: np.ndarray, places: np.ndarray, gradients: bool
) -> tuple[np.ndarray, list[np.ndarray] | None]:
    """The log-probability of the word at each place and, if wanted, the mean gradient of their sum.

    ``places`` are in the order of their words' classes, so that a class's words are one product.
    """
    embedding, shift, to_class, class_shift, to_word, word_shift = parameters
    word = line[places]
    cls, inner = word // IN_CLASS, word % IN_CLASS
    around = [line[places + side] for side in SIDES]
    hidden = embedding[0][around[0]]
    for side in range(1, len(SIDES)):
        hidden += embedding[side][around[side]]
    hidden += shift
    np.tanh(hidden, out=hidden)
    at_class = hidden @ to_class
    at_class += class_shift
    score = softmax(at_class, cls).astype(np.float64)
    bounds = np.searchsorted(cls, np.arange(CLASSES + 1))
    at_words = []
    for c in range(CLASSES):
        own = slice(bounds[c], bounds[c + 1])
        at_words.append(hidden[own] @ to_word[c] + word_shift[c])
        score[own] += softmax(at_words[c], inner[own])
    if not gradients:
        return score, None
    every = np.arange(len(places))
    at_class[every, cls] -= 1
    back = at_class @ to_class.T
    word_grad, word_shift_grad = np.zeros_like(to_word), np.zeros_like(word_shift)
    for c, at_word in enumerate(at_words):
        own = slice(bounds[c], bounds[c + 1])
        at_word[every[: len(at_word)], inner[own]] -= 1
        word_grad[c], word_shift_grad[c] = hidden[own].T @ at_word, at_word.sum(axis=0)
        back[own] += at_word @ to_word[c].T
    grads = [hidden.T @ at_class, at_class.sum(axis=0), word_grad, word_shift_grad]
    hidden *= hidden
    back *= 1 - hidden
    embedding_grad = np.zeros_like(embedding)
    for side, words in enumerate(around):
        order = np.argsort(words.astype(np.int16), kind="stable")
        words = words[order]
        firsts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        embedding_grad[side][words[firsts]] = np.add.reduceat(back[order], firsts, axis=0)
    grads = [embedding_grad, back.sum(axis=0), *grads]
    for g in grads:
        g *= -1 / len(places)
    return score, grads


def in_steps(line: np.ndarray, places: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of places, by step, in the order of their words."""
    for first in range(0, len(places), STEP):
        part = np.arange(first, min(first + STEP, len(places)))
        yield part[np.argsort(line[places[part]], kind="stable")]


class Training:
    """Adagrad from the common start."""

    def __init__(self) -> None:
        self.parameters = start()
        self.squares = [np.full_like(p, 1e-8) for p in self.parameters]
        self.words = 0

    def learn(self, line: np.ndarray, places: np.ndarray) -> None:
        for part in in_steps(line, places):
            _, grads = run_step(self.parameters, line, places[part], gradients=True)
            for p, s, g in zip(self.parameters, self.squares, grads, strict=True):
                s += g * g
                g /= np.sqrt(s)
                g *= RATE
                p += g
            self.words += len(part)


def train(rows: DataFrame, frequent: np.ndarray) -> list[np.ndarray]:
    """The mean of the tasks' networks, weighted by their words; the start, if there are no words."""
    schema = "at int, sum double, words long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, training = WordIds(frequent), Training()
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                line, places, _ = ids.of(batch.column("text").slice(first, SLICE_ROWS).to_pylist())
                training.learn(line, places)
        if training.words:
            flat = np.concatenate([p.ravel() for p in training.parameters]).astype(np.float64)
            columns = {"at": np.arange(len(flat)), "sum": flat * training.words, "words": np.full(len(flat), training.words)}
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)

    parts = map_arrow(rows.select("text"), run, schema)
    means = parts.groupBy("at").agg((F.sum("sum") / F.sum("words")).alias("mean"))
    made = start()
    flat = np.concatenate([p.ravel() for p in made])
    for at, mean in means.collect():  # as many as the network has parameters
        flat[at] = mean
    cuts = np.cumsum([p.size for p in made])[:-1]
    return [part.reshape(p.shape) for part, p in zip(np.split(flat, cuts), made, strict=True)]


def shares(counts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(word, log_share) of each word without an id of its own: its part of its group's words in ``counts``."""
    groups = WORDS - len(frequent)
    rare = counts.filter(~F.col("word").isin(frequent.view(np.int64).tolist()))
    # the group that WordIds gives, of hashes as signed numbers
    rare = rare.withColumn("group", F.expr(f"pmod(pmod(word, {groups}) + if(word < 0, {2**64 % groups}, 0), {groups})"))
    totals = rare.groupBy("group").agg(F.sum("n").alias("total"))  # a row for each group
    return rare.join(F.broadcast(totals), "group").select("word", F.log(F.col("n") / F.col("total")).alias("log_share"))


SCORED = "key long, word long, times int, doc_id long, n_words long, own double"


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_likelihood, per_word, token_log_likelihood, per_token) of each row under a
    network trained on all rows.

    ``log_likelihood`` is the network's alone, of words and groups; ``token_log_likelihood`` is that of
    every word itself, with grouped words' shares of their groups.

    Words are what A-Z in lower case, digits and letters beyond ASCII form.  A text without words, a
    null one too, has the sums 0 and no means.  Repeated rows give repeated rows, and count in training
    as often; other columns are not read.
    """
    rows = id_and_text(docs).withColumn("text", F.col("text").cast("binary"))
    counts = written(word_counts(rows), "word-counts")
    most = counts.orderBy(F.desc("n"), "word").limit(FREQUENT)
    frequent = np.array([r[0] for r in most.select("word").collect()], dtype=np.int64).view(np.uint64)
    model = docs.sparkSession.sparkContext.broadcast((frequent, train(rows, frequent)))
    arrow = arrow_schema(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A record for each row, and one for each different grouped word in it; they share the row's key."""
        from pyspark import TaskContext

        frequent, parameters = model.value
        ids, key = WordIds(frequent), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                line, places, of_text, hashes = ids.with_hashes(part.column("text").to_pylist())
                n = part.num_rows
                sums = np.zeros(n)
                for step in in_steps(line, places):
                    found, _ = run_step(parameters, line, places[step], gradients=False)
                    sums += np.bincount(of_text[step], found, n)
                grouped = line[places] >= ids.first_group
                of_text_grouped, hashes = of_text[grouped], hashes[grouped]
                order = np.lexsort((hashes, of_text_grouped))
                of_text_grouped, hashes = of_text_grouped[order], hashes[order]
                new = np.ones(len(hashes), dtype=bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (of_text_grouped[1:] != of_text_grouped[:-1])
                at = np.flatnonzero(new)
                keys = key + np.arange(n)
                key += n
                # a row's own record has no word and is counted 0 times; any number deals it out
                dealt = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                absent = len(at)
                columns = [
                    pa.array(np.concatenate([keys, keys[of_text_grouped[at]]])),
                    pa.array(np.concatenate([dealt, hashes[at].view(np.int64)])),
                    pa.array(np.concatenate([np.zeros(n, np.int32), np.diff(np.append(at, len(hashes))).astype(np.int32)])),
                    pa.concat_arrays([pa.array(part.column("doc_id").to_pylist(), pa.int64()), pa.nulls(absent, pa.int64())]),
                    pa.concat_arrays([pa.array(np.bincount(of_text, minlength=n)), pa.nulls(absent, pa.int64())]),
                    pa.concat_arrays([pa.array(sums), pa.nulls(absent, pa.float64())]),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    # the records are dealt out by their words, many more than the counted ones, which are not sorted against them
    joined = map_arrow(rows, run, SCORED).join(shares(counts, frequent).hint("shuffle_hash"), "word", "left")
    inside = F.sum(F.when(F.col("times") > 0, F.col("times") * F.col("log_share")))
    each = joined.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum("own").alias("log_likelihood"),
        F.coalesce(inside, F.lit(0.0)).alias("inside"),
    )
    each = each.withColumn("token_log_likelihood", F.col("log_likelihood") + F.col("inside"))

    def mean(of: str):
        return F.when(F.col("n_words") > 0, F.col(of) / F.col("n_words"))

    return each.select("doc_id", "n_words", "log_likelihood", mean("log_likelihood").alias("per_word"),
                       "token_log_likelihood", mean("token_log_likelihood").alias("per_token"))
