"""Ranked lexical search for many queries at once, sharing the sums that they have in common.

A document's score for an item is a sum over the item's terms, so a set of terms that several items
share has one partial sum for each document.  Such sets are mined among the items of a block:
terms are put in the order of how many items have them, and whenever two neighbours stand side by
side in more than one item, they become a node of their own, again and again.  What is left of an
item is a short list of nodes.  The nodes are a directed acyclic graph that the items share; for
some documents at a time, every node's accumulators are computed once, from those of its two
children, and every item adds up its list.

Texts are read once: each document gives the terms that any item has, found by a filter of
bounded size and counted (what the filter lets through wrongly is in no item and adds nothing).  Only the
best ``k`` documents of an item leave a task.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import arrow_schema, id_and_text, map_arrow, map_slices, written
from tierwise.llm.decontaminate import word_hashes, words_of
from tierwise.llm.membership import filter_of, passing

#: Different terms of all items of a block together, about: what is broadcast is bounded by it.
BLOCK_TERMS = 200_000
#: Accumulators that a task holds at a time.
CELLS = 4_000_000
#: Tasks' results are merged in so many shares first.
SHARES = 256


@dataclass(frozen=True)
class Sharing:
    """The graph of a block.  Nodes are numbered: first the leaves, then level by level the sums of two
    nodes; ``starts`` has where each item's list begins in ``lists``."""

    keys: list[int]
    leaf_term: np.ndarray
    leaf_times: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    lists: np.ndarray
    starts: np.ndarray

    @property
    def size(self) -> int:
        return len(self.leaf_term) + sum(len(a) for a, _ in self.levels)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """A row for each item, from a row for each term; columns are documents."""
        acc = np.empty((self.size, terms.shape[1]), dtype=np.int64)
        upto = len(self.leaf_term)
        np.multiply(terms[self.leaf_term], self.leaf_times[:, None], out=acc[:upto])
        for a, b in self.levels:
            np.add(acc[a], acc[b], out=acc[upto : upto + len(a)])
            upto += len(a)
        return np.add.reduceat(acc[self.lists], self.starts, axis=0)


def mined(items: list[tuple[int, dict[int, int]]]) -> Sharing:
    """The graph of items given as (key, times by term); items without a term are left out."""
    items = [(key, times) for key, times in items if times]
    having = Counter(leaf for _, times in items for leaf in times.items())
    leaves = sorted(having, key=lambda leaf: (-having[leaf], leaf))
    number = {leaf: i for i, leaf in enumerate(leaves)}
    left = [sorted(number[leaf] for leaf in times.items()) for _, times in items]
    levels, upto = [], len(leaves)
    while True:
        beside = Counter(pair for nodes in left for pair in zip(nodes, nodes[1:], strict=False))
        shared = {pair: upto + i for i, pair in enumerate(p for p, n in beside.items() if n > 1)}
        if not shared:
            break
        levels.append((np.array([a for a, _ in shared]), np.array([b for _, b in shared])))
        upto += len(shared)
        left = [list(joined(nodes, shared)) for nodes in left]
    return Sharing(
        [key for key, _ in items],
        np.array([term for term, _ in leaves], dtype=np.int64),
        np.array([n for _, n in leaves], dtype=np.int64),
        levels,
        np.array([node for nodes in left for node in nodes], dtype=np.int64),
        np.cumsum([0] + [len(nodes) for nodes in left[:-1]]),
    )


def joined(nodes: list[int], shared: dict[tuple[int, int], int]) -> Iterator[int]:
    i = 0
    while i < len(nodes):
        node = shared.get(tuple(nodes[i : i + 2]))
        yield nodes[i] if node is None else node
        i += 1 if node is None else 2


def query_terms(items: DataFrame) -> DataFrame:
    """(key, item_id, terms, times, hashes) of each row of ``items``; the key is the row's own number."""
    schema = "key long, item_id long, terms array<string>, times array<int>, hashes array<long>"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for item_id, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                times = Counter(words_of(text))
                hashes = word_hashes(list(times)).view(np.int64).tolist()
                rows.append((key, item_id, [t.decode("utf-8", "replace") for t in times], list(times.values()), hashes))
                key += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow, strict=True)], schema=arrow)

    return map_arrow(id_and_text(items, "item_id").withColumn("text", F.col("text").cast("binary")), run, schema)


def occurrences(docs: DataFrame, cells) -> DataFrame:
    """(doc_id, n, terms, tf) of each row: all its words' number, and how often it has terms of the items."""

    def work():
        kept = cells.value

        def handle(part: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"doc_id": part["doc_id"], "n": [], "terms": [], "tf": []}
            for text in part["text"]:
                words = words_of(text)
                found = Counter(words)
                unique = list(found)
                terms = [unique[i] for i in passing(kept, word_hashes(unique)).tolist()]
                out["n"].append(len(words))
                out["terms"].append([t.decode("utf-8", "replace") for t in terms])
                out["tf"].append([found[t] for t in terms])
            return out

        return handle

    rows = id_and_text(docs).withColumn("text", F.col("text").cast("binary"))
    return map_slices(rows, work, "doc_id long, n long, terms array<string>, tf array<long>")


def blocks_of(queries: DataFrame, weights: DataFrame, block_terms: int) -> DataFrame:
    """(block, vocabulary, weights, graph): the items are dealt into blocks of about ``block_terms`` terms."""
    total = queries.select(F.sum(F.size("terms"))).first()[0] or 0
    block = F.pmod(F.xxhash64("key"), F.lit(1 + total // block_terms)).cast("int")
    each = queries.select(block.alias("block"), "key", F.explode(F.arrays_zip("terms", "times")).alias("t"))
    each = each.select("block", "key", F.col("t.terms").alias("term"), F.col("t.times").alias("times")).join(weights, "term")

    def mine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "term"])
        codes, vocabulary = pd.factorize(rows["term"], sort=True)
        by_term = np.zeros(len(vocabulary), dtype=np.int64)
        by_term[codes] = rows["weight"].to_numpy()
        items: dict[int, dict[int, int]] = {}
        for key, term, times in zip(rows["key"].tolist(), codes.tolist(), rows["times"].tolist(), strict=True):
            items.setdefault(key, {})[term] = times
        packed = pickle.dumps((list(vocabulary), by_term, mined(sorted(items.items()))))
        return pd.DataFrame({"block": [rows["block"].iloc[0]], "packed": [packed]})

    return each.groupBy("block").applyInPandas(mine, "block int, packed binary")


class Best:
    """The ``k`` best documents of each item so far."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.least = np.ones(n_items, dtype=np.int64)
        self.held = np.empty((4, 0), dtype=np.int64)  # item, minus the score, no id, id

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.held = np.hstack([self.held, np.stack([item, -scores[item, doc], no_id[doc], ids[doc]])])
        if self.held.shape[1] > 4 * self.k * len(self.least):
            self.prune()

    def prune(self) -> None:
        held = self.held[:, np.lexsort(self.held[::-1])]
        rank = np.arange(held.shape[1]) - np.searchsorted(held[0], held[0])
        self.held = held[:, rank < self.k]
        last = held[:, rank == self.k - 1]
        self.least[last[0]] = -last[1]  # an equal score may still have a smaller id


def best_of_tasks(found: DataFrame, cells_of_block, n_docs: int, n_words: int, k: int) -> DataFrame:
    """(key, task, doc_id, score): the best ``k`` documents of each item of one block in each task."""
    schema = "key long, task int, doc_id long, score long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights, graph = pickle.loads(cells_of_block.value)  # noqa: S301  (made above)
        place = {term: i for i, term in enumerate(vocabulary)}
        width = max(16, CELLS // (graph.size + len(graph.lists) + len(place)))
        best = Best(len(graph.keys), k)
        for batch in batches:
            for start in range(0, batch.num_rows, width):
                part = batch.slice(start, width)
                ids = part.column(0)
                n = part.column(1).to_numpy(zero_copy_only=False)
                terms, tfs = part.column(2), part.column(3)
                doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                at = np.fromiter((place.get(t, -1) for t in terms.flatten().to_pylist()), dtype=np.int64, count=len(doc))
                tf = tfs.flatten().to_numpy(zero_copy_only=False)[at >= 0]
                doc, at = doc[at >= 0], at[at >= 0]
                m = 100 - 75 + 75 * n * n_docs // n_words
                by_term = np.zeros((len(place), part.num_rows), dtype=np.int64)
                by_term[at, doc] = weights[at] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                best.add(graph.scores(by_term), no_id, ids.fill_null(0).to_numpy())
        best.prune()
        item, score, no_id, ids = best.held
        keys = np.array(graph.keys, dtype=np.int64)[item]
        task = np.full(len(item), TaskContext.get().partitionId(), dtype=np.int32)
        doc_id = pa.array(ids, mask=no_id.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(task), doc_id, pa.array(-score)], schema=arrow)

    return map_arrow(found.filter("size(terms) > 0"), run, schema)


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best rows of ``docs`` for each row of ``items``.

    Terms are runs of ASCII digits and letters and of all code points from U+0080 on, A-Z in lower case.
    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))), and a row scores the sum of weight times
    10^9 tf div (1000 tf + 8 m) over the item's terms, repeats included, where m is 25 + 75 n N div L.
    Only scores above 0 count; equal ones are in the order of doc_id, rows without one last, and
    repeated rows are ranked each.  Null texts have no terms; an item without a term that any row has
    gives no row.  Other columns are not read.
    """
    spark = docs.sparkSession
    queries = written(query_terms(items), "queries")
    cells = spark.sparkContext.broadcast(filter_of(queries.select(F.explode("hashes").alias("hash"))))
    found = written(occurrences(docs, cells), "occurrences")
    n_docs, n_words = found.select(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)))
    blocks = written(blocks_of(queries, df.select("term", weight.alias("weight")), block_terms), "blocks")
    best = None
    for (block,) in blocks.select("block").orderBy("block").collect():
        packed = spark.sparkContext.broadcast(blocks.filter(F.col("block") == block).first()["packed"])
        part = best_of_tasks(found, packed, n_docs, n_words, k)
        best = part if best is None else best.unionByName(part)
    if best is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    share = F.pmod("task", F.lit(SHARES))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("key", share).orderBy(*order))).filter(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(queries.select("key", "item_id"), "key").select("item_id", "rank", "doc_id", "score")
