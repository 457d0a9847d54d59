"""Benchmark windows inside documents, by a set join on necessary prefix shingles.

A window of an item is the set of its word shingles.  All of them must be in a document that
contains the window, so its rarest shingle is a sufficient prefix to join on: shingles are ordered
by their number in all documents, and a window whose rarest one is in no document is dropped.
Documents send out those of their shingles only that are somebody's prefix, with the words
around; length and position bounds and then the exact words decide.

What a document's shingles are tested against first is a filter of bounded size (``membership``);
what it lets through wrongly the join sorts out.  To find windows, documents are read twice and not
moved; to leave documents out, they are read twice more, and those to be left out are moved.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import id_and_text, map_slices, row_key, written
from tierwise.llm.membership import filter_of, passing, without_keys

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
#: A-Z in lower case; bytes that are no digit, letter or part of a longer code point separate.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` words in a row, from the words' hashes."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    size = len(hashes) - n + 1
    mixed = hashes[:size].copy()
    for i in range(1, n):
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed += hashes[i : i + size]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, win, n, shingles): each item's windows, or its one shorter one."""

    def handle(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"item_id": [], "win": [], "n": [], "shingles": []}
        for item, text in zip(rows["doc_id"], rows["text"], strict=True):
            words = words_of(text)
            n = min(window, len(words))
            hashes = shingle_hashes(word_hashes(words), min(shingle, n)).view(np.int64).tolist()
            for start in range(len(words) - n + 1 if n else 0):
                out["item_id"].append(item)
                out["win"].append(b" ".join(words[start : start + n]).decode("utf-8", "replace"))
                out["n"].append(n)
                out["shingles"].append(hashes[start : start + max(1, n - shingle + 1)])
        return out

    return map_slices(items, lambda: handle, "item_id long, win string, n int, shingles array<long>")


def shingle_counts(rows: DataFrame, cells, sizes: list[int]) -> DataFrame:
    """(shingle, n_found) over all documents, of shingles that the filter lets through."""

    def work():
        kept = cells.value

        def handle(part: dict[str, list]) -> dict[str, list]:
            found = [np.empty(0, dtype=np.uint64)]
            for text in part["text"]:
                hashes = word_hashes(words_of(text))
                for n in sizes:
                    shingles = shingle_hashes(hashes, n)
                    found.append(shingles[passing(kept, shingles)])
            shingle, count = np.unique(np.concatenate(found), return_counts=True)
            return {"shingle": shingle.view(np.int64).tolist(), "n": count.tolist()}

        return handle

    return map_slices(rows, work, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n_found"))


def candidates(rows: DataFrame, cells, sizes: list[int], window: int) -> DataFrame:
    """(row_key, doc_id, n_words, found): the prefix shingles of each document, with their place and
    the words that a window around them can have."""
    found = "array<struct<shingle: long, at: int, start: int, around: string>>"

    def work():
        kept = cells.value

        def handle(part: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {"row_key": part["row_key"], "doc_id": part["doc_id"], "n_words": [], "found": []}
            for text in part["text"]:
                words = words_of(text)
                hashes, near = word_hashes(words), []
                for n in sizes:
                    shingles = shingle_hashes(hashes, n)
                    for at in passing(kept, shingles).tolist():
                        start = max(0, at - window + n)
                        around = b" ".join(words[start : at + window]).decode("utf-8", "replace")
                        near.append({"shingle": int(shingles[at].view(np.int64)), "at": at, "start": start, "around": around})
                out["n_words"].append(len(words))
                out["found"].append(near)
            return out

        return handle

    return map_slices(rows, work, f"row_key string, doc_id long, n_words long, found {found}")


def search(docs: DataFrame, items: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' (row_key, doc_id, n_words), the items' (item_id, win) and the occurrences of
    windows in documents (row_key, start, end, win)."""
    spark = docs.sparkSession
    rows = id_and_text(docs).select("doc_id", row_key().alias("row_key"), F.col("text").cast("binary").alias("text"))
    given = id_and_text(items, "item_id").withColumn("text", F.col("text").cast("binary"))
    windows = written(item_windows(given, window, shingle), "windows")
    unique = written(windows.groupBy("win", "n").agg(F.first("shingles").alias("shingles")), "windows")
    sizes = sorted(r[0] for r in unique.select(F.least("n", F.lit(shingle))).distinct().collect())

    cells = spark.sparkContext.broadcast(filter_of(unique.select(F.explode("shingles").alias("shingle"))))
    counts = written(shingle_counts(rows.select("text"), cells, sizes), "shingles")
    each = unique.select("win", "n", F.posexplode("shingles").alias("offset", "shingle"))
    # a window with a shingle that no document has cannot occur
    rarest = F.min(F.struct(F.coalesce("n_found", F.lit(0)).alias("n_found"), "shingle", "offset")).alias("rarest")
    prefixes = each.join(counts, "shingle", "left").groupBy("win", "n").agg(rarest).filter("rarest.n_found > 0")
    prefixes = written(prefixes.select("win", "n", "rarest.shingle", "rarest.offset"), "prefixes")

    cells = spark.sparkContext.broadcast(filter_of(prefixes.select("shingle")))
    scanned = written(candidates(rows, cells, sizes, window), "candidates")
    near = scanned.select("row_key", "n_words", F.explode("found").alias("f")).select("row_key", "n_words", "f.*")
    inside = F.expr("at >= offset AND at - offset + n <= n_words")
    same = F.expr("array_join(slice(split(around, ' ', -1), at - offset - start + 1, n), ' ') = win")
    hits = near.join(prefixes, "shingle").filter(inside).filter(same)
    hits = hits.selectExpr("row_key", "at - offset AS start", "at - offset + n AS end", "win")
    return scanned.select("row_key", "doc_id", "n_words"), windows.select("item_id", "win"), written(hits, "hits")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """What each row of ``docs`` (doc_id, text) has of ``items`` (item_id, text).

    A window is ``window`` item words in a row; an item of fewer words, but not none, is one window.
    Gives doc_id, n_words, n_hit (words inside any occurrence of a window), n_items (items with a
    window that occurs), items_sha256 (of their ids, sorted as text, comma-joined) and contaminated.
    Null texts have no words.  Items without an id hit words, but are not counted or named.  Equal
    items count each, equal rows give equal rows; other columns are not read.
    """
    scanned, windows, hits = search(docs, items, window, shingle)
    covered = F.expr(
        """aggregate(array_sort(collect_set(struct(start, end))), named_struct('n', 0L, 'upto', 0),
           (seen, span) -> named_struct('n', seen.n + greatest(0, span.end - greatest(span.start, seen.upto)),
                                        'upto', greatest(seen.upto, span.end)),
           seen -> seen.n)"""
    )
    n_hit = hits.groupBy("row_key").agg(covered.alias("n_hit"))
    of_window = windows.filter("item_id IS NOT NULL").select("win", F.col("item_id").cast("string").alias("item")).distinct()
    of_row = hits.select("row_key", "win").distinct().join(of_window, "win").select("row_key", "item").distinct()
    named = of_row.groupBy("row_key").agg(F.array_sort(F.collect_list("item")).alias("named"))
    return (
        scanned.join(n_hit, "row_key", "left")
        .join(named, "row_key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("named"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("named", ","), F.lit("")), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` that have no window of an item, with all their columns as they are.

    Rows that stay are not moved: ``without_keys``.  Repeated rows stay or go together.
    """
    _, _, hits = search(docs, items, window, shingle)
    gone = written(hits.select("row_key").distinct(), "gone")
    return without_keys(docs, row_key(), gone)
