"""SpotSigs fingerprints: chains of content words that follow common words.

Every anchor (a common word) starts a signature: the anchor and the next ``chain`` content words
after it, ``distance`` content words apart.  Such places are in running prose and hardly in
navigation or lists.  A text's fingerprint is the multiset of its signatures, and likeness the
multisets' Jaccard similarity.  Pairs are only compared if their sizes allow the wanted likeness:
sets are partitioned by their lengths, so that a set meets those of its own and the next partition.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import SLICE_ROWS, arrow_schema, id_and_text, map_arrow, map_slices, row_key, written
from tierwise.llm.components import connected_components

# Common words of English, German, French and Spanish; they are anchors, and no content.
ANCHORS = frozenset(
    """a an and are as at be but by for from had has have he his in is it its not of on or she that the their they this
    to was were which will with you der die das und in den von zu mit ist sich des auf für im dem nicht ein eine als
    auch es an er hat aus bei le la les de des et un une que qui en du dans est pour pas au sur par plus avec il elle
    ce se ou el los las y del por con una su para al lo como más o pero sus""".split()
)
WORD = re.compile(r"\w+")
ANCHOR_HASHES = np.sort(np.array([xxhash.xxh64_intdigest(w) for w in ANCHORS], dtype=np.uint64))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Content words of a signature, and the step from one to the next.
CHAIN, DISTANCE = 2, 1


def signatures(text: str, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """The sorted signatures, 32 bits each, repeats included.

    A text without a whole signature has one of all its words, so that no two texts are alike for
    want of anchors; without a word it is that of the text itself.
    """
    words = WORD.findall(text.lower())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    at = np.minimum(np.searchsorted(ANCHOR_HASHES, hashes), len(ANCHOR_HASHES) - 1)
    anchor = ANCHOR_HASHES[at] == hashes
    content, places = hashes[~anchor], np.flatnonzero(anchor)
    first = places - np.arange(len(places))  # content words before each anchor
    whole = first + (chain - 1) * distance < len(content)
    first, mixed = first[whole], hashes[places[whole]]
    for i in range(chain):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * MULTIPLIER + content[first + i * distance]
    if not len(mixed):
        mixed = np.array([xxhash.xxh64_intdigest(" ".join(words) or text)], dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * MULTIPLIER
    return np.sort((mixed >> np.uint64(32)).astype(np.uint32))


def as_text(found: np.ndarray) -> str:
    """A fingerprint: eight hexadecimal digits for each signature, in order."""
    return found.astype(">u4").tobytes().hex()


def numbered(found: np.ndarray) -> np.ndarray:
    """Each signature with the number of equal ones before it: a set instead of a multiset."""
    same = np.concatenate([[False], found[1:] == found[:-1]]) if len(found) else np.empty(0, bool)
    index = np.arange(len(found))
    start = np.maximum.accumulate(np.where(same, 0, index))
    return (found.astype(np.uint64) << np.uint64(32)) | (index - start).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The Jaccard similarity of two multisets; 0 without a comparison if their sizes rule ``least`` out."""
    small, large = sorted((len(a), len(b)))
    if small < least * large:
        return 0.0
    common = len(np.intersect1d(numbered(a), numbered(b), assume_unique=True))
    return common / (len(a) + len(b) - common)


def edited(text: str, following: str) -> str:
    """The text whose last half gives way to the beginning of another one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# ---- a document, its edited text and the next document


def at_most(bounds: list[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``: a coarse step, then a fine one."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]).cast("long") for g in groups])
    fine = F.array(*[F.array(*[F.lit(b).cast("long") for b in g]) for g in groups])
    coarse = F.size(F.filter(heads, lambda b: b <= value))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda b: b <= value))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def blocks_in_order(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (doc_id, text) in one partition for each stretch of ids, sorted, and after the rows of a
    stretch those that begin the next one (of the last stretch: the first one), marked as ``guard``."""
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    keyed = rows.withColumn("key", key)
    narrow = keyed.select("key")
    cuts = narrow.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else []
    bounds = sorted(set(cuts or []))
    first_of_each = narrow.groupBy(at_most(bounds, F.col("key")).alias("b")).agg(F.min("key").alias("first"))
    starts = sorted(r["first"] for r in first_of_each.collect())
    if not starts:
        return keyed.withColumns({"block": F.lit(0), "guard": F.lit(False)})
    block = at_most(starts, F.col("key")) - 1
    begins = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), block + 1) == F.col("key")
    own = F.struct(block.cast("int").alias("block"), F.lit(False).alias("guard"))
    before = F.struct(F.pmod(block - 1, F.lit(len(starts))).cast("int").alias("block"), F.lit(True).alias("guard"))
    placed = keyed.withColumn("to", F.explode(F.when(begins, F.array(own, before)).otherwise(F.array(own))))
    placed = placed.select("doc_id", "text", "key", "to.block", "to.guard")
    return placed.repartitionById(len(starts), "block").sortWithinPartitions("block", "guard", "key", "text")


COMPARED = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
    near_edited double, near_next double"""


def compare_with_next(docs: DataFrame, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and its likeness to that and to the next row.

    The next row is the one that follows in the order of ``doc_id`` and, for equal ids, text; a null id
    comes first, and after the last row the first one follows.  The edited text has the row's last
    half, rounded down, replaced by as many code points from the next row's beginning, or all it has.
    Null texts are empty ones; a table of one row is its own next; other columns are not read.

    Texts are moved once: to the stretch of ids that they belong to, in order.  Each stretch's last
    row needs the first one of the next stretch, of which it gets a copy.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrow = arrow_schema(COMPARED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before: block, id, text, signatures
        out: list[dict] = []
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for row in batch.slice(start, SLICE_ROWS).to_pylist():
                    if row["guard"] and held is None:
                        continue  # a further row that begins the next stretch
                    text, found = row["text"], signatures(row["text"], chain, distance)
                    if held and held[0] == row["block"]:
                        _, doc_id, before, own = held
                        changed = edited(before, text)
                        other = signatures(changed, chain, distance)
                        out.append(
                            {
                                "doc_id": doc_id,
                                "n_chars": len(before),
                                "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
                                "fingerprint": as_text(own),
                                "edited_fingerprint": as_text(other),
                                "near_edited": likeness(own, other),
                                "near_next": likeness(own, found),
                            }
                        )
                    held = None if row["guard"] else (row["block"], row["doc_id"], text, found)
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []

    return map_arrow(blocks_in_order(id_and_text(docs), n).select("doc_id", "text", "block", "guard"), run, COMPARED)


# ---- near-duplicates


def near_duplicates(docs: DataFrame, threshold: float = 0.8, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, class_id, n_links) of each row: documents that links of at least ``threshold`` connect.

    A class's id is its smallest ``doc_id``; ``n_links`` counts the other fingerprints that a row's
    fingerprint is that like.  Rows of one fingerprint are one entry of the search.  A pair must
    share one of its rarest signatures, must be of sizes that allow the threshold and is compared
    whole; a fingerprint meets those of its partition of lengths and of the next one.
    """

    def handle(rows: dict[str, list]) -> dict[str, list]:
        found = [numbered(signatures(t, chain, distance)).view(np.int64) for t in rows["text"]]
        return {
            "doc_id": rows["doc_id"],
            "row_key": rows["row_key"],
            "print": [xxhash.xxh64_intdigest(f.tobytes()) - 2**63 for f in found],
            "spots": [f.tolist() for f in found],
        }

    rows = id_and_text(docs).withColumn("row_key", row_key())
    made = map_slices(rows, lambda: handle, "doc_id long, row_key string, print long, spots array<long>")
    made = written(made, "spots")
    sets = written(made.groupBy("print").agg(F.first("spots").alias("spots"), F.min("doc_id").alias("first_id")), "sets")
    each = sets.select("print", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    counts = each.groupBy("spot").agg(F.count("*").alias("n_found"))
    ordered = each.join(counts, "spot").groupBy("print", "n").agg(F.array_sort(F.collect_list(F.struct("n_found", "spot"))).alias("o"))
    prefix = F.slice("o", 1, (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int"))
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(threshold)) + 1e-9)
    index = ordered.select("print", "n", part.alias("part"), F.explode(prefix).alias("p")).select("print", "n", "part", "p.spot")
    index = written(index, "index")
    small = index.withColumn("part", F.explode(F.array("part", F.col("part") + 1)))
    a, b = small.selectExpr("print u", "n n_u", "part", "spot"), index.selectExpr("print v", "n n_v", "part", "spot")
    near = a.join(b, ["spot", "part"]).filter(f"u <> v AND n_u <= n_v AND n_u >= {threshold} * n_v")
    near = near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    of_u = sets.selectExpr("print u", "spots spots_u")
    of_v = sets.selectExpr("print v", "spots spots_v")
    common = F.size(F.array_intersect("spots_u", "spots_v"))
    union = F.size("spots_u") + F.size("spots_v") - common
    links = near.join(of_u, "u").join(of_v, "v").filter(common >= threshold * union).select("u", "v")
    links = written(links, "links")
    n_links = links.selectExpr("u print").union(links.selectExpr("v print")).groupBy("print").agg(F.count("*").alias("n_links"))
    roots = connected_components(links).withColumnRenamed("node", "print")
    grouped = sets.select("print", "first_id").join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    grouped = written(grouped, "classes")
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("class_id"))
    of_print = grouped.join(smallest, "root").join(n_links, "print", "left").select("print", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return made.select("doc_id", "print").join(of_print, "print").select("doc_id", "class_id", "n_links")
