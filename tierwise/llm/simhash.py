"""Near-duplicates by SimHash fingerprints and deletion variants of their segments.

Two fingerprints that differ in at most two bits are cut into two segments of 32 bits: in one of
them they differ by at most one bit.  Each segment is indexed 32 times, each time without one of
its bits; an equality join on these variants finds every such pair, and the join's condition
verifies the whole distance, so that only true links leave it.  Equal fingerprints are one entry
of the index, whatever the number of their documents.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import id_and_text, map_slices, row_key, written
from tierwise.llm.components import connected_components
from tierwise.llm.membership import without_keys

#: Shingles counted at a time: 64 bytes each.
CHUNK = 1 << 16
#: Bits of a segment.  The distance that two segments can find is two bits, or fewer.
SEGMENT, MAX_BITS = 32, 2


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The bits set in over half the hashes of the word shingles, as a signed number; 0 without a
    word.  Fewer words than a shingle has are one shingle."""
    found = text.lower().split()  # bytes: A-Z only, and the six ASCII white spaces
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = list(map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False)))
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), CHUNK):
        hashes = [xxhash.xxh64_intdigest(s, seed) for s in shingles[start : start + CHUNK]]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, row_key, fingerprint long) of each row's whole text; a null text is the empty one."""
    one = partial(fingerprint, words=words, seed=seed)
    rows = id_and_text(docs).select("doc_id", row_key().alias("row_key"), F.col("text").cast("binary").alias("text"))

    def handle(part: dict[str, list]) -> dict[str, list]:
        return {"doc_id": part["doc_id"], "row_key": part["row_key"], "fingerprint": list(map(one, part["text"]))}

    return map_slices(rows, lambda: handle, "doc_id long, row_key string, fingerprint long")


def variants(prints: DataFrame) -> DataFrame:
    """(key, fingerprint): the segment and the bit left out, and the segment's other bits."""
    each = prints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(2 * SEGMENT - 1))).alias("i"))
    return each.selectExpr(
        "fingerprint",
        f"""(shiftrightunsigned(fingerprint, {SEGMENT} * int(i div {SEGMENT})) & {2**SEGMENT - 1}L
             & ~shiftleft(1L, i % {SEGMENT})) | shiftleft(bigint(i), {SEGMENT}) AS key""",
    )


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v): the distinct fingerprints that differ in one to ``max_bits`` bits, each pair once or
    twice.  A pair with an equal segment is taken from that segment's first variant only."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"two segments find distances up to {MAX_BITS}")
    index = variants(prints.select("fingerprint").distinct())
    a = index.select("key", F.col("fingerprint").alias("u"))
    b = index.select(F.col("key").alias("other_key"), F.col("fingerprint").alias("v"))
    i, mask = f"int(shiftright(key, {SEGMENT}))", 2**SEGMENT - 1
    differs = f"(shiftrightunsigned(u ^ v, {SEGMENT} * int({i} div {SEGMENT})) & {mask}L) <> 0"
    close = F.expr(f"u < v AND bit_count(u ^ v) <= {max_bits} AND ({differs} OR {i} % {SEGMENT} = 0)")
    return a.join(b, (a["key"] == b["other_key"]) & close).select("u", "v")


def grouped(docs: DataFrame, words: int, seed: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and (fingerprint, first, smallest): the first document that has the
    fingerprint, and that of all that chains of links reach.  The first has the smallest id."""
    prints = written(fingerprints(docs, words, seed), "fingerprints")
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = written(prints.groupBy("fingerprint").agg(F.min(entry).alias("first")), "first")
    linked = connected_components(near_links(first, max_bits)).withColumnRenamed("node", "fingerprint")
    linked = written(linked.join(first, "fingerprint"), "components")
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    linked = linked.join(smallest, "root").select("fingerprint", "smallest")
    of_print = first.join(linked, "fingerprint", "left").withColumn("smallest", F.coalesce("smallest", "first"))
    return prints, of_print


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs``.

    The component is all that chains of fingerprints at most ``max_bits`` apart can reach; its id
    is the smallest ``doc_id`` in it (null if none has one).  Texts without a word, null ones too,
    have the fingerprint zero.  Repeated rows give repeated rows; other columns are not read.
    """
    prints, of_print = grouped(docs, words, seed, max_bits)
    # written, so that the join with a fingerprint's many documents may split them
    component = written(of_print.select("fingerprint", F.col("smallest.doc_id").alias("component_id")), "groups")
    return prints.join(component, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, words: int = 3, seed: int = 42, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: that of the smallest ``doc_id``.

    Rows without an id come after those with one; of equal rows one stays, of several texts with
    the smallest id one.  All columns are kept as they are, and rows that stay are not moved:
    ``without_keys``.
    """
    prints, of_print = grouped(docs, words, seed, max_bits)
    # written, so that the join with a fingerprint's many rows may split them
    staying = written(of_print.select("fingerprint", F.col("smallest.row_key").alias("staying")), "groups")
    rows = prints.groupBy("row_key", "fingerprint").agg(F.count("*").alias("n"))
    rows = written(rows, "rows").join(staying, "fingerprint").select("row_key", (F.col("row_key") == F.col("staying")).alias("stays"), "n")
    rows = written(rows.filter("NOT stays OR n > 1"), "doubtful")
    return without_keys(docs, row_key(), rows.filter("NOT stays"), single=rows.filter("stays"))
