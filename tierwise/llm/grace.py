"""Exact duplicates by Grace hash partitioning and an open-addressing table of whole contents.

Every task first groups the contents of its own rows, so that a content leaves a task once, however
many rows have it; these parts are written to the shared folder.  The shuffle then deals the parts
by their hash, and each partition is grouped again.  Both times the same table is used: if it
outgrows its budget, it is partitioned by the next bits of the hash to spill files, and so on
until a file's distinct contents fit.  The files lie in Spark's own local folders, as its sorts'
do, and are deleted when they have been read; a task that is run again starts from its input.

A hash only says where a content is looked for.  Contents are equal if all their bytes are.
"""

from __future__ import annotations

import hashlib
import os
import re
import shutil
import struct
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import arrow_schema, batches_of, id_and_text, map_arrow, written

#: Bytes of contents and numbers that a table holds before it is spilled.
TABLE_BYTES = 64 << 20
#: Bits of the hash that a level of spill files is dealt by, and levels until they are used up.
LEVEL_BITS, LEVELS = 4, 16

SPACE = re.compile(rb"[\x20\x09-\x0d]+")
HEADER = struct.Struct("<QII")
Record = tuple[int, bytes, list[int]]


class OpenTable:
    """Contents with the numbers gathered for each; open addressing with linear probing."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.numbers: list[list[int]] = []
        self.bytes = 0

    def place(self, found: int, content: bytes) -> int:
        """The slot that has this content, or the free one it belongs in."""
        mask = len(self.slots) - 1
        at = found & mask
        while (i := self.slots[at]) >= 0 and not (self.hashes[i] == found and self.contents[i] == content):
            at = (at + 1) & mask
        return at

    def has(self, found: int, content: bytes) -> bool:
        return self.slots[self.place(found, content)] >= 0

    def add(self, found: int, content: bytes, numbers: list[int]) -> None:
        at = self.place(found, content)
        self.bytes += 32 * len(numbers)
        if (i := self.slots[at]) >= 0:
            self.numbers[i].extend(numbers)
            return
        self.slots[at] = len(self.contents)
        self.hashes.append(found)
        self.contents.append(content)
        self.numbers.append(list(numbers))
        self.bytes += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, (h, c) in enumerate(zip(self.hashes, self.contents, strict=True)):
                self.slots[self.place(h, c)] = i

    def groups(self) -> Iterator[Record]:
        return zip(self.hashes, self.contents, self.numbers, strict=True)


def put(file, found: int, content: bytes, numbers: list[int]) -> None:
    file.write(HEADER.pack(found, len(content), len(numbers)))
    file.write(content)
    file.write(struct.pack(f"<{len(numbers)}q", *numbers))


def stored(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while head := file.read(HEADER.size):
            found, size, n = HEADER.unpack(head)
            yield found, file.read(size), list(struct.unpack(f"<{n}q", file.read(8 * n)))
    os.remove(path)


def grouped(records: Iterator[Record], budget: int, folder: str, level: int = 0) -> Iterator[Record]:
    """Each distinct content once, with the numbers of all its records."""
    table = OpenTable()
    for record in records:
        table.add(*record)
        if table.bytes > budget and len(table.contents) > 1:
            break
    else:
        yield from table.groups()
        return
    with tempfile.TemporaryDirectory(dir=folder) as here:
        if level < LEVELS:
            yield from partitioned(table, records, budget, here, level)
        else:
            yield from in_turns(table, records, budget, here)


def partitioned(table: OpenTable, records: Iterator[Record], budget: int, here: str, level: int) -> Iterator[Record]:
    """Deal the table and what is left of the records to files by the next bits of the hash."""
    paths = [f"{here}/{i}" for i in range(1 << LEVEL_BITS)]
    files = [open(path, "wb") for path in paths]  # noqa: SIM115  (closed below)
    shift, mask = 64 - LEVEL_BITS * (level + 1), (1 << LEVEL_BITS) - 1
    try:
        for rest in (table.groups(), records):
            for found, content, numbers in rest:
                put(files[found >> shift & mask], found, content, numbers)
    finally:
        for file in files:
            file.close()
    table.clear()
    for path in paths:
        yield from grouped(stored(path), budget, here, level + 1)


def in_turns(table: OpenTable, records: Iterator[Record], budget: int, here: str) -> Iterator[Record]:
    """Contents that share their whole hash and do not fit together: a table of them at a time."""
    with open(f"{here}/rest", "wb") as file:
        for found, content, numbers in records:
            if table.has(found, content):
                table.add(found, content, numbers)
            else:
                put(file, found, content, numbers)
    yield from table.groups()
    yield from grouped(stored(f"{here}/rest"), budget, here, LEVELS)


def spill_root() -> str:
    """A new folder in Spark's local folders, whose paths Spark tells its Python workers."""
    return tempfile.mkdtemp(prefix="grace-", dir=os.environ["SPARK_LOCAL_DIRS"].split(",")[0])


def grouped_in_task(records: Iterator[Record], budget: int) -> Iterator[Record]:
    folder = spill_root()
    try:
        yield from grouped(records, budget, folder)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    return SPACE.sub(b" ", text)


def parts_of(docs: DataFrame, budget: int, hashed: Callable[[bytes], int]) -> DataFrame:
    """One row for each task and content: part (its number), hash, sha256, the ids (sorted, null ones
    last), no_id and least_id of the first of them, n and the content."""
    schema = "part long, hash long, sha256 string, ids array<long>, no_id boolean, least_id long, n long, content binary"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                for i in range(batch.num_rows):
                    content = normalised(batch.column(1)[i].as_py())
                    doc_id = batch.column(0)[i].as_py()
                    yield hashed(content), content, [doc_id is None, doc_id or 0]

        def rows() -> Iterator[tuple]:
            first = TaskContext.get().partitionId() << 33
            for part, (found, content, numbers) in enumerate(grouped_in_task(records(), budget), first):
                ids = [None if no_id else i for no_id, i in sorted(zip(numbers[::2], numbers[1::2], strict=True))]
                signed = found - (1 << 64) if found >> 63 else found
                sha256 = hashlib.sha256(content).hexdigest()
                yield part, signed, sha256, ids, ids[0] is None, ids[0], len(ids), content, len(content) + 8 * len(ids)

        yield from batches_of(rows(), arrow)

    rows = id_and_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_arrow(rows, run, schema)


def decided(parts: DataFrame, budget: int) -> DataFrame:
    """(part, keep_id, group_size, stays) of each part: ``stays`` is the one with the row that does."""
    schema = "part long, keep_id long, group_size long, stays boolean"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                part, found, no_id, least_id, n = (batch.column(i).to_pylist() for i in range(5))
                for i in range(batch.num_rows):
                    content = batch.column(5)[i].as_py()
                    yield found[i] & (1 << 64) - 1, content, [no_id[i], least_id[i] or 0, part[i], n[i]]

        def rows() -> Iterator[tuple]:
            for _, _, numbers in grouped_in_task(records(), budget):
                no_id, least_id, first = min(zip(numbers[::4], numbers[1::4], numbers[2::4], strict=True))
                size = sum(numbers[3::4])
                for part in numbers[2::4]:
                    yield part, None if no_id else least_id, size, part == first, 32

        yield from batches_of(rows(), arrow)

    dealt = parts.select("part", "hash", "no_id", "least_id", "n", "content").repartition("hash")
    return map_arrow(dealt, run, schema)


def exact_duplicates(
    docs: DataFrame, budget: int = TABLE_BYTES, hashed: Callable[[bytes], int] = xxhash.xxh64_intdigest
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of each row of ``docs``.

    Texts are equal if they are after each run of ASCII white space is one space; a null text is the
    empty one.  Of equal texts the row with the smallest id is kept, ``keep_id``; rows without an id
    come last, and ``keep_id`` is null if none has one.  Of rows with equal ids and texts one is
    kept.  An empty table gives none; other columns are not read.

    A content is moved once for each task that has it, never once for each row, and the ids stay with
    their task's part: no key gathers the rows of a group.  ``budget`` bounds a table's memory (one
    content is held whatever its size) and changes no result.
    """
    parts = written(parts_of(docs, budget, hashed), "parts")
    each = parts.select("part", "sha256", F.posexplode("ids").alias("at", "doc_id"))
    return each.join(decided(parts, budget), "part").select(
        "doc_id", "keep_id", "group_size", (F.col("stays") & (F.col("at") == 0)).alias("kept"), F.col("sha256").alias("text_sha256")
    )
