"""Token ids packed into rows of equal length by best-fit decreasing.

Documents become ids of a byte-level vocabulary, ended by ``eos``.  One longer than a row is split
into pieces of a row's length and a rest, without loss.  The pieces of a shard, longest first, go
into the fullest row that still has room for them: a segment tree over the rows' free places
finds it in a logarithmic number of steps.  Each row comes with its cumulative segment lengths and
the places at which positions begin again, so that a model does not look across documents.

A shard is what one task reads, in parts of ``SHARD_TOKENS``: no shuffle, and a task's memory is
bounded by its shard.  Which rows share a shard depends on how the input is split into tasks; what
is packed does not.

``write_packed`` stores each shard as one binary file, written by Spark's text writer from the task that
packs it: an uncompressed ``npz`` archive of the id matrix and its rows' segments, and a line end.
"""

from __future__ import annotations

import base64
import io
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import SLICE_ROWS, arrow_schema, id_and_text, map_arrow, map_slices

#: Ids of a row, and of a shard before it is packed.
ROW_TOKENS, SHARD_TOKENS = 2048, 1 << 21
#: White space in a row from which its words are found outside the encoder, whose stack a word of much white
#: space overflows; long words of other kinds it takes as they are, in n log n.
LONGEST_RUN = 2000
RUN = re.compile(rf"\s{{{LONGEST_RUN}}}")


@dataclass(frozen=True)
class Vocabulary:
    """A file of ranked byte strings, one ``base64 rank`` a line, and the pattern of its words."""

    path: str
    pattern: str
    eos: int

    def encoder(self) -> tiktoken.Encoding:
        if self not in _encoders:
            with open(self.path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            _encoders[self] = tiktoken.Encoding("file", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return _encoders[self]


_encoders: dict[Vocabulary, tiktoken.Encoding] = {}


def encode(encoder: tiktoken.Encoding, text: str) -> list[int]:
    """The vocabulary's own ids of any text: it is cut only at the borders of a word of the pattern."""
    if len(text) < LONGEST_RUN or not RUN.search(text):
        return encoder.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for m in regex.finditer(encoder._pat_str, text):
        if m.end() - m.start() >= LONGEST_RUN - 1:
            ids += encoder.encode_ordinary(text[at : m.start()]) + encoder._encode_single_piece(m[0])
            at = m.end()
    return ids + encoder.encode_ordinary(text[at:])


class FreePlaces:
    """Rows by their free places: a segment tree whose nodes say if any row is below them."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.any = bytearray(2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.width
        while node and not self.any[node]:
            self.any[node] = 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(free places, row) of the row with the fewest free places of at least ``least``, removed."""
        node = least + self.width
        while not self.any[node]:
            while node & 1:  # a right child: nothing greater beside it
                node >>= 1
            if node == 0:
                return None
            node += 1
        while node < self.width:
            node = 2 * node if self.any[2 * node] else 2 * node + 1
        free = node - self.width
        row = self.rows[free].pop()
        if not self.rows[free]:
            self.any[node] = 0
            node >>= 1
            while node and not (self.any[2 * node] or self.any[2 * node + 1]):
                self.any[node] = 0
                node >>= 1
        return free, row


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """The rows, each a list of the pieces in it; every length is from 1 to ``capacity``."""
    rows: list[list[int]] = []
    free = FreePlaces(capacity)
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[piece])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        places, row = found
        rows[row].append(piece)
        if places > lengths[piece]:
            free.add(places - lengths[piece], row)
    return rows


PACKED = """shard string, row int, n_tokens int, ids binary, doc_ids array<long>, doc_numbers array<int>,
    doc_offsets array<long>, cu_seqlens array<int>, position_resets array<int>"""


def pack_shard(shard: str, docs: list[tuple[int | None, np.ndarray]], size: int, pad: int) -> list[dict]:
    """The rows of one shard; ``ids`` are little-endian unsigned numbers, of 2 bytes or 4 as in ``docs``."""
    pieces = [(n, at) for n, (_, ids) in enumerate(docs) for at in range(0, len(ids), size)]
    lengths = [min(size, len(docs[n][1]) - at) for n, at in pieces]
    made = []
    for row, inside in enumerate(best_fit_decreasing(lengths, size)):
        ends = np.cumsum([0, *(lengths[p] for p in inside)]).tolist()
        ids = np.full(size, pad, dtype=docs[0][1].dtype)
        for p, start in zip(inside, ends, strict=False):
            n, at = pieces[p]
            ids[start : start + lengths[p]] = docs[n][1][at : at + lengths[p]]
        made.append(
            {
                "shard": shard,
                "row": row,
                "n_tokens": ends[-1],
                "ids": ids.tobytes(),
                "doc_ids": [docs[pieces[p][0]][0] for p in inside],
                "doc_numbers": [pieces[p][0] for p in inside],
                "doc_offsets": [pieces[p][1] for p in inside],
                "cu_seqlens": ends,
                "position_resets": ends[:-1],
            }
        )
    return made


def shards_of(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, size: int, shard_tokens: int) -> Iterator[list[dict]]:
    """The rows of each shard of what a task reads."""
    from pyspark import TaskContext

    encoder, task = vocabulary.encoder(), TaskContext.get().partitionId()
    kind = np.dtype("<u2" if max(encoder.n_vocab, vocabulary.eos + 1) <= 1 << 16 else "<u4")
    held: list[tuple[int | None, np.ndarray]] = []
    tokens = shards = 0
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS).to_pydict()
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                held.append((doc_id, np.array([*encode(encoder, text), vocabulary.eos], dtype=kind)))
                tokens += len(held[-1][1])
                if tokens >= shard_tokens:
                    yield pack_shard(f"{task:06d}-{shards:06d}", held, size, vocabulary.eos)
                    held, tokens, shards = [], 0, shards + 1
    if held:
        yield pack_shard(f"{task:06d}-{shards:06d}", held, size, vocabulary.eos)


def in_batches(rows: list[dict], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), SLICE_ROWS):
        yield pa.RecordBatch.from_pylist(rows[start : start + SLICE_ROWS], schema=arrow)


def pack(docs: DataFrame, vocabulary: Vocabulary, size: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Rows of ``size`` ids that hold all documents, each with its ``eos``.

    ``ids`` is a row of the shard's matrix, padded with ``eos`` after ``n_tokens``.  Segment i of a row
    is from ``cu_seqlens[i]`` to ``cu_seqlens[i + 1]`` and holds the ids of ``doc_ids[i]`` from
    ``doc_offsets[i]`` on; ``doc_numbers`` tell documents of a shard apart that have one id or none.
    A null or empty text is its ``eos`` alone; other columns are not read.
    """
    arrow = arrow_schema(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in shards_of(batches, vocabulary, size, shard_tokens):
            yield from in_batches(rows, arrow)

    return map_arrow(id_and_text(docs), run, PACKED)


def shard_file(rows: list[dict], size: int) -> bytes:
    """A shard's rows as an archive of arrays: ``ids`` is the matrix, ``n_tokens`` and ``n_segments`` have
    a number for each row of it; the arrays of segments follow each other row by row."""

    def joined(name: str, kind: str) -> np.ndarray:
        return np.array([x for r in rows for x in r[name]], dtype=kind)

    doc_ids = [i for r in rows for i in r["doc_ids"]]
    file = io.BytesIO()
    np.savez(
        file,
        shard=np.array(rows[0]["shard"]),
        ids=np.frombuffer(b"".join(r["ids"] for r in rows), dtype=f"<u{len(rows[0]['ids']) // size}").reshape(-1, size),
        n_tokens=np.array([r["n_tokens"] for r in rows], dtype="<i4"),
        n_segments=np.array([len(r["doc_ids"]) for r in rows], dtype="<i4"),
        cu_seqlens=joined("cu_seqlens", "<i4"),
        position_resets=joined("position_resets", "<i4"),
        doc_ids=np.array([i or 0 for i in doc_ids], dtype="<i8"),
        doc_has_id=np.array([i is not None for i in doc_ids], dtype=bool),
        doc_numbers=joined("doc_numbers", "<i4"),
        doc_offsets=joined("doc_offsets", "<i8"),
    )
    return file.getvalue()


def rows_of_file(content: bytes) -> list[dict]:
    """The rows that ``shard_file`` has stored."""
    with np.load(io.BytesIO(content)) as stored:
        found = {name: stored[name] for name in stored.files}
    made, ends = [], np.cumsum([0, *found["n_segments"]]).tolist()
    for row, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
        ids = zip(found["doc_ids"][a:b].tolist(), found["doc_has_id"][a:b].tolist(), strict=True)
        made.append(
            {
                "shard": str(found["shard"]),
                "row": row,
                "n_tokens": int(found["n_tokens"][row]),
                "ids": found["ids"][row].tobytes(),
                "doc_ids": [i if known else None for i, known in ids],
                "doc_numbers": found["doc_numbers"][a:b].tolist(),
                "doc_offsets": found["doc_offsets"][a:b].tolist(),
                "cu_seqlens": found["cu_seqlens"][a + row : b + row + 1].tolist(),
                "position_resets": found["position_resets"][a:b].tolist(),
            }
        )
    return made


def write_packed(
    docs: DataFrame, vocabulary: Vocabulary, path: str, size: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Write the shards of ``pack`` as binary files below ``path``, one each.  A repeated task's files
    replace those of its first try, by Spark's commit."""
    arrow = arrow_schema("value binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in shards_of(batches, vocabulary, size, shard_tokens):
            yield pa.RecordBatch.from_pydict({"value": [shard_file(rows, size)]}, schema=arrow)

    files = map_arrow(id_and_text(docs), run, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``pack`` from the files below ``path``."""
    arrow = arrow_schema(PACKED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from in_batches(rows_of_file(batch.column(0)[i].as_py()), arrow)

    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    return map_arrow(files, run, PACKED)


def position_ids(cu_seqlens: list[int], size: int) -> np.ndarray:
    """The position of each id in its segment; the padding is a segment of its own."""
    ends = [*cu_seqlens, size] if cu_seqlens[-1] < size else cu_seqlens
    return np.concatenate([np.arange(b - a) for a, b in zip(ends, ends[1:], strict=False)])


def unpack(packed: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text) of each document of ``packed``: its pieces put together and decoded."""
    spans = F.arrays_zip("doc_ids", "doc_numbers", "doc_offsets", "position_resets", F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("upto"))
    each = packed.select("shard", "ids", "cu_seqlens", F.explode(spans).alias("s"))
    pieces = each.select("shard", F.col("s.doc_numbers").alias("number"), F.col("s.doc_ids").alias("doc_id"),
                         F.struct(F.col("s.doc_offsets").alias("offset"), "ids", F.col("s.position_resets").alias("first"), F.col("s.upto").alias("upto")).alias("piece"))
    whole = pieces.groupBy("shard", "number", "doc_id").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))

    def work():
        encoder = vocabulary.encoder()
        kind = np.dtype("<u2" if max(encoder.n_vocab, vocabulary.eos + 1) <= 1 << 16 else "<u4")

        def text(pieces: list[dict]) -> str:
            ids = np.concatenate([np.frombuffer(p["ids"], dtype=kind)[p["first"] : p["upto"]] for p in pieces])
            return encoder.decode(ids[:-1].tolist())

        return lambda rows: {"doc_id": rows["doc_id"], "text": list(map(text, rows["pieces"]))}

    return map_slices(whole.select("doc_id", "pieces"), work, "doc_id long, text string")
