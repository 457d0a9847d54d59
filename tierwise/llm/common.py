"""Helpers shared by the operators: columns, Arrow batches, written tables, distinct rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierwise.scratch import work_dir

#: Rows of one slice of an Arrow batch; texts of a slice are Python objects at the same time.
SLICE_ROWS = 500
#: Bytes and rows after which a batch of rows with large values is given out.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1000
#: Rows of a file of a small table.
ROWS_PER_FILE = 500_000
PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, a null text as the empty one; all others are left out,
    so that their names cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id and 128 bits of hashes of the text; null ids have their own key, null texts the empty text's.

    Rows whose ids are equal share a key if their texts are, and otherwise with odds of one in 2 ** 128.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashes = [F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("second"), text))]
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), *hashes)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, or what it becomes by underscores until no column of ``frame`` is called that."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name = f"_{name}"
    return name


def map_slices(
    frame: DataFrame, work: Callable[[], Callable[[dict[str, list]], dict[str, list]]], schema: str
) -> DataFrame:
    """Apply ``work()`` to slices of the rows, given and returned as lists by column name.

    ``work`` is called once in each task and returns the function for its slices, so that what it
    sets up is bounded by a task.  A slice has at most ``SLICE_ROWS`` rows.
    """
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = work()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = handle(batch.slice(start, SLICE_ROWS).to_pydict())
                yield pa.RecordBatch.from_pydict(rows, schema=arrow)

    return map_arrow(frame, run, schema)


def map_arrow(
    frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` whose workers find this package."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def ship_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too; a cluster without that
    folder gets the package with ``--py-files``."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [PACKAGE_ROOT])


def arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def batches_of(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded bytes; the last value of a row says how many it has."""
    held: list[list] = []
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)

    for *row, n_bytes in rows:
        held.append(row)
        size += n_bytes
        if size > BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def written(frame: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """``frame`` as a new table in the shared folder: computed once, lineage ends there."""
    return written_to(frame, work_dir(frame.sparkSession, label), rows)


def written_to(frame: DataFrame, path: str, rows: int | None = None) -> DataFrame:
    """``frame`` as a table at ``path``, for whoever deletes it there when nothing needs it any more.

    If it is known to have about ``rows`` rows it gets a file for every ``ROWS_PER_FILE`` of them, however
    many tasks have made it.  Zstandard needs no memory outside the heap, which other codecs take for each of many small files.
    """
    if rows is not None:
        frame = frame.repartition(1 + rows // ROWS_PER_FILE)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
