"""Named access: temp views over layers, and external tables over published paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tierwise.spec import VIEW_SUFFIX, SpecError


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{name}{VIEW_SUFFIX}")


def view(spark: SparkSession, name: str, declared: Mapping[str, object]) -> DataFrame:
    """The registered view of a declared dataset."""
    if name not in declared:
        raise SpecError(f"dataset '{name}' is not declared")
    return spark.table(f"{name}{VIEW_SUFFIX}")


def quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.replace("`", "").split("."))


def create_external_table(
    spark: SparkSession,
    table: str,
    path: str,
    file_format: str = "parquet",
    partitioned: bool = False,
    schema: str | None = None,
) -> DataFrame:
    """Register the files under ``path``; dropping the table keeps them."""
    columns = f" ({schema})" if schema else ""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)}{columns} USING {file_format} LOCATION '{location}'")
    if partitioned:
        refresh_partitions(spark, table)
    return spark.table(quoted(table))


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Follow partition folders added or removed behind the catalog's back."""
    spark.sql(f"MSCK REPAIR TABLE {quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(quoted(table))


def repoint_table(spark: SparkSession, table: str, path: str) -> None:
    """Switch an unpartitioned table to another version folder in one catalog change."""
    location = path.replace("'", "\\'")
    spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION '{location}'")
    spark.catalog.refreshTable(quoted(table))


def change(spark: SparkSession, statement: str) -> None:
    """One change of the catalog."""
    spark.sql(statement)
