"""Incremental bronze to silver: only days with files that are new."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.plans.report import publish_silver
from tierwise.sources.files import day_files, feed_files, read_feed
from tierwise.sources.ledger import Claims, FileLedger
from tierwise.spec import DatasetSpec


def publish_days(spark: SparkSession, spec: DatasetSpec, listing: DataFrame, fresh: DataFrame) -> None:
    """Publish the days that the files ``fresh`` belong to, through the dataset's rules.

    A touched day is read from all its files and its folder replaced as a whole, so a run that
    failed is simply repeated: nothing is lost or doubled.
    """
    everything = dataclasses.replace(spec, snapshot="all")
    _, frame = read_feed(spark, everything, day_files(listing, fresh))
    if frame is not None:
        publish_silver(spark, {spec.name: frame}, {spec.name: everything})


def ingest_new(
    spark: SparkSession, spec: DatasetSpec, ledger: FileLedger, batch_id: str, claims: Claims | None = None
) -> int:
    """Publish the days new files belong to and record those files; returns how many.

    The batch's files are recorded as ``found`` first, so that those which arrive meanwhile are left
    to the next batch, and as ``done`` in the end.  With ``claims`` several runs may work on the feed at
    once: a run takes the days that no other has, looks again which of their files are new, and leaves
    the rest.  What a run that died had claimed is taken over when its claims are too old.
    """
    day = F.substring("stamp", 1, 8)
    if claims is None:
        return _ingest_listed(spark, spec, ledger, batch_id, feed_files(spark, spec))
    fresh = ledger.unprocessed(feed_files(spark, spec).filter("dated"), spec.name)
    mine = claims.claim([r[0] for r in fresh.select(day).distinct().collect()])  # one row for each day
    if not mine:
        return 0
    listing = feed_files(spark, spec).filter(day.isin(mine))
    n = _ingest_listed(spark, spec, ledger, batch_id, listing, lambda: all(map(claims.holds, mine)))
    claims.release(mine)
    return n


def _ingest_listed(
    spark: SparkSession,
    spec: DatasetSpec,
    ledger: FileLedger,
    batch_id: str,
    listing: DataFrame,
    may_publish: Callable[[], bool] = lambda: True,
) -> int:
    fresh = ledger.unprocessed(listing.filter("dated"), spec.name)
    ledger.record(fresh, spec.name, batch_id, "found")
    found = ledger.of_batch(spec.name, batch_id)
    mine = listing.join(found.select("file_name"), "file_name", "left_semi")
    n = mine.count()
    if n:
        if not may_publish():
            raise RuntimeError(f"dataset {spec.name}: batch {batch_id} took too long and lost its days to another run")
        publish_days(spark, spec, listing, mine)
        ledger.record(mine, spec.name, batch_id)
    return n
