"""Dated URL lists joined to captures as of their time, with DataFrame functions only.

List entries say from which day a pattern is on a list or off it.  They become validity intervals;
a capture is blocked by the entries that were valid when it was fetched, not by those of today.

A pattern is a domain (``example.org``, with all its subdomains) or a domain and path prefix
(``example.org/en``, whole path segments).  A capture's possible patterns are few and known from
its URL, so the join is one of equality on the pattern and a stretch of ``STRETCH`` days, into
which the intervals are cut; the days themselves are compared within it.  Equal captures are
looked up once, and one pattern's many captures are split by the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days of a stretch: an interval is in one row for each stretch that it touches.
STRETCH = 64
FOREVER = "9999-12-31"


def host_of(url: Column) -> Column:
    """The URL's host in lower case, without user, port and a final dot; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def segments_of(url: Column) -> Column:
    """The path's segments that are not empty."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda s: s != "")


def patterns_of(url: Column, depth: int) -> Column:
    """Every domain and, up to ``depth`` segments, every path prefix that the URL falls under."""
    host, segments = host_of(url), segments_of(url)
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(labels, i, count - i + 1), ".")
    )
    if depth == 0:
        return F.when(host != "", domains).otherwise(F.array().cast("array<string>"))
    longest = F.least(F.size(segments), F.lit(depth))
    prefixes = F.when(
        longest > 0,
        F.transform(F.sequence(F.lit(1), longest), lambda i: F.concat(F.lit("/"), F.array_join(F.slice(segments, 1, i), "/"))),
    ).otherwise(F.array().cast("array<string>"))
    pairs = F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: F.concat(d, p))))
    return F.when(host != "", F.concat(domains, pairs)).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of ``entries`` (list, pattern, day, listed).

    ``listed`` is true from the day on which the pattern is on the list and false from the day on
    which it is off; of several entries of one day, off wins.  ``valid_to`` is the first day that the
    interval does not hold any more.  Entries that repeat the state change nothing; those with a null
    are no entries.  Patterns are in lower case up to the first slash.
    """
    pattern = F.regexp_replace(F.concat(F.lower(F.regexp_extract("pattern", "^[^/]*", 0)), F.regexp_extract("pattern", "/.*$", 0)), "/+$", "")
    days = (
        entries.select("list", pattern.alias("pattern"), F.col("day").cast("date").alias("day"), "listed")
        .na.drop()
        .groupBy("list", "pattern", "day")
        .agg(F.min("listed").alias("listed"))
    )
    # one row a day at most: a pattern's window has as many rows as there are days
    by_day = Window.partitionBy("list", "pattern").orderBy("day")
    changes = days.withColumn("before", F.lag("listed", 1, False).over(by_day)).filter("listed <> before")
    until = F.coalesce(F.lead("day").over(by_day), F.lit(FOREVER).cast("date"))
    return changes.withColumn("valid_to", until).filter("listed").select("list", "pattern", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (page_id, url, fetched) and what the lists said when they were fetched.

    Gives page_id, url, fetched, blocked, lists (names of the lists with a valid entry, sorted and
    comma-joined, or null) and n_entries (valid entries that the URL falls under).  Captures without
    a URL, a host or a time are not blocked.  Repeated captures give repeated rows.
    """
    narrow = captures.select("page_id", "url", F.col("fetched").cast("timestamp_ntz").alias("fetched"))
    intervals = validity_intervals(entries)
    span = narrow.agg(F.min("fetched").cast("date").alias("first"), F.max("fetched").cast("date").alias("last")).first()
    depth = intervals.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0

    def stretch(day: Column) -> Column:
        return F.floor(F.unix_date(day) / STRETCH)

    first, last = F.lit(span["first"]).cast("date"), F.lit(span["last"]).cast("date")
    touched = F.sequence(
        stretch(F.greatest("valid_from", first)), stretch(F.least(F.date_sub("valid_to", 1), last))
    )
    cut = intervals.filter((F.col("valid_from") <= last) & (F.col("valid_to") > first)).withColumn(
        "stretch", F.explode(touched)
    )
    looked_up = (
        narrow.select("url", "fetched")
        .na.drop()
        .distinct()
        .withColumn("pattern", F.explode(patterns_of(F.col("url"), depth)))
        .withColumn("day", F.col("fetched").cast("date"))
        .withColumn("stretch", stretch(F.col("day")))
    )
    valid = looked_up.join(cut, ["pattern", "stretch"]).filter("valid_from <= day AND day < valid_to")
    verdicts = valid.groupBy("url", "fetched").agg(
        F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"), F.count("*").alias("n_entries")
    )
    return narrow.join(verdicts, ["url", "fetched"], "left").select(
        "page_id",
        "url",
        "fetched",
        F.col("lists").isNotNull().alias("blocked"),
        "lists",
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
    )
