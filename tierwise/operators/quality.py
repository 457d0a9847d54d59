"""Validation of a silver frame: row rules, uniqueness, references, quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.operators.keys import duplicate_keys
from tierwise.spec import Rule, as_tuple


def broken(rule: Rule) -> Column:
    """True where a row breaks the rule; never null."""
    value = F.col(rule.column) if rule.column else None
    if rule.kind == "not_null":
        return value.isNull()
    if rule.kind == "range":
        low = value < F.lit(rule.min) if rule.min is not None else F.lit(False)
        high = value > F.lit(rule.max) if rule.max is not None else F.lit(False)
        bad = low | high
    elif rule.kind == "in_set":
        bad = ~value.isin(*rule.values)
    elif rule.kind == "regex":
        bad = ~value.rlike(rule.pattern)
    elif rule.kind == "type":
        bad = value.try_cast(rule.as_type).isNull() & value.isNotNull()
    else:
        bad = ~F.expr(rule.expression)
    return F.coalesce(bad, F.lit(False))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, rows_checked, rows_bad) for all rules in one aggregate pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(broken(r)).alias(r.name) for r in rules]
    )
    return counts.unpivot(["__rows"], [r.name for r in rules], "rule", "rows_bad").select(
        "rule", F.col("__rows").alias("rows_checked"), "rows_bad"
    )


def with_failed_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    failed = F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]))
    return df.withColumn("failed_rules", failed)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the rules they break)."""
    checked = with_failed_rules(df, rules)
    valid = checked.filter(F.size("failed_rules") == 0).drop("failed_rules")
    return valid, checked.filter(F.size("failed_rules") > 0)


def verdicts_by_day(df: DataFrame, rules: Sequence[Rule], parts: Sequence[str]) -> DataFrame:
    """(parts, valid, rejected): how many rows of each day would go where."""
    fails = F.size("failed_rules") > 0
    counts = with_failed_rules(df, rules).groupBy(*parts)
    return counts.agg(F.count_if(~fails).alias("valid"), F.count_if(fails).alias("rejected"))


def not_unique(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    return duplicate_keys(df, as_tuple(keys))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key no parent row has.

    The parent is reduced to its distinct keys before the shuffle; a hot child key stays
    on the kept side, which adaptive execution may split.
    """
    known = parent.select(F.col(parent_key).alias("__parent")).distinct()
    referring = child.filter(F.col(child_key).isNotNull())
    return referring.join(known, F.col(child_key) == F.col("__parent"), "left_anti")
