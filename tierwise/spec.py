"""Declarative job descriptions.

Every class builds itself from plain JSON with ``from_dict``.  Unknown values fail
here, on the driver, before Spark is asked to do anything.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import ClassVar

# Configuration vocabulary, file-name stamp and view suffix.
STAMP_PATTERN = r".*_(\d{4})(\d{2})(\d{2})\d{6}\..*"
STAMP_DIGITS = r".*_(\d{14})\..*"
STAMP_START = r"(.*_)\d{14}\..*"
VIEW_SUFFIX = "_table"
DATE_PARTS = ("year", "month", "day")
FILE_COLUMNS = (*DATE_PARTS, "filename")
JOIN_TYPES = {
    "inner": "inner",
    "cross": "inner",  # a cross join with an equality condition is an inner join
    "left": "left",
    "left_outer": "left",
    "leftouter": "left",
    "right": "right",
    "right_outer": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "full_outer": "full",
    "fullouter": "full",
    "semi": "left_semi",
    "left_semi": "left_semi",
    "leftsemi": "left_semi",
    "anti": "left_anti",
    "left_anti": "left_anti",
    "leftanti": "left_anti",
}
READ_FORMATS = ("csv", "json", "parquet", "orc", "text", "xml")


class SpecError(ValueError):
    """A job description that cannot be run."""


def load_json(path: str) -> dict:
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)


def as_tuple(value: str | Sequence[str] | None) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def as_bool(value: bool | str) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() == "true"


def _need(cfg: Mapping, key: str, where: str):
    if cfg.get(key) in (None, "", []):
        raise SpecError(f"{where}: '{key}' is required")
    return cfg[key]


def _one_of(value: str, allowed: Sequence[str], where: str) -> str:
    if value not in allowed:
        raise SpecError(f"{where}: '{value}' is not one of {', '.join(allowed)}")
    return value


@dataclass(frozen=True)
class Rule:
    """A named row rule.

    kind: ``not_null``, ``range`` (min and/or max, inclusive), ``in_set`` (values),
    ``regex`` (pattern found in the text), ``type`` (text parses as ``as_type``) or
    ``sql`` (a boolean expression).  Nulls only break ``not_null``.
    """

    name: str
    kind: str
    column: str | None = None
    min: object = None
    max: object = None
    values: tuple = ()
    pattern: str | None = None
    as_type: str | None = None
    expression: str | None = None

    # What each kind needs beside its name.
    NEEDS: ClassVar[Mapping[str, tuple[str, ...]]] = {
        "not_null": ("column",),
        "range": ("column",),
        "in_set": ("column", "values"),
        "regex": ("column", "pattern"),
        "type": ("column", "as_type"),
        "sql": ("expression",),
    }

    def __post_init__(self) -> None:
        where = f"rule {self.name}"
        _one_of(self.kind, tuple(self.NEEDS), where)
        for needed in self.NEEDS[self.kind]:
            if not getattr(self, needed):
                raise SpecError(f"{where}: '{needed}' is required")
        if self.kind == "range" and self.min is None and self.max is None:
            raise SpecError(f"{where}: a range needs min or max")

    @classmethod
    def from_dict(cls, cfg: Mapping) -> Rule:
        unknown = set(cfg) - set(cls.__dataclass_fields__)
        if unknown:
            raise SpecError(f"rule {cfg.get('name')}: unknown settings {sorted(unknown)}")
        return cls(**{**cfg, "values": tuple(cfg.get("values", ()))})


@dataclass(frozen=True)
class DatasetSpec:
    """A feed: the files of one directory whose names match ``pattern``.

    ``snapshot`` is ``latest`` (files carrying the newest stamp) or ``all``; it must be declared if
    files of more than one stamp match.
    ``schema`` is an optional DDL string; without it columns come as read.
    ``casts`` are applied with ``try_cast`` when the silver layer is read back.  Rows
    breaking one of ``rules`` go to ``quarantine_path`` instead of silver.  ``table``
    registers the silver folder as an external table; ``compact`` gathers each day's
    rows before writing silver.  ``schema_log`` names a folder in which the schema of each delivery is
    kept: deliveries may then differ, see ``sources.schemas``.
    """

    name: str
    input_path: str
    output_path: str | None = None
    format: str = "csv"
    pattern: str = ".*"
    header: bool = True
    delimiter: str = ","
    multiline: bool = True
    schema: str | None = None
    snapshot: str | None = None
    required: bool = False
    casts: Mapping[str, str] = field(default_factory=dict)
    options: Mapping[str, str] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    quarantine_path: str | None = None
    table: str | None = None
    compact: bool = False
    schema_log: str | None = None

    def __post_init__(self) -> None:
        if self.snapshot is not None:
            _one_of(self.snapshot, ("latest", "all"), f"dataset {self.name}")
        try:
            re.compile(self.pattern)
        except re.error as err:
            raise SpecError(f"dataset {self.name}: bad regex {self.pattern!r}: {err}") from err
        if self.rules and not self.quarantine_path:
            raise SpecError(f"dataset {self.name}: rules need a quarantine_path")

    @classmethod
    def from_dict(cls, name: str, cfg: Mapping) -> DatasetSpec:
        return cls(
            name=name,
            input_path=_need(cfg, "input_path", f"dataset {name}"),
            output_path=cfg.get("output_path"),
            format=cfg.get("format", "csv"),
            pattern=cfg.get("regex", ".*"),
            header=as_bool(cfg.get("header", True)),
            delimiter=cfg.get("delimiter", ","),
            multiline=as_bool(cfg.get("multiline", True)),
            schema=cfg.get("schema"),
            snapshot=cfg.get("snapshot"),
            required=as_bool(cfg.get("required", False)),
            casts=dict(cfg.get("casts", {})),
            options=dict(cfg.get("options", {})),
            rules=tuple(Rule.from_dict(r) for r in cfg.get("rules", ())),
            quarantine_path=cfg.get("quarantine_path"),
            schema_log=cfg.get("schema_log"),
            table=cfg.get("table"),
            compact=as_bool(cfg.get("compact", False)),
        )


@dataclass(frozen=True)
class JoinStep:
    """One equi-join of the chain.

    ``skew`` is ``salt`` (outer joins survive a hot key on a side they pad) or
    ``plain`` (the caller knows that side is unique on its key).
    """

    name: str
    left: str
    right: str
    left_keys: tuple[str, ...]
    right_keys: tuple[str, ...]
    join_type: str
    alias: str | None = None
    key_type: str | None = None
    skew: str = "salt"

    def __post_init__(self) -> None:
        if len(self.left_keys) != len(self.right_keys) or not self.left_keys:
            raise SpecError(f"{self.name}: left_key and right_key need the same number of columns")
        if self.join_type not in JOIN_TYPES.values():
            raise SpecError(f"{self.name}: unknown join type '{self.join_type}'")
        _one_of(self.skew, ("salt", "plain"), self.name)

    @property
    def right_name(self) -> str:
        return self.alias or self.right

    @classmethod
    def from_dict(cls, name: str, cfg: Mapping) -> JoinStep:
        join_type = str(_need(cfg, "join_type", name)).lower()
        return cls(
            name=name,
            left=_need(cfg, "left", name),
            right=_need(cfg, "right", name),
            left_keys=as_tuple(_need(cfg, "left_key", name)),
            right_keys=as_tuple(_need(cfg, "right_key", name)),
            join_type=JOIN_TYPES.get(join_type, join_type),
            alias=cfg.get("as"),
            key_type=cfg.get("key_type"),
            skew=cfg.get("skew", "salt"),
        )


@dataclass(frozen=True)
class OutputSpec:
    """Projection and sink of a report.

    ``date_parts`` are the three columns ``date_id`` is built from.  ``legacy_date_id``
    keeps the unpadded text form (``2024-1-1``) instead of a DATE.  ``dynamic`` replaces
    only the days the run produced.  ``table`` registers the folder as an external table; with ``versioned``
    the table is published through the catalog, see ``sinks.versions``, and read by its name.
    """

    path: str
    format: str = "parquet"
    select: tuple[str, ...] = ()
    date_parts: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ("date_id",)
    legacy_date_id: bool = False
    drop_unmatched: bool = False
    dynamic: bool = False
    table: str | None = None
    versioned: bool = False

    def __post_init__(self) -> None:
        if self.versioned and not (self.table and self.partition_by and self.format == "parquet"):
            raise SpecError("output: versioned needs a table, partition_by and the format parquet")

    @classmethod
    def from_dict(cls, cfg: Mapping) -> OutputSpec:
        return cls(
            path=_need(cfg, "path", "output"),
            format=cfg.get("format", "parquet"),
            select=as_tuple(cfg.get("select")),
            date_parts=as_tuple(cfg.get("date_parts")),
            partition_by=as_tuple(cfg.get("partition_by", "date_id")),
            legacy_date_id=as_bool(cfg.get("legacy_date_id", False)),
            drop_unmatched=as_bool(cfg.get("drop_unmatched", False)),
            dynamic=as_bool(cfg.get("dynamic", False)),
            table=cfg.get("table"),
            versioned=as_bool(cfg.get("versioned", False)),
        )


@dataclass(frozen=True)
class ReportSpec:
    datasets: Mapping[str, DatasetSpec]
    joins: tuple[JoinStep, ...]
    aggregations: Mapping[str, str]
    output: OutputSpec
    group_by: tuple[str, ...] = ()
    grouping: str = "group"

    def __post_init__(self) -> None:
        _one_of(self.grouping, ("group", "rollup", "cube"), "etl")
        for step in self.joins:
            for side in (step.left, step.right):
                known = set(self.datasets) | {s.right_name for s in self.joins}
                if side not in known:
                    raise SpecError(f"{step.name}: dataset '{side}' is not declared")

    @classmethod
    def from_dict(cls, cfg: Mapping) -> ReportSpec:
        etl = _need(cfg, "etl", "report")
        return cls(
            datasets={n: DatasetSpec.from_dict(n, d) for n, d in cfg.get("datasets", {}).items()},
            joins=tuple(JoinStep.from_dict(n, c) for n, c in etl.items() if n.startswith("join")),
            aggregations=dict(etl.get("aggregations", {})),
            output=OutputSpec.from_dict(_need(etl, "output", "etl")),
            group_by=as_tuple(etl.get("group_by")),
            grouping=etl.get("grouping", "group"),
        )


@dataclass(frozen=True)
class ScdSpec:
    """A gold dimension and the silver source merged into it.

    ``source_filter`` is a SQL condition on the silver layer, normally on its year, month
    and day, so that a run reads only new days.  Several source rows of one key are
    reduced to the latest by ``order_by``, or by the stamp of their files.  ``late_path`` gets
    the changes that are older than a type 2 history's record of deliveries, if it has none from the start.
    With ``versioned`` a type 1 dimension is the ``table``, published through the catalog below the target's
    path, see ``sinks.versions``.
    """

    source_path: str
    target_path: str
    join_keys: tuple[str, ...]
    scd_type: str = "scd1"
    compare: str = "null_safe"
    metadata_cols: tuple[str, ...] = ()
    compare_exclude: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    delete_missing: bool = False
    partition_by: tuple[str, ...] = ("date_id",)
    check_target: bool = True
    broadcast_limit_bytes: int = 64 << 20
    source_filter: str | None = None
    late_path: str | None = None
    table: str | None = None
    versioned: bool = False

    def __post_init__(self) -> None:
        _one_of(self.scd_type, ("scd1", "scd2"), "dimension")
        _one_of(self.compare, ("null_safe", "hash"), "dimension")
        if self.scd_type == "scd2" and (self.delete_missing or self.compare != "null_safe"):
            raise SpecError("dimension: delete_missing and compare are settings of type 1")
        if not self.join_keys:
            raise SpecError("dimension: join_keys must not be empty")
        if self.versioned and not (self.table and self.partition_by and self.scd_type == "scd1"):
            raise SpecError("dimension: versioned needs a table, partition_by and type 1")

    @classmethod
    def from_dict(cls, cfg: Mapping) -> ScdSpec:
        return cls(
            source_path=_need(cfg, "source_table", "dimension"),
            target_path=_need(cfg, "target_table", "dimension"),
            join_keys=as_tuple(_need(cfg, "join_keys", "dimension")),
            scd_type=cfg.get("scd_type", "scd1"),
            compare=cfg.get("compare", "null_safe"),
            metadata_cols=as_tuple(cfg.get("metadata_cols")),
            compare_exclude=as_tuple(cfg.get("compare_exclude")),
            order_by=as_tuple(cfg.get("order_by")),
            delete_missing=as_bool(cfg.get("delete_missing", False)),
            partition_by=as_tuple(cfg.get("partition_by", "date_id")),
            check_target=as_bool(cfg.get("check_target", True)),
            broadcast_limit_bytes=int(cfg.get("broadcast_limit_bytes", 64 << 20)),
            source_filter=cfg.get("source_filter"),
            late_path=cfg.get("late_path"),
            table=cfg.get("table"),
            versioned=as_bool(cfg.get("versioned", False)),
        )
