"""A chain of equi-joins over streams, with bounds in event time.

A row of the right side belongs to a left row if their keys are equal and its time is not more than
``before`` earlier and ``after`` later.  With the watermarks of both sides this says how long a row can
still find partners: state holds only such rows, and a left row of an outer step that has found
none is given out when its time has passed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.operators.joins import alias_of
from tierwise.spec import SpecError


@dataclass(frozen=True)
class StreamSide:
    """A stream, the column with its event time, and how late its rows may come."""

    frame: DataFrame
    time: str
    delay: str


@dataclass(frozen=True)
class StreamStep:
    """Join ``right`` to what has been joined so far, by keys and times of ``left``.

    ``before`` and ``after`` are intervals, such as ``1 hour``.  ``spreads`` deals the left rows of a key to so
    many tasks and repeats the right rows for each: for keys that hold a large part of a stream.
    """

    left: str
    right: str
    left_keys: tuple[str, ...]
    right_keys: tuple[str, ...]
    join_type: str = "left"
    before: str = "0 seconds"
    after: str = "0 seconds"
    spreads: int = 1

    def __post_init__(self) -> None:
        if self.join_type not in ("inner", "left"):
            raise SpecError(f"{self.right}: streams are joined inner or left, not {self.join_type}")
        if not self.left_keys or len(self.left_keys) != len(self.right_keys):
            raise SpecError(f"{self.right}: left_keys and right_keys need the same number of columns")


def join_streams(sides: Mapping[str, StreamSide], steps: Sequence[StreamStep]) -> DataFrame:
    """Fold the steps in declared order; columns are reachable as ``<name>_table.<column>``.

    Every step's ``left`` is the first step's, or one that an inner step has joined: times of rows that an
    outer step may have padded bound nothing.
    """
    if not steps:
        raise SpecError("a join chain needs at least one step")
    dated, joined = {steps[0].left}, {steps[0].left}
    chain = _side(sides, steps[0].left)
    for step in steps:
        if step.left not in dated:
            raise SpecError(f"{step.right}: '{step.left}' is not part of the chain, or may be padded")
        if step.right in joined:
            raise SpecError(f"{step.right} is joined already")
        right = _side(sides, step.right)
        left_time, right_time = (F.col(f"{alias_of(n)}.{sides[n].time}") for n in (step.left, step.right))
        left_keys = [F.col(f"{alias_of(step.left)}.{k}") for k in step.left_keys]
        right_keys = [F.col(f"{alias_of(step.right)}.{k}") for k in step.right_keys]
        match = [a == b for a, b in zip(left_keys, right_keys)]
        salts = f"__left_{step.right}", f"__right_{step.right}"
        if step.spreads > 1:
            chain = chain.withColumn(salts[0], F.pmod(F.xxhash64(left_time, *map(F.col, _columns(chain))), F.lit(step.spreads)).cast("int"))
            right = right.withColumn(salts[1], F.explode(F.sequence(F.lit(0), F.lit(step.spreads - 1))))
            match.append(F.col(salts[0]) == F.col(salts[1]))
        match += [right_time >= left_time - _interval(step.before), right_time <= left_time + _interval(step.after)]
        chain = chain.join(right, reduce(and_, match), step.join_type).drop(*salts)
        joined.add(step.right)
        if step.join_type == "inner":
            dated.add(step.right)
    return chain


def _side(sides: Mapping[str, StreamSide], name: str) -> DataFrame:
    if name not in sides:
        raise SpecError(f"stream '{name}' is not declared")
    side = sides[name]
    return side.frame.withWatermark(side.time, side.delay).alias(alias_of(name))


def _columns(chain: DataFrame) -> list[str]:
    """Names that are there once only."""
    return [c for c in chain.columns if chain.columns.count(c) == 1]


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")
