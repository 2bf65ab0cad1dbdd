"""Row selection: condition and order builders, and the select entry point."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .spread import best_per_key


class UnknownConditionError(TypeError):
    """The condition is of a type no condition can be made from."""


class MalformedConditionError(ValueError):
    """The condition is a sequence of the wrong length."""


@dataclass(frozen=True)
class Where:
    column: str
    op: str
    value: Any


@dataclass(frozen=True)
class OrderBy:
    column: str
    descending: bool = True


def _equals(column: Column, value: Any) -> Column:
    return column.isNull() if value is None else column == value


_COMPARISONS: dict[str, Callable[[Column, Any], Column]] = {
    "==": _equals,
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
}


def where(condition: Where | Sequence[Any]) -> Where:
    """`(column, value)` means equality; `(column, op, value)` is explicit."""
    if isinstance(condition, Where):
        return condition
    if not isinstance(condition, (tuple, list)):
        raise UnknownConditionError(f"no condition can be made from {type(condition).__name__}")
    match list(condition):
        case [column, value]:
            return Where(column, "==", value)
        case [column, op, value]:
            return Where(column, op, value)
    raise MalformedConditionError(f"a condition has two or three parts, not {len(condition)}")


def order_by(condition: OrderBy | str | Sequence[Any]) -> OrderBy:
    """A column name alone sorts descending; `(column, descending)` is explicit."""
    if isinstance(condition, OrderBy):
        return condition
    if isinstance(condition, str):
        return OrderBy(condition)
    if not isinstance(condition, (tuple, list)):
        raise UnknownConditionError(f"no order can be made from {type(condition).__name__}")
    match list(condition):
        case [column]:
            return OrderBy(column)
        case [column, bool() as descending]:
            return OrderBy(column, descending)
        case [column, ("ASCENDING" | "DESCENDING") as direction]:
            return OrderBy(column, direction == "DESCENDING")
    raise MalformedConditionError(f"an order has one or two parts, not {condition!r}")


def predicate(df: DataFrame, condition: Where | Sequence[Any]) -> Column:
    """A boolean column for one condition on `df`."""
    wanted = where(condition)
    column = F.col(wanted.column)
    if wanted.op == "in":
        if isinstance(df.schema[wanted.column].dataType, T.ArrayType):
            return F.array_contains(column, wanted.value)
        return column.isin(list(wanted.value))
    if wanted.op not in _COMPARISONS:
        raise ValueError(f"unknown operator {wanted.op!r}")
    return _COMPARISONS[wanted.op](column, wanted.value)


def select_rows(
    df: DataFrame,
    filters: Sequence[Where | Sequence[Any]] = (),
    order: OrderBy | str | Sequence[Any] | None = None,
    limit: int | None = None,
    id_column: str | None = None,
) -> DataFrame:
    """All conditions together, then the order, then the limit; none is implied.

    Rows that tie in the order go by `id_column`, lowest first.
    """
    if filters:
        df = df.where(functools.reduce(operator.and_, [predicate(df, f) for f in filters]))
    if order is not None:
        wanted = order_by(order)
        ties = [F.asc(id_column)] if id_column and id_column != wanted.column else []
        df = df.orderBy(F.desc(wanted.column) if wanted.descending else F.asc(wanted.column), *ties)
    return df.limit(limit) if limit else df


def row_by_id(df: DataFrame, id_column: str, value: Any) -> DataFrame:
    """The row with this id; an unknown id gives no rows."""
    return df.where(F.col(id_column) == F.lit(value)).limit(1)


def rows_by_ids(df: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows of `df` for each distinct id of a frame of ids, in one join."""
    return df.join(ids.select(id_column).distinct(), id_column)


def keyed_rows(df: DataFrame, id_column: str, *later_first: Column) -> DataFrame:
    """One `(id, row)` pair per id; of duplicates, the one latest in order, or else of least hash."""
    row = F.struct(*[F.col(c) for c in df.columns]).alias("row")
    latest = best_per_key(df, [id_column], *(later_first or [F.xxhash64(*df.columns)]))
    return latest.select(F.col(id_column), row)


def id_first(df: DataFrame, id_column: str) -> DataFrame:
    return df.select(id_column, *[c for c in df.columns if c != id_column])


def within_window(stamp: Column, now: Column, days: int, backfill: bool = False) -> Column:
    """Strictly inside the last `days` before `now`; a backfill admits all."""
    if backfill:
        return F.lit(True)
    return (stamp > now - F.make_dt_interval(days=F.lit(days))) & (stamp < now)


def not_status(column: Column, dropped: str) -> Column:
    """True unless the status equals `dropped`; an unknown status is kept."""
    return ~column.eqNullSafe(F.lit(dropped))


def not_ignored(column: Column, ignored: Sequence[str | None]) -> Column:
    """Null-safe `not in`: a null name is dropped only if null is listed."""
    names = [name for name in ignored if name is not None]
    hit = F.coalesce(column.isin(names), F.lit(False)) if names else F.lit(False)
    if None in ignored:
        hit = hit | column.isNull()
    return ~hit


def filled(column: Column) -> Column:
    """Neither null nor empty."""
    return column > F.lit("")
