"""Keyset pagination: cursors, ordering with explicit null placement, and the n + 1 page."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT, MAX_LIMIT = 100, 1000


class CursorError(ValueError):
    """A cursor that no page of this kind has returned."""


@dataclass(frozen=True)
class Key:
    name: str
    descending: bool = False
    nulls_last: bool = True

    def order(self) -> Column:
        column = F.col(self.name)
        if self.descending:
            return column.desc_nulls_last() if self.nulls_last else column.desc_nulls_first()
        return column.asc_nulls_last() if self.nulls_last else column.asc_nulls_first()

    def after(self, value) -> Column:
        """Rows that come strictly later than ``value`` on this key, null having its place."""
        column = F.col(self.name)
        if value is None:
            return F.lit(False) if self.nulls_last else column.isNotNull()
        later = column < F.lit(value) if self.descending else column > F.lit(value)
        return (later | column.isNull()) if self.nulls_last else F.coalesce(later, F.lit(False))

    def same(self, value) -> Column:
        return F.col(self.name).eqNullSafe(F.lit(value))


def after_cursor(keys: Sequence[Key], values: Sequence) -> Column:
    """Lexicographic "later than", so that null tails are a branch of their own instead of a lost row."""
    if len(keys) != len(values):
        raise CursorError("the cursor has another number of keys")
    condition = F.lit(False)
    for k in reversed(range(len(keys))):
        condition = keys[k].after(values[k]) | (keys[k].same(values[k]) & condition)
    return condition


def row_after(columns: Sequence[str], values: Sequence) -> Column:
    """Row-value comparison (a, b) > (x, y) on columns without nulls."""
    return F.struct(*columns) > F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, values)])


def encode_cursor(values: Sequence) -> str:
    text = json.dumps(list(values), separators=(",", ":"), default=str)
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


def decode_cursor(cursor: str, n_keys: int) -> list:
    try:
        values = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
    except ValueError as error:
        raise CursorError("the cursor can't be read") from error
    if not isinstance(values, list) or len(values) != n_keys:
        raise CursorError("the cursor has another number of keys")
    return values


def checked_limit(limit: int | None) -> int:
    if limit is None:
        return DEFAULT_LIMIT
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be from 1 to {MAX_LIMIT}")
    return limit


def ordered_page(rows: DataFrame, keys: Sequence[Key], limit: int, cursor: Sequence | None = None) -> DataFrame:
    """The lazy page: filter after the cursor, order, ``limit`` rows (a top-k that no full sort precedes)."""
    if cursor is not None:
        rows = rows.where(after_cursor(keys, cursor))
    return rows.orderBy(*[k.order() for k in keys]).limit(limit)


def fetch_page(rows: DataFrame, keys: Sequence[Key], limit: int | None = None, cursor: str | None = None) -> tuple[list, str | None]:
    """Rows of one page and the cursor of the next, which there is only if one more row was found."""
    limit = checked_limit(limit)
    values = decode_cursor(cursor, len(keys)) if cursor else None
    found = ordered_page(rows, keys, limit + 1, values).collect()
    page = found[:limit]
    following = encode_cursor([page[-1][k.name] for k in keys]) if len(found) > limit else None
    return page, following
