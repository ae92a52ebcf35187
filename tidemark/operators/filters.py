"""Predicates of the read API: optional filters, arrays, escaped patterns, effective sets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The form of a semantic key, and how many a request may name: fixed values of the data model.
KEY_FORM, MOST_KEYS, MOST_PATTERN_CHARS = r"^[a-z][a-z0-9_]{0,127}(?![\s\S])", 50, 100


def where_equal(rows: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Equality filters, ANDed; a value of None is no predicate."""
    for name, value in values.items():
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
    return rows


def comma_values(text: str | None) -> list[str] | None:
    """What stands between commas and is not blank, trimmed; None if there is no text, an error if all of it is blank."""
    found = None if text is None else re.findall(r"[^\s,](?:[^,]*[^\s,])?", text)
    if found == []:
        raise ValueError("the list has no values")
    return found


def checked_keys(keys: Sequence[str]) -> list[str]:
    """Distinct semantic keys in the order given; the limit is on what is given."""
    if len(keys) > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} keys")
    if wrong := [key for key in keys if not re.fullmatch(KEY_FORM, key)]:
        raise ValueError(f"no semantic key: {wrong[0]!r}")
    return [key for k, key in enumerate(keys) if key not in keys[:k]]


def key_list(text: str | None) -> list[str] | None:
    """Semantic keys between commas, with blanks around them; a blank item is an error, unlike in ``comma_values``."""
    return None if text is None else checked_keys([item.strip(" ") for item in text.split(",")])


def contains_any_case(column: str, text: str) -> Column:
    """Case-insensitive containment of a literal text, which is trimmed first; its characters have no special meaning."""
    text = text.strip()
    if not text or len(text) > MOST_PATTERN_CHARS:
        raise ValueError(f"the text must have 1 to {MOST_PATTERN_CHARS} characters")
    return F.contains(F.lower(column), F.lower(F.lit(text)))


def any_of(column: str, values: Sequence[str]) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*map(F.lit, values)))


def all_of(column: str, values: Sequence[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, values)), F.col(column))) == 0


def scalar_or_member(scalar: str, array: str, value: str) -> Column:
    return F.coalesce(F.col(scalar) == value, F.lit(False)) | F.coalesce(F.array_contains(array, value), F.lit(False))


def object_matches(array: str, fields: Sequence[str], values: Sequence[str]) -> Column:
    """An element of an array of structs has one of the values in one of the fields."""
    return F.exists(array, lambda x: reduce(lambda a, b: a | b, [x[f].isin(*values) for f in fields]))


def starts_with_path(array: str, path: Sequence[str]) -> Column:
    return F.slice(F.col(array), 1, len(path)) == F.array(*map(F.lit, path))


def blank_to_null(column: Column) -> Column:
    return F.nullif(F.trim(column), F.lit(""))


def effective_set(own: str, default: Sequence[str], known: Sequence[str]) -> Column:
    """A row's own array replaces the default; null or empty means the default; an unknown item means the empty set."""
    column = F.col(own)
    valid = F.forall(own, lambda x: F.coalesce(x.isin(*known), F.lit(False)))
    fallback = F.array(*map(F.lit, default)) if default else F.array().cast("array<string>")
    return F.when(column.isNull() | (F.size(column) == 0), fallback).when(valid, column).otherwise(F.array().cast("array<string>"))


def retry_allowed(contract_valid: Column, item_failures: Column, charged_failures: Column, budget: int) -> Column:
    """Fewer item failures than the budget and fewer charged failures than five budgets, under a valid contract."""
    return contract_valid & (F.coalesce(item_failures, F.lit(0)) < budget) & (F.coalesce(charged_failures, F.lit(0)) < 5 * budget)


def is_due(last: Column, interval: Column, now: Column) -> Column:
    """Never done, or longer ago than the row's own interval."""
    return last.isNull() | (last < now - interval)


def violations(rows: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """Rows that fail a boolean SQL check (false or null), once per failed check, in a column ``check_name``."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)) for name, sql in checks.items()]))
    return rows.withColumn("check_name", F.explode(failed))
