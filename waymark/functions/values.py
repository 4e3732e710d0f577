"""Emptiness, truthiness and small array and map helpers, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``c``, which is computed once for a row however often ``f`` reads it: the start of a fold over nothing has a
    name in its finish, where an expression is written out again at each place. (An element of an array has one too, but
    Spark asks for its type at every row, which takes the longer the deeper such names are nested.)"""
    return F.aggregate(F.array().cast("array<int>"), c, lambda acc, _: acc, f)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, NULL if nothing is left."""
    t = F.trim(c)
    return F.when(t != "", t)


def is_empty(c: Column, words: Iterable[str] = ("N/A",)) -> Column:
    """NULL, blank, or one of ``words`` in any case. ``words=()`` is the plain variant; ("NAN", "NONE", "NULL") the all-text one."""
    upper = F.upper(F.trim(c))
    return c.isNull() | upper.isin("", *[w.upper() for w in words])


def is_empty_collection(c: Column) -> Column:
    """NULL or without elements, for arrays and maps."""
    return c.isNull() | (F.size(c) == 0)


def truthy_text(c: Column) -> Column:
    """The text, NULL where it is '' (blank text counts as text)."""
    return F.when(c != "", c)


def truthy_number(c: Column) -> Column:
    """The number, NULL where it is 0."""
    return F.when(c != 0, c)


def first_usable(c: Column) -> Column:
    """First element of a text array that is not empty, trimmed."""
    return F.trim(F.try_element_at(F.filter(c, lambda x: ~is_empty(x)), F.lit(1)))


def first_where(c: Column, predicate) -> Column:
    """First element for which ``predicate`` holds, else NULL."""
    return F.try_element_at(F.filter(c, predicate), F.lit(1))


def union_distinct(old: Column, new: Column) -> Column:
    """Elements of ``old`` then the new ones of ``new``, each once, order kept; NULL counts as none."""
    return F.when(old.isNull(), F.array_distinct(new)).when(new.isNull(), F.array_distinct(old)).otherwise(F.array_union(old, new))


def update_map(old: Column, new: Column) -> Column:
    """``old`` with the non-empty values of ``new``."""
    merged = F.map_zip_with(old, new, lambda k, o, n: F.coalesce(F.when(~is_empty(n, ()), n), o))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(merged)


def joined_sorted(c: Column, separator: str = "+") -> Column:
    """Distinct elements in order, joined."""
    return F.array_join(F.array_sort(F.array_distinct(c)), separator)


def from_json_or(c: Column, schema: str, default: str) -> Column:
    """Parsed JSON; ``default`` (JSON too) where the text is missing or broken."""
    return F.coalesce(F.from_json(c, schema), F.from_json(F.lit(default), schema))
