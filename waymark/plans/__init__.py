"""Queries of every operator, with the SQL that gives the same rows."""

from __future__ import annotations

from . import guards, merging, pages, places, scalars, stores
from .base import CATALOGUE, Query

MODULES = (scalars, places, merging, pages, guards, stores)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOGUE.items() if sql}
