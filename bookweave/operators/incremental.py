"""Life cycle of fact tables: skip what is there, replace, guard dependencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing(books: DataFrame, facts: DataFrame | None) -> DataFrame:
    """Books that have no row yet."""
    return books if facts is None else books.join(facts.select("barcode").distinct(), "barcode", "left_anti")


def upsert(facts: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of a book are replaced at once: stale values do not survive, unlike column-wise updates."""
    return facts.join(new.select("barcode").distinct(), "barcode", "left_anti").unionByName(new)


def delete_insert(facts: DataFrame, books: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the given books go, even where they get no new ones."""
    return facts.join(books.select("barcode").distinct(), "barcode", "left_anti").unionByName(new)


def window(books: DataFrame, offset: int | None = None, limit: int | None = None) -> DataFrame:
    d = books.orderBy("barcode")
    d = d.offset(offset) if offset else d
    return d if limit is None else d.limit(limit)


def require(complete: dict[str, DataFrame], books: DataFrame, *, present: dict[str, tuple[DataFrame, str]] | None = None) -> None:
    """ValueError unless each table has as many rows as books, and each present column a value somewhere."""
    n = books.count()
    for name, t in complete.items():
        if (m := t.count()) != n:
            raise ValueError(f"{name} has {m} rows for {n} books")
    for name, (t, c) in (present or {}).items():
        if t.filter(F.col(c).isNotNull()).isEmpty():
            raise ValueError(f"{name} has no {c}")


def status(tables: dict[str, DataFrame]) -> dict[str, int]:
    return {name: t.count() for name, t in tables.items()}
