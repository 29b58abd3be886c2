"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CATEGORY_SEPARATOR = " > "


def resource_id(col: Column | str) -> Column:
    """``'prefix/<id>'`` -> ``<id>`` as bigint.

    A name without a second segment gives NULL (so an inner join drops the
    row); a non-numeric second segment raises under ANSI casting, as a plain
    CAST does in the source dialect.
    """
    return F.get(F.split(F.col(col) if isinstance(col, str) else col, "/"), 1).cast("bigint")


def effective_price(sale_price: str = "sale_price", price: str = "price") -> Column:
    """Sale price if present, else the regular price."""
    return F.coalesce(F.col(f"{sale_price}.value"), F.col(f"{price}.value"))


def micros_to_units(col: Column | str) -> Column:
    """Integer micros to a double amount."""
    c = F.col(col) if isinstance(col, str) else col
    return c / F.lit(1e6)


def last_path_node(col: Column | str, separator: str = CATEGORY_SEPARATOR) -> Column:
    """Deepest node of a ``' > '``-separated path; NULL path gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_element_at(F.split(c, separator), F.lit(-1))


def full_category(*levels: str, separator: str = CATEGORY_SEPARATOR) -> Column:
    """Join category levels, skipping blanks and NULLs; all blank gives ''."""
    return F.concat_ws(separator, *[F.nullif(F.col(c), F.lit("")) for c in levels])


def array_or_empty(col: Column | str) -> Column:
    """Treat a NULL string array as empty (stored arrays can be NULL in Parquet)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.array().cast("array<string>"))
