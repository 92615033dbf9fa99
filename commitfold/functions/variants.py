"""Access to open records held as VARIANT.

A missing path is SQL NULL, an explicit JSON null is a variant of kind VOID, so
"absent" and "null" stay distinguishable, as do the number 1 and the string "1".
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def node(rec: Column, path: str) -> Column:
    return F.try_variant_get(rec, path, "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_string(rec: Column, path: str) -> Column:
    return F.coalesce(kind(node(rec, path)) == "STRING", F.lit(False))


def absent(rec: Column, path: str) -> Column:
    return node(rec, path).isNull()


def string_at(rec: Column, path: str) -> Column:
    """The value as text. Scalars of other kinds are rendered; see `is_string`."""
    return F.try_variant_get(rec, path, "string")


def string_where(rec: Column, path: str, test) -> Column:
    """The path holds a string and `test` holds for it."""
    return is_string(rec, path) & F.coalesce(test(string_at(rec, path)), F.lit(False))


def integer_where(rec: Column, path: str, test) -> Column:
    """The path holds a whole number and `test` holds for it."""
    whole = F.coalesce(kind(node(rec, path)) == "BIGINT", F.lit(False))
    return whole & F.coalesce(test(F.try_variant_get(rec, path, "long")), F.lit(False))


def items_at(rec: Column, path: str) -> Column:
    """The array at the path as ARRAY<VARIANT>, null when it is no array."""
    return F.try_variant_get(rec, path, "array<variant>")


def every(rec: Column, path: str, test, max_items: int | None = None) -> Column:
    """The path holds an array, not too long, whose every item passes `test`."""
    items = items_at(rec, path)
    ok = F.coalesce(F.forall(items, lambda item: F.coalesce(test(item), F.lit(False))), F.lit(False))
    if max_items is not None:
        ok = F.coalesce(F.size(items) <= max_items, F.lit(False)) & ok
    return ok


def optional(rec: Column, path: str, ok: Column) -> Column:
    return absent(rec, path) | ok
