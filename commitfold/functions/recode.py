"""Code columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import TYPE_LIKE, TYPE_REPOST


def engagement_name(code: Column) -> Column:
    """1 is repost, 2 is like, anything else is null."""
    return F.when(code == TYPE_REPOST, "repost").when(code == TYPE_LIKE, "like")
