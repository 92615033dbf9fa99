"""Reuse of large column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from pyspark.sql import SparkSession

Built = TypeVar("Built")


def built_once(build: Callable[[], Built]) -> Callable[[], Built]:
    """Keeps what `build` returns for as long as its Spark session is the active one.

    A column expression belongs to no DataFrame, so it can be used in any number of
    queries; assembling a large one takes longer than planning it.
    """
    kept: dict = {}

    @wraps(build)
    def get() -> Built:
        session = SparkSession.getActiveSession()
        if session is None or kept.get("session") is not session:
            kept["value"] = build()
            kept["session"] = session
        return kept["value"]

    return get
