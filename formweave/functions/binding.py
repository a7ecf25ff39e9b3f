"""Naming an intermediate value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    A Column used twice is computed twice outside generated code, and always
    inside lambdas; a lambda's argument is computed once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
