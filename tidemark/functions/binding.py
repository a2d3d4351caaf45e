"""A value that an expression names often, found once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value found once however often `then` names it: a lambda's variable isn't computed again. Inside other
    lambdas nothing else shares it, as Spark's common subexpressions end there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))
