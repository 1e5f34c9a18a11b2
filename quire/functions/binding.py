"""Values that an expression needs more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once: inside a lambda an expression is worked out anew for each element."""
    return F.element_at(F.transform(F.array(value), lambda v: then(v)), 1)
