"""Column expressions: no Python runs per row."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` applied to `value`, which is computed once however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
