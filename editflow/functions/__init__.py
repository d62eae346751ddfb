"""Column expressions. ``reuse`` keeps fixed expressions built once per SparkContext."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark import SparkContext
from pyspark.sql import Column


def reuse(key: Hashable, build: Callable[[], Column]) -> Column:
    """The column ``build()`` makes, built once per SparkContext and then shared.

    A column expression refers to its inputs by name and is resolved separately in each plan
    that uses it, so one object serves every DataFrame (and every micro-batch). Building the
    large fixed expressions (the adapter's message, the parser's groups and record) costs
    hundreds of driver-to-JVM calls, which this pays once instead of per query.
    """
    sc = SparkContext._active_spark_context
    if sc is None:
        return build()
    cache = getattr(sc, "_editflow_columns", None)
    if cache is None:
        cache = sc._editflow_columns = {}
    col = cache.get(key)
    if col is None:
        col = cache[key] = build()
    return col
