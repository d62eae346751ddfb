"""What a person looks at: the first rows of a batch (L1)."""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- Fixed value: the number of rows ``show()`` prints by default -------------------------
SHOW_ROWS = 20
# ------------------------------------------------------------------------------------------


def first_rows(df: DataFrame, order: list[str], n: int = SHOW_ROWS) -> DataFrame:
    """The first ``n`` rows in ``order``: what ``show()`` prints, made repeatable by the order.

    Planned as a top-k (``TakeOrderedAndProject``): each task keeps its own best ``n`` rows
    and one task merges ``n`` rows per task, so nothing else is sorted or moved.
    """
    return df.orderBy(*order).limit(n)
