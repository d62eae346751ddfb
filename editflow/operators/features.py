"""Model features from parsed edits, and the missing-value rules before scoring.

Pure projections (no shuffle), expressed as built-in column functions so they fuse into the
same code-generated stage as the parser.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.schemas import FEATURES, LABEL

# Columns left out of the model vector (the key and the label).
NOT_FEATURES = ("user", LABEL)


# Each model column as SQL text over a parsed edit with the two derived columns: the one
# definition that the DataFrame form and the SQL view share. The absolute value is taken of a
# long: the smallest 32-bit byte count has no positive counterpart of its own width.
FEATURE_SQL = {
    "user": "user",
    "type_bool": "type_bool",
    "summary_bytes": "length(summary)",
    "total_byte_change": "abs(cast(byteDiff AS bigint))",
    **{c: f"cast({c} AS int)" for c in ("addition_or_deletion", LABEL, "isMinor", "isUnpatrolled", "isNew")},
}


def derive_columns(edits: DataFrame) -> DataFrame:
    """Add ``addition_or_deletion`` (byteDiff > 0) and ``type_bool`` (type is EDIT, 0/1)."""
    return edits.withColumn("addition_or_deletion", F.col("byteDiff") > F.lit(0)).withColumn(
        "type_bool", (F.col("type") == "EDIT").cast("int")
    )


def feature_rows(edits: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The nine model columns: user, type_bool, summary length in characters, |byteDiff|,
    and the four flags and the sign as 0/1 integers (plus any ``keep`` columns first)."""
    derived = derive_columns(edits)
    return derived.select(*(keep or []), *(F.expr(text).alias(name) for name, text in FEATURE_SQL.items()))


def feature_columns(df: DataFrame, ignore: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    """Model inputs by exclusion, in model order (plan-time list, no data touched)."""
    present = [c for c in df.columns if c not in ignore]
    return [c for c in FEATURES if c in present]


def fill_missing_history(df: DataFrame, fill: int = 1) -> DataFrame:
    """A user without history counts as ``fill`` edits."""
    return df.fillna({"no_of_edits": fill})


def drop_incomplete(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with any NULL (run after the fill, so a NULL user is dropped here).

    ``ignore`` names columns that may be NULL: where a record came from is no model input.
    """
    return df.dropna("any", subset=[c for c in df.columns if c not in ignore])
