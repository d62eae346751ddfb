"""Parse raw notices into edits, keep rejected rows apart, and key edits by user.

Narrow transformations only: each task parses its own rows, nothing shuffles. The regex runs
once per row: its groups land in one column, and every field is then read from that column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editflow.functions import reuse
from editflow.functions.parse import edit_record, groups_from_parts, one_pass_parts, strict_int
from editflow.schemas import EDIT_FIELDS

_PARTS, _GROUPS, _BYTES = "_parts", "_groups", "_byte_diff"


def _with_groups(raw: DataFrame, message: str) -> DataFrame:
    # The one-pass regex gets its own projection: its result is read twice (length check and
    # value), so Catalyst keeps it there and evaluates it once per row.
    parts = reuse(("parts", message), lambda: one_pass_parts(F.col(message)))
    groups = reuse(("groups", message), lambda: groups_from_parts(F.col(_PARTS), F.col(message)))
    byte_diff = reuse("byte_diff", lambda: strict_int(F.col(_GROUPS).getItem(4)))
    staged = raw.withColumn(_PARTS, parts)
    grouped = staged.withColumn(_GROUPS, groups).drop(_PARTS)
    return grouped.withColumn(_BYTES, byte_diff)


def _record() -> F.Column:
    return reuse("edit_record", lambda: edit_record(F.col(_GROUPS), F.col(_BYTES)))


def _ok() -> F.Column:
    return reuse("parsed_ok", lambda: F.col(_GROUPS).isNotNull() & F.col(_BYTES).isNotNull())


# Rows are kept or dropped through a generator (``inline`` of a 0- or 1-element array), not
# a ``where``: Catalyst pushes a filter below the projection that computes the regex groups
# and substitutes the whole expression into it, so the regex would run twice per row. A
# generator is a barrier to that rewrite; it is still a narrow, per-row operator.


def parse_edits(raw: DataFrame, message: str = "message", keep: list[str] | None = None) -> DataFrame:
    """Rows whose ``message`` is a valid edit notice, as ``keep`` columns + the ten edit fields.

    Lines that do not match, whose byte count is not a 32-bit integer, or that are NULL are
    dropped here; ``parse_rejects`` returns exactly those rows.
    """
    # Input columns named like an edit field (the envelope's ``user`` is the relay bot) give
    # way to the parsed field.
    keep = [c for c in (keep if keep is not None else raw.columns) if c != message and c not in EDIT_FIELDS]
    record = _record()
    return _with_groups(raw, message).select(*keep, F.inline(F.when(_ok(), F.array(record))))


def parse_rejects(raw: DataFrame, message: str = "message") -> DataFrame:
    """The complement of ``parse_edits``: the raw rows that did not parse (quarantine)."""
    flag = F.struct(F.lit(True).alias("_rejected"))
    staged = _with_groups(raw, message).select(*raw.columns, F.inline(F.when(~_ok(), F.array(flag))))
    return staged.drop("_rejected")


def tag_edits(raw: DataFrame, message: str = "message") -> DataFrame:
    """``raw`` + ``_edit`` (the edit struct, NULL for a rejected row), one regex pass per row.

    For jobs that need both sides (edits and rejects) from one evaluation: persist the tagged
    frame, then take ``edits_from_tagged`` and ``rejects_from_tagged``.
    """
    record = _record()
    staged = _with_groups(raw, message)
    return staged.withColumn("_edit", F.when(_ok(), record)).drop(_GROUPS, _BYTES)


def edits_from_tagged(tagged: DataFrame, message: str = "message") -> DataFrame:
    keep = [c for c in tagged.columns if c not in ("_edit", message) and c not in EDIT_FIELDS]
    return tagged.where(F.col("_edit").isNotNull()).select(*keep, "_edit.*")


def rejects_from_tagged(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_edit").isNull()).drop("_edit")


def only_edits(edits: DataFrame) -> DataFrame:
    """Keep article edits (type EDIT), the rows that feed the per-user counts."""
    return edits.where(F.col("type") == "EDIT")
