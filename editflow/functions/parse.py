"""Column expressions that turn an edit-notice line into a typed edit record.

All of it is built-in Spark expressions (Java regex, string and conditional functions), so it
runs inside whole-stage code generation with no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: these must equal the source system's for identical results -----------
# Pattern of one edit notice, applied with an unanchored find; greedy groups are
# 1 title, 2 flags, 3 diff URL, 4 user, 5 byte count, 6 summary.
EDIT_PATTERN = r"\[\[(.*)\]\]\s(.*)\s(.*)\s\*\s(.*)\s\*\s\(\+?(.\d*)\)\s(.*)"
# Flag letters: N new page, M minor edit, ! unpatrolled, B bot edit.
FLAG_NEW, FLAG_MINOR, FLAG_UNPATROLLED, FLAG_BOT = "N", "M", "!", "B"
# Title prefixes of the two special page types (case-sensitive); everything else is EDIT.
SPECIAL_PREFIX, TALK_PREFIX = "Special:", "Talk:"
# ------------------------------------------------------------------------------------------

GROUPS = ("title", "flags", "diffUrl", "user", "byteDiffText", "summary")

# Separator for the one-pass extraction. Lines that contain it, or any character Java's
# "." does not match, go through the per-group path so that no row is lost or altered.
_SEP = "\u0001"
_UNSAFE_CHARS = "[\u0001\n\r\u0085\u2028\u2029]"
# "^.*?" + pattern + "$": the lazy prefix tries start positions left to right exactly like an
# unanchored find, and the final greedy group always reaches the end of a one-line message.
_ANCHORED = "^.*?" + EDIT_PATTERN + "$"
_REPLACEMENT = _SEP.join(f"${i}" for i in range(1, 7))
_INT_TEXT = r"^[+-]?[0-9]+$"


def one_pass_parts(message: Column) -> Column:
    """The six groups cut from one regex evaluation, as an array; NULL for a line with the
    separator or a line break (those take the per-group path). A line that does not match
    comes back unchanged from ``regexp_replace``, so its array has one element, not six."""
    parts = F.split(F.regexp_replace(message, _ANCHORED, _REPLACEMENT), _SEP)
    return F.when(~message.rlike(_UNSAFE_CHARS), parts)


def groups_from_parts(parts: Column, message: Column) -> Column:
    """ARRAY<STRING> of the six groups, or NULL when the line does not match.

    ``parts`` is ``one_pass_parts(message)``, computed in an earlier projection: it is used
    twice here (length check and value), and Catalyst keeps an expensive expression that is
    used twice in its own projection instead of inlining it, so the regex runs once per row.
    """
    per_group = F.array(*[F.regexp_extract(message, EDIT_PATTERN, i) for i in range(1, 7)])
    return (
        F.when(parts.isNotNull(), F.when(F.size(parts) == 6, parts))
        .when(message.rlike(EDIT_PATTERN), per_group)
    )


def strict_int(text: Column) -> Column:
    """Integer from text with an optional sign and ASCII digits only; NULL otherwise.

    ``try_cast`` alone would accept surrounding spaces; the guard rejects them, and overflow
    gives NULL through ``try_cast``.
    """
    return F.when(text.rlike(_INT_TEXT), text.try_cast("int"))


def edit_type(title: Column) -> Column:
    """SPECIAL / TALK by title prefix, EDIT otherwise (so ``User talk:`` pages are EDIT)."""
    return (
        F.when(title.startswith(SPECIAL_PREFIX), F.lit("SPECIAL"))
        .when(title.startswith(TALK_PREFIX), F.lit("TALK"))
        .otherwise(F.lit("EDIT"))
    )


def edit_record(groups: Column, byte_diff: Column) -> Column:
    """STRUCT of the ten edit fields from the six groups and the parsed byte count."""
    title, flags, diff_url, user, _, summary = (groups.getItem(i) for i in range(6))
    return F.struct(
        edit_type(title).alias("type"),
        title.alias("title"),
        user.alias("user"),
        diff_url.alias("diffUrl"),
        byte_diff.alias("byteDiff"),
        summary.alias("summary"),
        flags.contains(FLAG_MINOR).alias("isMinor"),
        flags.contains(FLAG_NEW).alias("isNew"),
        flags.contains(FLAG_UNPATROLLED).alias("isUnpatrolled"),
        flags.contains(FLAG_BOT).alias("isBotEdit"),
    )
