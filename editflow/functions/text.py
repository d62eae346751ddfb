"""Readable text forms and the envelope constructor, as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: output formats that must equal the source system's -----------------
# Edit line: flag words (in this order, each followed by a space), then
# "[<flags><type> by <user>] SUMMARY:<summary> TITLE: <title>, DIFF[<byteDiff>]: <diffUrl> "
EDIT_TEXT_FORMAT = "[%s%s by %s] SUMMARY:%s TITLE: %s, DIFF[%d]: %s "
FLAG_WORDS = (("isNew", "NEW "), ("isMinor", "MINOR "), ("isBotEdit", "BOT "), ("isUnpatrolled", "unpatrolled "))
# Envelope line: this prefix, then timestamp, channel and message separated by tabs.
ENVELOPE_TEXT_PREFIX = "IRCMessage "
# Changelog line of the per-user counts.
CHANGELOG_FORMAT = "USER: %s num.edits: %d"
# ------------------------------------------------------------------------------------------


def flag_words(prefix: str = "") -> Column:
    """Concatenated flag words of an edit (empty string when no flag is set)."""
    return F.concat(
        *[F.when(F.col(prefix + flag), F.lit(word)).otherwise(F.lit("")) for flag, word in FLAG_WORDS]
    )


def edit_text(prefix: str = "") -> Column:
    """One readable line per edit (columns of the edit record, optionally under ``prefix``)."""
    c = lambda name: F.col(prefix + name)
    return F.format_string(
        EDIT_TEXT_FORMAT,
        flag_words(prefix), c("type"), c("user"), c("summary"), c("title"), c("byteDiff"), c("diffUrl"),
    )


def envelope_text(timestamp: Column, channel: Column, message: Column) -> Column:
    """Tab-separated readable line of one raw envelope."""
    return F.concat(
        F.lit(ENVELOPE_TEXT_PREFIX), F.concat_ws("\t", timestamp.cast("string"), channel, message)
    )


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since the epoch of a timestamp (session time zone is UTC)."""
    return F.unix_millis(ts.cast("timestamp"))


def envelope(
    timestamp_ms: Column,
    channel: Column,
    message: Column,
    nick: Column,
    username: Column,
    host: Column,
) -> Column:
    """The raw envelope struct; pass the ingest time as a column (``current_timestamp`` live)."""
    return F.struct(
        timestamp_ms.cast("long").alias("timestamp"),
        channel.alias("channel"),
        message.alias("message"),
        F.struct(nick.alias("nick"), username.alias("username"), host.alias("host")).alias("user"),
    )
