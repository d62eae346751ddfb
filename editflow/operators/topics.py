"""Topic-level operators: encode records, compare two copies, reader lag, channel filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editflow.operators.joins import fits_broadcast
from editflow.schemas import EDIT_FIELDS


def encode_raw(envelopes: DataFrame, envelope_col: str = "envelope") -> DataFrame:
    """Raw-topic key/value: key = ingest timestamp (text), value = envelope as JSON."""
    env = F.col(envelope_col)
    return envelopes.select(
        "*",
        env.getField("timestamp").cast("string").alias("key"),
        F.to_json(env).alias("value"),
    ).drop(envelope_col)


def encode_parsed(edits: DataFrame) -> DataFrame:
    """Parsed-topic key/value: key = editor, value = the edit record as JSON."""
    return edits.select(
        "*",
        F.col("user").alias("key"),
        F.to_json(F.struct(*[F.col(f) for f in EDIT_FIELDS])).alias("value"),
    )


def channels_filter(channel: Column, channel_list: str) -> Column:
    """``channel`` is one of a comma-separated list (split once, JVM side)."""
    return F.array_contains(F.split(F.lit(channel_list), ","), channel)


def topic_diff(left: DataFrame, right: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Records present in one copy and not the other (multiset difference both ways).

    One pass: every record counts +1 on the left and -1 on the right, the sums are partial
    before the one shuffle, and what is not zero comes out as often as it is missing.
    """
    cols = cols or ["key", "value"]
    both = left.select(*cols, F.lit(1).alias("_d")).unionByName(right.select(*cols, F.lit(-1).alias("_d")))
    sums = both.groupBy(*cols).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    side = F.when(F.col("_d") > 0, "left_only").otherwise("right_only").alias("side")
    return sums.select(*cols, side, F.explode(F.sequence(F.lit(1), F.abs("_d"))).alias("_k")).drop("_k")


def topic_fingerprint(records: DataFrame) -> DataFrame:
    """Per partition: record count and an order-independent checksum (for replica checks).

    The checksum sums the first 60 bits of each record's MD5 as a decimal, which no number of
    records overflows; a NULL key, value or offset counts as empty.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws("|", part("key"), part("value"), part("offset")))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    return records.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"), F.sum(number).cast("string").alias("checksum"),
    )


def _digest_number(records: DataFrame) -> Column:
    """60 bits of a record's MD5 over key, value and place, as a decimal; NULLs count as a mark of their own."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    digest = F.md5(F.concat_ws("|", part("key"), part("value"), F.col("partition"), F.col("offset")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")


def _differing(both: DataFrame, size: int) -> DataFrame:
    """Ranges of ``size`` offsets of a partition whose signed sums over both copies aren't zero."""
    ranges = both.groupBy("partition", F.floor(F.col("offset") / F.lit(size)).alias("range")).agg(
        F.sum("_d").alias("_n"), F.sum(F.col("_d") * F.col("_h")).alias("_s"))
    return ranges.where("_n <> 0 or _s <> 0").select("partition", "range")


def _within(records: DataFrame, ranges: DataFrame, size: int) -> DataFrame:
    """The records of some ranges. Each partition's span of ranges is a filter of its own (one for each
    partition of the topic), which reaches the files of a topic that is stored in order."""
    spans = ranges.groupBy("partition").agg(F.min("range").alias("low"), F.max("range").alias("high")).collect()
    span = F.lit(False)
    for s in spans:
        span = span | ((F.col("partition") == s["partition"]) & (F.col("offset") >= s["low"] * size)
                       & (F.col("offset") < (s["high"] + 1) * size))
    wanted = ranges.withColumnsRenamed({"partition": "_p", "range": "_r"})
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    at = (F.col("partition") == F.col("_p")) & (F.floor(F.col("offset") / F.lit(size)) == F.col("_r"))
    return records.where(span).join(wanted, at, "left_semi")


def topic_diff_ranges(left: DataFrame, right: DataFrame, fan: int = 1024, leaf: int = 1024) -> DataFrame:
    """Where two copies of a topic differ: (partition, offset, key, value, side), found by descending a
    tree of range fingerprints.

    The first pass sums a fingerprint of every record (+ on the left, - on the right) over wide ranges of
    each partition's offsets; equal copies end here after one partially aggregated pass. Every further
    pass reads only ranges that differ, ``fan`` times narrower, down to ``leaf`` offsets, where the records
    themselves are compared. Records without partition or offset are compared directly. A difference goes
    unseen only if sums of 60-bit hashes agree by chance.
    """
    cols = ["partition", "offset", "key", "value"]
    placed = F.col("partition").isNotNull() & F.col("offset").isNotNull()
    sides = [df.select(*cols) for df in (left, right)]
    loose = topic_diff(*(s.where(~placed) for s in sides), cols=cols)
    sides = [s.where(placed) for s in sides]
    top = max(s.agg(F.max("offset")).first()[0] or 0 for s in sides) + 1
    size = leaf
    while size * fan < top:
        size *= fan
    while True:
        signed = [s.withColumns({"_h": _digest_number(s), "_d": F.lit(d)}) for s, d in zip(sides, (1, -1), strict=True)]
        ranges = _differing(signed[0].unionByName(signed[1]), size).checkpoint()
        sides = [_within(s, ranges, size) for s in sides]
        if size <= leaf:
            return topic_diff(*sides, cols=cols).unionByName(loose)
        size = max(leaf, size // fan)


def topic_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: end offset (last + 1), committed position and their difference.

    ``committed`` holds (topic, partition, committed_offset) = next offset to read; a
    partition with nothing committed lags by its whole length.
    """
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    joined = ends.join(committed, ["topic", "partition"], "left")
    return joined.select(
        "topic",
        "partition",
        "end_offset",
        F.coalesce("committed_offset", F.lit(0)).cast("long").alias("committed_offset"),
        (F.col("end_offset") - F.coalesce("committed_offset", F.lit(0))).cast("long").alias("lag"),
    )
