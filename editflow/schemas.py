"""Fixed schemas of every record editflow reads or writes.

Streaming sources need a declared schema, and a declared schema also spares batch jobs an
inference pass, so nothing in the engine infers types from the data.
"""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Raw envelope of one chat message: epoch-millisecond ingest time, channel, text, and the
# chat user that relayed it (the relay bot, not the editor).
CHAT_USER = StructType(
    [
        StructField("nick", StringType()),
        StructField("username", StringType()),
        StructField("host", StringType()),
    ]
)
ENVELOPE = StructType(
    [
        StructField("timestamp", LongType()),
        StructField("channel", StringType()),
        StructField("message", StringType()),
        StructField("user", CHAT_USER),
    ]
)

# One parsed edit, field order as in the parsed-topic JSON.
EDIT_TYPES = ("EDIT", "SPECIAL", "TALK")
EDIT = StructType(
    [
        StructField("type", StringType()),
        StructField("title", StringType()),
        StructField("user", StringType()),
        StructField("diffUrl", StringType()),
        StructField("byteDiff", IntegerType()),
        StructField("summary", StringType()),
        StructField("isMinor", BooleanType()),
        StructField("isNew", BooleanType()),
        StructField("isUnpatrolled", BooleanType()),
        StructField("isBotEdit", BooleanType()),
    ]
)
EDIT_FIELDS = [f.name for f in EDIT.fields]

# The raw edit table keeps the ten parsed columns in alphabetical order.
RAW_TABLE = StructType(sorted(EDIT.fields, key=lambda f: f.name))
# As stored by the streaming sink: one folder per micro-batch, so a replay replaces its batch.
RAW_TABLE_WITH_BATCH = StructType(RAW_TABLE.fields + [StructField("batch_id", LongType())])

# Historical edit counts per user (one row per user).
HISTORY = StructType([StructField("user", StringType()), StructField("no_of_edits", LongType())])

# Model features, in model order, then the scored row as stored.
FEATURES = [
    "type_bool",
    "summary_bytes",
    "total_byte_change",
    "addition_or_deletion",
    "isMinor",
    "isUnpatrolled",
    "isNew",
    "no_of_edits",
]
LABEL = "isBotEdit"
# Counts and sizes that can pass 32 bits are long. Partition and offset say which record a
# scored row came from; they may be NULL.
_LONG_FEATURES = {"total_byte_change", "no_of_edits"}
SCORED = StructType(
    [StructField("partition", IntegerType()), StructField("offset", LongType()), StructField("user", StringType())]
    + [StructField(name, LongType() if name in _LONG_FEATURES else IntegerType()) for name in FEATURES]
    + [StructField(LABEL, IntegerType()), StructField("predicted", IntegerType())]
)
SCORED_WITH_BATCH = StructType(SCORED.fields + [StructField("batch_id", LongType())])

# Common form of a topic record, for file-backed topics and message brokers alike.
TOPIC_RECORD = StructType(
    [
        StructField("key", StringType()),
        StructField("value", StringType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

# Per-batch metrics of the scoring stream.
BATCH_METRICS = StructType(
    [
        StructField("batch_id", LongType()),
        StructField("rows", LongType()),
        StructField("errors", LongType()),
        StructField("error_rate", DoubleType()),
    ]
)
