"""Registered queries: each reads the test tables under ``sf_dir`` and returns a DataFrame.

``QUERIES[name](spark, sf_dir)`` is the Spark plan; ``ORACLE[name]`` (when the operation is
expressible in SQL) is independent DuckDB SQL over the same tables. Every query reads whole
tables; none filters rows to make the check cheaper.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.functions import json as fjson
from editflow.functions.parse import strict_int
from editflow.functions.text import edit_text, envelope, envelope_text, epoch_millis
from editflow.operators import aggregates as agg
from editflow.operators import features as feat
from editflow.operators import joins
from editflow.operators import topics as ops_topics
from editflow.operators.display import first_rows
from editflow.operators.parse import only_edits, parse_edits, parse_rejects
from editflow.plans import sql as S
from editflow.schemas import EDIT_FIELDS, RAW_TABLE, RAW_TABLE_WITH_BATCH
from editflow.session import scratch_path
from editflow.sources.tables import read_messages, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return wrap


# ---------------------------------------------------------------- shared building blocks


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_edits(read_messages(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past counts per user from the whole ``lineitem`` table (one row per supplier number).

    The numbers are a subset of the users', so users without history exist at every scale.
    """
    items = read_table(spark, sf_dir, "lineitem")
    return items.groupBy(F.concat(F.lit("user"), F.col("l_suppkey").cast("string")).alias("user")).agg(
        F.count(F.lit(1)).alias("no_of_edits")
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.feature_rows(parsed(spark, sf_dir), keep=["event_id"])


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = joins.enrich_with_history(features(spark, sf_dir), history(spark, sf_dir))
    return feat.drop_incomplete(model)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_messages(spark, sf_dir)
    return raw.select(
        "event_id",
        envelope(
            epoch_millis(F.col("ts")),
            F.col("channel"),
            F.col("message"),
            F.lit("relay-bot"),
            F.lit("~relay-bot"),
            F.lit("relay.example"),
        ).alias("envelope"),
    )


def rule_prediction(df: DataFrame) -> DataFrame:
    """Rule-based stand-in for a model: predicts a bot when |byteDiff| > 500."""
    return df.withColumn("predicted", (F.col("total_byte_change") > 500).cast("int"))


FEATURE_COLS = [
    "user", "type_bool", "summary_bytes", "total_byte_change", "addition_or_deletion",
    "isBotEdit", "isMinor", "isUnpatrolled", "isNew",
]
_Q = ", ".join(f'"{c}"' for c in FEATURE_COLS)
_EDIT_Q = ", ".join(f'"{c}"' for c in EDIT_FIELDS)

# ---------------------------------------------------------------- parsing


@register("parse_edits", S.parsed_query(f"SELECT event_id, channel, {_EDIT_Q} FROM parsed"))
def q_parse_edits(spark, sf_dir):
    return parsed(spark, sf_dir).select("event_id", "channel", *EDIT_FIELDS)


@register("show_rows", S.parsed_query(f"SELECT event_id, channel, {_EDIT_Q} FROM parsed ORDER BY event_id LIMIT 20"))
def q_show_rows(spark, sf_dir):
    """L1: the 20 rows ``show()`` prints of the parsed batch (by event id, so repeatable)."""
    return first_rows(parsed(spark, sf_dir).select("event_id", "channel", *EDIT_FIELDS), ["event_id"])


@register(
    "parse_rejects",
    S.with_ctes(S.RAW, S.GROUPS, body="SELECT event_id, channel, message FROM grp2 WHERE NOT (m AND bd IS NOT NULL)"),
)
def q_parse_rejects(spark, sf_dir):
    return parse_rejects(read_messages(spark, sf_dir)).select("event_id", "channel", "message")


_INT_TEXT_SQL = """CASE event_id % 6
      WHEN 0 THEN CAST(user_id AS VARCHAR)
      WHEN 1 THEN ' ' || CAST(user_id AS VARCHAR)
      WHEN 2 THEN '+' || CAST(event_id AS VARCHAR)
      WHEN 3 THEN '-' || CAST(event_id * 100000 AS VARCHAR)
      WHEN 4 THEN CAST(event_id AS VARCHAR) || '0000000'
      ELSE props END"""


@register(
    "parse_int_guard",
    f"""SELECT event_id, txt AS "text",
      CASE WHEN regexp_matches(txt, '^[+-]?[0-9]+$') THEN TRY_CAST(txt AS INTEGER) END AS value
    FROM (SELECT event_id, {_INT_TEXT_SQL} AS txt FROM events)""",
)
def q_parse_int_guard(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    text = F.expr(_INT_TEXT_SQL.replace("VARCHAR", "STRING"))
    return events.select("event_id", text.alias("text")).select(
        "event_id", "text", strict_int(F.col("text")).alias("value")
    )


@register(
    "parse_flags",
    S.parsed_query('SELECT event_id, "isNew", "isMinor", "isUnpatrolled", "isBotEdit" FROM parsed'),
)
def q_parse_flags(spark, sf_dir):
    return parsed(spark, sf_dir).select("event_id", "isNew", "isMinor", "isUnpatrolled", "isBotEdit")


@register("classify_type", S.parsed_query('SELECT "type", count(*) AS n FROM parsed GROUP BY "type"'))
def q_classify_type(spark, sf_dir):
    return parsed(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@register(
    "edits_by_user",
    S.parsed_query("""SELECT "user", count(*) AS num_edits FROM parsed WHERE "type" = 'EDIT' GROUP BY "user\""""),
)
def q_edits_by_user(spark, sf_dir):
    return agg.edits_by_user(parsed(spark, sf_dir))


# ---------------------------------------------------------------- text and JSON forms


@register(
    "edit_to_text",
    S.parsed_query(
        """SELECT event_id, '[' || (CASE WHEN "isNew" THEN 'NEW ' ELSE '' END) || (CASE WHEN "isMinor" THEN 'MINOR ' ELSE '' END)
          || (CASE WHEN "isBotEdit" THEN 'BOT ' ELSE '' END) || (CASE WHEN "isUnpatrolled" THEN 'unpatrolled ' ELSE '' END)
          || "type" || ' by ' || "user" || '] SUMMARY:' || summary || ' TITLE: ' || title || ', DIFF['
          || CAST("byteDiff" AS VARCHAR) || ']: ' || "diffUrl" || ' ' AS line FROM parsed"""
    ),
)
def q_edit_to_text(spark, sf_dir):
    return parsed(spark, sf_dir).select("event_id", edit_text().alias("line"))


_EPOCH_MS = "CAST(epoch_us(ts) // 1000 AS BIGINT)"


@register(
    "envelope_to_text",
    S.with_ctes(
        S.RAW,
        body=f"SELECT event_id, 'IRCMessage ' || CAST({_EPOCH_MS} AS VARCHAR) || chr(9) || channel || chr(9) || message AS line FROM raw",
    ),
)
def q_envelope_to_text(spark, sf_dir):
    env = envelopes(spark, sf_dir)
    e = F.col("envelope")
    return env.select(
        "event_id",
        envelope_text(e.getField("timestamp"), e.getField("channel"), e.getField("message")).alias("line"),
    )


@register(
    "envelope_build",
    S.with_ctes(
        S.RAW,
        body=f"""SELECT event_id, {_EPOCH_MS} AS "timestamp", channel, message,
          'relay-bot' AS nick, '~relay-bot' AS username, 'relay.example' AS host FROM raw""",
    ),
)
def q_envelope_build(spark, sf_dir):
    return envelopes(spark, sf_dir).select(
        "event_id", "envelope.timestamp", "envelope.channel", "envelope.message",
        "envelope.user.nick", "envelope.user.username", "envelope.user.host",
    )


@register(
    "topic_encode_raw",
    S.with_ctes(
        S.RAW,
        body=f"""SELECT event_id, CAST({_EPOCH_MS} AS VARCHAR) AS "key",
          to_json({{'timestamp': {_EPOCH_MS}, 'channel': channel, 'message': message,
                   'user': {{'nick': 'relay-bot', 'username': '~relay-bot', 'host': 'relay.example'}}}}) AS "value"
          FROM raw""",
    ),
)
def q_topic_encode_raw(spark, sf_dir):
    return ops_topics.encode_raw(envelopes(spark, sf_dir)).select("event_id", "key", "value")


@register(
    "topic_encode_parsed",
    S.parsed_query(
        f"""SELECT event_id, "user" AS "key", to_json({{'type': "type", 'title': title, 'user': "user",
          'diffUrl': "diffUrl", 'byteDiff': "byteDiff", 'summary': summary, 'isMinor': "isMinor", 'isNew': "isNew",
          'isUnpatrolled': "isUnpatrolled", 'isBotEdit': "isBotEdit"}}) AS "value" FROM parsed"""
    ),
)
def q_topic_encode_parsed(spark, sf_dir):
    return ops_topics.encode_parsed(parsed(spark, sf_dir)).select("event_id", "key", "value")


_PROPS_SCHEMA = "k INT"


@register(
    "json_decode_props",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN json_valid(props) THEN NULL ELSE props END AS corrupt FROM events""",
)
def q_json_decode_props(spark, sf_dir):
    from pyspark.sql.types import StructType

    events = read_table(spark, sf_dir, "events")
    decoded = fjson.decode(F.col("props"), StructType.fromDDL(_PROPS_SCHEMA))
    return events.select("event_id", decoded.alias("d")).select(
        "event_id", F.col("d.k").alias("k"), F.col(f"d.{fjson.CORRUPT}").alias("corrupt")
    )


@register(
    "json_normalize",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE '{"k":' || (props ->> 'k') || '}' END AS normalized
       FROM events""",
)
def q_json_normalize(spark, sf_dir):
    """Every fifth document is cut short: a malformed one gives NULL, for the quarantine."""
    events = read_table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 5 == 0, F.substring("props", 1, 3)).otherwise(F.col("props"))
    return events.select("event_id", fjson.normalize(text).alias("normalized"))


# ---------------------------------------------------------------- SQL view, features, nesting


@register("feature_rows", S.parsed_query(f"SELECT event_id, {_Q} FROM feat", S.FEATURES))
def q_feature_rows(spark, sf_dir):
    return features(spark, sf_dir)


@register("sql_view", S.parsed_query(f"SELECT event_id, {_Q} FROM feat", S.FEATURES))
def q_sql_view(spark, sf_dir):
    """The projection written as SQL text over a temp view of the batch."""
    import uuid

    view = f"edits_{uuid.uuid4().hex[:12]}"
    feat.derive_columns(parsed(spark, sf_dir)).createOrReplaceTempView(view)
    columns = ", ".join(f"{text} AS {name}" for name, text in feat.FEATURE_SQL.items())
    return spark.sql(f"SELECT event_id, {columns} FROM {view}")


_SCORED_SQL = (
    'SELECT "user", type_bool, summary_bytes, total_byte_change, addition_or_deletion, "isMinor", '
    '"isUnpatrolled", "isNew", no_of_edits, "isBotEdit", CAST(total_byte_change > 500 AS INTEGER) AS predicted FROM enr'
)


@register("nested_project", S.parsed_query(_SCORED_SQL, S.FEATURES, S.HISTORY, S.ENRICHED))
def q_nested_project(spark, sf_dir):
    scored = rule_prediction(enriched(spark, sf_dir))
    cols = [c for c in scored.columns if c != "predicted"]
    wrapped = scored.select(
        F.struct(*cols).alias("cols"), F.struct(F.col("predicted").alias("predicted")).alias("predicted")
    )
    return wrapped.select(
        "cols.user", "cols.type_bool", "cols.summary_bytes", "cols.total_byte_change",
        "cols.addition_or_deletion", "cols.isMinor", "cols.isUnpatrolled", "cols.isNew",
        F.col("cols.no_of_edits").alias("no_of_edits"), "cols.isBotEdit", "predicted.predicted",
    )


# ---------------------------------------------------------------- joins and missing values


@register(
    "enrich_left_join",
    S.parsed_query(f"SELECT event_id, {_Q}, no_of_edits FROM enr", S.FEATURES, S.HISTORY, S.ENRICHED),
)
def q_enrich_left_join(spark, sf_dir):
    return enriched(spark, sf_dir)


@register(
    "enrich_skew_split",
    S.parsed_query(f"SELECT event_id, {_Q}, no_of_edits FROM enr", S.FEATURES, S.HISTORY, S.ENRICHED),
)
def q_enrich_skew_split(spark, sf_dir):
    """The same enrichment through the path taken when history is too big to broadcast."""
    model = joins.enrich_with_history(features(spark, sf_dir), history(spark, sf_dir), max_bytes=0)
    return feat.drop_incomplete(model)


@register(
    "enrich_bucketed",
    S.parsed_query(f"SELECT event_id, {_Q}, no_of_edits FROM enr", S.FEATURES, S.HISTORY, S.ENRICHED),
)
def q_enrich_bucketed(spark, sf_dir):
    """Enrichment above the broadcast bound against a history table bucketed by user: the
    history side is read in place, only the edits are shuffled (into as many buckets as the
    session has shuffle partitions)."""
    import uuid

    from editflow.sources.files import bucket_history

    name = f"user_counts_bucketed_{uuid.uuid4().hex[:12]}"
    table = bucket_history(history(spark, sf_dir), name, scratch_path(spark, name),
                           buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = joins.enrich_with_history(features(spark, sf_dir), table, max_bytes=0)
    return feat.drop_incomplete(model)


@register(
    "drop_incomplete",
    """SELECT o.o_orderkey, o.o_custkey, o.o_orderpriority, coalesce(s.s_name, 'UNKNOWN') AS s_name, s.s_nationkey
       FROM orders o LEFT JOIN supplier s ON o.o_custkey = s.s_suppkey
       WHERE s.s_nationkey IS NOT NULL AND o.o_orderpriority IS NOT NULL AND o.o_orderkey IS NOT NULL
         AND o.o_custkey IS NOT NULL""",
)
def q_drop_incomplete(spark, sf_dir):
    """Fill one column, then drop rows with any NULL: orders whose customer number is no
    supplier's are unmatched and go, as in the scorer."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    supplier = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("o_custkey"), "s_name", "s_nationkey"
    )
    joined = joins.left_join_checked(orders, supplier, "o_custkey")
    return feat.drop_incomplete(joined.fillna({"s_name": "UNKNOWN"}))


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register(
    "row_index",
    'SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS "index", '
    "l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem",
)
def q_row_index(spark, sf_dir):
    """Row number over all output columns: (orderkey, linenumber) repeats in this data, and
    ordering by every column leaves only ties between identical rows."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(*_LINE_ORDER)
    return joins.row_index(lineitem, _LINE_ORDER)


@register(
    "positional_join",
    """SELECT o."index", o.o_orderkey, c.c_custkey FROM
         (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index", o_orderkey FROM orders) o
         JOIN (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS "index", c_custkey FROM customer) c
         ON o."index" = c."index\"""",
)
def q_positional_join(spark, sf_dir):
    orders = joins.row_index(read_table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    customer = joins.row_index(read_table(spark, sf_dir, "customer").select("c_custkey"), ["c_custkey"])
    return joins.positional_join(orders, customer)


# ---------------------------------------------------------------- aggregates, changelog


@register(
    "changelog_text",
    S.parsed_query(
        """SELECT 'USER: ' || "user" || ' num.edits: ' || CAST(count(*) AS VARCHAR) AS line
           FROM parsed WHERE "type" = 'EDIT' GROUP BY "user\""""
    ),
)
def q_changelog_text(spark, sf_dir):
    return agg.changelog_text(agg.edits_by_user(parsed(spark, sf_dir)))


@register(
    "changelog_running",
    S.parsed_query(
        """SELECT event_id, "user", count(*) OVER (PARTITION BY "user" ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS num_edits
           FROM parsed WHERE "type" = 'EDIT'"""
    ),
)
def q_changelog_running(spark, sf_dir):
    edits = only_edits(parsed(spark, sf_dir)).select("event_id", "ts", "user")
    return agg.running_count(edits).select("event_id", "user", "num_edits")


@register(
    "changelog_compact",
    S.parsed_query("""SELECT "user", count(*) AS num_edits FROM parsed WHERE "type" = 'EDIT' GROUP BY "user\""""),
)
def q_changelog_compact(spark, sf_dir):
    """Four update batches (by event week) -> change rows -> compacted to the current counts."""
    edits = only_edits(parsed(spark, sf_dir))
    batches = edits.withColumn("seq", F.least(F.floor(F.dayofmonth("ts") / 8), F.lit(3)).cast("long"))
    per_batch = batches.groupBy("user", "seq").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    upto = Window.partitionBy("user").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    changes = per_batch.select("user", "seq", F.sum("n").over(upto).alias("num_edits"))
    return agg.compact_changelog(changes)


@register(
    "user_counts_ctas",
    S.parsed_query('SELECT "user", count("user") AS no_of_edits FROM parsed GROUP BY "user"'),
)
def q_user_counts_ctas(spark, sf_dir):
    """Store parsed edits in the raw table, then CREATE TABLE ... AS SELECT the counts."""
    import uuid

    from editflow.sources.files import create_tables, user_counts_as_select, write_raw_table

    suffix = uuid.uuid4().hex[:12]
    base = scratch_path(spark, "tables")
    names = create_tables(spark, base, prefix=f"t{suffix}_")
    write_raw_table(parsed(spark, sf_dir), f"{base}/{names['raw']}", batch_id=0)
    spark.sql(f"MSCK REPAIR TABLE {names['raw']}")
    counts = user_counts_as_select(spark, names["raw"], f"user_counts_{suffix}", f"{base}/user_counts")
    return spark.table(counts)


@register(
    "error_rate",
    S.parsed_query(
        """SELECT count_if("isBotEdit" <> predicted) AS errors, count(*) AS "rows",
             round(count_if("isBotEdit" <> predicted) / count(*), 6) AS error_rate
           FROM (SELECT "isBotEdit", CAST(total_byte_change > 500 AS INTEGER) AS predicted FROM enr)""",
        S.FEATURES, S.HISTORY, S.ENRICHED,
    ),
)
def q_error_rate(spark, sf_dir):
    return agg.error_rate(rule_prediction(enriched(spark, sf_dir)), label="isBotEdit")


@register(
    "confusion",
    S.parsed_query(
        """SELECT "isBotEdit" AS actual, CAST(total_byte_change > 500 AS INTEGER) AS predicted, count(*) AS n
           FROM enr GROUP BY 1, 2""",
        S.FEATURES, S.HISTORY, S.ENRICHED,
    ),
)
def q_confusion(spark, sf_dir):
    return agg.confusion(rule_prediction(enriched(spark, sf_dir)), label="isBotEdit")


@register(
    "channel_progress",
    S.with_ctes(
        S.RAW,
        body=f"SELECT channel, max({_EPOCH_MS}) AS last_timestamp, count(*) AS messages FROM raw GROUP BY channel",
    ),
)
def q_channel_progress(spark, sf_dir):
    env = envelopes(spark, sf_dir).select("envelope.channel", "envelope.timestamp")
    return agg.channel_progress(env)


CHANNELS = "#view,#click,#purchase"


@register(
    "channel_subset",
    S.with_ctes(S.RAW, body=f"SELECT event_id, channel, message FROM raw WHERE list_contains(string_split('{CHANNELS}', ','), channel)"),
)
def q_channel_subset(spark, sf_dir):
    raw = read_messages(spark, sf_dir)
    return raw.where(ops_topics.channels_filter(F.col("channel"), CHANNELS)).select("event_id", "channel", "message")


@register(
    "append_if_absent",
    S.parsed_query(
        """SELECT "user", arg_min(event_id, event_id) AS event_id, arg_min(title, event_id) AS title,
             arg_min("byteDiff", event_id) AS "byteDiff"
           FROM parsed WHERE "user" NOT IN (SELECT "user" FROM hist)
           GROUP BY "user\"""",
        S.HISTORY,
    ),
)
def q_append_if_absent(spark, sf_dir):
    """Append edits to a table keyed by user: one row (the earliest) per user, and only for
    users the table (here the history table) does not hold yet."""
    new_rows = parsed(spark, sf_dir).select("user", "event_id", "title", "byteDiff")
    return agg.append_if_absent(new_rows, history(spark, sf_dir), key="user", order="event_id")


# ---------------------------------------------------------------- files and tables


_HISTORY_SQL = S.with_ctes(S.HISTORY, body='SELECT "user", no_of_edits FROM hist')


@register("csv_roundtrip", _HISTORY_SQL)
def q_csv_roundtrip(spark, sf_dir):
    from editflow.sources.files import read_history_csv, write_history_csv

    path = scratch_path(spark, "user_counts_csv")
    write_history_csv(history(spark, sf_dir), path)
    return read_history_csv(spark, path)


@register("sink_raw_batch", S.parsed_query(
    "SELECT " + ", ".join(f'"{f.name}"' for f in RAW_TABLE.fields) + ", CAST(0 AS BIGINT) AS batch_id FROM parsed"
))
def q_sink_raw_batch(spark, sf_dir):
    from editflow.sources.files import write_raw_table

    path = scratch_path(spark, "wiki_edits_parsed")
    write_raw_table(parsed(spark, sf_dir), path, batch_id=0)
    write_raw_table(parsed(spark, sf_dir), path, batch_id=0)  # a replay overwrites, never doubles
    return spark.read.schema(RAW_TABLE_WITH_BATCH).parquet(path)


_SCORED_ROWS_SQL = (
    'SELECT CAST(event_id % 4 AS INTEGER) AS "partition", CAST(event_id // 4 AS BIGINT) AS "offset", "user", type_bool, '
    'summary_bytes, total_byte_change, addition_or_deletion, "isMinor", "isUnpatrolled", "isNew", no_of_edits, '
    '"isBotEdit", CAST(total_byte_change > 500 AS INTEGER) AS predicted, CAST(0 AS BIGINT) AS batch_id FROM enr'
)


def _scored_rows(spark, sf_dir):
    rows = rule_prediction(enriched(spark, sf_dir))
    return rows.withColumns({"partition": (F.col("event_id") % 4).cast("int"), "offset": F.floor(F.col("event_id") / 4)})


@register("sink_scored_batch", S.parsed_query(_SCORED_ROWS_SQL, S.FEATURES, S.HISTORY, S.ENRICHED))
def q_sink_scored_batch(spark, sf_dir):
    """Scored rows through the scored sink, read back with the declared schema (a replay overwrites)."""
    from editflow.schemas import SCORED_WITH_BATCH
    from editflow.sources.files import write_scored_table

    path = scratch_path(spark, "scored_data")
    for _ in range(2):
        write_scored_table(_scored_rows(spark, sf_dir), path, batch_id=0)
    return spark.read.schema(SCORED_WITH_BATCH).parquet(path)


@register("create_tables", S.parsed_query(_SCORED_ROWS_SQL, S.FEATURES, S.HISTORY, S.ENRICHED))
def q_create_tables(spark, sf_dir):
    """Both catalog tables created, scored rows written by the sink and read through the catalog."""
    import uuid

    from editflow.sources.files import create_tables, write_scored_table

    base = scratch_path(spark, "tables")
    names = create_tables(spark, base, prefix=f"t{uuid.uuid4().hex[:12]}_")
    write_scored_table(_scored_rows(spark, sf_dir), f"{base}/{names['scored']}", batch_id=0)
    spark.sql(f"MSCK REPAIR TABLE {names['scored']}")
    return spark.table(names["scored"])


@register(
    "json_infer_schema",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
)
def q_json_infer_schema(spark, sf_dir):
    """JSON strings to a table without a declared schema: inferred over all rows, then decoded."""
    from editflow.sources.files import infer_json_schema

    events = read_table(spark, sf_dir, "events")
    kind = infer_json_schema(events, "props")
    return events.select("event_id", F.from_json("props", kind).alias("d")).select(
        "event_id", F.col("d.k").cast("long").alias("k"))


__all__ = ["QUERIES", "ORACLE", "register"]
