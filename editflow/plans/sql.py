"""Independent SQL (DuckDB dialect) for the oracle check of each query.

The fragments below re-state the test-table adapter and the parser in plain SQL; they share
no code path with the Spark side except the pattern text itself. DuckDB's regex engine (RE2,
leftmost-first) gives the same groups as Java's for single-line messages.
"""

from __future__ import annotations

from editflow.functions.parse import EDIT_PATTERN

P = EDIT_PATTERN

RAW = """raw AS (
  SELECT event_id, ts, user_id, event_type, props, '#' || event_type AS channel,
    CASE WHEN event_id % 11 = 0
      THEN concat('[[Special:Log/', event_type, ']] hit  * user', CAST(user_id AS VARCHAR), ' *  no byte count')
      ELSE concat('[[', CASE event_type WHEN 'error' THEN 'Special:' WHEN 'signup' THEN 'Talk:' ELSE '' END,
        event_type, ' page ', CAST(event_id % 97 AS VARCHAR), ']] ',
        CASE event_id % 4 WHEN 0 THEN 'M' WHEN 1 THEN '!N' WHEN 2 THEN 'B' ELSE '' END,
        ' https://example.org/w/index.php?diff=', CAST(event_id AS VARCHAR), ' * user', CAST(user_id AS VARCHAR),
        ' * (', CASE WHEN event_id * 37 % 2001 >= 1000 THEN '+' ELSE '' END,
        CAST(event_id * 37 % 2001 - 1000 AS VARCHAR), ') ', props)
    END AS message
  FROM events)"""

GROUPS = f"""grp AS (
  SELECT *, coalesce(regexp_matches(message, '{P}'), false) AS m,
    regexp_extract(message, '{P}', 1) AS g1, regexp_extract(message, '{P}', 2) AS g2,
    regexp_extract(message, '{P}', 3) AS g3, regexp_extract(message, '{P}', 4) AS g4,
    regexp_extract(message, '{P}', 5) AS g5, regexp_extract(message, '{P}', 6) AS g6
  FROM raw),
grp2 AS (
  SELECT *, CASE WHEN m AND regexp_matches(g5, '^[+-]?[0-9]+$') THEN TRY_CAST(g5 AS INTEGER) END AS bd
  FROM grp)"""

PARSED = """parsed AS (
  SELECT event_id, ts, user_id, channel,
    CASE WHEN starts_with(g1, 'Special:') THEN 'SPECIAL' WHEN starts_with(g1, 'Talk:') THEN 'TALK' ELSE 'EDIT' END AS "type",
    g1 AS title, g4 AS "user", g3 AS "diffUrl", bd AS "byteDiff", g6 AS summary,
    contains(g2, 'M') AS "isMinor", contains(g2, 'N') AS "isNew",
    contains(g2, '!') AS "isUnpatrolled", contains(g2, 'B') AS "isBotEdit"
  FROM grp2 WHERE m AND bd IS NOT NULL)"""

FEATURES = """feat AS (
  SELECT event_id, "user", CAST("type" = 'EDIT' AS INTEGER) AS type_bool,
    CAST(length(summary) AS INTEGER) AS summary_bytes, abs(CAST("byteDiff" AS BIGINT)) AS total_byte_change,
    CAST("byteDiff" > 0 AS INTEGER) AS addition_or_deletion, CAST("isBotEdit" AS INTEGER) AS "isBotEdit",
    CAST("isMinor" AS INTEGER) AS "isMinor", CAST("isUnpatrolled" AS INTEGER) AS "isUnpatrolled",
    CAST("isNew" AS INTEGER) AS "isNew"
  FROM parsed)"""

# History: per-user counts from a whole table of its own (line items by supplier number); its
# keys are part of the users' numbers, so some users have no history row at any scale.
HISTORY = """hist AS (
  SELECT 'user' || CAST(l_suppkey AS VARCHAR) AS "user", count(*) AS no_of_edits
  FROM lineitem GROUP BY 1)"""

ENRICHED = """enr AS (
  SELECT f.*, coalesce(h.no_of_edits, 1) AS no_of_edits
  FROM feat f LEFT JOIN hist h ON f."user" = h."user")"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def parsed_query(body: str, *extra: str) -> str:
    return with_ctes(RAW, GROUPS, PARSED, *extra, body=body)
