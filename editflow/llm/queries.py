"""Registered queries of the subpackage: thin digests over the operators, with DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.llm import (
    conversation_repair, divergence, html_text, knn_quality, license_scan, line_dedup, mixing, ngram_join, nn_descent, packing,
    pii_anchors, run_index, spelling_kdtree,
)
from editflow.llm.common import saved, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Place of the public vocabularies; a cluster sets its own path.
def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


# Added tokens of the vocabulary's JSON form, which its default encode finds in text.
SPECIALS = {"<|endoftext|>": 50256}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


@query("op4_line_bitmaps", """
WITH lines AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), shared AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT keyed.doc_id, i, line, top IS NOT NULL AND top <> doc_id AS gone FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op4_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select(
        "doc_id", F.col("kept_n_lines").alias("n_lines"), F.col("kept_n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


# Domains are no column of the table: a rule assigns each source to one of three.
def domain():
    return F.expr("concat('d', cast(conv(substring(md5(coalesce(source, '')), 1, 2), 16, 10) as int) % 3)")


MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {"domain": {"d0": 5, "d1": 3, "d2": 2}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1}}


def _fill_sql(level: str, above: list[str], children: str, parents: str) -> str:
    """DuckDB: share a parent's budget among its children by weight, within their capacity."""
    part = ", ".join(above) or "1"
    key = ", ".join([*above, level])
    using = f"JOIN {parents} USING ({', '.join(above)})" if above else f", {parents}"
    return f"""
{level}_a AS (
  SELECT {key}, cap, w, budget,
    coalesce(sum(cap) OVER (PARTITION BY {part} ORDER BY r, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER (PARTITION BY {part} ORDER BY r, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest, r
  FROM (SELECT *, cap::DOUBLE / w AS r FROM ({children})) {using} WHERE cap > 0),
{level}_b AS (SELECT *, cap::HUGEINT * w_rest <= (budget - before)::HUGEINT * w AS is_full FROM {level}_a),
{level}_c AS (
  SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {part}), 0) AS full_sum,
    sum(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {part}) AS w_open FROM {level}_b),
{level}_d AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE ((budget - full_sum)::HUGEINT * w) // w_open END AS part,
    sum(CASE WHEN is_full THEN 0 ELSE 1 END) OVER (PARTITION BY {part} ORDER BY r, {level}) AS nth FROM {level}_c),
{level}_n AS (
  SELECT {key}, (part + CASE WHEN NOT is_full AND nth <= budget - sum(part) OVER (PARTITION BY {part}) THEN 1 ELSE 0 END)::BIGINT AS budget
  FROM {level}_d)"""


def _case(column: str, given: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in given.items()) + " ELSE 1 END"


_W_DOMAIN, _W_LANG = _case("domain", MIX_WEIGHTS["domain"]), _case("lang", MIX_WEIGHTS["lang"])


@query("op1_hierarchical_mix", f"""
WITH rows_ AS (
  SELECT doc_id, 'd' || (('0x' || substr(md5(coalesce(source, '')), 1, 2))::INT % 3) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, 2 * sum(n_tokens)::BIGINT AS cap FROM rows_ GROUP BY ALL),
root AS (SELECT least(sum(tokens), sum(cap)) AS budget FROM leaves),
{_fill_sql("domain", [], f"SELECT domain, sum(cap) AS cap, {_W_DOMAIN} AS w FROM leaves GROUP BY domain", "root")},
{_fill_sql("lang", ["domain"], f"SELECT domain, lang, sum(cap) AS cap, {_W_LANG} AS w FROM leaves GROUP BY domain, lang", "domain_n")},
{_fill_sql("source", ["domain", "lang"], "SELECT domain, lang, source, cap, 1 AS w FROM leaves", "lang_n")},
plan AS (
  SELECT domain, lang, source, budget // tokens AS epochs, budget % tokens AS extra
  FROM source_n JOIN leaves USING (domain, lang, source) WHERE tokens > 0 AND budget > 0),
taken AS (SELECT * FROM rows_ JOIN plan USING (domain, lang, source) WHERE n_tokens > 0),
last AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
    ORDER BY md5(concat_ws('|', '1', epochs, doc_id)), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done
  FROM taken WHERE extra > 0)
SELECT doc_id, domain, lang, source, n_tokens, e AS epoch, n_tokens AS taken FROM taken, unnest(range(0, epochs)) AS u(e)
UNION ALL
SELECT doc_id, domain, lang, source, n_tokens, epochs, least(n_tokens, extra - done)::BIGINT FROM last WHERE done < extra
""")
def op1_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("domain", domain())
    mix = mixing.select(docs, MIX_LEVELS, MIX_WEIGHTS, F.col("corpus"), max_epochs=2, seed=1)
    return mix.select("doc_id", *MIX_LEVELS, "n_tokens", "epoch", "taken")


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_COMMON_SQL = "CASE lang " + " ".join(
    f"WHEN '{k}' THEN {_list(v)}" for k, v in divergence.COMMON_WORDS.items()) + " ELSE [] END"
_CHARS_SQL = ", ".join(
    "length(regexp_replace(t, '[^" + c.replace("'", "''") + "]+', '', 'g'))" for c in divergence._CLASSES)
_JS = """sqrt(greatest(0, list_sum([
    CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END / 2
    + CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END / 2
    FOR x IN list_transform(range(1, len({p}) + 1), lambda i: [{p}[i] / list_sum({p}), {q}[i] / list_sum({q})])])))"""


@query("op7_js_divergence", f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
        {_COMMON_SQL} AS commonlist FROM d),
g AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM w, unnest(range(1, len(words) - 1)) AS u(i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, unnest([0, 1, 2]) AS u(k) GROUP BY rid),
f AS (SELECT rid, doc_id, lang, t, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        [{_CHARS_SQL}] AS c0,
        list_transform(commonlist, lambda c: len(list_filter(words, lambda x: x = c))) AS w0
      FROM w LEFT JOIN rep USING (rid)),
h AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        list_append(c0, length(t) - list_sum(c0)) AS chars,
        list_append(w0, n_words - coalesce(list_sum(w0), 0)) AS commons FROM f),
ref AS (SELECT lang, list(c ORDER BY i) AS rc FROM (
          SELECT lang, i, sum(chars[i]) AS c FROM h, unnest(range(1, len(chars) + 1)) AS u(i) WHERE NOT base_failed GROUP BY lang, i) GROUP BY lang),
rew AS (SELECT lang, list(c ORDER BY i) AS rw FROM (
          SELECT lang, i, sum(commons[i]) AS c FROM h, unnest(range(1, len(commons) + 1)) AS u(i) WHERE NOT base_failed GROUP BY lang, i) GROUP BY lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
  AND NOT coalesce(length(t) >= 200 AND {_JS.format(p="chars", q="rc")} > 0.32, false)
  AND NOT coalesce(len(commons) > 1 AND {_JS.format(p="commons", q="rw")} > 0.36, false) AS kept
FROM h LEFT JOIN ref USING (lang) LEFT JOIN rew USING (lang)
""")
def op7_js_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def _license_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    places = " UNION ALL ".join(
        f"SELECT rid, '{label}' AS label, i - 1 AS place FROM d, unnest(range(1, len(words) + 1)) AS u(i) "
        f"WHERE words[i:i + {len(p.split()) - 1}] = {_list(p.split())}"
        for p, label in license_scan.PHRASES.items())
    templates = ", ".join(
        f"('{label}', {_list(sorted(set(text.split())))}, {_list(own.split())})" for label, text, own in license_scan.TEMPLATES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, {split.format(lower)} AS words FROM documents),
places AS ({places}),
base AS (SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM places GROUP BY rid),
templates(label, t, own) AS (VALUES {templates}),
blocks AS (SELECT rid, {split.format(lower.replace("coalesce(text, '')", "block"))} AS b
           FROM (SELECT rid, unnest(regexp_split_to_array(coalesce(text, ''), '{license_scan.BLOCK_BREAK}')) AS block FROM d)),
found AS (SELECT rid, label, max(len(list_intersect(t, list_distinct(b))) / len(t)) AS share FROM blocks, templates
          WHERE len(list_intersect(t, list_distinct(b))) >= ceil(round(0.8 * len(t), 9))
            AND len(list_intersect(own, list_distinct(b))) = len(own) GROUP BY rid, label),
labels AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
           FROM (SELECT rid, label FROM places UNION SELECT rid, label FROM found) GROUP BY rid),
base_labels AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid),
shares AS (SELECT rid, max(share) AS share FROM found GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN labels USING (rid) LEFT JOIN base_labels USING (rid) LEFT JOIN shares USING (rid)
"""


@query("op10_license_join", _license_sql())
def op10_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query("op8_genetic_packing")
def op8_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = vocabulary()
    cut = saved(packing.pieces(table(spark, sf_dir, "documents"), ranks, pattern, specials=SPECIALS), "pack-pieces")
    return packing.pack(cut).drop("uid")


@query("op6_neighbour_vote")
def op6_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = knn_quality.fit(docs, table(spark, sf_dir, "labels"))
    return knn_quality.score(docs, model, keep_text=False).select(
        "doc_id", knn_quality.held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"),
        F.when(F.col("quality_score") >= 0.3, 1).otherwise(0).alias("predicted"))


@query("op9_host_suffixes")
def op9_host_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op5_combination_prefixes")
def op5_combination_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(table(spark, sf_dir, "documents"))


@query("op3_run_index")
def op3_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return run_index.remove(docs, run_index.repeated_spans(docs)).drop("spans")


@query("op2_nn_descent")
def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings")).drop("recall")


def _pii_sql() -> str:
    P = pii_anchors
    q = lambda x: "'" + x.replace("'", "''") + "'"
    cases = lambda words: "|".join(sorted({c.replace(".", "\\.") for w in words for c in (w, w.upper(), w.capitalize())}))
    schemes = "|".join(sorted({c for s in P.SCHEMES for c in (s, s.upper())}))
    found = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "scheme": schemes, "at": "@", "cue": cases(P.CUES), "iban": cases(["iban"]), "social": cases(["ssn", "social security"]),
        "key": "AKIA|ASIA",
    }
    hits = " UNION ALL ".join(
        f"SELECT rid, t, '{k}' AS k, regexp_split_to_array(t, {q(r)}) AS parts, regexp_extract_all(t, {q(r)}) AS found FROM d WHERE regexp_matches(t, {q(r)})"
        for k, r in found.items())
    plain = lambda r: r.pattern.split("(?![")[0]
    behind = lambda r: f"regexp_extract(rest, {q('^(?:' + r + ')')})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
hits AS ({hits}),
places AS (
  SELECT rid, t, k, found[i] AS m, (list_sum(list_transform(parts[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
  FROM hits, unnest(range(1, len(found) + 1)) AS u(i)),
near AS (
  SELECT *, substr(t, s + 1 + length(m)) AS rest, regexp_replace(m, '[^0-9]+', '', 'g') AS digits,
    s = 0 OR NOT regexp_matches(substr(t, s, 1), '[\\pL\\pN_]') AS free FROM places),
spans AS (
  SELECT rid, k, s, s + length(m) AS e FROM near WHERE k = 'email'
    OR k = 'ip' AND list_bool_and(list_transform(string_split(m, '.'), lambda x: length(ltrim(x, '0')) < 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') <= '255')))
    OR k = 'card' AND length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
      CASE WHEN i % 2 = 0 THEN reverse(digits)[i + 1]::INT ELSE (2 * reverse(digits)[i + 1]::INT) // 10 + (2 * reverse(digits)[i + 1]::INT) % 10 END)) % 10 = 0
    OR k = 'phone' AND length(digits) BETWEEN 9 AND 15
  UNION ALL
  SELECT rid, 'address', s, s + length(rtrim(m || v, '.,;:-(')) FROM (
    SELECT *, CASE lower(m) WHEN 'mailto:' THEN {behind(P.MAILBOX.pattern)} WHEN 'tel:' THEN {behind(P.TELEPHONE.pattern)}
      ELSE {behind(P.USER_HOST.pattern)} END AS v FROM near WHERE k = 'scheme' AND free)
  WHERE v <> '' AND (lower(m) <> 'tel:' OR length(regexp_replace(v, '[^0-9]+', '', 'g')) BETWEEN 7 AND 15)
  UNION ALL
  SELECT rid, 'account', s, s + 1 + length(v) FROM (
    SELECT *, regexp_extract(rest, {q('^(' + plain(P.HANDLE) + ')(?:[^A-Za-z0-9_@.-]|$)')}, 1) AS v FROM near
    WHERE k = 'at' AND free AND (s = 0 OR NOT regexp_matches(substr(t, s, 1), '[A-Za-z0-9._%+-]'))) WHERE v <> ''
  UNION ALL
  SELECT rid, 'account', s + length(m) + length(lead), s + length(m) + length(lead) + length(v) FROM (
    SELECT *, rtrim(regexp_extract(rest, {q('^' + P.CUE_VALUE.pattern)}, 1), '.-') AS v,
      regexp_extract(rest, {q('^(' + P.CUE_VALUE.pattern.split('([A-Za-z0-9_+/.-]')[0] + ')')}, 1) AS lead FROM near WHERE k = 'cue' AND free)
  WHERE length(v) >= 6 AND regexp_matches(v, '[0-9]')
  UNION ALL
  SELECT rid, 'account', s + length(m) + length(lead), s + length(m) + length(lead) + length(v) FROM (
    SELECT *, regexp_extract(rest, {q('^' + plain(P.IBAN) + '(?:[^A-Za-z0-9]|$)')}, 1) AS v,
      regexp_extract(rest, '^[ :=#.]{{0,4}}') AS lead FROM near WHERE k = 'iban' AND free)
  WHERE v <> '' AND length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(
    list_transform(string_split(replace(v, ' ', '')[5:] || v[1:4], ''), lambda c: CASE WHEN c <= '9' THEN c::INT ELSE ascii(c) - 55 END),
    lambda r, x: (r * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97, 0) = 1
  UNION ALL
  SELECT rid, 'account', s + length(m) + length(lead), s + length(m) + length(lead) + length(v) FROM (
    SELECT *, regexp_extract(rest, {q('^' + plain(P.SOCIAL) + '(?:[^0-9-]|$)')}, 1) AS v,
      regexp_extract(rest, {q('^(' + P.SOCIAL.pattern.split('([0-9]')[0] + ')')}, 1) AS lead FROM near WHERE k = 'social' AND free) WHERE v <> ''
  UNION ALL
  SELECT rid, 'account', s, s + 20 FROM near WHERE k = 'key' AND free AND regexp_matches(rest, '^[A-Z0-9]{{16}}(?:[^A-Za-z0-9]|$)')),
each AS (SELECT DISTINCT rid, k, s, e, list_position({[*P.KINDS]!r}, k) AS o FROM spans),
joined AS (
  SELECT rid, count_if(k = 'email') AS n_email, count_if(k = 'ip') AS n_ip, count_if(k = 'card') AS n_card, count_if(k = 'phone') AS n_phone,
    string_agg(k || ':' || s || ':' || e, ',' ORDER BY s, o, e) FILTER (WHERE o <= {len(P.BASE_KINDS)}) AS base,
    string_agg(k || ':' || s || ':' || e, ',' ORDER BY s, o, e) AS spans FROM each GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
  coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN joined USING (rid)
"""


@query("op11_anchor_expansion", _pii_sql())
def op11_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_anchors.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii_spans")
    return found.select(
        "doc_id", *(pii_anchors.count_of(spans, k).alias(f"n_{k}") for k in pii_anchors.BASE_KINDS),
        F.sha2(pii_anchors.joined(spans, pii_anchors.BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        pii_anchors.joined(spans).alias("spans"))


# CRC-32 as DuckDB lacks it: a table of 256 remainders, then a fold over bytes.
_CRC_SQL = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, n)) AS tab)"""


def _crc_of(text: str) -> str:
    """CRC-32 of a string's UTF-8 bytes; needs ``crc`` in the FROM clause."""
    return (f"xor(list_reduce(list_transform(range(1, length(hex({text})), 2), lambda i: ('0x' || hex({text})[i:i + 1])::BIGINT), "
            "lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)")


@query("op13_interval_repair", f"""
WITH RECURSIVE {_CRC_SQL},
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hashed AS (
  SELECT keyed.*, {_crc_of("k")} % 20 AS h FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text)) AS pos,
    left(role, 1) AS x, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last FROM damaged),
faulty AS (
  SELECT *, CASE WHEN last = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
    WHEN last NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(x) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 1) AS blank,
    count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
    count_if(before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM faulty GROUP BY conv_id),
moves(p, x, q) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
edits AS (
  SELECT p, x, q, 'K' AS e, 0 AS price FROM moves UNION ALL SELECT p, x, q, 'R', 1 FROM moves WHERE x <> 's'
  UNION ALL SELECT p, '', p, 'D', 2 FROM (VALUES ('0'), ('s'), ('u'), ('a')) AS d(p)),
puts(q, z, more, i) AS (VALUES ('0', '0', 0, ''), ('s', 's', 0, ''), ('u', 'u', 0, ''), ('a', 'a', 0, ''), ('0', 'u', 5, 'I'),
  ('0', 'a', 10, 'II'), ('s', 'u', 5, 'I'), ('s', 'a', 10, 'II'), ('u', 'a', 5, 'I'), ('a', 'u', 5, 'I')),
cells AS (
  SELECT conv_id, 0::BIGINT AS pos, z AS place, {{'c': more, 'a': i}} AS best FROM counts, puts WHERE q = '0'
  UNION ALL
  SELECT f.conv_id, f.pos, z, min({{'c': best.c + price + more + CASE WHEN f.fault = 3 AND e <> 'D' THEN 5 ELSE 0 END, 'a': best.a || e || i}})
  FROM cells JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM cells.conv_id AND f.pos = cells.pos + 1
    JOIN edits ON p = place AND (e <> 'K' OR edits.x = f.x) AND (e = 'D' OR f.fault NOT IN (1, 2)) JOIN puts USING (q)
  GROUP BY f.conv_id, f.pos, z),
parsed AS (
  SELECT c.conv_id, min(best) AS best FROM cells c JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND c.pos = n.n
  WHERE place IN ('0', 'a') GROUP BY c.conv_id),
letters AS (
  SELECT conv_id, i, best.a[i] AS e, count_if(best.a[i] <> 'D') OVER w AS total,
    count_if(best.a[i] <> 'I') OVER (w ORDER BY i) AS pos, count_if(best.a[i] <> 'D') OVER (w ORDER BY i) - 1 AS spot
  FROM parsed, unnest(range(1, length(best.a) + 1)) AS u(i) WINDOW w AS (PARTITION BY conv_id)),
lines AS (
  SELECT l.conv_id, string_agg(CASE WHEN e = 'K' THEN f.role WHEN (spot - total % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY i) AS body
  FROM letters l LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.pos = l.pos WHERE e <> 'D' GROUP BY l.conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN parsed ON parsed.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM ids.conv_id
""")
def op13_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    repair = conversation_repair.Repair(conversation_repair.damage(convs))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # One union and one grouping instead of two joins: every id, what is known of it, its digest.
    parts = convs.select("conv_id").unionByName(
        repair.report().withColumnRenamed("conv", "conv_id").drop("n"), allowMissingColumns=True
    ).unionByName(repair.digests().withColumnRenamed("conv", "conv_id"), allowMissingColumns=True)
    whole = parts.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in [*counts, "audit", "sha256"]))
    return whole.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query("op12_letter_kdtree", f"""
WITH RECURSIVE {_CRC_SQL},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL HAVING length(run) >= 7),
hashed AS (
  SELECT run, n, {_crc_of("(doc || ':' || run)")} AS h FROM runs, crc),
words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
cuts AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM places),
masks AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS mask FROM places),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.less = w.word
  UNION ALL SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.less = w.word),
best AS (SELECT word, count(*) AS n_near, min({{'m': -m, 'w': other}}) AS b FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 10 * w.n THEN b.w END AS form, CASE WHEN -b.m >= 10 * w.n THEN -b.m END AS form_n
  FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
FROM formed JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) USING (word)
""")
def op12_letter_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_kdtree.group(spelling_kdtree.seeded_words(table(spark, sf_dir, "documents")))
