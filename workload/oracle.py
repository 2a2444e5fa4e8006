"""The workload's results as plain SQL for the checking engine.

Written apart from the library: statements are split into token rows and rebuilt with
window functions and string aggregation, percentiles use row numbers.
"""

from __future__ import annotations

from stmtscope.schema import METRICS, PERCENTILES, TOTAL_UNITS, wide_metric_columns
from workload.derive import EVENTS_SQL, LINEITEM_KEY, LINEITEM_SQL

# One token; an open quote, bracket or comment runs to the end of the text.
TOKEN = (
    r"--[^\r\n]*|/\*(?s:.*?)(?:\*/|\z)"
    r"|[Nn]?'[^']*(?:''[^']*)*(?:'|\z)"
    r"|\[[^\]]*(?:\]\][^\]]*)*(?:\]|\z)"
    r'|"[^"]*(?:""[^"]*)*(?:"|\z)'
    r"|0[xX][0-9A-Fa-f]*|\p{Sc}[0-9.]+"
    r"|(?:[0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+|[0-9]+\.?[0-9]*|\.[0-9]+"
    r"|[@#_\p{L}][@#$_\p{L}\p{Nd}]*|[\t-\r\x{85}\p{Z}]+|(?s:.)"
)
NUMBER = r"0[xX][0-9A-Fa-f]*|[0-9]+\.?[0-9]*|\.[0-9]+"
SPACES = r"[\t-\r\x{85}\p{Z}]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm_ctes(source: str, id_column: str, text_column: str, prefix: str = "") -> str:
    """CTEs ending in ``{prefix}norm(id, norm_text)`` for every row of ``source``."""
    p = prefix
    return f"""
{p}tokens AS (
  SELECT {id_column} AS id, unnest(list) AS tok, generate_subscripts(list, 1) AS i
  FROM (SELECT {id_column}, regexp_extract_all({text_column}, {quoted(TOKEN)}) AS list FROM {source})
),
{p}kinds AS (
  SELECT *, CASE WHEN starts_with(tok, 'sp_executesql') OR tok = 'sp_prepare' THEN 'call'
                 WHEN starts_with(tok, '''') OR lower(substr(tok, 1, 2)) = 'n''' THEN 'text' END AS kind
  FROM {p}tokens
),
{p}states AS (
  SELECT *, last_value(kind IGNORE NULLS) OVER (
    PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
  FROM {p}kinds
),
{p}norm AS (
  SELECT id, replace(trim(regexp_replace(string_agg(
    CASE WHEN kind = 'text' AND prev = 'call' THEN tok
         WHEN kind = 'text' THEN '{{STR}}'
         WHEN starts_with(tok, '--') OR starts_with(tok, '/*') THEN ''
         WHEN regexp_full_match(tok, {quoted(NUMBER)}) THEN '{{##}}'
         ELSE tok END, '' ORDER BY i), {quoted(SPACES)}, ' ', 'g')), '-{{##}}', '{{##}}') AS norm_text
  FROM {p}states GROUP BY id
)"""


# Tokens outside a block comment, of which a comment's opening is one; and inside.
CODE_TOKEN = (
    r"^(?:--[^\r\n]*|/\*|[Nn]?'[^']*(?:''[^']*)*(?:'|\z)|\[[^\]]*(?:\]\][^\]]*)*(?:\]|\z)"
    r'|"[^"]*(?:""[^"]*)*(?:"|\z)|[^-/\'"\[Nn]+|(?s:.))'
)
COMMENT_TOKEN = r"^(?:/\*|\*/|[^*/]+|.)"
CLOSED = r"[Nn]?'[^']*(?:''[^']*)*'|\[[^\]]*(?:\]\][^\]]*)*\]|\"[^\"]*(?:\"\"[^\"]*)*\"|/\*(?s:.*?)\*/"
# Whether a token leaves something open.
OPEN = (
    "(starts_with(tok, chr(39)) OR lower(substr(tok, 1, 2)) = 'n' || chr(39) OR starts_with(tok, '[') "
    f"OR starts_with(tok, chr(34)) OR starts_with(tok, '/*')) AND NOT regexp_full_match(tok, {quoted(CLOSED)})"
)


def flat_ctes(source: str, id_column: str, text_column: str) -> str:
    """CTEs ending in ``flat(id, text)``: one token a step, comments in comments emptied."""
    return f"""
scan AS (
  SELECT {id_column} AS id, {text_column} AS rest, 0 AS depth, '' AS text FROM {source}
  UNION ALL
  SELECT id, substr(rest, len(tok) + 1), depth + CASE WHEN tok = '/*' THEN 1 WHEN tok = '*/' AND depth > 0 THEN -1 ELSE 0 END,
         text || CASE WHEN depth = 0 OR depth = 1 AND tok = '*/' THEN tok ELSE '' END
  FROM (SELECT *, CASE WHEN depth = 0 THEN regexp_extract(rest, {quoted(CODE_TOKEN)})
                       ELSE regexp_extract(rest, {quoted(COMMENT_TOKEN)}, 0, 's') END AS tok
        FROM scan WHERE rest <> '')
),
flat AS (SELECT id, text FROM scan WHERE rest = '')"""


def stable_id(expression: str) -> str:
    return f"('0x' || substr(md5({expression}), 1, 15))::BIGINT"


RAW = {
    "events": EVENTS_SQL.format(events="events"),
    "lineitem": LINEITEM_SQL.replace("{sequence}", stable_id(LINEITEM_KEY)).format(lineitem="lineitem"),
}
RESET = "(name = 'rpc_completed' AND coalesce(object_name, '') = 'sp_reset_connection')"
KEPT = "name IN ('rpc_completed', 'sql_batch_completed')"
DYNAMIC = "(starts_with(object_name, 'sp_execute') OR object_name = 'sp_prepare')"


def batches_with(source: str = "events", drop_resets: bool = True) -> str:
    """``WITH raw ..., batches`` for one source; follow it with a SELECT from ``batches``."""
    resets = f" AND NOT {RESET}" if drop_resets else ""
    return f"""
WITH raw AS ({RAW[source]}),
kept AS (SELECT * FROM raw WHERE {KEPT}{resets}),
parsed AS (SELECT * FROM kept WHERE name = 'sql_batch_completed' OR {DYNAMIC}),
{norm_ctes("parsed", "event_sequence", "text_data")},
named AS (
  SELECT kept.*, CASE WHEN name = 'sql_batch_completed' OR {DYNAMIC} THEN coalesce(norm.norm_text, '')
                      ELSE coalesce(object_name, '') END AS norm_text
  FROM kept LEFT JOIN norm ON norm.id = kept.event_sequence
),
batches AS (
  SELECT event_sequence, name AS event_type, event_ts, client_pid, client_hostname, client_app_name,
         username, database_name, {stable_id("text_data")} AS text_id, text_data,
         {stable_id("database_name || ', ' || norm_text")} AS norm_id, norm_text,
         CASE WHEN result = 'OK' THEN 1 ELSE 0 END AS successful,
         CASE WHEN result = 'Error' THEN 1 ELSE 0 END AS failed,
         CASE WHEN result = 'Abort' THEN 1 ELSE 0 END AS aborted,
         {", ".join(METRICS)}
  FROM named
)"""


UNIQUE = """
SELECT norm_id, e.event_type, e.database_name, e.orig_text, e.norm_text FROM (
  SELECT norm_id, min({'event_sequence': event_sequence, 'text_id': text_id, 'event_type': event_type,
                       'database_name': database_name, 'orig_text': text_data, 'norm_text': norm_text}) AS e
  FROM batches GROUP BY norm_id)"""

COUNTS = """
SELECT norm_id, count(*) AS all_executions, count(DISTINCT text_id) AS distinct_executions,
       CAST(sum(successful) AS BIGINT) AS successful_executions,
       CAST(sum(failed) AS BIGINT) AS failed_executions,
       CAST(sum(aborted) AS BIGINT) AS aborted_executions
FROM batches GROUP BY norm_id"""


def wide_summary(metric: str) -> str:
    names = wide_metric_columns(metric)
    # Ordered list per fingerprint, NULLs first; a percentile is the element at its rank.
    percentiles = []
    for p, percent in PERCENTILES.items():
        few = 3 if percent == 25 else 1
        rank = f"({percent} * n // 100)"
        percentiles.append(
            f"CASE WHEN n <= {few} THEN low ELSE greatest(coalesce(vs[CAST({rank} AS INTEGER)], 0), 0) END AS {names[p]}"
        )
    return f"""
SELECT norm_id, low AS {names['min']}, CAST(total // filled AS BIGINT) AS {names['mean']},
       high AS {names['max']}, CAST(total AS BIGINT) AS {names['total']},
       CAST(dense_rank() OVER (ORDER BY total DESC) AS INTEGER) AS {names['total_rank']},
       {", ".join(percentiles)}
FROM (SELECT norm_id, min({metric}) AS low, max({metric}) AS high, sum({metric}) AS total, count({metric}) AS filled,
             count(*) AS n, list({metric} ORDER BY {metric} ASC NULLS FIRST) AS vs
      FROM batches GROUP BY norm_id)"""


def long_summary() -> str:
    parts = []
    for metric in METRICS:
        names = wide_metric_columns(metric)
        columns = ", ".join(f"{wide} AS {plain}" for plain, wide in names.items())
        parts.append(f"SELECT norm_id, '{metric}' AS metric, {columns} FROM ({wide_summary(metric)})")
    return " UNION ALL ".join(parts)


# Half-up rounding of the percentage to four digits in whole numbers, for 20 cores:
# 100 * cpu / (60 * 10^6 * 20), times 10^4, is cpu / 1200.
MINUTES = """
SELECT date_trunc('minute', event_ts) AS minute, database_name, norm_id, count(*) AS execution_count,
       CAST(sum(duration) AS BIGINT) AS duration_us, CAST(sum(cpu_time) AS BIGINT) AS cpu_us,
       CAST((((sum(cpu_time) * 2 + 1200) // 2400)::BIGINT) / 10000.0 AS DECIMAL(7,4)) AS cpu_pct,
       CAST(sum(logical_reads) AS BIGINT) AS logical_reads_pages,
       CAST(sum(physical_reads) AS BIGINT) AS physical_reads_pages,
       CAST(sum(writes) AS BIGINT) AS writes_pages,
       CAST(sum(row_count) // count(row_count) AS BIGINT) AS avg_row_count
FROM batches GROUP BY 1, 2, 3"""


def report(metric: str, where: str = "") -> str:
    names = wide_metric_columns(metric)
    suffix, divisor = TOTAL_UNITS[metric]
    percentiles = ", ".join(names[p] for p in PERCENTILES)
    return f"""
SELECT s.norm_id, u.database_name, u.norm_text, c.all_executions, {names['min']}, {names['mean']},
       {names['max']}, {names['total']} // {divisor} AS total_{metric}{suffix}, {percentiles}
FROM ({wide_summary(metric)}) s JOIN ({COUNTS}) c ON c.norm_id = s.norm_id
JOIN ({UNIQUE}) u ON u.norm_id = s.norm_id {where}"""


def qualified_name(text: str, name: str) -> str:
    at = f"strpos({text}, {name})"
    return f"""CASE WHEN len(string_split({text}, ' ')) < 3 THEN {name}
       WHEN {name} = '' OR {at} < 1 OR strpos(left({text}, {at} - 1), ' ') < 1
            OR strpos(substr({text}, {at}), ' ') < 1 THEN ''
       ELSE trim(split_part(left({text}, {at} - 1), ' ', -1)
                 || split_part(substr({text}, {at}), ' ', 1)) END"""
