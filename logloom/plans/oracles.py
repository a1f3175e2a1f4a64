"""The registered queries in plain SQL, for checking their results with another engine."""

from __future__ import annotations

from logloom.operators.access_log import LINE_PATTERN
from logloom.schemas import ACCESS_FIELDS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# --- assembly -------------------------------------------------------------------------------------


def _doc_lines(blanks: int = 1, stream: str = "source") -> str:
    return f"""
    docs AS (
      SELECT doc_id, {stream} AS stream,
             string_split(replace(text, chr(10), repeat(chr(10), {blanks + 1})), chr(10)) AS parts FROM documents),
    lines AS (
      SELECT stream, {{'doc_id': doc_id, 'pos': i - 1}} AS pos, parts[i] AS line
      FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM docs) t)"""


def _segments(terminator: str) -> str:
    return f"""
    marked AS (SELECT *, ends_with(line, {_quoted(terminator)}) AS is_end FROM lines),
    numbered AS (
      SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY stream ORDER BY pos
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM marked),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY stream, seg, line = '' ORDER BY pos) AS rn FROM numbered),
    kept AS (SELECT * FROM ranked WHERE NOT (seg > 0 AND line = '' AND rn = 1))"""


def _events(glue: str, blanks: int = 1, terminator: str = ".") -> str:
    return f"""WITH {_doc_lines(blanks)}, {_segments(terminator)},
    events AS (
      SELECT stream, max(pos).doc_id AS doc_id, max(pos).pos::BIGINT AS pos, string_agg(line, {glue} ORDER BY pos) AS body, count(*)::INT AS n_lines
      FROM kept GROUP BY stream, seg HAVING bool_or(is_end))"""


ALL_EVENTS = _events("' § '") + " SELECT stream, doc_id, pos, body, n_lines FROM events"

FILE_LINES = """
  SELECT line FROM (SELECT unnest(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10))) AS line FROM documents)
  UNION ALL SELECT 'document ' || doc_id || ' |#]' FROM documents
  UNION ALL SELECT '|#]' FROM documents"""

# --- headers --------------------------------------------------------------------------------------

# Event headers as rows of (event_id, key, value), as the rendering builds them.
EVENT_HEADERS = """
  SELECT event_id, 'type' AS key, event_type AS value FROM events
  UNION ALL SELECT event_id, 'customer', 'old' FROM events WHERE event_id % 5 = 0
  UNION ALL SELECT event_id, 'host', 'Nation_' || (user_id % 30) || CASE WHEN event_id % 2 = 0 THEN '.example.com' ELSE '' END
            FROM events WHERE event_id % 13 <> 0"""

NATION_REGISTRY = """
  SELECT lower(n_name) AS host, r_name AS customer FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT lower(n_name) || '-b', r_name FROM nation JOIN region ON n_regionkey = r_regionkey"""

STATIC_LINES = """
  SELECT n_nationkey AS pos,
         CASE WHEN n_nationkey = 3 THEN 'type=static-' || n_name WHEN n_nationkey = 4 THEN 'host=static-' || n_name || '=lost'
              WHEN n_nationkey = 21 THEN 'bad' ELSE 'region' || n_regionkey || '=' || n_name END AS line
  FROM nation"""


def _statics(pick: str) -> str:
    return f"""
    static_lines AS ({STATIC_LINES}),
    statics AS (
      SELECT split_part(line, '=', 1) AS key, {pick}(split_part(line, '=', 2), pos) AS value FROM static_lines
      WHERE pos < (SELECT min(pos) FROM static_lines WHERE position('=' IN line) = 0) GROUP BY 1)"""


HEADER_TEXT = "string_agg(key || '=' || value, ';' ORDER BY key) AS headers"

STATICS_KEEP = f"""WITH headers AS ({EVENT_HEADERS}), {_statics('arg_min')},
  merged AS (
    SELECT * FROM headers
    UNION ALL SELECT event_id, s.key, s.value FROM events e, statics s
              WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.event_id = e.event_id AND h.key = s.key))
  SELECT event_id, {HEADER_TEXT} FROM merged GROUP BY event_id"""

STATICS_OVERWRITE = f"""WITH headers AS ({EVENT_HEADERS}), {_statics('arg_max')},
  merged AS (
    SELECT * FROM headers WHERE key NOT IN (SELECT key FROM statics)
    UNION ALL SELECT event_id, s.key, s.value FROM events e, statics s)
  SELECT event_id, {HEADER_TEXT} FROM merged GROUP BY event_id"""

WITH_CUSTOMER = f"""WITH headers AS ({EVENT_HEADERS}), registry AS ({NATION_REGISTRY}),
  found AS (
    SELECT e.event_id, coalesce(r.customer, 'UNKNOWN') AS customer
    FROM events e
    LEFT JOIN (SELECT * FROM headers WHERE key = 'host') h ON h.event_id = e.event_id
    LEFT JOIN registry r ON r.host = lower(split_part(h.value, '.', 1)))"""

CUSTOMERS = f"""{WITH_CUSTOMER},
  merged AS (
    SELECT * FROM headers WHERE key <> 'customer'
    UNION ALL SELECT event_id, 'customer', customer FROM found)
  SELECT event_id, {HEADER_TEXT} FROM merged GROUP BY event_id"""

SUPPLIER_REGISTRY = """
WITH lines AS (
  SELECT s_suppkey AS pos,
         CASE WHEN s_suppkey % 11 = 5 THEN 'no entry ' || s_name
              ELSE n_name || ':' || (s_suppkey % 3) || ':  ' || s_name || '.example.com Host' || (s_suppkey % 40)
                   || chr(9) || 'h' || (s_suppkey % 7) || '.a.b ' END AS line
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey),
entries AS (
  SELECT pos, regexp_extract(line, '^(.*):(.*)$', 1) AS customer,
         string_split_regex(trim(regexp_extract(line, '^(.*):(.*)$', 2)), '\\s') AS hosts
  FROM lines WHERE position(':' IN line) > 0),
hosts AS (
  SELECT pos, i, customer, lower(split_part(hosts[i], '.', 1)) AS host
  FROM (SELECT *, unnest(range(1, len(hosts) + 1)) AS i FROM entries))
SELECT host, arg_max(customer, pos * 100 + i) AS customer FROM hosts GROUP BY host"""

USER_STATICS = """
WITH lines AS (
  SELECT user_id AS stream, event_id AS pos,
         CASE WHEN event_id % 101 = 7 THEN event_type || '==' WHEN event_id % 97 = 3 THEN event_type
              WHEN event_id % 10 = 4 THEN event_type || '=' || event_id || '=lost' WHEN event_id % 10 = 5 THEN '=' || event_id
              ELSE event_type || '=' || event_id END AS line
  FROM events),
stops AS (SELECT stream, min(pos) AS stop FROM lines WHERE position('=' IN rtrim(line, '=')) = 0 GROUP BY stream)
SELECT l.stream, l.pos, split_part(line, '=', 1) AS key, split_part(line, '=', 2) AS value
FROM lines l LEFT JOIN stops s ON s.stream = l.stream WHERE s.stop IS NULL OR l.pos < s.stop"""

# --- application log ------------------------------------------------------------------------------

APP_LINES = """
  SELECT event_id, 'host=NATION_' || (user_id % 30) || '.example.com' AS headers,
         CASE event_id % 23
           WHEN 1 THEN 'no pipes for ' || event_id
           WHEN 2 THEN 'x|only rest ' || event_id
           WHEN 3 THEN 'x|' || stamp || '|' || level || '|rest'
           WHEN 4 THEN '[#|yesterday|' || level || tail || 'bad time|#]'
           WHEN 5 THEN '[#|' || stamp || '|' || level || tail || 'a|b|c|#]'
           WHEN 6 THEN ''
           ELSE '[#|' || stamp || '|' || level || tail || 'did ' || props || ' § ok|#]' END AS body
  FROM (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '+0100' AS stamp,
               CASE event_type WHEN 'error' THEN 'SEVERE' WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS level,
               '|app' || (user_id % 5) || '|com.example.' || event_type || '|_ThreadID=' || user_id || ';|' AS tail
        FROM events)"""

APP_PARSED = f"""
  app_cut AS (SELECT *, string_split(body, '|') AS p, len(string_split(body, '|')) - 1 AS n FROM ({APP_LINES})),
  app_timed AS (
    SELECT *, CASE WHEN n >= 2 THEN try_strptime(p[2], '%Y-%m-%dT%H:%M:%S.%g%z') END AT TIME ZONE 'UTC' AS t FROM app_cut),
  app_parsed AS (
    SELECT event_id, headers, body AS original, coalesce(epoch_ms(t), 0)::BIGINT AS "timestamp",
           coalesce(strftime(t, '%Y-%m-%d %H:%M:%S'), '') AS datetime,
           CASE WHEN n >= 3 THEN p[3] ELSE '' END AS loglevel, CASE WHEN n >= 4 THEN p[4] ELSE '' END AS appservername,
           CASE WHEN n >= 5 THEN p[5] ELSE '' END AS classname, CASE WHEN n >= 6 THEN p[6] ELSE '' END AS thread,
           p[least(n, 6) + 1] AS message,
           CASE WHEN t IS NOT NULL THEN 'ok' WHEN n >= 2 THEN 'bad_time' ELSE 'no_match' END AS parse_status, n
    FROM app_timed)"""

APP_COLUMNS = 'headers, original, "timestamp", datetime, loglevel, appservername, classname, thread, message'

APP_CUSTOMER = f"""{APP_PARSED}, registry AS ({NATION_REGISTRY}),
  app_customers AS (
    SELECT p.*, coalesce(r.customer, 'UNKNOWN') AS customer
    FROM app_parsed p JOIN events e ON e.event_id = p.event_id
    LEFT JOIN registry r ON r.host = 'nation_' || (e.user_id % 30))"""

# --- access log -----------------------------------------------------------------------------------

ACCESS_LINES = """
  SELECT event_id, 'type=' || event_type AS headers, CASE WHEN event_id % 7 = 6 THEN substr(line, 1, 60) ELSE line END AS body
  FROM (
    SELECT e.*, '10.' || (user_id % 256) || '.0.' || (event_id % 256) || ' - user' || user_id || ' ['
      || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0100] "GET ' || url || ' HTTP/1.1" ' || (event_id % 5 * 100 + 100) || ' '
      || CASE WHEN event_id % 4 = 0 THEN '-' ELSE (event_id * 17 % 100000)::VARCHAR END || ' "' || url
      || '" "Mozilla/5.0 (' || event_type || ' x)" ' || CASE WHEN event_id % 6 = 0 THEN '' ELSE 'www.example.com' END
      || ' "www.example.com" ' || CASE WHEN event_id % 9 = 0 THEN '' ELSE (event_id % 60)::VARCHAR END || ' '
      || (event_id % 1000000) || ' ' || CASE WHEN event_id % 8 = 0 THEN '' WHEN event_id % 3 = 0 THEN 'X' ELSE '+' END
      || ' "text/html"' || CASE WHEN event_id % 12 = 0 THEN ' "-' ELSE ' "-"' END || ' ' || (event_id % 777) || ' '
      || CASE WHEN event_id % 10 = 0 THEN '' ELSE (event_id % 999)::VARCHAR END AS line
    FROM events e LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages))"""

_ACCESS_RE = _quoted(LINE_PATTERN + "$")
_ACCESS_GROUPS = ", ".join(
    f"coalesce(try_cast(nullif(g['{name}'], '') AS INT), 0) AS {name}" if name == "statuscode" else f"g['{name}'] AS \"{name}\""
    for name in ACCESS_FIELDS
)
ACCESS_PARSED = f"""
  access_parsed AS (
    SELECT event_id, headers, body AS original, {_ACCESS_GROUPS},
           CASE WHEN regexp_matches(body, {_ACCESS_RE}) THEN 'ok' ELSE 'no_match' END AS parse_status
    FROM (SELECT *, regexp_extract(body, {_ACCESS_RE}, [{", ".join(_quoted(n) for n in ACCESS_FIELDS)}]) AS g
          FROM ({ACCESS_LINES})))"""
ACCESS_COLUMNS = ", ".join(f'"{name}"' for name in ACCESS_FIELDS)

# --- syslog ---------------------------------------------------------------------------------------


def _syslog_time(moment: str, zero_padded: str) -> str:
    day = f"day({moment})::VARCHAR"
    padded = f"CASE WHEN {zero_padded} THEN lpad({day}, 2, '0') ELSE lpad({day}, 2, ' ') END"
    return f"(strftime({moment}, '%b') || ' ' || {padded} || strftime({moment}, ' %H:%M:%S'))"


def _repaired(base: str, clock: str) -> str:
    """Year repair of a time in the year 2000 against a clock."""
    year = f"year({clock})::INT"
    at = [f"({base} + to_years({year} - 2000 + {shift}))" for shift in (-1, 0, 1)]
    one = "INTERVAL 1 MONTH"
    return f"""CASE WHEN {at[1]} > {clock} AND {at[1]} - {one} > {clock} THEN {at[0]}
                    WHEN {at[1]} < {clock} AND {at[1]} + {one} < {clock} THEN {at[2]} ELSE {at[1]} END"""


def _nearest(base: str, clock: str) -> str:
    year = f"year({clock})::INT"
    at = [f"({base} + to_years({year} - 2000 + {shift}))" for shift in (-1, 0, 1)]
    gap = [f"abs(epoch_ms({moment}) - epoch_ms({clock}))" for moment in at]
    return f"""CASE WHEN {gap[0]} < {gap[1]} AND {gap[0]} <= {gap[2]} THEN {at[0]}
                    WHEN {gap[2]} < {gap[1]} THEN {at[2]} ELSE {at[1]} END"""


_SYSLOG_CLOCK = "TIMESTAMP '2024-01-31 00:00:00'"

SYSLOG_LINES = f"""
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'nation_' || (user_id % 30) || '-B' END AS header_host,
         CASE event_id % 29
           WHEN 1 THEN substr(stamp, 1, 9)
           WHEN 2 THEN 'no time here, event ' || event_id
           WHEN 3 THEN stamp
           WHEN 4 THEN stamp || ' onlymessage'
           WHEN 5 THEN stamp || '  blank host'
           ELSE stamp || ' NATION_' || (user_id % 30) || CASE WHEN event_id % 4 = 0 THEN '.example.com' ELSE '-b' END
                || ' app: ' || event_type || ' ' || props END AS body
  FROM (SELECT *, {_syslog_time('ts', 'event_id % 3 = 0')} AS stamp FROM events)"""

SYSLOG_PARSED = f"""
  syslog_timed AS (
    SELECT *, length(body) < 15 AS short, try_strptime('2000 ' || substr(body, 1, 15), '%Y %b %d %H:%M:%S') AS base
    FROM ({SYSLOG_LINES})),
  syslog_cut AS (
    SELECT *, CASE WHEN NOT short AND base IS NOT NULL THEN {_repaired('base', _SYSLOG_CLOCK)} END AS t,
           CASE WHEN NOT short AND base IS NOT NULL THEN substr(body, 17) END AS rest
    FROM syslog_timed),
  syslog_named AS (
    SELECT *, CASE WHEN position(' ' IN rest) > 0 THEN substr(rest, 1, position(' ' IN rest) - 1) END AS name FROM syslog_cut),
  registry AS ({NATION_REGISTRY}),
  syslog_parsed AS (
    SELECT event_id, body AS original, coalesce(epoch_ms(t), 0)::BIGINT AS "timestamp",
           coalesce(strftime(t, '%Y-%m-%d %H:%M:%S'), '') AS datetime, coalesce(name, '') AS hostname,
           CASE WHEN short THEN '' WHEN name IS NOT NULL THEN substr(rest, length(name) + 2) ELSE coalesce(rest, body) END AS message,
           CASE WHEN short THEN 'too_short' WHEN t IS NULL THEN 'bad_time' WHEN length(body) = 15 THEN 'no_message' ELSE 'ok' END AS parse_status,
           concat_ws(';', CASE WHEN NOT short THEN 'customer=' || coalesce(r.customer, 'UNKNOWN') END,
                     'host=' || coalesce(name, header_host)) AS headers
    FROM syslog_named LEFT JOIN registry r ON r.host = lower(coalesce(name, header_host)))"""

SYSLOG_COLUMNS = 'original, "timestamp", datetime, hostname, message'

_DATED = f"""
  dated AS (
    SELECT event_id, clock, strptime('2000 ' || stamp, '%Y %b %d %H:%M:%S') AS base
    FROM (SELECT event_id, {_syslog_time('moment', 'event_id % 2 = 0')} AS stamp, clock
          FROM (SELECT event_id, ts + to_months((user_id % 12)::INT) AS moment,
                       ts + to_months((event_id % 25)::INT - 12) AS clock FROM events)))"""

_DOCUMENT_PART = "floor(doc_id * 3 / ((SELECT max(doc_id) FROM documents) + 1))"

ORACLES = {
    "s1_read_lines": f"SELECT line, count(*) AS n FROM ({FILE_LINES}) GROUP BY line",
    "s1_files_to_events": f"""WITH lines AS (
        SELECT doc_id, i, parts[i] AS line FROM (
          SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
            SELECT doc_id, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10)) AS parts FROM documents))),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line = '' ORDER BY i) AS rn FROM lines),
      bodies AS (
        SELECT string_agg(line, ' § ' ORDER BY i) || ' § |#]' AS body, (count(*) + 1)::INT AS n_lines
        FROM ranked WHERE NOT (line = '' AND rn = 1) GROUP BY doc_id
        UNION ALL SELECT 'document ' || doc_id || ' |#]', 1 FROM documents)
      SELECT body, n_lines, count(*) AS n FROM bodies GROUP BY ALL""",
    "s1_rolled_files": _events("' § '") + " SELECT stream, body, n_lines, count(*) AS n FROM events GROUP BY ALL",
    "s2_charset": "SELECT conv_id, turn, text AS little, text AS big, text AS utf8 FROM conversations",
    "s2_charset_files": """SELECT charset, line, count(*) AS n
      FROM (SELECT unnest(string_split(CASE doc_id % 2 WHEN 1 THEN text || chr(10) || 'Ċ漊ĀਅĀ' || chr(10) ELSE text END, chr(10))) AS line FROM documents),
        (VALUES ('UTF-16LE'), ('UTF-16BE'), ('UTF-32LE'), ('UTF-32BE')) c(charset) GROUP BY ALL""",
    "s3_assemble_events": ALL_EVENTS,
    "s4_separator_blanks": _events("'~'", blanks=3) + " SELECT stream, doc_id, pos, body, n_lines FROM events",
    "s5_line_glue": _events("chr(10)") + " SELECT stream, doc_id, pos, body FROM events",
    "s6_unterminated_tail": f"""WITH {_doc_lines(stream='doc_id')}, {_segments('.')},
      tails AS (SELECT *, bool_or(is_end) OVER (PARTITION BY stream, seg) AS closed FROM numbered)
      SELECT stream, count(*) AS n_lines, min(pos).pos::BIGINT AS first_pos, max(pos).pos::BIGINT AS last_pos
      FROM tails WHERE NOT closed GROUP BY stream""",
    "s7_stream_assembly": ALL_EVENTS,
    "s8_micro_batches": _events("' § '")
    + f" SELECT {_DOCUMENT_PART}::BIGINT AS batch, count(*) AS n_events FROM events GROUP BY 1",
    "s8_admitted_batches": _events("' § '")
    + f""", files AS (SELECT DISTINCT source, floor(doc_id * 4 / ((SELECT max(doc_id) FROM documents) + 1)) AS roll FROM documents)
      SELECT stream, count(*) AS n_events, sum(n_lines)::BIGINT AS n_lines, (SELECT ceil(count(*) / 24)::BIGINT FROM files) AS n_batches, true AS within
      FROM events GROUP BY stream""",
    "s9_stream_counts": f"""WITH {_doc_lines()},
      files AS (SELECT DISTINCT source, floor(doc_id * 4 / ((SELECT max(doc_id) FROM documents) + 1)) AS roll FROM documents)
      SELECT (SELECT ceil(count(*) / 16)::BIGINT FROM files) AS n_batches, count(*) AS n_written, count(*) AS events_read, 0 AS n_different FROM lines""",
    "s9_count_events": _events("' § '")
    + " SELECT stream, count(*) AS n_events, (SELECT count(*) FROM events) AS events_read FROM events GROUP BY stream",
    "s10_restart": ALL_EVENTS,
    "e1_host_registry": SUPPLIER_REGISTRY,
    "e2_short_host": """SELECT page_id, lower(split_part(regexp_extract(url, '^https?://([^/:?#]+)', 1), '.', 1)) AS short_host
      FROM pages""",
    "e3_add_customer": CUSTOMERS,
    "e4_syslog_customer": f"WITH {SYSLOG_PARSED} SELECT event_id, headers FROM syslog_parsed",
    "e5_static_pairs": USER_STATICS,
    "e6_statics_keep": STATICS_KEEP,
    "e7_statics_overwrite": STATICS_OVERWRITE,
    "e8_whole_batch": f"""{WITH_CUSTOMER}, {_statics('arg_max')}
      SELECT customer, (SELECT value FROM statics WHERE key = 'type') AS type,
             (SELECT value FROM statics WHERE key = 'region0') AS region0, count(*) AS n_events
      FROM found GROUP BY 1, 2, 3""",
    "e9_header_access": f"""WITH headers AS ({EVENT_HEADERS}),
      puts AS (SELECT * FROM headers WHERE key <> 'customer' UNION ALL SELECT event_id, 'customer', props FROM events)
      SELECT e.event_id, (SELECT value FROM headers h WHERE h.event_id = e.event_id AND key = 'host') AS host,
             e.event_id % 5 = 0 AS has_customer, p.put
      FROM events e
      JOIN (SELECT event_id, string_agg(key || '=' || value, ';' ORDER BY key) AS put FROM puts GROUP BY 1) p
        ON p.event_id = e.event_id""",
    "e10_refresh": f"""WITH registry AS ({NATION_REGISTRY})
      SELECT event_id, coalesce(
               CASE WHEN event_id * 2 >= (SELECT max(event_id) + 1 FROM events) THEN 'new ' ELSE '' END || customer, 'UNKNOWN') AS customer,
             coalesce(customer, 'UNKNOWN') AS customer_once
      FROM events LEFT JOIN registry ON host = 'nation_' || (user_id % 30)""",
    "p1_string_events": "SELECT conv_id, turn, 'role=' || role || ';turn=' || turn AS headers, text AS body FROM conversations",
    "p2_access_log": f"WITH {ACCESS_PARSED} SELECT event_id, headers, original, {ACCESS_COLUMNS}, parse_status FROM access_parsed",
    "p2_access_log_typed": f"""WITH {ACCESS_PARSED}
      SELECT event_id, statuscode, {", ".join(f'try_cast("{n}" AS BIGINT) AS "{n}"' for n in ("bytesSend", "bytesIn", "bytesOut", "timeSecond", "timeMicro"))},
             (epoch_ms(try_strptime(split_part("time", ' ', 1), '%d/%b/%Y:%H:%M:%S')) // 1000 - 3600)::BIGINT AS event_seconds
      FROM access_parsed""",
    "p3_app_log": f"WITH {APP_PARSED} SELECT event_id, {APP_COLUMNS}, parse_status FROM app_parsed",
    "p3_app_log_whole_message": f"""WITH {APP_PARSED}
      SELECT event_id, CASE WHEN event_id % 23 = 5 THEN 'a|b|c' ELSE message END AS message FROM app_parsed""",
    "p4_syslog": f"WITH {SYSLOG_PARSED} SELECT event_id, {SYSLOG_COLUMNS}, parse_status FROM syslog_parsed",
    "p5_year_repair": f"""WITH {_DATED}
      SELECT event_id, epoch_ms({_repaired('base', 'clock')})::BIGINT AS repaired,
             epoch_ms({_nearest('base', 'clock')})::BIGINT AS nearest FROM dated""",
    "p6_time_with_offset": """SELECT event_id, CASE event_id % 5
        WHEN 0 THEN epoch_us(ts) // 1000 - 3600000 WHEN 1 THEN epoch_us(ts) // 1000 + 19800000 WHEN 2 THEN epoch_us(ts) // 1000
        WHEN 3 THEN epoch_us(ts) // 1000 - 7200000 ELSE 0 END::BIGINT AS millis FROM events""",
    "p7_readable_time": f"""WITH {APP_PARSED}
      SELECT event_id, CASE WHEN datetime = '' THEN '' ELSE strftime(epoch_ms("timestamp" + 19800000), '%Y-%m-%d %H:%M:%S') END AS datetime,
             strftime(epoch_ms("timestamp"), '%Y-%m-%d %H:%M:%S') AS utc FROM app_parsed""",
    "p8_defaults": f"""SELECT doc_id, '{",".join("0" if n == "statuscode" else "" for n in ACCESS_FIELDS)}' AS access,
        replace(text, '|', '/') AS original, '0,,,,,' AS app, replace(text, '|', '/') AS message FROM documents""",
    "p9_rejects": f"""WITH {ACCESS_PARSED}, {APP_PARSED}, {SYSLOG_PARSED}
      SELECT 'access' AS kind, parse_status, count(*) AS n FROM access_parsed WHERE parse_status <> 'ok' GROUP BY ALL
      UNION ALL SELECT 'app', parse_status, count(*) FROM app_parsed WHERE parse_status <> 'ok' GROUP BY ALL
      UNION ALL SELECT 'syslog', parse_status, count(*) FROM syslog_parsed WHERE parse_status <> 'ok' GROUP BY ALL""",
    "p9_quarantine": f"""WITH {ACCESS_PARSED}, {APP_PARSED}, {SYSLOG_PARSED},
      all_rows AS (SELECT 'access' AS kind, parse_status, original FROM access_parsed UNION ALL SELECT 'app', parse_status, original FROM app_parsed
        UNION ALL SELECT 'syslog', parse_status, original FROM syslog_parsed)
      SELECT kind, parse_status, count(*) AS n, count(*) AS counted, sum(length(original))::BIGINT AS chars FROM all_rows GROUP BY ALL""",
    "k1_event_table": "SELECT 'role=' || role || ';turn=' || turn AS headers, text AS body FROM conversations",
    "k2_access_table": f"WITH {ACCESS_PARSED} SELECT headers, original, {ACCESS_COLUMNS} FROM access_parsed",
    "k3_app_table": f"WITH {APP_PARSED} SELECT {APP_COLUMNS} FROM app_parsed",
    "k4_syslog_table": f"WITH {SYSLOG_PARSED} SELECT headers, {SYSLOG_COLUMNS} FROM syslog_parsed",
    "k5_read_by_field": f"""WITH {APP_PARSED}
      SELECT loglevel, classname, count(*) AS n, max("timestamp") AS latest FROM app_parsed GROUP BY ALL""",
    "k6_container_formats": f"""WITH {ACCESS_PARSED}
      SELECT statuscode, method, count(*) AS n, format FROM access_parsed, (VALUES ('parquet'), ('orc')) f(format) GROUP BY ALL""",
    "k6_avro": f"""WITH {ACCESS_PARSED}, {APP_PARSED}, {SYSLOG_PARSED},
      all_rows AS (
        SELECT 'event' AS kind, 'role=' || role || ';turn=' || turn AS headers, text AS t, 0::BIGINT AS number FROM conversations
        UNION ALL SELECT 'access', headers, original, statuscode FROM access_parsed
        UNION ALL SELECT 'app', headers, original, "timestamp" FROM app_parsed UNION ALL SELECT 'syslog', headers, original, "timestamp" FROM syslog_parsed)
      SELECT kind, headers, count(*) AS n, sum(length(t))::BIGINT AS chars, sum(number)::BIGINT AS numbers FROM all_rows GROUP BY ALL""",
    "k7_by_customer": f"""WITH {APP_CUSTOMER}
      SELECT customer, 'customer=' || customer || ';' || headers AS headers, original, "timestamp", message
      FROM app_customers WHERE customer = 'ASIA'""",
    "k7_all_customers": f"""WITH {APP_CUSTOMER}
      SELECT customer, loglevel, count(*) AS n, sum(length(original))::BIGINT AS chars FROM app_customers GROUP BY ALL""",
    "k7_stream_by_customer": f"""WITH {APP_PARSED}
      SELECT CASE WHEN event_id % 3 = 0 THEN 'HOT' WHEN event_id % 7 = 1 THEN '' WHEN event_id % 7 = 2 THEN '__EMPTY__'
               WHEN event_id % 7 = 3 THEN '__HIVE_DEFAULT_PARTITION__' WHEN event_id % 7 = 4 THEN 'a/b=c %' ELSE 'C' || (event_id % 11) END AS customer,
             loglevel, count(*) AS n, sum(length(original))::BIGINT AS chars FROM app_parsed GROUP BY ALL""",
    "flagship_levels_by_customer": f"""WITH {APP_CUSTOMER}
      SELECT customer, loglevel, count(*) AS n_events, max(datetime) AS latest FROM app_customers GROUP BY ALL""",
}
