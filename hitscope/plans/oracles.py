"""DuckDB SQL for every registered query: the independent check.

The SQL rebuilds the web log from ``events`` and ``nation`` by the integer and
string rules of ``hitscope.sources.testdata`` and has its own constants.
Sessions are derived from their starts: the hits that open a session are found
first, and every hit then belongs to the latest start at or before it.
"""

from __future__ import annotations

# The request and page patterns of the original jobs, and their
# host patterns, gap and labels.
REQUEST = r"^([A-Z])* (\/([a-zA-Z0-9\-\.\_\?\/\+\%\~\:]+)?)*(\.{1}([a-z0-9]+)*)?( [A-Z0-9]+\/[0-9|a-z|A-Z]+\.[0-9|a-z|A-Z])?$"
PAGE = r"^\/([a-z|A-Z]|\/|\-|[0-9]|\_)*.?(html|htm|\?|[0-9]*\,[0-9]*)?$"
NUMERIC_HOST = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"
HOST_NAME = r"^([a-z]|[0-9]|\-|\_|\.)*\.([a-z])*$"
DURATION_GAP = 1800


# Spark rounds a double HALF_UP on its shortest decimal form; going through
# DECIMAL gives DuckDB the same reading.
def _round(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _ipv4(n: str) -> str:
    parts = [f"CAST(({n} // {d}) % 256 AS VARCHAR)" for d in (16777216, 65536, 256, 1)]
    return " || '.' || ".join(parts)


def _ip_to_long(h: str) -> str:
    o = [f"TRY_CAST(string_split({h}, '.')[{i}] AS BIGINT)" for i in (1, 2, 3, 4)]
    return f"({o[0]} * 16777216 + {o[1]} * 65536 + {o[2]} * 256 + {o[3]})"


RAW = f"""
ev AS (SELECT *, CASE WHEN user_id % 10 < 3 THEN 0 ELSE user_id END AS u FROM events),
raw AS (
  SELECT
    CASE WHEN event_id % 227 <> 0 THEN CASE u % 4
      WHEN 0 THEN {_ipv4("CAST(16777216 + u * 65537 AS BIGINT)")}
      WHEN 1 THEN 'u' || CAST(u AS VARCHAR) || '.example.' || repeat(chr(CAST(97 + u % 26 AS INTEGER)), 2)
      WHEN 2 THEN 'u' || CAST(u AS VARCHAR) || '.example.com'
      ELSE 'U' || CAST(u AS VARCHAR) || '.LOCAL'
    END END AS host,
    '-' AS hyphen_string1,
    '-' AS hyphen_string2,
    CASE WHEN event_id % 229 = 0 THEN '[99/Foo/2024:00:00:00' ELSE '[' || strftime(ts, '%d/%b/%Y:%H:%M:%S') END AS "timestamp",
    CASE WHEN event_id % 223 = 0 THEN NULL WHEN event_id % 7 = 3 THEN '-0400]' ELSE '+0000]' END AS timezone,
    CASE WHEN event_id % 211 <> 0 THEN CASE event_type
      WHEN 'view' THEN 'GET /view/' || CAST(event_id % 10 AS VARCHAR) || '.html HTTP/1.0'
      WHEN 'click' THEN 'GET /click/' || CAST(event_id % 10 AS VARCHAR) || ' HTTP/1.0'
      WHEN 'signup' THEN 'POST /signup/ HTTP/1.0'
      WHEN 'purchase' THEN 'GET /img/' || CAST(event_id % 10 AS VARCHAR) || '.gif HTTP/1.0'
      ELSE 'GET /cgi/x?k=' || CAST(event_id % 10 AS VARCHAR) || ' HTTP/1.0'
    END END AS request,
    CASE WHEN event_id % 50 = 0 THEN '404' ELSE '200' END AS http_response_code,
    CASE WHEN event_id % 50 = 0 THEN '-' ELSE CAST(event_id % 5000 AS VARCHAR) END AS bytes,
    event_id
  FROM ev
),
nat AS (
  SELECT CAST(n_nationkey AS BIGINT) AS n, 16777216 + CAST(n_nationkey AS BIGINT) * 4000000 AS b,
         repeat(chr(CAST(97 + n_nationkey AS INTEGER)), 2) AS cc, n_name
  FROM nation
),
ranges AS (
  SELECT CAST(b AS BIGINT) AS begin_ip_int, CAST(b + 2999999 AS BIGINT) AS end_ip_int, cc AS country_code, n_name AS country FROM nat
  UNION ALL SELECT b + 200000, b + 1999999, cc, 'OVER, ' || n_name FROM nat WHERE n % 5 = 0
  UNION ALL SELECT b + 100000, b + 699999, NULL, NULL FROM nat WHERE n % 5 = 1
  UNION ALL SELECT NULL, NULL, cc, NULL FROM nat WHERE n = 2
),
kept AS (
  SELECT host, host AS encrypted_host, replace("timestamp", '[', '') AS raw_timestamp, timezone,
         request, http_response_code, bytes, event_id
  FROM raw
  WHERE host IS NOT NULL AND "timestamp" IS NOT NULL AND request IS NOT NULL
    AND http_response_code IS NOT NULL AND bytes IS NOT NULL
),
valid AS (
  SELECT *, string_split(request, ' ')[2] AS request_url FROM kept
  WHERE regexp_matches(request, '{REQUEST}')
),
rejected AS (SELECT * FROM kept WHERE NOT regexp_matches(request, '{REQUEST}')),
page AS (SELECT * FROM valid WHERE regexp_matches(request_url, '{PAGE}')),
non_page AS (SELECT * FROM valid WHERE NOT regexp_matches(request_url, '{PAGE}')),
hosts AS (SELECT DISTINCT host FROM page),
ip_hosts AS (
  SELECT host, {_ip_to_long("host")} AS ip_int FROM hosts
  WHERE regexp_matches(host, '{NUMERIC_HOST}')
),
ip_country AS (
  SELECT h.host, r.country FROM ip_hosts h JOIN ranges r ON h.ip_int BETWEEN r.begin_ip_int AND r.end_ip_int
),
name_hosts AS (
  SELECT host, nullif(string_split(rtrim(host, '.'), '.')[-1], '') AS country_code FROM hosts
  WHERE regexp_matches(host, '{HOST_NAME}')
),
codes AS (SELECT DISTINCT country_code, coalesce(country, 'NA') AS country FROM ranges WHERE country_code IS NOT NULL),
name_country AS (
  SELECT n.host, coalesce(c.country, 'NA') AS country
  FROM name_hosts n LEFT JOIN codes c ON n.country_code = c.country_code
),
host_map AS (
  SELECT DISTINCT host, country FROM (SELECT * FROM ip_country UNION ALL SELECT * FROM name_country)
),
tagged AS (SELECT p.*, m.country FROM page p LEFT JOIN host_map m ON p.host = m.host),
enriched AS (
  SELECT encrypted_host, datetime, CAST(epoch(datetime) AS BIGINT) AS epoch, request,
         TRY_CAST(http_response_code AS INTEGER) AS http_response_code,
         TRY_CAST(bytes AS BIGINT) AS bytes, request_url, country,
         CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month,
         CAST(day(datetime) AS INTEGER) AS day, event_id
  FROM (SELECT *, try_strptime(raw_timestamp, '%d/%b/%Y:%H:%M:%S') AS datetime FROM tagged)
)"""


def _sessions(gap: int, name: str = "sess") -> str:
    # hits of a host, numbered in time order; a hit without a time comes first
    return f"""
{name}_n AS (
  SELECT *, row_number() OVER (PARTITION BY encrypted_host ORDER BY datetime NULLS FIRST, event_id,
    country IS NULL OR country = 'NA' OR country LIKE 'OVER,%') AS i FROM enriched
),
{name}_g AS (
  SELECT a.*, a.epoch - b.epoch AS session_time_difference
  FROM {name}_n a LEFT JOIN {name}_n b ON a.encrypted_host = b.encrypted_host AND b.i = a.i - 1
),
{name}_starts AS (
  SELECT encrypted_host, i AS start, row_number() OVER (PARTITION BY encrypted_host ORDER BY i) - 1 AS no, request_url AS first_visited_page
  FROM {name}_g WHERE i = 1 OR session_time_difference >= {gap}
),
{name} AS (
  SELECT h.encrypted_host, datetime, epoch, request, http_response_code, bytes, h.request_url, country,
         year, month, day, session_time_difference,
         CAST(CASE WHEN session_time_difference >= {gap} THEN 1 ELSE 0 END AS INTEGER) AS is_new_session,
         h.encrypted_host || '_' || CAST(s.no AS VARCHAR) AS session_id,
         s.first_visited_page, h.request_url AS last_visited_page,
         CAST(count(h.request_url) OVER (PARTITION BY h.encrypted_host, s.no ORDER BY i) AS BIGINT) AS page_count,
         event_id
  FROM {name}_g h ASOF JOIN {name}_starts s ON h.encrypted_host = s.encrypted_host AND h.i >= s.start
),
{name}_day AS (
  SELECT *, CAST(datetime AS DATE) AS d FROM {name} WHERE datetime IS NOT NULL
),
{name}_sd AS (
  SELECT d, session_id, any_value(encrypted_host) AS encrypted_host, COUNT(*) AS hits,
         SUM(CASE WHEN session_time_difference <= {DURATION_GAP} THEN session_time_difference END) AS duration
  FROM {name}_day GROUP BY d, session_id
),
{name}_last AS (
  SELECT d, session_id, last_visited_page FROM (
    SELECT d, session_id, last_visited_page,
           ROW_NUMBER() OVER (PARTITION BY d, session_id ORDER BY datetime DESC, event_id DESC) AS rn
    FROM {name}_day) WHERE rn = 1
),
{name}_page_hits AS (
  SELECT d, request_url, COUNT(*) AS page_request_count FROM {name}_day GROUP BY d, request_url
),
{name}_exits AS (
  SELECT e.d, e.request_url, e.count_last_visit, p.page_request_count,
         {_round("e.count_last_visit / p.page_request_count * 100")} AS exit_rate
  FROM (SELECT d, last_visited_page AS request_url, COUNT(*) AS count_last_visit
        FROM {name}_last GROUP BY d, last_visited_page) e
  JOIN {name}_page_hits p ON e.d = p.d AND e.request_url = p.request_url
),
{name}_metrics AS (
  SELECT d, COUNT(DISTINCT encrypted_host) AS unique_visitor_count,
         COUNT(*) AS user_session_count,
         {_round("avg(duration) / 60")} AS avg_session_duration,
         CAST(round(avg(duration)) AS BIGINT) AS avg_session_duration_sec,
         CAST(SUM(hits) AS BIGINT) AS page_views_count,
         COUNT(*) FILTER (WHERE hits = 1) AS bounce_count,
         {_round("(COUNT(*) FILTER (WHERE hits = 1)) / COUNT(*) * 100")} AS bounce_rate
  FROM {name}_sd GROUP BY d
),
{name}_hd AS (SELECT DISTINCT encrypted_host, d FROM {name}_day),
{name}_new AS (
  SELECT t.d, CAST(COUNT(*) FILTER (WHERE NOT EXISTS (
            SELECT 1 FROM {name}_hd h WHERE h.encrypted_host = t.encrypted_host
              AND h.d >= t.d - {{lookback}} AND h.d < t.d)) AS BIGINT) AS new_users_count
  FROM {name}_hd t GROUP BY t.d
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


def _sess_query(gap: int, body: str, lookback: int = 7) -> str:
    return _with(RAW, _sessions(gap).replace("{lookback}", str(lookback))) + body


DAY = "strftime(d, '%Y-%m-%d')"
SESSION_COLS = (
    "encrypted_host, datetime, epoch, request, http_response_code, bytes, request_url, country, "
    "year, month, day, session_time_difference, is_new_session, session_id, first_visited_page, "
    "last_visited_page, page_count, event_id"
)


def _top_k(src: str, measure: str, k: int) -> str:
    return f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY d ORDER BY {measure} DESC, request_url ASC) AS rk
      FROM {src}) WHERE rk <= {k}"""


def _daily(gap: int, lookback: int) -> str:
    return _sess_query(
        gap,
        f"""SELECT CAST(year(m.d) AS INTEGER) AS insight_year, CAST(month(m.d) AS INTEGER) AS insight_month,
       CAST(day(m.d) AS INTEGER) AS insight_day, strftime(m.d, '%Y-%m-%d') AS insight_date,
       m.unique_visitor_count, m.user_session_count, m.avg_session_duration, m.avg_session_duration_sec,
       m.page_views_count, m.bounce_count, m.bounce_rate, coalesce(n.new_users_count, 0) AS new_users_count
FROM sess_metrics m LEFT JOIN sess_new n ON m.d = n.d""",
        lookback,
    )


def _page_insights(gap: int, k_hits: int, k_exit: int) -> str:
    return _sess_query(
        gap,
        f"""SELECT {DAY} AS insight_date, 'Page_Hits' AS query_type, request_url,
       CAST(page_request_count AS DOUBLE) AS measure_value
FROM ({_top_k("sess_page_hits", "page_request_count", k_hits)})
UNION ALL
SELECT {DAY} AS insight_date, 'Exit_Rate' AS query_type, request_url, exit_rate AS measure_value
FROM ({_top_k("sess_exits", "exit_rate", k_exit)})""",
    )


GAP_30M = 1800
RERUN_DAY = "2024-01-15"
GAP_6H = 21600
LOOKBACK_DAYS = 7
TOP_K = 10
WINDOW_DAYS = 7


def oracle_sql() -> dict[str, str]:
    base = _with(RAW)
    any_null = " OR ".join(
        f'"{c}" IS NULL' if c == "timestamp" else f"{c} IS NULL"
        for c in ["host", "hyphen_string1", "hyphen_string2", "timestamp", "timezone", "request",
                  "http_response_code", "bytes"]
    )
    routed = "encrypted_host, raw_timestamp, request, http_response_code, bytes"
    q: dict[str, str] = {}
    q["route_counts"] = base + f"""
SELECT 'null' AS route, (SELECT COUNT(*) FROM raw WHERE {any_null}) AS hits
UNION ALL SELECT 'kept', (SELECT COUNT(*) FROM kept)
UNION ALL SELECT 'rejected', (SELECT COUNT(*) FROM rejected)
UNION ALL SELECT 'page', (SELECT COUNT(*) FROM page)
UNION ALL SELECT 'non_page', (SELECT COUNT(*) FROM non_page)"""
    q["rejected_hits"] = base + f"SELECT {routed} FROM rejected"
    q["page_hits"] = base + f"SELECT {routed} FROM page"
    q["non_page_hits"] = base + f"SELECT {routed} FROM non_page"
    q["null_hits"] = base + f"""
SELECT host, hyphen_string1, hyphen_string2, "timestamp", timezone, request, http_response_code, bytes, event_id
FROM raw WHERE {any_null}"""
    q["raw_log_roundtrip"] = base + """
SELECT host, raw_timestamp, timezone, request, http_response_code, bytes,
       try_strptime(raw_timestamp, '%d/%b/%Y:%H:%M:%S') AS datetime
FROM kept"""
    q["host_kind"] = base + f"""
SELECT host, regexp_matches(host, '{NUMERIC_HOST}') AS is_ip,
       regexp_matches(host, '{HOST_NAME}') AS is_name,
       CASE WHEN regexp_matches(host, '{HOST_NAME}')
            THEN nullif(string_split(rtrim(host, '.'), '.')[-1], '') END AS suffix
FROM hosts"""
    q["ip_to_int"] = base + "SELECT host, ip_int FROM ip_hosts"
    q["ip_range_country"] = base + "SELECT DISTINCT host, country FROM ip_country"
    q["ip_range_country_bucketed"] = base + "SELECT host, country FROM ip_country"
    q["smallest_range_country"] = base + """
SELECT host, country FROM (
  SELECT h.host, r.country, row_number() OVER (PARTITION BY h.host ORDER BY end_ip_int - begin_ip_int, r.country NULLS FIRST) AS k
  FROM ip_hosts h JOIN ranges r ON h.ip_int BETWEEN r.begin_ip_int AND r.end_ip_int)
WHERE k = 1"""
    q["ambiguous_hosts"] = base + "SELECT host, COUNT(*) AS countries FROM host_map GROUP BY host HAVING COUNT(*) > 1"
    q["labelled_countries"] = base + """
SELECT event_id, CASE WHEN country IS NULL OR country = 'NA' THEN 'unknown' ELSE country END AS country FROM tagged"""
    q["ip_ranges_csv"] = base + "SELECT begin_ip_int, end_ip_int, country_code, country FROM ranges"
    q["pseudonymised_hosts"] = base + """
SELECT host, host AS back, CAST((16 * (octet_length(encode(host)) // 16 + 1) + 2) // 3 * 4 AS INTEGER) AS token_length, true AS same_token
FROM hosts"""
    q["host_suffix_country"] = base + "SELECT host, country FROM name_country"
    q["country_tagged_hits"] = base + "SELECT event_id, encrypted_host, request_url, country FROM tagged"
    q["country_tagged_hits_direct"] = q["country_tagged_hits"]
    q["country_tagged_hits_bucketed"] = q["country_tagged_hits"]
    q["country_tagged_hits_shuffle"] = q["country_tagged_hits"]
    q["time_columns"] = base + """
SELECT encrypted_host, datetime, epoch, request, http_response_code, bytes, request_url, country,
       year, month, day, event_id FROM enriched"""
    q["time_columns_with_offset"] = base + """
SELECT encrypted_host, datetime, CAST(epoch(datetime) AS BIGINT) AS epoch, request,
       TRY_CAST(http_response_code AS INTEGER) AS http_response_code, TRY_CAST(bytes AS BIGINT) AS bytes, request_url, country,
       CAST(year(datetime) AS INTEGER) AS year, CAST(month(datetime) AS INTEGER) AS month, CAST(day(datetime) AS INTEGER) AS day, event_id
FROM (
  SELECT *, try_strptime(raw_timestamp, '%d/%b/%Y:%H:%M:%S')
            + CASE timezone WHEN '+0000]' THEN INTERVAL 0 HOUR WHEN '-0400]' THEN INTERVAL 4 HOUR END AS datetime
  FROM tagged)"""
    q["date_prefix"] = base + "SELECT event_id, strftime(datetime, '%Y-%m-%d') AS date_text FROM enriched"
    q["gaps_and_flags"] = _sess_query(
        GAP_30M, "SELECT event_id, encrypted_host, session_time_difference, is_new_session FROM sess"
    )
    q["session_hits_30m"] = _sess_query(GAP_30M, f"SELECT {SESSION_COLS} FROM sess")
    q["session_hits_30m_window"] = q["session_hits_30m"]
    q["session_hits_bucketed"] = q["session_hits_30m"]
    q["session_hits_30m_chunked"] = q["session_hits_30m"]
    q["session_hits_6h_chunked"] = _sess_query(GAP_6H, f"SELECT {SESSION_COLS} FROM sess")
    q["session_hits_6h"] = _sess_query(GAP_6H, f"SELECT {SESSION_COLS} FROM sess")
    q["session_rollup"] = _sess_query(
        GAP_6H,
        f"""SELECT s.session_id, any_value(s.encrypted_host) AS encrypted_host, MIN(s.datetime) AS session_start,
       MAX(s.datetime) AS session_end, COUNT(*) AS hits,
       CAST(SUM(CASE WHEN s.session_time_difference <= {DURATION_GAP} THEN s.session_time_difference END) AS BIGINT) AS duration,
       any_value(s.first_visited_page) AS entry_page, any_value(l.last_visited_page) AS exit_page
FROM sess s JOIN (SELECT session_id, last_visited_page FROM (
    SELECT session_id, last_visited_page,
           ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY datetime DESC, event_id DESC) AS rn FROM sess)
  WHERE rn = 1) l ON s.session_id = l.session_id
GROUP BY s.session_id""",
    )
    q["unique_visitors"] = _sess_query(GAP_30M, f"SELECT {DAY} AS insight_date, unique_visitor_count FROM sess_metrics")
    q["user_sessions"] = _sess_query(GAP_30M, f"SELECT {DAY} AS insight_date, user_session_count FROM sess_metrics")
    q["page_views"] = _sess_query(GAP_30M, f"SELECT {DAY} AS insight_date, page_views_count FROM sess_metrics")
    q["avg_session_duration"] = _sess_query(
        GAP_6H,
        f"SELECT {DAY} AS insight_date, avg_session_duration, avg_session_duration_sec FROM sess_metrics",
    )
    q["bounce_rate"] = _sess_query(
        GAP_6H,
        f"SELECT {DAY} AS insight_date, bounce_count, user_session_count, bounce_rate FROM sess_metrics",
    )
    q["top_pages"] = _sess_query(
        GAP_30M,
        f"SELECT {DAY} AS insight_date, request_url, page_request_count FROM ({_top_k('sess_page_hits', 'page_request_count', TOP_K)})",
    )
    q["country_traffic"] = _sess_query(
        GAP_30M,
        f"SELECT {DAY} AS insight_date, country AS country_name, COUNT(*) AS page_request_count FROM sess_day GROUP BY d, country",
    )
    q["last_page_per_session"] = _sess_query(
        GAP_6H,
        """SELECT session_id, last_visited_page FROM (
    SELECT session_id, last_visited_page,
           ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY datetime DESC, event_id DESC) AS rn FROM sess)
WHERE rn = 1""",
    )
    q["exit_rates"] = _sess_query(
        GAP_6H,
        f"SELECT {DAY} AS insight_date, request_url, count_last_visit, page_request_count, exit_rate FROM sess_exits",
    )
    q["page_insights"] = _page_insights(GAP_30M, TOP_K, TOP_K)
    q["page_insights_6h"] = _page_insights(GAP_6H, TOP_K, TOP_K)
    q["new_visitors"] = _sess_query(
        GAP_30M, f"SELECT {DAY} AS insight_date, new_users_count FROM sess_new", LOOKBACK_DAYS
    )
    q["daily_insights"] = _daily(GAP_30M, LOOKBACK_DAYS)
    q["daily_insights_6h"] = _daily(GAP_6H, LOOKBACK_DAYS)
    q["country_insights"] = q["country_traffic"]
    for table in ("daily_insights", "page_insights", "country_insights"):
        q[f"{table}_refreshed"] = q[table]
    q["country_rank"] = _sess_query(
        GAP_30M,
        f"""SELECT {DAY} AS insight_date, country AS country_name, n AS page_request_count,
       CAST(row_number() OVER (PARTITION BY d ORDER BY n DESC, country NULLS LAST) AS INTEGER) AS country_rank
FROM (SELECT d, country, COUNT(*) AS n FROM sess_day GROUP BY d, country)""",
    )
    q["site_insights"] = _sess_query(
        GAP_30M,
        f"""SELECT COUNT(DISTINCT encrypted_host) AS unique_visitor_count, COUNT(*) AS user_session_count,
       {_round("avg(duration) / 60")} AS avg_session_duration,
       CAST(round(avg(duration)) AS BIGINT) AS avg_session_duration_sec,
       CAST(SUM(hits) AS BIGINT) AS page_views_count
FROM (SELECT session_id, any_value(encrypted_host) AS encrypted_host, COUNT(*) AS hits,
             SUM(CASE WHEN session_time_difference <= {DURATION_GAP} THEN session_time_difference END) AS duration
      FROM sess GROUP BY session_id)""",
    )
    site_exits = f"""
SELECT e.request_url, e.count_last_visit, p.count_page_visit,
       {_round("e.count_last_visit / p.count_page_visit * 100")} AS exit_rate
FROM (SELECT last_visited_page AS request_url, COUNT(*) AS count_last_visit FROM (
        SELECT last_visited_page, ROW_NUMBER() OVER (PARTITION BY session_id ORDER BY datetime DESC, event_id DESC) AS rn
        FROM sess) WHERE rn = 1 GROUP BY last_visited_page) e
JOIN (SELECT request_url, COUNT(*) AS count_page_visit FROM sess GROUP BY request_url) p
  ON e.request_url = p.request_url"""
    q["site_top_pages"] = _sess_query(
        GAP_6H,
        f"""SELECT request_url, COUNT(*) AS count_page_visit FROM sess GROUP BY request_url
ORDER BY count_page_visit DESC, request_url ASC LIMIT {TOP_K}""",
    )
    q["site_top_exits"] = _sess_query(
        GAP_6H, f"SELECT * FROM ({site_exits}) ORDER BY exit_rate DESC, request_url ASC LIMIT {TOP_K}"
    )
    q["partitioned_rewrite"] = q["time_columns"]
    q["publish_rerun"] = q["daily_insights"]
    q["session_view_sql"] = _sess_query(
        GAP_30M, "SELECT session_id, max(page_count) AS pages, count(*) AS hits FROM sess GROUP BY session_id"
    )
    q["published_tables"] = _sess_query(
        GAP_30M,
        f"""SELECT 'daily_insights' AS table_name, {DAY} AS insight_date, 'new_users_count' AS key, CAST(new_users_count AS DOUBLE) AS measure FROM sess_new
UNION ALL SELECT 'page_insights', {DAY}, 'Page_Hits ' || request_url, CAST(page_request_count AS DOUBLE)
FROM ({_top_k("sess_page_hits", "page_request_count", TOP_K)})
UNION ALL SELECT 'page_insights', {DAY}, 'Exit_Rate ' || request_url, exit_rate FROM ({_top_k("sess_exits", "exit_rate", TOP_K)})
UNION ALL SELECT 'country_insights', {DAY}, country, CAST(COUNT(*) AS DOUBLE) FROM sess_day GROUP BY d, country""",
        LOOKBACK_DAYS,
    )
    q["session_history"] = q["daily_insights"]
    q["session_csv_scan"] = _sess_query(GAP_30M, f"SELECT {SESSION_COLS.removesuffix(', event_id')} FROM sess")
    q["managed_table"] = q["time_columns"]
    q["external_tables"] = base + """
SELECT encrypted_host, datetime, epoch, request, http_response_code, bytes, request_url, country,
       year, month, day FROM enriched"""
    q["session_hits_sql"] = q["session_hits_30m"]
    q["streamed_enriched_log"] = base + """
SELECT encrypted_host, datetime, epoch, request, http_response_code, bytes, request_url, country,
       year, month, day FROM enriched"""
    q["session_hits_incremental"] = q["session_hits_30m"]
    q["new_visitors_incremental"] = _sess_query(
        GAP_30M, f"SELECT {DAY} AS insight_date, new_users_count FROM sess_new WHERE new_users_count > 0", LOOKBACK_DAYS
    )
    q["window_visitors"] = _sess_query(
        GAP_30M,
        f"""SELECT strftime(e.d, '%Y-%m-%d') AS window_end, COUNT(DISTINCT h.encrypted_host) AS exact_visitors, true AS within_3_percent
FROM (SELECT DISTINCT d FROM sess_hd) e JOIN sess_hd h ON h.d BETWEEN e.d - {WINDOW_DAYS - 1} AND e.d GROUP BY e.d""",
    )
    q["country_upsert"] = _sess_query(
        GAP_30M,
        f"""SELECT {DAY} AS insight_date, country AS country_name,
       COUNT(*) + CASE WHEN {DAY} = '{RERUN_DAY}' AND length(coalesce(country, '')) % 2 = 0 THEN 1000 ELSE 0 END AS page_request_count
FROM sess_day GROUP BY d, country UNION ALL SELECT '{RERUN_DAY}', 'Nowhere', 1""",
    )
    q["ordered_sessions"] = _sess_query(
        GAP_30M,
        """SELECT row_number() OVER (ORDER BY h.encrypted_host NULLS FIRST, h.datetime NULLS FIRST, h.i) AS position,
       h.encrypted_host, h.datetime, h.event_id, h.encrypted_host || '_' || CAST(s.no AS VARCHAR) AS session_id, h.request_url
FROM sess_n h ASOF JOIN sess_starts s ON h.encrypted_host = s.encrypted_host AND h.i >= s.start""",
    )
    q["routed_tables"] = _sess_query(
        GAP_30M,
        f"""SELECT 'null' AS route, COUNT(*) AS hits, COUNT(DISTINCT host) AS hosts FROM raw WHERE {any_null}
UNION ALL SELECT 'rejected', COUNT(*), COUNT(DISTINCT encrypted_host) FROM rejected
UNION ALL SELECT 'page', COUNT(*), COUNT(DISTINCT encrypted_host) FROM page
UNION ALL SELECT 'non_page', COUNT(*), COUNT(DISTINCT encrypted_host) FROM non_page
UNION ALL SELECT 'enriched', COUNT(*), COUNT(DISTINCT encrypted_host) FROM enriched
UNION ALL SELECT 'session', COUNT(*), COUNT(DISTINCT encrypted_host) FROM sess""",
    )
    q["sql_functions"] = _sess_query(
        GAP_30M,
        f"""SELECT event_id, session_id, page_count, encrypted_host AS host_back, request_url AS resource,
       CASE WHEN regexp_matches(encrypted_host, '{NUMERIC_HOST}') THEN {_ip_to_long("encrypted_host")} END AS ip_int,
       nullif(string_split(rtrim(encrypted_host, '.'), '.')[-1], '') AS suffix,
       strftime(datetime, '%Y-%m-%d') AS date_text
FROM sess""",
    )
    q["land_late_files"] = base + """
SELECT coalesce(strftime(try_strptime(replace("timestamp", '[', ''), '%d/%b/%Y:%H:%M:%S'), '%Y-%m-%d'), 'unknown') AS day,
       COUNT(*) AS lines FROM raw GROUP BY 1"""
    q["land_new_days"] = base + """
SELECT coalesce(strftime(try_strptime(replace("timestamp", '[', ''), '%d/%b/%Y:%H:%M:%S'), '%Y-%m-%d'), 'unknown') AS day,
       COUNT(*) AS lines FROM raw GROUP BY 1"""
    return q
