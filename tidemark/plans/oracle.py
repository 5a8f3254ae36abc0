"""The same queries as SQL text, stated independently for a second engine.

Windows are listed row by row here, and the running maximum is one ordered window over the
whole table: plain definitions, not the plans the library runs.
"""

from __future__ import annotations

K = "CAST(regexp_extract(props, '([0-9]+)\\}', 1) AS BIGINT)"

BEHAVIOR = f"""behavior AS (
  SELECT user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
         CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior,
         epoch_us(ts) // 1000 AS ms
  FROM events)"""

ACCESS_LOG = f"""log AS (
  SELECT event_id, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, CAST(user_id AS VARCHAR) AS user_id,
         epoch_us(ts) // 1000 AS ms,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
         '/' || event_type || '/' || CAST({K} AS VARCHAR) || CASE {K} % 8
           WHEN 0 THEN '.css' WHEN 1 THEN '.js' WHEN 2 THEN '.png' WHEN 3 THEN '.ico'
           WHEN 4 THEN '.css?x=1' WHEN 5 THEN '.CSS' WHEN 6 THEN '.html' ELSE '' END AS url
  FROM events)"""

PAGE = r"method = 'GET' AND NOT regexp_matches(url, '\.(css|js|png|ico)$')"


def _ends(size_ms: int, slide_ms: int) -> str:
    """Window ends of a row at ``ms``, for sizes that are multiples of the slide."""
    return f"unnest(generate_series((ms // {slide_ms}) * {slide_ms} + {slide_ms}, (ms // {slide_ms}) * {slide_ms} + {size_ms}, {slide_ms}))"


ITEM_COUNTS = f"""WITH {BEHAVIOR},
placed AS (SELECT item_id, {_ends(3600000, 300000)} AS window_end FROM behavior WHERE behavior = 'pv'),
counts AS (SELECT item_id, CAST(window_end AS BIGINT) AS window_end, count(*) AS view_count FROM placed GROUP BY 1, 2)"""

PAGE_COUNTS = f"""WITH {ACCESS_LOG},
placed AS (SELECT url, {_ends(600000, 5000)} AS window_end FROM log WHERE {PAGE}),
counts AS (SELECT url, CAST(window_end AS BIGINT) AS window_end, count(*) AS view_count FROM placed GROUP BY 1, 2)"""


def _ranked(counts: str, key: str, n: int) -> str:
    return f"""{counts},
ranked AS (SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, {key}) AS BIGINT) AS rank,
                  {key}, view_count FROM counts),
top AS (SELECT * FROM ranked WHERE rank <= {n})"""


def _report(counts: str, key: str, n: int, key_label: str, count_label: str) -> str:
    line = f"'NO ' || CAST(rank AS VARCHAR) || '{key_label}' || CAST({key} AS VARCHAR) || '{count_label}' || CAST(view_count AS VARCHAR) || chr(10)"
    stamp = "strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0'"
    return f"""{_ranked(counts, key, n)}
SELECT window_end, '==============' || chr(10) || 'Endtime：' || {stamp} || chr(10)
       || string_agg({line}, '' ORDER BY rank) || '===============================' || chr(10) || chr(10) AS report
FROM top GROUP BY window_end"""


ARRIVALS = f"""WITH {ACCESS_LOG},
arriving AS (SELECT *, ms + ((event_id * 7919) % 1801) * 1000 AS arrival_key FROM log),
clocked AS (SELECT *, max(ms) OVER (ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS running_max_ms
            FROM arriving)"""


def _late_counts(grace_ms: int) -> str:
    return f"""{ARRIVALS},
placed AS (SELECT url, running_max_ms, {_ends(600000, 5000)} AS window_end FROM clocked WHERE {PAGE}),
counts AS (SELECT url, CAST(window_end AS BIGINT) AS window_end, count(*) AS view_count FROM placed
           WHERE running_max_ms IS NULL OR running_max_ms < window_end + {grace_ms} GROUP BY 1, 2)"""


HOUR_END = "CAST((ms // 3600000) * 3600000 + 3600000 AS BIGINT)"


def _slot(bits: int) -> str:
    """Character codes folded from the left, reduced at every step."""
    codes = "list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"list_reduce({codes}, lambda a, c: (a * 61 + c) % {1 << bits}, CAST(0 AS BIGINT))"


def _bitmap(bits: int) -> str:
    return f"""WITH {BEHAVIOR}
SELECT {HOUR_END} AS window_end, count(DISTINCT {_slot(bits)}) AS uv_count
FROM behavior WHERE behavior = 'pv' GROUP BY 1"""


def _long_windows(who: str) -> str:
    """Visits of pages, once for each window of six hours that they lie in."""
    return f"""WITH {BEHAVIOR},
placed AS (SELECT {who} AS who, {_ends(21600000, 3600000)} AS window_end FROM behavior WHERE behavior = 'pv')"""


SECONDS = "epoch_us(ts) // 1000000"

DAMAGED = f"""WITH raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS u, CAST({K} AS VARCHAR) AS i, event_type AS b, CAST({SECONDS} AS VARCHAR) AS s FROM events),
lines AS (
  SELECT CASE event_id % 8
    WHEN 0 THEN u || ',' || i || ',1,' || b
    WHEN 1 THEN 'x' || u || ',' || i || ',1,' || b || ',' || s
    WHEN 2 THEN u || ', ' || i || ',1,' || b || ',' || s
    WHEN 3 THEN u || ',' || i || ',2147483648,' || b || ',' || s
    WHEN 4 THEN ''
    WHEN 5 THEN u || ',' || i || ',1,' || b || ',' || s || ',EXTRA'
    WHEN 6 THEN u || ',' || i || ',1,' || b || ','
    ELSE u || ',' || i || ',1,' || b || ',' || s END AS line FROM raw),
fielded AS (SELECT line, string_split(rtrim(line, ','), ',') AS f FROM lines),
judged AS (SELECT line, CASE
    WHEN len(f) < 5 THEN 'too few fields'
    WHEN NOT regexp_full_match(f[1], '[+-]?[0-9]+') THEN 'user_id'
    WHEN NOT regexp_full_match(f[2], '[+-]?[0-9]+') THEN 'item_id'
    WHEN NOT regexp_full_match(f[3], '[+-]?[0-9]+') OR TRY_CAST(f[3] AS INTEGER) IS NULL THEN 'category_id'
    WHEN NOT regexp_full_match(f[5], '[+-]?[0-9]+') THEN 'timestamp' END AS reason FROM fielded)
SELECT line, reason FROM judged WHERE reason IS NOT NULL"""

DAMAGED_LOG = f"""WITH raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS u, event_type AS b, strftime(ts, '%d/%m/%Y:%H:%M:%S') AS t FROM events),
lines AS (
  SELECT '10.0.0.1 ' || u || ' - ' || CASE event_id % 5
    WHEN 1 THEN '32' || substr(t, 3) WHEN 2 THEN t || 'x' WHEN 3 THEN '' ELSE t END
    || ' +0000 GET ' || CASE event_id % 5 WHEN 0 THEN '' ELSE '/' || b END AS line FROM raw),
fielded AS (SELECT line, string_split(rtrim(line, ' '), ' ') AS f FROM lines),
judged AS (SELECT line, CASE
    WHEN len(f) < 7 THEN 'too few fields'
    WHEN try_strptime(f[4], '%d/%m/%Y:%H:%M:%S') IS NULL THEN 'time' END AS reason FROM fielded)
SELECT line, reason FROM judged WHERE reason IS NOT NULL"""

CHANNEL_COUNTS = f"""WITH marketing AS (
  SELECT CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'DOWNLOAD' WHEN 'purchase' THEN 'INSTALL'
           WHEN 'signup' THEN 'INSTALL' WHEN 'error' THEN 'UNINSTALL' END AS behavior,
         CASE {K} % 4 WHEN 0 THEN 'app store' WHEN 1 THEN 'weibo' WHEN 2 THEN 'wechat' ELSE 'tieba' END AS channel,
         epoch_us(ts) // 1000 AS ms
  FROM events)
SELECT channel, behavior, strftime(make_timestamp({HOUR_END} * 1000), '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS count
FROM marketing WHERE behavior IS DISTINCT FROM 'UNINSTALL' GROUP BY 1, 2, 3"""

BATCH: dict[str, str] = {
    "item_view_counts": f"{ITEM_COUNTS} SELECT item_id, window_end, view_count FROM counts",
    "hot_items_top5": f"{_ranked(ITEM_COUNTS, 'item_id', 5)} SELECT window_end, rank, item_id, view_count FROM top",
    "page_view_counts": f"{PAGE_COUNTS} SELECT url, window_end, view_count FROM counts",
    "hot_pages_top3": f"{_ranked(PAGE_COUNTS, 'url', 3)} SELECT window_end, rank, url, view_count FROM top",
    "pv_hourly": f"""WITH {BEHAVIOR}
SELECT 'pv' AS name, {HOUR_END} AS window_end, count(*) AS count FROM behavior WHERE behavior = 'pv' GROUP BY 2""",
    "uv_hourly": f"""WITH {BEHAVIOR}
SELECT 'uv' AS name, {HOUR_END} AS window_end, count(DISTINCT user_id) AS count FROM behavior WHERE behavior = 'pv' GROUP BY 2""",
    "uv_hourly_bitmap": _bitmap(29),
    "uv_hourly_bitmap_128": _bitmap(7),
    "uv_hourly_bitmap_merged": _bitmap(29),
    "uv_sliding_bitmap": f"""{_long_windows(_slot(16))}
SELECT CAST(window_end AS BIGINT) AS window_end, count(DISTINCT who) AS uv_count FROM placed GROUP BY 1""",
    "uv_hourly_sketch": f"""WITH {BEHAVIOR}
SELECT {HOUR_END} AS window_end, count(DISTINCT user_id) AS visitors, true AS within_bound
FROM behavior WHERE behavior = 'pv' GROUP BY 1""",
    "uv_sliding_sketch": f"""{_long_windows("user_id")}
SELECT CAST(window_end AS BIGINT) AS window_end, count(DISTINCT who) AS visitors, true AS within_bound FROM placed GROUP BY 1""",
    "channel_behavior_counts": CHANNEL_COUNTS,
    "late_page_events": f"""{ARRIVALS}
SELECT event_id, ms AS event_ms, running_max_ms FROM clocked
WHERE {PAGE} AND running_max_ms >= (ms // 5000) * 5000 + 600000 + 65000""",
    "page_counts_first_fire": f"{_late_counts(5000)} SELECT url, window_end, view_count FROM counts",
    "page_counts_final": f"{_late_counts(65000)} SELECT url, window_end, view_count FROM counts",
    "hot_pages_first_fire_top3": f"{_ranked(_late_counts(5000), 'url', 3)} SELECT window_end, rank, url, view_count FROM top",
    "hot_pages_final_top3": f"{_ranked(_late_counts(65000), 'url', 3)} SELECT window_end, rank, url, view_count FROM top",
    "static_asset_filter": rf"""WITH {ACCESS_LOG}
SELECT event_id, url FROM log WHERE NOT regexp_matches(url, '\.(css|js|png|ico)$')""",
    "parse_user_behavior": f"""WITH {BEHAVIOR}
SELECT user_id, item_id, category_id, behavior, CAST((ms // 1000) * 1000 AS BIGINT) AS event_ms FROM behavior""",
    "parse_access_log": f"""WITH {ACCESS_LOG}
SELECT ip, user_id, CAST((ms // 1000) * 1000 AS BIGINT) AS event_ms, method, url FROM log""",
    "parse_rejects": DAMAGED,
    "parse_log_rejects": DAMAGED_LOG,
    "hot_items_report": _report(ITEM_COUNTS, "item_id", 5, ": 商品ID = ", " 热门度 = "),
    "hot_pages_report": _report(PAGE_COUNTS, "url", 3, ": URL = ", " Page View = "),
}

# Streams run to the end of their input, and readers of files, have the results of the batch queries.
STREAMS: dict[str, str] = {
    stream: BATCH[batch]
    for stream, batch in {
        "pv_hourly_stream": "pv_hourly",
        "uv_hourly_stream": "uv_hourly",
        "channel_behavior_counts_stream": "channel_behavior_counts",
        "hot_items_top5_stream": "hot_items_top5",
        "hot_items_report_stream": "hot_items_report",
        "uv_hourly_bitmap_stream": "uv_hourly_bitmap",
        "page_view_counts_stream": "page_view_counts",
        "hot_pages_top3_stream": "hot_pages_top3",
        "late_page_events_stream": "late_page_events",
        "page_counts_first_fire_stream": "page_counts_first_fire",
        "page_counts_final_stream": "page_counts_final",
        "hot_pages_first_fire_top3_stream": "hot_pages_first_fire_top3",
        "hot_pages_final_top3_stream": "hot_pages_final_top3",
        "hot_items_from_files": "hot_items_top5",
        "hot_items_from_files_stream": "hot_items_top5",
        "uv_hourly_from_files": "uv_hourly",
        "hot_pages_report_from_files": "hot_pages_report",
        "page_counts_from_files_stream": "page_view_counts",
        "channel_counts_from_files": "channel_behavior_counts",
        "channel_counts_from_files_stream": "channel_behavior_counts",
    }.items()
}
STREAMS["hot_pages_first_report_stream"] = _report(_late_counts(5000), "url", 3, ": URL = ", " Page View = ")
