"""DuckDB twins of every registered query.

Each string runs on the driver's parquet views (``events`` here) and must give
the same rows, column names and types as the Spark query of the same key.
Windows are enumerated the plain way (``generate_series`` over the slides of
each event), never with the pane method the Spark side uses, so the two are
independent.  Times are compared at full microsecond precision and reported
as epoch milliseconds.
"""

from __future__ import annotations

from tidemark.plans import params as P

_US = 1_000_000
_MS = 1_000

# column derivations shared by the oracle strings; they restate FIXTURES.md
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_TS_US = "epoch_us(ts)"
_TS_MS = "epoch_us(ts) // 1000"  # floor; epoch_ms() rounds


def _sliding_counts(where: str, key_exprs: dict[str, str], size_s: int, slide_s: int,
                    value: str = "COUNT(*)", value_name: str = "cnt",
                    with_start: bool = False) -> str:
    """Count per key and epoch-aligned sliding window, one row per non-empty window."""
    ratio = size_s // slide_s
    keys = ", ".join(f"{expr} AS {name}" for name, expr in key_exprs.items())
    key_names = ", ".join(key_exprs)
    keys_sel = f"{keys}, " if keys else ""
    key_group = f"{key_names}, " if key_names else ""
    start = f"(pane + m) * {slide_s * _MS} - {size_s * _MS} AS window_start_ms, " if with_start else ""
    return f"""
WITH src AS (
  SELECT {keys_sel}user_id, {_TS_US} // {slide_s * _US} AS pane
  FROM events WHERE {where}
)
SELECT {key_group}{start}(pane + m) * {slide_s * _MS} AS window_end_ms, {value} AS {value_name}
FROM src CROSS JOIN generate_series(1, {ratio}) AS g(m)
GROUP BY ALL"""


def _top_n(counts_sql: str, key: str, n: int) -> str:
    return f"""
WITH c AS ({counts_sql})
SELECT window_end_ms, {key}, cnt, rank_no FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY cnt DESC, {key}) AS rank_no
  FROM c
) WHERE rank_no <= {n}"""


_ITEM = {"item_id": f"{_K} % {P.ITEM_MOD}"}
_VIEWS = "event_type = 'view'"

WINDOWED_COUNT = _sliding_counts(_VIEWS, _ITEM, P.HOT_ITEMS_SIZE_S, P.HOT_ITEMS_SLIDE_S)

HOT_ITEMS = _top_n(WINDOWED_COUNT, "item_id", P.HOT_ITEMS_N)

HOT_PAGES = _top_n(
    _sliding_counts("event_type = 'click'",
                    {"url": f"'/p/' || CAST({_K} % {P.URL_MOD} AS VARCHAR)"},
                    P.HOT_PAGES_SIZE_S, P.HOT_PAGES_SLIDE_S),
    "url", P.HOT_PAGES_N)

PAGE_VIEWS = _sliding_counts(_VIEWS, {}, P.PV_SIZE_S, P.PV_SLIDE_S)

UNIQUE_VISITORS = _sliding_counts("TRUE", {}, P.PV_SIZE_S, P.PV_SLIDE_S,
                                  value="COUNT(DISTINCT user_id)", value_name="uv")

_BITMAP_OFFSET = (
    "list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), "
    "lambda ch: CAST(ascii(ch) AS BIGINT)), "
    f"lambda acc, ch: (acc * {P.BITMAP_SEED} + ch) % {1 << P.BITMAP_LOG2_BITS}, CAST(0 AS BIGINT))"
)

UNIQUE_VISITORS_HLL = f"""
SELECT ({_TS_US} // {P.UV_TUMBLE_S * _US} + 1) * {P.UV_TUMBLE_S * _MS} AS window_end_ms,
       COUNT(DISTINCT user_id) AS exact_uv, TRUE AS within
FROM events WHERE {_VIEWS}
GROUP BY ALL"""

UNIQUE_VISITORS_BITMAP = f"""
SELECT ({_TS_US} // {P.UV_TUMBLE_S * _US} + 1) * {P.UV_TUMBLE_S * _MS} AS window_end_ms,
       COUNT(DISTINCT {_BITMAP_OFFSET}) AS uv
FROM events WHERE {_VIEWS}
GROUP BY ALL"""

UNIQUE_VISITORS_BITMAP_DAILY = f"""
SELECT ({_TS_US} // {P.UV_DAY_S * _US} + 1) * {P.UV_DAY_S * _MS} AS window_end_ms,
       COUNT(DISTINCT {_BITMAP_OFFSET}) AS uv
FROM events WHERE {_VIEWS}
GROUP BY ALL"""

RUNNING_UNIQUE_VISITORS = f"""
WITH v AS (
  SELECT event_id, user_id, ts, {_TS_US} // {P.UV_TUMBLE_S * _US} AS w
  FROM events WHERE {_VIEWS}
), f AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY w, user_id ORDER BY ts, event_id) = 1
                 THEN 1 ELSE 0 END AS first_seen
  FROM v
)
SELECT (w + 1) * {P.UV_TUMBLE_S * _MS} AS window_end_ms, event_id, user_id,
       SUM(first_seen) OVER (PARTITION BY w ORDER BY ts, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS uv
FROM f"""

CHANNEL_COUNTS = _sliding_counts(
    f"event_type = '{P.CHANNEL_BEHAVIOR}'",
    {"channel": f"CAST({_K} % {P.CHANNEL_MOD} AS VARCHAR)", "behavior": "event_type"},
    P.CHANNEL_SIZE_S, P.CHANNEL_SLIDE_S, with_start=True)

_LOCAL_DAY = f"({_TS_US} + {P.AD_DAY_OFFSET_S * _US}) // {86400 * _US}"

_AD_RANKED = f"""
WITH c AS (
  SELECT event_id, user_id, {_K} % {P.AD_MOD} AS ad_id,
         CAST(user_id % {P.PROVINCE_MOD} AS VARCHAR) AS province, ts, {_TS_MS} AS ts_ms,
         {_LOCAL_DAY} AS local_day
  FROM events WHERE event_type = 'click'
), r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, local_day ORDER BY ts, event_id) AS rn
  FROM c
)"""

AD_CLICK_FILTER = _AD_RANKED + f"""
SELECT event_id, user_id, ad_id, province, ts_ms FROM r WHERE rn <= {P.AD_MAX_CLICKS}"""

AD_CLICK_WARNINGS = _AD_RANKED + f"""
SELECT user_id, ad_id, local_day * {86400 * _MS} - {P.AD_DAY_OFFSET_S * _MS} AS day_start_ms,
       event_id, ts_ms
FROM r WHERE rn = {P.AD_MAX_CLICKS + 1}"""

AD_CLICKS_BY_PROVINCE = _AD_RANKED + f"""
, src AS (SELECT province, {_TS_US} // {P.PROVINCE_SLIDE_S * _US} AS pane FROM r WHERE rn <= {P.AD_MAX_CLICKS})
SELECT province, (pane + m) * {P.PROVINCE_SLIDE_S * _MS} AS window_end_ms, COUNT(*) AS cnt
FROM src CROSS JOIN generate_series(1, {P.PROVINCE_SIZE_S // P.PROVINCE_SLIDE_S}) AS g(m)
GROUP BY ALL"""

_LOGINS = f"""
WITH l AS (
  SELECT event_id, user_id, ts, {_TS_US} AS ts_us,
         CASE event_type WHEN 'error' THEN 'fail' ELSE 'success' END AS login_type
  FROM events WHERE event_type IN ('error', 'signup')
), s AS (
  SELECT *, lead(login_type) OVER w AS next_type, lead(ts_us) OVER w AS next_us,
            lead(event_id) OVER w AS next_id,
            lag(login_type) OVER w AS prev_type, lag(ts_us) OVER w AS prev_us
  FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)"""

LOGIN_FAIL_PATTERN = _LOGINS + f"""
SELECT user_id, ts_us // 1000 AS first_fail_ms, next_us // 1000 AS last_fail_ms,
       '{P.MSG_LOGIN_PATTERN}' AS warning_msg
FROM s WHERE login_type = 'fail' AND next_type = 'fail' AND next_us - ts_us < {P.LOGIN_GAP_S * _US}"""

LOGIN_FAIL_IMMEDIATE = _LOGINS + f"""
SELECT user_id, event_id AS alert_event_id, prev_us // 1000 AS first_fail_ms, ts_us // 1000 AS last_fail_ms,
       '{P.MSG_LOGIN_IMMEDIATE}' AS warning_msg
FROM s WHERE login_type = 'fail' AND prev_type = 'fail' AND ts_us - prev_us < {P.LOGIN_GAP_S * _US}"""

LOGIN_FAIL_BURST = f"""
WITH l AS (
  SELECT event_id, user_id, ts, {_TS_US} AS ts_us, event_type = 'error' AS is_fail
  FROM events WHERE event_type IN ('error', 'signup')
), i AS (
  SELECT *, SUM(CASE WHEN is_fail THEN 0 ELSE 1 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island
  FROM l
), runs AS (
  SELECT user_id, island, MIN(ts_us) AS t0 FROM i WHERE is_fail GROUP BY ALL
), closers AS (
  SELECT user_id, island - 1 AS island, ts_us AS close_us FROM i WHERE NOT is_fail
), hits AS (
  SELECT r.user_id, r.island, r.t0, COUNT(*) AS fail_count, MAX(i.ts_us) AS last_us
  FROM runs r JOIN i ON i.user_id = r.user_id AND i.island = r.island AND i.is_fail
                    AND i.ts_us <= r.t0 + {P.BURST_WINDOW_S * _US}
  GROUP BY ALL
)
SELECT h.user_id, h.t0 // 1000 AS first_fail_ms, h.last_us // 1000 AS last_fail_ms, h.fail_count,
       printf('{P.MSG_LOGIN_BURST}', h.fail_count) AS warning_msg
FROM hits h LEFT JOIN closers c ON c.user_id = h.user_id AND c.island = h.island
WHERE h.fail_count >= {P.BURST_MIN_FAILS}
  AND (c.close_us IS NULL OR c.close_us > h.t0 + {P.BURST_WINDOW_S * _US})"""

_ORDER_EVENTS = f"""
WITH o AS (
  SELECT event_id, user_id AS order_id, ts, {_TS_US} AS ts_us,
         CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS event,
         CASE event_type WHEN 'signup' THEN 0 ELSE 1 END AS pay_first
  FROM events WHERE event_type IN ('signup', 'purchase')
)"""

ORDER_TIMEOUT = _ORDER_EVENTS + f"""
, s AS (
  SELECT *, MIN(CASE WHEN event = 'pay' THEN ts_us END)
              OVER (PARTITION BY order_id ORDER BY ts, pay_first, event_id
                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pay_us
  FROM o
)
SELECT order_id, event_id AS create_event_id, ts_us // 1000 AS create_ms,
       CASE WHEN next_pay_us - ts_us < {P.ORDER_TIMEOUT_S * _US} THEN 'pay' ELSE 'timeout' END AS result,
       CASE WHEN next_pay_us - ts_us < {P.ORDER_TIMEOUT_S * _US} THEN next_pay_us // 1000
            ELSE ts_us // 1000 + {P.ORDER_TIMEOUT_S * _MS} END AS result_ms
FROM s WHERE event = 'create'"""

ORDER_PAY_MATCH = _ORDER_EVENTS + f"""
, s AS (
  SELECT *, lead(event) OVER w AS next_event, lead(ts_us) OVER w AS next_us,
            lag(event) OVER w AS prev_event, lag(ts_us) OVER w AS prev_us
  FROM o WINDOW w AS (PARTITION BY order_id ORDER BY ts, pay_first, event_id)
)
SELECT order_id, ts_us // 1000 AS create_ms, next_us // 1000 AS pay_ms, '{P.MSG_PAY_SUCCESS}' AS result
FROM s WHERE event = 'create' AND next_event = 'pay' AND next_us - ts_us <= {P.ORDER_MATCH_S * _US}
UNION ALL
SELECT order_id, ts_us // 1000 AS create_ms, CAST(NULL AS BIGINT) AS pay_ms, '{P.MSG_NOT_PAYED}' AS result
FROM s WHERE event = 'create' AND NOT coalesce(next_us - ts_us <= {P.ORDER_MATCH_S * _US}, FALSE)
UNION ALL
SELECT order_id, CAST(NULL AS BIGINT) AS create_ms, ts_us // 1000 AS pay_ms, '{P.MSG_NO_CREATE}' AS result
FROM s WHERE event = 'pay'
  AND NOT coalesce(prev_event = 'create' AND ts_us - prev_us <= {P.ORDER_MATCH_S * _US}, FALSE)"""

_TX_SIDES = f"""
WITH p AS (
  SELECT user_id AS tx_id, event_id, ts, {_TS_US} AS ts_us FROM events WHERE event_type = 'purchase'
), r AS (
  SELECT user_id AS tx_id, event_id, ts, {_TS_US} AS ts_us FROM events WHERE event_type = 'click'
)"""

TX_INTERVAL_JOIN = _TX_SIDES + f"""
SELECT p.tx_id, p.event_id AS pay_event_id, r.event_id AS receipt_event_id,
       p.ts_us // 1000 AS pay_ms, r.ts_us // 1000 AS receipt_ms, 'app' AS pay_channel
FROM p JOIN r ON p.tx_id = r.tx_id
 AND r.ts_us BETWEEN p.ts_us - {P.TX_JOIN_BEFORE_S * _US} AND p.ts_us + {P.TX_JOIN_AFTER_S * _US}"""

TX_MATCH = _TX_SIDES + f"""
, u AS (
  SELECT tx_id, event_id, ts_us, 0 AS is_receipt FROM p
  UNION ALL SELECT tx_id, event_id, ts_us, 1 AS is_receipt FROM r
), s AS (
  SELECT *, lag(is_receipt) OVER w AS p_receipt, lag(ts_us) OVER w AS p_us, lag(event_id) OVER w AS p_id,
         lead(is_receipt) OVER w AS n_receipt, lead(ts_us) OVER w AS n_us
  FROM u WINDOW w AS (PARTITION BY tx_id ORDER BY ts_us, is_receipt, event_id)
)
SELECT tx_id, 'matched' AS kind, p_id AS pay_event_id, event_id AS receipt_event_id,
       p_us // 1000 AS pay_ms, ts_us // 1000 AS receipt_ms, 'app' AS pay_channel
FROM s WHERE is_receipt = 1 AND p_receipt = 0 AND ts_us - p_us <= {P.TX_MATCH_WAIT_S * _US}
UNION ALL
SELECT tx_id, 'order_only' AS kind, event_id AS pay_event_id, CAST(NULL AS BIGINT) AS receipt_event_id,
       ts_us // 1000 AS pay_ms, CAST(NULL AS BIGINT) AS receipt_ms, CAST(NULL AS VARCHAR) AS pay_channel
FROM s WHERE is_receipt = 0 AND NOT coalesce(n_receipt = 1 AND n_us - ts_us <= {P.TX_MATCH_WAIT_S * _US}, FALSE)
UNION ALL
SELECT tx_id, 'receipt_only' AS kind, CAST(NULL AS BIGINT) AS pay_event_id, event_id AS receipt_event_id,
       CAST(NULL AS BIGINT) AS pay_ms, ts_us // 1000 AS receipt_ms, 'app' AS pay_channel
FROM s WHERE is_receipt = 1 AND NOT coalesce(p_receipt = 0 AND ts_us - p_us <= {P.TX_MATCH_WAIT_S * _US}, FALSE)"""

SPLIT_LATE = f"""
WITH a AS (
  SELECT event_id, user_id, {_TS_US} AS ts_us,
         {_TS_US} + CAST(round(value * 60000000) AS BIGINT) AS arrival_us
  FROM events
), m AS (
  SELECT *, MAX(ts_us) OVER (ORDER BY arrival_us, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {P.LATE_DELAY_S * _US} AS wm_us,
         (ts_us // {P.LATE_TUMBLE_S * _US} + 1) * {P.LATE_TUMBLE_S * _US} AS end_us
  FROM a
)
SELECT event_id, user_id, ts_us // 1000 AS ts_ms, arrival_us // 1000 AS arrival_ms,
       end_us // 1000 AS window_end_ms, wm_us // 1000 AS watermark_ms
FROM m WHERE end_us + {P.LATE_LATENESS_S * _US} <= wm_us"""


ORACLE_SQL: dict[str, str] = {
    "hot_items": HOT_ITEMS,
    "hot_items_sql": HOT_ITEMS,
    "hot_items_summaries": HOT_ITEMS,
    "hot_pages": HOT_PAGES,
    "windowed_count": WINDOWED_COUNT,
    "page_views": PAGE_VIEWS,
    "page_views_salted": PAGE_VIEWS,
    "unique_visitors": UNIQUE_VISITORS,
    "unique_visitors_bitmap": UNIQUE_VISITORS_BITMAP,
    "unique_visitors_bitmap_stored": UNIQUE_VISITORS_BITMAP,
    "unique_visitors_bitmap_daily": UNIQUE_VISITORS_BITMAP_DAILY,
    "unique_visitors_hll": UNIQUE_VISITORS_HLL,
    "running_unique_visitors": RUNNING_UNIQUE_VISITORS,
    "channel_counts": CHANNEL_COUNTS,
    "sliding_count_panes": CHANNEL_COUNTS,
    "ad_click_filter": AD_CLICK_FILTER,
    "ad_click_warnings": AD_CLICK_WARNINGS,
    "ad_clicks_by_province": AD_CLICKS_BY_PROVINCE,
    "login_fail_pattern": LOGIN_FAIL_PATTERN,
    "login_fail_pattern_cut": LOGIN_FAIL_PATTERN,
    "login_fail_burst": LOGIN_FAIL_BURST,
    "login_fail_immediate": LOGIN_FAIL_IMMEDIATE,
    "order_timeout": ORDER_TIMEOUT,
    "order_pay_match": ORDER_PAY_MATCH,
    "tx_interval_join": TX_INTERVAL_JOIN,
    "tx_match": TX_MATCH,
    "split_late": SPLIT_LATE,
    "split_late_cut": SPLIT_LATE,
}
