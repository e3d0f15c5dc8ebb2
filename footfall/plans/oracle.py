"""Equivalent SQL for the catalog, written independently of the operators.

Window counts list every window of every row; folds are recursive; nothing here
uses panes, sweeps, blocks or carries.
"""

_BEHAVIOR = """
behavior AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) AS us,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
  FROM events
)"""


def _sliding(source: str, keys: str, size_ms: int, slide_ms: int) -> str:
    """Counts per (keys, window end): one row per event and window, then grouped."""
    return f"""
    SELECT {keys}, window_end, count(*) AS cnt
    FROM (
      SELECT {keys}, unnest(range((us // {slide_ms * 1000} + 1) * {slide_ms},
                                  (us // {slide_ms * 1000} + 1) * {slide_ms} + {size_ms}, {slide_ms})) AS window_end
      FROM {source}
    ) GROUP BY {keys}, window_end"""


def _top(counts: str, id_col: str, n: int, out: str) -> str:
    return f"""
    SELECT window_end, {id_col} AS {out}, cnt, CAST(rn AS INTEGER) AS row_num
    FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {id_col}) AS rn FROM ({counts}))
    WHERE rn <= {n}"""


def _runs(counts: str, keys: str, slide_ms: int) -> str:
    """Maximal runs of equal counts inside a UTC day of window ends."""
    return f"""
    SELECT {keys}, min(window_end) AS first_end, max(window_end) AS last_end, any_value(cnt) AS "count"
    FROM (
      SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY {keys} ORDER BY window_end) AS run
      FROM (
        SELECT *, coalesce(lag(window_end) OVER w = window_end - {slide_ms} AND lag(cnt) OVER w = cnt
                           AND window_end % 86400000 <> 0, false) AS same
        FROM ({counts}) WINDOW w AS (PARTITION BY {keys} ORDER BY window_end)
      )
    ) GROUP BY {keys}, run"""


_HOT_ITEM_COUNTS = _sliding("(SELECT k, us FROM behavior WHERE event_type = 'view')", "k", 3_600_000, 300_000)
_HOT_ITEMS = _top(_HOT_ITEM_COUNTS, "k", 5, "item_id")

_LATE = """
arrived AS (
  SELECT *, max(us) OVER (ORDER BY us + event_id * 7919 % 3600 * 1000000, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60000000 AS wm
  FROM {source}
),
tagged AS (
  SELECT *, CASE
    WHEN wm IS NULL THEN 'on_time'
    -- last window: its last millisecond plus five minutes is not ahead of the watermark
    WHEN (us // 5000000) * 5000000 + 600000000 - 1000 + 300000000 <= wm THEN 'late'
    -- some window that is still kept has fired
    WHEN (SELECT bool_or(e - 1000 <= wm AND e - 1000 + 300000000 > wm)
          FROM unnest(range((us // 5000000 + 1) * 5000000, (us // 5000000) * 5000000 + 605000000, 5000000)) AS t(e))
      THEN 'refire'
    ELSE 'on_time' END AS tag
  FROM arrived
)"""

_RELATE = (
    _LATE.replace("60000000 AS wm", "600000000 AS wm")
    .replace("(us // 5000000) * 5000000 + 600000000 - 1000 + 300000000 <= wm", "(us // 600000000) * 600000000 + 1200000000 - 1000 + 900000000 <= wm")
    .replace("e - 1000 + 300000000 > wm", "e - 1000 + 900000000 > wm")
    .replace("range((us // 5000000 + 1) * 5000000, (us // 5000000) * 5000000 + 605000000, 5000000)",
             "range((us // 600000000 + 1) * 600000000, (us // 600000000) * 600000000 + 1800000000, 600000000)")
)

_CAPPED = """
numbered AS (
  SELECT event_id, user_id, event_type, us,
         row_number() OVER (PARTITION BY user_id, event_type, (us + 28800000000) // 86400000000
                            ORDER BY us, event_id) AS n
  FROM behavior
)"""

_STREAK = """
marked AS (
  SELECT user_id, us, event_id, event_type = 'error' AS fail,
         sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
           OVER (PARTITION BY user_id ORDER BY us, event_id) AS streak
  FROM behavior
),
fails AS (
  SELECT user_id, streak, us, row_number() OVER (PARTITION BY user_id, streak ORDER BY us, event_id) AS n,
         first_value(us) OVER (PARTITION BY user_id, streak ORDER BY us, event_id) AS first_us
  FROM marked WHERE fail
)"""

_SIGNUPS = """
signups AS (
  SELECT s.user_id, s.event_id AS create_id,
         (SELECT arg_min(p.event_id, (p.us, p.event_id)) FROM behavior p
          WHERE p.user_id = s.user_id AND p.event_type = 'purchase'
            AND (p.us, p.event_id) > (s.us, s.event_id) AND p.us - s.us < 43200000000) AS pay_id
  FROM behavior s WHERE s.event_type = 'signup'
)"""

_PAIRS = """
pairs AS (
  SELECT c.event_id AS click_id, p.event_id AS purchase_id
  FROM behavior c JOIN behavior p ON c.user_id = p.user_id
  WHERE c.event_type = 'click' AND p.event_type = 'purchase'
    AND p.us - c.us BETWEEN -10800000000 AND 18000000000
)"""


# state machines, event by event

_HELD = """
orders AS (
  SELECT user_id, us, event_type = 'signup' AS made,
         row_number() OVER (PARTITION BY user_id ORDER BY us, event_type = 'purchase', event_id) AS n
  FROM behavior WHERE event_type IN ('signup', 'purchase')
),
fold AS (
  SELECT user_id, n, CASE WHEN made THEN us END AS held, CASE WHEN NOT made THEN 'payed but not created' END AS status,
         false AS expired
  FROM orders WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n, CASE WHEN o.made THEN o.us END,
         CASE WHEN o.made THEN CASE WHEN o.us - f.held > 43200000000 AND o.us - f.held <= 129600000000 THEN 'timeout' END
              WHEN f.held IS NULL OR o.us - f.held > 129600000000 THEN 'payed but not created'
              WHEN o.us - f.held <= 43200000000 THEN 'payed' ELSE 'payed but already timeout' END,
         coalesce(o.us - f.held > 129600000000, false)
  FROM fold f JOIN orders o ON o.user_id = f.user_id AND o.n = f.n + 1
)"""

_FIRST_COME = """
both_ AS (
  SELECT user_id, us, event_id, event_type AS kind, CASE event_type WHEN 'click' THEN 18000000000 ELSE 10800000000 END AS wait,
         row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS n
  FROM behavior WHERE event_type IN ('click', 'purchase')
),
fold AS (
  SELECT user_id, n, event_id AS held, kind AS side, us + wait AS due, false AS matched, CAST(NULL AS BIGINT) AS click_id,
         CAST(NULL AS BIGINT) AS purchase_id, CAST(NULL AS BIGINT) AS lone_click, CAST(NULL AS BIGINT) AS lone_purchase
  FROM both_ WHERE n = 1
  UNION ALL
  SELECT user_id, n, CASE WHEN NOT meets THEN event_id END, CASE WHEN NOT meets THEN kind END,
         CASE WHEN NOT meets THEN us + wait END, meets,
         CASE WHEN meets THEN CASE kind WHEN 'click' THEN event_id ELSE held END END,
         CASE WHEN meets THEN CASE kind WHEN 'click' THEN held ELSE event_id END END,
         CASE WHEN us > due AND side = 'click' THEN held END,
         CASE WHEN us > due AND side <> 'click' THEN held END
  FROM (SELECT x.*, f.held, f.side, f.due, coalesce(x.us <= f.due AND f.side <> x.kind, false) AS meets
        FROM fold f JOIN both_ x ON x.user_id = f.user_id AND x.n = f.n + 1)
)"""

_BURSTS = """
ordered AS (
  SELECT user_id, us, event_type = 'error' AS fail, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS n
  FROM behavior
),
fold AS (
  SELECT user_id, n, CASE WHEN fail THEN us END AS open_us, CASE WHEN fail THEN us END AS open_last,
         CASE WHEN fail THEN 1 END AS open_size, CAST(NULL AS BIGINT) AS first_us, CAST(NULL AS BIGINT) AS last_us, 0 AS size
  FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.user_id, o.n,
         CASE WHEN NOT o.fail THEN NULL WHEN f.open_us IS NULL OR o.us > f.open_us + 43200000000 THEN o.us ELSE f.open_us END,
         CASE WHEN o.fail THEN o.us END,
         CASE WHEN NOT o.fail THEN NULL WHEN f.open_us IS NULL OR o.us > f.open_us + 43200000000 THEN 1 ELSE f.open_size + 1 END,
         CASE WHEN o.us > f.open_us + 43200000000 THEN f.open_us END,
         CASE WHEN o.us > f.open_us + 43200000000 THEN f.open_last END,
         CASE WHEN o.us > f.open_us + 43200000000 THEN f.open_size ELSE 0 END
  FROM fold f JOIN ordered o ON o.user_id = f.user_id AND o.n = f.n + 1
)"""


def _with(*parts: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"


_RENAME = 'SELECT * EXCLUDE (cnt), cnt AS "count" FROM ({})'
_HOURLY = "(us // 3600000000 + 1) * 3600000"
_CHANNEL_COUNTS = _sliding(
    "(SELECT k % 3 AS channel, event_type AS behavior, us FROM behavior WHERE event_type <> 'unstall')",
    "channel, behavior", 3_600_000, 5_000,
)
_PAGE_COUNTS = _sliding("(SELECT k, us FROM behavior WHERE event_type = 'view')", "k", 600_000, 5_000)
_UNIQUE = f"""SELECT {_HOURLY} AS window_end, count(DISTINCT user_id) AS "count"
              FROM behavior WHERE event_type = 'view' GROUP BY 1"""
_VIEWS = f"""SELECT {_HOURLY} AS window_end, count(*) AS "count" FROM behavior WHERE event_type = 'view' GROUP BY 1"""

ORACLES: dict[str, str] = {
    "hot_items": _with(_BEHAVIOR, body=_RENAME.format(_HOT_ITEMS)),
    "hot_items_sql": _with(_BEHAVIOR, body=_HOT_ITEMS),
    "hot_items_report": _with(_BEHAVIOR, body=f"""
        SELECT window_end,
               '======================' || chr(10) || '窗口结束时间：'
               || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S.0') || chr(10)
               || string_agg('NO' || row_num || ':商品ID= ' || item_id || '点击量= ' || cnt, chr(10) ORDER BY row_num)
               || chr(10) AS report
        FROM ({_HOT_ITEMS}) GROUP BY window_end"""),
    "hot_pages": _with(_BEHAVIOR, body=_RENAME.format(_top(_PAGE_COUNTS, "k", 3, "url"))),
    "hot_pages_daily": _with(_BEHAVIOR, body=_RENAME.format(_top(
        _sliding("(SELECT k, us FROM behavior WHERE event_type = 'view')", "k", 86_400_000, 3_600_000), "k", 3, "url"))),
    "hot_pages_late": _with(
        _BEHAVIOR,
        _LATE.format(source="(SELECT * FROM behavior WHERE event_type = 'view')"),
        body=_RENAME.format(_top("""
        SELECT k, window_end, count(*) AS cnt
        FROM (
          SELECT k, wm, unnest(range((us // 5000000 + 1) * 5000, (us // 5000000 + 1) * 5000 + 600000, 5000)) AS window_end
          FROM tagged
        ) WHERE wm IS NULL OR window_end * 1000 - 1000 + 300000000 > wm
        GROUP BY k, window_end""", "k", 3, "url"))),
    "hot_pages_relisted": _with(
        _BEHAVIOR,
        _RELATE.format(source="(SELECT * FROM behavior WHERE event_type = 'view')"),
        body=_RENAME.format(_top("""
        SELECT k, window_end, count(*) AS cnt
        FROM (
          SELECT k, wm, unnest(range((us // 600000000 + 1) * 600000, (us // 600000000 + 1) * 600000 + 1200000, 600000)) AS window_end
          FROM tagged
        ) WHERE wm IS NULL OR window_end * 1000 - 1000 + 900000000 > wm
        GROUP BY k, window_end""", "k", 3, "url"))),
    "views_uneven": _with(_BEHAVIOR, body="""
        SELECT s * 240000 + 600000 AS window_end, count(*) AS "count"
        FROM (SELECT unnest(range((us - 600000000) // 240000000 + 1, us // 240000000 + 1)) AS s
              FROM behavior WHERE event_type = 'view') GROUP BY s"""),
    "unique_visitors_sliding_sketch": _with(_BEHAVIOR, body="""
        SELECT window_end, count(DISTINCT user_id) AS "count", true AS within_bound
        FROM (SELECT user_id, unnest(range((us // 3600000000 + 1) * 3600000, (us // 3600000000 + 25) * 3600000, 3600000)) AS window_end
              FROM behavior WHERE event_type = 'view') GROUP BY window_end"""),
    "late_split": _with(
        _BEHAVIOR, _LATE.format(source="behavior"), body="SELECT event_id, tag, wm AS watermark_us FROM tagged"),
    "page_views": _with(_BEHAVIOR, body=_VIEWS),
    "page_views_salted": _with(_BEHAVIOR, body=_VIEWS),
    "unique_visitors": _with(_BEHAVIOR, body=_UNIQUE),
    "unique_visitors_bitmap": _with(_BEHAVIOR, body=f"""
        SELECT window_end, count(DISTINCT bit) AS "count"
        FROM (
          SELECT window_end, event_id,
                 CAST(sum(ascii(substr(u, i, 1)) * CAST(pow(61, length(u) - i) AS BIGINT)) AS BIGINT) & 1073741823 AS bit
          FROM (SELECT {_HOURLY} AS window_end, event_id, CAST(user_id AS VARCHAR) AS u,
                       unnest(range(1, length(CAST(user_id AS VARCHAR)) + 1)) AS i
                FROM behavior WHERE event_type = 'view')
          GROUP BY window_end, event_id
        ) GROUP BY window_end"""),
    # hourly windows hold few users here, for which the sketch is exact
    "unique_visitors_sketch": _with(_BEHAVIOR, body=_UNIQUE),
    "channel_counts": _with(_BEHAVIOR, body=_runs(_CHANNEL_COUNTS, "channel, behavior", 5_000)),
    "channel_counts_daily": _with(_BEHAVIOR, body=f"""
        SELECT channel, behavior, window_end // 86400000 AS day, count(*) AS windows,
               CAST(sum(cnt) AS BIGINT) AS total, max(cnt) AS peak
        FROM ({_CHANNEL_COUNTS}) GROUP BY ALL"""),
    "click_cap": _with(_BEHAVIOR, _CAPPED, body="SELECT event_id, user_id, event_type FROM numbered WHERE n <= 2"),
    "click_blacklist": _with(_BEHAVIOR, _CAPPED, body="""
        SELECT user_id, event_type, 'click over 2 times today' AS msg FROM numbered WHERE n = 3"""),
    "capped_by_province": _with(
        _BEHAVIOR, _CAPPED,
        """located AS (
          SELECT n_name AS province, us FROM numbered
          JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n <= 2
        )""",
        body=_runs(_sliding("located", "province", 3_600_000, 5_000), "province", 5_000)),
    "fail_anchor": _with(_BEHAVIOR, _STREAK, body="""
        SELECT user_id, first_us, us AS last_us, 'login fail in 2s for ' || (n - 1) || ' times.' AS msg
        FROM fails WHERE n > 1 AND us - first_us < 43200000000"""),
    "fail_last_matched": _with(
        _BEHAVIOR, _STREAK,
        """fold AS (
          SELECT user_id, streak, n, us AS saved, CAST(NULL AS BIGINT) AS first_us, CAST(NULL AS BIGINT) AS last_us
          FROM fails WHERE n = 1
          UNION ALL
          SELECT f.user_id, f.streak, f.n,
                 CASE WHEN f.us - p.saved <= 43200000000 THEN f.us ELSE p.saved END,
                 CASE WHEN f.us - p.saved <= 43200000000 THEN p.saved END,
                 CASE WHEN f.us - p.saved <= 43200000000 THEN f.us END
          FROM fold p JOIN fails f ON f.user_id = p.user_id AND f.streak = p.streak AND f.n = p.n + 1
        )""",
        recursive=True,
        body="SELECT user_id, first_us, last_us, 'login fail' AS msg FROM fold WHERE last_us IS NOT NULL"),
    "fail_pairs_strict": _with(_BEHAVIOR, body="""
        SELECT user_id, event_id AS first_id, next_id AS second_id
        FROM (SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type, lead(us) OVER w AS next_us
              FROM behavior WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
        WHERE event_type = 'error' AND next_type = 'error' AND next_us - us < 7200000000"""),
    "fail_times2_global": _with(_BEHAVIOR, body="""
        SELECT event_id AS first_id, next_id AS second_id
        FROM (SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type, lead(us) OVER w AS next_us
              FROM behavior WINDOW w AS (ORDER BY us, event_id))
        WHERE event_type = 'error' AND next_type = 'error' AND next_us - us < 600000000"""),
    "signup_purchase": _with(_BEHAVIOR, _SIGNUPS, body="""
        SELECT user_id, create_id, pay_id FROM signups WHERE pay_id IS NOT NULL"""),
    "signup_timeout": _with(_BEHAVIOR, _SIGNUPS, body="""
        SELECT user_id, create_id, 'timeout' AS status FROM signups WHERE pay_id IS NULL"""),
    "funnel_three_steps": _with(
        _BEHAVIOR,
        """clicked AS (
          SELECT v.user_id, v.event_id AS view_id, v.us,
                 (SELECT min((c.us, c.event_id)) FROM behavior c
                  WHERE c.user_id = v.user_id AND c.event_type = 'click' AND (c.us, c.event_id) > (v.us, v.event_id)
                    AND c.us - v.us < 86400000000) AS click
          FROM behavior v WHERE v.event_type = 'view'
        )""",
        """bought AS (
          SELECT q.*, (SELECT min((p.us, p.event_id)) FROM behavior p
                       WHERE p.user_id = q.user_id AND p.event_type = 'purchase' AND (p.us, p.event_id) > q.click
                         AND p.us - q.us < 86400000000) AS purchase
          FROM clicked q
        )""",
        body="""
        SELECT user_id, view_id, click[2] AS click_id, purchase[2] AS purchase_id,
               CASE WHEN purchase IS NULL THEN 'timeout' ELSE 'match' END AS status
        FROM bought"""),
    "order_status": _with(
        _BEHAVIOR,
        """orders AS (
          SELECT user_id, us, CASE event_type WHEN 'signup' THEN 0 ELSE 1 END AS k, event_id
          FROM behavior WHERE event_type IN ('signup', 'purchase')
        )""",
        """placed AS (
          SELECT o.*,
                 (SELECT arg_min({'k': n.k, 'us': n.us}, (n.us, n.k, n.event_id)) FROM orders n
                  WHERE n.user_id = o.user_id AND (n.us, n.k, n.event_id) > (o.us, o.k, o.event_id)) AS after,
                 (SELECT arg_max(p.k, (p.us, p.k, p.event_id)) FROM orders p
                  WHERE p.user_id = o.user_id AND (p.us, p.k, p.event_id) < (o.us, o.k, o.event_id)) AS before
          FROM orders o
        )""",
        body="""
        SELECT user_id, 'payed' AS status FROM placed WHERE k = 0 AND after.k = 1 AND after.us - us <= 43200000000
        UNION ALL SELECT user_id, 'payed but already timeout' FROM placed
          WHERE k = 0 AND after.k = 1 AND after.us - us > 43200000000
        UNION ALL SELECT user_id, 'timeout' FROM placed
          WHERE k = 0 AND (after IS NULL OR after.k = 0 AND after.us - us > 43200000000)
        UNION ALL SELECT user_id, 'payed but not created' FROM placed WHERE k = 1 AND coalesce(before, 1) = 1"""),
    "order_status_held": _with(_BEHAVIOR, _HELD, recursive=True, body="""
        SELECT user_id, status FROM fold WHERE status IS NOT NULL
        UNION ALL SELECT user_id, 'timeout' FROM fold WHERE expired
        UNION ALL SELECT user_id, 'timeout' FROM fold f WHERE held IS NOT NULL
          AND n = (SELECT max(n) FROM orders o WHERE o.user_id = f.user_id)"""),
    "two_stream_match": _with(_BEHAVIOR, _FIRST_COME, recursive=True, body="""
        SELECT click_id, purchase_id, 'matched' AS tag FROM fold WHERE matched
        UNION ALL SELECT lone_click, NULL, 'unmatched-pays' FROM fold WHERE lone_click IS NOT NULL
        UNION ALL SELECT NULL, lone_purchase, 'unmatched-receipts' FROM fold WHERE lone_purchase IS NOT NULL
        UNION ALL SELECT CASE WHEN side = 'click' THEN held END, CASE WHEN side <> 'click' THEN held END,
                 CASE WHEN side = 'click' THEN 'unmatched-pays' ELSE 'unmatched-receipts' END
          FROM fold f WHERE held IS NOT NULL AND n = (SELECT max(n) FROM both_ o WHERE o.user_id = f.user_id)"""),
    "fail_bursts": _with(_BEHAVIOR, _BURSTS, recursive=True, body="""
        SELECT user_id, first_us, last_us, 'login fail in 2s for ' || size || ' times.' AS msg FROM fold WHERE size >= 2
        UNION ALL SELECT user_id, open_us, open_last, 'login fail in 2s for ' || open_size || ' times.' FROM fold f
          WHERE open_size >= 2 AND n = (SELECT max(n) FROM ordered o WHERE o.user_id = f.user_id)"""),
    "interval_join": _with(_BEHAVIOR, _PAIRS, body="SELECT * FROM pairs"),
    "reconcile": _with(_BEHAVIOR, _PAIRS, body="""
        SELECT click_id, purchase_id, 'matched' AS tag FROM pairs
        UNION ALL SELECT event_id, NULL, 'click_only' FROM behavior
          WHERE event_type = 'click' AND event_id NOT IN (SELECT click_id FROM pairs)
        UNION ALL SELECT NULL, event_id, 'purchase_only' FROM behavior
          WHERE event_type = 'purchase' AND event_id NOT IN (SELECT purchase_id FROM pairs)"""),
    "log_behavior": _with(_BEHAVIOR, body="""
        SELECT CASE event_type WHEN 'view' THEN 'pv' ELSE event_type END AS behavior, CAST(k % 10 AS INTEGER) AS category_id,
               count(*) AS n, CAST(sum(k) AS BIGINT) AS items, count(DISTINCT user_id) AS users, max(us // 1000000) AS last_ts
        FROM behavior GROUP BY ALL"""),
    "log_ad_clicks": _with(_BEHAVIOR, body="""
        SELECT 'province ' || user_id % 5 AS province, 'a city, quoted' AS city, k % 7 AS ad_id, count(*) AS n,
               max(us // 1000000) AS last_ts
        FROM behavior WHERE event_type = 'click' GROUP BY ALL"""),
    "log_logins": _with(_BEHAVIOR, body="""
        SELECT user_id, '10.0.0.' || user_id % 256 AS ip, count(*) FILTER (event_type = 'error') AS fails, count(*) AS n,
               min(us // 1000000) AS first_ts
        FROM behavior GROUP BY ALL"""),
    "log_payments": _with(
        _BEHAVIOR,
        """pays AS (SELECT 'tx' || event_id AS tx_id, us // 1000000 AS s FROM behavior WHERE event_type = 'purchase')""",
        """receipts AS (
          SELECT 'tx' || event_id AS tx_id, CASE event_id % 2 WHEN 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel,
                 us // 1000000 + event_id % 13 - 5 AS s
          FROM behavior WHERE event_type = 'purchase' AND event_id % 3 > 0 OR event_type = 'click' AND event_id % 10 = 0)""",
        """met AS (SELECT p.tx_id, pay_channel FROM pays p JOIN receipts r ON p.tx_id = r.tx_id AND r.s - p.s BETWEEN -3 AND 5)""",
        body="""
        SELECT tx_id, pay_channel, 'matched' AS tag FROM met
        UNION ALL SELECT tx_id, NULL, 'unmatched-pays' FROM pays WHERE tx_id NOT IN (SELECT tx_id FROM met)
        UNION ALL SELECT tx_id, pay_channel, 'unmatched-receipts' FROM receipts WHERE tx_id NOT IN (SELECT tx_id FROM met)"""),
    "channel_windows": _with(_BEHAVIOR, body=f"""
        SELECT strftime(make_timestamp((window_end - 3600000) * 1000), '%Y-%m-%d %H:%M:%S.0') AS window_start,
               strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S.0') AS window_end,
               CASE channel WHEN 0 THEN 'app-store' WHEN 1 THEN 'huawei-store' ELSE 'wechat' END AS channel, behavior, cnt AS "count"
        FROM ({_sliding("(SELECT k % 3 AS channel, event_type AS behavior, us FROM behavior WHERE event_type <> 'error')",
                        "channel, behavior", 3_600_000, 1_800_000)})"""),
    "kafka_decode": _with(_BEHAVIOR, body="""
        SELECT event_type AS behavior, CAST(k % 10 AS INTEGER) AS category_id, count(*) AS n,
               CAST(sum(k) AS BIGINT) AS items, max(us // 1000000) AS last_ts
        FROM behavior GROUP BY ALL"""),
    "access_log": _with(_BEHAVIOR, body="""
        SELECT '/page/' || k AS url, count(*) AS n, count(DISTINCT user_id % 256) AS ips, max(us // 1000000) AS last_ts
        FROM behavior WHERE event_type = 'view' GROUP BY k"""),
}

#: Streams come to an end, which closes all windows.
ORACLES |= {
    "stream_page_views": ORACLES["page_views"],
    "stream_unique_visitors": ORACLES["unique_visitors"],
    "stream_unique_visitors_bitmap": ORACLES["unique_visitors_bitmap"],
    "stream_views_uneven": ORACLES["views_uneven"],
    "stream_hot_pages_late": ORACLES["hot_pages_relisted"],
    "stream_hot_items": ORACLES["hot_items"],
    "stream_hot_pages": ORACLES["hot_pages"],
    "stream_channel_counts_daily": ORACLES["channel_counts_daily"],
    "stream_hot_items_retract": ORACLES["hot_items"],
    "stream_page_views_upsert": ORACLES["page_views"],
    "stream_interval_join": ORACLES["interval_join"],
    "stream_fail_anchor": ORACLES["fail_anchor"],
    "stream_fail_last_matched": ORACLES["fail_last_matched"],
    "stream_fail_bursts": ORACLES["fail_bursts"],
    "stream_capped_by_province": _with(
        _BEHAVIOR, _CAPPED,
        """located AS (
          SELECT n_name AS province, us FROM numbered
          JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n <= 2
        )""",
        body=f"""
        SELECT province, window_end // 86400000 AS day, count(*) AS windows, CAST(sum(cnt) AS BIGINT) AS total, max(cnt) AS peak
        FROM ({_sliding("located", "province", 3_600_000, 5_000)}) GROUP BY ALL"""),
    "stream_tagged_clicks": _with(_BEHAVIOR, _CAPPED, body="""
        SELECT CASE WHEN n <= 2 THEN 'pass' ELSE 'blacklist' END AS tag, user_id, count(*) AS n
        FROM numbered WHERE n <= 3 GROUP BY ALL"""),
    "stream_order_status": ORACLES["order_status_held"],
    "stream_two_stream_match": ORACLES["two_stream_match"],
    "stream_late_split": ORACLES["late_split"],
    "stream_late_rows": _with(
        _BEHAVIOR,
        """arrived AS (
          SELECT event_id, user_id, us, max(us) OVER (ORDER BY us + event_id * 7919 % 3600 * 1000000, event_id
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
          FROM behavior WHERE event_type = 'view'
        )""",
        body="SELECT event_id, user_id FROM arrived WHERE us <= (seen // 1000 - 1200000) * 1000"),
    "stream_click_cap": _with(_BEHAVIOR, _CAPPED, body="""
        SELECT user_id, event_type, event_id, CASE WHEN n <= 2 THEN 'pass' ELSE 'blacklist' END AS tag
        FROM numbered WHERE n <= 3"""),
}
