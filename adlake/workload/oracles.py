"""The same results in SQL over the test tables, written independently of the queries.

Statements are put together from named common table expressions; each result must match its
query in column names, rows and values.
"""

from __future__ import annotations

CLICK, CONVERSION = 604800, 2592000
CUT = "DATE '2024-01-15'"

_EV = """
ev AS (
  SELECT event_id, user_id, value, event_type AS source_type,
         CAST(props->>'$.k' AS INTEGER) AS k,
         CAST(floor(epoch(ts)) AS BIGINT) AS t
  FROM events WHERE event_type IN ('view', 'click', 'purchase')
)"""

_RAW = (
    _EV
    + """,
raw AS (
  SELECT concat_ws('_', user_id, k) AS eid,
         CAST(user_id AS VARCHAR) AS uid,
         t AS "timestamp",
         strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS event_time,
         CASE source_type WHEN 'view' THEN 'impression' WHEN 'click' THEN 'click'
              ELSE 'conversion' END AS event_type,
         k % 10 AS campaign,
         CASE WHEN source_type = 'view' THEN value END AS cost,
         CAST(user_id % 3 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset,
         make_timestamp((t + event_id % 7) * 1000000) AS kafka_timestamp,
         make_timestamp((t + event_id % 7 + (event_id * 37) % 601) * 1000000) AS ingest_ts,
         CAST(make_timestamp((t + event_id % 7 + (event_id * 37) % 601) * 1000000) AS DATE)
           AS raw_date,
         CAST(hour(make_timestamp((t + event_id % 7 + (event_id * 37) % 601) * 1000000))
           AS INTEGER) AS raw_hour
  FROM ev
)"""
)


def _dedup(name: str, event_type: str, where: str = "TRUE", by: str = "eid") -> str:
    return f"""
{name} AS (
  SELECT * FROM raw WHERE event_type = '{event_type}' AND {where}
  QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY ingest_ts, kafka_offset) = 1
)"""


def _silver(name: str, imp: str, click: str, conv_ts: str, joins: str = "") -> str:
    """Row-level rows of deduplicated impressions ``i``."""
    return f"""
{name} AS (
  SELECT i.eid AS event_id,
         CAST(make_timestamp(i."timestamp" * 1000000) AS DATE) AS event_date,
         CAST(hour(make_timestamp(i."timestamp" * 1000000)) AS INTEGER) AS event_hour,
         make_timestamp(i."timestamp" * 1000000) AS event_time,
         i.uid, i.campaign,
         CAST({click} AS INTEGER) AS click,
         CAST(CASE WHEN {conv_ts} IS NULL THEN 0 ELSE 1 END AS INTEGER) AS conversion,
         coalesce({conv_ts}, -1) AS conversion_timestamp,
         coalesce({conv_ts} - i."timestamp", -1) AS conversion_delay_sec,
         round(coalesce(i.cost, 0.0), 6) AS cost,
         CAST(epoch(i.kafka_timestamp) AS BIGINT) - i."timestamp" AS producer_to_broker_sec,
         CAST(epoch(i.ingest_ts) - epoch(i.kafka_timestamp) AS BIGINT) AS broker_to_ingest_sec,
         CAST(epoch(i.ingest_ts) AS BIGINT) - i."timestamp" AS end_to_end_latency_sec
  FROM {imp} i {joins}
)"""


def _attributed(name: str, where: str = "TRUE", clicks: str = "", conversions: str = "") -> str:
    """Deduplicate each type, then join within the windows."""
    return ",".join(
        [
            _dedup(f"{name}_imp", "impression", where),
            _dedup(f"{name}_clk", "click", clicks or where),
            _dedup(f"{name}_cvt", "conversion", conversions or where),
            _silver(
                name,
                f"{name}_imp",
                "CASE WHEN c.eid IS NULL THEN 0 ELSE 1 END",
                'v."timestamp"',
                f"""
  LEFT JOIN {name}_clk c ON c.eid = i.eid
    AND c."timestamp" - i."timestamp" BETWEEN 0 AND {CLICK}
  LEFT JOIN {name}_cvt v ON v.eid = i.eid
    AND v."timestamp" - i."timestamp" BETWEEN 0 AND {CONVERSION}""",
            ),
        ]
    )


def _gold(name: str, source: str, where: str = "TRUE", places: int = 6) -> str:
    """KPIs rounded to ``places``: reports that round for themselves ask for all digits."""
    text = f"""
{name} AS (
  SELECT event_date AS summary_date, campaign,
         count(*) AS impressions,
         CAST(sum(click) AS BIGINT) AS clicks,
         CAST(sum(conversion) AS BIGINT) AS conversions,
         count(DISTINCT uid) AS unique_users,
         count(DISTINCT CASE WHEN conversion = 1 THEN uid END) AS converting_users,
         SUMMED AS total_cost,
         round(sum(click)::DOUBLE / count(*) * 100, 6) AS ctr,
         round(sum(conversion)::DOUBLE / nullif(sum(click), 0) * 100, 6) AS cvr,
         round(SUMMED / nullif(sum(click), 0), 6) AS cpc,
         round(SUMMED / nullif(sum(conversion), 0), 6) AS cpa,
         round(SUMMED / count(*) * 1000, 6) AS cpm,
         count(*) FILTER (click = 1 AND conversion = 1) AS click_through_conversions,
         count(*) FILTER (click = 0 AND conversion = 1) AS view_through_conversions,
         round(avg(conversion_delay_sec) FILTER (conversion_delay_sec >= 0), 6)
           AS avg_conversion_delay_sec,
         round(count(*)::DOUBLE / count(DISTINCT uid), 6) AS frequency
  FROM {source} WHERE campaign IS NOT NULL AND {where} GROUP BY ALL
)"""
    return text.replace(", 6)", f", {places})").replace("SUMMED", "round(sum(cost), 6)")


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_FULL = _with(_RAW, _attributed("s"))
_FULL_GOLD = _with(_RAW, _attributed("s"), _gold("g", "s"))
_EARLY = f"raw_date <= {CUT}"
_BOTH = _with(_RAW, _attributed("s"), _attributed("b", _EARLY))

# Incremental runs: each batch attributes its own clicks and conversions to the impressions
# stored so far, and the first batch with a conversion in the window wins. Batches are runs of raw
# dates of about equal length.
_SPAN = """(SELECT date_diff('day', min(raw_date), max(raw_date)) + 1 FROM unbatched)"""
_FIRST = "(SELECT min(raw_date) FROM unbatched)"
_WEEKS = f"(date_diff('day', {_FIRST}, raw_date) * 4) // {_SPAN} + 1"
_DAYS = """least(5, greatest(1, 4 - date_diff('day', raw_date, (
  SELECT max(CAST(make_timestamp("timestamp" * 1000000) AS DATE))
  FROM unbatched WHERE event_type = 'impression'))))"""


def _incremental(batch: str) -> str:
    return ",".join(
        [
            _RAW.replace("raw AS (", "unbatched AS ("),
            f"\nraw AS (SELECT *, {batch} AS batch FROM unbatched)",
            _dedup("imp", "impression", "batch IS NOT NULL"),
            _dedup("clk", "click", "batch IS NOT NULL", "batch, eid"),
            _dedup("cvt", "conversion", "batch IS NOT NULL", "batch, eid"),
            f"""
hit AS (
  SELECT i.eid, arg_min(v."timestamp", v.batch) AS conv_ts
  FROM imp i JOIN cvt v ON v.eid = i.eid AND v.batch >= i.batch
    AND v."timestamp" - i."timestamp" BETWEEN 0 AND {CONVERSION}
  GROUP BY i.eid
),
clicked AS (
  SELECT DISTINCT i.eid
  FROM imp i JOIN clk c ON c.eid = i.eid AND c.batch >= i.batch
    AND c."timestamp" - i."timestamp" BETWEEN 0 AND {CLICK}
)""",
            _silver(
                "s",
                "imp",
                "CASE WHEN k.eid IS NULL THEN 0 ELSE 1 END",
                "h.conv_ts",
                "LEFT JOIN hit h ON h.eid = i.eid LEFT JOIN clicked k ON k.eid = i.eid",
            ),
        ]
    )


def _matched(event_type: str, window: int) -> str:
    return (
        _with(_RAW, _dedup("imp", "impression"), _dedup("e", event_type))
        + f"""
SELECT i.eid AS event_id, CAST(make_timestamp(i."timestamp" * 1000000) AS DATE) AS event_date,
       CAST(0 AS INTEGER) AS click, CAST(0 AS INTEGER) AS conversion,
       e."timestamp" AS match_ts, e."timestamp" - i."timestamp" AS match_delay_sec
FROM imp i JOIN e ON e.eid = i.eid AND e."timestamp" - i."timestamp" BETWEEN 0 AND {window}"""
    )


# One run of each layer per batch, at two in the morning after its last raw date.
_RUNS = (
    _RAW.replace("raw AS (", "unbatched AS (")
    + """,
spans AS (SELECT date_diff('day', min(raw_date), max(raw_date)) + 1 AS span FROM unbatched),
runs AS (
  SELECT layer, operation, CAST(n AS BIGINT) AS commit_id,
         CAST(nullif(n - 1, 0) AS BIGINT) AS parent_id,
         CAST(last AS TIMESTAMP) + INTERVAL 26 HOUR AS committed_at
  FROM (SELECT n, min(raw_date) + CAST((any_value(span) * n + 3) // 4 - 1 AS INTEGER) AS last
        FROM unbatched, range(1, 5) r(n), spans GROUP BY n) b
  CROSS JOIN (VALUES ('silver', 'incremental'), ('gold', 'merge')) l(layer, operation)
)"""
)
# Rows each run added or changed.
_RECORDS = """
changed AS (
  SELECT i.eid, CAST(make_timestamp(i."timestamp" * 1000000) AS DATE) AS d, min(c.batch) AS batch
  FROM imp i JOIN clk c ON c.eid = i.eid AND c.batch >= i.batch
    AND c."timestamp" - i."timestamp" BETWEEN 0 AND 604800 GROUP BY ALL
  UNION
  SELECT i.eid, CAST(make_timestamp(i."timestamp" * 1000000) AS DATE), min(v.batch)
  FROM imp i JOIN cvt v ON v.eid = i.eid AND v.batch >= i.batch
    AND v."timestamp" - i."timestamp" BETWEEN 0 AND 2592000 GROUP BY ALL
),
placed AS (
  SELECT batch, CAST(make_timestamp("timestamp" * 1000000) AS DATE) AS d, campaign FROM imp
),
touched AS (SELECT batch, d FROM placed UNION SELECT batch, d FROM changed),
written AS (
  SELECT DISTINCT t.batch, t.d, p.campaign
  FROM touched t JOIN placed p ON p.d = t.d AND p.batch <= t.batch
)"""


def _stale(layer: str) -> str:
    return f"""{_with(_RUNS)}
SELECT '{layer}_snapshot_missing' AS alert FROM runs WHERE layer = '{layer}'
HAVING coalesce(CAST(max(committed_at) AS DATE) < DATE '2024-02-10', TRUE)"""


_WIDE = (
    _EV
    + """,
w AS (
  SELECT row_number() OVER (ORDER BY t, event_id) - 1 AS row_index,
         t - 1704067200 AS "timestamp", CAST(user_id AS VARCHAR) AS uid, k % 10 AS campaign,
         k % 3 = 0 AS clicks, k % 4 = 0 AS converts,
         CASE WHEN k % 4 = 0 THEN user_id ELSE -1 END AS conversion_id,
         CASE WHEN k % 4 = 0 THEN t - 1704067200 + k * 3600 ELSE -1 END AS conversion_timestamp,
         CASE WHEN k % 5 <> 0 THEN value END AS cost
  FROM ev
),
origin AS (SELECT "timestamp" AS base FROM w WHERE row_index = 0),
firsts AS (
  SELECT * FROM w WHERE converts
  QUALIFY row_number() OVER (PARTITION BY conversion_id ORDER BY row_index) = 1
)"""
)


def _remap(unix: str) -> str:
    return f"CAST(floor(1704067200.0::DOUBLE + ({unix} - base) / 100.0::DOUBLE) AS BIGINT)"


_RAW_COLUMNS = """eid, uid, "timestamp", event_time, event_type, campaign, cost, kafka_partition,
  kafka_offset, kafka_timestamp"""
_ARRIVAL = "ingest_ts, raw_date, raw_hour"

_COUNTS = """CAST(sum(click) AS BIGINT) AS clicks, CAST(sum(conversion) AS BIGINT) AS conversions"""


def _trailing(column: str, days: int, as_of: str = "DATE '2024-01-31'") -> str:
    return f"{column} >= {as_of} - INTERVAL {days} DAY AND {column} < {as_of}"


_KPI_COLUMNS = """summary_date, campaign, impressions, clicks, conversions, unique_users,
  converting_users, round(total_cost, 6) AS total_cost"""

ORACLES: dict[str, str] = {
    "bronze_parse": f"""{_with(_RAW)}
SELECT {_RAW_COLUMNS}, {_ARRIVAL} FROM raw WHERE kafka_offset % 97 <> 0""",
    "bronze_quarantine": f"""{_with(_RAW)}
SELECT kafka_partition, kafka_offset, kafka_timestamp, {_ARRIVAL}
FROM raw WHERE kafka_offset % 97 = 0""",
    "bronze_stream": f"{_with(_RAW)} SELECT {_RAW_COLUMNS} FROM raw",
    "raw_range_scan": f"""{_with(_RAW)}
SELECT {_RAW_COLUMNS}, {_ARRIVAL} FROM raw
WHERE raw_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "dedup_events": f"""{_with(_RAW)}
SELECT event_type, eid, "timestamp", kafka_offset, ingest_ts FROM raw
QUALIFY row_number() OVER (PARTITION BY event_type, eid ORDER BY ingest_ts, kafka_offset) = 1""",
    "attribution_full": f"""{
        _with(
            _RAW, _dedup("imp", "impression"), _dedup("clk", "click"), _dedup("cvt", "conversion")
        )
    }
SELECT i.eid, i.uid, i."timestamp", c."timestamp" AS click_ts, v."timestamp" AS conv_ts
FROM imp i
LEFT JOIN clk c ON c.eid = i.eid AND c."timestamp" - i."timestamp" BETWEEN 0 AND {CLICK}
LEFT JOIN cvt v ON v.eid = i.eid AND v."timestamp" - i."timestamp" BETWEEN 0 AND {CONVERSION}""",
    "attribution_clicks": _matched("click", CLICK),
    "attribution_conversions": _matched("conversion", CONVERSION),
    "attribution_bucketed": f"""SELECT *, 'click' AS event_type FROM ({_matched("click", CLICK)})
UNION ALL SELECT *, 'conversion' FROM ({_matched("conversion", CONVERSION)})""",
    "attribution_orders": f"""WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(epoch(o_orderdate) AS BIGINT) AS t FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate) = 1
), l AS (
  SELECT l_orderkey, CAST(epoch(l_shipdate) AS BIGINT) AS t FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) = 1
)
SELECT CAST(o_orderkey AS VARCHAR) AS eid, CAST(o_custkey AS VARCHAR) AS uid, o.t AS "timestamp",
       CASE WHEN l.t - o.t <= {CLICK} THEN l.t END AS click_ts, l.t AS conv_ts
FROM o JOIN l ON l_orderkey = o_orderkey AND l.t - o.t BETWEEN 0 AND {CONVERSION}""",
    "silver_stage1": f"""{
        _with(_RAW, _dedup("imp", "impression"), _silver("s", "imp", "0", "CAST(NULL AS BIGINT)"))
    }
SELECT * FROM s""",
    "silver_conform": f"{_FULL} SELECT * FROM s",
    "silver_incremental": f"{_with(_incremental(_WEEKS))} SELECT * FROM s",
    "silver_full_refresh": f"{_FULL} SELECT * FROM s",
    "silver_refresh_range": _with(
        _RAW,
        _attributed(
            "s",
            "raw_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
            "raw_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-27'",
            "raw_date BETWEEN DATE '2024-01-05' AND DATE '2024-02-19'",
        ),
    )
    + " SELECT * FROM s",
    "assert_matched": f"""{_with(_RAW)}
SELECT event_type, count(*) AS source_events, CAST(0 AS BIGINT) AS matched_events
FROM raw WHERE event_type <> 'impression' GROUP BY event_type""",
    "upsert_insert_absent": f"""{
        _with(
            _RAW,
            _dedup("old", "impression", _EARLY),
            _dedup("new", "impression"),
            "both_ AS (SELECT * FROM old UNION ALL SELECT * FROM new "
            "WHERE eid NOT IN (SELECT eid FROM old))",
            _silver("s", "both_", "0", "CAST(NULL AS BIGINT)"),
        )
    }
SELECT * FROM s""",
    "upsert_click": f"""{
        _with(
            _RAW,
            _dedup("imp", "impression"),
            _dedup("clk", "click"),
            _silver(
                "s",
                "imp",
                "CASE WHEN c.eid IS NULL THEN 0 ELSE 1 END",
                "CAST(NULL AS BIGINT)",
                "LEFT JOIN clk c ON c.eid = i.eid "
                f'AND c."timestamp" - i."timestamp" BETWEEN 0 AND {CLICK}',
            ),
        )
    }
SELECT * FROM s""",
    "upsert_conversion": f"""{
        _with(_RAW, _attributed("b", _EARLY), _dedup("cvt", "conversion"))
    },
m AS (
  SELECT b.event_id, v."timestamp" AS ts,
         v."timestamp" - CAST(epoch(b.event_time) AS BIGINT) AS delay
  FROM b JOIN cvt v ON v.eid = b.event_id
    AND v."timestamp" - CAST(epoch(b.event_time) AS BIGINT) BETWEEN 0 AND {CONVERSION}
)
SELECT b.* REPLACE (
  CAST(CASE WHEN m.ts IS NOT NULL THEN 1 ELSE b.conversion END AS INTEGER) AS conversion,
  CASE WHEN b.conversion = 0 AND m.ts IS NOT NULL THEN m.ts
       ELSE b.conversion_timestamp END AS conversion_timestamp,
  CASE WHEN b.conversion = 0 AND m.ts IS NOT NULL THEN m.delay
       ELSE b.conversion_delay_sec END AS conversion_delay_sec)
FROM b LEFT JOIN m ON m.event_id = b.event_id""",
    "upsert_gold": f"""{
        _with(
            _RAW,
            _attributed("s"),
            _attributed("b", _EARLY),
            _gold("new", "s", "event_date >= DATE '2024-01-10'"),
            _gold("old", "b"),
        )
    }
SELECT * FROM new
UNION ALL
SELECT o.* FROM old o WHERE NOT EXISTS (
  SELECT 1 FROM new n WHERE n.summary_date = o.summary_date AND n.campaign = o.campaign)""",
    "update_where": f"""{_FULL}
SELECT * REPLACE (round(CASE WHEN campaign = 3 THEN cost * 1.1::DOUBLE ELSE cost END, 6) AS cost)
FROM s""",
    "delete_where": f"{_FULL} SELECT * FROM s WHERE campaign <> 3 AND event_date <> {CUT}",
    "gold_kpi": f"{_FULL_GOLD} SELECT * FROM g",
    "gold_changed_only": f"""{_BOTH},
changed AS (
  SELECT event_date FROM (
    SELECT event_date, count(*) AS n, sum(click) AS c, sum(conversion) AS v FROM s GROUP BY ALL
    EXCEPT
    SELECT event_date, count(*), sum(click), sum(conversion) FROM b GROUP BY ALL)
),{_gold("g", "s", "event_date IN (SELECT event_date FROM changed)")}
SELECT * FROM g""",
    "gold_trailing_window": f"""{
        _with(_RAW, _attributed("s"), _gold("g", "s", _trailing("event_date", 30)))
    }
SELECT * FROM g""",
    "gold_range": f"""{
        _with(
            _RAW,
            _attributed("s"),
            _gold("g", "s", "event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"),
        )
    }
SELECT * FROM g""",
    "gold_daily": f"{_with(_incremental(_WEEKS), _gold('g', 's'))} SELECT * FROM g",
    "gold_full_refresh": f"{_FULL_GOLD} SELECT * FROM g",
    "changed_dates_count": f"""{_BOTH}
SELECT a.event_date FROM (SELECT event_date, count(*) AS n FROM s GROUP BY ALL) a
LEFT JOIN (SELECT event_date, count(*) AS n FROM b GROUP BY ALL) p USING (event_date)
WHERE p.n IS NULL OR p.n <> a.n""",
    "changed_dates_initial": f"{_FULL} SELECT DISTINCT event_date FROM s",
    "changed_dates_content": f"""{_BOTH},
now_ AS (SELECT event_date, count(*) AS n, sum(click) AS c, sum(conversion) AS v
         FROM s GROUP BY ALL),
was AS (SELECT event_date, count(*) AS n, sum(click) AS c, sum(conversion) AS v
        FROM b GROUP BY ALL)
SELECT DISTINCT event_date FROM
  ((FROM now_ EXCEPT FROM was) UNION ALL (FROM was EXCEPT FROM now_))""",
    "first_commit_of_day": f"""{_with(_RUNS)}
SELECT commit_id, parent_id, committed_at FROM runs
WHERE layer = 'silver' AND commit_id >= 2
ORDER BY committed_at LIMIT 1""",
    "alert_freshness": f"""{_with(_RUNS)}
SELECT layer, 'no_snapshot_today' AS alert_type, max(committed_at) AS latest_committed_at
FROM runs GROUP BY layer HAVING CAST(max(committed_at) AS DATE) < DATE '2024-02-10'""",
    "alert_consistency": f"""{
        _with(_RAW, _attributed("s"), _attributed("b", _EARLY), _gold("g", "b"))
    },
x AS (SELECT event_date, count(*) AS silver_rows FROM s
      WHERE {_trailing("event_date", 30)} GROUP BY ALL),
y AS (SELECT summary_date, CAST(sum(impressions) AS BIGINT) AS n FROM g
      WHERE {_trailing("summary_date", 30)} GROUP BY ALL)
SELECT event_date, silver_rows, coalesce(n, 0) AS gold_impressions,
       CASE WHEN n IS NULL THEN 100.0::DOUBLE
            ELSE round(abs(silver_rows - n)::DOUBLE / silver_rows * 100, 2) END AS diff_pct,
       CASE WHEN n IS NULL THEN 'gold_partition_missing'
            ELSE 'silver_gold_count_mismatch' END AS alert_type
FROM x LEFT JOIN y ON event_date = summary_date
WHERE n IS NULL OR abs(silver_rows - n)::DOUBLE / silver_rows > 0.1""",
    "alert_missing_dates": f"""{_FULL}
SELECT CAST(d AS DATE) AS missing_date, 'event_date_missing_in_silver' AS alert_type
FROM range(TIMESTAMP '2024-01-11', TIMESTAMP '2024-02-10', INTERVAL 1 DAY) r(d)
WHERE CAST(d AS DATE) NOT IN (SELECT event_date FROM s)""",
    "alert_latency": f"""{_FULL}
SELECT event_date, quantile_disc(end_to_end_latency_sec, 0.5) AS p50_e2e_sec,
       '5min_latency_threshold_breached' AS alert_type
FROM s WHERE {_trailing("event_date", 30)} GROUP BY event_date
HAVING quantile_disc(end_to_end_latency_sec, 0.5) > 300""",
    "ops_volume": f"""{_FULL}
SELECT event_date, count(*) AS impressions, {_COUNTS}, count(DISTINCT uid) AS unique_users
FROM s WHERE {_trailing("event_date", 14)} GROUP BY event_date""",
    "ops_wow": f"""{_FULL},
t AS (SELECT event_date, count(*) AS n FROM s WHERE {_trailing("event_date", 7)} GROUP BY ALL),
p AS (SELECT CAST(event_date + INTERVAL 7 DAY AS DATE) AS event_date, count(*) AS n FROM s
      WHERE {_trailing("event_date", 7, "DATE '2024-01-24'")} GROUP BY ALL)
SELECT t.event_date, t.n AS rows_this_week, p.n AS rows_prev_week,
       round((t.n::DOUBLE / nullif(p.n, 0) - 1) * 100, 2) AS wow_change_pct
FROM t LEFT JOIN p ON p.event_date = t.event_date""",
    "ops_attribution": f"""{_FULL}
SELECT event_date, count(*) AS impressions, {_COUNTS},
       round(sum(click)::DOUBLE / count(*) * 100, 4) AS click_rate_pct,
       round(sum(conversion)::DOUBLE / count(*) * 100, 4) AS conv_rate_pct
FROM s WHERE {_trailing("event_date", 7)} GROUP BY event_date""",
    "ops_latency": f"""{_FULL}
SELECT event_date, quantile_disc(producer_to_broker_sec, 0.5) AS p50_p2b_sec,
       quantile_disc(broker_to_ingest_sec, 0.5) AS p50_b2i_sec,
       quantile_disc(end_to_end_latency_sec, 0.5) AS p50_e2e_sec
FROM s WHERE {_trailing("event_date", 14)} GROUP BY event_date""",
    "biz_kpi_trend": f"""{_with(_RAW, _attributed("s"), _gold("g", "s", places=15))}
SELECT {_KPI_COLUMNS}, round(ctr, 4) AS ctr, round(cvr, 4) AS cvr, round(cpc, 4) AS cpc,
       round(cpa, 4) AS cpa, round(cpm, 4) AS cpm, click_through_conversions,
       view_through_conversions, round(frequency, 4) AS frequency
FROM g WHERE {_trailing("summary_date", 30)} ORDER BY summary_date DESC, campaign""",
    "biz_conv_delay": f"""{_FULL}
SELECT quantile_disc(conversion_delay_sec, 0.25) AS p25_sec,
       quantile_disc(conversion_delay_sec, 0.5) AS p50_sec,
       quantile_disc(conversion_delay_sec, 0.75) AS p75_sec,
       quantile_disc(conversion_delay_sec, 0.9) AS p90_sec,
       quantile_disc(conversion_delay_sec, 0.95) AS p95_sec, count(*) AS conversion_count
FROM s WHERE conversion = 1 AND conversion_delay_sec >= 0 AND {_trailing("event_date", 30)}""",
    "incident_day": f"""{_FULL}
SELECT event_date, count(*) AS silver_rows, CAST(sum(click) AS BIGINT) AS attributed_clicks,
       CAST(sum(conversion) AS BIGINT) AS attributed_conversions,
       round(avg(end_to_end_latency_sec), 2) AS avg_e2e_sec,
       quantile_disc(end_to_end_latency_sec, 0.5) AS p50_e2e_sec,
       quantile_disc(end_to_end_latency_sec, 0.95) AS p95_e2e_sec,
       round(sum(click)::DOUBLE / count(*) * 100, 4) AS click_rate_pct,
       round(sum(conversion)::DOUBLE / count(*) * 100, 4) AS conv_rate_pct
FROM s WHERE event_date = DATE '2024-01-22' GROUP BY event_date""",
    "incident_commits": f"""{_with(_RUNS)}
SELECT layer, commit_id, parent_id, committed_at, operation FROM runs
ORDER BY committed_at DESC, layer, commit_id DESC LIMIT 20""",
    "bronze_runs": f"""{_with(_RAW)}
SELECT event_type AS topic, CAST(1 AS BIGINT) AS batches, count(*) AS rows,
       count(*) FILTER (kafka_offset % 97 = 0) AS undecoded,
       max((kafka_offset * 37) % 601) AS max_lag_sec
FROM raw GROUP BY event_type""",
    "users_window": f"""{_with(_incremental(_WEEKS))},
seen AS (SELECT DISTINCT w.n, s.campaign, s.uid, s.conversion,
           date_diff('day', s.event_date, DATE '2024-01-31') <= w.n AS now
         FROM s, (VALUES (7), (14), (30)) w(n)
         WHERE date_diff('day', s.event_date, DATE '2024-01-31') BETWEEN 1 AND 2 * w.n
           AND s.campaign IS NOT NULL)
SELECT CAST(n AS INTEGER) AS window_days, campaign,
       count(DISTINCT uid) FILTER (now) AS users,
       count(DISTINCT uid) FILTER (now AND conversion = 1) AS converting_users,
       (SELECT count(DISTINCT a.uid) FROM seen a JOIN seen b USING (n, campaign, uid)
        WHERE a.now AND NOT b.now AND a.n = seen.n AND a.campaign = seen.campaign) AS returning_users
FROM seen GROUP BY n, campaign HAVING users > 0""",
    "delays_window": f"""{_with(_incremental(_WEEKS))},
v AS (SELECT 'conversion_delay_sec' AS metric, conversion_delay_sec AS x FROM s
      WHERE {_trailing("event_date", 30)} AND conversion = 1 AND conversion_delay_sec >= 0 AND campaign IS NOT NULL
      UNION ALL SELECT 'end_to_end_latency_sec', end_to_end_latency_sec FROM s
      WHERE {_trailing("event_date", 30)} AND campaign IS NOT NULL)
SELECT metric, count(*) AS n, quantile_disc(x, 0.25) AS p25_sec, quantile_disc(x, 0.5) AS p50_sec,
       quantile_disc(x, 0.75) AS p75_sec, quantile_disc(x, 0.9) AS p90_sec,
       quantile_disc(x, 0.95) AS p95_sec
FROM v GROUP BY metric""",
    "alert_rate_drop": f"""{_FULL},
days AS (
  SELECT event_date, count(*) AS rows,
         CAST(sum(CASE WHEN event_date = DATE '2024-01-20' THEN 0 ELSE click END) AS BIGINT) AS clicks,
         CAST(sum(CASE WHEN event_date = DATE '2024-01-27' THEN 0 ELSE conversion END) AS BIGINT) AS conversions
  FROM s GROUP BY event_date
),
rated AS (
  SELECT event_date, measure, (events * 1000000) // rows AS rate_ppm
  FROM (SELECT event_date, rows, 'clicks' AS measure, clicks AS events FROM days
        UNION ALL SELECT event_date, rows, 'conversions', conversions FROM days)
  WHERE {_trailing("event_date", 58)}
),
judged AS (
  SELECT a.event_date, a.measure, a.rate_ppm, median(b.rate_ppm)::DOUBLE AS usual_ppm,
         mad(b.rate_ppm)::DOUBLE AS mad_ppm, CAST(count(*) AS INTEGER) AS weeks
  FROM rated a JOIN rated b ON a.measure = b.measure
    AND date_diff('day', b.event_date, a.event_date) IN (7, 14, 21, 28)
  GROUP BY ALL HAVING count(*) >= 2
)
SELECT * FROM judged WHERE {_trailing("event_date", 30)}
  AND rate_ppm < usual_ppm - 3.0::DOUBLE * mad_ppm AND rate_ppm < 0.5::DOUBLE * usual_ppm""",
    "infra_files": f"""{_FULL}
SELECT event_date, 'data' AS file_type, CAST(1 AS BIGINT) AS file_count,
       count(*) AS total_records
FROM s GROUP BY event_date""",
    "infra_runs": f"""{_with(_incremental(_WEEKS), _RECORDS)}
SELECT 'silver' AS layer, CAST(4 AS BIGINT) AS run_count,
       (SELECT count(*) FROM imp) + (SELECT count(*) FROM changed) AS records
UNION ALL SELECT 'gold', 4, (SELECT count(*) FROM written)""",
    "infra_retention": f"""{_with(_RUNS)}
SELECT layer, count(*) AS snapshot_count, min(committed_at) AS oldest_snapshot,
       max(committed_at) AS latest_snapshot,
       date_sub('day', min(committed_at), max(committed_at)) AS retention_days
FROM runs GROUP BY layer""",
    "gate_silver_commit": _stale("silver"),
    "gate_gold_commit": _stale("gold"),
    "gate_silver_rows": f"""{_FULL}
SELECT count(*) AS silver_rows FROM s WHERE event_date = DATE '2024-02-10' HAVING count(*) = 0""",
    "gate_consistency": f"""{
        _with(_RAW, _attributed("s"), _attributed("b", _EARLY), _gold("g", "b"))
    }
SELECT silver_rows, coalesce(n, 0) AS gold_impressions,
       CASE WHEN n IS NULL THEN 100.0::DOUBLE
            ELSE round(abs(silver_rows - n)::DOUBLE / nullif(silver_rows, 0) * 100, 2)
            END AS diff_pct
FROM (SELECT count(*) AS silver_rows FROM s WHERE event_date = DATE '2024-01-16')
CROSS JOIN (SELECT CAST(sum(impressions) AS BIGINT) AS n FROM g
            WHERE summary_date = DATE '2024-01-16')
WHERE n IS NULL OR abs(silver_rows - n)::DOUBLE / nullif(silver_rows, 0) > 0.1""",
    "gate_bronze_present": f"""{_with(_RAW)}
SELECT DATE '2024-02-10' AS raw_date, 'bronze_missing' AS alert
WHERE NOT EXISTS (SELECT 1 FROM raw WHERE raw_date = DATE '2024-02-10')""",
    "quality_profile": f"""{_FULL}
SELECT event_date, count(*) AS "rows",
       count(*) FILTER (event_id IS NULL OR uid IS NULL) AS null_keys,
       count(*) FILTER (campaign IS NULL) AS null_campaigns,
       count(*) FILTER (click IS NULL OR click NOT IN (0, 1)) AS bad_click_flags,
       count(*) FILTER (conversion IS NULL OR conversion NOT IN (0, 1)) AS bad_conversion_flags,
       {_COUNTS},
       round(sum(click)::DOUBLE / count(*) * 100, 4) AS click_rate_pct,
       round(sum(conversion)::DOUBLE / count(*) * 100, 4) AS conv_rate_pct
FROM s GROUP BY event_date""",
    "split_wide_events": f"""{_with(_WIDE)},
clicked AS (
  SELECT *, 1 + CAST(('0x' || substr(md5(printf('evt_%08d', row_index)), 1, 8)) AS UBIGINT) % 30
    AS delay
  FROM w WHERE clicks
),
streams AS (
  SELECT row_index, uid, campaign, 'impression' AS event_type, coalesce(cost, 0.0) AS cost,
         {_remap('"timestamp"')} AS t FROM w CROSS JOIN origin
  UNION ALL
  SELECT row_index, uid, campaign, 'click', NULL,
         {_remap('"timestamp" + CAST(delay AS BIGINT)')} FROM clicked CROSS JOIN origin
  UNION ALL
  SELECT row_index, uid, campaign, 'conversion', NULL,
         {_remap("conversion_timestamp")} FROM firsts CROSS JOIN origin
)
SELECT printf('evt_%08d', row_index) AS eid, uid, t AS "timestamp",
       strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') AS event_time,
       event_type, campaign, round(cost, 6) AS cost
FROM streams""",
    "first_conversion": f"""{_with(_WIDE)}
SELECT conversion_id, row_index, uid, conversion_timestamp FROM firsts""",
    "time_remap": f"""{_with(_WIDE)}
SELECT row_index, "timestamp", {_remap('"timestamp"')} AS real_ts FROM w CROSS JOIN origin""",
    "day_partition": """
SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, value AS amount,
       CAST(ts AS DATE) AS event_date
FROM events
UNION ALL SELECT -1, TIMESTAMP '2024-02-01 10:30:00', 'manual', 1.5, DATE '2024-02-01'""",
    "day_partition_range": """
SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, value AS amount,
       CAST(ts AS DATE) AS event_date
FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-13'""",
    "compact_binpack": f"{_FULL} SELECT * FROM s",
    "compact_sort": f"{_FULL} SELECT * FROM s",
    "compact_zorder": f"{_FULL} SELECT * FROM s",
    "campaign_filter": f"""{_FULL}
SELECT campaign, count(*) AS impressions, round(sum(cost), 6) AS total_cost
FROM s WHERE campaign = 7 GROUP BY campaign""",
    "daily_run": f"{_with(_incremental(_DAYS), _gold('g', 's'))} SELECT * FROM g",
}
