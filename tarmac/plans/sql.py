"""Oracle SQL (DuckDB dialect) for the fixture views and the enriched table.

Each oracle query is ``WITH <ctes> <body>``; the CTEs restate the fixture
views independently of the Spark code so the two implementations check
each other.
"""

from __future__ import annotations

import math

from .. import schemas as S

_NK = "(e.user_id % 25)"
_PAD = f"lpad(CAST({_NK} AS VARCHAR), 2, '0')"
_MOD = "(hour(e.ts) * 60 + minute(e.ts))"
_SHIFT = f"((({_MOD} + CAST(round(e.value - 20) AS BIGINT)) % 1440) + 1440) % 1440"

DEPARTURES_RAW = f"""
departures_raw AS (
  SELECT e.event_id AS row_id,
         CAST(e.ts AS DATE) AS flight_date,
         'C' || {_PAD} || ' ' || CAST(e.event_id AS VARCHAR) AS flight_no,
         'C' || {_PAD} AS carrier,
         upper(n.n_name) || ' (N' || {_PAD} || ')' AS route,
         CAST(CAST(e.ts AS DATE) AS TIMESTAMP) + to_minutes(CAST({_MOD} AS BIGINT)) AS planned_ts,
         CASE WHEN e.event_type = 'error' THEN NULL
              ELSE CAST(CAST(e.ts AS DATE) AS TIMESTAMP) + to_minutes(CAST({_SHIFT} AS BIGINT)) END AS actual_ts,
         CASE WHEN e.event_type = 'error' THEN 'Cancelled'
              WHEN e.event_type = 'signup' THEN 'Boarding'
              ELSE 'Departed ' || strftime(CAST(CAST(e.ts AS DATE) AS TIMESTAMP) + to_minutes(CAST({_SHIFT} AS BIGINT)), '%H:%M') END AS status,
         e.ts AS updated_at
  FROM events e JOIN nation n ON n.n_nationkey = {_NK}
)"""

DEPARTURES = """
departures AS (
  SELECT * FROM departures_raw
  WHERE lower(status) LIKE 'departed%' OR lower(status) LIKE 'cancelled%'
)"""

LOCATIONS = """
locations AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code,
         CAST(-60 + (37 * n_nationkey) % 121 AS DOUBLE) AS lat,
         CAST(-180 + (73 * n_nationkey) % 360 AS DOUBLE) AS lon,
         CAST(11 * n_nationkey AS DOUBLE) AS elev
  FROM nation WHERE n_nationkey <> 24
)"""


def haversine_sql(lat: str, lon: str) -> str:
    la0, lo0 = math.radians(S.ORIGIN_LAT), math.radians(S.ORIGIN_LON)
    return (f"({2 * S.EARTH_RADIUS_KM!r} * asin(sqrt(pow(sin((radians({lat}) - {la0!r}) / 2), 2)"
            f" + {math.cos(la0)!r} * cos(radians({lat})) * pow(sin((radians({lon}) - {lo0!r}) / 2), 2))))")


def _case_levels(col: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN '{lab}'" for cond, lab in pairs) + " END"


DAY_PART_SQL = (f"CASE WHEN planned_hour IS NULL THEN NULL "
                f"WHEN planned_hour >= 5 AND planned_hour < 12 THEN '{S.DAY_PARTS[0]}' "
                f"WHEN planned_hour >= 12 AND planned_hour < 17 THEN '{S.DAY_PARTS[1]}' "
                f"WHEN planned_hour >= 17 AND planned_hour < 22 THEN '{S.DAY_PARTS[2]}' "
                f"ELSE '{S.DAY_PARTS[3]}' END")

DELAY_BAND_SQL = (f"CASE WHEN delay_signed IS NULL THEN NULL "
                  f"WHEN delay_signed <= 0 THEN '{S.DELAY_BANDS[0]}' "
                  f"WHEN delay_signed <= 15 THEN '{S.DELAY_BANDS[1]}' "
                  f"WHEN delay_signed <= 30 THEN '{S.DELAY_BANDS[2]}' "
                  f"WHEN delay_signed <= 60 THEN '{S.DELAY_BANDS[3]}' "
                  f"ELSE '{S.DELAY_BANDS[4]}' END")

WEEKDAY_SQL = "list_extract([" + ", ".join(f"'{d}'" for d in S.WEEKDAYS) + "], dow_num + 1)"


def enriched_ctes(threshold: float = 15) -> str:
    return f"""{DEPARTURES_RAW},{DEPARTURES},{LOCATIONS},
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_date, flight_no, planned_ts
                                 ORDER BY updated_at DESC, row_id DESC) AS _rn
    FROM departures) WHERE _rn = 1
),
step1 AS (
  SELECT row_id, flight_date, planned_ts,
         CAST(contains(lower(status), 'cancelled') AS INTEGER) AS is_cancelled,
         CASE WHEN d < -720 THEN d + 1440 ELSE d END AS delay_signed,
         upper(trim(carrier)) AS carrier,
         upper(trim(route)) AS route
  FROM (SELECT *, date_diff('second', planned_ts, actual_ts) / 60.0 AS d FROM dedup)
),
step2 AS (
  SELECT *,
         CASE WHEN delay_signed < 0 THEN 0.0 ELSE delay_signed END AS delay_min,
         hour(planned_ts) AS planned_hour,
         isodow(planned_ts) - 1 AS dow_num,
         month(planned_ts) AS month,
         weekofyear(planned_ts) AS iso_week,
         upper(trim(replace(split_part(route, '(', -1), ')', ''))) AS dest_code,
         {DELAY_BAND_SQL} AS delay_band
  FROM step1
),
step3 AS (
  SELECT s.*,
         {WEEKDAY_SQL} AS dow,
         CAST(dow_num IN (5, 6) AS INTEGER) AS is_weekend,
         {DAY_PART_SQL} AS day_part,
         CAST(delay_min > {threshold} AS DOUBLE) AS is_late,
         {haversine_sql('l.lat', 'l.lon')} AS distance_km
  FROM step2 s LEFT JOIN locations l ON l.code = s.dest_code
),
fence AS (
  SELECT quantile_cont(delay_min, 0.75) + 1.5 * (quantile_cont(delay_min, 0.75) - quantile_cont(delay_min, 0.25)) AS f
  FROM step3
),
enriched AS (
  SELECT row_id, flight_date, carrier, route, is_cancelled, delay_signed, delay_min, planned_hour,
         dow_num, dow, is_weekend, day_part, month, iso_week, dest_code, distance_km, delay_band, is_late,
         CAST(coalesce(delay_min > (SELECT f FROM fence), false) AS INTEGER) AS is_outlier
  FROM step3
)"""


def with_enriched(body: str, threshold: float = 15) -> str:
    return f"WITH {enriched_ctes(threshold)}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {DEPARTURES_RAW},{DEPARTURES},{LOCATIONS}\n{body}"


TRANSIT = """
transit AS (
  SELECT l.l_orderkey * 8 + l.l_linenumber AS row_id,
         CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS value,
         o.o_orderpriority, l.l_returnflag, o.o_orderstatus, p.p_brand
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""


def with_transit(body: str) -> str:
    return f"WITH {TRANSIT}\n{body}"


def q_enriched(body: str, extra: str = "", threshold: float = 15) -> str:
    """``WITH <enriched ctes>[, extra ctes] body``."""
    more = f",\n{extra.strip().rstrip(',')}" if extra.strip() else ""
    return f"WITH {enriched_ctes(threshold)}{more}\n{body}"


def q_raw(body: str, extra: str = "") -> str:
    more = f",\n{extra.strip().rstrip(',')}" if extra.strip() else ""
    return f"WITH {DEPARTURES_RAW},{DEPARTURES},{LOCATIONS}{more}\n{body}"


def q_transit(body: str, extra: str = "") -> str:
    more = f",\n{extra.strip().rstrip(',')}" if extra.strip() else ""
    return f"WITH {TRANSIT}{more}\n{body}"
