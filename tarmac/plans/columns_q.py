"""Scalar-function queries (S1, P1-P33) over the departures fixture.

Each returns ``row_id`` plus the computed columns for every row, so the
oracle compares the functions value by value on the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import columns as C
from ..sources import tables as TB
from . import sql as Q
from .enrich import build_features, load_xy
from .registry import register
from .views import R, rnd

_RAW_ONLY = "SELECT * FROM departures_raw"


@register("status_filter", Q.q_raw("""
SELECT row_id, status FROM departures_raw
WHERE lower(status) LIKE 'departed%' OR lower(status) LIKE 'cancelled%'"""))
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix filter on status (pushed to the scan as a predicate)."""
    return TB.scan_departures(spark, sf_dir).select("row_id", "status")


@register("dest_codes", Q.q_raw("""
SELECT row_id, upper(trim(replace(split_part(route, '(', -1), ')', ''))) AS dest_code,
       upper(trim(route)) AS route_norm,
       regexp_replace(route, '\\s*\\(.*\\)', '') AS route_label,
       CASE WHEN instr(flight_no, ' ') > 0 THEN split_part(flight_no, ' ', 1) ELSE 'UNKNOWN' END AS carrier_code
FROM departures_raw"""))
def dest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2 + P17 + P20."""
    d = TB.departures_raw(spark, sf_dir)
    return d.select("row_id", C.dest_code("route").alias("dest_code"), C.normalise_text("route").alias("route_norm"),
                    C.strip_parenthetical("route").alias("route_label"),
                    C.carrier_code("flight_no").alias("carrier_code"))


@register("status_time", Q.q_raw("""
SELECT row_id, hhmm,
       CASE WHEN a < planned_ts - INTERVAL 12 HOUR THEN a + INTERVAL 1 DAY ELSE a END AS actual_parsed
FROM (SELECT row_id, planned_ts, nullif(regexp_extract(status, '(?i)departed\\s+(\\d{2}:\\d{2})', 1), '') AS hhmm,
             try_strptime(strftime(flight_date, '%Y-%m-%d') || ' ' ||
                          nullif(regexp_extract(status, '(?i)departed\\s+(\\d{2}:\\d{2})', 1), ''), '%Y-%m-%d %H:%M') AS a
      FROM departures_raw)"""))
def status_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P4 + P6: time from the status text, combined with the date, midnight guard."""
    d = TB.departures_raw(spark, sf_dir)
    hhmm = C.time_from_status("status", "departed")
    a = C.combine_date_time("flight_date", hhmm)
    return d.select("row_id", hhmm.alias("hhmm"), C.midnight_guard(a, F.col("planned_ts")).alias("actual_parsed"))


@register("parse_dates", Q.q_raw("""
SELECT row_id, txt, coalesce(CAST(try_strptime(txt, '%d/%m/%Y') AS DATE), CAST(try_strptime(txt, '%Y-%m-%d') AS DATE)) AS parsed
FROM (SELECT row_id, CASE row_id % 3 WHEN 0 THEN strftime(flight_date, '%d/%m/%Y')
                                     WHEN 1 THEN strftime(flight_date, '%Y-%m-%d')
                                     ELSE 'day ' || CAST(row_id AS VARCHAR) END AS txt
      FROM departures_raw)"""))
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: DD/MM/YYYY first, then YYYY-MM-DD; anything else -> null."""
    d = TB.departures_raw(spark, sf_dir)
    txt = (F.when(F.pmod("row_id", F.lit(3)) == 0, F.date_format("flight_date", "dd/MM/yyyy"))
           .when(F.pmod("row_id", F.lit(3)) == 1, F.date_format("flight_date", "yyyy-MM-dd"))
           .otherwise(F.concat(F.lit("day "), F.col("row_id").cast("string"))))
    t = d.select("row_id", txt.alias("txt"))
    return t.select("row_id", "txt", C.parse_date_multi("txt").alias("parsed"))


@register("delays", Q.q_raw("""
SELECT row_id, d AS delay_raw, CASE WHEN d < -720 THEN d + 1440 ELSE d END AS delay_signed,
       CASE WHEN (CASE WHEN d < -720 THEN d + 1440 ELSE d END) < 0 THEN 0.0
            ELSE (CASE WHEN d < -720 THEN d + 1440 ELSE d END) END AS delay_min
FROM (SELECT row_id, date_diff('second', planned_ts, actual_ts) / 60.0 AS d FROM departures_raw)"""))
def delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8 + P9."""
    d = TB.departures_raw(spark, sf_dir)
    raw = C.delay_raw("planned_ts", "actual_ts")
    signed = C.rollover_minutes(raw)
    return d.select("row_id", raw.alias("delay_raw"), signed.alias("delay_signed"), C.delay_clipped(signed).alias("delay_min"))


@register("cancel_flags", Q.q_raw("""
SELECT row_id, CAST(contains(lower(status), 'cancelled') AS INTEGER) AS c_contains,
       starts_with(status, 'Cancelled') AS c_starts, CAST(lower(status) LIKE 'cancelled%' AS INTEGER) AS c_like
FROM departures_raw"""))
def cancel_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the three cancellation tests."""
    d = TB.departures_raw(spark, sf_dir)
    return d.select("row_id", C.cancelled_contains("status").alias("c_contains"),
                    C.cancelled_startswith("status").alias("c_starts"), C.cancelled_like("status").alias("c_like"))


@register("calendar", Q.q_raw(f"""
SELECT row_id, hour(planned_ts) AS hour, isodow(planned_ts) - 1 AS dow_num,
       CAST(isodow(planned_ts) - 1 IN (5, 6) AS INTEGER) AS is_weekend, month(planned_ts) AS month,
       weekofyear(planned_ts) AS iso_week, day(planned_ts) AS day_of_month,
       {Q.DAY_PART_SQL.replace('planned_hour', 'hour(planned_ts)')} AS day_part,
       {Q.WEEKDAY_SQL.replace('dow_num', '(isodow(planned_ts) - 1)')} AS dow
FROM departures_raw"""))
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + P12 + P13."""
    d = TB.departures_raw(spark, sf_dir)
    dow = C.weekday_mon0("planned_ts")
    return d.select("row_id", F.hour("planned_ts").alias("hour"), dow.alias("dow_num"),
                    C.is_weekend(dow).alias("is_weekend"), F.month("planned_ts").alias("month"),
                    F.weekofyear("planned_ts").alias("iso_week"), F.dayofmonth("planned_ts").alias("day_of_month"),
                    C.day_part(F.hour("planned_ts")).alias("day_part"), C.weekday_name(dow).alias("dow"))


def _hist_sql(col: str) -> str:
    e, labs = S.HIST_EDGES, S.HIST_LABELS
    parts = " ".join(f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(e[:-1], e[1:], labs))
    return f"CASE {parts} END"


@register("delay_bands", Q.q_raw(f"""
SELECT row_id, {Q.DELAY_BAND_SQL} AS delay_band, {_hist_sql('delay_signed')} AS hist_band
FROM (SELECT row_id, CASE WHEN d < -720 THEN d + 1440 ELSE d END AS delay_signed
      FROM (SELECT row_id, date_diff('second', planned_ts, actual_ts) / 60.0 AS d FROM departures_raw))"""))
def delay_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14 + P15: right-closed bands."""
    d = TB.departures_raw(spark, sf_dir)
    s = C.rollover_minutes(C.delay_raw("planned_ts", "actual_ts"))
    return d.select("row_id", C.delay_band(s).alias("delay_band"), C.delay_histogram_band(s).alias("hist_band"))


@register("late_flags", Q.q_raw("""
SELECT row_id, CAST(dm > 15 AS DOUBLE) AS late_a, CAST(coalesce(d > 15, false) AS INTEGER) AS late_b,
       CAST(coalesce(d >= 15, false) AS INTEGER) AS late_c
FROM (SELECT row_id, d, CASE WHEN ds < 0 THEN 0.0 ELSE ds END AS dm
      FROM (SELECT row_id, d, CASE WHEN d < -720 THEN d + 1440 ELSE d END AS ds
            FROM (SELECT row_id, date_diff('second', planned_ts, actual_ts) / 60.0 AS d FROM departures_raw)))"""))
def late_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three deliberate late definitions (tri-state > 15; > 15 null->0; >= 15 null->0)."""
    d = TB.departures_raw(spark, sf_dir)
    raw = C.delay_raw("planned_ts", "actual_ts")
    dm = C.delay_clipped(C.rollover_minutes(raw))
    return d.select("row_id", C.late_flag_nullable(dm, 15).alias("late_a"), C.late_flag_strict(raw, 15).alias("late_b"),
                    C.late_flag_inclusive(raw, 15).alias("late_c"))


@register("distance", Q.q_raw(f"""
SELECT d.row_id, l.lat, l.lon, l.elev, round({Q.haversine_sql('l.lat', 'l.lon')}, {R}) AS distance_km
FROM (SELECT row_id, upper(trim(replace(split_part(route, '(', -1), ')', ''))) AS dest_code FROM departures_raw) d
LEFT JOIN locations l ON l.code = d.dest_code"""))
def distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + P18: broadcast lookup of the bounded location dimension, great-circle distance."""
    from .enrich import with_location
    d = TB.departures_raw(spark, sf_dir).select("row_id", C.dest_code("route").alias("dest_code"))
    j = with_location(d, TB.locations(spark, sf_dir))
    return j.select("row_id", "lat", "lon", "elev", rnd("distance_km"))


@register("cyclic", Q.q_raw(f"""
SELECT row_id, round(sin(2 * pi() * hour(planned_ts) / 24.0), {R}) AS hour_sin,
       round(cos(2 * pi() * hour(planned_ts) / 24.0), {R}) AS hour_cos,
       round(sin(2 * pi() * (isodow(planned_ts) - 1) / 7.0), {R}) AS dow_sin,
       round(cos(2 * pi() * (isodow(planned_ts) - 1) / 7.0), {R}) AS dow_cos,
       round(sin(2 * pi() * month(planned_ts) / 12.0), {R}) AS month_sin,
       round(cos(2 * pi() * month(planned_ts) / 12.0), {R}) AS month_cos
FROM departures_raw"""))
def cyclic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sin/cos encodings with periods 24, 7, 12."""
    d = TB.departures_raw(spark, sf_dir)
    hs, hc = C.cyclic(F.hour("planned_ts"), 24)
    ds, dc = C.cyclic(C.weekday_mon0("planned_ts"), 7)
    ms, mc = C.cyclic(F.month("planned_ts"), 12)
    return d.select("row_id", rnd(hs, "hour_sin"), rnd(hc, "hour_cos"), rnd(ds, "dow_sin"), rnd(dc, "dow_cos"),
                    rnd(ms, "month_sin"), rnd(mc, "month_cos"))


# Vocabulary deliberately shorter than the carrier set so unknown codes occur.
ENCODE_VOCAB = S.CARRIER_VOCAB[:20]


def _one_hot_sql() -> str:
    cols = ", ".join(f"CAST(coalesce(carrier = '{v}', false) AS INTEGER) AS carrier_{v}" for v in ENCODE_VOCAB)
    return Q.q_raw(f"SELECT row_id, {cols} FROM departures_raw")


@register("one_hot", _one_hot_sql())
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed vocabulary (unknown -> all zeros)."""
    d = TB.departures_raw(spark, sf_dir)
    return d.select("row_id", *C.one_hot("carrier", ENCODE_VOCAB, "carrier"))


@register("ordinal", Q.q_raw("SELECT row_id, coalesce(list_position([" + ", ".join(f"'{v}'" for v in ENCODE_VOCAB)
                             + "], carrier), 0) - 1 AS carrier_code FROM departures_raw"))
def ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """0-based vocabulary index (unknown -> -1)."""
    d = TB.departures_raw(spark, sf_dir)
    return d.select("row_id", C.ordinal("carrier", ENCODE_VOCAB).alias("carrier_code"))


@register("level_order", Q.q_enriched("""
SELECT day_part, list_position(['morning', 'afternoon', 'evening', 'night'], day_part) AS level, count(*) AS n
FROM enriched WHERE day_part IS NOT NULL GROUP BY day_part"""))
def level_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level position of an ordered category (sort key)."""
    from .enrich import enriched
    e = enriched(spark, sf_dir).filter(F.col("day_part").isNotNull())
    return (e.groupBy("day_part").agg(F.count(F.lit(1)).alias("n"))
            .select("day_part", C.level_index("day_part", S.DAY_PARTS).alias("level"), "n")
            .orderBy("level"))


def _effect_case(x: str, cuts, labels, absolute: bool) -> str:
    v = f"abs({x})" if absolute else x
    parts = " ".join(f"WHEN {v} < {c} THEN '{lab}'" for c, lab in zip(cuts, labels))
    return f"CASE WHEN {x} IS NULL THEN NULL {parts} ELSE '{labels[-1]}' END"


@register("effect_labels", Q.q_enriched(f"""
SELECT carrier, r,
       {_effect_case('r', S.RHO_CUTS, ['negligible', 'weak', 'moderate', 'strong', 'very strong'], True)} AS rho_label,
       {_effect_case('r', S.RBC_CUTS, ['negligible', 'small', 'medium', 'large'], True)} AS rbc_label,
       {_effect_case('abs(r)', S.V_CUTS, ['negligible', 'weak', 'moderate', 'strong'], False)} AS v_label,
       {_effect_case('r * r', S.EPS2_CUTS, ['negligible', 'small', 'moderate', 'large'], False)} AS eps2_label
FROM (SELECT carrier, round(corr(CAST(planned_hour AS DOUBLE), delay_min), {R}) AS r
      FROM enriched WHERE is_cancelled = 0 AND delay_min IS NOT NULL GROUP BY carrier)"""))
def effect_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effect-size labels of the per-carrier hour/delay correlation."""
    from .enrich import enriched
    e = enriched(spark, sf_dir).filter((F.col("is_cancelled") == 0) & F.col("delay_min").isNotNull())
    g = e.groupBy("carrier").agg(F.round(F.corr(F.col("planned_hour").cast("double"), "delay_min"), R).alias("r"))
    return g.select("carrier", "r", C.rho_label("r").alias("rho_label"),
                    C.rbc_label("r").alias("rbc_label"), C.v_label(F.abs("r")).alias("v_label"),
                    C.eps2_label(F.col("r") * F.col("r")).alias("eps2_label"))


@register("features", Q.q_raw(f"""
SELECT row_id, lat, lon, elev, round(distance_km, {R}) AS distance_km, is_weekend, day_of_month,
       round(sin(2 * pi() * h / 24.0), {R}) AS hour_sin, round(cos(2 * pi() * h / 24.0), {R}) AS hour_cos,
       round(sin(2 * pi() * dw / 7.0), {R}) AS dow_sin, round(cos(2 * pi() * dw / 7.0), {R}) AS dow_cos,
       round(sin(2 * pi() * mo / 12.0), {R}) AS month_sin, round(cos(2 * pi() * mo / 12.0), {R}) AS month_cos,
       {", ".join(f"CAST(coalesce(carrier = '{v}', false) AS INTEGER) AS carrier_{v}" for v in S.CARRIER_VOCAB)},
       is_late
FROM (SELECT d.row_id, d.carrier, l.lat, l.lon, l.elev, {Q.haversine_sql('l.lat', 'l.lon')} AS distance_km,
             CAST(isodow(planned_ts) - 1 IN (5, 6) AS INTEGER) AS is_weekend, day(planned_ts) AS day_of_month,
             hour(planned_ts) AS h, isodow(planned_ts) - 1 AS dw, month(planned_ts) AS mo,
             CAST(coalesce(date_diff('second', planned_ts, actual_ts) / 60.0 > 15, false) AS INTEGER) AS is_late
      FROM departures d JOIN locations l ON l.code = upper(trim(replace(split_part(d.route, '(', -1), ')', ''))))"""))
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M2 (one-hot): feature table with label, rows with missing coordinates dropped."""
    from .enrich import BASE_FEATURES
    x = load_xy(TB.scan_departures(spark, sf_dir), TB.locations(spark, sf_dir), 15, "onehot")
    fl = [c for c in BASE_FEATURES]
    out = []
    for c in x.columns:
        if c in ("distance_km",) or c.endswith("_sin") or c.endswith("_cos"):
            out.append(rnd(c))
        else:
            out.append(F.col(c))
    return x.select(*out)
