"""Scalar column functions.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -----------------------------------------------------------------
def dest_code(route: str | Column, upper: bool = True) -> Column:
    """Text after the last '(', ')' removed, trimmed; no '(' -> whole text."""
    r = _c(route)
    code = F.trim(F.replace(F.substring_index(r, "(", -1), F.lit(")"), F.lit("")))
    return F.upper(code) if upper else code


def carrier_code(flight_no: str | Column, unknown: str = "UNKNOWN") -> Column:
    """Token before the first space, else an 'unknown' literal."""
    f = _c(flight_no)
    return F.when(F.instr(f, " ") > 0, F.substring_index(f, " ", 1)).otherwise(F.lit(unknown))


def time_from_status(status: str | Column, word: str = "departed") -> Column:
    """Case-insensitive ``<word>\\s+(HH:MM)``; no match -> null."""
    return F.nullif(F.regexp_extract(_c(status), rf"(?i){word}\s+(\d{{2}}:\d{{2}})", 1), F.lit(""))


def combine_date_time(date_col: str | Column, hhmm: str | Column) -> Column:
    """Date + 'HH:MM' -> timestamp_ntz, invalid -> null.

    Built from the date and the parsed hour / minute, so no session time zone
    is involved (a wall-clock time is never shifted by a DST rule).
    """
    t = _c(hhmm)
    h = F.substring(t, 1, 2).try_cast("int")
    m = F.substring(t, 4, 2).try_cast("int")
    valid = t.rlike(r"^\d{2}:\d{2}$") & (h <= 23) & (m <= 59)
    ts = F.timestamp_add("MINUTE", h * 60 + m, _c(date_col).cast("timestamp_ntz"))
    return F.when(valid, ts)


def parse_date_multi(text: str | Column, formats: Sequence[str] = ("dd/MM/yyyy", "yyyy-MM-dd")) -> Column:
    """P5: first format that parses wins; none -> null."""
    t = _c(text)
    return F.coalesce(*[F.try_to_date(t, f) for f in formats])


def normalise_text(c: str | Column) -> Column:
    """Trim + upper."""
    return F.upper(F.trim(_c(c)))


def strip_parenthetical(c: str | Column) -> Column:
    """P20: drop a trailing '(...)' part and the blanks before it."""
    return F.regexp_replace(_c(c), r"\s*\(.*\)", "")


# --- time -----------------------------------------------------------------
def midnight_guard(actual: str | Column, planned: str | Column) -> Column:
    """Actual < planned - 12h  =>  actual + 1 day (strict)."""
    a, p = _c(actual), _c(planned)
    return F.when(a < p - F.expr("INTERVAL 12 HOURS"), a + F.expr("INTERVAL 1 DAY")).otherwise(a)


def delay_raw(planned: str | Column, actual: str | Column) -> Column:
    """(actual - planned) in minutes, null if either is null."""
    return F.timestamp_diff("SECOND", _c(planned), _c(actual)) / F.lit(60.0)


def rollover_minutes(d: str | Column) -> Column:
    """Delta < -720 => delta + 1440 (strict, one-sided)."""
    d = _c(d)
    return F.when(d < -720, d + 1440).otherwise(d)


def delay_clipped(d: str | Column) -> Column:
    """max(d, 0) with null kept (``greatest`` would turn null into 0)."""
    d = _c(d)
    return F.when(d < 0, F.lit(0.0)).otherwise(d)


def cancelled_contains(status: str | Column, word: str = "cancelled") -> Column:
    """Lower-case contains -> int."""
    return F.lower(_c(status)).contains(word).cast("int")


def cancelled_startswith(status: str | Column, word: str = "Cancelled") -> Column:
    """Case-sensitive prefix -> boolean."""
    return _c(status).startswith(word)


def cancelled_like(status: str | Column, word: str = "cancelled") -> Column:
    """SQL LIKE prefix, ASCII case-insensitive like the source engine."""
    return F.lower(_c(status)).like(f"{word}%").cast("int")


def hour_of(ts: str | Column) -> Column:
    return F.hour(_c(ts))


def weekday_mon0(ts: str | Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(ts))


def is_weekend(dow: str | Column) -> Column:
    return _c(dow).isin(5, 6).cast("int")


def day_part(hour: str | Column) -> Column:
    """[5,12) morning, [12,17) afternoon, [17,22) evening, else night."""
    h = _c(hour)
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when((h >= 5) & (h < 12), S.DAY_PARTS[0])
            .when((h >= 12) & (h < 17), S.DAY_PARTS[1])
            .when((h >= 17) & (h < 22), S.DAY_PARTS[2])
            .otherwise(S.DAY_PARTS[3]))


def weekday_name(dow: str | Column) -> Column:
    """0..6 -> ordered label."""
    return F.element_at(F.array(*[F.lit(x) for x in S.WEEKDAYS]), _c(dow) + 1)


def right_closed_band(x: str | Column, edges: Sequence[float], labels: Sequence[str],
                      open_low: bool = True, open_high: bool = True) -> Column:
    """Right-closed bins ``(e_i, e_{i+1}]``; values outside the edges -> null.

    ``open_low``/``open_high``: first/last bin extends to -inf/+inf.
    """
    x = _c(x)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    bounds = list(edges)
    if open_low and open_high:
        assert len(labels) == len(bounds) + 1
        for e, lab in zip(bounds, labels):
            expr = expr.when(x <= e, lab)
        return expr.otherwise(labels[-1])
    assert len(labels) == len(bounds) - 1
    for lo, hi, lab in zip(bounds[:-1], bounds[1:], labels):
        expr = expr.when((x > lo) & (x <= hi), lab)
    return expr.otherwise(F.lit(None).cast("string"))


def delay_band(d: str | Column) -> Column:
    """(-inf,0], (0,15], (15,30], (30,60], (60,inf) on the signed delay."""
    return right_closed_band(d, S.DELAY_BAND_EDGES, S.DELAY_BANDS)


def delay_histogram_band(d: str | Column) -> Column:
    """Right-closed edges -200..1000, outside -> null."""
    return right_closed_band(d, S.HIST_EDGES, S.HIST_LABELS, open_low=False, open_high=False)


def late_flag_nullable(delay_min: str | Column, thr: float = 15) -> Column:
    """``> thr`` as 0/1 double, null kept (tri-state)."""
    return (_c(delay_min) > thr).cast("double")


def late_flag_strict(delay: str | Column, thr: float = 15) -> Column:
    """``> thr``, null => 0 (int)."""
    return F.coalesce(_c(delay) > thr, F.lit(False)).cast("int")


def late_flag_inclusive(delay: str | Column, thr: float = 15) -> Column:
    """``>= thr``, null => 0 (int)."""
    return F.coalesce(_c(delay) >= thr, F.lit(False)).cast("int")


def haversine_km(lat: str | Column, lon: str | Column,
                 lat0: float = S.ORIGIN_LAT, lon0: float = S.ORIGIN_LON) -> Column:
    """Great-circle distance to a fixed origin (R = 6371 km)."""
    la0, lo0 = math.radians(lat0), math.radians(lon0)
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    a = (F.pow(F.sin((la - F.lit(la0)) / 2), 2)
         + F.lit(math.cos(la0)) * F.cos(la) * F.pow(F.sin((lo - F.lit(lo0)) / 2), 2))
    return F.lit(2 * S.EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def cyclic(x: str | Column, period: float) -> tuple[Column, Column]:
    """sin/cos(2*pi*x/period)."""
    ang = F.lit(2 * math.pi) * _c(x) / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def coerce_timestamp(text: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """P25: unparsable -> null."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)).cast("timestamp_ntz")


def one_hot(c: str | Column, vocab: Sequence[str], prefix: str) -> list[Column]:
    """Fixed vocabulary, unknown -> all zeros, stable column set."""
    c = _c(c)
    return [F.coalesce((c == v).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in vocab]


def ordinal(c: str | Column, vocab: Sequence[str]) -> Column:
    """0-based index in the vocabulary, unknown -> -1."""
    return (F.array_position(F.array(*[F.lit(v) for v in vocab]), _c(c)) - 1).cast("int")


def level_index(c: str | Column, levels: Sequence[str]) -> Column:
    """1-based position in a declared level list (0 when absent)."""
    return F.array_position(F.array(*[F.lit(v) for v in levels]), _c(c))


def effect_label(x: str | Column, cuts: Sequence[float], labels: Sequence[str], absolute: bool = True) -> Column:
    """Label by ascending cut-offs on |x| (or x)."""
    v = F.abs(_c(x)) if absolute else _c(x)
    expr = F.when(v.isNull(), F.lit(None).cast("string"))
    for cut, lab in zip(cuts, labels):
        expr = expr.when(v < cut, lab)
    return expr.otherwise(labels[-1])


def eps2_label(x):
    return effect_label(x, S.EPS2_CUTS, ["negligible", "small", "moderate", "large"], absolute=False)


def rbc_label(x):
    return effect_label(x, S.RBC_CUTS, ["negligible", "small", "medium", "large"])


def v_label(x):
    return effect_label(x, S.V_CUTS, ["negligible", "weak", "moderate", "strong"], absolute=False)


def rho_label(x):
    return effect_label(x, S.RHO_CUTS, ["negligible", "weak", "moderate", "strong", "very strong"])


def verdict(p: str | Column, alpha: float = S.ALPHA) -> Column:
    p = _c(p)
    return F.when(p.isNull(), F.lit(None).cast("string")).when(p < alpha, "significant").otherwise("not significant")


def format_p(p: str | Column) -> Column:
    """3 significant digits, scientific below 1e-4 (Python-style, no trailing zeros)."""
    p = _c(p)
    plain = F.regexp_replace(F.regexp_replace(F.format_string("%.3g", p), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(p >= 1e-4, plain).otherwise(F.format_string("%.2e", p))


def band_by_threshold(x: str | Column, large: float, small: float | None = None,
                      labels: Sequence[str] = ("ok", "small", "large")) -> Column:
    """Rate -> ok / small / large band."""
    x = _c(x)
    expr = F.when(x.isNull(), F.lit(None).cast("string")).when(x >= large, labels[2])
    if small is not None:
        expr = expr.when(x >= small, labels[1])
        return expr.otherwise(labels[0])
    return expr.otherwise(labels[1])


def label_from_params(params: str | Column, keys: Sequence[str]) -> Column:
    """Compact 'k=v' text from a parameter map, in the given key order."""
    m = _c(params)
    return F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(m[k], F.lit("None"))) for k in keys])


def is_synthetic_date(d: str | Column, dates: Sequence[str]) -> Column:
    """Mark rows of a known list of dates."""
    return _c(d).isin([F.lit(x).cast("date") for x in dates]).cast("int")


def require_columns(df, needed: Sequence[str], forbidden: Sequence[str] = (), numeric: Sequence[str] = ()):
    """Fail before planning if the schema breaks the contract."""
    names = set(df.columns)
    missing = [c for c in needed if c not in names]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    bad = [c for c in forbidden if c in names]
    if bad:
        raise ValueError(f"raw text columns must be encoded first: {bad}")
    kinds = dict(df.dtypes)
    non_num = [c for c in numeric if kinds.get(c) in ("string", "date", "timestamp", "timestamp_ntz", "boolean")]
    if non_num:
        raise ValueError(f"non-numeric feature columns: {non_num}")
    return df
