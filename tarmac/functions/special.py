"""Tail probabilities for the test statistics (normal, chi-square, t, F, binomial).

These run on a handful of aggregated rows (one per test or per group pair),
wrapped as Arrow-batched pandas UDFs by ``pvalue_udfs``; the statistics
themselves are Spark columns.  Standard series / continued-fraction forms of
the regularised incomplete gamma and beta functions, in log space.
"""

from __future__ import annotations

import math

_EPS = 1e-15
_TINY = 1e-300
_MAXIT = 100000


def norm_sf(z: float) -> float:
    """P(Z > z) for a standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def norm_two_sided(z: float) -> float:
    return min(1.0, 2.0 * norm_sf(abs(z)))


def _gamma_p_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    for _ in range(_MAXIT):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gamma_q_cf(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = _TINY if abs(d) < _TINY else d
        c = b + an / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gamma_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_cf(a, x)


def chi2_sf(x: float, df: float) -> float:
    if x is None or df is None or df <= 0 or math.isnan(x):
        return float("nan")
    return gamma_q(df / 2.0, x / 2.0)


def _beta_cf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = _TINY if abs(d) < _TINY else d
    d = 1.0 / d
    h = d
    for m in range(1, _MAXIT):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = _TINY if abs(d) < _TINY else d
        c = 1.0 + aa / c
        c = _TINY if abs(c) < _TINY else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _beta_cf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _beta_cf(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return min(1.0, betainc(df / 2.0, 0.5, df / (df + t * t)))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or f <= 0 or math.isnan(f):
        return 1.0 if f is not None and f <= 0 else float("nan")
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def binom_sf_ge(m: int, n: int, p: float) -> float:
    """P(Bin(n, p) >= m) = I_p(m, n - m + 1)."""
    if m <= 0:
        return 1.0
    if m > n:
        return 0.0
    return betainc(float(m), float(n - m + 1), p)


def median_ci_ranks(n: int, level: float = 0.95) -> tuple[float, float, float, float]:
    """Order-statistic ranks of the percentile-bootstrap CI of the median.

    The bootstrap median of a resample is ``<= x_(k)`` when at least
    ``m = (n + 1) / 2`` draws fall at or below ``x_(k)``, i.e. with probability
    ``P(Bin(n, k/n) >= m)``; the CI ends are the smallest ``k`` whose
    probability reaches ``(1 - level) / 2`` and ``(1 + level) / 2``.  For even
    ``n`` the two middle-rank solutions (m = n/2 and n/2 + 1) are averaged.
    Returns ``(k_lo_a, k_lo_b, k_hi_a, k_hi_b)``; the CI is the mean of the
    order statistics at the ``a``/``b`` ranks.
    """
    lo_q, hi_q = (1 - level) / 2, (1 + level) / 2

    def smallest_k(m: int, q: float) -> int:
        lo, hi = 1, n
        while lo < hi:
            mid = (lo + hi) // 2
            if binom_sf_ge(m, n, mid / n) >= q:
                hi = mid
            else:
                lo = mid + 1
        return lo

    if n % 2 == 1:
        m = (n + 1) // 2
        a, b = smallest_k(m, lo_q), smallest_k(m, hi_q)
        return a, a, b, b
    m1, m2 = n // 2, n // 2 + 1
    return smallest_k(m1, lo_q), smallest_k(m2, lo_q), smallest_k(m1, hi_q), smallest_k(m2, hi_q)


def binom_quantile(q: float, n: int, p: float) -> int:
    """Smallest j with P(Bin(n, p) <= j) >= q."""
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi) // 2
        cdf = 1.0 - binom_sf_ge(mid + 1, n, p)
        if cdf >= q:
            hi = mid
        else:
            lo = mid + 1
    return lo


def proportion_ci(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Percentile-bootstrap CI of a share k/n in closed form: a resample's count of
    ones is Binomial(n, k/n), so the CI ends are its quantiles divided by n."""
    if n <= 0:
        return float("nan"), float("nan")
    p = k / n
    return (binom_quantile((1 - level) / 2, n, p) / n, binom_quantile((1 + level) / 2, n, p) / n)
