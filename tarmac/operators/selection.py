"""Exact order statistics of a whole column by narrowing brackets.

``percentile`` keeps one count per distinct value in its final buffer, which
on continuous values is the column itself in one task.  Here a value at a
rank is found by rounds over the (column-pruned) table:

1. ``percentile_approx`` — a sketch of bounded size, combined map-side — gives
   two values of the column, a little below and above the wanted rank.
2. One aggregate counts the rows below, at and between the two.  Either the
   rank falls on one of them, or only the rows of one open interval stay.

The counts decide, so the result is exact whatever the sketch answers, and
both values leave the bracket, so every round makes progress however many
ties there are.  A round keeps about 3 rows in ``ACCURACY``; once ``GATHER``
rows or fewer are left, they are sorted in one buffer of that size.  The
driver sees a few numbers a round.  All ranks of all columns share the jobs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATHER = 1 << 18      # rows sorted in one buffer (a few MB) at the end
ACCURACY = 10_000     # of the sketch: rank error of one row in this many


@dataclass
class _Bracket:
    """Where the value at ``rank`` lies: ``below`` rows before ``lo``, ``inside`` rows in [lo, hi]."""
    x: Column
    rank: int
    inside: int
    below: int = 0
    lo: float = -math.inf
    hi: float = math.inf
    value: float | None = None

    def rows(self) -> Column:
        return F.when(self.x.between(F.lit(self.lo), F.lit(self.hi)), self.x)

    def around(self, accuracy: int) -> tuple[float, float]:
        """Shares of the bracket's rows a little below and above the rank."""
        at, off = (self.rank - self.below + 0.5) / self.inside, 1.5 / accuracy
        return max(0.0, at - off), min(1.0, at + off)

    def narrow(self, a: float, b: float, n: Sequence[int]) -> None:
        """``n``: rows of the bracket below ``a``, up to ``a``, below ``b``, up to ``b``."""
        r = self.rank - self.below
        if r < n[0]:
            self.hi, self.inside = math.nextafter(a, -math.inf), n[0]
        elif r < n[1]:
            self.value = a
        elif r < n[2]:
            self.lo, self.hi = math.nextafter(a, math.inf), math.nextafter(b, -math.inf)
            self.below, self.inside = self.below + n[1], n[2] - n[1]
        elif r < n[3]:
            self.value = b
        else:
            self.lo, self.below, self.inside = math.nextafter(b, math.inf), self.below + n[3], self.inside - n[3]


def _alike(brackets: Sequence[_Bracket]) -> list[list[_Bracket]]:
    """Brackets over the same rows, which share a buffer."""
    found: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        found.setdefault((id(b.x), b.lo, b.hi), []).append(b)
    return list(found.values())


def _solve(df: DataFrame, brackets: Sequence[_Bracket], gather: int, accuracy: int) -> None:
    todo = [b for b in brackets if b.value is None]
    while todo:
        last = _alike([b for b in todo if b.inside <= gather])
        wide = _alike([b for b in todo if b.inside > gather])

        def sorted_at(group):
            rows = F.sort_array(F.collect_list(group[0].rows()))
            return F.transform(F.array(*[F.lit(b.rank - b.below + 1) for b in group]), lambda i: F.element_at(rows, i))

        def sketched(group):
            return F.percentile_approx(group[0].rows(), F.array(*[F.lit(q) for b in group for q in b.around(accuracy)]), accuracy)

        got = df.agg(*map(sorted_at, last), *map(sketched, wide)).first()
        for group, values in zip(last, got):
            for b, v in zip(group, values):
                b.value = float(v)
        todo = [b for group in wide for b in group]
        if todo:
            ends = [float(v) for values in got[len(last):] for v in values]
            pairs = list(zip(ends[::2], ends[1::2]))
            n = df.agg(*[F.count_if(c) for b, (lo, hi) in zip(todo, pairs) for x in [b.rows()]
                         for c in (x < F.lit(lo), x <= F.lit(lo), x < F.lit(hi), x <= F.lit(hi))]).first()
            for i, (b, (lo, hi)) in enumerate(zip(todo, pairs)):
                b.narrow(lo, hi, n[4 * i:4 * i + 4])
        todo = [b for b in todo if b.value is None]


def quantiles(df: DataFrame, columns: Mapping[str, tuple[Column | str, Sequence[float]]], gather: int = GATHER,
              accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles: ``{name: (column, [q, ...])}`` -> ``{name: [value, ...]}``.

    Same results as ``percentile``: nulls don't count, NaN is the largest
    value, a column without values gives None.  ``df`` is read once for the
    counts and once or twice a round, so it should be a written table.
    """
    if not columns:
        return {}
    xs = {k: (F.col(c) if isinstance(c, str) else c).cast("double") for k, (c, _) in columns.items()}
    n = df.agg(*[f(x) for x in xs.values() for f in (F.count, lambda x: F.count_if(F.isnan(x)))]).first()
    found: dict[str, dict[int, _Bracket]] = {}
    spots: dict[str, list[tuple[int, float]]] = {}
    total: dict[str, int] = {}
    for i, (k, (_, qs)) in enumerate(columns.items()):
        total[k], nan = n[2 * i], n[2 * i + 1]
        x = F.when(~F.isnan(xs[k]), xs[k])
        spots[k] = [(math.floor(at), at) for at in ((total[k] - 1) * q for q in qs)] if total[k] else []
        ranks = {r for low, at in spots[k] for r in (low, math.ceil(at))}
        found[k] = {r: _Bracket(x, r, total[k] - nan, value=math.nan if r >= total[k] - nan else None) for r in ranks}
    _solve(df, [b for bs in found.values() for b in bs.values()], gather, accuracy)

    def between(k: str, low: int, at: float) -> float:
        a, b = found[k][low].value, found[k][math.ceil(at)].value
        return a if a == b or at == low else (low + 1 - at) * a + (at - low) * b

    return {k: [between(k, *s) for s in spots[k]] if total[k] else [None] * len(qs) for k, (_, qs) in columns.items()}


def order_parts(df: DataFrame, col: str) -> list[Column]:
    """``col`` as doubles that sort as it does and lose nothing: time stamps as day and microsecond of the day,
    integers as upper and lower 32 bits, other numbers as they are.  Null sorts first, NaN as infinity."""
    kind = dict(df.dtypes)[col]
    c = F.col(col)
    if kind.startswith("timestamp") or kind == "date":
        parts = [F.unix_date(c.cast("date"))]
        if kind != "date":
            parts.append((F.hour(c) * 60 + F.minute(c)).cast("long") * 60_000_000 +
                         (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    elif kind in ("bigint", "long"):
        parts = [F.shiftright(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))]
    else:
        parts = [c]
    top = F.lit(math.inf)
    return [F.coalesce(F.when(F.isnan(p), top).otherwise(p), -top) for p in (p.cast("double") for p in parts)]


def from_rank(df: DataFrame, order: Sequence[str], rank: int, gather: int = GATHER,
              accuracy: int = ACCURACY) -> Column:
    """Condition that holds for the rows from the 0-based ``rank`` on in ascending ``order``.

    The cut row is found part by part: the value of the first part at the
    rank, then, among the rows that share it, the next part.  No row number is
    made.  Rows equal to the cut row in all of ``order`` all satisfy it, so
    ``order`` should end in a key.  ``rank`` must lie in the table.
    """
    parts = [p for c in order for p in order_parts(df, c)]
    first = df.agg(F.count(F.lit(1)), *[f(p) for p in parts for f in (F.min, F.max)]).first()
    inside = first[0]
    parts = [p for i, p in enumerate(parts) if first[2 * i + 1] != first[2 * i + 2]]   # one value decides nothing
    rest, after, tied = df, F.lit(False), F.lit(True)
    for i, p in enumerate(parts):
        b = _Bracket(p, rank, inside)
        _solve(rest, [b], gather, accuracy)
        cut = F.lit(b.value)
        after, tied = after | (tied & (p > cut)), tied & (p == cut)
        if i < len(parts) - 1:
            less, inside = rest.agg(F.count_if(p < cut), F.count_if(p == cut)).first()
            rank -= less
            rest = rest.filter(p == cut)
            if inside == 1:
                break
    return after | tied


def last_share(df: DataFrame, order: Sequence[str], share: float, **kw) -> Column:
    """Condition for the last ``max(1, round(share * n))`` rows in ascending ``order`` (W6); halves round to even."""
    n = df.count()
    return from_rank(df, order, n - max(1, round(share * n)), **kw) if n else F.lit(False)
