"""Exact k-nearest-neighbour join over Voronoi cells.

1. Identical vectors are one row with a multiplicity, so a vector repeated by a
   third of all rows is one point.
2. About sqrt(N) pivots (a seeded sample of the points, ``MOST_PIVOTS`` at most)
   cut the points into cells: each point belongs to its nearest pivot.  Cells
   are stored as blocks of at most ``BLOCK`` points.
3. Each point's distance to its k-th neighbour inside its own block bounds its
   search.  A pair of cells is looked at only if the distance of their pivots
   less both cells' radii is within the largest bound in the first; the same
   holds for their blocks, and each point is tried against the other cell's
   pivot, radius and the plane between both pivots.
4. Distances are computed between the blocks that are left, and the k nearest
   of all are kept (ties by the neighbour's key).  Blocks are shuffled to tiles of
   up to 128 blocks, once each, not once per pair of blocks.  A task holds the
   blocks of one tile; those they are compared with pass by, one after the other.

No candidate is capped: whatever can be within a point's bound is examined, so
the result is exact.  How many pairs of points are left depends on the data:
few where they lie in clusters, nearly all where all distances are alike.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

#: pivots of a group, and of all groups together (they go to every task)
MOST_PIVOTS, ALL_PIVOTS = 1024, 1 << 15
#: points of a block at most, on average
BLOCK = 1024
#: blocks of so many cells, and so many of a cell, are compared in one place with each block that any of them needs
TILE_CELLS, TILE_SUBS = 32, 4
#: relative room for rounding in bounds
ROOM = 1e-9


def sqdist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length double arrays (JVM-side)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def dist(a: Column, b: Column) -> Column:
    return F.sqrt(sqdist(a, b))


def _identity(payload: list[str]) -> Column:
    """256-bit key of a vector with its payload: different points never share it in practice."""
    return F.unhex(F.sha2(F.to_json(F.struct("vec", *payload)), 256))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances by one matrix product, good to about 1e-7 of the vectors' length."""
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0.0))


def _nearest(x, no, y, other, tie, mult, k: int, bound):
    """Rows (query, neighbour, distance, tie, copies) of each query's k nearest of y within its bound.

    The matrix product only rules out what is clearly too far; the rest is measured exactly.
    """
    rough = _distances(x, y)
    slack = 1e-6 * (np.abs(x).max(initial=0.0) + np.abs(y).max(initial=0.0) + 1.0)
    copies = np.where(no[:, None] == other[None, :], mult - 1, np.broadcast_to(mult, (len(no), len(mult))))
    rough = np.where(copies > 0, rough, np.inf)
    m = min(k, len(y)) - 1
    kth = np.partition(rough, m, axis=1)[:, m] if len(y) >= k else np.full(len(x), np.inf)
    limit = np.minimum(bound * (1 + ROOM), kth) + slack
    q, s = np.nonzero((rough <= limit[:, None]) & (copies > 0))
    d = np.sqrt(((x[q] - y[s]) ** 2).sum(1))
    order = np.lexsort((tie[s], d, q))
    q, s, d = q[order], s[order], d[order]
    c = copies[q, s]
    before = np.cumsum(c) - c
    first = np.searchsorted(q, np.arange(len(x)))
    before -= before[np.minimum(first, max(len(q) - 1, 0))][q] if len(q) else 0
    keep = (before < k) & (d <= bound[q] * (1 + ROOM) + 1e-300)
    return q[keep], s[keep], d[keep], c[keep], before[keep] + c[keep]


def _unpack(row, d: int):
    return (np.frombuffer(row["vec"]).reshape(-1, d), *(np.frombuffer(row[c], dtype=np.int64) for c in ("no", "tie", "mult")),
            np.frombuffer(row["r"]))


_BLOCKS = "g string, cell int, sub int, n int, no binary, tie binary, mult binary, vec binary, r binary, radius double, reach double"


class Cells:
    """Points of a k-NN join in blocks: ``blocks`` and ``pairs`` (g, cell, sub, cell2, sub2) that have to be compared."""

    def __init__(self, dv: DataFrame, k: int, seed: int = 7):
        spark = dv.sparkSession
        counts = dv.groupBy("g").agg(F.count("*").alias("n"))
        sized = counts.collect()   # one row per group
        if len(sized) > ALL_PIVOTS:
            raise ValueError(f"{len(sized)} groups; at most {ALL_PIVOTS}")
        wanted = {r["g"]: min(MOST_PIVOTS, int(np.ceil(np.sqrt(r["n"])))) for r in sized}
        scale = min(1.0, ALL_PIVOTS / max(1, sum(wanted.values())))
        share = {r["g"]: max(1.0, wanted[r["g"]] * scale) / r["n"] for r in sized}
        rates = spark.createDataFrame([(g, float(x)) for g, x in share.items()], "g string, share double")
        draw = F.pmod(F.xxhash64("tie", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        some = dv.join(F.broadcast(rates), "g").filter(draw < F.col("share")).select("g", "tie", "vec")
        lone = dv.groupBy("g").agg(F.min("tie").alias("tie")).join(dv, ["g", "tie"]).select("g", "tie", "vec")
        got = some.unionByName(lone).dropDuplicates(["g", "tie"]).orderBy("g", "tie").collect()   # about ALL_PIVOTS rows
        pivots: dict[str, list] = {}
        for r in got:
            pivots.setdefault(r["g"], []).append(r["vec"])
        self.pivots = {g: np.array(v) for g, v in pivots.items()}
        self.d = len(got[0]["vec"]) if got else 0
        sent = spark.sparkContext.broadcast(self.pivots)

        def assign(frames):
            for pdf in frames:
                out = []
                for g, part in pdf.groupby("g", sort=False):
                    x, p = np.stack(part["vec"].to_numpy()), sent.value[g]
                    cell = np.concatenate([_distances(x[i:i + 2048], p).argmin(axis=1) for i in range(0, len(x), 2048)])
                    out.append(part.assign(cell=cell.astype(np.int32), dp=np.sqrt(((x - p[cell]) ** 2).sum(1))))
                yield pd.concat(out) if out else pdf.assign(cell=[], dp=[])

        placed = checkpoint(dv.select("g", "no", "tie", "mult", "vec").mapInPandas(
            assign, "g string, no long, tie long, mult long, vec array<double>, cell int, dp double"))
        sizes = placed.groupBy("g", "cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("subs"))

        def build(pdf):
            x, dp = np.stack(pdf["vec"].to_numpy()), pdf["dp"].to_numpy()
            no, tie, mult = (pdf[c].to_numpy(dtype=np.int64) for c in ("no", "tie", "mult"))
            r = np.full(len(x), np.inf)
            for at in range(0, len(x), 512):
                q, _, dd, _, upto = _nearest(x[at:at + 512], no[at:at + 512], x, no, tie, mult, k, np.full(len(x[at:at + 512]), np.inf))
                full = upto >= k
                np.minimum.at(r, at + q[full], dd[full])
            return pd.DataFrame({"g": pdf["g"].iloc[:1], "cell": pdf["cell"].iloc[:1], "sub": pdf["sub"].iloc[:1], "n": [len(x)],
                                 "no": [no.tobytes()], "tie": [tie.tobytes()], "mult": [mult.tobytes()], "vec": [x.tobytes()],
                                 "r": [r.tobytes()], "radius": [dp.max()], "reach": [r.max()]})

        dealt = placed.join(F.broadcast(sizes), ["g", "cell"]).withColumn("sub", F.pmod(F.xxhash64("no"), F.col("subs")).cast("int"))
        self.blocks = checkpoint(dealt.drop("subs").groupBy("g", "cell", "sub").applyInPandas(build, _BLOCKS))
        cells = self.blocks.groupBy("g", "cell").agg(F.max("radius").alias("radius"), F.max("reach").alias("reach"))

        def near(pdf):
            g = pdf["g"].iloc[0]
            p, rad, reach = sent.value[g][pdf["cell"]], pdf["radius"].to_numpy(), pdf["reach"].to_numpy()
            gap = _distances(p, p)
            a, b = np.nonzero(gap * (1 - ROOM) - 1e-6 - rad[:, None] - rad[None, :] <= reach[:, None])
            return pd.DataFrame({"g": g, "cell": pdf["cell"].to_numpy()[a], "cell2": pdf["cell"].to_numpy()[b], "gap": gap[a, b]})

        near_cells = cells.groupBy("g").applyInPandas(near, "g string, cell int, cell2 int, gap double")   # MOST_PIVOTS squared a group
        meta = self.blocks.select("g", "cell", "sub", "n", "radius", "reach")
        other = meta.select("g", F.col("cell").alias("cell2"), F.col("sub").alias("sub2"), F.col("n").alias("n2"),
                            F.col("radius").alias("radius2"))
        self.pairs = near_cells.join(meta, ["g", "cell"]).join(other, ["g", "cell2"]).filter(
            F.col("gap") * (1 - ROOM) - 1e-6 - F.col("radius") - F.col("radius2") <= F.col("reach"))

    def _met(self) -> DataFrame:
        """Tile by tile its blocks (``wanted`` is null), then the blocks they have to be compared with (``wanted``: by which
        of them): a block travels once to a tile that needs it."""
        cols = ("n", "no", "tie", "mult", "vec", "r")
        tile = [F.floor(F.col("cell") / TILE_CELLS).alias("tile"), F.floor(F.col("sub") / TILE_SUBS).alias("part")]
        wanted = self.pairs.groupBy("g", *tile, "cell2", "sub2").agg(F.collect_list(F.struct("cell", "sub")).alias("wanted"))
        others = self.blocks.select("g", F.col("cell").alias("cell2"), F.col("sub").alias("sub2"), *cols, "radius")
        sent = wanted.join(others, ["g", "cell2", "sub2"]).withColumnsRenamed({"cell2": "cell", "sub2": "sub"})
        own = self.blocks.select("g", *tile, "cell", "sub", *cols, "radius").withColumn("wanted", F.lit(None))
        return own.unionByName(sent).repartition("g", "tile", "part").sortWithinPartitions(
            "g", "tile", "part", F.col("wanted").isNotNull(), "cell", "sub")

    def _searches(self):
        """Function that names a block's points which have to be compared with another block."""
        pivots = self.blocks.sparkSession.sparkContext.broadcast(self.pivots)

        def live(x, cell, r, row) -> np.ndarray:
            p = pivots.value[row["g"]]
            far = np.sqrt(((x - p[row["cell"]]) ** 2).sum(1))
            least = far * (1 - ROOM) - row["radius"]
            if cell != row["cell"]:   # what lies nearer to the other pivot lies behind the middle of both
                gap = np.sqrt(((p[cell] - p[row["cell"]]) ** 2).sum())
                own = ((x - p[cell]) ** 2).sum(1)
                least = np.maximum(least, (far ** 2 - own) / (2 * max(gap, 1e-300)) * (1 - ROOM) - 1e-6)
            return np.flatnonzero(least <= r * (1 + ROOM) + 1e-9)

        return live

    def candidates(self) -> int:
        """Pairs of points that the bounds leave to be compared."""
        live, d = self._searches(), self.d

        def counted(batches):
            tile, held = None, {}
            for row in _rows(batches):
                if (row["g"], row["tile"], row["part"]) != tile:
                    tile, held = (row["g"], row["tile"], row["part"]), {}
                x, _, _, _, r = _unpack(row, d)
                if row["wanted"] is None:
                    held[row["cell"], row["sub"]] = x.copy(), r.copy()
                else:
                    found = (live(held[w["cell"], w["sub"]][0], w["cell"], held[w["cell"], w["sub"]][1], row) for w in row["wanted"])
                    yield pa.RecordBatch.from_pydict({"n": [sum(len(f) for f in found) * row["n"]]})

        return self._met().mapInArrow(counted, "n long").agg(F.sum("n")).first()[0] or 0

    def nearest(self, k: int) -> DataFrame:
        """(no, no2, distance, tie, copies): for each point at least its k nearest, found block by block.

        Bounds tighten as a tile's blocks meet others, and a tile tells only the k nearest of what it has met.
        """
        d, live = self.d, self._searches()

        def least(q, no2, dd, tie, c):
            """Of the found rows those that k nearest copies of each query need, and the queries' copies up to each."""
            order = np.lexsort((no2, tie, dd, q))
            q, no2, dd, tie, c = (v[order] for v in (q, no2, dd, tie, c))
            before = np.cumsum(c) - c
            before -= before[np.searchsorted(q, q)]
            keep = before < k
            return [v[keep] for v in (q, no2, dd, tie, c)], (before + c)[keep]

        def compare(batches):
            tile, held = None, {}   # of the blocks of a tile: points, numbers, bounds, and the rows found so far

            def told():
                for _, no, _, (q, no2, dd, tie, c) in held.values():
                    yield pa.RecordBatch.from_pydict({"no": no[q], "no2": no2, "distance": dd, "tie": tie, "copies": c})

            for row in _rows(batches):
                if (row["g"], row["tile"], row["part"]) != tile:
                    yield from told()
                    tile, held = (row["g"], row["tile"], row["part"]), {}
                y, other, ties, mult, r = _unpack(row, d)
                if row["wanted"] is None:   # copies, as views would hold the whole batch
                    held[row["cell"], row["sub"]] = [y.copy(), other.copy(), r.copy(),
                                                     [np.empty(0, dtype=t) for t in (int, int, float, int, int)]]
                    continue
                for w in row["wanted"]:
                    mine = held[w["cell"], w["sub"]]
                    x, no, r, found = mine
                    todo = live(x, w["cell"], r, row)
                    new = [found]
                    for i in range(0, len(todo), 512):
                        some = todo[i:i + 512]
                        q, s, dd, c, _ = _nearest(x[some], no[some], y, other, ties, mult, k, r[some])
                        new.append([some[q], other[s], dd, ties[s], c])
                    if len(new) > 1:
                        found, upto = least(*(np.concatenate(v) for v in zip(*new)))
                        full = upto >= k
                        np.minimum.at(r, found[0][full], found[2][full])
                        mine[3] = found
            yield from told()

        return self._met().mapInArrow(compare, "no long, no2 long, distance double, tie long, copies long")


def _rows(batches):
    """Rows of Arrow batches (of 64 MB at most by Spark's setting), binary values as views of them."""
    for batch in batches:
        names = batch.schema.names
        views = [n for n in names if pa.types.is_binary(batch.schema.field(n).type) or pa.types.is_large_binary(batch.schema.field(n).type)]
        columns = {n: batch.column(n) for n in names}
        for i in range(batch.num_rows):
            yield {n: columns[n][i].as_buffer() if n in views else columns[n][i].as_py() for n in names}


def distinct_points(points: DataFrame, vec_col: str, group: str | None, payload: list[str]) -> DataFrame:
    """(g, vec, payload, mult, vkey, no, tie): one row per distinct point, numbered, written to the checkpoint folder."""
    g = F.col(group).cast("string") if group else F.lit("")
    pts = points.select(F.coalesce(g, F.lit("\0")).alias("g"), *payload, F.col(vec_col).cast("array<double>").alias("vec"))
    dv = pts.groupBy("g", "vec", *payload).agg(F.count(F.lit(1)).alias("mult")).withColumn("vkey", _identity(payload))
    return checkpoint(dv.withColumns({"no": F.monotonically_increasing_id(), "tie": F.xxhash64(F.lower(F.hex("vkey")))}))


def knn(points: DataFrame, id_col: str, vec_col: str, k: int, group: str | None = None, seed: int = 7,
        payload: tuple[str, ...] = ()) -> DataFrame:
    """k nearest other points of every point (within ``group`` when given).

    Returns ``(id, [group], vkey, j, nn_vec, nn_key, [nn_<payload>], distance)`` with ``j = 1..k`` ordered by distance
    (ties by the neighbour's key).  Neighbours are identified by (vector, payload): duplicates are interchangeable.
    """
    pl = list(payload)
    dv = distinct_points(points, vec_col, group, pl)
    found = Cells(dv, k, seed).nearest(k)
    order = Window.partitionBy("no").orderBy("distance", "tie", "no2")
    ranked = found.withColumn("before", F.coalesce(F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranked.filter(F.col("before") < k).withColumn("take", F.least("copies", F.lit(k) - F.col("before")))
    nn = ranked.select("no", "no2", "distance", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("take"))).alias("j"))
    other = dv.select(F.col("no").alias("no2"), F.col("vec").alias("nn_vec"), F.col("vkey").alias("nn_key"),
                      *[F.col(c).alias(f"nn_{c}") for c in pl])
    own = dv.select("no", "g", "vkey")
    named = nn.join(other, "no2").join(own, "no").drop("no", "no2")
    g = F.coalesce(F.col(group).cast("string"), F.lit("\0")) if group else F.lit("")
    rows = points.withColumn("vec", F.col(vec_col).cast("array<double>")).select(
        id_col, *([group] if group else []), g.alias("g"), _identity(pl).alias("vkey"))
    return rows.join(named, ["g", "vkey"]).select(
        id_col, *([group] if group else []), "vkey", F.col("j").cast("int").alias("j"), "nn_vec", "nn_key",
        *[f"nn_{c}" for c in pl], "distance")
