"""S8 keyed upsert and U1-U3 set operations.

The reference keeps a unique index and runs ``INSERT ... ON CONFLICT DO
UPDATE`` row by row.  Here a whole batch is merged at once: rows are reduced
per key with ``min_by`` / ``max_by`` over an arrival order, which Spark
aggregates map-side before the shuffle — a key repeated by a third of all
rows costs one partial row per map task.  ``KeyedTable`` keeps the result on
shared storage, cut into buckets, and a merge rewrites touched buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _order(order: Sequence[str] | Column) -> Column:
    if isinstance(order, Column):
        return order
    return F.struct(*[F.col(c) for c in order])


def merge_rows(rows: DataFrame, key: Sequence[str], order: Sequence[str] | Column,
               first_cols: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """Reduce every key's arrivals to one row.

    ``first_cols`` keep the value of the first arrival of a key (never
    refreshed on conflict); ``update_cols`` take the latest arrival's value,
    null included (the newest row overwrites, as ``DO UPDATE SET x =
    excluded.x`` does).
    """
    o = _order(order)
    first = F.min_by(F.struct(*[F.col(c) for c in first_cols]), o).alias("_first")
    last = F.max_by(F.struct(*[F.col(c) for c in update_cols]), o).alias("_last")
    agg = rows.groupBy(*key).agg(first, last)
    return agg.select(*key, *[F.col(f"_first.{c}").alias(c) for c in first_cols],
                      *[F.col(f"_last.{c}").alias(c) for c in update_cols])


#: bytes up to which a touched bucket is written whole, and deltas that a larger one has at most
SMALL, DELTAS = 1 << 20, 16


class KeyedTable:
    """A table with one row per key under ``path``, changed by merging batches.

    Layout: ``v=<version>/_bucket=<n>/`` holds the whole of a bucket as of that
    version, ``v=<version>/delta/_bucket=<n>/`` what that version's batch
    added to it; an empty file ``commits/<version>`` commits both.  A bucket's
    rows are those of its largest committed whole and the deltas after it, so
    a failed merge leaves the table as it was, and any later process goes on
    from the files.  A merge writes whole again what it touches of small
    buckets (up to ``SMALL`` bytes) and of those with ``DELTAS`` deltas;
    otherwise it adds its batch's rows and reads nothing of the table, so
    bytes written follow the batches.  Versions are given by the caller (a
    stream's batch ids) and must rise; a version at or below the last
    committed one is not merged again.

    ``bucket``: an integer column over ``key``, by default ``key``'s hash over
    ``buckets``; with keys that begin with a date, buckets by date keep the
    bytes written near the batch's own.  It must stay the same for a path, as
    must ``buckets``: at most so many folders are listed and named on the
    driver.  A bucket is written by up to ``spread`` tasks (raise it where few
    buckets are large).  ``first_cols``
    and ``update_cols`` as in ``merge_rows``; rows with equal ``order`` in one
    key are alike.  Null keys are a key.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str],
                 first_cols: Sequence[str] = (), update_cols: Sequence[str] = (), buckets: int = 64,
                 bucket: Column | None = None, spread: int = 1):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.order, self.first_cols, self.update_cols = list(key), list(order), list(first_cols), list(update_cols)
        hashed = F.xxhash64(*self.key)
        self.bucket = (F.pmod(hashed, F.lit(buckets)) if bucket is None else bucket).cast("int")
        self.part = F.pmod(F.shiftright(hashed, 32), F.lit(spread)).cast("int")

    # -- files ---------------------------------------------------------------
    def _fs(self, name: str = ""):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._fs(folder)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def version(self) -> int | None:
        """The last committed version."""
        return max((int(n) for n in self._names("commits")), default=None)

    def _held(self) -> dict[str, list[tuple[int, str, bool]]]:
        """Per bucket folder the committed (version, path, whether it is the whole), rising."""
        last, held = self.version(), {}
        for v in (int(n[2:]) for n in self._names("") if n.startswith("v=")):
            if last is not None and v <= last:
                for sub in ("", "/delta"):
                    for n in self._names(f"v={v:08d}{sub}"):
                        if n.startswith("_bucket="):
                            held.setdefault(n, []).append((v, f"v={v:08d}{sub}/{n}", not sub))
        return {n: sorted(vs) for n, vs in held.items()}

    @staticmethod
    def _since_whole(versions: list[tuple[int, str, bool]], nth: int = 1) -> list[tuple[int, str, bool]]:
        """A bucket's files from its ``nth`` last whole on."""
        wholes = [i for i, x in enumerate(versions) if x[2]]
        return versions[wholes[-nth]:] if len(wholes) >= nth else versions

    def _read(self, buckets: list[list[tuple[int, str, bool]]]) -> DataFrame | None:
        paths = sorted(f"{self.path}/{p}" for vs in buckets for _, p, _ in vs)
        return self.spark.read.parquet(*paths) if paths else None

    # -- rows ----------------------------------------------------------------
    # A key's state is (order, other columns) of its first and of its last arrival; a side without columns is left out.
    def _sides(self) -> dict[str, list[str]]:
        sides = {n: c for n, c in (("_first", self.first_cols), ("_last", self.update_cols)) if c}
        return sides or {"_first": []}

    def _least(self, rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys, *self.key).agg(*[(F.min if n == "_first" else F.max)(n).alias(n) for n in self._sides()])

    def _reduced(self, rows: DataFrame) -> DataFrame:
        held = {n: [F.col(c) for c in dict.fromkeys(cols) if c not in self.order] for n, cols in self._sides().items()}
        packed = [F.struct(_order(self.order).alias("o"), F.struct(F.lit(0).alias("_"), *x).alias("x")).alias(n) for n, x in held.items()]
        return self._least(rows.select(*self.key, *packed))

    def _placed(self, state: DataFrame) -> DataFrame:
        return state.select(self.bucket.alias("_bucket"), self.part.alias("_part"), *self.key, *self._sides())

    def merge(self, batch: DataFrame, version: int) -> bool:
        """Merge ``batch``; False if ``version`` was merged before."""
        last = self.version()
        if last is not None and version <= last:
            return False
        self._write(self._placed(self._reduced(batch)), version)
        fs, marker = self._fs(f"commits/{version:08d}")
        fs.create(marker, True).close()
        self._clean()
        return True

    def _due(self, versions: list[tuple[int, str, bool]]) -> bool:
        """Whether a merge that touches the bucket writes it whole."""
        if len(versions) > DELTAS:
            return True
        size = 0
        for _, path, _ in versions:
            fs, p = self._fs(path)
            size += fs.getContentSummary(p).getLength()
        return size <= SMALL

    def _write(self, rows: DataFrame, version: int) -> None:
        held = {n: self._since_whole(vs) for n, vs in self._held().items()}
        due = {n: vs for n, vs in held.items() if self._due(vs)}
        path = f"{self.path}/v={version:08d}"
        if not due:
            rows.limit(0).drop("_bucket", "_part").write.mode("overwrite").parquet(path)   # what a failed merge left goes
            rows.drop("_part").write.partitionBy("_bucket").parquet(f"{path}/delta")
            return
        rows = rows.persist()   # a row per key; the batch is run through once
        try:
            touched = {f"_bucket={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}" for r in rows.select("_bucket").distinct().collect()}
            mine = [n for n in due if n in touched]
            numbers = [int(n[8:]) for n in mine if n[8:].lstrip("-").isdigit()]
            inside = F.coalesce(F.col("_bucket").isin(numbers), F.lit(False))
            if len(numbers) < len(mine):
                inside = inside | F.col("_bucket").isNull()
            old = self._read([due[n] for n in mine])
            whole = rows.filter(inside) if old is None else self._placed(old).unionByName(rows.filter(inside))
            merged = self._least(whole.repartition("_bucket", "_part"), "_bucket", "_part")
            merged.drop("_part").write.mode("overwrite").partitionBy("_bucket").parquet(path)
            if len(mine) < len(touched):
                rows.filter(~inside).drop("_part").write.partitionBy("_bucket").parquet(f"{path}/delta")
        finally:
            rows.unpersist()

    def _clean(self, keep: int = 2) -> None:
        """Remove what newer wholes replace; the last ``keep`` of a bucket stay for readers that began before."""
        used = set()
        for versions in self._held().values():
            kept = self._since_whole(versions, keep)
            used |= {v for v, _, _ in kept}
            for _, path, _ in versions[:len(versions) - len(kept)]:
                fs, p = self._fs(path)
                fs.delete(p, True)
        for v in [int(n) for n in self._names("commits")][:-1]:
            if v not in used:
                for name in (f"v={v:08d}", f"commits/{v:08d}"):
                    fs, p = self._fs(name)
                    fs.delete(p, True)

    def read(self) -> DataFrame | None:
        """The table's rows as of now (key, first and updated columns); None before the first row."""
        held = [self._since_whole(vs) for vs in self._held().values()]
        parts = [self._read([vs for vs in held if len(vs) == 1]), self._read([vs for vs in held if len(vs) > 1])]
        if parts[1] is not None:
            parts[1] = self._least(parts[1])
        parts = [p for p in parts if p is not None]
        if not parts:
            return None
        return union_all(parts).select(*self.key, *[
            F.col(f"{n}.o.{c}" if c in self.order else f"{n}.x.{c}").alias(c)
            for n, cols in (("_first", self.first_cols), ("_last", self.update_cols)) for c in cols])

    def read_or_empty(self, rows: DataFrame) -> DataFrame:
        """``read``, or an empty table with the types of ``rows``."""
        found = self.read()
        return rows.select(*self.key, *self.first_cols, *self.update_cols).limit(0) if found is None else found


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def intersect_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in both (distinct)."""
    return a.select(*keys).intersect(b.select(*keys))
