"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path

#: white space of the word rule ``[^\x20\x09-\x0D]+``
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many more underscores as make it unlike any column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def n_words(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null counts as 0."""
    trimmed = F.regexp_replace(F.coalesce(c, F.lit("")), f"^{SPACES}|{SPACES}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


class Scratch:
    """Tables written to the shared checkpoint folder, to cut lineage.

    ``keep`` writes a DataFrame as Parquet and returns a reader of it: a lost
    executor never needs more than these files.  ``drop`` deletes tables that
    nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = shared_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _summary(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(scratch: Scratch, links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links(u, v)``: rows ``(node, root)`` for linked nodes,
    root the smallest node of the component.

    Alternating large-star and small-star steps: every step sends each node's
    neighbours to its smallest neighbour, so the number of edges never grows
    and a hub is one aggregate plus a skew-splittable join.  Stops when a round
    changes nothing (logarithmically many rounds).
    """
    edges = scratch.keep(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct(), f"{name}-cc0")
    state, step = _summary(edges), 0
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # of a largest node without larger neighbours the edges come from the other end
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        nxt = small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        step += 1
        edges = scratch.keep(nxt, f"{name}-cc{step}")
        scratch.drop(f"{name}-cc{step - 1}")
        before, state = state, _summary(edges)
        if state == before:
            break
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _ordered(star: DataFrame) -> DataFrame:
    return star.select(F.least("hub", "id").alias("u"), F.greatest("hub", "id").alias("v"))


def bucket_components(scratch: Scratch, buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
                      residual: Callable[[DataFrame], DataFrame], name: str, rounds: int = 2,
                      confirm: Callable[[DataFrame], DataFrame] | None = None,
                      drawn: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components of the verified links among members that share a bucket.

    ``buckets(key, id)``.  A bucket of n members does not make n² pairs: first
    every member is compared with the bucket's smallest member only, then, in
    buckets whose members lie in different components, with one that a hash
    draws, which differs from bucket to bucket.  Members that the verified
    links have joined need no further look.  What is then left are pairs
    across components of a bucket; all of these are compared last, so that no
    link that could join two components is lost.  ``verify(pairs(u, v))``
    returns the linked pairs; ``residual(rows(key, id, comp))`` makes the pairs
    of the last round (across components, same key, u < v), which ``confirm``
    checks instead of ``verify`` where they have passed a part of its tests.
    ``drawn(rows(key, id, comp), hubs(key, id, comp))`` makes the pairs with
    drawn members in the same way, so that only likely pairs are written.
    """
    dealt = buckets.repartition("key")
    heads = dealt.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub != last")
    placed = scratch.keep(dealt.join(heads.select("key", "hub"), "key").select("key", "id", "hub"), f"{name}-shared")
    shared, comp, tried, links = placed.select("key", "id"), None, None, None
    for r in range(rounds):
        if r:
            order = F.struct(F.xxhash64("id", "key", F.lit(r)).alias("h"), "id", "comp")
            hubs = placed.groupBy("key").agg(F.min(order).alias("least")).select("key", "least.id", "least.comp")
        if r and drawn:
            pairs = drawn(placed, hubs)
        elif r:
            far = placed.join(hubs.select("key", F.col("id").alias("hub"), F.col("comp").alias("there")), "key")
            pairs = _ordered(far.filter("comp != there"))
        else:
            pairs = _ordered(placed.filter("id != hub"))
        pairs = pairs.distinct()
        pairs = scratch.keep(pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti"), f"{name}-star{r}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = scratch.keep((confirm if r and drawn and confirm else verify)(pairs), f"{name}-links{r}")
        if r and found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        comp = scratch.keep(components(scratch, links, f"{name}-{r}"), f"{name}-comp{r}")
        placed = shared.join(comp, shared["id"] == comp["node"], "left").select(
            "key", "id", F.coalesce("root", "id").alias("comp"))
        mixed = placed.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a != b")
        placed = scratch.keep(placed.join(mixed.select("key"), "key", "left_semi"), f"{name}-placed{r}")
        shared = placed.select("key", "id")
    rest = residual(placed).distinct().join(tried, ["u", "v"], "left_anti")
    more = scratch.keep((confirm or verify)(rest), f"{name}-more")
    if more.isEmpty():
        return comp
    return components(scratch, links.unionByName(more), f"{name}-last")
