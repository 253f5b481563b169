"""Near-duplicate vectors: Euclidean p-stable hashing, then exact cosine checks.

A normalised vector x falls into cell ``floor((a.x + b) / CELL)`` of a random
Gaussian projection a with offset b; ``DEPTH`` cells together are its bucket in
one of ``TABLES`` tables.  Cosine 0.93 is Euclidean distance 0.374 between
normalised vectors; with CELL = 6 x that distance one projection keeps such a
pair together with probability 0.867, so a table with 0.867^16 = 0.10 and all
120 tables miss it with probability 3e-6, while unrelated vectors (distance
about 1.41) share a bucket of a table with probability 4e-5.

Equal directions of a label are one class before any join.  Buckets are
compared through their smallest member first (``bucket_components``), and every
pair found is checked by its exact cosine in double precision.  All links of a
vector lie in its own component, so links are then counted by multiplying
blocks of the component's members; no table of pairs is made.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bucket_components, table
from .npwords import mix
from .registry import query

COSINE = 0.93
TABLES, DEPTH, CELL = 120, 16, 2.24
BLOCK = 512


def _projections(dim: int, tables: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([dim, tables, depth])
    return rng.standard_normal((dim, tables * depth)), rng.random(tables * depth)


def _hash(frames, tables=TABLES, depth=DEPTH, cell=CELL):
    """Adds each vector's bucket key in every table (the label is part of the key)."""
    held: dict[int, tuple] = {}
    for pdf in frames:
        keys = [None] * len(pdf)
        sizes = pdf["vec"].map(len)
        for dim, part in pdf.groupby(sizes):
            if dim not in held:
                held.clear()   # one dimension is the usual case
                held[dim] = _projections(dim, tables, depth)
            a, b = held[dim]
            rows = np.flatnonzero(sizes.to_numpy() == dim)
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                x = np.stack(pdf["vec"].iloc[some].to_numpy()).astype(np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                cells = np.floor(x @ a / cell + b).astype(np.int64).astype(np.uint64).reshape(len(some), tables, depth)
                salt = mix(pdf["label"].iloc[some].to_numpy().astype(np.int64).astype(np.uint64))
                k = mix(salt[:, None] + np.arange(tables, dtype=np.uint64)[None, :])
                for j in range(depth):
                    k = mix(k * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, j])
                for i, row in zip(some, k.astype(np.int64)):
                    keys[i] = row
        yield pd.DataFrame({"cls": pdf["cls"], "keys": keys})


def _cosine(frames, least: float):
    for pdf in frames:
        ok = []
        for u, v in zip(pdf["vec_u"], pdf["vec_v"]):
            a, b = np.asarray(u, dtype=np.float64), np.asarray(v, dtype=np.float64)
            ok.append(len(a) == len(b) and _cos(a, b) >= least)
        yield pdf.loc[ok, ["u", "v"]]


def _cos(a: np.ndarray, b: np.ndarray) -> float:
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


def _count_block(left: pd.DataFrame, right: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of each vector of ``left`` to the vectors of ``right``, copies counted as often as they occur."""
    counts = np.zeros(len(left), dtype=np.int64)
    rn = right["n"].to_numpy()
    dims_l, dims_r = left["vec"].map(len).to_numpy(), right["vec"].map(len).to_numpy()
    for dim in np.unique(dims_l):
        i, j = np.flatnonzero(dims_l == dim), np.flatnonzero(dims_r == dim)
        if len(j):
            a = np.stack(left["vec"].to_numpy()[i]).astype(np.float64)
            b = np.stack(right["vec"].to_numpy()[j]).astype(np.float64)
            cos = (a @ b.T) / np.sqrt((a * a).sum(1)[:, None] * (b * b).sum(1)[None, :])
            # near the threshold the plain dot product decides, as in _cosine
            for r, c in np.argwhere(np.abs(cos - least) < 1e-9):
                cos[r, c] = _cos(a[r], b[c])
            counts[i] = ((cos >= least) * rn[j][None, :]).sum(1)
    return pd.DataFrame({"cls": left["cls"], "links": counts})


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors are compared within equal, non-null labels.  A vector that is
    null, empty, zero, or holds a null or non-finite component, links with
    nothing and is its own component, as is one without a label; vectors of
    different dimension do not link.  Rows that repeat an id are vectors of
    their own that share the id.  A null id takes part; a component's id is
    its smallest non-null id.  An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    vec = F.col(vec_col).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x)
    fit = vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(True)) & F.col(label_col).isNotNull() & (
        norm > 0) & (norm < float("inf"))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(fit, vec).alias("vec"),
                          F.when(fit, F.xxhash64(F.col(label_col).cast("string"))).alias("label"),
                          F.when(fit, F.col(label_col).cast("string")).alias("name"))
    # a class: the same label and the same components, told apart by their bytes
    packed = F.sha2(F.concat_ws(",", "name", F.concat_ws(",", F.col("vec").cast("array<string>"))), 256)
    rows = rows.withColumn("cls", F.when(F.col("vec").isNotNull(), F.substring(F.unhex(packed), 1, 16)))
    good = rows.filter("cls is not null")
    classes = scratch.keep(good.groupBy("cls").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"),
                                                   F.first("vec").alias("vec"), F.first("label").alias("label"),
                                                   F.first("name").alias("name")), "classes")
    hashed = classes.select("cls", "vec", "label").mapInPandas(_hash, "cls binary, keys array<long>")
    buckets = hashed.select(F.explode("keys").alias("key"), F.col("cls").alias("id"))
    facts = classes.select("cls", "vec", "name")

    def verify(pairs: DataFrame) -> DataFrame:
        u = facts.select(F.col("cls").alias("u"), F.col("vec").alias("vec_u"), F.col("name").alias("name_u"))
        v = facts.select(F.col("cls").alias("v"), F.col("vec").alias("vec_v"), F.col("name").alias("name_v"))
        both = pairs.join(u, "u").join(v, "v").filter("name_u = name_v").select("u", "v", "vec_u", "vec_v")
        return both.mapInPandas(lambda frames: _cosine(frames, cosine), "u binary, v binary")

    def residual(placed: DataFrame) -> DataFrame:
        a, b = placed.alias("a"), placed.alias("b")
        return (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
                       & (F.col("a.comp") != F.col("b.comp")))
                .select(F.col("a.id").alias("u"), F.col("b.id").alias("v")))

    comp = scratch.keep(bucket_components(scratch, buckets, verify, residual, "vectors"), "comp")
    # members of a component are dealt into blocks of about BLOCK; each block meets every block once
    member = comp.join(classes, comp["node"] == classes["cls"]).select("root", "cls", "vec", "n")
    sizes = member.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = scratch.keep(member.join(sizes, "root").withColumn("block", F.pmod(F.hash("cls"), "blocks")), "member")
    left = member.select("root", F.col("block").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
                         .alias("j"), "cls", "vec", "n")
    right = member.select("root", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"),
                          F.col("block").alias("j"), "cls", "vec", "n")
    counted = left.groupBy("root", "i", "j").cogroup(right.groupBy("root", "i", "j")).applyInPandas(
        lambda a, b: _count_block(a, b, cosine), "cls binary, links long")
    links = counted.groupBy("cls").agg(F.sum("links").alias("links"))
    rooted = classes.select("cls", "least", "n").join(comp, classes["cls"] == comp["node"], "left").select(
        "cls", "least", "n", F.coalesce("root", "cls").alias("root"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = scratch.keep(rooted.join(first, "root").join(links, "cls", "left")
                          .select("cls", "component_id",
                                  (F.coalesce("links", "n") - 1).alias("n_links")), "placed")
    return (rows.select("vec_id", "cls").join(placed, "cls", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


ORACLE_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
g AS (SELECT vec_id, label, v, list_dot_product(v, v) AS q FROM e),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM g a JOIN g b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.q > 0 AND b.q > 0 AND list_dot_product(a.v, b.v) / sqrt(a.q * b.q) >= 0.93),
r AS (SELECT vec_id AS u, vec_id AS w FROM embeddings UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
c AS (SELECT u, min(w) AS component_id FROM r GROUP BY 1),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY 1)
SELECT d.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, d.vec_id = c.component_id AS kept
FROM embeddings d JOIN c ON c.u = d.vec_id LEFT JOIN n ON n.u = d.vec_id
"""


@query("op2_embedding_near_dedup", ORACLE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
