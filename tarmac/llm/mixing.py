"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times.  The
whole part is taken outright; the fraction, in words, is a mass between none
and the document's size.  The pivotal method pairs two such documents and moves
mass from one to the other, in a direction drawn so that neither expectation
changes, until one of them is empty or full.  The pair's total stays as it is,
so a source's taken words end within one document of its target.

Pairs are made inside blocks of documents (a fold over an array, all built-in
functions).  A block leaves at most one open document, and blocks of open
documents are folded in turn: a reduction tree with fan-in ``BLOCK`` whose root
is drawn by its own mass.  Blocks are dealt by a hash of the document, so
reruns agree whatever the partitioning, and a source with a third of all rows
is as many blocks as it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, free_names, n_words, table
from .registry import query

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 256
#: mass is counted in whole units of 2^-20 words, so that a pair's total stays exact
UNIT = 1 << 20


def source_targets(docs: DataFrame) -> DataFrame:
    """(source, docs, source_size, target): one row per source of ``docs(source, size)``.

    Shares follow the weights in code point order of the sources, null last;
    a target above ``MOST_COPIES`` times the source's size stops there and the
    excess is shared among the others.  With sources in order of size per
    weight, the stopped ones come first, so one pass of running sums over the
    source table settles it.
    """
    by_source = docs.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)),
                                                          (place % len(WEIGHTS) + 1).cast("int")))
    limit = MOST_COPIES * F.col("source_size")
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = weighed.withColumn("level", left / weights)
    # the level at the first source that is not stopped is the level of all that follow
    free = F.col("level") * F.col("weight") <= limit
    return (level.withColumn("level", F.first(F.when(free, F.col("level")), ignorenulls=True)
                             .over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .select("source", "docs", "source_size",
                    F.when(F.col("level").isNull(), limit.cast("double"))
                    .otherwise(F.least(F.col("level") * F.col("weight"), limit.cast("double"))).alias("target")))


def _draw(a: Column, b: Column) -> Column:
    """Uniform number in [0, 1) that belongs to a pair."""
    h = F.xxhash64(a["doc_id"], a["size"], b["doc_id"], b["size"], F.lit("pivot"))
    return F.pmod(h, F.lit(1 << 52)) / float(1 << 52)


def _pair(state: Column, x: Column) -> Column:
    """Fold step: move mass between the open document and ``x`` until one is settled."""
    a = state["open"]
    up = F.least(a["cap"] - a["mass"], x["mass"])       # from x to the open one
    down = F.least(a["mass"], x["cap"] - x["mass"])     # from the open one to x
    moved = F.when(_draw(a, x) * (up + down) < down, up).otherwise(-down)
    a2, x2 = a.withField("mass", a["mass"] + moved), x.withField("mass", x["mass"] - moved)
    return F.when(a.isNull(), state.withField("open", x)).otherwise(_settle(state["done"], a2, x2))


def _settle(done: Column, a: Column, x: Column) -> Column:
    """The settled documents of a pair go to ``done``, the other stays open."""
    none = F.lit(None)
    both = F.array(a, x)

    def settled(d):
        return (d["mass"] <= 0) | (d["mass"] >= d["cap"])

    return F.aggregate(both, F.struct(none.cast(_DOC).alias("open"), done.alias("done")),
                       lambda s, d: F.when(settled(d), s.withField("done", F.concat(s["done"], F.array(d))))
                       .otherwise(s.withField("open", d)))


_DOC = "struct<doc_id:bigint,size:bigint,rows:bigint,whole:bigint,cap:bigint,mass:bigint>"


def _fold(rows: DataFrame) -> DataFrame:
    """(source, block, open, done) of ``rows(source, block, doc)``: one fold per block."""
    docs = F.array_sort(F.collect_list(F.struct(F.xxhash64("doc.doc_id", "doc.size").alias("h"), "doc")))
    start = F.struct(F.lit(None).cast(_DOC).alias("open"), F.array().cast(f"array<{_DOC}>").alias("done"))
    folded = rows.groupBy("source", "block").agg(docs.alias("docs")).select(
        "source", "block", F.aggregate(F.transform("docs", lambda d: d["doc"]), start, _pair).alias("state"))
    return folded.select("source", "block", "state.open", "state.done")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    A null text or source is a text without words, and a source of its own.
    Equal rows (doc_id, source and size) are one unit: its copies are dealt out
    evenly to the rows.  A document without words, and every document of a
    source without words, is taken 0 words; it keeps one copy if its source's
    rate rounds to one or more.  An empty table gives an empty result; other
    columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                        n_words(F.col(text_col)).alias("size"))
    units = scratch.keep(sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "units")
    sources = scratch.keep(source_targets(units.select("source", (F.col("size") * F.col("rows")).alias("size"))),
                           "sources")
    s = sources.select(F.col("source").alias("s"), "docs", "source_size", "target")
    rated = units.join(s, units["source"].eqNullSafe(s["s"])).drop("s").withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn(
        "wanted", F.col("rate") * F.col("rows")).withColumn("whole", F.floor("wanted"))
    cap = F.col("size") * UNIT
    doc = F.struct("doc_id", "size", "rows", "whole", cap.alias("cap"),
                   F.round((F.col("wanted") - F.col("whole")) * cap).cast("long").alias("mass")).cast(_DOC)
    blocks = F.ceil(F.col("docs") / BLOCK)
    with_words = rated.filter("size > 0").select(
        "source", F.pmod(F.xxhash64("doc_id", "size", F.lit("block")), blocks).alias("block"), doc.alias("doc"))
    deepest = sources.agg(F.max(blocks)).first()[0] or 0
    levels, level = [], 0
    while True:
        folded = scratch.keep(_fold(with_words), f"level{level}")
        levels.append(folded)
        if deepest <= 1:
            break
        with_words = folded.filter("open is not null").select(
            "source", F.floor(F.col("block") / BLOCK).alias("block"), F.col("open").alias("doc"))
        deepest, level = -(-deepest // BLOCK), level + 1
    root = levels[-1].filter("open is not null").select("source", F.col("open").alias("doc"))
    drawn = F.pmod(F.xxhash64("doc.doc_id", "doc.size", F.lit("root")), F.lit(1 << 52)) / float(1 << 52)
    root = root.select("source", "doc", (drawn * F.col("doc.cap") < F.col("doc.mass")).cast("long").alias("more"))
    settled = [x.select("source", F.explode("done").alias("doc")).select(
        "source", "doc", (F.col("doc.mass") > 0).cast("long").alias("more")) for x in levels]
    for x in settled:
        root = root.unionByName(x)
    chosen = root.select("source", "doc.doc_id", "doc.size", "doc.rows",
                         (F.col("doc.whole") + F.col("more")).alias("copies"))
    wordless = rated.filter("size = 0").select("source", "doc_id", "size", "rows",
                                               F.when(F.col("rate") >= 0.5, F.col("rows")).otherwise(F.lit(0))
                                               .cast("long").alias("copies"))
    per_row = chosen.unionByName(wordless).select(
        "source", "doc_id", "size", "copies", "rows", F.explode(F.sequence(F.lit(1).cast("long"), "rows")).alias("nth"))
    each = F.floor(F.col("copies") / F.col("rows")) + (F.col("nth") <= F.col("copies") % F.col("rows")).cast("long")
    out = per_row.select("doc_id", "source", "size", each.cast("long").alias("copies"))
    return out.join(s, out["source"].eqNullSafe(s["s"])).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def repeat_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, all their columns kept.

    Rows that share doc_id, source and size are told apart by their order only.
    """
    row, n, doc, source, size, copies, k, i = free_names(docs, *"row n doc source size copies k i".split())
    plan = mixed.groupBy("doc_id", "source", "size").agg(F.array_sort(F.collect_list("copies")).alias(copies)).select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("size").alias(size), copies)
    # the row is carried whole, so that no column of it meets a name of these steps
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row), n_words(F.col("text")).alias(n))
    met = held.join(plan, F.col(f"{row}.doc_id").eqNullSafe(F.col(doc)) & F.col(f"{row}.source").eqNullSafe(F.col(source))
                    & (F.col(n) == F.col(size)))
    single = met.filter(F.size(copies) == 1).withColumn(k, F.col(copies)[0])
    nth = F.row_number().over(Window.partitionBy(doc, source, size).orderBy(f"{row}.text"))
    several = met.filter(F.size(copies) > 1).withColumn(k, F.element_at(copies, nth))
    taken = single.unionByName(several).filter(F.col(k) > 0)
    return taken.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), k))).select(
        *(F.col(row)[c].alias(c) for c in docs.columns))


@query("op10_pivotal_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies",
                                                         "source")
