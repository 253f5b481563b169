"""Prefix trie of conversations by van Emde Boas recursion.

A trie of depth 2^k is cut at half depth: its upper half is a trie of depth
2^(k-1), and below every prefix that ends at the cut hangs a lower trie of the
same depth.  All tries of one recursion level are worked on at once:

1. Sequences are paired up into blocks of 1, 2, 4 ... turns; a block is named
   by a strong digest of its halves' names.  Sequences whose whole block has
   one name are equal, and one of them stands for all from here on.
2. From the whole down, every block is cut in half: the prefix that ends at the
   cut is named from the prefix at the block's start and the name of its first
   half.  The first half goes on as part of an upper trie, the second half as
   part of a lower trie whose root is the cut prefix.  When blocks are single
   turns, every prefix has its name, and equal names are one node.
3. A node belongs to its smallest member.  Totals of a member's nodes are
   summed up the blocks; then lower halves' totals are grafted onto upper halves
   down to single nodes.  What hangs below a node that another member owns is
   that member's total, grafted onto each node of the path it branches from.

Every step is keyed by (member, block) or summed before the shuffle, so neither
a conversation with a third of all turns nor a first turn that a third of all
conversations share lands in one task.  Rounds are logarithmic in the depth.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table
from .registry import query

#: the contract's rebuilding: conversations of a hundred share up to five first turns
SHARED, MOST_SHARED = 100, 6
#: conversation ids of one piece of a node's list of ends: 2^16 of them at most
ENDS_BITS = 16
_FLIP = -(1 << 63)


def _name(*parts: Column) -> tuple[Column, Column]:
    """128 bits of the SHA-256 of the joined parts as two numbers that sort as the hexadecimal digest does."""
    digest = F.sha2(F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)), 256)
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("long").bitwiseXOR(F.lit(_FLIP)) for at in (1, 17))


def numbered(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, row, a, b, chars) in order of conversation and turn, and (conv_id, part, first, before): where
    each conversation starts in a part and how many of its turns are in the parts before.

    Turns are dealt by ranges of (conversation, turn), so that one conversation may fill many parts.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    a, b = _name(F.octet_length(role), F.concat(role, text))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), a.alias("a"), b.alias("b"),
        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = scratch.keep(dealt.select("conv_id", F.spark_partition_id().alias("part"),
                                        F.monotonically_increasing_id().alias("row"), "a", "b", "chars"), "ordered")
    spans = ordered.groupBy("conv_id", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered, spans.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _shift() -> Column:
    """First turns that a conversation takes from the one it shares them with, less the own ones it leaves out."""
    return F.least("h", "there") - F.col("h")


def rebuild(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, i, a, b, chars): turns of the rebuilt conversations, named, and (conv_id, len) of all conversations.

    A conversation c takes the first h original turns of conversation c - c % 100, then its own after its first h;
    h is the crc32 of c in decimal, modulo 6.
    """
    ordered, spans = numbered(conversations, scratch)
    spans = scratch.keep(spans, "spans")
    convs = spans.groupBy("conv_id").agg(F.sum("n").alias("own"))
    home = F.col("conv_id") - F.col("conv_id") % SHARED
    asked = convs.select("conv_id", "own", home.alias("home"),
                         (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).alias("h"))
    homes = convs.filter(F.col("conv_id") % SHARED == 0).select(F.col("conv_id").alias("home"), F.col("own").alias("there"))
    plan = scratch.keep(asked.join(homes, "home", "left").withColumn("there", F.coalesce("there", F.lit(0))), "plan")
    starts = spans.join(plan, "conv_id").select("conv_id", "part", "first", "before", "h", "there")

    def placed(turns, where):
        return turns.join(where, ["conv_id", "part"]).withColumn("pos", F.col("before") + F.col("row") - F.col("first"))

    own = placed(ordered, starts).filter("pos >= h").select("conv_id", (F.col("pos") + _shift()).alias("i"), "a", "b", "chars")
    shared = placed(ordered.filter(F.col("conv_id") % SHARED == 0), spans).filter(F.col("pos") < MOST_SHARED - 1).select(
        F.col("conv_id").alias("home"), F.col("pos").alias("i"), "a", "b", "chars")
    heads = plan.select("conv_id", "home", "h").join(shared, "home").filter("i < h").select("conv_id", "i", "a", "b", "chars")
    turns = scratch.keep(own.unionByName(heads), "turns")
    lens = plan.select("conv_id", (F.least("h", "there") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    return turns, lens


def _blocks(turns: DataFrame, levels: int, scratch: Scratch) -> list[DataFrame]:
    """Per level the blocks (conv_id, i, a, b), from level 1 on with their first half's name (la, lb) and ``more``:
    whether there is a second half."""
    rows = [turns.select("conv_id", "i", "a", "b")]
    even = F.col("i") % 2 == 0
    for j in range(1, levels + 1):
        pairs = rows[-1].groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(
            *(F.max(F.when(half, F.col(c))).alias(f"{side}{c}") for side, half in (("l", even), ("r", ~even)) for c in "ab"))
        a, b = _name(F.col("la"), F.col("lb"), F.col("ra"), F.col("rb"))
        rows.append(scratch.keep(pairs.select("conv_id", "i", "la", "lb", F.col("ra").isNotNull().alias("more"),
                                              a.alias("a"), b.alias("b")), f"blocks{j}"))
    return rows


def _paths(sequences: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """(rep, n, depth, pa, pb, ea, eb): every prefix of every sequence by name, with its parent's name.

    ``sequences(rep, n, a, b)`` are named whole blocks.  A block that is cut names the prefix at its cut; where it
    has no second half, its first half is all of it.
    """
    ea, eb = _name(F.lit(0), F.lit(0), F.col("a"), F.col("b"))
    zero = F.lit(0).cast("long")
    cuts = sequences.select("rep", "n", zero.alias("i"), zero.alias("pa"), zero.alias("pb"), ea.alias("ea"), eb.alias("eb"))
    for rows in reversed(blocks[1:]):
        met = cuts.join(rows.select(F.col("conv_id").alias("rep"), "i", "la", "lb", "more"), ["rep", "i"])
        ca, cb = _name(F.col("pa"), F.col("pb"), F.col("la"), F.col("lb"))
        met = met.withColumns({"ca": ca, "cb": cb})
        upper = F.struct((F.col("i") * 2).alias("i"), "pa", "pb", F.col("ca").alias("ea"), F.col("cb").alias("eb"))
        lower = F.struct((F.col("i") * 2 + 1).alias("i"), F.col("ca").alias("pa"), F.col("cb").alias("pb"), "ea", "eb")
        cuts = met.select("rep", "n", F.inline(F.when(F.col("more"), F.array(upper, lower)).otherwise(F.array(upper))))
    return cuts.select("rep", "n", (F.col("i") + 1).alias("depth"), "pa", "pb", "ea", "eb")


TOTALS = ("leaves", "saved")


def _grafted(own: DataFrame, levels: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Totals of ``own(rep, i, leaves, saved)`` from each place on to the member's last, and of all of a member."""
    sums, half = [own], F.shiftright("i", 1)
    for j in range(1, levels + 1):
        up = sums[-1].groupBy("rep", half.alias("i")).agg(*(F.sum(c).alias(c) for c in TOTALS))
        sums.append(scratch.keep(up, f"sums{j}"))
    after = sums[-1].select("rep", "i", *(F.lit(0).cast("long").alias(f"after_{c}") for c in TOTALS))
    for here in reversed(sums[:-1]):
        # a block's second half hangs below its first: graft its total there
        second = here.filter("i % 2 = 1").select("rep", half.alias("up"), *(F.col(c).alias(f"low_{c}") for c in TOTALS))
        spread = here.select("rep", "i", half.alias("up")).join(second, ["rep", "up"], "left").join(
            after.withColumnRenamed("i", "up"), ["rep", "up"])
        low = {c: F.when(F.col("i") % 2 == 0, F.coalesce(f"low_{c}", F.lit(0))).otherwise(0) for c in TOTALS}
        after = spread.select("rep", "i", *((F.col(f"after_{c}") + low[c]).alias(f"after_{c}") for c in TOTALS))
    from_here = own.join(after, ["rep", "i"]).select("rep", "i", *((F.col(c) + F.col(f"after_{c}")).alias(c) for c in TOTALS))
    return from_here, sums[-1].select("rep", *TOTALS)


def _digests(frames):
    """SHA-256 of each key's pieces in order, joined by commas; rows come sorted by key and piece."""
    key, state = None, None
    for pdf in frames:
        out = []
        for a, b, ids in zip(pdf["a"], pdf["b"], pdf["ids"]):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (a, b), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["a", "b", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["a", "b", "ends_sha256"])


def _ends(whole: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of ``whole(conv_id, a, b)``: the digest of the ids that share a name, ascending.

    Ids are first joined in pieces of 2^16 consecutive numbers; the pieces of a name are then read in order, one at a
    time.
    """
    pieces = whole.groupBy("a", "b", F.shiftright("conv_id", ENDS_BITS).alias("piece")).agg(
        F.sort_array(F.collect_list("conv_id")).alias("ids"))
    text = F.concat_ws(",", F.transform("ids", lambda x: x.cast("string")))
    return (pieces.select("a", "b", "piece", text.alias("ids")).repartition("a", "b").sortWithinPartitions("a", "b", "piece")
            .mapInPandas(_digests, "a long, b long, ends_sha256 string"))


def trie(turns: DataFrame, lens: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes of the prefix trie of ``turns(conv_id, i, a, b, chars)``; ``lens(conv_id, len)`` has all conversations.

    ``i`` counts a conversation's turns from 0, (a, b) is a turn's name and chars its weight.  Returns conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  Without conversations there is
    no node, not even the root.
    """
    deepest = lens.agg(F.max("len")).first()[0]
    levels = max(0, (deepest or 0) - 1).bit_length()
    blocks = _blocks(turns, levels, scratch)
    top = blocks[-1].select("conv_id", F.col("a").alias("ta"), F.col("b").alias("tb"))
    whole = scratch.keep(lens.join(top, "conv_id", "left").select(
        "conv_id", "len", F.coalesce("ta", F.lit(0)).alias("a"), F.coalesce("tb", F.lit(0)).alias("b")), "whole")
    sequences = scratch.keep(whole.groupBy("a", "b").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n"),
                                                         F.max("len").alias("len")), "sequences")
    paths = scratch.keep(_paths(sequences.filter("len > 0").select("rep", "n", "a", "b"), blocks), "paths")
    below = paths.groupBy("pa", "pb", "ea", "eb", "depth").agg(F.sum("n").alias("n_convs"), F.min("rep").alias("rep"))
    weights = turns.select(F.col("conv_id").alias("rep"), (F.col("i") + 1).alias("depth"), "chars")
    none = F.lit(None).cast("long")
    root = sequences.agg(F.sum("n").alias("n_convs"), F.min("rep").alias("rep")).filter("rep is not null").select(
        F.lit(0).cast("long").alias("ea"), F.lit(0).cast("long").alias("eb"), none.alias("pa"), none.alias("pb"),
        F.lit(0).cast("long").alias("depth"), "n_convs", "rep", F.lit(0).cast("long").alias("chars"))
    nodes = scratch.keep(below.join(weights, ["rep", "depth"]).unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy("pa", "pb").agg(F.count("*").alias("n_children")).select(
        F.col("pa").alias("ea"), F.col("pb").alias("eb"), "n_children")
    counted = scratch.keep(nodes.join(children, ["ea", "eb"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "counted")
    own = counted.select("rep", F.col("depth").alias("i"), (F.col("n_children") == 0).cast("long").alias("leaves"),
                         ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    from_here, members = _grafted(own, (deepest or 0).bit_length(), scratch)
    # members are smallest from a depth on; what they own hangs below the nodes above that belong to others
    first = counted.groupBy("rep").agg(F.min("depth").alias("owned_from"))
    other = members.join(first, "rep").filter("owned_from > 0")
    steps = paths.select("rep", "depth", "ea", "eb").unionByName(
        sequences.select("rep", *(F.lit(0).cast("long").alias(c) for c in ("depth", "ea", "eb"))))
    grafts = steps.join(other, "rep").filter("depth < owned_from").groupBy("ea", "eb").agg(
        *(F.sum(c).alias(f"more_{c}") for c in TOTALS))
    ends = sequences.filter("len > 0").select("rep", F.col("len").alias("depth"), "a", "b").join(
        paths.select("rep", "depth", "ea", "eb"), ["rep", "depth"]).unionByName(
        sequences.filter("len = 0").select("rep", F.lit(0).cast("long").alias("depth"), "a", "b",
                                           F.lit(0).cast("long").alias("ea"), F.lit(0).cast("long").alias("eb")))
    ended = ends.select("a", "b", "ea", "eb").join(_ends(whole), ["a", "b"]).select("ea", "eb", "ends_sha256")
    parents = counted.select(F.col("ea").alias("pa"), F.col("eb").alias("pb"), F.col("rep").alias("parent_conv_id"))
    totals = from_here.select("rep", F.col("i").alias("depth"), *TOTALS)
    total = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in TOTALS}
    return (counted.join(totals, ["rep", "depth"]).join(grafts, ["ea", "eb"], "left").join(ended, ["ea", "eb"], "left")
            .join(parents, ["pa", "pb"], "left")
            .select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                    total["leaves"].alias("n_leaves"), total["saved"].alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Prefix trie of the rebuilt conversations of ``conversations(conv_id, turn, role, text)``.

    Turns are ordered by turn, null first; rows of one turn by the digest of role and text, so that repeated rows
    are turns of their own.  A null role or text is empty.  Rows without conv_id belong to no conversation and are
    left out.  Texts are compared by digest and never shuffled, however long.  Other columns are ignored.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns, lens = rebuild(conversations.select("conv_id", "turn", "role", "text"), scratch)
    return trie(turns, lens, scratch)


ORACLE_SQL = """
WITH t AS (
  SELECT conv_id, sha256(strlen(r) || ':' || r || x) AS name, length(x) AS chars,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
        WHERE conv_id IS NOT NULL)),
crc AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
      string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda s, v: CASE WHEN v >= 0 THEN xor(s, v) ELSE xor(s >> 1, (s & 1) * 3988292384) END), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT conv_id FROM t)),
c AS (SELECT conv_id, crc % 6 AS h, conv_id - conv_id % 100 AS home FROM crc),
turns AS (
  SELECT conv_id, name, chars, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS d FROM (
    SELECT c.conv_id, name, chars, pos, 0 AS own FROM c JOIN t ON t.conv_id = c.home AND t.pos < c.h
    UNION ALL SELECT conv_id, name, chars, pos, 1 FROM c JOIN t USING (conv_id) WHERE pos >= h)),
path AS (
  SELECT conv_id, d, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY d) AS k, chars FROM turns
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
node AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars FROM path GROUP BY k, d),
kids AS (SELECT substr(k, 1, length(k) - 64) AS k, count(*) AS kids FROM node WHERE d > 0 GROUP BY 1),
own AS (SELECT node.*, coalesce(kids, 0) AS kids, (n - 1) * chars AS saved FROM node LEFT JOIN kids USING (k)),
total AS (SELECT p.k, count(*) FILTER (o.kids = 0) AS leaves, sum(o.saved)::BIGINT AS saved
  FROM own o JOIN path p ON p.conv_id = o.conv_id AND p.d <= o.d GROUP BY p.k),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, last(k ORDER BY d) AS k FROM path GROUP BY conv_id) GROUP BY k)
SELECT o.conv_id, o.d AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.kids AS n_children, total.leaves AS n_leaves,
  total.saved AS saved_tokens, sha256(coalesce(ends.ids, '')) AS ends_sha256
FROM own o JOIN total USING (k) LEFT JOIN ends USING (k)
  LEFT JOIN node p ON o.d > 0 AND p.k = substr(o.k, 1, length(o.k) - 64)
"""


@query("op12_veb_prefix_trie", ORACLE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
