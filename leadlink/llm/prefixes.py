"""Prefix trie of conversations, built level by level.

Conversations with equal turns are one class first, which goes through the trie under its smallest
conv_id. At each depth the live classes are grouped by (parent node, next turn), and a group is a node
named by its smallest conv_id. A class that is alone in its node retires: the rest of its turns is a
chain of nodes without branches, which needs no further level. So there are as many levels as the
longest beginning that two different conversations share, and one more. Then, from the last level to
the root, joins sum up the leaves and savings of the children of each node.

Turns are rows throughout, known by a 128-bit hash of role and text. They are numbered by a range sort
with offsets of its partitions, so that no task needs all turns of a conversation; crowded groups are
joined by `spread`.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, spread

EMPTY = hashlib.sha256(b"").hexdigest()
HEAD = 5
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), t (hash of role and text), len (code points) and upto (code points up to
    this turn) of all turns of conversations that have a conv_id, in the order of turn (null first), then t."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = turns.where("conv_id IS NOT NULL").select("conv_id", "turn", key.alias("t"), F.length(text).cast("long").alias("len"))
    order = ["conv_id", "turn", "t"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.table(rows.select("conv_id", "t", "len", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "sorted")
    parts = rows.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("n"), F.sum("len").alias("c"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", "low", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}0") for x in "nc"])
    within = Window.partitionBy("conv_id", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("len").over(within)).join(parts, ["conv_id", "part"])
    return scratch.table(rows.select("conv_id", (F.col("at") - F.col("low") + F.col("n0") + 1).alias("pos"), "t", "len", (F.col("upto") + F.col("c0")).alias("upto")), "turns")


def rebuilt(scratch: Scratch, turns: DataFrame, total: int, group: int = 100, heads: int = HEAD + 1) -> tuple[DataFrame, DataFrame]:
    """(convs, rows): conversations that begin like the first of their group. The first h turns of
    conversation c - c % group (h: crc32 of c in decimal, % heads) stand before c's turns after its own first h.
    convs: conv_id of every conversation. rows: conv_id, d (from 1), t, len and tail (code points from this turn on)."""
    head = F.array_sort(F.collect_list(F.when(F.col("pos") < heads, F.struct("pos", "t", "len"))))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum("len").alias("c"), head.alias("head"))
    convs = scratch.table(convs.withColumns({"h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int"), "base": F.col("conv_id") - F.col("conv_id") % group}), "convs")
    first = convs.select(F.col("conv_id").alias("base"), F.col("head").alias("first"))
    whole = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["len"])
    convs = convs.join(first, "base", "left").withColumn("first", F.slice(F.coalesce("first", F.slice("head", 1, 0)), F.lit(1), F.col("h")))
    rest = (F.col("c") - whole(F.slice("head", F.lit(1), F.col("h")))).alias("rest")
    convs = scratch.table(convs.select("conv_id", "n", "c", "h", "first", rest), "rebuilt")
    begun = convs.select("conv_id", "first", "rest", F.explode("first").alias("x"))
    later = whole(F.filter("first", lambda y: y["pos"] >= F.col("x.pos")))
    begun = begun.select("conv_id", F.col("x.pos").alias("d"), "x.t", "x.len", (F.col("rest") + later).alias("tail"))
    keyed = convs.select("conv_id", F.col("n").alias("w"), "c", "h", F.size("first").alias("b"))
    own = spread(turns, keyed, ["conv_id"], "w", total).where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("b")).alias("d"), "t", "len", (F.col("c") - F.col("upto") + F.col("len")).alias("tail"))
    return convs.select("conv_id"), scratch.table(begun.unionByName(own), "rows")


def listed(convs: DataFrame, keys: list[str], bits: int = 12) -> DataFrame:
    """keys and ends: SHA-256 of their ascending conv_ids, comma-joined. Ids are joined in blocks of
    2^bits numbers; a key of several blocks is hashed block by block, so none is held as a whole."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    blocks = convs.groupBy(*keys, F.shiftright("conv_id", bits).alias("block")).agg(ids.alias("ids"))
    several = blocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("blocks"), F.first("ids").alias("only"))
    single = several.where("blocks = 1").select(*keys, F.sha2("only", 256).alias("ends"))
    kinds = dict(convs.dtypes)

    def hashed(batches):
        import pandas as pd

        now, state = None, None
        for p in batches:
            out = []
            for row in p.itertuples(index=False):
                key, text = tuple(row[: len(keys)]), row.ids.encode()
                if key == now:
                    state.update(b"," + text)
                    continue
                if state:
                    out.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(text)
            yield pd.DataFrame(out, columns=[*keys, "ends"])
        if state:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*keys, "ends"])

    long = blocks.join(several.where("blocks > 1").select(*keys), keys).repartition(*keys).sortWithinPartitions(*keys, "block")
    return single.unionByName(long.select(*keys, "ids").mapInPandas(hashed, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", ends string"))


def trie(spark: SparkSession, conversations: DataFrame, group: int = 100) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of
    every node of the trie of rebuilt conversations (see rebuilt()).

    Rows with a null conv_id belong to no conversation. A null role or text is empty. A null turn comes
    first; equal turns come in the order of a hash of role and text; repeated rows are turns like any
    other. Conversations without turns are members of the root. An empty table gives an empty result.
    Columns besides conv_id, turn, role and text are ignored, whatever they are named."""
    scratch = Scratch(spark, "prefixes")
    turns = numbered(scratch, conversations.select("conv_id", "turn", "role", "text"))
    total = turns.count()
    convs, rows = rebuilt(scratch, turns, total, group)
    keys = ["x1", "x2", "n"]
    xor = rows.groupBy("conv_id").agg(F.bit_xor(F.xxhash64("d", "t")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(7), "d", "t")).alias("x2"), F.count(F.lit(1)).alias("n"))
    xor = scratch.table(convs.join(xor, "conv_id", "left").na.fill(0, keys), "xor")
    classes = xor.groupBy(*keys).agg(F.min("conv_id").alias("c"), F.count(F.lit(1)).alias("size"))
    classes = scratch.table(classes.join(listed(xor, keys), keys).select("c", "size", "n", "ends"), "classes")
    # the turns of each class, those of one depth together
    of = classes.select(F.col("c").alias("conv_id"), "size", "n", F.col("n").alias("w")).where("n > 0")
    steps = spread(rows, of, ["conv_id"], "w", total).withColumnRenamed("conv_id", "c")
    steps = scratch.table(steps.repartitionByRange("d", "c").sortWithinPartitions("d", "c"), "steps")

    root = classes.agg(F.min("c").alias("node"), F.sum("size").alias("members"), F.min(F.when(F.col("n") == 0, F.col("c"))).alias("ender")).where("node IS NOT NULL")
    levels = [scratch.table(root.select("node", F.lit(None).cast("long").alias("parent"), "members", F.lit(0).cast("long").alias("len"), "ender"), "level0")]
    top = levels[0].first()
    chains, live, d = [], classes.where("n > 0").select("c", F.lit(top["node"] if top else None).cast("long").alias("parent")), 0
    while True:
        d += 1
        at = scratch.table(steps.where(F.col("d") == d).select("c", "size", "n", "t", "len", "tail").join(live, "c"), f"at{d}")
        nodes = at.groupBy("parent", "t").agg(F.min("c").alias("node"), F.count(F.lit(1)).alias("k"), F.sum("size").alias("members"), F.max("len").alias("len"), F.max("tail").alias("tail"))
        nodes = scratch.table(nodes, f"nodes{d}")
        chains.append(nodes.where("k = 1").select(F.col("node").alias("c"), "parent", F.lit(d).cast("long").alias("top"), ((F.col("members") - 1) * F.col("tail")).alias("saved")))
        shared = nodes.where("k > 1")
        if shared.isEmpty():
            break
        into = scratch.table(spread(at.select("c", "n", "parent", "t"), shared.select("parent", "t", "node", "k"), ["parent", "t"], "k", total), f"into{d}")
        enders = into.where(F.col("n") == d).select("node", F.col("c").alias("ender"))
        levels.append(scratch.table(shared.select("node", "parent", "members", "len").join(enders, "node", "left"), f"level{d}"))
        live = into.where(F.col("n") > d).select("c", F.col("node").alias("parent"))

    found = []
    below = None
    for d in range(len(levels) - 1, -1, -1):  # leaves and savings of the children, summed up
        parts = chains[d].select("parent", F.lit(1).cast("long").alias("n_leaves"), "saved")
        if below is not None:
            parts = parts.unionByName(below.select("parent", "n_leaves", "saved"))
        sums = parts.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("under"))
        joined = levels[d].join(sums.withColumnRenamed("parent", "node"), "node", "left")
        below = joined.select(
            "node", F.lit(d).cast("long").alias("depth"), "parent", "members", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            ((F.col("members") - 1) * F.col("len") + F.coalesce("under", F.lit(0))).alias("saved"), "ender",
        )
        below = scratch.table(below, f"rolled{d}")
        found.append(below)
    tops = chains[0]
    for c in chains[1:]:
        tops = tops.unionByName(c)
    tops = scratch.table(tops.select("c", "parent", "top").join(classes.select("c", F.col("n").alias("w")), "c"), "tops")
    chained = spread(steps, tops, ["c"], "w", total).where("d >= top")
    chained = chained.select(
        F.col("c").alias("node"), F.col("d").alias("depth"), F.when(F.col("d") == F.col("top"), F.col("parent")).otherwise(F.col("c")).alias("parent"),
        F.col("size").alias("members"), (F.col("d") < F.col("n")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("size") - 1) * F.col("tail")).alias("saved"), F.when(F.col("d") == F.col("n"), F.col("c")).alias("ender"),
    )
    for level in found:
        chained = chained.unionByName(level)
    ended = chained.where("ender IS NOT NULL").join(classes.select(F.col("c").alias("ender"), "ends"), "ender")
    every = ended.unionByName(chained.where("ender IS NULL").withColumn("ends", F.lit(EMPTY)))
    return every.select("node", "depth", "parent", "members", "n_children", "n_leaves", "saved", "ends").toDF("conv_id", "depth", "parent_conv_id", *OUT[3:])


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(spark, spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {"op11_conversation_trie": op11}
SQL = {
    "op11_conversation_trie": """
WITH r AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, md5(concat(CAST(length(role) AS VARCHAR), ':', role, text)) AS t, length(text) AS len,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(concat(CAST(length(role) AS VARCHAR), ':', role, text))) AS pos
  FROM r
), c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM o)
), bits AS (
  SELECT n, CASE WHEN n % 2 = 1 THEN xor(n // 2, 3988292384) ELSE n // 2 END AS v FROM range(256) t(n)
), bits2 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits
), bits3 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits2
), bits4 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits3
), bits5 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits4
), bits6 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits5
), bits7 AS (SELECT n, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END AS v FROM bits6
), tab AS (
  SELECT list(CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END ORDER BY n) AS a FROM bits7
), h AS (
  SELECT conv_id, base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda s, b: xor(s // 256, a[xor(s % 256, b) + 1])), 4294967295) % 6 AS h FROM c, tab
), b AS (
  SELECT h.conv_id, h.h, (SELECT count(*) FROM o WHERE o.conv_id = h.base AND o.pos <= h.h) AS nb, base FROM h
), m AS (
  SELECT b.conv_id, o.pos AS d, t, len FROM b JOIN o ON o.conv_id = b.base AND o.pos <= b.h
  UNION ALL SELECT b.conv_id, o.pos - b.h + b.nb, t, len FROM b JOIN o ON o.conv_id = b.conv_id AND o.pos > b.h
), p AS MATERIALIZED (
  SELECT conv_id, 0 AS d, CAST([] AS VARCHAR[]) AS path, 0 AS len FROM c
  UNION ALL SELECT conv_id, d, list(t) OVER (PARTITION BY conv_id ORDER BY d), len FROM m
), n AS (
  SELECT d, path, min(conv_id) AS node, count(*) AS n_convs, max(len) AS len FROM p GROUP BY d, path
), q AS MATERIALIZED (
  SELECT p.conv_id, p.d, n.node, n.n_convs, n.len FROM p JOIN n ON n.d = p.d AND n.path = p.path
), e AS (
  SELECT d, node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM q) WHERE d = last GROUP BY d, node
), k AS (
  SELECT DISTINCT q.d, q.node, n_convs, q.len, up.node AS parent FROM q LEFT JOIN (SELECT conv_id, d, node FROM q) up ON up.conv_id = q.conv_id AND up.d = q.d - 1
), ch AS (
  SELECT d - 1 AS d, parent AS node, count(*) AS n FROM k WHERE parent IS NOT NULL GROUP BY ALL
), under AS (
  SELECT a.d, a.node, count(*) FILTER (ch.n IS NULL) AS n_leaves, sum((k.n_convs - 1) * k.len) AS saved
  FROM k JOIN q a ON a.conv_id = k.node AND a.d <= k.d LEFT JOIN ch ON ch.d = k.d AND ch.node = k.node GROUP BY ALL
)
SELECT k.node AS conv_id, CAST(k.d AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, coalesce(ch.n, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM k LEFT JOIN ch USING (d, node) LEFT JOIN e USING (d, node) JOIN under USING (d, node)
"""
}
