"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame
operations only.

A test item is in a document if the document contains at least a share t of the item's distinct
shingles of five words (runs of letters and digits, lower-cased). Items are partitioned into classes
by size, each twice as large as the one before; a document is searched only for classes that it is
long enough to contain. An item's MinHash signature is the shingles with the least value under each of
ROWS hash functions. Each is one of the item's shingles picked evenly, so the share of the signature
that occurs in a document estimates containment, however long the document is (the Jaccard
similarity of a short item and a long document is near zero, and tells nothing). A document with
LEAST of ROWS or more is a candidate: with containment 0.8, fewer come up in one case of 80 million.
What the search finds is verified by the exact shingles, as texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, text_key

WORDS = 5
SHARE = 0.8
ROWS, LEAST = 16, 3
#: Up to this many hashes of signatures are held in the plan; more are broadcast in blocks of BLOCK.
INLINE, BLOCK = 20_000, 1 << 20


def words_of(column: str) -> str:
    """SQL for the words of a text: runs of letters and digits, lower-cased."""
    return f"filter(split(lower({column}), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x <> '')"


def literal(value: int) -> str:
    return f"{value}L" if value > -(1 << 63) else "(-9223372036854775807L - 1L)"


def hashes(words: str, size: int) -> str:
    parts = ", ".join(f"{words}[p + {i}]" for i in range(size))
    return f"CASE WHEN size({words}) >= {size} THEN transform(sequence(0, size({words}) - {size}), p -> xxhash64({parts})) END"


def shingles(words: str, size: int) -> str:
    return f"CASE WHEN size({words}) >= {size} THEN array_distinct(transform(sequence(0, size({words}) - {size}), p -> array_join(slice({words}, p + 1, {size}), ' '))) END"


def pinned(df: DataFrame, name: str, value: str) -> DataFrame:
    """Adds a column that is computed once a row: as the only element of an exploded array, it is
    not copied into the filters above, where each use of it would compute it again."""
    return df.select("*", F.explode(F.array(F.expr(value))).alias(name))


def signatures(items: DataFrame, size: int, share: float, rows: int) -> DataFrame:
    """item_id, s (distinct shingles), n, need (how many a document must hold), class_need (the same
    for the smallest item of its size class) and the signature, as an array of hashes."""
    own = pinned(items.where("item_id is not null and text is not null").select("item_id", "text"), "w", words_of("text"))
    own = own.select("item_id", F.expr(shingles("w", size)).alias("s"), F.expr(f"array_distinct({hashes('w', size)})").alias("h")).where("s is not null")
    own = own.dropDuplicates(["item_id", "s"]).withColumn("n", F.size("s"))
    need = lambda n: F.ceil(n * share - 1e-9).cast("int")
    least = f"transform(sequence(1, {rows}), i -> array_min(transform(h, x -> named_struct('v', xxhash64(x, i), 'x', x))).x)"
    smallest = F.pow(F.lit(2), F.floor(F.log2("n") + 1e-9))
    return own.select("item_id", "s", "n", need(F.col("n")).alias("need"), need(smallest).alias("class_need"), F.expr(least).alias("signature"))


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WORDS, share: float = SHARE, inline: int = INLINE, rows: int = ROWS, least: int = LEAST) -> DataFrame:
    """The rows of contamination(), with the key (k1, k2) of the document's text.

    Null texts, and texts and items of fewer than `size` words, contain and are nothing; nor are
    items with a null item_id. Equal items with ids of their own are found each. Rows that repeat
    both doc_id and text give their rows once; documents with a null doc_id are found with null.
    Empty tables give an empty result. Other columns are ignored, whatever they are named."""
    scratch = Scratch(spark, "decontaminate")
    known = scratch.table(signatures(items, size, share, rows), "items")
    sought = known.select("item_id", "class_need", F.explode("signature").alias("h")).groupBy("item_id", "class_need", "h").agg(F.count(F.lit(1)).alias("weight"))
    sought = scratch.table(sought, "sought")
    values = scratch.table(sought.select("h").distinct(), "values")
    own = docs.where("text is not null").select("doc_id", "text")
    h1, h2 = text_key(F.col("text"))
    cut = pinned(own, "w", words_of("text"))
    count = values.count()
    if count <= inline:
        # the plan holds all hashes; documents without any go at once
        held = sorted(r[0] for r in values.collect())
        hit = f"array_distinct(filter({hashes('w', size)}, x -> x IN ({', '.join(map(literal, held))})))" if held else "CAST(array() AS array<bigint>)"
        hits = pinned(cut, "hits", hit).where("size(hits) > 0").select("doc_id", "text", F.size("w").alias("m"), "hits").withColumns({"k1": h1, "k2": h2})
        base = scratch.table(hits, "hits")
        found = base.select("doc_id", "k1", "k2", "m", F.explode("hits").alias("h"))
    else:
        # signatures are the stated queries: blocks of them are broadcast, and no shingle is shuffled
        base = own.withColumns({"k1": h1, "k2": h2})
        every = cut.select("doc_id", h1.alias("k1"), h2.alias("k2"), F.size("w").alias("m"), F.explode(F.expr(f"array_distinct({hashes('w', size)})")).alias("h"))
        blocks = -(-count // BLOCK)
        block = lambda i: F.broadcast(values.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == i))
        found = scratch.table(reduce(DataFrame.union, [every.join(block(i), "h", "left_semi").select("doc_id", "k1", "k2", "m", "h") for i in range(blocks)]), "found")
    pairs = found.distinct().join(sought, "h").where(F.col("m") - size + 1 >= F.col("class_need"))
    pairs = pairs.groupBy("doc_id", "k1", "k2", "item_id").agg(F.sum("weight").alias("weight")).where(F.col("weight") >= least).drop("weight")
    pairs = pairs.withColumnsRenamed({"doc_id": "d", "k1": "i", "k2": "j"})
    both = base.select("doc_id", "k1", "k2", "text").join(pairs, base["doc_id"].eqNullSafe(pairs["d"]) & (base["k1"] == pairs["i"]) & (base["k2"] == pairs["j"]))
    sizes = known.select(F.col("item_id").alias("item"), "s", "need")
    both = pinned(both.select("doc_id", "item_id", "text", "k1", "k2").join(sizes, F.col("item_id") == F.col("item")), "w", words_of("text"))
    both = pinned(both, "shared", f"size(array_intersect({shingles('w', size)}, s))")
    exact = both.select("doc_id", "k1", "k2", "item_id", F.size("s").alias("n_shingles"), F.col("shared").alias("n_shared"), "need")
    exact = exact.where("n_shared >= need")
    return exact.select("doc_id", "k1", "k2", "item_id", F.col("n_shingles").cast("long").alias("n_shingles"), F.col("n_shared").cast("long").alias("n_shared"), (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, size: int = WORDS, share: float = SHARE, inline: int = INLINE) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared and containment for every document and
    item with containment of at least `share` (see matches)."""
    return matches(spark, docs, items, size, share, inline).drop("k1", "k2").distinct()


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, as they are, in which no item was found (by doc_id, null or not, and text)."""
    bad = matches(spark, docs, items).select(F.col("doc_id").alias("b0"), F.col("k1").alias("b1"), F.col("k2").alias("b2")).distinct()
    h1, h2 = text_key(F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("k0"), h1.alias("k1"), h2.alias("k2"))
    same = F.col("k0").eqNullSafe(F.col("b0")) & (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2"))
    return rows.join(bad, same, "left_anti").select("row.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {"op4_benchmark_decontamination": op4}
SQL = {
    "op4_benchmark_decontamination": r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), ds AS (
  SELECT DISTINCT doc_id, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] || ' ' || w[p + 4] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM dw)
), bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), bs AS (
  SELECT DISTINCT item_id, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] || ' ' || w[p + 4] AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM bw)
), n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n.n AS n_shingles, count(*) AS n_shared, count(*) / n.n AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n.n HAVING count(*) >= 0.8 * n.n - 1e-9
"""
}
