"""Sharding by longest-processing-time scheduling.

Documents with equal texts stay together. A group's load is the sum of its sizes; groups go, from
the heaviest down, each to the least loaded shard, which a heap yields. Groups of one load are
alike, so the scheduler sees loads with their number of groups, never the groups: k distinct loads
need k^2/2 bytes at least, so it reads under 1.5 x sqrt(bytes) rows. Which groups of a load go to
which shard follows from their rank among equals, found by a distributed numbering.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ranks, spread, text_key


def schedule(loads, shards: int, start=None):
    """(load, shard, low, high) for loads in descending order with their number of groups: the
    groups with rank low to high - 1 go to the shard. Ties go to the smallest shard."""
    heap = sorted((x, i) for i, x in enumerate(start or [0] * shards))
    for load, count in loads:
        taken = [0] * shards
        left = count
        if count > 4 * shards:  # all steps up to a common level at once: they come out the same in any order
            low, high = heap[0][0], max(heap)[0] + count * load
            while low < high:
                level = (low + high + 1) // 2
                low, high = (level, high) if sum(max(0, level - x) // load for x, _ in heap) <= count else (low, level - 1)
            for at, (x, i) in enumerate(heap):
                taken[i] = max(0, low - x) // load
                heap[at] = (x + taken[i] * load, i)
            heapq.heapify(heap)
            left -= sum(taken)
        for _ in range(left):
            total, i = heap[0]
            heapq.heapreplace(heap, (total + load, i))
            taken[i] += 1
        at = 0
        for i, n in enumerate(taken):
            if n:
                yield load, i, at, at + n
                at += n


def shard(spark: SparkSession, docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of docs.

    size: the text's UTF-8 bytes plus 1. Null texts count no bytes, have crc 0 and are a group of
    their own, apart from empty texts. Slots run from 0 without gaps in each shard. Null and
    repeated doc_ids are rows like any other. An empty table gives an empty result. Columns
    besides doc_id and text are ignored, whatever they are named."""
    scratch = scratch or Scratch(spark, "sharding")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    h1, h2 = text_key(F.col("t"))
    rows = own.select(
        "doc_id",
        (F.coalesce(F.octet_length("t"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(F.col("t").cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        h1.alias("h1"),
        h2.alias("h2"),
    )
    rows = scratch.table(rows, "rows")
    groups = rows.groupBy("h1", "h2", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("load", F.col("n") * F.col("size"))
    total = rows.count()
    groups = scratch.table(ranks(groups, ["load"], ["h1", "h2", "size"], "r", total=total), "groups")
    loads = groups.groupBy("load").agg(F.count(F.lit(1)).alias("n"))

    def plan(batches):
        import pandas as pd

        def pairs():
            for p in batches:
                yield from zip(p["load"].tolist(), p["n"].tolist())

        held = []
        for row in schedule(pairs(), shards):
            held.append(row)
            if len(held) == 10_000:
                yield pd.DataFrame(held, columns=["load", "shard", "low", "high"])
                held = []
        if held:
            yield pd.DataFrame(held, columns=["load", "shard", "low", "high"])

    dealt = loads.repartition(1).sortWithinPartitions(F.desc("load")).mapInPandas(plan, "load long, shard int, low long, high long")
    spans = dealt.groupBy("load").agg(F.array_sort(F.collect_list(F.struct("low", "high", "shard"))).alias("spans"), F.sum(F.col("high") - F.col("low")).alias("c"))
    where = F.filter("spans", lambda s: (s["low"] <= F.col("r")) & (F.col("r") < s["high"]))[0]["shard"]
    of = spread(groups, scratch.table(spans, "spans"), ["load"], "c", total).select("h1", "h2", "size", "n", where.alias("shard"))
    placed = scratch.table(spread(rows, scratch.table(of, "of"), ["h1", "h2", "size"], "n", total), "placed")
    return ranks(placed, ["shard"], ["doc_id", "h1", "h2"], "slot", total=total).select("doc_id", "size", "text_crc32", "shard", "slot")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op10_sharding": op10}
SQL: dict[str, str] = {}
