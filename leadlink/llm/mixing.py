"""Mixing sources to target weights by fitting subset sums.

Every source takes each of its documents floor(target / size of the source) times. What is left
of its budget is met by taking some documents once more: documents are counted by exact length;
each length first gives its proportional share, rounded down; the longest lengths then give
documents as far as shorter ones can still fill the rest, and a bounded knapsack, by dynamic
programming over lengths and counts, finds the largest sum that does not go over what is left.
The plan says how many documents of each length to take; which ones follows from their rank by a
seeded hash. A source enters the planner as its table of lengths, never as documents.
"""

from __future__ import annotations

from math import gcd

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, Scratch, ranks

WEIGHTS = (5, 2, 1)
MOST = 3
#: Knapsacks are exact for budgets of up to WORDS words, or up to FEW documents.
WORDS, FEW = 1 << 22, 20
#: Beyond that: units of a budget, units over it that are looked at, longest documents and lengths of the last step.
GRID, OVER, DEEP, KINDS = 1 << 20, 64, 32, 1024
#: Rows of a source and size that are broadcast, of some 60 bytes each.
SIZES = 200_000


def dense(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """How many to take of each (length, count) for the largest sum up to budget, in memory of 5
    bytes for each word of the budget. Counts are split into powers of two; for each sum, the step
    at which it is first reached is kept, which is enough to go back, as what it was reached from
    was reached before."""
    goal, reach, first, steps = largest(items, budget), np.zeros(budget + 1, bool), np.zeros(budget + 1, np.int32), []
    reach[0] = True
    for length, count in items:
        count, part = min(count, budget // length), 1
        while count and not reach[goal]:
            part = min(part, count)
            w = length * part
            steps.append((length, part))
            new = np.flatnonzero(reach[:-w] & ~reach[w:]) + w
            reach[new], first[new] = True, len(steps)
            count, part = count - part, part * 2
    return back(int(np.flatnonzero(reach)[-1]), first, steps)


def sparse(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """As dense(), for any budget, in memory of 12 bytes for each sum that can be reached."""
    sums, first, steps = np.zeros(1, np.int64), np.zeros(1, np.int32), []
    for length, count in items:
        count, part = min(count, budget // length), 1
        while count:
            part = min(part, count)
            steps.append((length, part))
            more = sums[sums <= budget - length * part] + length * part
            more = more[~np.isin(more, sums, assume_unique=True)]
            sums, first = np.concatenate([sums, more]), np.concatenate([first, np.full(len(more), len(steps), np.int32)])
            count, part = count - part, part * 2
    return back(int(sums.max()), dict(zip(sums.tolist(), first.tolist())), steps)


def back(at: int, first, steps: list[tuple[int, int]], unit: int = 1) -> dict[int, int]:
    """What the sum `at` is made of, in units; first: for each sum, the step that reached it."""
    taken: dict[int, int] = {}
    while at:
        length, part = steps[int(first[at]) - 1]
        taken[length] = taken.get(length, 0) + part
        at -= units(length * part, unit)
    return taken


def units(words: int, unit: int) -> int:
    return max(1, (words + unit // 2) // unit)


def rounded(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """A sum near budget, never over it, for any budget: dynamic programming over sums in units of
    budget / GRID words, to which lengths are rounded; of the last sums that are reached, up to some over
    the budget, the one counts whose documents fit it best by their exact lengths."""
    unit = max(1, budget // GRID)
    top = budget // unit + OVER
    reach, first, steps = np.zeros(top + 1, bool), np.zeros(top + 1, np.int32), []
    reach[0] = True
    for length, count in items:
        count, part = min(count, budget // length), 1
        while count:
            part = min(part, count)
            steps.append((length, part))
            w = units(length * part, unit)
            new = np.flatnonzero(reach[:-w] & ~reach[w:]) + w
            reach[new], first[new] = True, len(steps)
            count, part = count - part, part * 2
    ends = (back(int(at), first, steps, unit) for at in np.flatnonzero(reach)[-4 * OVER :])
    return max((t for t in ends if weight(t) <= budget), key=weight, default={})


def tail(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """For budgets over WORDS words: longest documents first, until DEEP of the longest would fill the
    rest; that is met by rounded sums of documents of up to KINDS lengths, evenly chosen among those that
    are left, and what then is open by an exact knapsack."""
    items = sorted(((n, c) for n, c in items if c and 0 < n <= budget), reverse=True)
    taken: dict[int, int] = {}
    left, keep = budget, DEEP * max((n for n, _ in items), default=0)
    for n, c in items:
        if k := min(c, max(0, left - keep) // n):
            taken[n] = k
            left -= k * n
    rest = [(n, c - taken.get(n, 0)) for n, c in items]
    rest = [(n, c) for n, c in rest if c and n <= left]
    some = [rest[i * len(rest) // KINDS] for i in range(KINDS)] if len(rest) > KINDS else rest
    taken = added(taken, rounded(some, left))
    open_ = [(n, c - taken.get(n, 0)) for n, c in items]
    return added(taken, knapsack(open_, budget - weight(taken)) or {})


def added(a: dict[int, int], b: dict[int, int]) -> dict[int, int]:
    return {n: a.get(n, 0) + b.get(n, 0) for n in {**a, **b}}


def largest(items: list[tuple[int, int]], budget: int) -> int:
    """No sum up to budget is above this: the multiple of what all lengths are multiples of."""
    return budget - budget % (gcd(*(n for n, _ in items)) or 1)


def knapsack(items: list[tuple[int, int]], budget: int) -> dict[int, int] | None:
    """The largest sum up to budget, or None where neither way is at hand: budgets over WORDS words
    with over FEW documents to choose from."""
    items = sorted(((n, c) for n, c in items if c and 0 < n <= budget), reverse=True)
    if sum(n * c for n, c in items) <= budget:
        return dict(items)
    if sum(min(c, budget // n) for n, c in items) <= FEW:
        return sparse(items, budget)
    return dense(items, budget) if budget <= WORDS else None


def filled(rest: dict[int, int], left: int, reach: int) -> dict[int, int]:
    """Takes the longest documents first, but leaves half of `reach` to shorter ones, as far as there
    are any, for the knapsack to fill."""
    taken: dict[int, int] = {}
    shorter = sum(n * c for n, c in rest.items())
    for n in sorted(rest, reverse=True):
        shorter -= n * rest[n]
        if left <= reach:
            break
        k = min(rest[n], max(0, left - min(reach // 2, shorter)) // n)
        if k:
            taken[n] = k
            left -= k * n
    open_ = [(n, c - taken.get(n, 0)) for n, c in rest.items()]
    last = knapsack(open_, left)
    if last is None:  # over WORDS are left: at most one document of those that remain has room
        n = max((n for n, c in open_ if c and n <= left), default=0)
        last = {n: 1} if n else {}
    for n, k in last.items():
        taken[n] = taken.get(n, 0) + k
    return taken


def fit(lengths: list[tuple[int, int]], budget: int, total: int) -> dict[int, int]:
    """How many documents to take of each length, from (length, count) with their total size, for
    a sum that comes near budget, which is under total, and never goes over.

    Each length gives its proportional share first. Where the rest cannot be met to the word, it is
    tried with a larger knapsack, and then without the shares; the best counts. The sum is the
    largest of all for budgets up to WORDS words, and for up to FEW documents; beyond, it is met by
    rounded lengths first."""
    items = [(n, c) for n, c in lengths if n and c]
    if not items or budget <= 0:
        return {}
    goal, best = largest(items, budget), {}
    share = {n: c * budget // total for n, c in items}
    rest = {n: c - share[n] for n, c in items}
    left = budget - sum(n * k for n, k in share.items())
    for reach in (1 << 16, WORDS):
        more = filled(rest, left, reach)
        found = {n: share[n] + more.get(n, 0) for n, _ in items}
        best = max(best, found, key=weight)
        if weight(best) == goal:
            return best
    whole = knapsack(items, budget)
    return max(best, tail(items, budget) if whole is None else whole, key=weight)


def nearest(lengths: list[tuple[int, int]], budget: int, total: int) -> dict[int, int]:
    """As fit(); but where that leaves over a thousandth of the budget open, and leaving out what fits
    best into total - budget goes over it by less, that."""
    under = fit(lengths, budget, total)
    short = budget - weight(under)
    if short * 1000 <= budget:
        return under
    out = fit(lengths, total - budget, total)
    over = {n: c - out.get(n, 0) for n, c in lengths}
    return over if weight(over) - budget < short else under


def weight(taken: dict[int, int]) -> int:
    return sum(n * k for n, k in taken.items())


def targets(scratch: Scratch, totals: DataFrame) -> DataFrame:
    """source, source_size -> and target. Sources in the order of their code points, null last,
    weigh 5, 2, 1 and so on. Targets share the sum of all sizes by weight, up to MOST times the
    source's size; what is above is shared among the others, until none is above. Sources are
    numbered in ranges, and each round of sharing is one sum over them; no task holds them all."""
    parts = totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = scratch.table(parts, "parts")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("c"))  # a row for each range
    ahead = F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    i = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("ahead")
    w = parts.join(F.broadcast(counts.select("part", ahead.alias("ahead"))), "part").withColumn("i", i)
    w = w.withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("i") % len(WEIGHTS) + 1).cast("int")))
    w = scratch.table(w.select("source", "source_size", "w", (F.col("source_size") * MOST).alias("limit")), "weights")
    number = lambda x: F.lit(x).cast("decimal(38,0)")
    total = w.agg(F.sum("source_size")).first()[0] or 0
    share, open_, last = F.lit(0.0), F.lit(True), None
    while True:
        s = w.agg(F.sum(F.when(open_, F.col("w"))), F.sum(F.when(~open_, F.col("limit")))).first()
        if s == last or not s[0]:
            break
        last = s
        left = total - (s[1] or 0)
        share = F.lit(float(left)) / s[0]
        open_ = F.col("limit").cast("decimal(20,0)") * number(s[0]) >= F.col("w") * number(left)
    return w.select("source", "source_size", F.when(open_, share * F.col("w")).otherwise(F.col("limit").cast("double")).alias("target"))


def sized(docs: DataFrame, seed: int, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> list[Column]:
    """source, size and the seeded hash of a row."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return [F.col(source).alias("source"), size.alias("size"), F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h")]


def shares(scratch: Scratch, own: DataFrame) -> DataFrame:
    """source, size, source_size, target, base (times that each document of that size is taken) and
    more (how many of them are taken once more)."""
    lengths = scratch.table(own.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    goal = scratch.table(targets(scratch, lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "targets")

    def plan(key, p):
        import pandas as pd

        total, target = int(p["source_size"].iloc[0]), float(p["target"].iloc[0])
        rows = list(zip(p["size"].tolist(), p["n"].tolist()))
        base = min(MOST, int(target // total)) if total else 0
        left = round(target) - base * total
        more = nearest(rows, left, total) if base < MOST and left > 0 else {}
        return pd.DataFrame({"source": p["source"], "size": p["size"], "source_size": total, "target": target, "base": base, "more": [more.get(n, 0) for n, _ in rows]})

    joined = lengths.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return scratch.table(joined.groupBy("source").applyInPandas(plan, "source string, size long, source_size long, target double, base int, more long"), "plan")


def mix(spark: SparkSession, docs: DataFrame, seed: int = 42, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of docs.

    taken is a multiple of size, up to 3 times. Null and blank texts have size 0 and are taken 0
    words. Null sources are one source, the last. Equal rows are rows of their own: the same
    number of them is taken in every run. An empty table gives an empty result. Other columns are
    ignored, whatever they are named."""
    scratch = Scratch(spark, "mixing")
    own = scratch.table(docs.select(F.col(doc_id).alias("doc_id"), *sized(docs, seed, doc_id, text, source)), "sizes")
    found = ranks(own, ["source", "size"], ["h"], "r", also=shares(scratch, own))
    return found.select("doc_id", "size", "source_size", "target", F.expr("size * (base + CAST(r < more AS INT))").alias("taken"))


def mixed(spark: SparkSession, docs: DataFrame, seed: int = 42) -> DataFrame:
    """The mix itself: each row of docs, as it is, as many times as mix() takes it. Rows without
    a word are taken no time, as they bring no words.

    Only sources, sizes and hashes are ranked. Each source and size has one row that says up to which
    hash its documents are taken once more, so that texts are not shuffled (unless there are over
    SIZES such rows, which are then not broadcast). Rows of that very hash have equal doc_id and text;
    where only some of them are taken, they are told apart by their rank among themselves."""
    scratch = Scratch(spark, "mixed")
    own = scratch.table(docs.select(*sized(docs, seed)), "sizes")
    total = own.count()
    buckets = max(256, total // 10_000)
    plan = shares(scratch, own)
    ranked = scratch.table(ranks(own.where("size > 0"), ["source", "size"], ["h"], "r", buckets, plan).select("source", "size", "h", "more", "r"), "ranked")
    last = ranked.where("r = more - 1").select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("h").alias("top"))
    ties = ranked.join(last, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("h") == F.col("top")))
    ties = ties.groupBy("s", "z", "top").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("r") < F.col("more")).alias("k"))
    limits = plan.where("size > 0").select(F.col("source").alias("source_"), F.col("size").alias("size_"), "base")
    limits = limits.join(ties, F.col("source_").eqNullSafe(F.col("s")) & (F.col("size_") == F.col("z")), "left").drop("s", "z")
    limits = scratch.table(limits, "limits")
    few = limits.count() <= SIZES
    cut = docs.select(F.struct("*").alias("row"), *sized(docs, seed))
    cut = cut.join(F.broadcast(limits) if few else limits, F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_")))
    bucket = lambda h: F.pmod(F.xxhash64(F.lit("r"), h), F.lit(buckets))  # noqa: E731  as ranks() has it
    place, end = F.struct(bucket(F.col("h")).alias("b"), F.col("h").alias("h")), F.struct(bucket(F.col("top")).alias("b"), F.col("top").alias("h"))
    once = F.when(F.col("top").isNull() | (place > end), 0).when((place < end) | (F.col("k") == F.col("n")), 1)
    cut = cut.select("row", "source", "size", "base", "k", once.alias("once"))
    repeated = lambda df: df.select("row", F.explode(F.expr("array_repeat(0, base + once)"))).select("row.*")
    if not limits.where("k < n").limit(1).count():
        return repeated(cut)
    open_ = scratch.table(cut.where("once IS NULL").withColumn("id", F.monotonically_increasing_id()), "ties")
    told = ranks(open_, ["source", "size"], ["id"], "r").withColumn("once", (F.col("r") < F.col("k")).cast("int"))
    return repeated(cut.where("once IS NOT NULL")).union(repeated(told))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op8_mixing": op8}
SQL: dict[str, str] = {}
