"""Exact nearest neighbours within a block by a clustered index that is searched with bounds.

Unit vectors are assigned to the nearest of a few centroids; the vectors of one block and centroid are
a cell, with the smallest and the largest angle to the centroid. By the triangle inequality on the
sphere no vector of a cell is nearer to a query than the query's angle to the centroid lies outside
that range. A query first visits the cells of best bound that hold k vectors, and then only those
whose bound can still reach the k-th best it found, or the gate. So the result is that of comparing
everything, while most pairs are never formed; `work` tells how many were.

Cells lie in parts of about `size` vectors. A query goes to a part once, with the list of the cells
that it visits there; these are scored by matrix products, so a task holds two parts, however large a
block or a cell is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vectors
from ..sources.scratch import written

SLACK = 1e-7


@dataclass
class Index:
    """centroids: one unit vector a row. vectors: block, cell, pos_id, v of every vector. cells:
    block, cell, n, the range of angles low to high, and that of lengths short to long."""

    centroids: np.ndarray
    vectors: DataFrame
    cells: DataFrame
    block: str


def unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def angles(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(x) @ centroids.T, -1, 1))


def fit(df: DataFrame, most: int, sample: int, rounds: int = 5) -> np.ndarray:
    """At most `most` centroids, by k-means on the sphere over a sample of `sample` vectors: those
    with the smallest hash of their ids. All vectors are indexed; the sample only places centroids."""
    finite = df.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = finite.select("pos_id", "v").orderBy(F.xxhash64("pos_id"), "pos_id").limit(sample).select("v").collect()
    if not rows:
        return np.zeros((0, 1))
    x = unit(np.array([r["v"] for r in rows], np.float64))
    del rows
    c = x[:: max(1, -(-len(x) // most))][:most].copy()
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, unit(sums), c)
    return c


def build(pos: DataFrame, block: str, most: int = 256, sample: int = 16_384) -> Index:
    """An index of all vectors v of pos that are not null, under their block and pos_id."""
    full = pos.where(f"v IS NOT NULL AND `{block}` IS NOT NULL").select(F.col(block), "pos_id", "v")
    centroids = fit(full, most, sample)

    def assign(batches: Iterator):
        for p in batches:
            x = np.array(p["v"].tolist(), np.float64).reshape(len(p), -1)
            a = angles(x, centroids) if len(p) else np.zeros((0, 1))
            p["cell"] = np.argmin(a, axis=1).astype(np.int32) if len(p) else np.zeros(0, np.int32)
            p["angle"], p["length"] = a[np.arange(len(p)), p["cell"]], vectors.lengths(x)
            yield p

    kinds = dict(full.dtypes)
    schema = f"`{block}` {kinds[block]}, pos_id {kinds['pos_id']}, v {kinds['v']}, cell int, angle double, length double"
    rows = written(full.mapInPandas(assign, schema), "index")
    # what is not finite is null or NaN here, and its cell is always visited
    least = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.min(c))
    most_ = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.max(c))
    cells = rows.groupBy(block, "cell").agg(F.count(F.lit(1)).alias("n"), least("angle").alias("low"), most_("angle").alias("high"), least("length").alias("short"), most_("length").alias("long"))
    return Index(centroids, rows.drop("angle", "length"), written(cells, "cells"), block)


def parts_of(index: Index, size: int) -> DataFrame:
    """The cells with their part: cells in a row that hold about `size` vectors. A larger cell is a part of
    its own, in `cuts` pieces."""
    before = Window.partitionBy(index.block).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    at = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / size).cast("int")
    alone = F.col("n") > size
    return index.cells.withColumn("part", F.when(alone, -1 - F.col("cell")).otherwise(at)).withColumn("cuts", F.ceil(F.col("n") / size).cast("int"))


def visits(leads: DataFrame, index: Index, cells: DataFrame, k: int, gate: float, size: int) -> DataFrame:
    """block, part, lead_id, v, first, cells, ns and bounds: for each lead and part, the cells there that can
    pass the gate, how many vectors each has, and the best score it can give. first: whether the cells
    are among those that together hold k vectors, best bounds first."""
    block, centroids = index.block, index.centroids
    full = leads.where("v IS NOT NULL").select(F.col(block), "lead_id", "v")
    cuts = full.groupBy(block).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("n_l"))
    own = full.join(cuts, block).select(F.col(block), F.pmod(F.xxhash64("lead_id"), F.col("n_l")).cast("int").alias("i"), "lead_id", "v")
    known = cells.join(cuts, block).select(F.col(block).alias("b"), F.explode(F.sequence(F.lit(0), F.col("n_l") - 1)).alias("b_i"), "cell", "part", "n", "low", "high", "short", "long")

    def bounds(key, p, c):
        import pandas as pd

        out = {name: [] for name in (block, "part", "lead_id", "v", "first", "cells", "ns", "bounds")}
        if len(p) and len(c):
            c = c.sort_values("part", kind="stable")
            ids, part, count, low, high, short, long = (c[n].to_numpy() for n in ("cell", "part", "n", "low", "high", "short", "long"))
            leads, given = p["lead_id"].to_numpy(), p["v"].to_numpy()
            x = vectors.matrix(p["v"])
            t, norm = angles(x, centroids)[:, ids], vectors.lengths(x)[:, None]
            near = np.cos(np.maximum(np.maximum(low - t, t - high), 0))
            # a little more than the rounding of angles
            b = np.where(near >= 0, near * long, near * short) * norm * 100 + SLACK * np.maximum(1, norm * long)
            b = np.where(np.isnan(b), np.inf, b)
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[starts[1:], len(part)]
            for i in range(len(p)):
                order = np.argsort(-b[i], kind="stable")
                early = np.zeros(len(ids), bool)
                early[order] = np.r_[0, np.cumsum(count[order])[:-1]] < k
                for some, is_first in ((early, True), (~early, False)):
                    some = some & (b[i] >= gate)
                    for s, e in zip(starts, ends):
                        if (at := s + np.flatnonzero(some[s:e])).size:
                            for name, value in zip(out, (key[0], part[s], leads[i], given[i], is_first, ids[at], count[at], b[i, at])):
                                out[name].append(value)
        return pd.DataFrame(out) if out["v"] else pd.DataFrame(out, dtype=object)

    kinds = dict(full.dtypes)
    schema = f"`{block}` {kinds[block]}, part int, lead_id {kinds['lead_id']}, v {kinds['v']}, first boolean, cells array<int>, ns array<long>, bounds array<double>"
    return own.groupBy(block, "i").cogroup(known.groupBy("b", "b_i")).applyInPandas(bounds, schema)


def scored(left: DataFrame, index: Index, cells: DataFrame, k: int, gate: float, distinct_ids: bool = False, size: int = 4096) -> DataFrame:
    """block, lead_id, pos_id and raw (cosine times 100): for each lead_id of left its k best of the cells it
    lists, with raw at or above the gate; ties go to the smaller pos_id. Each pair of parts of about
    `size` vectors gives its own best."""
    block = index.block
    right = index.vectors.join(cells.select(block, "cell", "part", "cuts"), [block, "cell"]).withColumn("cut", F.when(F.col("part") < 0, F.pmod(F.xxhash64("pos_id"), F.col("cuts"))).otherwise(0).cast("int"))
    pieces = cells.groupBy(block, "part").agg(F.max(F.when(F.col("part") < 0, F.col("cuts")).otherwise(1)).alias("cuts"))
    counts = left.groupBy(block, "part").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("n_l")).join(pieces, [block, "part"])
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = left.join(counts, [block, "part"]).select(block, "part", F.pmod(F.xxhash64("lead_id"), F.col("n_l")).cast("int").alias("i"), spread("cuts").alias("cut"), "lead_id", "v", "cells")
    b = right.join(counts.select(block, "part", "n_l"), [block, "part"]).select(F.col(block).alias("b"), F.col("part").alias("b_part"), spread("n_l").alias("b_i"), F.col("cut").alias("b_cut"), "pos_id", F.col("v").alias("w"), "cell")

    def best(key, a, b):
        import pandas as pd

        none = pd.DataFrame({c: [] for c in [block, "lead_id", "pos_id", "raw"]})
        if not len(a) or not len(b):
            return none
        b = b.sort_values("pos_id")
        x, y, leads, ids = vectors.matrix(a["v"]), vectors.matrix(b["w"]), a["lead_id"].to_numpy(), b["pos_id"].to_numpy()
        places = {c: np.flatnonzero(b["cell"].to_numpy() == c) for c in np.unique(b["cell"].to_numpy())}
        listed = [np.array(c) for c in a["cells"]]

        def seen(own):
            s = np.full((len(x[own]), len(y)), -np.inf)
            flat = np.concatenate(listed[own])
            row = np.repeat(np.arange(len(s)), [len(c) for c in listed[own]])
            for c, at in places.items():
                if (rows := row[flat == c]).size:
                    s[np.ix_(rows, at)] = x[own][rows] @ y[at].T * 100
            return s

        out = [none]
        for i, j, raw in vectors.best_products(x, y, leads, ids, k, gate, distinct_ids, seen):
            out.append(pd.DataFrame({block: [key[0]] * len(i), "lead_id": leads[i], "pos_id": ids[j], "raw": raw}))
        return pd.concat(out[1:], ignore_index=True)

    kinds = dict(left.dtypes) | {"pos_id": dict(right.dtypes)["pos_id"]}
    schema = f"`{block}` {kinds[block]}, lead_id {kinds['lead_id']}, pos_id {kinds['pos_id']}, raw double"
    found = a.groupBy(block, "part", "i", "cut").cogroup(b.groupBy("b", "b_part", "b_i", "b_cut")).applyInPandas(best, schema)
    return found.withColumn("raw", F.coalesce("raw", F.lit(float("nan"))))  # pandas gives NaN back as null


@dataclass
class Search:
    """found: block, lead_id, pos_id, raw and rank. visits: for each lead and part, in n, the pairs that were scored."""

    found: DataFrame
    visits: DataFrame


def search(leads: DataFrame, index: Index, k: int, gate: float, distinct_ids: bool = False, size: int = 4096) -> Search:
    """The k nearest vectors of each lead_id in its block with a score of at least the gate; ties go to
    the smaller pos_id. Null vectors and blocks find nothing. lead_id is one row for each block."""
    block, need = index.block, k + 1 if distinct_ids else k
    cells = written(parts_of(index, size), "parts")
    every = written(visits(leads, index, cells, need, gate, size), "visits")
    first = written(scored(every.where("first"), index, cells, k, gate, distinct_ids, size), "near")
    ranked = Window.partitionBy(block, "lead_id").orderBy(F.desc("raw"), "pos_id")
    reach = first.withColumn("r", F.row_number().over(ranked)).where(F.col("r") == k).select(block, "lead_id", F.col("raw").alias("reach"))
    # only cells that can give what is as good as the k-th
    kept = F.filter(F.arrays_zip("cells", "ns", "bounds"), lambda c: F.col("reach").isNull() | (c["bounds"] >= F.col("reach")) | (c["bounds"] == float("inf")))  # reach may be NaN
    more = every.where("NOT first").join(reach, [block, "lead_id"], "left").withColumn("z", kept).where(F.size("z") > 0)
    more = written(more.select(block, "part", "lead_id", "v", F.col("z.cells").alias("cells"), F.col("z.ns").alias("ns")), "visits")
    both = first.unionByName(scored(more, index, cells, k, gate, distinct_ids, size))
    found = both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    n = lambda df: df.select(block, "lead_id", F.aggregate("ns", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    return Search(found, n(every.where("first")).unionByName(n(more)))


def nearest(leads: DataFrame, pos: DataFrame, block: str, k: int, gate: float, distinct_ids: bool = False, most: int = 256) -> DataFrame:
    """block, lead_id, pos_id, raw and rank, as by comparing every pair of a block."""
    return search(leads, build(pos, block, most), k, gate, distinct_ids).found


def work(found: Search, leads: DataFrame, pos: DataFrame, block: str) -> DataFrame:
    """block, pairs (of leads and transactions that have vectors), scored and pruned, for each block with pairs."""
    n = lambda df, name: df.where("v IS NOT NULL").groupBy(block).agg(F.count(F.lit(1)).alias(name))
    done = found.visits.groupBy(block).agg(F.sum("n").alias("scored"))
    out = n(leads, "l").join(n(pos, "p"), block).join(done, block, "left")
    pairs, scored = F.col("l") * F.col("p"), F.coalesce("scored", F.lit(0))
    return out.select(block, pairs.alias("pairs"), scored.alias("scored"), (pairs - scored).alias("pruned"))
