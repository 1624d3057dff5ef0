"""Near duplicates among vectors by a subspace pigeonhole join.

Unit vectors with cosine >= c have a squared distance of at most 2 - 2c. A fixed rotation spreads
that distance over all coordinates; the coordinates are split into blocks of equal width. In at
least one block a pair has no more than that block's proportional share of the squared distance,
so joining each block by that range, and uniting the blocks, misses no pair. Within a block the
range join deals vectors to the cells of a grid over its first coordinates, as wide as the range
on either side; a vector goes to the cell it lies in and as a visitor to those that its range
reaches. The number of gridded coordinates follows the number of vectors of a label, and cells
with many vectors are salted, so that a task holds `cell` vectors of a group at a time.

What is dealt out are ids with the coordinates of one block. A first pass finds, group by group, the
vectors that have any other within range in the block; only these fetch their whole vectors, for
the groups where they have one. The second pass verifies candidates by the exact cosine in double
precision. A pair counts only in the first block whose share it keeps, so numbers of links add up
without listing the pairs; for components, a group gives a spanning forest of its links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, forest, spread


def rotation(dim: int, seed: int = 42) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, width: int) -> list[slice]:
    return [slice(a, min(a + width, dim)) for a in range(0, dim, width)]


def budgets(dim: int, width: int, cosine: float) -> np.ndarray:
    """The share of the squared distance that each block has; a little is added for rounding."""
    return np.array([(2 - 2 * cosine) * (b.stop - b.start) / dim for b in blocks_of(dim, width)]) + 1e-5


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


_turned: dict[tuple[int, int], np.ndarray] = {}


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    """Rotated unit vectors. Sums run coordinate by coordinate, so a vector's result does not depend
    on those beside it, and every task has the same."""
    dim = x.shape[1]
    if (dim, seed) not in _turned:
        _turned[dim, seed] = rotation(dim, seed)
    u, out = unit(x), np.zeros_like(x)
    for i in range(dim):
        out += u[:, i : i + 1] * _turned[dim, seed][i]
    return out.astype(np.float32)


def dealer(cosine: float, width: int, seed: int, count: bool):
    """A row for each cell that a vector lies in or reaches, with its rotated coordinates of the
    block; or only the number of vectors of a batch that lie in each cell."""

    def deal(batches):
        import pandas as pd

        for p in batches:
            for (dim, grid), q in p.groupby([p["embedding"].map(len), "grid"]):
                y = rotated(np.array(q["embedding"].tolist(), np.float64).reshape(len(q), dim), seed)
                label, ids, h = q["label"].to_numpy(), q["id"].to_numpy(), q["h1"].to_numpy()
                for b, (part, most) in enumerate(zip(blocks_of(dim, width), budgets(dim, width, cosine))):
                    own = np.ascontiguousarray(y[:, part])
                    wide = 2 * np.sqrt(most)
                    at = own.astype(np.float64)[:, : int(grid)] / wide
                    home = np.floor(at).astype(np.int64)
                    if count:
                        yield pd.DataFrame({"label": label, "dim": dim, "block": b, "cell": names(home)}).groupby(["label", "dim", "block", "cell"]).size().reset_index(name="c")
                        continue
                    low, data = at - home, [x.tobytes() for x in own]
                    side, gap = np.where(low < 0.5, -1, 1), (np.minimum(low, 1 - low) * wide) ** 2
                    for moved in range(1 << at.shape[1]):
                        step = (moved >> np.arange(at.shape[1])) & 1
                        reach = np.flatnonzero((gap * step).sum(1) <= most)
                        yield pd.DataFrame({"label": label[reach], "dim": dim, "block": b, "cell": names((home + side * step)[reach]), "home": moved == 0, "id": ids[reach], "h": h[reach], "data": [data[i] for i in reach.tolist()]})

    def names(cells):
        return [",".join(map(str, c)) for c in cells.tolist()]

    return deal


GROUP = ["label", "dim", "block", "cell", "salt"]


def grouped(load, within, across):
    """Over rows sorted by group and home first: within(key, own) for the home rows of a group that
    has no others, across(key, own, others) for home rows and each batch of others, both loaded;
    last, within(key, own, True) for home rows that others follow."""

    def run(batches):
        key, home, done = None, [], None

        def close():
            if done is None and sum(map(len, home)) > 1:
                yield from within(key, load(home, key))

        for p in batches:
            new = (p[GROUP] != p[GROUP].shift()).any(axis=1).to_numpy()
            new[:1] = True
            starts = np.flatnonzero(new)
            for s, e in zip(starts, [*starts[1:], len(p)]):
                q = p.iloc[s:e]
                now = tuple(q[GROUP].iloc[0])
                if now != key:
                    yield from close()
                    key, home, done = now, [], None
                inside = q["home"].to_numpy()
                if inside.any():
                    home.append(q[inside])
                if not inside.all():
                    if done is None:
                        done = load(home, key) if home else ()
                        if sum(map(len, home)) > 1:
                            yield from within(key, done)
                        home = []
                    if done:
                        yield from across(key, done, load([q[~inside]], key))
        yield from close()

    return run


def near(left: np.ndarray, right: np.ndarray, most: float):
    """(i, j) of all rows of left and right within a squared distance of `most`, by 512 rows of left.
    A fast look with some slack comes first, then the differences themselves."""
    squares = (right * right).sum(1)
    for at in range(0, len(left), 512):
        part = left[at : at + 512]
        i, j = np.nonzero((part * part).sum(1)[:, None] + squares - 2 * (part @ right.T) <= most + 1e-4)
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)] + at, j[cut : cut + (1 << 16)]
            keep = ((left[a] - right[b]) ** 2).sum(1, dtype=np.float64) <= most
            yield a[keep], b[keep]


def marker(cosine: float, width: int):
    """The rows (group, home, id, h) of vectors that have any other within range in their group's block."""

    def load(parts, key):
        ids, h = (np.concatenate([q[c].to_numpy() for q in parts]) for c in ("id", "h"))
        return ids, np.frombuffer(b"".join(x for q in parts for x in q["data"]), np.float32).reshape(len(ids), -1), h

    def rows(key, home, own, some):
        import pandas as pd

        if some.any():
            yield pd.DataFrame(dict(zip(GROUP, key)) | {"home": home, "id": own[0][some], "h": own[2][some]})

    def within(key, own):
        most, found = budgets(int(key[1]), width, cosine)[int(key[2])], np.zeros(len(own[0]), bool)
        for i, j in near(own[1], own[1], most):
            found[i[i != j]] = True
        yield from rows(key, True, own, found)

    def across(key, own, other):
        most = budgets(int(key[1]), width, cosine)[int(key[2])]
        mine, theirs = np.zeros(len(own[0]), bool), np.zeros(len(other[0]), bool)
        for i, j in near(own[1], other[1], most):
            keep = other[0][j] < own[0][i]
            mine[i[keep]], theirs[j[keep]] = True, True
        yield from rows(key, True, own, mine)
        yield from rows(key, False, other, theirs)

    return grouped(load, within, across)


def joiner(cosine: float, width: int, seed: int):
    """Over rows sorted by group and home first: (kind 0, u, v) for links and (kind 1, id, number
    of vectors linked to it). It holds the home vectors of one group and a batch of others."""

    def load(parts, key):
        ids = np.concatenate([q["id"].to_numpy() for q in parts])
        x = np.array([e for q in parts for e in q["embedding"]], np.float64).reshape(len(ids), int(key[1]))
        return ids, np.concatenate([q["n"].to_numpy() for q in parts]), rotated(x, seed), x, np.sqrt((x * x).sum(1))

    def within(key, own):
        yield from pairs(key, own, own, True)

    def across(key, own, other):
        yield from pairs(key, own, other, False)

    def pairs(key, own, other, same):
        import pandas as pd

        dim, block = int(key[1]), int(key[2])
        parts, most = blocks_of(dim, width), budgets(dim, width, cosine)
        links, other_links, edges = np.zeros(len(own[0]), np.int64), np.zeros(len(other[0]), np.int64), []
        for a, b in near(np.ascontiguousarray(own[2][:, parts[block]]), np.ascontiguousarray(other[2][:, parts[block]]), most[block]):
            keep = a < b if same else other[0][b] < own[0][a]
            a, b = a[keep], b[keep]
            gap = (own[2][a] - other[2][b]) ** 2
            earlier = np.zeros(len(a), bool)
            for s, m in zip(parts[:block], most):
                earlier |= gap[:, s].sum(1, dtype=np.float64) <= m
            a, b = a[~earlier], b[~earlier]
            close = np.einsum("ij,ij->i", own[3][a], other[3][b]) / (own[4][a] * other[4][b]) >= cosine
            a, b = a[close], b[close]
            np.add.at(links, a, other[1][b])
            np.add.at(other_links, b, own[1][a])
            if len(a):
                edges.append(forest(own[0][a], other[0][b]))
        for ids, count in ((own[0], links), (other[0], other_links)):
            some = np.flatnonzero(count)
            if len(some):
                yield pd.DataFrame({"kind": np.int32(1), "u": ids[some], "v": count[some]})
        if edges:
            u, v = forest(*(np.concatenate(x) for x in zip(*edges)))
            yield pd.DataFrame({"kind": np.int32(0), "u": u, "v": v})

    return grouped(load, within, across)


def near_vectors(spark: SparkSession, vectors: DataFrame, cosine: float = 0.93, width: int = 16, cell: int = 4096, seed: int = 42) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors.

    Vectors of equal, not null label and equal length are linked if their cosine, in double
    precision, is at least `cosine`. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with null label or vec_id, are linked with nothing.
    component_id is the smallest vec_id that links reach (for a null vec_id null, and kept is
    true). Equal vectors of a label are one class: each is linked with all others of it. Rows
    that repeat a vec_id count as rows, and are linked only as their vectors are. An empty table gives an
    empty result. Other columns are ignored, whatever they are named."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    scratch = Scratch(spark, "vectors")
    e = F.col("e")
    sound = ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(e, lambda v: v != 0)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    own = own.withColumn("ok", F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    own = own.select("vec_id", "label", "ok", F.when(F.col("ok"), F.xxhash64("e")).alias("h1"), F.when(F.col("ok"), F.xxhash64(F.lit(7), "e")).alias("h2"), "e")
    classes = own.where("ok").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"), F.first("e").alias("embedding"))
    # a class is a node of its own, as vec_ids may repeat over classes; its number holds once it is written
    classes = scratch.table(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    # as many gridded coordinates as bring the fullest cell of spread-out vectors under `cell`
    labels = classes.groupBy(F.col("label").alias("l")).agg(F.count(F.lit(1)).alias("c"))
    grids = labels.select(F.col("l").alias("label"), "c", F.greatest(F.lit(0), F.least(F.lit(width), F.ceil(F.log(F.col("c") / cell) / float(np.log(2))))).cast("int").alias("grid"))
    rows = spread(classes, scratch.table(grids, "grids"), ["label"], "c", classes.count()).select("label", "grid", "id", "h1", "embedding")
    full = rows.mapInPandas(dealer(cosine, width, seed, True), "label long, dim int, block int, cell string, c long")
    full = full.groupBy("label", "dim", "block", "cell").agg(F.sum("c").alias("c")).where(F.col("c") > cell)
    full = scratch.table(full.withColumn("salts", F.ceil(F.col("c") / cell).cast("int")).drop("c"), "full")
    dealt = rows.mapInPandas(dealer(cosine, width, seed, False), "label long, dim int, block int, cell string, home boolean, id long, h long, data binary")
    salted = dealt.join(F.broadcast(full) if full.count() <= 10_000 else full, GROUP[:4], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    own_salt = F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")
    salted = salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).withColumn("home", F.col("home") & (F.col("salt") == own_salt)).drop("salts")
    order = [*GROUP, F.desc("home"), "id"]
    key = "label long, dim int, block int, cell string, salt int, home boolean, id long, h long"
    marked = salted.repartition(*GROUP).sortWithinPartitions(*order).mapInPandas(marker(cosine, width), key)
    # a home vector is marked once for each batch of others
    marked = scratch.table(marked.distinct(), "marked")
    fetched = marked.join(classes.select("id", F.col("h1").alias("h"), "label", "n", "embedding"), ["id", "h", "label"])
    fetched = fetched.repartition(*GROUP).sortWithinPartitions(*order)
    found = scratch.table(fetched.mapInPandas(joiner(cosine, width, seed), "kind int, u long, v long"), "found")
    counts = found.where("kind = 1").groupBy("u").agg(F.sum("v").alias("links"))
    nodes = components(scratch, found.where("kind = 0"), "u", "v").withColumnRenamed("label", "top")
    nodes = scratch.table(nodes.join(classes.select(F.col("id").alias("node"), "low"), "node"), "nodes")
    tops = nodes.groupBy("top").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("c"))
    least = spread(nodes.select("node", "top"), scratch.table(tops, "tops"), ["top"], "c", nodes.count()).select("node", "least")
    named = classes.drop("embedding").join(counts, F.col("id") == F.col("u"), "left").drop("u").join(least, F.col("id") == F.col("node"), "left")
    named = named.select("label", "h1", "h2", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "low").alias("component_id"))
    own, links = own.drop("e"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    total = classes.agg(F.sum("n")).first()[0] or 0
    linked = spread(own.where("ok"), scratch.table(named, "named"), ["label", "h1", "h2"], "n", total)
    alone = own.where("not ok").select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    found = linked.select("vec_id", "n_links", "component_id").union(alone)
    return found.select("vec_id", links, "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = {
    "op7_embedding_near_dedup": """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.93
), reach(u, v) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), low AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM e JOIN low ON low.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""
}
QUERIES = {"op7_embedding_near_dedup": op7}
