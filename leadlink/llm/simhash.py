"""Near duplicates by SimHash, found by covering locality-sensitive hashing.

Every bit position gets a fixed vector of radius + 1 bits. For each of the 2^(radius+1) - 1 other
vectors, a mask keeps the positions whose inner product with it is odd. At most `radius` differing
positions never span that space, so some vector is orthogonal to all of them: under its mask the
two fingerprints are equal. Every pair within the radius therefore meets in some table, for
certain (Pagh, 2016); what meets is compared exactly.

Equal fingerprints are one node, so copies cost one row. A bucket is compared within a task only
up to `dense` fingerprints, and gives a spanning forest, never all its pairs. Larger buckets go
another exact way, linear in their size: each fingerprint is sent to every point within half the
radius of it, and those that share a point are linked to the smallest of them. Two fingerprints
that share a point are within the radius, and two within the radius share one.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb
from random import Random

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, batches_of, components, spread, text_key, tidy

BITS = 64


@lru_cache
def masks(radius: int) -> list[int]:
    """One mask for each table, as signed 64-bit integers. The vectors are those, of a few plain
    and some seeded choices, whose thinnest mask keeps the most positions, so that buckets are small
    in every table (for 4 bits 32 positions, for 6 bits 32: a Reed-Muller code)."""
    size = 2 ** (radius + 1)
    choices = [[1 + i % (size - 1) for i in range(BITS)], [size // 2 + i % (size // 2) for i in range(BITS)]]
    rng = Random(42)
    choices += [[rng.randrange(1, size) for _ in range(BITS)] for _ in range(8)]

    def kept(vectors):
        return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, size)]

    best = max(map(kept, choices), key=lambda m: min(x.bit_count() for x in m))
    return [m - (1 << 64) if m >> 63 else m for m in best]


def fingerprint(data: bytes, words: int) -> int:
    """SimHash of the shingles of a text, as an unsigned integer; bytes.lower() changes A-Z only,
    and bytes.split() splits at 0x20 and 0x09-0x0D only."""
    from xxhash import xxh64_intdigest

    parts = data.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    k = min(words, len(parts))
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lens + 1) - 1
    starts, ends = (ends - lens)[: len(parts) - k + 1], ends[k - 1 :]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        s, e = starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist()
        h = np.array([xxh64_intdigest(joined[x:y], 42) for x, y in zip(s, e)], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, out: str = "fp") -> DataFrame:
    """Adds the fingerprint, as a signed long, to every row. Null and blank texts have 0."""

    def of(series):
        import pandas as pd

        for s in series:
            yield pd.Series(np.array([0 if x is None else fingerprint(x, words) for x in s], dtype=np.uint64).view(np.int64))

    from collections.abc import Iterator

    import pandas as pd

    of.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out, F.pandas_udf(of, "long")(F.col(text).cast("binary")))


def spanning(f: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one bucket."""
    if len(f) == 2:
        return [(0, 1)] if int(f[0] ^ f[1]).bit_count() <= radius else []
    label, edges = np.arange(len(f)), []
    for i in range(1, len(f)):
        near = np.flatnonzero(np.bitwise_count(f[:i] ^ f[i]) <= radius)
        if near.size:
            found = label[near]
            low = found.min()
            edges.append((i, int(near[found.argmin()])))
            label[i] = low
            if found.max() != low:
                others, first = np.unique(found, return_index=True)
                for x, at in zip(others[1:], first[1:]):
                    edges.append((i, int(near[at])))
                    label[label == x] = low
    return edges


def linker(radius: int, dense: int):
    """Over rows sorted by table and key: (kind 0, u, v) for links; (kind 1, u, key's table) for
    each fingerprint of a bucket of over `dense`. It holds one bucket at a time, `dense` at most."""

    def link(batches):
        import pandas as pd

        held, key, over = [], None, False
        for p in batches:
            t, k, f = p["t"].to_numpy(), p["k"].to_numpy(), p["fp"].to_numpy()
            cuts = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(t)]])
            out = []
            inner = np.flatnonzero(ends - starts >= 2)
            todo = sorted({0, len(starts) - 1, *inner.tolist()}) if len(t) else []
            for g in todo:
                s, e = int(starts[g]), int(ends[g])
                now = (int(t[s]), int(k[s]))
                if now != key:
                    out += flush(held, radius)
                    held, key, over = [], now, False
                held.append(f[s:e])
                if over or sum(map(len, held)) > dense:
                    over = True
                    out += [(1, int(x), now[0]) for h in held for x in h]
                    held = []
            if out:
                yield pd.DataFrame(out, columns=["kind", "u", "v"]).astype({"kind": "int32", "u": "int64", "v": "int64"})
        if out := flush(held, radius):
            yield pd.DataFrame(out, columns=["kind", "u", "v"]).astype({"kind": "int32", "u": "int64", "v": "int64"})

    def flush(held, radius):
        if sum(map(len, held)) < 2:
            return []
        f = np.concatenate(held)
        return [(0, int(f[a]), int(f[b])) for a, b in spanning(f.view(np.uint64), radius)]

    return link


def balls(rows: DataFrame, flips: int) -> DataFrame:
    """(u, z) for every z that differs from u in up to `flips` bits; position 64 stands for no flip."""
    rows = rows.select("u", F.col("u").alias("z"), F.lit(0).alias("i"))
    for _ in range(flips):
        rows = rows.select("u", "z", F.explode(F.sequence("i", F.lit(BITS))).alias("i"))
        rows = rows.select("u", F.expr(f"CASE WHEN i < {BITS} THEN z ^ shiftleft(1L, i) ELSE z END AS z"), F.expr(f"CASE WHEN i < {BITS} THEN i + 1 ELSE i END AS i"))
    return rows.select("u", "z")


def crowd(radius: int) -> int:
    """Fingerprints of a bucket from which on the linear way, with so many points for each, is less
    work than comparing them."""
    return max(20_000, sum(comb(BITS, i) for i in range(radius // 2 + 1)))


def links(scratch: Scratch, nodes: DataFrame, radius: int = 4, dense: int | None = None) -> DataFrame:
    """(u, v): links that connect the distinct fingerprints `fp` of nodes as all links would."""
    dense = dense or crowd(radius)
    if radius % 2:
        raise ValueError("the radius must be even")
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks(radius))])
    rows = nodes.select("fp", F.explode(tables).alias("x")).select("x.t", "x.k", "fp")
    rows = rows.repartition("t", "k").sortWithinPartitions("t", "k", "fp")
    found = scratch.table(rows.mapInPandas(linker(radius, dense), "kind int, u long, v long"), "links")
    crowded = found.where("kind = 1").select("u").distinct()
    shared = balls(crowded, radius // 2)
    least = shared.groupBy("z").agg(F.min("u").alias("v"))
    return found.where("kind = 0").select("u", "v").union(shared.join(least, "z").where("u <> v").select("u", "v").distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text", dense: int | None = None) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of docs.

    Documents whose fingerprints differ in at most `radius` bits are linked; component_id is the
    smallest doc_id that links reach. Null and blank texts have fingerprint 0 and are linked like
    any other. A null doc_id is never the smallest; a component of nothing else has null. Rows
    with equal doc_id are rows of their own. An empty table gives an empty result. Columns
    besides doc_id and text are ignored, whatever they are named."""
    scratch = Scratch(spark, "simhash")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = scratch.table(fingerprints(own, words=words).drop("text"), "prints")
    nodes = scratch.table(prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")), "nodes")
    label = components(scratch, links(scratch, nodes.select("fp"), radius, dense), "u", "v")
    named = scratch.table(nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "n", "low", F.coalesce("label", "fp").alias("label")), "named")
    low = scratch.table(named.groupBy("label").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("c")), "low")
    of = scratch.table(spread(named, low, ["label"], "c", nodes.count()).select("fp", "n", "component_id"), "of")
    return spread(prints, of, ["fp"], "n", prints.count()).select("doc_id", "fp", "component_id")


# ---- similar texts: candidates that can reach a Jaccard similarity, near by fingerprint, verified ----
#: Texts differ in up to NEAR bits of a fingerprint of 128, or are not compared. At similarity 0.8
#: about 20 bits differ (deviation 4), of unrelated texts 64 (6).
NEAR = 44
#: Up to so many fingerprints of a bucket, all near pairs are listed.
SMALL = 64
#: How common shingles are is counted by the low bits of their hashes, in SLOTS places, PART of them in a row.
SLOTS, PART = 1 << 20, 4096
#: Texts go to Python workers in batches of about so many bytes.
BATCH = 8 << 20


def shingle_set(data: bytes, words: int) -> tuple[bytes, set[bytes]]:
    """A text's words joined by single spaces, and its distinct shingles (split as in fingerprint())."""
    parts = data.lower().split()
    k = min(words, len(parts))
    return b" ".join(parts), {b" ".join(parts[i : i + k]) for i in range(len(parts) - k + 1)} if k else set()


def digests(found: set[bytes]) -> np.ndarray:
    """128 bits of each shingle, as rows of two signed longs."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, found)), np.int64).reshape(-1, 2)


def long_print(h: np.ndarray) -> np.ndarray:
    """SimHash of 128 bits, as two signed longs."""
    ones = np.zeros(128, np.int64)
    for at in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[at : at + (1 << 14)].view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h)).view(np.int64)


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """For each of SLOTS places, in how many texts of docs a shingle is whose hash falls there (once for
    each such shingle). All texts count; each task adds up its own, so SLOTS numbers a task are moved."""

    def count(batches):
        import pandas as pd

        total = np.zeros(SLOTS, np.int64)
        for p in batches:
            held, size = [], 0
            for x in p["text"]:
                held.append(digests(shingle_set(x.encode("utf-8", "surrogatepass"), words)[1])[:, 0])
                size += len(held[-1])
                if size > SLOTS:
                    total += np.bincount(np.concatenate(held) & (SLOTS - 1), minlength=SLOTS)
                    held, size = [], 0
            if held:
                total += np.bincount(np.concatenate(held) & (SLOTS - 1), minlength=SLOTS)
        if total.any():
            yield pd.DataFrame({"at": np.arange(SLOTS // PART), "n": [x.tobytes() for x in total.reshape(-1, PART)]})
        tidy()

    def add(p):
        import pandas as pd

        n = sum((np.frombuffer(x, np.int64) for x in p["n"]), np.zeros(PART, np.int64))
        return pd.DataFrame({"at": p["at"][:1], "n": [n.tobytes()]})

    parts = docs.select("text").where(F.col("text").isNotNull()).mapInPandas(count, "at int, n binary")
    out = np.zeros((SLOTS // PART, PART), np.uint32)
    # one row for each PART of the places, however many texts there are
    for at, n in parts.groupBy("at").applyInPandas(add, "at int, n binary").collect():
        out[at] = np.minimum(np.frombuffer(n, np.int64), 0xFFFFFFFF)
    return out.reshape(-1)


def prefix(h: np.ndarray, share: float, counts: np.ndarray) -> np.ndarray:
    """The first n - ceil(share n) + 1 hashes of a set of n, rare ones first. Two sets of a Jaccard
    similarity of at least share have share n in common, so a hash of one's prefix is in the other's."""
    if not len(h):
        return h
    times = counts[h & (len(counts) - 1)]
    return h[np.lexsort((h, times))[: len(h) - int(np.ceil(share * len(h) - 1e-9)) + 1]]


def long_prints(docs: DataFrame, words: int, share: float) -> DataFrame:
    """doc_id, text, node (a hash of the words: texts of equal words are one), s0, s1 (fingerprint
    of distinct shingles), n (their number) and keys (by which it is looked up) of every row."""
    counts = shingle_counts(docs, words)
    tidy()

    def of(batches):
        from xxhash import xxh64_intdigest

        for p in batches:
            nodes, prints, keys, sizes = [], [], [], []
            for x in p["text"]:
                joined, found = shingle_set((x or "").encode("utf-8", "surrogatepass"), words)
                h = digests(found)
                nodes.append(xxh64_intdigest(joined, 42))
                prints.append(long_print(h))
                keys.append(prefix(h[:, 0], share, counts))
                sizes.append(len(h))
            p["node"] = np.array(nodes, np.uint64).view(np.int64)
            p["s0"], p["s1"] = np.array(prints, np.int64).reshape(-1, 2).T
            p["n"], p["keys"] = sizes, keys
            yield p
        tidy()

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInPandas(of, f"doc_id {kind}, text string, node long, s0 long, s1 long, n long, keys array<long>")


def distance(s: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(s ^ one).sum(-1, dtype=np.int32)


def from_the_middle(s: np.ndarray) -> np.ndarray:
    """Order of fingerprints by their distance from the one that has each bit as most have it. What
    others are copies of lies nearest to it."""
    bits = np.zeros(128, np.int64)
    for at in range(0, len(s), 1 << 14):
        bits += np.unpackbits(s[at : at + (1 << 14)].view(np.uint8), axis=1).sum(0, dtype=np.int64)
    return np.argsort(distance(s, np.packbits(bits * 2 > len(s)).view(np.uint64)), kind="stable")


def near_pairs(node: np.ndarray, s: np.ndarray) -> tuple[list, list, list]:
    """Of one bucket, sorted by node: first links (each member to the first it is near to), the
    other near pairs, and for a bucket of over SMALL, instead of these, a spanning forest of all its
    near pairs: pairs of members that it joins are looked for by group."""
    first, more, linked, apart = [], [], np.zeros(len(node), bool), []
    large = len(node) > SMALL
    if large:
        order = from_the_middle(s)
        node, s = node[order], s[order]
    tree = np.arange(len(node))
    for i in range(len(node)):
        near = np.flatnonzero(distance(s, s[i]) <= NEAR)
        if large:
            if (tree[near] != tree[i]).any():
                others, at = np.unique(tree[near], return_index=True)
                apart += [(int(node[i]), int(node[near[x]])) for o, x in zip(others, at) if o != tree[i]]
                tree[np.isin(tree, others)] = tree[i]
            if linked[i]:
                continue
        near = near[near != i] if large else near[near > i]
        first += [(int(node[i]), int(node[j])) for j in near[~linked[near]]]
        if not large:
            more += [(int(node[i]), int(node[j])) for j in near[linked[near]]]
        elif len(near):
            linked[i] = True
        linked[near] = True
    return first, more, apart


def buckets(columns: list[str], handle):
    """mapInPandas over rows sorted by key: handle(key, arrays of a bucket) gives lists of (kind, u, v)."""

    def run(batches):
        import pandas as pd

        def frame(out):
            return pd.DataFrame(out, columns=["kind", "u", "v"]).astype({"kind": "int32", "u": "int64", "v": "int64"})

        held, out = None, []
        for p in batches:
            if held is not None:
                p = pd.concat([held, p], ignore_index=True)
            key = p["k"].to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(key)]])
            held, starts, ends = p.iloc[int(starts[-1]) :], starts[:-1], ends[:-1]
            some = np.flatnonzero(ends - starts >= 2)
            x = [p[c].to_numpy() for c in columns]
            for a, b in zip(starts[some].tolist(), ends[some].tolist()):
                for part in handle(int(key[a]), *[c[a:b] for c in x]):
                    out += part
                    if len(out) > 10_000:
                        yield frame(out)
                        out = []
        if held is not None and len(held) > 1:
            for part in handle(int(held["k"].iloc[0]), *[held[c].to_numpy() for c in columns]):
                out += part
                if len(out) > 10_000:
                    yield frame(out)
                    out = []
        yield frame(out)

    return run


def in_bucket(key, node, s0, s1):
    s = np.stack([s0, s1], 1).view(np.uint64)
    if len(node) == 2:
        yield [(0, int(node[0]), int(node[1]))] if distance(s[1], s[0]) <= NEAR else []
    elif len(node) > SMALL or (np.bitwise_count(s[:, None] ^ s).sum(-1, dtype=np.int32) <= NEAR).sum() > len(node):
        first, more, rest = near_pairs(node, s)
        yield [(0, *x) for x in first] + [(1, *x) for x in more] + [(2, *x) for x in rest]


def hashed_sets(words: int):
    """(node, h): hashes of the distinct shingles of each text, ascending, as binary."""

    def of(batches):
        import pandas as pd

        for p in batches:
            h = [np.sort(digests(shingle_set((x or "").encode("utf-8", "surrogatepass"), words)[1])[:, 0]).tobytes() for x in p["text"]]
            yield pd.DataFrame({"node": p["node"], "h": h})
        tidy()

    return of


def texts_of(scratch: Scratch, rows: DataFrame, nodes: DataFrame, some: DataFrame, name: str) -> DataFrame:
    """(node, text): one text of each node in some. Rows of a node that many rows have are not moved."""
    of = scratch.table(nodes.select("node", "copies").join(some, "node", "left_semi"), f"{name}-nodes")
    return spread(rows.select("node", "text"), of, ["node"], "copies", rows.count()).select("node", "text").dropDuplicates(["node"])


def links_of(share: float, label: np.ndarray, mine: np.ndarray, s: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs (a, b) of sets, a in one of two blocks and b in the other (or both in one, if there is one),
    of different labels, near by fingerprint, with a Jaccard similarity of at least share; one
    pair, at least, for each two labels that have any. Sets of the most frequent label are not
    compared with each other."""
    kinds, counts = np.unique(label, return_counts=True)
    size, out = np.array([len(x) for x in sets]), []
    for i in np.flatnonzero(label != kinds[counts.argmax()]):
        own = sets[i]
        at = (distance(s, s[i]) <= NEAR) & (label != label[i]) & (size >= share * len(own)) & (len(own) >= share * size) & (size > 0)
        at = np.flatnonzero(at if mine.all() else at & (mine != mine[i]))
        for a in range(0, len(at), 4096):
            part = at[a : a + 4096]
            other = np.concatenate([sets[j] for j in part])
            hit = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
            shared = np.add.reduceat(hit, np.cumsum(size[part]) - size[part], dtype=np.int64)
            found = part[shared >= share * (size[part] + len(own) - shared) - 1e-9]
            _, one = np.unique(label[found], return_index=True)
            out += [(int(i), int(j)) for j in found[one]]
    return out


def in_groups(share: float):
    """Over rows (g, i, j, own, node, label, s0, s1, h) sorted by (g, i, j): links (u, v) between members
    of two blocks of a group. It holds two blocks at a time."""

    def run(batches):
        import pandas as pd

        held, key = [], None

        def solved():
            q = pd.concat(held, ignore_index=True)
            s = q[["s0", "s1"]].to_numpy().view(np.uint64)
            pairs = links_of(share, q["label"].to_numpy(), (q["own"] == q["i"]).to_numpy(), np.ascontiguousarray(s), [np.frombuffer(x, np.int64) for x in q["h"]])
            node = q["node"].to_numpy()
            return pd.DataFrame({"u": [node[a] for a, _ in pairs], "v": [node[b] for _, b in pairs]}, dtype="int64")

        for p in batches:
            k = list(zip(p["g"].tolist(), p["i"].tolist(), p["j"].tolist()))
            cuts = [0, *[n for n in range(1, len(k)) if k[n] != k[n - 1]], len(k)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if key is not None and k[a] != key:
                    yield solved()
                    held = []
                key = k[a]
                held.append(p.iloc[a:b])
        if held:
            yield solved()
        held = []
        tidy()

    return run


def grouped_links(scratch: Scratch, crowd: DataFrame, label: DataFrame, nodes: DataFrame, rows: DataFrame, words: int, share: float, block: int = 1_000_000) -> DataFrame:
    """(u, v): links between members of crowded buckets that are not linked yet.

    Members that near pairs of crowded buckets join are one group; a group whose members all have
    one label is done. The others are cut into blocks of about `block` shingles, and each two blocks
    of a group are compared in a task, by the hashes of all their shingles. A task gives a pair for
    two labels, never all pairs."""
    group = components(Scratch(rows.sparkSession, "similar-groups"), crowd, "u", "v").select("node", F.col("label").alias("g"))
    named = nodes.select("node", "s0", "s1", "n").join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = scratch.table(group.join(named, "node"), "members")
    open_ = own.groupBy("g").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.ceil((F.sum("n") + 1) / block).cast("int").alias("blocks"), F.count(F.lit(1)).alias("c"))
    open_ = scratch.table(open_.where("a <> b").drop("a", "b"), "open")
    own = scratch.table(spread(own, open_, ["g"], "c", own.count()), "open-members")
    texts = texts_of(scratch, rows, nodes, own, "members")
    dealt = own.join(texts.mapInPandas(hashed_sets(words), "node long, h binary"), "node")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label", "s0", "s1", "h")
    dealt = dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "node")
    return dealt.mapInPandas(in_groups(share), "u long, v long")


def verified(scratch: Scratch, pairs: DataFrame, rows: DataFrame, nodes: DataFrame, words: int, share: float, name: str) -> DataFrame:
    """The pairs (u, v) of nodes whose distinct shingles have a Jaccard similarity of at least share."""

    def exact(batches):
        known, size = {}, 0

        def of(node, text):
            nonlocal size
            if node not in known:
                size += len(text or "")
                if len(known) >= 16 or size > 1 << 21:
                    known.clear()
                    size = len(text or "")
                known[node] = shingle_set((text or "").encode("utf-8", "surrogatepass"), words)[1]
            return known[node]

        for p in batches:
            keep = []
            for u, v, a, b in zip(p["u"], p["v"], p["a"], p["b"]):
                x, y = of(u, a), of(v, b)
                both = len(x & y)
                keep.append(both >= share * (len(x) + len(y) - both) - 1e-9)
            yield p.loc[np.array(keep, bool), ["u", "v"]]
        known.clear()
        tidy()

    sought = scratch.table(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), f"{name}-pairs")
    of = sought.select(F.col("u").alias("node")).union(sought.select("v")).distinct()
    own = scratch.table(texts_of(scratch, rows, nodes, of, name), f"{name}-texts")
    both = sought.join(own.withColumnsRenamed({"node": "u", "text": "a"}), "u").join(own.withColumnsRenamed({"node": "v", "text": "b"}), "v")
    return scratch.table(both.select("u", "v", "a", "b").mapInPandas(exact, "u long, v long"), name)


def similar(spark: SparkSession, docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, (k1, k2) (the key of the text) and label of every row of docs: rows have one label if
    links connect them.

    Linked are texts of equal words, and pairs with a Jaccard similarity of distinct shingles of at
    least `share`. Candidates share a hash of their prefixes, which loses no such pair, and are near
    by SimHash of 128 bits; all are verified by their shingles as texts, unless already linked by
    others. First links go to the middle of a bucket; what these leave apart comes second, by pairs for
    small buckets and by groups for others (see grouped_links)."""
    with batches_of(spark, BATCH):
        return labelled(Scratch(spark, "similar"), docs, words, share)


def labelled(scratch: Scratch, docs: DataFrame, words: int, share: float) -> DataFrame:
    """The rows of similar(); all that Python does is done and written when it returns."""
    spark = docs.sparkSession
    rows = scratch.table(long_prints(docs, words, share), "rows")
    of_node = [F.first(c).alias(c) for c in ("s0", "s1", "n", "keys")]
    nodes = scratch.table(rows.groupBy("node").agg(*of_node, F.count(F.lit(1)).alias("copies")), "nodes")
    met = nodes.select("node", "s0", "s1", F.explode("keys").alias("k")).repartition("k").sortWithinPartitions("k", "node")
    found = scratch.table(met.mapInPandas(buckets(["node", "s0", "s1"], in_bucket), "kind int, u long, v long"), "found")
    links = verified(scratch, found.where("kind = 0").select("u", "v"), rows, nodes, words, share, "first")
    label = scratch.table(components(scratch, links, "u", "v"), "label")
    ends = [label.select(F.col("node").alias(f"n{x}"), F.col("label").alias(f"l{x}")) for x in "uv"]
    apart = found.where("kind = 1").select("u", "v").distinct().join(ends[0], F.col("u") == F.col("nu"), "left").join(ends[1], F.col("v") == F.col("nv"), "left")
    apart = apart.where("coalesce(lu, u) <> coalesce(lv, v)").select("u", "v")
    apart = apart.union(grouped_links(scratch, found.where("kind = 2").select("u", "v"), label, nodes, rows, words, share))
    links = links.union(verified(scratch, apart, rows, nodes, words, share, "second"))
    label = components(Scratch(spark, "similar-all"), links, "u", "v")
    h1, h2 = text_key(F.col("text"))
    narrow = rows.select("doc_id", h1.alias("k1"), h2.alias("k2"), "node")
    times = nodes.select(F.col("node").alias("x"), F.col("copies").alias("n"))
    of = scratch.table(times.join(label, F.col("x") == F.col("node"), "left").select(F.col("x").alias("node"), "n", F.coalesce("label", "x").alias("label")), "of")
    return spread(narrow, of, ["node"], "n", rows.count()).select("doc_id", "k1", "k2", "label")


def keep_one(spark: SparkSession, docs: DataFrame, words: int = 5, share: float = 0.8) -> DataFrame:
    """The rows of docs, one of each group of near duplicates: that with the smallest doc_id (of
    rows of one doc_id in the group, that with the smallest hash of its text). Rows with a null
    doc_id cannot be named as one of a group and stay as they are."""
    named = docs.where("doc_id is not null")
    best = similar(spark, named, words, share).groupBy("label").agg(F.min(F.struct("doc_id", "k1", "k2")).alias("b")).select("b.*")
    best = best.withColumnsRenamed({"doc_id": "b0", "k1": "b1", "k2": "b2"})
    h1, h2 = text_key(F.col("text"))
    rows = named.select(F.struct("*").alias("row"), F.col("doc_id").alias("k0"), h1.alias("k1"), h2.alias("k2"))
    kept = rows.join(best, (F.col("k0") == F.col("b0")) & (F.col("k1") == F.col("b1")) & (F.col("k2") == F.col("b2")), "left_semi")
    # one of rows that repeat both doc_id and text
    kept = kept.withColumn("n", F.row_number().over(Window.partitionBy("k0", "k1", "k2").orderBy(F.xxhash64("row"))))
    return kept.where("n = 1").select("row.*").union(docs.where("doc_id is null"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(spark, docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op1_simhash_near_dedup": op1}
SQL: dict[str, str] = {}
