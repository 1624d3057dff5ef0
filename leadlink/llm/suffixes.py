"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

A byte goes if some string of `width` bytes around it starts earlier elsewhere. Three steps:

1. Windows of `width` bytes are dealt out by their minimizer (the 24 bytes in them with the least
   hash): equal windows have equal minimizers, at equal places. A run of windows with one minimizer
   is one string. A string whose minimizer occurs once is done; a string that occurs again, as a
   whole (by a hash of 128 bits, within those of one minimizer), has all its bytes removed at every
   later place. What is left are different strings around one minimizer, which may share windows.
2. A window reaches a given number of bytes to the left of its minimizer or the rest to the right. So
   each string is cut in two, and the parts are brought together by these bytes; equal windows
   still meet, and a part that stands alone is done. A group of over `crowd` parts is cut again by
   half of the bytes that are left, and so on until groups are small or the key is the whole window,
   of which the first stays. Other groups go in batches: a batch is cut into shards; the
   suffixes of each shard are sorted and give its Burrows-Wheeler transform. The transforms are
   merged by refining their interleave (Holt and McMillan, 2014): a vector says which shard each
   place of the merged order comes from; a stable sort of it by the transforms' symbols refines it
   by one symbol, and never sorts suffixes of two shards against each other. A symbol is four
   bytes, so width / 4 steps order all suffixes by `width` bytes. The block borders that appear
   on the way (Egidi and Manzini, 2017) are the common prefixes: a block left at the end is a
   repeated interval, and all its windows but the earliest go.
3. Removed stretches are united in each document.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ranks, spread

WIDTH, GRAM = 100, 24
SLICE = 1 << 22
U = np.uint64
LAST = (1 << 63) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def strings(data: bytes, width: int):
    """(minimizer hash, start, number of windows, offset of the minimizer) of the runs of windows
    with one minimizer, for slices of a text. The leftmost minimizer counts, so equal windows have
    it at equal places."""
    step = SLICE
    for at in range(0, max(len(data) - width + 1, 0), step):
        part = data[at : at + step + width - 1]
        n = len(part)
        words = np.ndarray((n - 7,), "<u8", np.frombuffer(part + b"\0", np.uint8), strides=(1,)).astype(np.uint64)
        grams = n - GRAM + 1
        h = mixed(words[:grams] + mixed(words[8 : 8 + grams] + mixed(words[16 : 16 + grams])))
        least = h >> U(24) << U(24) | np.arange(grams, dtype=np.uint64)
        span, s = width - GRAM + 1, 1
        while 2 * s <= span:
            least, s = np.minimum(least[:-s], least[s:]), 2 * s
        if s < span:
            least = np.minimum(least[: len(least) - (span - s)], least[span - s :])
        starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        ends = np.concatenate([starts[1:], [len(least)]])
        place = (least[starts] & U(0xFFFFFF)).astype(np.int64)
        yield h[place].view(np.int64), starts + at, ends - starts, place - starts


def finder(width: int):
    """Rows (kind, m, s, z, d, t, start, n, a) of all texts: kind 1 for the first occurrence of a string
    in this batch, kind 0 for stretches that repeat an earlier one of the batch."""

    def find(batches):
        import pandas as pd
        from xxhash import xxh3_128_digest

        for p in batches:
            held = []
            for d, t, data in zip(p["d"].tolist(), p["t"].tolist(), p["data"]):
                for m, starts, counts, place in strings(data, width):
                    s = np.frombuffer(b"".join([xxh3_128_digest(data[a : a + n + width - 1]) for a, n in zip(starts.tolist(), counts.tolist())]), np.int64).reshape(-1, 2)
                    held.append((m, s[:, 0], s[:, 1], np.full(len(m), d), np.full(len(m), t), starts, counts, place))
            if held:
                m, s, z, d, t, start, n, a = map(np.concatenate, zip(*held))
                o = np.lexsort((start, t, d, z, s, m))
                m, s, z = m[o], s[o], z[o]
                first = np.concatenate([[True], (m[1:] != m[:-1]) | (s[1:] != s[:-1]) | (z[1:] != z[:-1])])
                # stretches that are done are not dealt by their minimizer, which may be a very common one
                m = np.where(first, m, mixed(d[o].astype(np.uint64) * U(0x9E3779B97F4A7C15) + start[o].astype(np.uint64)).view(np.int64))
                yield pd.DataFrame({"kind": first.astype(np.int32), "m": m, "s": s, "z": z, "d": d[o], "t": t[o], "start": start[o], "n": n[o].astype(np.int32), "a": a[o].astype(np.int32)})

    return find


def sorter():
    """Over rows sorted by (m, s, z, d, t, start): passes kind 0 on; makes later equal strings kind 0;
    keeps the first of each string of a minimizer that has different ones. It holds a batch and a
    row at most."""

    def sort(batches):
        import pandas as pd

        last, pending = None, None  # the string before, and the first of its minimizer until another comes
        for p in batches:
            gone = p["kind"].to_numpy() == 0
            if gone.any():
                yield p.loc[gone, OUT]
            p = p[~gone]
            if not len(p):
                continue
            key = [p[c].to_numpy() for c in ("m", "s", "z")]
            before = [np.concatenate([[x[0] if last is None else last[i]], x[:-1]]) for i, x in enumerate(key)]
            new = before[0] != key[0]
            first = new | (before[1] != key[1]) | (before[2] != key[2])
            if last is None:
                new[0] = first[0] = True
            last = [x[-1] for x in key]
            if not first.all():
                yield p.loc[~first, OUT].assign(kind=np.int32(0))
            q, new = p[first], new[first]
            if not len(q):
                continue
            if not new[0] and pending is not None:
                yield pending
            # a string stays if another of its minimizer comes before or after it
            follows = np.concatenate([~new[1:], [False]])
            keep = ~new | follows
            if keep.any():
                yield q.loc[keep, OUT]
            pending = None if keep[-1] else q[-1:][OUT]

    return sort


OUT = ["kind", "m", "d", "t", "start", "n", "a"]


def parts_of(width: int, row: str, ext: str, back: str) -> str:
    """SQL for the two parts of a row (m, start, data, n, p, l), all of whose windows contain the l
    bytes from the p-th of data on: windows that reach `ext` bytes or more to the left of these are
    keyed by them and the bytes there, the others by them and `back` bytes to the right."""
    cut = lambda at, n: f"substring({row}.data, CAST({at} AS INT) + 1, CAST({n} AS INT))"
    part = lambda side, at, n, key, p, size: f"named_struct('m', xxhash64({row}.m, {side}, {key}), 'start', {row}.start + {at}, 'data', {cut(at, f'{n} + {width - 1}')}, 'n', CAST({n} AS INT), 'p', CAST({p} AS INT), 'l', CAST({size} AS INT))"
    skip = f"greatest(0, {row}.p - {ext} + 1)"
    left = part(0, "0", f"least({row}.n, {row}.p - {ext} + 1)", cut(f"{row}.p - {ext}", ext), f"{row}.p - {ext}", f"{row}.l + {ext}")
    right = part(1, skip, f"({row}.n - {skip})", cut(f"{row}.p + {row}.l", back), f"({row}.p - {skip})", f"{row}.l + {back}")
    return f"array_compact(array(CASE WHEN {row}.p >= {ext} THEN {left} END, CASE WHEN {row}.n > {skip} THEN {right} END))"


def narrower(rows: DataFrame, width: int) -> DataFrame:
    """Rows (m, d, t, start, data, n, p, l) cut in two, by half of the bytes that a window has besides
    the l that all windows of a row share."""
    rows = rows.withColumn("e", F.expr(f"CAST(ceil(({width} - l) / 2) AS INT)")).withColumn("b", F.expr(f"{width} - l - e + 1"))
    rows = rows.select("d", "t", F.struct("m", "start", "data", "n", "p", "l", "e", "b").alias("w"))
    return rows.select("d", "t", F.explode(F.expr(parts_of(width, "w", "w.e", "w.b"))).alias("x")).select("x.m", "d", "t", "x.start", "x.data", "x.n", "x.p", "x.l")


def shard_order(text: np.ndarray, after: np.ndarray, width: int) -> np.ndarray:
    """Places of the cyclic suffixes of a shard in the order of `width` symbols at least. after: for
    each place, the place that follows it in its string, around its end."""
    rank, reach = text.astype(np.int64), 1
    jump = after
    while True:
        key = rank * (int(rank.max()) + 1) + rank[jump]
        order = np.argsort(key, kind="stable")
        k = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]]))
        reach *= 2
        if reach >= width or rank[order[-1]] == len(rank) - 1:
            return order
        jump = jump[jump]


def by_symbol(c: np.ndarray) -> np.ndarray:
    """Stable order by symbols, in one or two passes of 16 bits."""
    if c.dtype == np.uint16:
        return np.argsort(c, kind="stable")
    low = np.argsort((c & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    return low[np.argsort((c[low] >> np.uint32(16)).astype(np.uint16), kind="stable")]


def repeated(parts: list[bytes], width: int = WIDTH, shards: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(part, offset) of every window of `width` bytes that occurs in a part before, or earlier in
    the same one. Parts are given in the order in which they count as earlier."""
    if width % 4:
        raise ValueError("the width must be a multiple of four")
    lens = np.array([len(x) for x in parts], np.int64)
    n = int(lens.sum()) + len(parts)
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.uint16) + 1
    ends = np.cumsum(lens + 1) - 1
    begins = ends - lens
    text[ends] = 0
    after = np.arange(1, n + 1)
    after[ends] = begins
    before = np.empty(n, np.int64)
    before[after] = np.arange(n)
    # the four symbols before each place, as one
    sign = np.zeros(n, np.uint64)
    at = before
    for i in range(4):
        sign |= text[at].astype(np.uint64) << U(9 * i)
        at = before[at]
    kinds, sign = np.unique(sign, return_inverse=True)
    sign = sign.astype(np.uint16 if len(kinds) <= 1 << 16 else np.uint32)
    # transforms of the shards, one after the other, with the places they come from
    borders = np.unique(np.searchsorted(ends, np.linspace(0, n, shards + 1)[1:-1]))
    cuts = [0, *[int(begins[b]) for b in borders if 0 < b < len(parts)], n]
    place = np.concatenate([a + shard_order(text[a:b], after[a:b] - a, width) for a, b in zip(cuts, cuts[1:])])
    transform = sign[place]
    origin = np.repeat(np.arange(len(cuts) - 1, dtype=np.uint8), np.diff(cuts))
    block = np.zeros(n, np.int32)
    symbol = np.empty(n, sign.dtype)
    for _ in range(width // 4):
        symbol[np.argsort(origin, kind="stable")] = transform
        order = by_symbol(symbol)
        origin, block, symbol = origin[order], block[order], symbol[order]
        border = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.zeros(n, np.int32)
        np.cumsum(border, out=block[1:])
    merged = np.empty(n, np.int64)
    merged[np.argsort(origin, kind="stable")] = place
    # windows that end before the end of their part; places grow with the order of the parts
    left = np.repeat(ends, lens + 1) - np.arange(n)
    first = np.full(int(block[-1]) + 1 if n else 0, n, np.int64)
    np.minimum.at(first, block, merged)
    again = np.sort(merged[(merged != first[block]) & (left[merged] >= width)])
    part = np.searchsorted(ends, again)
    return part, again - begins[part]


def merger(width: int, batch: int):
    """Over rows (m, d, t, start, data) sorted by m: the stretches (d, t, start, n) of repeated
    windows. Parts that stand alone are left out; the others are taken group by group, together up
    to `batch` bytes."""

    def merge(batches):
        import pandas as pd

        held, size, rest = [], 0, None
        for p in batches:
            p = p if rest is None else pd.concat([rest, p], ignore_index=True)
            if not len(p):
                continue
            m = p["m"].to_numpy()
            cut = int(np.flatnonzero(m != m[-1])[-1]) + 1 if m[0] != m[-1] else 0  # the last group may go on
            q, rest = p.iloc[:cut], p.iloc[cut:]
            q = shared(q)
            for at in range(0, len(q), 4096):
                # a group may be cut between two looks at the size, but not between two batches
                held.append(q.iloc[at : at + 4096])
                size += int(held[-1]["data"].map(len).sum())
            if size > batch:
                yield from solved(pd, held)
                held, size = [], 0
        if rest is not None and len(shared(rest)):
            held.append(shared(rest))
        if held:
            yield from solved(pd, held)

    def shared(q):
        m = q["m"].to_numpy()
        same = m[1:] == m[:-1]
        return q[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(q) else q

    def solved(pd, held):
        whole = pd.concat(held, ignore_index=True)
        m, sizes = whole["m"].to_numpy(), whole["data"].map(len).to_numpy()
        # batches end where a group does
        ends = np.concatenate([np.flatnonzero(m[1:] != m[:-1]) + 1, [len(m)]]) if len(m) else np.zeros(0, int)
        at, total = 0, np.cumsum(sizes)
        for e in ends.tolist():
            if e == len(m) or total[e - 1] - (total[at - 1] if at else 0) > batch:
                yield from solved_batch(pd, whole.iloc[at:e])
                at = e

    def solved_batch(pd, p):
        p = p.sort_values(["d", "t", "start"])
        d, t, start = p["d"].to_numpy(), p["t"].to_numpy(), p["start"].to_numpy()
        part, offset = repeated(list(p["data"]), width)
        if len(part):
            run = np.concatenate([[True], (part[1:] != part[:-1]) | (offset[1:] != offset[:-1] + 1)])
            at = np.flatnonzero(run)
            n = np.diff([*at, len(part)])
            yield pd.DataFrame({"d": d[part[at]], "t": t[part[at]], "start": start[part[at]] + offset[at], "n": n.astype(np.int32)})

    return merge


def keyed(scratch: Scratch, docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """doc_id, data, and (d, t): d orders documents, nulls last; t tells apart the texts of one
    doc_id (0 where doc_ids are all different, which is looked up). Second, one row for each (d, t)."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("data"))
    own = own.withColumn("d", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)))
    if not own.groupBy("d").agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 OR d = {LAST}").limit(1).count():
        own = own.withColumn("t", F.lit(0).cast("long"))
        return own, own
    own = own.withColumns({"k1": F.xxhash64("data"), "k2": F.xxhash64(F.lit(7), "data")})
    texts = scratch.table(own.groupBy("d", "k1", "k2").agg(F.count(F.lit(1)).alias("c")), "texts")
    total = own.count()
    texts = scratch.table(ranks(texts, ["d"], ["k1", "k2"], "t", total=total), "told")
    own = spread(own, texts, ["d", "k1", "k2"], "c", total).drop("k1", "k2")
    return own, own.groupBy("d", "t").agg(F.min("data").alias("data"))


def digest(width: int):
    def of(batches):
        import pandas as pd

        for p in batches:
            out = []
            for i, data, starts, counts in zip(p["doc_id"], p["data"], p["starts"], p["counts"]):
                removed, spans, kept, at = 0, 0, hashlib.sha256(), 0
                if starts is not None and len(starts):
                    a = np.array(starts, np.int64)
                    b = a + np.array(counts, np.int64) + width - 1
                    o = np.argsort(a, kind="stable")
                    a, b = a[o], np.maximum.accumulate(b[o])
                    new = np.concatenate([[True], a[1:] > b[:-1]])
                    first = np.flatnonzero(new)
                    for x, y in zip(a[first].tolist(), b[[*(first[1:] - 1), len(b) - 1]].tolist()):
                        kept.update(memoryview(data)[at:x])
                        removed, spans, at = removed + y - x, spans + 1, y
                kept.update(memoryview(data)[at:])
                out.append((None if i is None or i != i else int(i), len(data), removed, spans, kept.hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})

    return of


def stretches(scratch: Scratch, docs: DataFrame, width: int = WIDTH, batch: int = 1 << 21, crowd: int = 50_000) -> DataFrame:
    """(d, t, start, n): runs of n windows, all of which start earlier elsewhere too."""
    if width < GRAM + 1:
        raise ValueError(f"the width must be over {GRAM}")
    rows = docs.where(F.octet_length("data") >= width).select("d", "t", "data")
    found = rows.mapInPandas(finder(width), "kind int, m long, s long, z long, d long, t long, start long, n int, a int")
    found = found.repartition("m").sortWithinPartitions("m", "s", "z", "d", "t", "start")
    known = scratch.table(found.mapInPandas(sorter(), "kind int, m long, d long, t long, start long, n int, a int"), "known")
    open_ = known.where("kind > 0").groupBy("d", "t").agg(F.collect_list(F.struct("m", "start", "n", "a")).alias("w"))
    cut = docs.join(open_, ["d", "t"]).select("d", "t", "data", F.explode("w").alias("w"))
    strings = cut.select("w.m", "d", "t", "w.start", F.expr(f"substring(data, CAST(w.start AS INT) + 1, w.n + {width - 1})").alias("data"), "w.n", F.col("w.a").alias("p"), F.lit(GRAM).alias("l"))
    out, stretch = [known.where("kind = 0").select("d", "t", "start", "n")], "d long, t long, start long, n int"
    now, level = scratch.table(narrower(strings, width), "parts0"), 0
    while True:
        counts = now.groupBy("m").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > crowd).select("m")
        crowded = scratch.table(counts, f"crowded{level}")
        many = crowded.count()
        # keys of over `crowd` of the rows each: few, unless there are 10 billion such rows and more
        hot = F.broadcast(crowded) if many <= 200_000 else crowded
        rest = now.join(hot, "m", "left_anti") if many else now
        parts = rest.select("m", "d", "t", "start", "data").repartition("m").sortWithinPartitions("m")
        out.append(scratch.table(parts.mapInPandas(merger(width, batch), stretch), f"merged{level}"))
        if not many:
            break
        over = now.join(hot, "m", "left_semi")
        level += 1
        now = scratch.table(narrower(over.where(F.col("l") < width), width), f"parts{level}")
        # windows whose key is all of their bytes: all but the first of each go
        whole = scratch.table(over.where(F.col("l") >= width).select("data", F.struct("d", "t", "start").alias("o"), "n"), f"whole{level}")
        first = scratch.table(whole.groupBy("data").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("c")), f"first{level}")
        later = spread(whole, first, ["data"], "c", whole.count()).where("o <> first")
        out.append(later.select("o.d", "o.t", "o.start", "n"))
    return reduce(DataFrame.union, out)


def remove_repeats(spark: SparkSession, docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", crowd: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of docs.

    A null text is as an empty one. Texts shorter than `width` stay whole. A null doc_id comes
    after all others. Rows that repeat doc_id and text are one document and have its result; texts
    of one doc_id come in the order of a hash. An empty table gives an empty result. Other columns
    are ignored, whatever they are named."""
    scratch = Scratch(spark, "suffixes")
    own, single = keyed(scratch, docs, doc_id, text)
    gone = stretches(scratch, single, width, crowd=crowd).groupBy("d", "t").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))
    joined = own.join(gone, ["d", "t"], "left").select("doc_id", "data", "starts", "counts")
    return joined.mapInPandas(digest(width), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_suffix_array_dedup": op6}
SQL: dict[str, str] = {}
