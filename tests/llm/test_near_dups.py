"""SimHash, line, decontamination, suffix and vector operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlink.llm import common, decontaminate, embeddings, lines, quality, simhash, suffixes

WORDS = [f"w{i}" for i in range(40)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def near(a, rng, n=1):
    w = a.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "new"
    return " ".join(w)


# ---- simhash ----
def brute_print(text, k=4):
    import xxhash

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(n, linked):
    label = list(range(n))
    for _ in range(n):
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("radius", [2, 4, 6])
def test_masks_cover_every_pair(radius):
    m = [x & (1 << 64) - 1 for x in simhash.masks(radius)]
    rng = random.Random(1)
    for _ in range(500):
        flips = sum(1 << i for i in rng.sample(range(64), radius))
        assert any(x & flips == 0 for x in m)


def test_spanning_forest_joins_what_all_links_join():
    rng = np.random.default_rng(0)
    for _ in range(50):
        centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
        flips = lambda: sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))
        f = np.unique(np.array([int(centres[rng.integers(5)]) ^ flips() for _ in range(60)], np.uint64))
        linked = [(a, b) for a in range(len(f)) for b in range(a) if int(f[a] ^ f[b]).bit_count() <= 4]
        got = simhash.spanning(f, 4)
        assert components(len(f), got) == components(len(f), linked)
        assert len(got) == len(f) - len(set(components(len(f), linked)))


@pytest.mark.parametrize("dense", [20_000, 3])
def test_simhash_against_brute_force(spark, docs, dense):
    rng = random.Random(7)
    texts = [prose(rng, 300) for _ in range(8)]
    texts += [near(texts[i % 8], rng) for i in range(30)] + [texts[0]] * 5 + ["", None, "   ", "One", "one", prose(rng, 3)]
    ids = [1000 - i for i in range(len(texts) - 1)] + [None]
    df = docs(texts, ids)
    got = simhash.near_duplicates(spark, df, dense=dense).collect()
    p = [brute_print(t) for t in texts]
    linked = [(a, b) for a in range(len(p)) for b in range(a) if (p[a] ^ p[b]).bit_count() <= 4]
    label = components(len(p), linked)
    low = {c: min((ids[i] for i in range(len(p)) if label[i] == c and ids[i] is not None), default=None) for c in set(label)}
    want = sorted((str(ids[i]), p[i], str(low[label[i]])) for i in range(len(p)))
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, str(r["component_id"])) for r in got) == want


def test_keep_one(spark, docs):
    rng = random.Random(3)
    a, b = prose(rng, 400), prose(rng, 400)
    df = docs([a, a, near(a, rng), b, b, None, "x"], [5, 5, 9, 2, None, 7, 8])
    kept = simhash.keep_one(spark, df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "5", "7", "8", "None"]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    got = dict(common.components(common.Scratch(spark, "t"), edges, "a", "b").collect())
    assert got == {i: 0 for i in range(201)} | {1000: 1000, 1001: 1000}


def test_ranks(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = common.ranks(df, ["k"], ["id"], buckets=7).groupBy("k").agg(F.count("*").alias("n"), F.count_distinct("rank").alias("d"), F.min("rank").alias("a"), F.max("rank").alias("b")).collect()
    assert all(r["n"] == r["d"] and r["a"] == 0 and r["b"] == r["n"] - 1 for r in got)


# ---- lines ----
def brute_lines(texts):
    seen, out = set(), []
    for t in texts:
        cut = t.split("\n")
        gone = set()
        for i in range(len(cut) - 2):
            w = tuple(cut[i : i + 3])
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        spans = sum(i - 1 not in gone for i in gone)
        out.append((len(cut), len(gone), spans, "\n".join(x for i, x in enumerate(cut) if i not in gone)))
    return out


def test_lines_against_brute_force(spark, docs):
    rng = random.Random(2)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["", "a\n\n\n\n\n", "\n".join("q" * 1 for _ in range(3000))]
    got = {r["doc_id"]: tuple(r)[1:] for r in lines.deduplicate(spark, docs(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts)


def test_lines_odd_rows(spark, docs):
    got = lines.deduplicate(spark, docs(["a\nb\nc", "a\nb\nc", None, "a\nb\nc"], [1, 1, 2, None])).collect()
    want = [(1, 3, 0, 0, "a\nb\nc"), (1, 3, 0, 0, "a\nb\nc"), (2, 0, 0, 0, None), (None, 3, 3, 1, "")]
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))


# ---- decontamination ----
def brute_shared(text, item):
    import regex

    def sh(t):
        w = regex.findall(r"[\p{L}\p{N}]+", (t or "").lower())
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    s = sh(item)
    return len(s), len(s & sh(text))


@pytest.mark.parametrize("inline", [20_000, 0])
def test_contamination_against_brute_force(spark, docs, inline):
    rng = random.Random(5)
    items = [prose(rng, n) for n in (12, 20, 40, 4)] + ["same here " + prose(rng, 9)] * 2 + [None]
    texts = [prose(rng, 200) for _ in range(6)]
    for i in (0, 1, 2, 4):
        texts.append(f"{prose(rng, 3000)} {items[i].upper()}, {prose(rng, 40)}")
        w = items[i].split(" ")
        w[len(w) // 2] = "gap"
        texts.append(f"{prose(rng, 30)} {' '.join(w)}")
    texts += ["", None, items[2]]
    b = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(None, items[2], "x")], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_shared"]) for r in decontaminate.contamination(spark, docs(texts), b, inline=inline).collect()}
    want = {(d, i, *brute_shared(t, x)) for d, t in enumerate(texts) for i, x in enumerate(items)}
    assert got == {w for w in want if w[2] and w[3] >= 0.8 * w[2]} and len(got) >= 6
    kept = decontaminate.clean(spark, docs(texts), b)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {g[0] for g in got})


# ---- suffixes ----
def brute_bytes(texts, width):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        cover = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - width + 1):
            w = b[i : i + width]
            if w in seen:
                cover[i : i + width] = True
            seen.add(w)
        cover = cover[: len(b)]
        spans = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(b) else 0
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out.append((len(b), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("width, crowd", [(28, 50_000), (100, 50_000), (100, 2)])
def test_suffixes_against_brute_force(spark, docs, width, crowd):
    rng = random.Random(4)
    base = [prose(rng, 40) for _ in range(5)] + ["a" * 300, "ab" * 200, "é" * 90]
    texts = ["".join(rng.choice(base)[rng.randrange(20) :] for _ in range(rng.randint(0, 4))) for _ in range(40)] + ["", None, base[0], base[0]]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixes.remove_repeats(spark, docs(texts), width, crowd=crowd).collect()}
    assert [got[i] for i in range(len(texts))] == brute_bytes(texts, width)


def test_suffixes_across_slices(monkeypatch):
    rng = random.Random(6)
    data = prose(rng, 3000).encode()
    whole = [np.concatenate(x) for x in zip(*suffixes.strings(data, 100))]
    monkeypatch.setattr(suffixes, "SLICE", 1000)
    parts = [np.concatenate(x) for x in zip(*suffixes.strings(data, 100))]
    for _, s, n, _ in (whole, parts):
        assert n.sum() == len(data) - 99 and (s[1:] == s[:-1] + n[:-1]).all()


def test_suffixes_odd_rows(spark, docs):
    long = "x" + "0123456789" * 30
    rows = suffixes.remove_repeats(spark, docs([long, long, "other " + long, None], [1, 1, None, 2])).collect()
    by = sorted(str(tuple(r)[:3]) for r in rows)
    own = brute_bytes([long, "other " + long], 100)
    assert by == sorted(map(str, [(1, *own[0][:2]), (1, *own[0][:2]), (None, *own[1][:2]), (2, 0, 0)]))


# ---- vectors ----
@pytest.mark.parametrize("cell", [4096, 4])
def test_vectors_against_brute_force(spark, cell):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 16))
    x = np.concatenate([base, base.repeat(6, 0) + rng.normal(0, 0.12, (72, 16)), base[:3] * 2])
    label = [i % 2 for i in range(len(x))]
    rows = [(i * 7 % 1000, label[i], x[i].tolist(), "c") for i in range(len(x))]
    rows += [(2001, None, x[0].tolist(), "c"), (2002, 0, None, "c"), (2003, 0, [0.0] * 16, "c"), (2004, 0, [float("nan")] * 16, "c"), (2005, 0, [None] * 16, "c"), (2006, 0, [1.0], "c"), (None, 0, x[0].tolist(), "c")]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, id string")
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_vectors(spark, df, cell=cell, width=4).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = [(a, b) for a in range(len(x)) for b in range(len(x)) if a != b and label[a] == label[b] and u[a] @ u[b] >= 0.93]
    comp = components(len(x), linked)
    for i in range(len(x)):
        low = min(rows[j][0] for j in range(len(x)) if comp[j] == comp[i])
        assert got[rows[i][0]] == (sum(a == i for a, _ in linked), low, rows[i][0] == low)
    for v in range(2001, 2007):
        assert got[v] == (0, v, True)
    assert got[None] == (0, None, True)


def test_vectors_at_the_very_cosine_and_repeated_ids(spark):
    # 0.6 x 0.6 + 0.8 x 0.8 and the like: cosines of 0.96, 0.8, exactly; ties at the threshold link
    rows = [(1, 0, [3.0, 4.0]), (2, 0, [4.0, 3.0]), (3, 0, [4.0, -3.0]), (4, 0, [3.0, 4.0]), (4, 0, [-3.0, -4.0]), (5, 1, [3.0, 4.0]), (6, 1, [4.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(tuple(r) for r in embeddings.near_vectors(spark, df, cosine=0.96, width=1).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (4, 2, 1, False), (5, 1, 5, True), (6, 1, 5, False)]


@pytest.mark.parametrize("cell", [4096, 4])
def test_vectors_that_share_an_id(spark, cell):
    """One id for two vectors, or under two labels: each row has its own links and component."""
    far, near = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, 0, far), (1, 0, near), (2, 0, [1.0, 0.01, 0.0]), (3, 0, [0.01, 1.0, 0.0])]
    rows += [(10, 0, [0.0, 0.0, 1.0]), (11, 0, [0.0, 0.01, 1.0]), (10, 1, far), (12, 1, [1.0, 0.01, 0.0]), (13, 1, [1.0, 0.02, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = sorted(tuple(r) for r in embeddings.near_vectors(spark, df, cell=cell, width=1).collect())
    assert got == sorted([(1, 1, 1, True)] * 2 + [(2, 1, 1, False), (3, 1, 1, False), (10, 1, 10, True), (11, 1, 10, False), (10, 2, 10, True), (12, 2, 10, False), (13, 2, 10, False)])


def test_empty_tables(spark, docs):
    none = docs([])
    assert simhash.near_duplicates(spark, none).count() == 0
    assert lines.deduplicate(spark, none).count() == 0
    assert suffixes.remove_repeats(spark, none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(spark, none, items).count() == 0
    assert decontaminate.contamination(spark, docs(["a b c d e f"]), items).count() == 0
    assert embeddings.near_vectors(spark, spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


# ---- similar texts ----
def jaccard(a, b):
    x, y = [simhash.shingle_set((t or "").encode(), 5)[1] for t in (a, b)]
    return len(x & y) / max(1, len(x | y))


def test_similar_texts_down_to_the_share(spark, docs):
    rng = random.Random(11)
    texts = []
    for i in range(30):
        w = [f"v{rng.randrange(5000)}" for _ in range(400)]
        v = list(w)
        for at in range(7, 400, 52 if i % 2 else 30):
            v[at] = "new"
        texts += [" ".join(w), " ".join(v)]
    # a loop of words, and the same with other words after it, are far apart as sets
    texts += ["a b c d e f " * 200, "a b c d e f " * 200 + " ".join(f"z{i}" for i in range(40))]
    shares = [jaccard(texts[i], texts[i + 1]) for i in range(0, len(texts), 2)]
    kept = {r["doc_id"] for r in simhash.keep_one(spark, docs(texts)).collect()}
    assert kept == {i for i in range(len(texts)) if i % 2 == 0 or shares[i // 2] < 0.8}
    assert sum(0.8 <= s < 0.9 for s in shares) >= 10 and sum(s < 0.8 for s in shares) >= 10


@pytest.mark.parametrize("small", [64, 3])
def test_similar_groups_against_brute_force(spark, docs, small, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(12)
    base = [" ".join(f"v{rng.randrange(5000)}" for _ in range(300)) for _ in range(4)]
    texts = [near(base[i % 4], rng, rng.randint(0, 9)) for i in range(80)]
    linked = [(a, b) for a in range(80) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    label = components(80, linked)
    assert {r["doc_id"] for r in simhash.keep_one(spark, docs(texts)).collect()} == set(label)


def test_keep_one_with_repeated_doc_ids(spark, docs):
    rng = random.Random(13)
    a, b, c = prose(rng, 200), prose(rng, 200), prose(rng, 200)
    # two texts of their own under one doc_id; a copy of 2's text and one of its own under another
    rows = [(5, a), (5, b), (2, c), (7, c), (7, "only here"), (7, "only here")]
    got = simhash.keep_one(spark, docs([t for _, t in rows], [i for i, _ in rows]))
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == sorted([(5, a), (5, b), (2, c), (7, "only here")])


def test_clean_with_null_and_repeated_doc_ids(spark, docs):
    rng = random.Random(14)
    item = prose(rng, 30)
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, f"start {item} end"), (None, "clean " * 9), (3, f"more {item}"), (3, "also clean"), (4, None)]
    kept = decontaminate.clean(spark, docs([t for _, t in rows], [i for i, _ in rows]), b).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {rows[1], rows[3], rows[4]}


def test_stages_keep_columns_of_any_name(spark, docs):
    rng = random.Random(20)
    item = prose(rng, 30)
    texts = [prose(rng, 60) for _ in range(6)] + [f"x {item} y", None, ""]
    df = docs(texts).selectExpr("doc_id", "text", "lang AS row", "source AS k0", "n_chars AS k1", "h1 AS n", "size AS score", "r AS b0", "rank AS label", "'a' AS __bad", "1 AS __id", "2 AS __score", "3 AS __n")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    for out, gone in ((simhash.keep_one(spark, df), {8}), (decontaminate.clean(spark, df, items), {6}), (quality.accepted(spark, df, labels, 0.0), set())):
        assert out.columns == df.columns
        assert {r["doc_id"] for r in out.collect()} == set(range(9)) - gone
        assert {(r["__bad"], r["__id"], r["__score"], r["__n"]) for r in out.collect()} == {("a", 1, 2, 3)}


def test_hot_keys_are_spread(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id")
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    got = common.spread(rows, table, ["k"], "n", 3000)
    assert sorted(map(tuple, got.select("k", "id", "low").collect())) == sorted(map(tuple, rows.join(table, "k").select("k", "id", "low").collect()))


def test_scratch_goes_when_released(spark):
    with common.released():
        s = common.Scratch(spark, "t")
        assert s.table(spark.range(3), "a").count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(s.path)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@pytest.mark.parametrize("inline", [20_000, 0])
def test_containment_search_loses_nothing_at_the_share(spark, docs, inline, monkeypatch):
    """Items of all sizes, each in a long document that holds the share or a little more or less."""
    monkeypatch.setattr(decontaminate, "BLOCK", 500)
    rng = random.Random(22)
    word = lambda: f"v{rng.randrange(9000)}"
    items, texts = [], []
    for i in range(120):
        w = [word() for _ in range(5 + i * i // 60)]
        items.append(" ".join(w))
        v = list(w)
        for at in rng.sample(range(len(v)), round(len(v) * rng.choice([0, 0.02, 0.03, 0.04, 0.05]))):
            v[at] = "gap"
        texts.append(" ".join([*(word() for _ in range(rng.randrange(800))), *v, *(word() for _ in range(rng.randrange(800)))]))
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["n_shared"]) for r in decontaminate.contamination(spark, docs(texts), b, inline=inline).collect()}
    want = {(i, i, brute_shared(texts[i], items[i])) for i in range(120)}
    want = {(i, j, s) for i, j, (n, s) in want if n and s >= 0.8 * n - 1e-9}
    assert got == want and 60 < len(want) < 115
    assert sum(s < 0.9 * brute_shared(texts[i], items[i])[0] for i, _, s in want) > 10


@pytest.mark.parametrize("block", [1_000_000, 3000])
def test_crowded_groups_against_brute_force(spark, docs, block, monkeypatch):
    """A group of copies of one text, most of which lie a little under the share of each other."""
    monkeypatch.setattr(simhash, "SMALL", 10)
    whole = simhash.grouped_links
    monkeypatch.setattr(simhash, "grouped_links", lambda *a: whole(*a, block))
    rng = random.Random(23)
    base = " ".join(f"v{rng.randrange(5000)}" for _ in range(300))
    texts = [near(base, rng, rng.randint(3, 8)) for _ in range(70)] + [near(near(base, rng, 30), rng, 2) for _ in range(10)]
    linked = [(a, b) for a in range(80) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8]
    label = components(80, linked)
    assert 3 < len(set(label)) < 60
    assert {r["doc_id"] for r in simhash.keep_one(spark, docs(texts)).collect()} == set(label)


def test_shingles_are_counted_in_all_texts(spark, docs):
    from xxhash import xxh3_128_digest

    texts = [f"a b c d e {' '.join(f'w{i + j}' for j in range(i % 7))}" for i in range(300)] + [None, ""]
    want = np.zeros(simhash.SLOTS, np.int64)
    for t in texts:
        for s in simhash.shingle_set((t or "").encode(), 5)[1]:
            want[int(np.frombuffer(xxh3_128_digest(s), np.int64)[0]) & (simhash.SLOTS - 1)] += 1
    got = simhash.shingle_counts(docs(texts).repartition(7), 5)
    assert got.tolist() == want.tolist() and got.max() == 300
    # a set's prefix has its rare hashes first
    h = np.flatnonzero(want)
    assert want[simhash.prefix(h, 0.8, got)].max() < 300 and len(simhash.prefix(h, 0.8, got)) == len(h) - int(np.ceil(0.8 * len(h))) + 1


def test_tables_give_back_the_drivers_memory(spark):
    # before, what the native code of the driver's JVM had freed stayed with it through all tables
    scratch = common.Scratch(spark, "given")
    common._given[0] = 0.0
    assert scratch.table(spark.range(10), "t").count() == 10
    assert common._given[0] > 0
    scratch.drop()
    if int(spark._jvm.java.lang.System.getProperty("java.specification.version").split(".")[0]) >= 17:
        assert "native heap" in common.give_back(spark, 0.0)
