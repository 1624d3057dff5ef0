"""Classifiers, mixing, sharding, tokens and the pipeline."""

import functools
import heapq
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlink.llm import common, language, mixing, quality, sharding, tokens

DIR = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(40)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def same_rows(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# ---- sharding ----
def test_schedule_is_longest_processing_time():
    rng = random.Random(1)
    for t in range(200):
        loads = sorted({rng.randint(1, 200): rng.choice([1, 3, 50, 400]) for _ in range(6)}.items(), reverse=True)
        start = [0] * 8 if t % 2 else [rng.randint(0, 3000) for _ in range(8)]
        heap = [(x, i) for i, x in enumerate(start)]
        heapq.heapify(heap)
        for load, n in loads:
            for _ in range(n):
                x, i = heap[0]
                heapq.heapreplace(heap, (x + load, i))
        total, n = list(start), 0
        for load, i, low, high in sharding.schedule(loads, 8, start):
            total[i] += load * (high - low)
            n += high - low
        assert sorted(total) == sorted(x for x, _ in heap) and n == sum(c for _, c in loads)


def test_shards(spark, docs):
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(0, 30)) for _ in range(200)] + ["same text"] * 40 + ["", "", None, None]
    df = docs(texts, [*range(len(texts) - 1), None])
    rows = sharding.shard(spark, df).collect()
    assert len(rows) == len(texts)
    of = {}
    for r in rows:
        t = None if r["doc_id"] is None else texts[r["doc_id"]]
        b = (t or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(b) + 1, zlib.crc32(b))
        assert of.setdefault(t, r["shard"]) == r["shard"]
    load = [sum(r["size"] for r in rows if r["shard"] == i) for i in range(8)]
    assert max(load) - min(load) <= max(40 * 10, max(r["size"] for r in rows))
    for i in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == i) == list(range(sum(r["shard"] == i for r in rows)))
    assert same_rows(sharding.shard(spark, df), sharding.shard(spark, df.repartition(3)))


# ---- mixing ----
def largest_sum(items, budget):
    sums = {0}
    for n, c in items:
        for _ in range(c):
            sums |= {x + n for x in sums if x + n <= budget}
    return max(sums)


@pytest.mark.parametrize("way", [mixing.dense, mixing.sparse, mixing.knapsack])
def test_knapsack_against_all_sums(way):
    rng = random.Random(3)
    for _ in range(200):
        items = [(rng.randint(1, 12), rng.randint(1, 4)) for _ in range(4)]
        items = sorted(dict(items).items())
        budget = rng.randint(0, 60)
        got = way([x for x in items if x[0] <= budget], budget)
        assert all(got.get(n, 0) <= c for n, c in items)
        assert sum(n * k for n, k in got.items()) == largest_sum(items, budget)


@pytest.mark.parametrize("most, kinds", [(40, 8), (5000, 8), (1_000_000, 8), (10_000_000, 5)])
def test_fit_against_all_sums(most, kinds):
    rng = random.Random(most)
    for _ in range(30):
        lengths = sorted({rng.randint(1, most): rng.choice([1, 1, 2]) for _ in range(kinds)}.items())
        total = sum(n * c for n, c in lengths)
        budget = rng.randint(0, total - 1)
        got = mixing.fit(lengths, budget, total)
        assert all(0 <= got.get(n, 0) <= c for n, c in lengths)
        assert sum(n * k for n, k in got.items()) == largest_sum(lengths, budget)
    assert mixing.weight(mixing.fit([(290000, 1), (400000, 1)], 300000, 690000)) == 290000
    assert mixing.weight(mixing.fit([(1_000_000 + i, 1) for i in range(3)], 1_020_000, 3_000_003)) == 1_000_002


def test_fit_of_many_documents():
    rng = random.Random(9)
    for top in (300, 20_000, 3_000_000):
        lengths = sorted({rng.randint(top // 100, top): rng.randint(1, 50) for _ in range(400)}.items())
        total = sum(n * c for n, c in lengths)
        for budget in (total // 7, total // 2, total - 11):
            got = mixing.fit(lengths, budget, total)
            assert all(got[n] <= c for n, c in lengths if n in got)
            assert 0 <= budget - mixing.weight(got) <= 1 + budget // 100_000


@pytest.mark.parametrize("n, low, high", [(25, 5_000_000, 6_000_000), (30, 4_500_000, 4_600_000), (40, 3_000_000, 9_000_000), (60, 3_000_000, 11_000_000), (4000, 4_200_000, 5_000_000)])
def test_fit_of_long_documents(n, low, high):
    """Budgets over WORDS words without short documents, against 2,000 random sums."""
    rng = random.Random(n)
    for part in (0.3, 0.5, 0.32):
        own = rng.sample(range(low, high), n)
        budget = int(sum(own) * part) + rng.randrange(1000)
        got = mixing.fit([(x, 1) for x in own], budget, sum(own))
        assert set(got) <= set(own) and all(k in (0, 1) for k in got.values())
        best = 0
        for _ in range(2000 if n < 100 else 20):
            total = 0
            for x in rng.sample(own, n):
                total += x if total + x <= budget else 0
            best = max(best, total)
        assert best - budget // 1000 <= mixing.weight(got) <= budget


def test_mix_of_long_texts(spark, docs):
    rng = random.Random(1)
    sizes = [rng.randrange(210_000, 260_000) for _ in range(26)]
    texts = ["w " * n for n in sizes] + ["one", "two words"]
    df = docs(texts).select("doc_id", "text", F.when(F.col("doc_id") < 26, "b").when(F.col("doc_id") == 26, "a").otherwise("c").alias("source"))
    rows = mixing.mix(spark, df).where("source_size > 2").collect()
    assert len(rows) == 26 and abs(sum(r["taken"] for r in rows) - rows[0]["target"]) < rows[0]["target"] / 1000


def water(sizes):
    """Targets by sharing the excess again until none is above its limit."""
    w = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    target, full, total = [0.0] * len(sizes), set(), float(sum(sizes))
    while len(full) < len(sizes):
        rest = [i for i in range(len(sizes)) if i not in full]
        left = total - sum(3 * sizes[i] for i in full)
        for i in rest:
            target[i] = left * w[i] / sum(w[j] for j in rest)
        over = [i for i in rest if target[i] > 3 * sizes[i]]
        if not over:
            break
        full |= set(over)
    for i in full:
        target[i] = 3.0 * sizes[i]
    return target


def test_targets_against_loop(spark):
    rng = random.Random(4)
    for _ in range(5):
        sizes = [rng.choice([0, 1, 5, 100, 1000]) * rng.randint(1, 9) for _ in range(rng.randint(1, 9))]
        df = spark.createDataFrame([(f"s{i}", x) for i, x in enumerate(sizes)], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(common.Scratch(spark, "t"), df).collect()}
        assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(water(sizes))


def test_mix(spark, docs):
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(300)] + [None, " ", "a\x1cb c d"] + ["five words are in this"] * 30
    source = [rng.choice(["b", "a", "\U0001f600", "～", None]) for _ in texts]
    df = docs(texts, source=source)
    rows = mixing.mix(spark, df).collect()
    assert len(rows) == len(texts) and next(r["size"] for r in rows if r["doc_id"] == 302) == 2
    names = ["a", "b", "～", "\U0001f600", None]
    size = {n: sum(r["size"] for r in rows if source[r["doc_id"]] == n) for n in names}
    goal = dict(zip(names, water([size[n] for n in names])))
    for n in names:
        own = [r for r in rows if source[r["doc_id"]] == n]
        assert all(r["source_size"] == size[n] and r["target"] == pytest.approx(goal[n]) for r in own)
        assert abs(sum(r["taken"] for r in own) - goal[n]) <= 1
        assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in own)
    assert same_rows(mixing.mix(spark, df), mixing.mix(spark, df.repartition(5)))
    out = mixing.mixed(spark, df)
    assert out.columns == df.columns
    times = {r["doc_id"]: r["taken"] // r["size"] for r in rows if r["taken"]}
    assert {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == times


def test_mixed_rows_that_repeat(spark, docs):
    rng = random.Random(10)
    texts = ["one two three"] * 40 + [prose(rng, 5) for _ in range(9)] + [None, " "]
    ids = [3] * 40 + list(range(100, 111))
    df = docs(texts, ids, source=["a"] * 30 + [None] * 10 + ["b"] * 9 + ["c", "c"]).withColumnRenamed("n_chars", "base").withColumnRenamed("h1", "once")
    out = mixing.mixed(spark, df)
    assert out.columns == df.columns
    want = {}
    for r in mixing.mix(spark, df).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + (r["taken"] // r["size"] if r["size"] else 0)
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert mixing.mix(spark, docs([])).count() == 0 and mixing.mixed(spark, docs([])).count() == 0


# ---- tokens ----
def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1000):
        values = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        counts = np.array([n // 2, n - n // 2], np.int64)
        block = tokens.encode_block(values, counts, np.array([5, tokens.NULL]))
        v, c, i = tokens.decode_block(block)
        assert (v == values).all() and (c == counts).all() and i.tolist() == [5, tokens.NULL]
        with pytest.raises(ValueError):
            tokens.decode_block(block[:-1] + bytes([block[-1] ^ 1]))


@functools.cache
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def reference_ids(text):
    return np.array([*library().encode(text or "", add_special_tokens=False).ids, 0], "<u4")


ODD = ["a  b", "a\n \nb", " lead", "trail ", "a\n b", "a \n\nb", "x's y'll", "tab\tq", "é ü\nß 12,3 a.b", "", None, "<|endoftext|> hi", "a b c", "a\x1cb", "a\x00b c", "日本 語。 ½ ²", "word. Word!? (x) don't", "a" * 5000]


def test_tokens_against_the_library(spark, docs):
    df = docs(ODD, [i * 7 % 18 for i in range(len(ODD))])
    rows = tokens.encode_documents(spark, df, tokens=64, partitions=3).orderBy("doc_id").collect()
    at, by = 0, {i * 7 % 18: t for i, t in enumerate(ODD)}
    for r in rows:
        ids = reference_ids(by[r["doc_id"]])
        assert tuple(r) == (r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(rows) == len(ODD)


def test_tokens_with_other_white_space():
    import public_tokenizers

    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    spaces = ["\xa0", "\t", "\r", "\u3000", "\x0b", "\x0c", "\x85", "\u2028", "\u2009", "\x1c"]
    texts = [f"a{x}{y}{z}b c" for x in [" ", "\n"] for y in spaces for z in [*spaces, "", " ", "\n", "d "]]
    for t in [*texts, *texts]:
        assert np.frombuffer(e(t), e.kind).tolist() == reference_ids(t)[:-1].tolist(), repr(t)


def test_tokens_of_random_texts():
    """The library itself, on all white space, marks and added tokens side by side."""
    import public_tokenizers

    e, t, rng = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json")), library(), random.Random(15)
    signs = [" ", "\n", " ", "\n", "\t", "\r", "\xa0", "\u3000", "\x0b", "\x1c", "\x85", "\u2028", "a", "b", "Word", "é", "日", "1", "23", "'s", "'", ".", "!?", "<|endoftext|>", "½", "\x00", "\u200b", "\U0001f600", "_"]
    for _ in range(20_000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 9)))
        assert np.frombuffer(e(text), e.kind).tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_tokens_odd_rows(spark, docs):
    rows = tokens.encode_documents(spark, docs(["a", "a", "b"], [3, 3, None])).orderBy("start").collect()
    assert [(r["doc_id"], r["start"]) for r in rows] == [(None, 0), (3, 2), (3, 4)]
    assert tokens.encode_documents(spark, docs([])).count() == 0


# ---- language ----
def texts_of(rng, letters, n):
    return [" ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30)) for _ in range(n)]


def test_language(spark, docs):
    rng = random.Random(6)
    kinds = {"aa": "abcde", "ab": "abcdf", "zy": "vwxyz", "zx": "vwxyu"}
    texts, langs = [], []
    for k, letters in kinds.items():
        texts += texts_of(rng, letters, 40)
        langs += [k] * 40
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts, langs = [texts[i] for i in order], [langs[i] for i in order]
    texts += [None, "", "12 !?", texts[0] * 3]
    langs += ["aa", None, "zy", None]
    df = docs(texts, [*range(len(texts) - 1), None], lang=langs)
    rows = {r["doc_id"]: r for r in language.identify(spark, df).collect()}
    held = [i for i in range(160) if rows[i]["held_out"]]
    assert held == [i for i in range(160) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i]["lang_pred"] == langs[i] for i in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[i]["lang_pred"] for i in (160, 161, 162)] == ["und"] * 3 and rows[None]["lang_pred"] == langs[0]
    model = language.Model([], [])
    assert model.predict(language.profile("abc")) == ("und", 0.0)


def test_families_join_like_languages():
    mean = np.array([[1, 0, 0.1], [1, 0.1, 0], [0, 1, 1], [0.1, 1, 1.0]])
    assert sorted(language.families(list("abcd"), mean)) == [[0, 1], [2, 3]]


def test_profile_is_whole_in_chunks(monkeypatch):
    text = "Één tekst, 12 woorden lang! " * 50
    a = language.profile(text)
    monkeypatch.setattr(language, "CHUNK", 17)
    assert np.allclose(a, language.profile(text))


# ---- quality ----
def test_contexts_against_loop(spark, docs, monkeypatch):
    rng = random.Random(7)
    texts = [prose(rng, n) for n in (0, 1, 2, 3, 50, 200)] + [None]
    index = quality.index_vectors(quality.BUCKETS).astype(int)
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for t in texts:
        w = [quality.bucket(x) for x in (t or "").split()]
        for i in range(len(w)):
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if i != j:
                    want[w[i]] += index[w[j]]
    norm = np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-12)
    assert np.allclose(quality.contexts(docs(texts)), want / norm, atol=1e-6)


def plain_features(text, table):
    """One vector a document, by plain loops over its words."""
    words = text.split() if text else []
    kinds = sorted(set(words))
    mean = lambda some: sum((table[quality.bucket(w)].astype(float) for w in some), np.zeros(quality.DIM)) / max(len(some), 1)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return np.concatenate([mean(words), mean(kinds), [np.log1p(len(words)) / 10, len(kinds) / len(words) if words else 0, repeats / max(len(words), 1)]])


@pytest.mark.parametrize("cache", [200_000, 7])
def test_features_against_loop(cache, monkeypatch):
    monkeypatch.setattr(quality, "CACHE", cache)
    rng = random.Random(19)
    table = np.random.default_rng(1).random((quality.BUCKETS, quality.DIM)).astype(np.float32)
    own = quality.Pooler(table)
    for t in [None, "", "a", "a a b", *[prose(rng, rng.randint(1, 90)) for _ in range(30)], " ".join(f"v{i % 700}" for i in range(40_000))]:
        assert np.allclose(own.features(t), plain_features(t, table), atol=1e-4)


def test_network_against_plain_steps():
    """The same split, steps and choice of the epoch, one row at a time."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((120, 5))
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.standard_normal(120) > 0).astype(float)
    net = quality.Network(x, y, hidden=4, passes=3)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    logit = [sum(np.tanh(sum(r[i] * net.p[0][i, j] for i in range(5)) + net.p[1][j]) * net.p[2][j] for j in range(4)) + net.p[3][0] for r in z]
    assert np.allclose(net.score(x), [1 / (1 + np.exp(-v / net.temperature)) for v in logit])
    order = np.random.default_rng(42).permutation(120)
    last = order[18:36]
    loss = lambda t: np.mean([np.log1p(np.exp(-(2 * y[i] - 1) * logit[i] / t)) for i in last])
    assert loss(net.temperature) <= min(loss(t) for t in np.exp(np.linspace(-2, 3, 101))) + 1e-9


def test_repeated_and_long_documents_of_a_label(spark, docs):
    rng = random.Random(21)
    texts = [prose(rng, 30) if i % 2 else "".join(rng.choices("xyz ", k=90)) for i in range(60)] + ["long " * 300_000] * 2
    df = docs(texts, [*range(60), 1, 1])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    rows = quality.classify(spark, df, labels).collect()
    assert len(rows) == 62 and all(0 <= r["score"] <= 1 for r in rows)
    again = quality.classify(spark, df.repartition(5), labels).collect()
    assert np.allclose(sorted(r["score"] for r in rows), sorted(r["score"] for r in again), atol=1e-3)


def test_labels_of_absent_documents_take_no_place(spark, docs):
    rng = random.Random(4)
    df = docs([prose(rng, 20) if i % 2 else "!! ? " * 9 for i in range(60)])
    labels = spark.range(5000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    _, few = quality.learned(spark, df, labels.where("doc_id < 60"), sample=60)
    _, all_ = quality.learned(spark, df, labels, sample=60)
    assert few.ready and all_.ready and np.allclose(few.p[0], all_.p[0])


def test_quality(spark, docs):
    rng = random.Random(8)
    texts = [prose(rng, 40) if i % 3 else "!! ".join(prose(rng, 40).upper().split(" ")) for i in range(240)] + [None, "", "word"]
    df = docs(texts, [*range(len(texts) - 1), None])
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(0, 240)] + [(None, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.classify(spark, df, labels).collect()}
    held = [i for i in range(240) if rows[i]["held_out"]]
    assert held == [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([rows[i]["predicted"] == int(i % 3 > 0) for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())
    assert {r["score"] for r in quality.classify(spark, df, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(spark, docs([]), labels).count() == 0
    kept = quality.accepted(spark, df, labels)
    assert kept.columns == df.columns and 60 < 240 - kept.where("doc_id < 240").count() < 100


# ---- pipeline ----
def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    if not os.path.isdir(DIR):
        pytest.skip("no test tables")
    docs = start = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DIR).write.parquet(f"file://{tmp_path}/{i}")
        docs = spark.read.parquet(f"file://{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == start.columns
            assert docs.join(start, start.columns, "left_anti").count() == 0
        kept.append({r[0] for r in docs.select("doc_id").distinct().collect()})
    assert kept[0] >= kept[1] >= kept[2] >= kept[3] == kept[4]
    bad = {r[0] for r in spark.read.parquet(f"{DIR}/labels.parquet").where("quality = 0").collect()}
    good = {r[0] for r in spark.read.parquet(f"{DIR}/labels.parquet").where("quality = 1").collect()}
    assert len(bad & kept[0]) <= 0.2 * len(bad) and len(good - kept[0]) <= 0.05 * len(good)
    texts = spark.read.parquet(f"file://{tmp_path}/2").groupBy("text").count().where("count > 1")
    assert texts.count() == 0
    mix = spark.read.parquet(f"file://{tmp_path}/3").orderBy("doc_id", "text").collect()
    ids = [reference_ids(r["text"]) for r in mix]
    rows = spark.read.parquet(f"file://{tmp_path}/4").orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows] == [(m["doc_id"], len(x), zlib.crc32(x.tobytes())) for m, x in zip(mix, ids)]


# ---- language: what is learned, against plain loops ----
def plain_profile(text):
    signs, last = [], True
    for c in text.lower():
        letter = c.isalpha()
        if letter or not last:
            signs.append(ord(c) if letter else 32)
        last = not letter
    if not any(x != 32 for x in signs):
        return None
    counts = np.zeros(language.SIZE)
    for n, mul in ((1, 1), (2, 0x9E3779B1), (3, 0x85EBCA77)):
        for i in range(len(signs) - n + 1):
            h = 0
            for x in signs[i : i + n]:
                h = ((h ^ x) * 0x01000193 + mul) & 0xFFFFFFFF
            counts[(h ^ h >> 15) % language.SIZE] += 1
    return np.sqrt(counts / counts.sum())


def test_profile_against_loop():
    rng = random.Random(16)
    for t in ["a", "Ab, c!", " x ", "12", "\n", "勱", "掭", "輖", "㺱", *["".join(rng.choices("abé Ü1,\n日", k=40)) for _ in range(50)]]:
        got, want = language.profile(t), plain_profile(t)
        assert (got is None) == (want is None) and (want is None or np.allclose(got, want)), repr(t)


def test_repeated_rows_take_no_other_language_away(spark, docs):
    rng = random.Random(17)
    fr = texts_of(rng, "fghij", 60)
    texts = [texts_of(rng, "abcde", 1)[0]] * 3000 + fr + texts_of(rng, "abcde", 30)
    langs = ["en"] * 3000 + ["fr"] * 60 + ["en"] * 30
    df = docs(texts, [7] * 3000 + list(range(100, 190)), lang=langs).withColumnRenamed("doc_id", "key")
    got = language.chosen(common.Scratch(spark, "t"), df, 40, 42).collect()
    assert {k: sum(r["lang"] == k for r in got) for k in ("en", "fr")} == {"en": 20, "fr": 20}
    assert len({r["text"] for r in got}) == 40
    # more languages than the sample has rows: those with most rows
    many = docs([f"t{i}" for i in range(30)], lang=[f"l{i // 3:02}" for i in range(30)]).union(docs(["x", "y"], [90, 91], lang=["l05", "l07"])).withColumnRenamed("doc_id", "key")
    assert sorted(r["lang"] for r in language.chosen(common.Scratch(spark, "t"), many, 3, 42).collect()) == ["l00", "l05", "l07"]


def test_votes_against_loop():
    rng = np.random.default_rng(18)
    x = [(np.sort(rng.choice(language.SIZE, 9, False)).astype(np.int32), rng.random(9).astype(np.float32)) for _ in range(60)]
    model = language.Model(x, [f"l{i % 6}" for i in range(60)])
    for at, v in x:
        whole = np.zeros(language.SIZE + 1)
        whole[at], whole[-1] = v, 1
        g = int(np.argmax([w @ whole for w in model.family]))
        wins, margins = {i: 0 for i in model.groups[g]}, {i: 0.0 for i in model.groups[g]}
        for (a, b), w in model.pairs.items():
            if a in wins:
                wins[a if w @ whole >= 0 else b] += 1
                margins[a] += w @ whole
                margins[b] -= w @ whole
        want = sorted(wins, key=lambda i: (-wins[i], -margins[i], i))[0]
        name, score = model.predict(whole[:-1])
        assert name == model.names[want] and 0 <= score <= 1


def test_language_odd_rows(spark, docs):
    assert language.identify(spark, docs([])).count() == 0
    rows = language.identify(spark, docs(["abc abc", "abc abc", "x" * 600_000, None], [1, 1, 2, 2], lang=["aa", "aa", "bb", "bb"])).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in rows) == [(1, "aa"), (1, "aa"), (2, "bb"), (2, "und")]
