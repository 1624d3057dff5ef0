"""Quality classifier over pooled random-indexing word vectors.

Random indexing: a word's index vector is a sparse ternary vector that follows from its hash, and
its context vector is the sum, over the whole corpus, of the index vectors of its neighbours. Words
share a fixed number of context vectors by hash (BUCKETS of 192 bytes: 6.3 MB), so the table is
bounded; sums are of integers, so they are the same in any order. A word's vector is its context
vector, scaled to length 1. A document is the mean over its words and the mean over its distinct
words, beside its length and its shares of new and of repeated words. A network of two layers
scores it; its logits are divided by a temperature fitted on labels that neither training nor the
choice of the epoch saw.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, tidy

BUCKETS, DIM, SPARSE = (1 << 15) - 1, 48, 6
FEATURES = 2 * DIM + 3
CACHE = 200_000
CHUNK = 1 << 17


def index_vectors(n: int, dim: int = DIM, seed: int = 42) -> np.ndarray:
    """n sparse ternary vectors: SPARSE places, half of them 1 and half -1."""
    rng, out = np.random.default_rng(seed), np.zeros((n, dim), np.int8)
    places = rng.permuted(np.tile(np.arange(dim), (n, 1)), axis=1)[:, :SPARSE]
    out[np.arange(n)[:, None], places] = np.tile([1, -1], SPARSE // 2)
    return out


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


class Ids(dict):
    """Words' buckets; starts anew once it is large."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = found = bucket(word)
        return found


def contexts(docs: DataFrame, text: str = "text", reach: int = 2) -> np.ndarray:
    """The context vectors of all words of all documents: BUCKETS rows go to the driver."""

    def count(batches):
        import pandas as pd

        index, total, ids = index_vectors(BUCKETS).astype(np.int16), np.zeros((BUCKETS, DIM), np.int64), Ids()

        def add(at):
            """Sums the neighbours' index vectors at each place, then those of places of one word."""
            own = index[at]
            near = np.zeros_like(own)
            for step in range(1, reach + 1):
                near[:-step] += own[step:]
                near[step:] += own[:-step]
            order = np.argsort(at.astype(np.uint16), kind="stable")
            key = at[order]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            total[key[starts]] += np.add.reduceat(near[order], starts, axis=0, dtype=np.int32)

        # documents follow each other with `reach` empty places between, whose index vector is zero
        index = np.vstack([index, np.zeros((1, DIM), np.int16)])
        total = np.vstack([total, np.zeros((1, DIM), np.int64)])
        gap, held, size = np.full(reach, BUCKETS), [], 0
        for p in batches:
            for t in p["t"]:
                words = t.split() if t else []
                for at in range(0, len(words), CHUNK):
                    part = words[max(0, at - reach) : at + CHUNK] if at else words[:CHUNK]
                    x = np.fromiter(map(ids.__getitem__, part), np.int64, len(part))
                    if at:  # pairs of the words before the cut are counted already
                        add_overlap(total, index, x[:reach], reach)
                    held += [x, gap]
                    size += len(x) + reach
                    if size > CHUNK:
                        add(np.concatenate(held))
                        held, size = [], 0
        if held:
            add(np.concatenate(held))
        some = np.flatnonzero(total[:BUCKETS].any(1))
        yield pd.DataFrame({"b": some, **{f"d{i}": total[some, i] for i in range(DIM)}})

    def add_overlap(total, index, x, reach):
        for step in range(1, reach):
            for a, b in ((x[:-step], x[step:]), (x[step:], x[:-step])):
                np.subtract.at(total, a, index[b].astype(np.int64))

    names = [f"d{i}" for i in range(DIM)]
    # one row for each bucket
    parts = docs.select(F.col(text).alias("t")).mapInPandas(count, "b long, " + ", ".join(f"{n} long" for n in names))
    out = np.zeros((BUCKETS, DIM), np.float32)
    got = parts.groupBy("b").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    sums = np.stack([got.column(n).to_numpy() for n in names], 1).astype(np.float64).reshape(-1, DIM)
    out[got.column("b").to_numpy()] = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return out


class Places(dict):
    """A place for each word, given as it is first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self)
        self.new.append(word)
        return found


class Pooler:
    """Features of texts: DIM for all words, DIM for distinct ones, the length, and the shares of
    words that are new and that repeat the word before."""

    def __init__(self, table: np.ndarray):
        self.table, self.places, self.rows = table, Places(), np.zeros((1024, DIM), np.float32)

    def learn(self) -> None:
        """Vectors of the words that have just got their place."""
        new, self.places.new = self.places.new, []
        if new:
            end = len(self.places)
            while end > len(self.rows):
                self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
            self.rows[end - len(new) : end] = self.table[[bucket(w) for w in new]]

    def features(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        total, kind, kinds = np.zeros(DIM), np.zeros(DIM), len(set(words))
        if len(self.places) + kinds > CACHE:
            self.places.clear()
        if kinds <= CACHE:
            at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            self.learn()
            places, counts = np.unique(at, return_counts=True)
            for a in range(0, len(places), CHUNK // 8):
                rows = self.rows[places[a : a + CHUNK // 8]]
                total += counts[a : a + CHUNK // 8].astype(np.float32) @ rows
                kind += rows.sum(0)
        else:  # too many kinds to keep at once: part by part, each kind with its count
            counted = list(Counter(words).items())
            for a in range(0, kinds, CHUNK // 8):
                self.places.clear()
                part = counted[a : a + CHUNK // 8]
                at = [self.places[w] for w, _ in part]
                self.learn()
                total += np.array([c for _, c in part], np.float32) @ self.rows[at]
                kind += self.rows[at].sum(0)
        n, k = max(len(words), 1), max(kinds, 1)
        return np.concatenate([total / n, kind / k, [np.log1p(len(words)) / 10, k / n if words else 0.0, sum(map(eq, words, islice(words, 1, None))) / n]])


_poolers: dict[int, Pooler] = {}


def pooler(table: np.ndarray) -> Pooler:
    """One for each table and worker process, which serves many tasks."""
    key = zlib.crc32(table.tobytes())
    if key not in _poolers:
        _poolers.clear()
        _poolers[key] = Pooler(table)
    return _poolers[key]


class Network:
    """Two layers, tanh and logistic, by Adam. Of the rows, 70 % train, 15 % choose the epoch, and
    15 % fit the temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, passes: int = 60, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (0.0, 1.0)
        self.temperature, self.prior = 1.0, float(y.mean()) if len(y) else 0.5
        self.ready = 0 < y.sum() < len(y)
        if not self.ready:
            return
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(x))
        part = len(x) * 3 // 20
        held, last, own = order[:part], order[part : 2 * part], order[2 * part :]
        self.p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        m, v, step = [0 * a for a in self.p], [0 * a for a in self.p], 0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) ** 0.5
        best, kept = np.inf, None
        for _ in range(passes):
            for at in range(0, len(own), 256):
                i = rng.permutation(own)[:256] if len(own) < 256 else own[at : at + 256]
                h = np.tanh(x[i] @ self.p[0] + self.p[1])
                e = (1 / (1 + np.exp(-(h @ self.p[2] + self.p[3]))) - y[i]) * weight[i] / len(i)
                d = np.outer(e, self.p[2]) * (1 - h * h)
                grads, step = [x[i].T @ d + 1e-4 * self.p[0], d.sum(0), h.T @ e, np.array([e.sum()])], step + 1
                for a, g, mm, vv in zip(self.p, grads, m, v):
                    mm += 0.1 * (g - mm)
                    vv += 0.001 * (g * g - vv)
                    a -= 0.003 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
            own = rng.permutation(own)
            if len(held):
                z = self.logits(x[held])
                loss = float(np.mean(np.logaddexp(0, z) - y[held] * z))
                if loss < best:
                    best, kept = loss, [a.copy() for a in self.p]
        self.p = kept or self.p
        if len(last):
            z = self.logits(x[last])
            grid = np.exp(np.linspace(-2, 3, 101))
            self.temperature = float(min(grid, key=lambda t: np.mean(np.logaddexp(0, z / t) - y[last] * z / t)))

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.ready:
            return np.full(len(x), self.prior)
        z = self.logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def learned(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = 12_000, seed: int = 42) -> tuple[np.ndarray, Network]:
    """The table of context vectors, from all of docs, and the network, from the `sample` labelled
    doc_ids at most that have the smallest seeded hash (features of 400 bytes each go to the
    driver). Where rows repeat a doc_id, the text with the smallest hash stands for it. Rows with
    null doc_id, null label, or labels that contradict each other, are left out."""
    table = contexts(docs)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("top")).where("y = top")
    # labels of documents that are not there take nobody's place
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("k"), "y")
    shared = spark.sparkContext.broadcast(table)

    def pooled(batches):
        import pandas as pd

        own = pooler(shared.value)
        for p in batches:
            yield pd.DataFrame({"k": p["k"], "y": p["y"], "x": [own.features(t).astype("<f4").tobytes() for t in p["text"]]})

    # the labels are `sample` rows of two numbers at most
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("k"))
    rows = rows.groupBy("k").agg(F.min("y").alias("y"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("k", "y", "t.text")
    got = rows.mapInPandas(pooled, "k long, y int, x binary").orderBy("k").collect()
    x = np.array([np.frombuffer(r["x"], "<f4") for r in got], np.float64).reshape(len(got), FEATURES)
    y = np.array([r["y"] for r in got], np.float64)
    del got
    network = Network(x, y)
    del x
    tidy()  # the driver keeps what it frees otherwise, through all stages of the pipeline
    return table, network


def scored(docs: DataFrame, table: np.ndarray, network: Network, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score of each whole text (0 to 1; null and blank texts have one too)."""
    import pandas as pd

    shared = docs.sparkSession.sparkContext.broadcast((table, network))

    def of(series):
        own = pooler(shared.value[0])
        for s in series:
            yield pd.Series(shared.value[1].score(np.array([own.features(t) for t in s]).reshape(len(s), FEATURES)))

    of.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(out, F.pandas_udf(of, "double")(F.col(text)))


def fold(doc_id: str, folds: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, folds: int = 3, out_fold: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs; labels of rows whose crc32 of
    the doc_id as text leaves the remainder `out_fold` are not learned from. Without labels of
    both kinds, the score is the share of label 1 (0.5 without labels). A null doc_id is not held
    out. Repeated doc_ids are rows like any other. An empty table gives an empty result. Other
    columns are ignored, whatever they are named."""
    own = docs.select("doc_id", "text")
    table, network = learned(spark, own, labels.where(fold("doc_id", folds) != out_fold))
    held = F.coalesce(fold("doc_id", folds) == out_fold, F.lit(False))
    found = scored(own, table, network)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(spark: SparkSession, docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs, as they are, that score at least `least`."""
    table, network = learned(spark, docs.select("doc_id", "text"), labels)
    rows = docs.select(F.struct("*").alias("row"), "text")
    return scored(rows, table, network).where(F.col("score") >= least).select("row.*")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op3_quality_classifier": op3}
SQL: dict[str, str] = {}
