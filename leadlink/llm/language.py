"""Language identification in two steps: the family first, then the language within it.

Families are found from the training texts: languages whose mean n-gram profiles are alike are
merged until about the square root of their number remains. A linear classifier tells families
apart; within a family, one linear support vector machine for each pair of languages votes, and
the sum of margins decides between equal votes. Texts enter as counts of hashed character
1- to 3-grams of their lower-cased letters, over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

SIZE = 1 << 13
CHUNK = 1 << 18
UNDETERMINED = "und"


def profile(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts, square-rooted and of length 1; None without a letter. White space
    and everything else that is not a letter become one border sign."""
    if not text:
        return None
    counts, tail = np.zeros(SIZE), np.zeros(0, np.uint32)
    border, any_letter = True, False
    for at in range(0, len(text), CHUNK):
        piece = text[at : at + CHUNK].lower()
        code = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), "<u4")
        letter = letters(code)
        any_letter |= bool(letter.any())
        code = np.where(letter, code, 32)
        keep = letter | np.concatenate([[not border], letter[:-1]])  # the first of each run of borders
        border = not letter[-1]
        code = code[keep]
        c = np.concatenate([tail, code])
        new = len(tail)
        for n, mul in ((1, 1), (2, 0x9E3779B1), (3, 0x85EBCA77)):
            begin = max(0, new - n + 1)
            if len(c) - begin < n:
                continue
            h = np.zeros(len(c) - begin - n + 1, np.uint32)
            for i in range(n):
                h = (h ^ c[begin + i : len(c) - n + 1 + i]) * np.uint32(0x01000193) + np.uint32(mul)
            counts += np.bincount((h ^ (h >> np.uint32(15))) & np.uint32(SIZE - 1), minlength=SIZE)
        tail = c[-2:]
    if not any_letter:
        return None
    norm = np.sqrt(counts.sum())
    return np.sqrt(counts) / norm


_letter = np.zeros(0, bool)


def letters(code: np.ndarray) -> np.ndarray:
    """Which code points are letters, by a table made once for each process."""
    global _letter
    if not len(_letter):
        _letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letter[code]


def svm(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, c: float = 10.0, passes: int = 60, seed: int = 42) -> np.ndarray:
    """Weights, and last the bias, of a linear SVM (hinge loss, L2) by dual coordinate descent over
    sparse rows (places, values); y is -1 or 1."""
    w, bias, alpha, order = np.zeros(SIZE), 0.0, np.zeros(len(x)), np.random.default_rng(seed)
    q = [float(v @ v) + 1 for _, v in x]
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(x)):
            at, v = x[i]
            g = y[i] * (w[at] @ v + bias) - 1
            a = min(max(alpha[i] - g / q[i], 0.0), c)
            if a != alpha[i]:
                step = (a - alpha[i]) * y[i]
                w[at] += step * v
                bias += step
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-3:
            break
    return np.append(w, bias)


def families(names: list[str], mean: np.ndarray) -> list[list[int]]:
    """Average-link merging by cosine, down to about the square root of the number of languages."""
    groups = [[i] for i in range(len(names))]
    if len(groups) <= 2:
        return [list(range(len(names)))] if groups else []
    centred = mean - mean.mean(0)
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    like = centred @ centred.T
    while len(groups) > max(2, round(np.sqrt(len(names)))):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: np.mean([like[i, j] for i in groups[p[0]] for j in groups[p[1]]]))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


class Model:
    """Learned from profiles and language names."""

    def __init__(self, x: list[tuple[np.ndarray, np.ndarray]], langs: list[str]):
        self.names = sorted(set(langs))
        y = np.array([self.names.index(v) for v in langs])
        if not self.names:
            return
        mean = np.zeros((len(self.names), SIZE))
        for (at, v), i in zip(x, y):
            mean[i, at] += v
        mean /= np.bincount(y)[:, None]
        self.groups = families(self.names, mean)
        of = np.array([next(g for g, members in enumerate(self.groups) if i in members) for i in range(len(self.names))])
        self.family = np.array([svm(x, np.where(of[y] == g, 1.0, -1.0)) for g in range(len(self.groups))]) if len(self.groups) > 1 else None
        self.pairs = {}
        for g in self.groups:
            for a, b in combinations(g, 2):
                some = np.flatnonzero((y == a) | (y == b))
                self.pairs[a, b] = svm([x[i] for i in some], np.where(y[some] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray | None) -> tuple[str, float]:
        if x is None or not self.names:
            return UNDETERMINED, 0.0
        x, sure, g = np.append(x, 1.0), 1.0, 0
        if self.family is not None:
            m = self.family @ x
            g = int(m.argmax())
            sure = squash(m[g])
        members = self.groups[g]
        votes, margin = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        least = {}
        for a, b in combinations(members, 2):
            m = float(self.pairs[a, b] @ x)
            win = a if m >= 0 else b
            votes[win] += 1
            margin[a], margin[b] = margin[a] + m, margin[b] - m
            for k, v in ((a, m), (b, -m)):
                least[k] = min(least.get(k, np.inf), v)
        best = max(members, key=lambda i: (votes[i], margin[i], -i))
        return self.names[best], sure * squash(least.get(best, np.inf))


def squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-min(4 * margin, 50.0))))


def profiled(rows: DataFrame) -> DataFrame:
    """lang with the places and values of the profile that are not zero."""

    def of(batches):
        import pandas as pd

        for p in batches:
            x = [profile(t) for t in p["text"]]
            some = [i for i, v in enumerate(x) if v is not None]
            at = [np.flatnonzero(x[i]).astype(np.int32) for i in some]
            yield pd.DataFrame({"lang": p["lang"].to_numpy()[some], "at": [a.tobytes() for a in at], "v": [x[i][a].astype(np.float32).tobytes() for i, a in zip(some, at)]})

    return rows.select("text", "lang").mapInPandas(of, "lang string, at binary, v binary")


def chosen(scratch: Scratch, rows: DataFrame, sample: int, seed: int) -> DataFrame:
    """lang and text of the rows that are learned from (see fit)."""
    h = [F.xxhash64(F.lit(seed + i), "key", "text").alias(f"h{i}") for i in range(2)]
    rows = rows.where("lang is not null and text is not null").select("lang", "text", *h)
    kinds = scratch.table(rows.select("lang", "h0", "h1").distinct(), "kinds")
    counts = kinds.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "lang").limit(sample)
    counts = scratch.table(counts, "counts")
    most = max(1, sample // max(1, counts.count()))
    # different rows have uniform hashes: about 2 x `most` of a language lie below this, and only they are ranked
    under = F.least(F.lit(1.0), F.lit(2.0 * most + 100) / F.col("c"))
    low = kinds.join(F.broadcast(counts.select(F.col("lang").alias("l"), under.alias("under"))), F.col("lang") == F.col("l"))
    low = low.where((F.col("h0") / 2.0**64 + 0.5) <= F.col("under")).select("lang", "h0", "h1")
    first = low.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h0", "h1"))).where(F.col("r") <= most).drop("r")
    # `sample` rows of two hashes at most
    return rows.join(F.broadcast(scratch.table(first, "first")), ["lang", "h0", "h1"]).groupBy("lang", "h0", "h1").agg(F.min("text").alias("text")).select("lang", "text")


def fit(rows: DataFrame, sample: int = 4000, seed: int = 42) -> Model:
    """Learns from (key, text, lang) rows with a language. Rows that repeat all three count once. Of
    each language it takes the `sample` / number of languages rows, at most, that have the smallest
    seeded hash of key and text; of over `sample` languages, the `sample` that have most rows (ties
    by name). So `sample` profiles, of 64 KB at most each, go to the driver, however rows repeat."""
    scratch = Scratch(rows.sparkSession, "language")
    got = profiled(chosen(scratch, rows, sample, seed)).orderBy("lang", "at", "v").collect()
    scratch.drop()
    return Model([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["v"], np.float32)) for r in got], [r["lang"] for r in got])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred and score (0 to 1) by whole texts. Null texts and texts without a letter are
    undetermined, with score 0, as is everything if no language was learned."""
    import pandas as pd

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of(series):
        for s in series:
            got = [shared.value.predict(profile(t)) for t in s]
            yield pd.DataFrame({"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]})

    of.__annotations__ = {"series": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    out = F.pandas_udf(of, "lang_pred string, score double")
    return docs.select(F.struct("*").alias("row"), out(F.col(text)).alias("p")).select("row.*", "p.lang_pred", "p.score")


def identify(spark: SparkSession, docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs, learned from those rows with a
    language whose crc32 of the doc_id as text leaves another remainder than `fold`. Rows with a
    null doc_id are not held out and not learned from. Only text enters a prediction. Other
    columns are ignored, whatever they are named; an empty table gives an empty result."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    own = docs.select("doc_id", "text", "lang", F.coalesce(rest == fold, F.lit(False)).alias("held_out"))
    model = fit(own.where(~F.col("held_out") & F.col("doc_id").isNotNull()).withColumnRenamed("doc_id", "key"))
    return predict(own.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op9_language_id": op9}
SQL: dict[str, str] = {}
