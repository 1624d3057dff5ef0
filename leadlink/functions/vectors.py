"""Vectors as array columns: length 1, dot product, cosine score; the best of a matrix of scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: Column) -> Column:
    """Length 1; null for zero vectors and those with null or non-finite components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.sqrt(dot(v, v))
    return F.when(v.isNull() | bad | (norm == 0), None).otherwise(F.transform(v, lambda x: F.round(x.cast("double") / norm, 8)))


def score(a: Column, b: Column) -> Column:
    """Cosine of unit vectors, times 100."""
    return dot(a, b) * 100


def nan_as_zero(s: Column) -> Column:
    """A score that is null or not a number counts as 0."""
    return F.coalesce(F.nanvl(s, F.lit(None).cast("double")), F.lit(0.0))


def matrix(vectors) -> np.ndarray:
    """Vectors of one length, as rows."""
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1) if len(vectors) and len(vectors.iloc[0]) else np.zeros((len(vectors), 0))


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def best_products(x: np.ndarray, y: np.ndarray, leads: np.ndarray, ids: np.ndarray, k: int, gate: float, distinct_ids: bool = False, seen: Iterator | None = None, rows: int = 256) -> Iterator[tuple]:
    """(i, j, score) of the k best rows of y for each row of x, of scores (dot product times 100) of at
    least the gate; ties go to the smaller j, and NaN goes first, as in SQL.

    A matrix product, of `rows` rows of x at a time, tells what can be among the best; that is
    scored again component by component, as dot() does, so that equal vectors tie and every
    score is that of comparing the pair. seen(part): that product, where only some of it is formed."""
    xt, yt = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    # more than the product and the sum in order can differ by
    far = lengths(y)
    slack = np.nan_to_num(1e-9 * lengths(x) * far[np.isfinite(far)].max(initial=0.0), nan=0.0, posinf=0.0)
    for at in range(0, len(x), rows):
        own = slice(at, at + rows)
        with np.errstate(invalid="ignore", over="ignore"):
            s = x[own] @ yt * 100 if seen is None else seen(own)
            s[np.isnan(s)] = np.inf
            if distinct_ids:
                s[leads[own, None] == ids] = -np.inf
            last = np.partition(s, len(y) - k, axis=1)[:, len(y) - k] if len(y) > k else np.full(len(s), -np.inf)
            limit = np.maximum(last, gate) - slack[own]
            i, j = np.nonzero((s >= limit[:, None]) & (s > -np.inf))
            raw = np.zeros(len(i))
            for a, b in zip(xt[:, own], yt):
                raw += a[i] * b[j]
            raw *= 100
            keep = (raw >= gate) | np.isnan(raw)
        i, j, raw = i[keep], j[keep], raw[keep]
        order = np.lexsort((j, -np.where(np.isnan(raw), np.inf, raw), ~np.isnan(raw), i))
        i, j, raw = i[order], j[order], raw[order]
        start = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
        place = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
        yield at + i[place < k], j[place < k], raw[place < k]
