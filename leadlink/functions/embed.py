"""Text to vector: hashed character n-grams by default, any callable on batches otherwise.

The default needs no model; its scores are not those of a trained one."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 64


def hashed(texts: list[str]) -> list[list[float] | None]:
    out = []
    for t in texts:
        v, s = np.zeros(DIM), f" {t.lower()} "
        for n in (2, 3):
            for i in range(len(s) - n + 1):
                h = zlib.crc32(s[i : i + n].encode("utf-8", "surrogatepass"))
                v[h % DIM] += 1 if h >> 31 else -1
        norm = np.linalg.norm(v)
        out.append((v / norm).round(8).tolist() if norm else None)
    return out


def embed_distinct(df: DataFrame, columns: list[str], embedder: Callable[[list[str]], list] = hashed, batch: int = 250) -> DataFrame:
    """(text, v) of every distinct, filled text of the columns; each is embedded once."""
    texts = df.select(F.explode(F.array(*columns)).alias("text")).where("text is not null and trim(text) <> ''").distinct()

    def run(batches):
        import pandas as pd

        for p in batches:
            for at in range(0, len(p), batch):
                part = p["text"].iloc[at : at + batch].tolist()
                got = embedder(part)
                if len(got) != len(part):
                    raise ValueError(f"{len(part)} texts gave {len(got)} vectors")
                yield pd.DataFrame({"text": part, "v": got})

    return texts.mapInPandas(run, "text string, v array<double>")


def cached(df: DataFrame, cache: DataFrame, columns: list[str], embedder=hashed) -> DataFrame:
    """The cache's vectors and those of texts that it lacks."""
    texts = df.select(F.explode(F.array(*columns)).alias("text")).distinct().join(cache.select("text"), "text", "left_anti")
    return cache.unionByName(embed_distinct(texts, ["text"], embedder))
