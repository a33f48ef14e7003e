"""Embedders: a protocol and a deterministic offline default (signed feature hashing; our own choice, no trained model)."""

from __future__ import annotations

from typing import Protocol

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F


class Embedder(Protocol):
    dim: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class HashingEmbedder:
    """Unit vectors of word and letter-trigram hashes."""

    def __init__(self, dim: int = 1024):
        self.dim = dim

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for w in t.lower().split():
                for g in (w, *(f"^{w}$"[k : k + 3] for k in range(len(w)))):
                    h = xxhash.xxh3_64_intdigest(g)
                    out[i, h % self.dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)


class PooledEmbedder:
    """An embedder over a model of token vectors: ``encode(texts) -> (rows x tokens x dim, mask)``; vectors are pooled by the mask."""

    def __init__(self, encode, dim: int):
        self.encode, self.dim = encode, dim

    def embed(self, texts: list[str]) -> np.ndarray:
        return mean_pooled(*self.encode(texts)).astype(np.float32)


def works(embedder: Embedder) -> bool:
    """Whether the embedder gives a vector of its size for a word."""
    try:
        return np.asarray(embedder.embed(["test"])).shape == (1, embedder.dim)
    except Exception:  # noqa: BLE001  a plug-in's failure is the answer
        return False


def mean_pooled(tokens: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean of token vectors (rows, tokens, dim) under an attention mask; rows without tokens are zero."""
    m = mask[:, :, None].astype(tokens.dtype)
    return (tokens * m).sum(axis=1) / np.maximum(m.sum(axis=1), 1e-9)


def embed(text: Column, embedder: Embedder | None = None) -> Column:
    """array<float>; null for null or empty text."""
    model = embedder or HashingEmbedder()

    def run(s: pd.Series) -> pd.Series:
        there = s.fillna("") != ""
        out = pd.Series([None] * len(s), index=s.index, dtype=object)
        if there.any():
            out[there] = pd.Series(list(model.embed(s[there].tolist())), index=s.index[there], dtype=object)
        return out

    return F.pandas_udf(run, "array<float>")(text)
