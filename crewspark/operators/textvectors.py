"""V1: dense text vectors, the truncated singular value decomposition of the token weights, as Spark jobs.

The matrix of texts by tokens is never formed: it is the table (did, token, impact).  A product with a thin matrix
is a join on its rows' key and a sum of vectors; only the small Gram matrices of the thin side, (dims + EXTRA)
squared numbers, come to the driver (randomised range finder with power iterations, Halko et al. 2011).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code, written
from .similarity import index_weights, text_terms

EXTRA = 8


def _random_rows(tokens: DataFrame, width: int, seed: int) -> DataFrame:
    """(token, vec): a vector of normal numbers made from the token's hash, the same on every machine."""
    share = lambda i, salt: (F.pmod(F.xxhash64("token", i, F.lit(seed + salt)), F.lit(1 << 40)) + 0.5) / (1 << 40)
    normal = lambda i: F.sqrt(-2 * F.log(share(i, 0))) * F.cos(2 * np.pi * share(i, 1))
    return tokens.select("token", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), normal).alias("vec"))


def _product(terms: DataFrame, on: str, key: str, rows: DataFrame, name: str) -> DataFrame:
    """(key, vec): for each ``key`` of the terms the sum of impact times the row that its ``on`` has; batches are summed before the shuffle."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                code, keys = pd.factorize(pdf[key])
                each = np.stack(pdf["vec"].to_numpy()) * pdf["impact"].to_numpy()[:, None]
                out = np.zeros((len(keys), each.shape[1]))
                np.add.at(out, code, each)
                yield pd.DataFrame({key: keys, "vec": list(out)})

    ship_code()
    parts = terms.join(rows, on).select(key, "impact", "vec").mapInPandas(partial, f"{key} string, vec array<double>")
    sums = parts.select(key, F.posexplode("vec").alias("at", "x")).groupBy(key, "at").agg(F.sum("x").alias("x"))
    whole = sums.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s"))
    return written(whole.select(key, F.transform("s", lambda p: p["x"]).alias("vec")), name)


def _gram(rows: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of all rows, width * width numbers."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for pdf in batches:
            if len(pdf):
                m = np.stack(pdf["vec"].to_numpy())
                total += m.T @ m
        yield pd.DataFrame({"at": np.arange(width * width), "x": total.ravel()})

    found = rows.select("vec").mapInPandas(partial, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(width * width)
    out[found["at"].to_numpy()] = found["x"].to_numpy()
    return out.reshape(width, width)


def _times(rows: DataFrame, key: str, small: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(vec=list(np.stack(pdf["vec"].to_numpy()) @ small))

    return rows.mapInPandas(run, f"{key} string, vec array<double>")


def _whitened(gram: np.ndarray) -> np.ndarray:
    """What makes rows of this Gram matrix orthonormal; directions without weight become zero."""
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-10 * max(value.max(initial=0.0), 1e-300)
    return vector * np.where(keep, 1 / np.sqrt(np.where(keep, value, 1.0)), 0.0)


def text_vectors(index: DataFrame, dims: int = 64, rounds: int = 2, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(vectors, directions): did, vec of every distinct description with a token, and token, vec of every token.

    ``index`` as ``build_index`` gives it.  The dot product of two texts' vectors approaches the cosine of their
    token weights, and is that cosine if ``dims`` is at least the matrix's rank.  Another text's vector is the sum
    of its tokens' directions times their shares (``embedded``).
    """
    weights, norms, _ = index_weights(index)
    terms = written(weights.join(norms.select("Project_Description", "norm"), "Project_Description")
                    .select(F.md5("Project_Description").alias("did"), "token", (F.col("w") / F.col("norm")).alias("impact")), "svd-terms")
    width = dims + EXTRA
    basis = _random_rows(terms.select("token").distinct(), width, seed)
    for _ in range(rounds):
        texts = _product(terms, "token", "did", basis, "svd-texts")
        texts = _times(texts, "did", _whitened(_gram(texts, width)))
        tokens = _product(terms, "did", "token", texts, "svd-tokens")
        basis = _times(tokens, "token", _whitened(_gram(tokens, width)))
    texts = _product(terms, "token", "did", basis, "svd-texts")
    value, vector = np.linalg.eigh(_gram(texts, width))
    top = vector[:, ::-1][:, :dims]
    return written(_times(texts, "did", top), "text-vectors"), written(_times(basis, "token", top), "token-directions")


def embedded(queries: DataFrame, directions: DataFrame, idf: DataFrame, n: int, text: str) -> DataFrame:
    """(did, vec) of other texts by the token directions; tokens that the index lacks count in the length only."""
    terms = text_terms(queries, text).join(idf, "token", "left").select(F.md5(text).alias("did"), "token", (F.col("tf") * F.coalesce("idf", F.log(F.lit(1.0 + n)) + 1)).alias("w"))
    norms = terms.groupBy("did").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return _product(terms.join(norms, "did").select("did", "token", (F.col("w") / F.col("norm")).alias("impact")), "token", "did", directions, "embedded")
