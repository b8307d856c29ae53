from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from crewspark.operators import similarity as V
from crewspark.operators import textvectors as X


def corpus(spark, n, words, seed):
    rnd = random.Random(seed)
    topics = [[f"t{k}w{i}" for i in range(words)] for k in range(8)]
    texts = [" ".join(["the", "and"] + [rnd.choice(topics[j % 8]) for _ in range(12)] + [rnd.choice(topics[rnd.randrange(8)])]) for j in range(n)]
    return texts, spark.createDataFrame([(i, "D", t) for i, t in enumerate(texts)] + [(9000, "D", None), (9001, "D", "")], "ProjectID long, Domain string, Project_Description string")


def exact(spark, index):
    weights, norms, _ = V.index_weights(index)
    rows = weights.join(norms.select("Project_Description", "norm"), "Project_Description").select(F.md5("Project_Description").alias("did"), "token", (F.col("w") / F.col("norm")).alias("x")).toPandas()
    return rows.pivot_table(index="did", columns="token", values="x", fill_value=0.0)


def test_vectors_are_the_truncated_decomposition(spark):
    texts, index = corpus(spark, 300, 20, 1)
    whole = exact(spark, index)
    vectors, directions = X.text_vectors(index, dims=16, rounds=3)
    got = {r["did"]: np.array(r["vec"]) for r in vectors.collect()}
    assert set(got) == set(whole.index)
    M = np.stack([got[d] for d in whole.index])
    u, s, vt = np.linalg.svd(whole.to_numpy(), full_matrices=False)
    assert np.allclose(np.sqrt((M**2).sum(0)), s[:16], rtol=0.05)
    assert abs(np.linalg.norm(M @ M.T) - np.linalg.norm((u[:, :16] * s[:16]) @ (u[:, :16] * s[:16]).T)) < 0.02 * np.linalg.norm(M @ M.T)
    T = {r["token"]: np.array(r["vec"]) for r in directions.collect()}
    assert np.allclose(whole.to_numpy() @ np.stack([T[t] for t in whole.columns]), M, atol=1e-6)


def test_neighbours_agree_with_exact_search(spark):
    """Of the ten nearest texts by token weights, the dense vectors of a fifth of the rank find at least 70 %."""
    texts, index = corpus(spark, 300, 20, 2)
    whole = exact(spark, index)
    vectors, _ = X.text_vectors(index, dims=32)
    got = {r["did"]: np.array(r["vec"]) for r in vectors.collect()}
    M = np.stack([got[d] / np.linalg.norm(got[d]) for d in whole.index])
    A = whole.to_numpy()
    best, near = np.argsort(-(A @ A.T), 1)[:, 1:11], np.argsort(-(M @ M.T), 1)[:, 1:11]
    assert np.mean([len(set(b) & set(c)) / 10 for b, c in zip(best, near)]) >= 0.7


def test_full_rank_is_exact_and_queries_embed(spark):
    texts, index = corpus(spark, 40, 3, 3)
    whole = exact(spark, index)
    vectors, directions = X.text_vectors(index, dims=64)
    got = {r["did"]: np.array(r["vec"]) for r in vectors.collect()}
    M = np.stack([got[d] for d in whole.index])
    assert np.allclose(M @ M.T, whole.to_numpy() @ whole.to_numpy().T, atol=1e-6)
    _, _, idf = V.index_weights(index)
    asked = spark.createDataFrame([(texts[0],), ("t1w1 unknown",), (None,), ("",)], "t string")
    n = len(set(texts)) + 1
    q = {r["did"]: np.array(r["vec"]) for r in X.embedded(asked, directions, idf, n, "t").collect()}
    assert len(q) == 2
    same = spark.createDataFrame([(texts[0],)], "t string").select(F.md5("t")).first()[0]
    assert np.allclose(q[same], got[same], atol=1e-6)
