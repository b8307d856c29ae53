"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Vectors of one label are dealt into blocks of about ``block`` rows; each pair of
blocks is one tile.  A tile multiplies int8 codes, adds each pair's largest possible
quantisation error, and recomputes in double precision only the pairs whose upper
bound reaches the threshold.  It returns one row per vector (links counted, a local
component's root) and never a row per pair, so a large group of copies stays linear.

Error bound: a unit vector x = s q + r with code q, scale s and remainder norm e gives
|x.y - s_x s_y q_x.q_y| <= (1 + e_x) e_y + e_x.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, forest, stage, table

#: Added to the error bound: rounding of the bound's own arithmetic.
SLACK = 1e-9


def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Double components, int8 code, scale and error norm of every usable vector."""
    for pdf in batches:
        rows = []
        for vec_id, label, embedding in zip(pdf["vec_id"], pdf["label"], pdf["embedding"]):
            try:
                x = np.asarray(embedding, dtype=np.float64)
            except (TypeError, ValueError):
                continue
            if x.ndim != 1 or not x.size or not np.isfinite(x).all():
                continue
            big = np.abs(x).max()
            if big == 0:
                continue
            unit = x / big  # no overflow or underflow in the norm
            unit = unit / np.sqrt(unit @ unit)
            scale = np.abs(unit).max() / 127
            code = np.rint(unit / scale).astype(np.int8)
            rest = unit - scale * code
            rows.append((vec_id, label, x.size, x.tobytes(), code.tobytes(), scale, float(np.sqrt(rest @ rest))))
        yield pd.DataFrame(rows, columns=["vec_id", "label", "dim", "x", "code", "scale", "err"])


def links_of_tile(threshold: float):
    """A grouped-map function over one tile (label, dim, i, j)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n, dim = len(pdf), int(pdf["dim"].iat[0])
        i, j = int(pdf["i"].iat[0]), int(pdf["j"].iat[0])
        ids = pdf["vec_id"].to_numpy(np.int64)
        x = np.frombuffer(b"".join(pdf["x"]), np.float64).reshape(n, dim)
        # the integer products are exact in float32 up to 2**24
        code = np.frombuffer(b"".join(pdf["code"]), np.int8).reshape(n, dim).astype(np.float32 if dim * 127 * 127 < 2**24 else np.float64)
        scale, err = pdf["scale"].to_numpy(), pdf["err"].to_numpy()
        blk = pdf["blk"].to_numpy()
        left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
        top = (code[left] @ code[right].T).astype(np.float64)
        top *= scale[left][:, None] * scale[right][None, :]
        top += (1 + err[left])[:, None] * err[right][None, :] + err[left][:, None] + SLACK
        hit = top >= threshold
        if i == j:
            hit = np.triu(hit, 1)
        r, c = np.nonzero(hit)
        a, b = left[r], right[c]
        big = np.abs(x).max(1)
        unit = x / big[:, None]
        norm = np.sqrt(np.einsum("ij,ij->i", unit, unit))
        keep = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 15):
            p, q = a[at:at + (1 << 15)], b[at:at + (1 << 15)]
            keep[at:at + (1 << 15)] = np.einsum("ij,ij->i", unit[p], unit[q]) / (norm[p] * norm[q]) >= threshold
        a, b = a[keep], b[keep]
        counts = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
        out = pd.DataFrame({"vec_id": ids, "n_links": counts})[counts > 0]
        nodes, roots = forest(ids[a], ids[b])
        return out.assign(to=roots[np.searchsorted(nodes, out["vec_id"].to_numpy())])

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, block: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every distinct ``vec_id``.

    ``vectors`` has vec_id, label and embedding (array of numbers); other columns are
    ignored.  Two vectors are compared only when their labels are equal and not null and
    their lengths agree.  A vector that is null, empty, zero or holds a null or
    non-finite component links with nothing.  Rows that repeat a vec_id count as one
    vector, the least by (label, embedding); rows without a vec_id return with no link
    and a null component.  An empty table gives an empty result.

    All pairs of a label are compared, in tiles: work grows with the square of a label's
    rows, each vector is sent to as many tiles as its label has blocks, and a task holds
    2 x ``block`` vectors.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    one = given.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("v")).select("vec_id", "v.label", "v.embedding")
    usable = one.where("label is not null and embedding is not null and not exists(embedding, c -> c is null)")
    kind = dict(usable.dtypes)["label"]
    codes = stage(usable.mapInPandas(quantise, f"vec_id long, label {kind}, dim int, x binary, code binary, scale double, err double"), "vector-codes")
    sizes = codes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("n_blk"))
    dealt = codes.join(sizes, ["label", "dim"]).withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("n_blk")).cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blk") - 1))) \
        .select("vec_id", "label", "dim", "x", "code", "scale", "err", "blk", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"))
    found = stage(tiles.groupBy("label", "dim", "i", "j").applyInPandas(links_of_tile(threshold), "vec_id long, n_links long, to long"), "vector-links")
    links = found.groupBy("vec_id").agg(F.sum("n_links").alias("n"))
    parts = connected_components(found.select(F.col("vec_id").alias("a"), F.col("to").alias("b")), "vector-components")
    ids = one.select("vec_id").unionByName(given.where("vec_id is null").select("vec_id"))
    return ids.join(links, "vec_id", "left").join(parts.withColumnRenamed("id", "vec_id"), "vec_id", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        (F.coalesce("component", "vec_id") == F.col("vec_id")).alias("kept"))


def op9_embedding_near_dedup(spark, sf_dir):
    """Near-duplicate links, components and kept flags of every row of embeddings; edge cases as in ``near_duplicate_vectors``."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


#: Brute-force twin: every pair of a label in double precision, components by recursion.
ORACLE_9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), reach(id, seen) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.seen
), comp AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN comp c ON c.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

QUERIES = {"op9_embedding_near_dedup": op9_embedding_near_dedup}
ORACLES = {"op9_embedding_near_dedup": ORACLE_9}
