"""Vector code compression: product codes whose entries are found by Orchard's search.

Every part position has a small codebook.  For each of its entries a list of all entries, nearest
first, is kept.  A search walks the list of its best entry so far; an entry that is nearer to
the query becomes the best one and the walk goes on in that entry's list.  Entries already
measured are marked and passed over.  The walk ends at the first entry that lies beyond twice
the query's distance from the list's owner: by the triangle inequality no later one can be nearer.

All arithmetic is in integers, so sums don't depend on the order in which tasks finish.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Scaled components are held within +-LARGEST, so that squared distances of up to 8,192 dimensions fit in 64 bits.
LARGEST = 1 << 24
#: Rows searched at once in a task.
CHUNK = 1 << 15


class Codebook:
    """The entries of one part position (entries x components, integers) with their sorted neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = entries[:, None, :] - entries[None, :, :]
        square = np.einsum("ijk,ijk->ij", gaps, gaps)
        self.lists = np.argsort(square, axis=1, kind="stable")
        self.square = np.take_along_axis(square, self.lists, 1)
        sums = entries.sum(1)
        self.by_sum = np.argsort(sums, kind="stable")
        self.sums = sums[self.by_sum]

    def measure(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        rest = x - self.entries[which]
        return np.einsum("ij,ij->i", rest, rest)

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row of ``x`` (ties: the lower index) and its squared distance."""
        n, k = len(x), len(self.entries)
        best = self.by_sum[np.minimum(np.searchsorted(self.sums, x.sum(1)), k - 1)]  # any first entry will do
        near = self.measure(x, best)
        seen = np.zeros((n, k), bool)
        seen[np.arange(n), best] = True
        step = np.zeros(n, np.int64)
        walk = np.arange(n)
        while len(walk):
            owner, at = best[walk], step[walk]
            inside = self.square[owner, at] <= 4 * near[walk]  # beyond twice the distance, squared
            walk, owner, at = walk[inside], owner[inside], at[inside]
            other = self.lists[owner, at]
            step[walk] += 1
            fresh = np.flatnonzero(~seen[walk, other])
            rows, tried = walk[fresh], other[fresh]
            seen[rows, tried] = True
            far = self.measure(x[rows], tried)
            better = (far < near[rows]) | ((far == near[rows]) & (tried < best[rows]))
            rows = rows[better]
            best[rows], near[rows], step[rows] = tried[better], far[better], 0
            walk = walk[step[walk] < k]
        return best, near


def integers(parts: int):
    """mapInArrow function over (vec_id, label, embedding): the scaled floors of usable vectors as packed 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for x in batch.column(2).to_pylist():
                x = np.array([] if x is None or None in x else x, np.float64)
                usable = len(x) and len(x) % parts == 0 and np.isfinite(x).all()
                codes.append(np.clip(np.floor(np.clip(x, -LARGEST, LARGEST) * SCALE), -LARGEST, LARGEST).astype("<i4").tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], ["vec_id", "label", "x"])

    return run


def chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """The rows in tables of about CHUNK, with their vectors as a matrix."""
    held, rows = [], 0

    def out() -> tuple[pa.Table, np.ndarray]:
        whole = pa.Table.from_batches(held)
        return whole, np.frombuffer(b"".join(whole.column("x").to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= CHUNK:
            yield out()
            held, rows = [], 0
    if rows:
        yield out()


def improved(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every entry the floor of its parts' mean, unused entries as they were.

    A task sends one row of sums per part, entry and component, whatever it read; the driver
    gets as many numbers as the codebooks hold.
    """
    parts, entries, width = len(books), len(books[0]), books[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, many = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        searchers = [Codebook(b) for b in books]
        for _, x in chunks(batches, parts * width):
            for j, book in enumerate(searchers):
                part = x[:, j * width:(j + 1) * width]
                which, _ = book.search(part)
                np.add.at(total[j], which, part)
                many[j] += np.bincount(which, minlength=entries)
        if many.any():
            place = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel()), pa.array(np.repeat(many.ravel(), width))], ["place", "total", "many"])

    found = vectors.select("x").mapInArrow(sums, "place long, total long, many long").groupBy("place").agg(F.sum("total").alias("total"), F.sum("many").alias("many")).toPandas()
    flat = np.concatenate([b.ravel() for b in books])
    found = found[found["many"] > 0]
    flat[found["place"].to_numpy()] = found["total"].to_numpy() // found["many"].to_numpy()
    return list(flat.reshape(parts, entries, width))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): (vec_id, label, code, error) of every usable row of ``vectors``, and the entries of each part.

    ``vectors``: vec_id, label, embedding (array of numbers); other columns are ignored.  A row whose
    vector is null, empty or holds a null or non-finite component is dropped, and so is one
    whose length isn't that of the usable row of least vec_id, or isn't a multiple of ``parts``.
    A component x counts as floor(4096 x), held within +-2**24.  The codebooks start as the
    parts of the ``entries`` rows of least vec_id (repeated vec_ids: by their packed integers; null ones last); with fewer
    rows they are smaller.  Repeated rows and null ids stay.  Ties go to the lower index.
    An empty table gives no rows and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    kind = dict(vectors.dtypes)["label"]
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = stage(given.mapInArrow(integers(parts), f"vec_id long, label {kind}, x binary").where("x is not null"), "code-vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("x")]
    one = usable.orderBy(*order).limit(1).collect()
    if not one:
        return usable.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    dim = len(one[0]["x"]) // 4
    vectors = usable.where(F.length("x") == 4 * dim)
    first = vectors.orderBy(*order).limit(entries).collect()
    start = np.stack([np.frombuffer(r["x"], "<i4") for r in first]).astype(np.int64)
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, 1)]
    for _ in range(rounds):
        books = improved(vectors, books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers, width = [Codebook(b) for b in books], dim // parts
        for rows, x in chunks(batches, dim):
            found = [book.search(x[:, j * width:(j + 1) * width]) for j, book in enumerate(searchers)]
            code = np.stack([which for which, _ in found], 1).astype(np.uint8).tobytes().hex()
            error = np.sum([far for _, far in found], 0)
            codes = [code[i:i + 2 * parts] for i in range(0, len(code), 2 * parts)]
            yield from rows.select(["vec_id", "label"]).append_column("code", pa.array(codes)).append_column("error", pa.array(error, pa.int64())).to_batches()

    return stage(vectors.mapInArrow(assign, f"vec_id long, label {kind}, code string, error long"), "vector-codes"), books


def codebook_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def decoded(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(vec_id, approximation): the vector that each code stands for, in the embedding's own scale."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            which = np.frombuffer(bytes.fromhex("".join(pdf["code"])), np.uint8).reshape(-1, len(books)) if len(pdf) else np.empty((0, len(books)), np.uint8)
            back = np.concatenate([book[which[:, j]] for j, book in enumerate(books)], 1) / SCALE
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "approximation": list(back)})

    return codes.select("vec_id", "code").mapInPandas(run, "vec_id long, approximation array<double>")


def op12_orchard_vector_codes(spark, sf_dir):
    """Code and error of every usable row of embeddings, the error of its label and the codebooks' digest.

    Rows with a null label have their errors summed together; see ``compress`` for the other cases.
    """
    rows, books = compress(table(spark, sf_dir, "embeddings"))
    labels = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    labels = labels.select(F.col("label").alias("of"), "label_error")
    return rows.join(labels, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """Every distance of every round, without neighbour lists."""
    far = "list_sum([(p.v[t] - c.v[t]) * (p.v[t] - c.v[t]) for t in range(1, len(p.v) + 1)])"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT p.vec_id, p.j, p.v, arg_min(c.i, ({far}, c.i)) AS i, min({far}) AS d FROM p JOIN c{r} c ON c.j = p.j GROUP BY ALL)""")
        if r < ROUNDS:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.j, c.i, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT j, i, list(m ORDER BY t) AS v FROM (SELECT j, i, t, floor(sum(v[t]) / count(*))::BIGINT AS m FROM a{r}, range(1, 1 + (SELECT max(len(v)) FROM p)) s(t) GROUP BY ALL) GROUP BY ALL) n ON n.j = c.j AND n.i = c.i)""")
    return f"""
WITH k AS (
  SELECT vec_id, label, [floor(4096 * e::DOUBLE)::BIGINT for e in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), p AS MATERIALIZED (SELECT vec_id, label, j, e[j * len(e) // {PARTS} + 1:(j + 1) * len(e) // {PARTS}] AS v FROM k, range({PARTS}) s(j)),
c0 AS MATERIALIZED (SELECT j, row_number() OVER (PARTITION BY j ORDER BY vec_id) - 1 AS i, v FROM p QUALIFY i < {ENTRIES}),
{", ".join(steps)},
codes AS (SELECT vec_id, string_agg(printf('%02x', i), '' ORDER BY j) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY j, i)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, (SELECT codebooks_sha256 FROM books) AS codebooks_sha256
FROM codes c JOIN k ON k.vec_id = c.vec_id
"""


QUERIES = {"op12_orchard_vector_codes": op12_orchard_vector_codes}
ORACLES = {"op12_orchard_vector_codes": _oracle()}
