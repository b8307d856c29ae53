"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .slices import MIX, mixed


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Python workers of this session get at most BATCH_ROWS rows at once: texts can be long,
    and a batch of them is held several times over (in the JVM, as Arrow, as Python strings)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ship_package(spark: SparkSession) -> None:
    """Let Spark hand this package's source to its Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_crewspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    made = Path(tempfile.mkdtemp(prefix="crewspark-code-")) / "crewspark_code.zip"  # read by the driver only
    with zipfile.ZipFile(made, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, f"{root.name}/{source.relative_to(root)}")
    sc.addPyFile(str(made))
    sc._crewspark_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's own reader."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage; the files outlive the executors that wrote them.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, keep: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """Rows whose text passes ``keep`` (texts, null as empty -> booleans), with every column as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield batch.filter(pa.array(np.asarray(keep(texts), bool), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


FILTER_BITS = 26


def id_places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each id in a filter of 2**FILTER_BITS bits."""
    h = mixed(ids.astype(np.int64).view(np.uint64) * MIX[0])
    low = np.uint64((1 << FILTER_BITS) - 1)
    return h & low, h >> np.uint64(FILTER_BITS) & low


def id_filter(ids: DataFrame, col: str):
    """A Bloom filter of the ids, to be made in a task: ``id_filter(...)()`` tells which ids may be among them.

    Its size, 2**FILTER_BITS bits in at most 2**(FILTER_BITS - 6) rows, doesn't depend on the
    number of ids; a full filter lets all ids pass, so an exact join has to follow.
    """
    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = np.unique(np.concatenate(id_places(pdf[col].to_numpy(np.int64))))
            if len(at):
                place, one = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
                first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                yield pd.DataFrame({"place": place[first].view(np.int64), "bits": np.bitwise_or.reduceat(one, first).view(np.int64)})

    rows = ids.select(F.col(col).cast("long").alias(col)).mapInPandas(bits, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    places, words = rows["place"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64).view(np.uint64)

    def make() -> Callable[[np.ndarray], np.ndarray]:
        filled = np.zeros(1 << FILTER_BITS >> 6, np.uint64)
        filled[places] = words

        def held(some: np.ndarray) -> np.ndarray:
            out = np.ones(len(some), bool)
            for at in id_places(some):
                out &= (filled[(at >> np.uint64(6)).view(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
            return out

        return held

    return make


def crc_fold(doc_id: str, folds: int):
    """crc32 of the id written as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(folds)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, root of each) of the edges (a, b), which may be none.

    A component's root is its node of least hashed id: with a random order a constant
    share of the nodes stops being a root in every round of ``connected_components``.
    """
    ids = np.unique(np.concatenate([a, b]))
    key = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    order = np.argsort(key ^ (key >> np.uint64(27)), kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    x, y = place[np.searchsorted(ids, a)], place[np.searchsorted(ids, b)]
    low = np.arange(len(ids))
    while len(x):
        x, y = low[x], low[y]
        x, y = np.minimum(x, y), np.maximum(x, y)
        x, y = x[x != y], y[x != y]
        np.minimum.at(low, y, x)
        while (low[low] != low).any():
            low = low[low]
    return ids, ids[order][low[place]]


def forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function: a partition's edges (a, b) as a forest of depth one (node, root)."""
    nodes, roots = np.empty(0, np.int64), np.empty(0, np.int64)
    for pdf in batches:
        nodes, roots = forest(np.concatenate([nodes, pdf["a"].to_numpy(np.int64)]), np.concatenate([roots, pdf["b"].to_numpy(np.int64)]))
    yield pd.DataFrame({"node": nodes, "root": roots})


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every id in the edges (a, b); component is the smallest id reachable.

    Each round replaces a partition's edges by its forest, takes a least root of every node
    (a grouped aggregate: a node has at most one root per partition) and goes on with the
    edges between a node's roots.  Those are far fewer: the graph of partitions' roots.  No
    round puts a component or a hub into one task, and no edge reaches the driver.  Null and
    self edges are ignored; no edges give an empty result.
    """
    left = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    levels, more = [], True
    while more:
        roots = left.mapInPandas(forests, "node long, root long").groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("all"))
        roots = stage(roots, name)
        levels.append(roots.select("node", "root"))
        left = roots.where("size(all) > 1").select(F.explode("all").alias("a"), F.col("root").alias("b")).where("a <> b")
        more = not left.isEmpty()
    out = levels[0]
    for level in levels[1:]:
        nearer = level.select(F.col("node").alias("root"), F.col("root").alias("next"))
        out = out.join(nearer, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    if len(levels) > 1:
        out = stage(out, name)
    least = out.groupBy("root").agg(F.min("node").alias("component"))
    return out.join(least, "root").select(F.col("node").alias("id"), "component")
