"""Session helpers: defaults for local runs and the shared scratch folder.

Library code never creates a session.  Tests and bench call ``local_session``;
on a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "crewspark", **extra: str) -> SparkSession:
    """A local session for tests and the bench; sets a checkpoint folder only if unset."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it.

    A folder set by ``setCheckpointDir`` comes first, then ``spark.checkpoint.dir``.
    With neither, a session on one machine (``local[...]``: tests and benches, where every
    task sees the same disk) gets a fresh temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        given = sc.getConf().get("spark.checkpoint.dir", None)
        return given or sc.getCheckpointDir()
    base = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if sc.applicationId not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="crewspark-ckpt-")
        base = _LOCAL_FALLBACK[sc.applicationId]
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/crewspark/{name}-{uuid.uuid4().hex[:12]}"


def parallelism(spark: SparkSession) -> int:
    """Cores available to the job (used to size block counts)."""
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - connect sessions
        return max(1, os.cpu_count() or 1)


def ship_code() -> None:
    """Send this package's functions to Python workers by value.

    Pandas UDFs defined here call module-level helpers; pickling the package
    by value means executors need no install of it (no ``--py-files``).
    """
    import sys

    from pyspark import cloudpickle

    pkg = sys.modules[__name__.split(".")[0]]
    try:
        cloudpickle.register_pickle_by_value(pkg)
    except ValueError:  # already registered
        pass


def written(df, name: str):
    """Write ``df`` as Parquet below the shared folder and read it back with its schema.

    Unlike a lazy frame, several readers of the result see the same partition numbers and
    row order that were written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df):
    """Cut the lineage of a frame several consumers reuse.

    A reliable checkpoint into the shared ``spark.checkpoint.dir`` folder: the
    data survive the loss of the executors that computed them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
