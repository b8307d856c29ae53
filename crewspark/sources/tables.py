"""Parquet tables with versions, history, partitioned writes and compaction.

S1–S10 without Delta: each commit writes its rows under
``<path>/data/version=<v>/`` and then appends one history row (version,
timestamp, operation, metrics, base).  An overwrite starts a new chain; an
append names the version it extends, so a snapshot is the union of the
version folders on its chain and appends never rewrite old files.  Readers
take the highest version in the history.  No concurrent-writer isolation
is claimed.
"""

from __future__ import annotations

import datetime as _dt
import json
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.schema import HISTORY, conform
from ..operators.merge import upsert, version_diff
from ..session import written

HISTORY_ROW = T.StructType(HISTORY.fields + [T.StructField("base", T.LongType()), T.StructField("schema", T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


CORRUPT = "_corrupt_record"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt) of a CSV folder: rows that fit the schema, and (_corrupt_record) the lines that don't.

    A cell of the wrong type, a missing or an extra cell makes a line corrupt; none of its cells are used.
    The file is parsed once, into a table in the shared folder that both frames read.
    """
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = written(spark.read.schema(whole).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path), "csv-checked")
    return read.where(F.col(CORRUPT).isNull()).select(*schema.names), read.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV folder with a header line per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, partition_col: str | None) -> None:
    """Partitioned overwrite (one folder per partition value)."""
    w = df.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


SLOT_ROWS = 1 << 20     # rows that one task of a compaction sorts, about


class VersionedTable:
    """A Parquet table with numbered versions and a commit history."""

    def __init__(self, spark: SparkSession, path: str, partition_col: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_col = partition_col

    # -- metadata ---------------------------------------------------------
    @property
    def _history_path(self) -> str:
        return f"{self.path}/_history"

    def history(self) -> DataFrame:
        """All commits (version, timestamp, operation, operationMetrics).

        A table without any folder has none.  Data without a history is an error, as is any
        failure to read it: an unreadable history must not look like a new table.
        """
        if self._exists(self._history_path):
            return self.spark.read.schema(HISTORY_ROW).parquet(self._history_path)
        if self._exists(f"{self.path}/data"):
            raise ValueError(f"{self.path} has data but no commit history")
        return self.spark.createDataFrame([], HISTORY_ROW)

    def _exists(self, path: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def _log(self) -> list:
        # The commit log is metadata (one small row per commit), read like a table log.
        return self.history().select("version", "base", "schema").orderBy("version").collect()

    def latest_version(self) -> int | None:
        log = self._log()
        return log[-1]["version"] if log else None

    def _chain(self, version: int) -> list[int]:
        bases = {r["version"]: r["base"] for r in self._log()}
        if version not in bases:
            raise ValueError(f"version {version} not in history of {self.path}")
        chain, v = [], version
        while v is not None:
            chain.append(v)
            v = bases.get(v)
        return chain

    # -- reads ------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """The latest snapshot, or the snapshot as of ``version``."""
        v = self.latest_version() if version is None else version
        if v is None:
            raise ValueError(f"{self.path} has no commits")
        dirs = [f"{self.path}/data/version={x}" for x in self._chain(v)]
        schema = T.StructType.fromJson(json.loads(next(r["schema"] for r in self._log() if r["version"] == v)))
        # the schema is given, so that a partition value such as 007 stays the string it was
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*dirs).select(*schema.names)

    def appended(self, version: int) -> DataFrame:
        """The rows that an appending version added, without those of the versions it extends."""
        schema = T.StructType.fromJson(json.loads(next(r["schema"] for r in self._log() if r["version"] == version)))
        return self.spark.read.schema(schema).parquet(f"{self.path}/data/version={version}").select(*schema.names)

    # -- writes -----------------------------------------------------------
    def _commit(self, df: DataFrame, operation: str, base: int | None, metrics: dict[str, str]) -> int:
        latest = self.latest_version()
        v = 0 if latest is None else latest + 1
        target = f"{self.path}/data/version={v}"
        w = df.write.mode("errorifexists")
        if self.partition_col and self.partition_col in df.columns:
            w = w.partitionBy(self.partition_col)
        w.parquet(target)
        rows = self.spark.read.parquet(target).count()
        metrics = {"numOutputRows": str(rows), **metrics}
        entry = self.spark.createDataFrame(
            [(v, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), operation, metrics, base, df.schema.json())], HISTORY_ROW)
        entry.coalesce(1).write.mode("append").parquet(self._history_path)
        return v

    def overwrite(self, df: DataFrame, operation: str = "WRITE", **metrics: str) -> int:
        """A new chain holding exactly ``df`` (schema may change)."""
        return self._commit(df, operation, None, metrics)

    def append(self, df: DataFrame, operation: str = "WRITE (append)", base: int | None = None, **metrics: str) -> int:
        """Conform ``df`` to the current schema by name, add it as a new version.

        ``base`` names the version to extend (default: the latest).
        """
        base = self.latest_version() if base is None else base
        if base is not None:
            df = conform(df, self.read(base).schema, fill_missing=True)
        return self._commit(df, operation, base, metrics)

    def merge(self, source: DataFrame, keys: list[str], operation: str = "MERGE", **metrics: str) -> int:
        """J3-J5 as a commit: rows of ``source`` update those of the same ``keys`` and add the others."""
        merged = upsert(self.read(), source, keys)
        return self._commit(merged, operation, None, {"keys": ",".join(keys), **metrics})

    def compact(self, sort_cols: list[str] | None = None, files_per_partition: int = 4) -> int:
        """Rewrite the latest snapshot with fewer files, clustered by all of ``sort_cols`` alike.

        Each partition value is cut into ``files_per_partition`` slots along a space-filling curve over
        the sort columns, so a filter on any of them skips files (see ``curve_key``).  A slot
        is one task's (so a value of many rows is not) and at most one file; a value gets more slots than
        that once they would hold more than ``SLOT_ROWS`` rows each.  Rows lie in the order of the curve.  Without sort columns rows are dealt by a hash.
        """
        df = self.read()
        cols = [c for c in (sort_cols or []) if c in df.columns]
        pc = self.partition_col if self.partition_col in df.columns else None
        n = max(1, files_per_partition)
        group = F.col(pc) if pc else F.lit(0)
        most = df.groupBy(*([pc] if pc else [])).count().agg(F.max("count")).first()[0] or 0
        n = max(n, math.ceil(most / SLOT_ROWS))
        if not cols and not pc:
            return self._commit(df.coalesce(n), "OPTIMIZE", None, {"sortColumns": ""})
        df = df.withColumn("_of", group)
        df = df.withColumn("_key", F.pmod(F.xxhash64(*self.read().columns), F.lit(n)) if not cols else F.lit(0).cast("long"))
        if cols:
            df = curve_key(df, "_of", cols, "_key")
        cuts = df.groupBy(F.col("_of").alias("_value")).agg(F.percentile_approx("_key", [i / n for i in range(1, n)] or [0.5]).alias("_cuts"))
        df = df.join(F.broadcast(cuts), F.col("_of").eqNullSafe(F.col("_value"))) \
            .withColumn("_slot", F.size(F.filter("_cuts", lambda c: c < F.col("_key"))) if n > 1 else F.lit(0)).drop("_value", "_cuts")
        slots = n * max(1, df.select("_of").distinct().count())
        df = df.repartitionByRange(slots, "_of", "_slot").sortWithinPartitions(*([pc] if pc else []), "_key", *cols).drop("_slot", "_of", "_key")
        return self._commit(df, "OPTIMIZE", None, {"sortColumns": ",".join(cols)})


CURVE_BITS = 5


def curve_key(df: DataFrame, group: str, cols: list[str], out: str) -> DataFrame:
    """``df`` with ``out``, each row's place along a Z-shaped curve over the quantile ranks of ``cols`` within its ``group``.

    A rank is one of 2**CURVE_BITS steps of about equal row counts (fewer bits with many columns), so skewed
    values spread like even ones; the ranks' bits take turns in the key.  Text is ranked by its first
    seven bytes, null before everything.
    """
    bits = max(1, min(CURVE_BITS, 60 // len(cols)))
    steps = 1 << bits

    def number(c: str):
        if isinstance(df.schema[c].dataType, T.NumericType):
            return F.col(c).cast("double")
        raw = F.rpad(F.hex(F.substring(F.col(c).cast("string").cast("binary"), 1, 7)), 14, "0")
        return F.conv(raw, 16, 10).cast("double")

    shares = [i / steps for i in range(1, steps)]
    cuts = df.groupBy(F.col(group).alias("_g")).agg(*[F.percentile_approx(number(c), shares).alias(f"_cut{i}") for i, c in enumerate(cols)])
    ranked = df.join(F.broadcast(cuts), F.col(group).eqNullSafe(F.col("_g")))
    below = lambda cuts, value: F.coalesce(F.size(F.filter(cuts, lambda x: x < value)), F.lit(0)).cast("long")
    ranks = [below(f"_cut{i}", number(c)) for i, c in enumerate(cols)]
    ranked = ranked.withColumns({f"_rank{i}": r for i, r in enumerate(ranks)})
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i in range(len(cols)):
            one = F.shiftright(f"_rank{i}", bit).bitwiseAND(F.lit(1).cast("long"))
            key = key + F.shiftleft(one, bit * len(cols) + len(cols) - 1 - i)
    return ranked.withColumn(out, key).drop("_g", *[f"_cut{i}" for i in range(len(cols))], *[f"_rank{i}" for i in range(len(cols))])


def recent_history(table: VersionedTable, n: int = 10) -> DataFrame:
    """Newest ``n`` commits."""
    return (table.history().select("version", "timestamp", "operation", "operationMetrics")
            .orderBy(F.col("version").desc()).limit(n))


class BucketedSnapshot:
    """A snapshot dealt into buckets by a hash of its keys, with a digest of each bucket kept beside it."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def write(self, df: DataFrame) -> "BucketedSnapshot":
        """Write ``df`` a folder a bucket, and (bucket, rows, two sums of row hashes) as its digests."""
        dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        dealt.repartition(F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{self.path}/rows")
        rows = self.spark.read.schema(dealt.schema).parquet(f"{self.path}/rows")
        total = lambda salt: F.sum(F.xxhash64(*df.columns, F.lit(salt)).cast("decimal(20,0)")).alias(f"sum{salt}")
        rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("rows"), total(1), total(2)).coalesce(1).write.parquet(f"{self.path}/digests")
        self.schema = dealt.schema
        return self

    def digests(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/digests")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, all or those of the given buckets (only their folders are listed and read)."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        return (rows if buckets is None else rows.where(F.col("_bucket").isin(buckets))).drop("_bucket")

    def differing(self, other: "BucketedSnapshot") -> list[int]:
        """Buckets whose digests differ, at most ``buckets`` numbers; an absent bucket differs from any."""
        if (self.keys, self.buckets, self.schema) != (other.keys, other.buckets, other.schema):
            raise ValueError("snapshots of other keys, buckets or columns have no common buckets")
        mine, theirs = ({r["_bucket"]: tuple(r) for r in s.digests().collect()} for s in (self, other))
        return sorted(b for b in mine.keys() | theirs.keys() if mine.get(b) != theirs.get(b))

    def diff(self, other: "BucketedSnapshot") -> DataFrame:
        """``version_diff`` from this snapshot to ``other``, joining only the buckets that differ."""
        some = self.differing(other) or [-1]
        return version_diff(self.read(some), other.read(some), self.keys)
