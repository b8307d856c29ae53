"""Registry of named queries: Spark job + optional DuckDB oracle text.

A query is ``fn(spark, sf_dir) -> DataFrame``.  ``round_cols`` lists double
columns that come out of floating aggregation; both sides round them to six
places so that summation order does not change the value hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUND_PLACES = 6


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    round_cols: list[str] = field(default_factory=list)
    bench: bool = False

    def spark_df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.fn(spark, sf_dir)
        if self.round_cols:
            df = df.select(*[F.round(c, ROUND_PLACES).alias(c) if c in self.round_cols else F.col(c)
                             for c in df.columns])
        return df

    def oracle_sql(self) -> str | None:
        if self.oracle is None:
            return None
        if not self.round_cols:
            return self.oracle
        repl = ", ".join(f"round({c}, {ROUND_PLACES}) AS {c}" for c in self.round_cols)
        return f"SELECT * REPLACE ({repl}) FROM ({self.oracle}) AS q"


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None, round_cols: list[str] | None = None, bench: bool = False):
    def deco(fn):
        QUERIES[name] = Query(name, fn, oracle, list(round_cols or []), bench)
        return fn
    return deco
