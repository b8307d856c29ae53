"""Table profiles as mergeable sketches, one row a column, kept beside each version of a table.

The exact form is ``analytics.table_profile``.  Sketches of two parts of a table (two versions' appends) merge
into the sketches of both without reading either part again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DISTINCT_BITS = 12   # log2 of the distinct sketch's size: standard error about 1.6 %
QUANTILE_K = 200     # the quantile sketch's size: rank error about 1.7 % with 99 % confidence
HEAVY = 64           # values whose counts are kept

COLUMNS = ["column_name", "rows", "nulls", "low", "high", "distinct", "quantiles", "heavy", "heavy_bound"]


def _numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


def _heaviest(counts: DataFrame, slack: DataFrame | None = None) -> DataFrame:
    """(column_name, heavy: value -> count, heavy_bound) of (column_name, value, n): the HEAVY largest counts.

    A value's true count is between the stored one (0 if absent) and that plus heavy_bound; ``slack`` (column_name,
    bound) is what the counts given may already lack.
    """
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HEAVY + 1)
    out = top.groupBy("column_name").agg(F.map_from_entries(F.collect_list(F.when(F.col("place") <= HEAVY, F.struct("value", "n")))).alias("heavy"),
                                         F.coalesce(F.max(F.when(F.col("place") > HEAVY, F.col("n"))), F.lit(0)).cast("long").alias("cut"))
    if slack is not None:
        return out.join(slack, "column_name").select("column_name", "heavy", (F.col("cut") + F.col("bound")).alias("heavy_bound"))
    return out.select("column_name", "heavy", F.col("cut").alias("heavy_bound"))


def sketch_profile(df: DataFrame) -> DataFrame:
    """COLUMNS for every column of ``df``: rows, nulls, low and high (of numbers), a sketch of the distinct values, one of
    the quantiles (of numbers) and the heaviest values' counts.  One aggregate, and one over (column, value)."""
    null = F.lit(None)
    parts = []
    for c in df.columns:
        text, number = F.col(c).cast("string"), F.col(c).cast("double") if _numeric(df, c) else null.cast("double")
        parts.append(F.struct(
            F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) - F.count(F.col(c))).alias("nulls"), F.min(number).alias("low"), F.max(number).alias("high"),
            F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)).alias("distinct"),
            (F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)) if _numeric(df, c) else null.cast("binary")).alias("quantiles")))
    one = df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])).alias("v")).select("v.*")
    counts = values.where("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return _with_heavy(one, _heaviest(counts))


def _with_heavy(one: DataFrame, heavy: DataFrame) -> DataFrame:
    return one.join(heavy, "column_name", "left").select(*COLUMNS[:-2], F.coalesce("heavy", F.create_map().cast("map<string,bigint>")).alias("heavy"), F.coalesce("heavy_bound", F.lit(0)).alias("heavy_bound"))


def merged_profiles(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows that the given profiles describe, from the profiles alone."""
    every = profiles[0]
    for p in profiles[1:]:
        every = every.unionByName(p)
    one = every.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
                                           F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
                                           F.max(F.col("quantiles").isNotNull()).alias("numbers"))
    one = one.withColumn("quantiles", F.when(F.col("numbers"), F.col("quantiles"))).drop("numbers")
    counts = every.select("column_name", F.explode("heavy").alias("value", "n")).groupBy("column_name", "value").agg(F.sum("n").alias("n"))
    return _with_heavy(one, _heaviest(counts, every.groupBy("column_name").agg(F.sum("heavy_bound").alias("bound"))))


def profile_report(sketches: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, rows, nulls, low, high, distinct_values, quantiles, heaviest): what the sketches tell."""
    some = F.col("rows") > F.col("nulls")
    return sketches.select(
        "column_name", "rows", "nulls", "low", "high", F.when(some, F.hll_sketch_estimate("distinct")).otherwise(0).cast("long").alias("distinct_values"),
        F.when(some & F.col("quantiles").isNotNull(), F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(s)) for s in shares])).alias("quantiles"),
        F.get(F.array_sort(F.map_entries("heavy"), lambda a, b: F.when(a["value"] > b["value"], -1).when(a["value"] < b["value"], 1).when(a["key"] < b["key"], -1).otherwise(1)), F.lit(0))["key"].alias("heaviest"))
