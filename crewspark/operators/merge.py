"""Merges and version comparison as joins.

``update_only`` is MERGE … WHEN MATCHED UPDATE; ``upsert`` is MERGE with
update-all and insert-all; ``version_diff`` compares two snapshots.  Each is
one shuffle join on the key (or a broadcast when AQE sees a small side).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schema import conform


def _key_cond(keys: list[str], left: str = "t", right: str = "s"):
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def assert_unique_keys(source: DataFrame, keys: list[str]) -> None:
    """A merge source may hold each key once (as MERGE requires)."""
    dup = source.groupBy(*keys).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"merge source has duplicate keys on {keys}")


def update_only(target: DataFrame, source: DataFrame, keys: list[str], cols: list[str],
                check_unique: bool = True) -> DataFrame:
    """Set ``cols`` from ``source`` where the key matches; other rows unchanged."""
    if check_unique:
        assert_unique_keys(source, keys)
    s = source.select(*keys, *cols).withColumn("__hit", F.lit(True))
    joined = target.alias("t").join(s.alias("s"), _key_cond(keys), "left")
    out = []
    for c in target.columns:
        if c in cols:
            out.append(F.when(F.col("s.__hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], check_unique: bool = True) -> DataFrame:
    """Matched rows take the source values, new keys are inserted.

    The source is conformed to the target schema by name first; a column the
    source lacks keeps the target value on update and is null on insert.
    """
    if check_unique:
        assert_unique_keys(source, keys)
    present = [f.name for f in target.schema.fields if f.name in source.columns]
    src = conform(source, target.schema).withColumn("__hit", F.lit(True))
    tgt = target.withColumn("__old", F.lit(True))
    joined = tgt.alias("t").join(src.alias("s"), _key_cond(keys), "full_outer")
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            out.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c in present:
            out.append(F.when(F.col("s.__hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out)


def version_diff(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows inserted, deleted or updated between two snapshots.

    Output: keys, ``change_type`` and ``changed_columns`` (names of the
    non-key columns that differ, null-safe, in schema order).
    """
    cols = [c for c in before.columns if c not in keys and c in after.columns]
    b = before.withColumn("__b", F.lit(True))
    a = after.withColumn("__a", F.lit(True))
    j = b.alias("b").join(a.alias("a"), _key_cond(keys, "b", "a"), "full_outer")
    diffs = F.array(*[F.when(~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")), F.lit(c)) for c in cols])
    changed = F.array_join(F.filter(diffs, lambda x: x.isNotNull()), ",")
    kind = (F.when(F.col("b.__b").isNull(), F.lit("insert"))
            .when(F.col("a.__a").isNull(), F.lit("delete"))
            .when(changed != "", F.lit("update")))
    return (j.select(*[F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in keys],
                     kind.alias("change_type"),
                     F.when(F.col("b.__b").isNotNull() & F.col("a.__a").isNotNull(), changed)
                      .otherwise(F.lit("")).alias("changed_columns"))
            .where(F.col("change_type").isNotNull()))
