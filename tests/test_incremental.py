"""Clustered tables, stored states, snapshots with digests, checked CSV, statement-wide names, clustering in tiles."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewspark.operators import analytics as A
from crewspark.operators import clustering as K
from crewspark.operators import lifecycle as U
from crewspark.operators import similarity as V
from crewspark.operators.merge import version_diff
from crewspark.sources import tables as TB


def groups_touched(path, column, low, high):
    """Row groups whose statistics allow a value between low and high, and all row groups."""
    touched = every = 0
    for f in sorted(path.rglob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == column)
            every += 1
            touched += bool(stats.has_min_max and stats.max >= low and stats.min <= high)
    return touched, every


@pytest.mark.parametrize("partition", [None, "part"])
def test_compaction_helps_every_sort_column(spark, tmp_path, partition):
    rnd = random.Random(1)
    rows = [(i, rnd.randrange(1000), rnd.random() ** 4, f"name {rnd.randrange(10_000):04d}", f"p{i % 2}") for i in range(8000)] + [(9001, None, None, None, "p0"), (9002, None, None, None, None)]
    df = spark.createDataFrame(rows, "id long, a long, b double, c string, part string")
    t = TB.VersionedTable(spark, str(tmp_path / "t"), partition_col=partition)
    t.overwrite(df.repartition(7))
    t.compact(["a", "b", "c"], files_per_partition=27)
    v = t.latest_version()
    folder = tmp_path / "t" / "data" / f"version={v}"
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    for column, low, high in (("a", 100, 150), ("b", 0.9, 0.95), ("c", "name 0100", "name 0500")):
        touched, every = groups_touched(folder, column, low, high)
        assert every >= 20 and touched <= 0.6 * every, (column, touched, every)
    t.compact([], files_per_partition=2)
    assert t.read().count() == 8002


def test_curve_ranks_follow_order(spark):
    df = spark.createDataFrame([(i, float(i), f"{i:03d}") for i in range(100)], "id long, x double, s string").withColumn("g", F.lit(1))
    for cols in (["x"], ["s"], ["x", "s"]):
        keys = [r["k"] for r in TB.curve_key(df, "g", cols, "k").orderBy("id").collect()]
        assert keys == sorted(keys) and len(set(keys)) >= 30


def test_state_reads_the_appended_rows_only(spark, tmp_path):
    rows = [(p, e, None if e == 3 else (p * e % 7) / 7) for p in range(50) for e in range(5)]
    t = TB.VersionedTable(spark, str(tmp_path / "h"))
    schema = "ProjectID long, EmployeeID long, Individual_Performance_Score double"
    t.overwrite(spark.createDataFrame(rows, schema))
    state = U.performance_state(t.read(0))
    path = str(tmp_path / "state")
    state.write.parquet(path)
    v = t.append(spark.createDataFrame([(100, 1, 1.0), (100, 9, 0.25), (100, 8, None)], schema))
    new = U.updated_state(spark.read.parquet(path), t.appended(v))
    read = new.inputFiles()
    assert any("version=1" in f for f in read) and not any("version=0" in f for f in read)
    want = {r["EmployeeID"]: r["a"] for r in t.read().groupBy("EmployeeID").agg(F.avg("Individual_Performance_Score").alias("a")).collect()}
    got = {r["EmployeeID"]: r["Avg_Performance"] for r in U.state_averages(new).collect()}
    assert got.keys() == want.keys() and all(got[e] is None if want[e] is None else math.isclose(got[e], want[e]) for e in want)


def test_changed_index_equals_a_rebuild(spark):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(40)] + [None, ""]
    old = [(i, "D", rnd.choice(texts)) for i in range(200)]
    changed = [(i, "E", rnd.choice(texts + ["new words here"])) for i in range(150, 260)]
    gone = [(i,) for i in range(0, 60)]
    schema = "ProjectID long, Domain string, Project_Description string"
    index = V.DescriptionIndex.build(spark.createDataFrame(old, schema)).updated(spark.createDataFrame(changed, schema), spark.createDataFrame(gone, "ProjectID long"))
    left = {r[0]: r for r in old if r[0] >= 60} | {r[0]: r for r in changed}
    whole = V.DescriptionIndex.build(spark.createDataFrame(sorted(left.values()), schema))
    rows = lambda df, *cols: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert rows(index.entries, "ProjectID", "Domain", "Project_Description") == rows(whole.entries, "ProjectID", "Domain", "Project_Description")
    assert rows(index.tokens, "token", "df") == rows(whole.tokens, "token", "df") and index.n == whole.n
    assert rows(index.terms, "did", "token", "tf") == rows(whole.terms, "did", "token", "tf")
    assert rows(index.texts, "did", "users") == rows(whole.texts, "did", "users")
    weights, norms, idf = V.index_weights(whole.entries)
    want = {r["did"]: (r["n_terms"], round(r["norm"], 9)) for r in norms.withColumn("did", F.md5("Project_Description")).collect()}
    assert {r["did"]: (r["n_terms"], round(r["norm"], 9)) for r in index.norms().collect()} == want


def test_only_new_texts_are_tokenised(spark, monkeypatch):
    schema = "ProjectID long, Domain string, Project_Description string"
    index = V.DescriptionIndex.build(spark.createDataFrame([(i, "D", f"text {i % 10}") for i in range(100)], schema))
    read = []
    plain = V.text_terms
    monkeypatch.setattr(V, "text_terms", lambda rows, text: read.append(rows.count()) or plain(rows, text))
    index.updated(spark.createDataFrame([(1, "D", "text 3"), (2, "D", "fresh"), (200, "D", "fresh")], schema))
    assert read == [1]


def test_digests_name_the_buckets_to_join(spark, tmp_path):
    rows = [(i, f"n{i}", None if i % 5 else i / 3) for i in range(2000)]
    schema = "id long, name string, x double"
    after = [r for r in rows if r[0] not in (7, 8)] + [(5000, "new", None)]
    after = [(i, n, -1.0 if i == 500 else x) for i, n, x in after]
    a = TB.BucketedSnapshot(spark, str(tmp_path / "a"), ["id"]).write(spark.createDataFrame(rows, schema))
    b = TB.BucketedSnapshot(spark, str(tmp_path / "b"), ["id"]).write(spark.createDataFrame(after, schema).repartition(5))
    some = a.differing(b)
    assert 1 <= len(some) <= 4
    assert a.read(some).count() < 2000 * 4 * 2 / 64
    plan = a.read(some)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan.replace("isnotnull(_bucket#", "") or "_bucket" in plan.split("PartitionFilters")[1][:200]
    want = sorted(map(tuple, version_diff(spark.createDataFrame(rows, schema), spark.createDataFrame(after, schema), ["id"]).collect()))
    assert sorted(map(tuple, a.diff(b).collect())) == want and len(want) == 4
    assert a.differing(a) == [] and a.diff(a).count() == 0
    twice = TB.BucketedSnapshot(spark, str(tmp_path / "c"), ["id"]).write(spark.createDataFrame(rows + rows[:1], schema))
    assert len(a.differing(twice)) == 1
    with pytest.raises(ValueError):
        a.differing(TB.BucketedSnapshot(spark, str(tmp_path / "d"), ["id"], buckets=8).write(spark.createDataFrame(rows[:5], schema)))


def test_corrupt_lines_are_kept(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,x\n1,2.5\n2,abc\n3\n4,1,9\n,\n5,\n")
    rows, corrupt = TB.read_csv_checked(spark, str(tmp_path / "f.csv"), T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType())]))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, 2.5), (None, None), (5, None)], key=str)
    assert sorted(r[0] for r in corrupt.collect()) == ["2,abc", "3", "4,1,9"] and corrupt.count() == 3


def test_names_of_a_statement_are_its_own(spark):
    one, two = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int")
    spark.createDataFrame([(9,)], "x int").createOrReplaceTempView("people")
    first, second = A.run_sql(spark, "SELECT sum(x) AS s FROM people", people=one), A.run_sql(spark, "WITH t AS (SELECT x + 1 AS y FROM people) SELECT y FROM t ORDER BY y;", people=two)
    assert first.first()[0] == 1 and sorted(r[0] for r in second.collect()) == [3, 4]
    assert spark.table("people").first()[0] == 9
    assert A.run_sql(spark, "SELECT '{x}' AS s, x FROM people", people=one).first()[0] == "{x}"
    assert [r[0] for r in A.run_sql(spark, "SELECT x FROM people ORDER BY x DESC", people=two).collect()] == [3, 2]
    assert A.run_sql(spark, "SELECT 1 AS one").first()[0] == 1


def points(spark, n, seed=2, k=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) + 4 * rng.integers(0, k, (n, 1))
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "EmployeeID long, Age double, Cost_per_Hour double, Avg_Performance double")


def test_silhouettes_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(K, "TILE_ROWS", 64)
    x, std = points(spark, 300)
    label = np.arange(300) % 5
    label[label == 4] = 0
    label[17] = 9  # a cluster of one
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(label)], "EmployeeID long, cluster long")
    for form, fn in ((1, K.silhouette_euclidean), (2, K.silhouette)):
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) ** form
        s = []
        for i in range(300):
            mine = label == label[i]
            if mine.sum() == 1:
                s.append(0.0)
                continue
            a, b = d[i, mine].sum() / (mine.sum() - 1), min(d[i, label == c].mean() for c in set(label) - {label[i]})
            s.append((b - a) / max(a, b))
        assert math.isclose(fn(std, labels).first()[0], np.mean(s), rel_tol=1e-9)
        assert math.isnan(fn(std, labels.withColumn("cluster", F.lit(1).cast("long"))).first()[0])
        assert math.isnan(fn(std, labels.withColumn("cluster", F.col("EmployeeID"))).first()[0])


def test_nearest_of_many_centres(spark):
    x, std = points(spark, 200)
    c, centres = points(spark, 3000, seed=8)
    centres = centres.withColumnRenamed("EmployeeID", "cluster")
    got = {r["EmployeeID"]: r["cluster"] for r in K.assign(std, centres).collect()}
    want = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
    assert got == dict(enumerate(want.tolist()))
    assert K.assign(std, centres.limit(0)).count() == 0


def test_starts_advance_together(spark):
    x, std = points(spark, 240)
    labels, centres, costs = K.kmeans_starts(std, k=3, starts=6, rounds=30)
    assert len(centres) == len(costs) == 6 and min(costs) < 1.05 * sum(((x[:, None] - np.array(centres[int(np.argmin(costs))])[None]) ** 2).sum(2).min(1))
    got = {r["EmployeeID"]: r["cluster"] for r in labels.collect()}
    best = np.array(centres[int(np.argmin(costs))])
    assert got == dict(enumerate(((x[:, None] - best[None]) ** 2).sum(2).argmin(1).tolist()))
    mllib = K.kmeans(std.withColumn("x", F.lit(0)), k=3, starts=3)[2]
    assert min(costs) < 3 * 240 and mllib > 0
    with pytest.raises(ValueError):
        K.kmeans_starts(std.limit(2), k=3)
