"""Work and memory of a task stay bounded as tables grow; what briefs share is worked out once."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from crewspark.functions import skills as X
from crewspark.operators import clustering as K
from crewspark.operators import context as C
from crewspark.operators import similarity as V
from crewspark.sources import fixtures as FX
from crewspark.sources import tables as TB


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def raw(spark, tmp_path):
    spark.range(900).selectExpr("id % 300 AS l_orderkey", "id % 7 AS l_suppkey", "id % 5 AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(300).selectExpr("id AS o_orderkey", "id % 11 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(100).selectExpr("id AS c_custkey", "id % 25 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def test_views_are_built_in_more_tasks_as_tables_grow(spark, raw, monkeypatch):
    few = FX.Workforce(spark, raw, materialize=False)
    whole = rows_of(few.projects), rows_of(few.briefs)
    monkeypatch.setattr(FX, "DEALT", {"lineitem": ("l_orderkey", 100), "customer": (None, 10)})
    many = FX.Workforce(spark, raw, materialize=False)
    assert many.dealt("lineitem").rdd.getNumPartitions() == 9 and many.dealt("customer").rdd.getNumPartitions() == 10
    assert (rows_of(many.projects), rows_of(many.briefs)) == whole and len(whole[0]) == 900


def test_compaction_cuts_large_values_into_more_slots(spark, tmp_path, monkeypatch):
    df = spark.range(4000).selectExpr("id", "id * 7919 % 4001 AS a", "id % 2 AS part")
    t = TB.VersionedTable(spark, str(tmp_path / "t"), partition_col="part")
    t.overwrite(df)
    monkeypatch.setattr(TB, "SLOT_ROWS", 200)
    v = t.compact(["a"], files_per_partition=2)
    files = t.read(v).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 20 and max(r["count"] for r in files) < 400
    assert rows_of(t.read(v)) == rows_of(df)


def test_kmeans_rounds_run_on_a_partition_a_core(spark):
    rows = spark.range(600).selectExpr("id AS EmployeeID", "id % 9 AS Age", "id % 50 AS Cost_per_Hour", "0.5 AS Avg_Performance").repartition(40)
    sc = spark.sparkContext
    sc.setJobGroup("kmeans-growth", "")
    K.kmeans(rows, k=3, starts=2)
    sc.setJobGroup("after", "")
    track = sc.statusTracker()
    stages = {s for j in track.getJobIdsForGroup("kmeans-growth") for s in track.getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(track.getStageInfo, stages) if i is not None and i.numCompletedTasks]
    assert len(tasks) > 10 and sum(n > sc.defaultParallelism for n in tasks) <= 6


def test_sparse_text_vectors_are_the_dense_ones(spark):
    docs = spark.createDataFrame([(1, "spark and delta"), (2, "spark spark"), (3, ""), (4, None)], "id long, t string")
    dense = {r["id"]: r["embedding"] for r in V.embed_text(docs, "id", "t", num_features=64).collect()}
    for r in V.embed_text(docs, "id", "t", num_features=64, sparse=True).collect():
        at = dict(zip(r["embedding"]["indices"], r["embedding"]["values"]))
        assert [at.get(i, 0.0) for i in range(64)] == dense[r["id"]]


def test_briefs_with_one_description_share_its_answer(spark, monkeypatch):
    monkeypatch.setattr(C, "ANSWERED", 2)
    texts = ["Build a retail website with Python", "A thing with Go", None]
    rows = [(i, texts[i % 2], "") for i in range(12)] + [(None, texts[0], ""), (None, texts[1], ""), (20, texts[0], ""), (20, texts[0], ""), (21, texts[0], ""), (21, texts[1], ""), (22, None, "")]
    briefs = spark.createDataFrame(rows, "BriefID long, BriefText string, Reply string")
    projects = spark.createDataFrame([(p, e, f"Finance project using {s}", s, d) for p, s, d in [(1, "Python, SQL", "Finance"), (2, "Go", "Media"), (3, "Go, with", "Media")] for e in (p, p + 1)],
                                     "ProjectID long, EmployeeID long, Project_Description string, Tech_Stack_Used string, Domain string")
    people = spark.createDataFrame([(1, "Python, SQL", "Available", 10.0, "Media"), (2, "Go", "Available", 20.0, "Retail")], "EmployeeID long, Skills string, Availability string, Cost_per_Hour double, Domain_Expertise string")
    ctx = C.brief_context(briefs, people, projects, k=2)
    parsed = X.parse_reply(briefs)
    similar = V.top_k_by_text(parsed, V.build_index(projects), k=2)
    stacks, base = V.similar_stacks(similar, projects), V.base_fit(V.similar_rows(similar, projects.select("ProjectID", "EmployeeID")))
    domain = V.brief_domain(parsed, stacks)
    assert ctx.asked.count() == 2 + 7 and ctx.heavy.count() == 2
    assert rows_of(ctx.domain) == rows_of(domain)
    assert rows_of(ctx.for_all(ctx.asked_fit)) == rows_of(base) and base.count() > 24
    assert rows_of(ctx.for_all(V.tech_top_n(ctx.stacks, 8))) == rows_of(V.tech_top_n(stacks, 8))
    assert rows_of(ctx.fit(people)) == rows_of(V.project_fit(base, domain, people))
    pairs = base.where("BriefID is not null").select("BriefID", "EmployeeID")
    assert rows_of(ctx.fit_of(pairs)) == rows_of(base.where("BriefID is not null"))


def shuffled(df):
    """Rows that the shuffles of a collected frame's plan wrote."""
    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        own = plan.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        below = plan.children()
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_pairs_of_briefs_and_roster_are_not_shuffled(spark):
    fit = spark.createDataFrame([(b, e, 0.5) for b in range(60) for e in (b, b + 1, 1000)], "BriefID long, EmployeeID long, base_fit double")
    domains = spark.range(60).selectExpr("id AS BriefID", "if(id < 50, 'Media', 'Retail') AS Domain")
    people = spark.range(500).selectExpr("id AS EmployeeID", "if(id < 400, 'Media', 'Retail') AS Domain_Expertise")
    df = V.project_fit(fit, domains, people)
    got = df.collect()
    want = {(b, e): 0.5 for b in range(60) for e in (b, b + 1, 1000)}
    for b, e in [(b, e) for b in range(60) for e in (range(400) if b < 50 else range(400, 500))]:
        want[b, e] = want.get((b, e), 0.0) + 0.3
    assert {(r[0], r[1]): r[2] for r in got} == want and len(got) == len(want) > 21_000
    assert shuffled(df) < 2_000


def test_only_similar_projects_rows_are_shuffled(spark, monkeypatch):
    briefs = spark.createDataFrame([(1, "Build a website with Python", "")], "BriefID long, BriefText string, Reply string")
    projects = spark.range(3000).selectExpr("id div 3 AS ProjectID", "id AS EmployeeID", "concat('thing with ', if(id < 9, 'Python', 'Go')) AS Project_Description", "'SQL' AS Tech_Stack_Used", "'Media' AS Domain")
    people = spark.createDataFrame([(1, "Python, SQL", "Available", 10.0, "Media")], "EmployeeID long, Skills string, Availability string, Cost_per_Hour double, Domain_Expertise string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {}
        for limit in (C.FOUND_IDS, 0):
            monkeypatch.setattr(C, "FOUND_IDS", limit)
            rows = C.brief_context(briefs, people, projects, k=2).rows
            got[limit] = sorted(map(tuple, rows.collect())), shuffled(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[1 << 18][0] == got[0][0] and len(got[0][0]) == 6
    assert got[1 << 18][1] < 100 < 3000 <= got[0][1]


@pytest.mark.parametrize("part, cell", [(8192, 1 << 28), (3, 50)])
def test_roster_meets_null_and_repeated_keys_as_a_full_join_does(spark, monkeypatch, part, cell):
    monkeypatch.setattr(V, "ROSTER_ROWS", part)
    monkeypatch.setattr(V, "CELL_PAIRS", cell)
    fit = spark.createDataFrame([(1, 10, 0.5), (1, None, 1.0), (1, 15, 0.25), (None, 10, 1.0), (2, 11, 1.0), (4, 10, 0.5)], "BriefID long, EmployeeID long, base_fit double")
    domains = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, None), (None, "A"), (3, "B"), (4, "C")], "BriefID long, Domain string")
    people = spark.createDataFrame([(10, "A"), (10, "A"), (11, "A"), (None, "A"), (None, "A"), (10, "B"), (12, "B"), (13, None), (14, "A"), (16, "A")], "EmployeeID long, Domain_Expertise string")
    members = domains.join(people, F.col("Domain") == F.col("Domain_Expertise")).selectExpr("BriefID", "EmployeeID", "0.3D AS boost")
    both = fit.join(members, ["BriefID", "EmployeeID"], "full_outer").selectExpr("BriefID", "EmployeeID", "coalesce(base_fit, 0D) + coalesce(boost, 0D) AS fit")
    assert rows_of(V.project_fit(fit, domains, people)) == rows_of(both)


def test_language_calibration_reads_every_labelled_row(spark, monkeypatch):
    from crewspark.llm import language as L

    judged = []
    judge = L.LanguageModel.judge
    monkeypatch.setattr(L.LanguageModel, "judge", lambda self, rows, *rest: judged.append(rows.count()) or judge(self, rows, *rest))
    rows = spark.range(2600).selectExpr("id AS doc_id", "concat(if(id % 13 = 0, 'der Hund ', 'the dog '), id) AS text", "if(id % 13 = 0, 'de', 'en') AS lang")
    assert L.train(rows) is not None and judged == [2600]
