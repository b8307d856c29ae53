"""Edge cases on hand-made frames (FIXTURES.md: small frames) and table behaviour."""

from __future__ import annotations

import math
import os

import pytest
from pyspark.sql import functions as F

from crewspark.functions import schema as S
from crewspark.functions import skills as X
from crewspark.operators import analytics as A
from crewspark.operators import clustering as K
from crewspark.operators import lifecycle as U
from crewspark.operators import merge as M
from crewspark.operators import similarity as V
from crewspark.session import scratch_path
from crewspark.sources import tables as TB
from crewspark.sources.fixtures import Workforce
from tests.conftest import SF_MID, SF_SMALL

EMP_DDL = ("EmployeeID long, Name string, Age int, Role string, Domain_Expertise string, Availability string, "
           "Skills string, Cost_per_Hour double")


def test_skill_tokens_and_canonical(spark):
    df = spark.createDataFrame([(1, " Python ,SQL,, Delta Lake "), (2, None), (3, "")], "id long, Skills string")
    got = {r["id"]: r["t"] for r in df.select("id", X.skill_tokens("Skills").alias("t")).collect()}
    assert got == {1: ["Python", "SQL", "Delta Lake"], 2: [], 3: []}
    canon = sorted(r["Skill"] for r in X.canonical_skills(df).collect())
    assert canon == ["Delta Lake", "Python", "SQL"]


def test_normalize_exact_containment_and_case(spark):
    canon = spark.createDataFrame([("Spark",), ("spark",), ("Delta Lake",), ("Go",), ("Python",)], "Skill string")
    items = spark.createDataFrame([(1, ["SPARK", " delta ", "govtech", "Kafka", "python", "Spark"])],
                                  "BriefID long, items array<string>")
    out = X.normalize_skills(items, canon).collect()[0]["skills"]
    # 'spark' key keeps the last spelling in sorted order ('spark'); 'delta' is contained in
    # 'delta lake'; 'go' is contained in 'govtech'; unknown items drop; duplicates keep first.
    assert out == ["spark", "Delta Lake", "Go", "Python"]


def test_phrase_and_domain(spark):
    df = spark.createDataFrame([(1, "A healthcare Dashboard with streaming"), (2, "nothing here"), (3, None)],
                               "id long, t string")
    got = {r["id"]: (r["p"], r["d"]) for r in
           df.select("id", X.phrase_skills("t").alias("p"), X.infer_domain("t").alias("d")).collect()}
    assert got[1][0] == ["Python", "SQL", "Spark", "Delta Lake", "Airflow", "AWS"]
    assert got[1][1] == "Healthcare"
    assert got[2] == ([], None)
    assert got[3] == ([], None)


def test_budget_regex(spark):
    df = spark.createDataFrame([(1, "10 people, $500"), (2, "under USD 1234/hour"), (3, "no number"),
                                (4, "1234567")], "id long, t string")
    got = {r["id"]: r["b"] for r in df.select("id", X.budget_from_text("t").alias("b")).collect()}
    assert got == {1: 10.0, 2: 1234.0, 3: None, 4: 123456.0}


def test_parse_reply_cases(spark):
    rows = [
        (1, '```json\n{"required_skills": ["Spark"], "max_budget_per_hour": 300, "project_description": "x"}\n```', "t $120"),
        (2, '// note\n{"required_skills": "Go", "max_budget_per_hour": null}', "text 55"),
        (3, '{"required_skills": ["A"], /* c */ "max_budget_per_hour": "abc"}', "t"),
        (4, '{"required_skills": ["A"', "cut reply $75/hour"),
        (5, None, "no reply 99"),
    ]
    df = spark.createDataFrame(rows, "BriefID long, Reply string, BriefText string")
    got = {r["BriefID"]: r for r in X.parse_reply(df).collect()}
    assert got[1]["required_skills"] == ["Spark"] and got[1]["max_budget_per_hour"] == 300.0
    assert got[1]["project_description"] == "x"
    assert got[2]["required_skills"] == ["Go"] and got[2]["max_budget_per_hour"] == 0.0
    assert got[2]["project_description"] == "text 55"
    assert got[3]["max_budget_per_hour"] == 0.0
    assert got[4]["reply_parsed"] is False and got[4]["max_budget_per_hour"] == 75.0
    assert got[4]["required_skills"] == []
    assert got[5]["max_budget_per_hour"] == 99.0


def test_split_known(spark):
    canon = spark.createDataFrame([("Python",), ("SQL",)], "Skill string")
    df = spark.createDataFrame([(1, ["python ", "Kafka", " ", "SQL"])], "BriefID long, required_skills array<string>")
    r = X.split_known_skills(df, canon).collect()[0]
    assert r["explicit_skills"] == ["python ", "SQL"]
    assert r["missing_skills"] == ["Kafka"]


def test_upsert_rejects_duplicate_source_keys(spark):
    t = spark.createDataFrame([(1, "a", 1.0)], "EmployeeID long, Name string, Cost_per_Hour double")
    s = spark.createDataFrame([(2, "b", 2.0), (2, "c", 3.0)], "EmployeeID long, Name string, Cost_per_Hour double")
    with pytest.raises(ValueError):
        M.upsert(t, s, ["EmployeeID"])


def test_upsert_missing_column_keeps_target(spark):
    t = spark.createDataFrame([(1, "a", 0.7), (2, "b", 0.9)], "EmployeeID long, Name string, Avg_Performance double")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "EmployeeID long, Name string")
    got = {r["EmployeeID"]: (r["Name"], r["Avg_Performance"]) for r in M.upsert(t, s, ["EmployeeID"]).collect()}
    assert got == {1: ("a", 0.7), 2: ("B", 0.9), 3: ("C", None)}


def test_update_only_keeps_unmatched(spark):
    t = spark.createDataFrame([(1, 0.0), (2, 0.0)], "EmployeeID long, Avg_Performance double")
    s = spark.createDataFrame([(2, 0.8), (9, 0.5)], "EmployeeID long, Avg_Performance double")
    got = {r["EmployeeID"]: r["Avg_Performance"] for r in
           M.update_only(t, s, ["EmployeeID"], ["Avg_Performance"]).collect()}
    assert got == {1: 0.0, 2: 0.8}


def test_version_diff_kinds(spark):
    b = spark.createDataFrame([(1, "a", None), (2, "b", 1.0), (3, "c", 2.0)], "id long, n string, v double")
    a = spark.createDataFrame([(1, "a", None), (2, "b", 5.0), (4, "d", 1.0)], "id long, n string, v double")
    got = {r["id"]: (r["change_type"], r["changed_columns"]) for r in M.version_diff(b, a, ["id"]).collect()}
    assert got == {2: ("update", "v"), 3: ("delete", ""), 4: ("insert", "")}


def test_versioned_table_chain_and_compaction(spark):
    t = TB.VersionedTable(spark, scratch_path(spark, "t"), partition_col="Domain")
    base = spark.createDataFrame([(1, "Finance", 1.0), (2, "Retail", 2.0)], "id long, Domain string, x double")
    assert t.overwrite(base) == 0
    assert t.append(spark.createDataFrame([("3", "Retail", "3.5")], "id string, Domain string, x string")) == 1
    assert t.read(0).count() == 2
    latest = t.read()
    assert latest.count() == 3 and dict(latest.dtypes)["id"] == "bigint"
    v = t.compact(["x"], files_per_partition=1)
    assert t.read().count() == 3
    local = t.path[len("file:"):] if t.path.startswith("file:") else t.path
    files = [f for _, _, fs in os.walk(f"{local}/data/version={v}") for f in fs if f.endswith(".parquet")]
    assert len(files) == 2  # one file per Domain partition
    hist = [(r["version"], r["operation"]) for r in TB.recent_history(t).collect()]
    assert hist == [(2, "OPTIMIZE"), (1, "WRITE (append)"), (0, "WRITE")]


def test_consecutive_ids(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "k").repartition(7)
    out = U.consecutive_ids(df, "k", 5001, "pid").orderBy("k").collect()
    assert [r["pid"] for r in out] == list(range(5001, 5001 + len(out)))


def test_next_project_id_empty(spark):
    empty = spark.createDataFrame([], "ProjectID long")
    assert A.next_project_id(empty).collect()[0][0] == 5001


def test_histogram_constant_values(spark):
    e = spark.createDataFrame([(1, 50.0), (2, 50.0)], "EmployeeID long, Cost_per_Hour double")
    rows = A.cost_histogram(e, bins=5).orderBy("bin").collect()
    assert [r["cnt"] for r in rows] == [2, 0, 0, 0, 0]


def test_coerce_and_clip(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), (None,)], "x string")
    got = [r[0] for r in df.select(S.coerce_numeric("x")).collect()]
    assert got == [12.5, 0.0, 0.0]
    got = [r[0] for r in spark.createDataFrame([(-1.0,), (0.5,), (3.0,)], "x double").select(S.clip01("x")).collect()]
    assert got == [0.0, 0.5, 1.0]


def test_standardize_zero_variance(spark):
    df = spark.createDataFrame([(1, 30, 5.0), (2, 40, 5.0)], "EmployeeID long, Age int, Cost_per_Hour double")
    rows = {r["EmployeeID"]: r for r in K.standardize(df, ["Age", "Cost_per_Hour"]).collect()}
    assert rows[1]["Cost_per_Hour"] == 0.0 and rows[1]["Age"] == -1.0 and rows[2]["Age"] == 1.0


def test_kmeans_best_of_starts_not_worse(spark):
    from tests.conftest import SF_MID
    from crewspark.plans.reports import enriched_employees

    emp = enriched_employees(Workforce(spark, SF_MID))
    labels, centres, cost = K.kmeans(emp, K.FEATURES, k=4, seed=42, starts=3)
    _, _, single = K.kmeans(emp, K.FEATURES, k=4, seed=42, starts=1)
    assert cost <= single + 1e-9
    assert len(centres) == 4
    assert {r["cluster"] for r in labels.collect()} <= {0, 1, 2, 3}
    with pytest.raises(ValueError):
        K.kmeans(emp.limit(2), K.FEATURES, k=4)


def test_pca_components_orthogonal(spark):
    from crewspark.plans.reports import enriched_employees

    emp = enriched_employees(Workforce(spark, SF_SMALL))
    pts = K.pca_2d(K.standardize(emp)).toPandas()
    # projections onto orthogonal components are uncorrelated
    cov = ((pts.pca1 - pts.pca1.mean()) * (pts.pca2 - pts.pca2.mean())).mean()
    assert abs(cov) < 1e-9


def test_silhouette_needs_more_rows_than_clusters(spark):
    std = spark.createDataFrame([(1, 0.0), (2, 1.0)], "EmployeeID long, Age double")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "EmployeeID long, cluster long")
    assert math.isnan(K.silhouette(std, labels, ["Age"]).collect()[0][0])


def test_top_k_blocks_agree(spark, monkeypatch):
    """Splitting the corpus into several blocks gives the same neighbours as one block."""
    wf = Workforce(spark, SF_SMALL)
    idx = wf.embeddings.withColumnRenamed("vec_id", "ProjectID")
    q = wf.embeddings.where("vec_id % 7 = 0").select(F.col("vec_id").alias("BriefID"), F.col("embedding").alias("qvec"))
    one = {tuple(r) for r in V.top_k_similar(q, idx, k=10).collect()}
    monkeypatch.setattr(V, "CORPUS_BLOCK_ROWS", 50)
    monkeypatch.setattr(V, "QUERY_BLOCK_ROWS", 20)
    monkeypatch.setattr(V, "QUERY_TILE_ROWS", 7)
    many = {tuple(r) for r in V.top_k_similar(q, idx, k=10).collect()}
    assert one == many and len(one) == 10 * q.count()


def test_codes_recall_and_exact_when_all_opened(spark, monkeypatch):
    wf = Workforce(spark, "/root/testdata/sf0.1")
    idx = wf.embeddings.withColumnRenamed("vec_id", "ProjectID")
    q = wf.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("BriefID"), F.col("embedding").alias("qvec"))
    exact = {tuple(r) for r in V.top_k_similar(q, idx, k=50).collect()}
    assert {tuple(r) for r in V.similar_by_codes(q, idx, k=50, share=1.0).collect()} == exact
    approx = {(r[0], r[1]) for r in V.similar_by_codes(q, idx, k=50).select("BriefID", "ProjectID").collect()}
    pairs = {(r[0], r[1]) for r in exact}
    assert len(approx) == 50 * q.count() and len(pairs & approx) / len(pairs) >= 0.9 and V.CODE_SHARE < 0.25
    monkeypatch.setattr(V, "CORPUS_BLOCK_ROWS", 30)  # blocks smaller than k are opened whole
    small = idx.limit(100)
    assert {tuple(r) for r in V.similar_by_codes(q.limit(3), small, k=50, share=0.01).collect()} == {tuple(r) for r in V.top_k_similar(q.limit(3), small, k=50).collect()}


def test_embed_text_unit_vectors(spark):
    docs = spark.createDataFrame([(1, "spark and delta"), (2, "spark spark"), (3, "")], "id long, t string")
    rows = {r["id"]: r["embedding"] for r in V.embed_text(docs, "id", "t", num_features=64).collect()}
    assert abs(sum(x * x for x in rows[1]) - 1.0) < 1e-9
    assert all(x == 0 for x in rows[3])


def test_project_fit_salting_does_not_change_result(spark):
    fit = spark.createDataFrame([(1, 10, 1.0), (1, 11, 0.5), (2, 12, 1.0)], "BriefID long, EmployeeID long, base_fit double")
    dom = spark.createDataFrame([(1, "Finance"), (2, None), (3, "Retail")], "BriefID long, Domain string")
    emp = spark.createDataFrame([(10, "Finance"), (13, "Finance"), (14, "Retail")],
                                "EmployeeID long, Domain_Expertise string")
    one = sorted(tuple(r) for r in V.project_fit(fit, dom, emp, 0.3, salt_buckets=1).collect())
    many = sorted(tuple(r) for r in V.project_fit(fit, dom, emp, 0.3, salt_buckets=5).collect())
    assert one == many
    assert one == [(1, 10, 1.3), (1, 11, 0.5), (1, 13, 0.3), (2, 12, 1.0), (3, 14, 0.3)]


def test_index_holds_every_project_and_merged_ones(spark):
    import __spark_entry__ as entry

    wf = Workforce(spark, SF_SMALL)
    assert entry.queries()["embedding_index"](spark, SF_SMALL).count() == wf.projects.select("ProjectID").distinct().count()
    assert entry.queries()["reindex_after_merge"](spark, SF_SMALL).where("ProjectID >= 10000000").count() > 0


def test_consecutive_ids_of_many_rows(spark):
    """Two million rows with a payload: the plan's consumers must read one numbering."""
    from crewspark.operators.lifecycle import consecutive_ids
    from crewspark.session import written

    n = 2_000_000
    rows = spark.range(n).select(((F.col("id") * 7919) % n).alias("k"), F.concat(F.lit("name "), "id").alias("name"))
    got = written(consecutive_ids(rows, "k", 5001, "seq"), "many-ids")
    assert tuple(got.agg(F.count_distinct("seq"), F.min("seq"), F.max("seq")).first()) == (n, 5001, 5000 + n)
    assert got.where(F.col("seq") != F.col("k") + 5001).count() == 0


def test_versioned_table_refuses_to_lose_data(spark, tmp_path):
    import os

    from crewspark.sources import tables as TB

    t = TB.VersionedTable(spark, str(tmp_path / "t"), partition_col="Domain")
    first = spark.createDataFrame([(i, "00%d" % (i % 3 + 5), i) for i in range(60)], "id long, Domain string, n int")
    t.overwrite(first)
    assert {r["Domain"] for r in t.read().collect()} == {"005", "006", "007"}
    t.merge(spark.createDataFrame([(1, "006", 100), (99, "007", 1)], "id long, Domain string, n int"), ["id"])
    assert {(r["id"], r["n"]) for r in t.read().collect() if r["id"] in (1, 99)} == {(1, 100), (99, 1)}
    assert t.read(0).count() == 60 and t.read().count() == 61
    t.compact(["n"], files_per_partition=3)
    version = t.latest_version()
    for domain in ("005", "006", "007"):
        folder = tmp_path / "t" / "data" / f"version={version}" / f"Domain={domain}"
        files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
        assert 2 <= len(files) <= 4
        for f in files:
            ns = [r["n"] for r in spark.read.parquet(str(folder / f)).collect()]
            assert ns == sorted(ns) and len(ns) < 20
    os.rename(tmp_path / "t" / "_history", tmp_path / "t" / "_gone")
    with pytest.raises(ValueError):
        t.append(first.limit(1))
    with pytest.raises(ValueError):
        t.history()


@pytest.mark.parametrize("reply,skills,budget,ok", [
    ('{"required_skills": ["Go"], // main\n "max_budget_per_hour": 90}', ["Go"], 90.0, True),
    ('Sure:\n```json\n{"required_skills": "Go", "max_budget_per_hour": 5}\n```\nDone // bye', ["Go"], 5.0, True),
    ('{"required_skills": ["C // C++"], "max_budget_per_hour": 1, "project_description": "a ```b``` /* c */ http://d"}', ["C // C++"], 1.0, True),
    ("42", [], 300.0, False), ('["Go"]', [], 300.0, False), ('{"required_skills": ["Go"', [], 300.0, False), (None, [], 300.0, False),
])
def test_replies_with_comments_and_prose(spark, reply, skills, budget, ok):
    from crewspark.functions import skills as X

    r = X.parse_reply(spark.createDataFrame([(1, "a site for $300/hour", reply)], "BriefID long, BriefText string, Reply string")).first()
    assert (r["required_skills"], r["max_budget_per_hour"], r["reply_parsed"]) == (skills, budget, ok)
    if reply and "```b```" in reply:
        assert r["project_description"] == "a ```b``` /* c */ http://d"


def test_team_rules(spark):
    """A size cap of 0 means none, and more than 63 required skills are no special case."""
    from crewspark.operators import teams as TM

    many = ", ".join(f"skill{i}x" for i in range(70))
    emp = spark.createDataFrame([(1, "Available", 10.0, 40, "a, b", "HR", 0.5), (2, "Available", 20.0, 20, many, "IT", 1.0), (3, "Busy", 1.0, 50, "zz", "IT", 1.0)],
                                "EmployeeID long, Availability string, Cost_per_Hour double, Age int, Skills string, Domain_Expertise string, Avg_Performance double")
    # 1: soft skills don't count beside explicit ones; 5: they do without; 2: they count once relaxed; 6: none inferred, the explicit ones become soft
    briefs = spark.createDataFrame([(1, 30.0, many.split(", "), ["b", "c9"], "IT"), (2, 29.0, ["a"], ["zz", "skill7"], "HR"), (3, 10.0, ["zz"], [], None), (4, 40.0, [" A "], [], None),
                                    (5, 30.0, [], ["B", "skill7x", "zz"], "IT"), (6, 10.0, ["Skill7x", "skill7x"], [], "HR"), (7, 50.0, [], [], "IT")],
                                   "BriefID long, budget double, explicit array<string>, inferred array<string>, Domain string")
    members = spark.createDataFrame([(b, "given", e) for b, who in ((1, (1, 2)), (2, (1, 2)), (3, (1, 2)), (4, (3,)), (5, (1,)), (6, (1,))) for e in who], "BriefID long, source string, EmployeeID long")
    given = {"sources": ("given",)}
    got = {r["BriefID"]: r for r in TM.evaluate_teams(members, briefs, emp, TM.TeamParams(max_team_size=0), **given).collect()}
    assert {b: r["status"] for b, r in got.items()} == {1: "ok", 2: "ok_relaxed", 3: "skill_absent", 4: "no_members", 5: "ok", 6: "ok_relaxed", 7: "no_members"}
    assert got[1]["objective"] == (2 * 500 + 3 * 300 + 2 * 1000) / 1000 and got[1]["uncovered_soft"] == ""
    assert got[2]["objective"] == (2 * 500 + 3 * 300 + 2 * 1000) / 1000  # zz: nobody available holds it
    assert got[5]["objective"] == (2 * 500 - 1000) / 1000 and got[5]["uncovered_soft"] == "skill7x"
    assert got[6]["objective"] == (2 * 500 + 3 * 300 - 2000) / 1000 and got[6]["missing_required"] == "skill7x"
    assert got[3]["objective"] is None
    capped = {r["BriefID"]: r["status"] for r in TM.evaluate_teams(members, briefs, emp, TM.TeamParams(max_team_size=1), **given).collect()}
    assert capped[1] == "ok_relaxed"
    fit = spark.createDataFrame([(1, 1, 0.5), (5, 1, 1.0), (9, 1, 1.0)], "BriefID long, EmployeeID long, base_fit double")
    fitted = {r["BriefID"]: r["objective"] for r in TM.evaluate_teams(members, briefs, emp, base_fit=fit, **given).collect()}
    assert fitted[1] == got[1]["objective"] + 1.5 and fitted[5] == got[5]["objective"] + 3 and fitted[6] == got[6]["objective"]
    plan = TM.evaluate_teams(members, briefs, emp, **given)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


def test_nobody_available(spark):
    from crewspark.operators import teams as TM

    schema = "EmployeeID long, Availability string, Cost_per_Hour double, Age int, Skills string, Domain_Expertise string, Avg_Performance double"
    emp = spark.createDataFrame([(i, "Busy", 100.0 - i, 40, "a", "HR", 0.5) for i in (9, 4, 7, 5)], schema)
    briefs = spark.createDataFrame([(1,), (2,)], "BriefID long")
    assert sorted(tuple(r) for r in TM.fallback_members(briefs, emp).collect()) == [(b, "fallback", e) for b in (1, 2) for e in (4, 5, 7)]
    asked = briefs.selectExpr("BriefID", "10D AS budget", "'HR' AS Domain", "array('a') AS explicit", "array('a') AS inferred")
    got = TM.evaluate_teams(TM.fallback_members(briefs, emp), asked, emp).collect()
    assert sorted((r["BriefID"], r["source"], r["status"]) for r in got) == [(b, s, "nobody_available") for b in (1, 2) for s in ("fallback", "history")]
    assert TM.fallback_members(briefs, emp.limit(0)).count() == 0
    assert [r["budget"] for r in TM.budget_heuristic(briefs.withColumn("max_budget_per_hour", F.lit(0.0)), emp).collect()] == [100.0, 100.0]
