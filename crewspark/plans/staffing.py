"""Registered queries: team search, project lifecycle and workforce clustering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clustering as K
from ..operators import lifecycle as U
from ..operators import teams as TM
from ..session import scratch_path, written
from ..sources import tables as TB
from ..sources.fixtures import Workforce, with_views
from .registry import register
from .reports import ENRICHED_SQL, enriched_employees
from .retrieval import chain, context

PARAMS = TM.TeamParams()


_ASKED: dict[tuple[str, str], DataFrame] = {}


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """What each brief asks for (budget, domain, explicit and inferred skills), written once a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _ASKED:
        _, _, ctx = context(spark, d)
        asked = ctx.split.select("BriefID", F.col("explicit_skills").alias("explicit")).join(ctx.inferred, "BriefID").join(ctx.budget, "BriefID").join(ctx.domain, "BriefID")
        _ASKED[key] = written(asked.select("BriefID", "budget", "Domain", "explicit", "inferred"), "asked")
    return _ASKED[key]


def _given_teams(spark: SparkSession, d: str):
    """The fallback team and the domain's latest team of every brief, and how they fare."""
    wf, emp, ctx = context(spark, d)
    asked = _asked(spark, d)
    members = TM.fallback_members(asked, emp).unionByName(TM.history_members(asked, wf.projects))
    return wf, emp, members, TM.evaluate_teams(members, asked, emp, PARAMS, base_fit=ctx.fit_of(members))


_MEMBERS_SQL = """
SELECT a.BriefID, 'fallback' AS source, f.EmployeeID FROM asked a,
  (SELECT EmployeeID FROM emp WHERE Availability = 'Available' OR NOT EXISTS (SELECT 1 FROM emp WHERE Availability = 'Available')
   ORDER BY CASE WHEN Availability = 'Available' THEN Cost_per_Hour END, EmployeeID LIMIT 3) f
UNION
SELECT a.BriefID, 'history' AS source, p.EmployeeID FROM asked a JOIN projects p ON p.Domain = a.Domain
  JOIN (SELECT Domain, max(ProjectID) AS ProjectID FROM projects GROUP BY Domain) l ON l.Domain = p.Domain AND l.ProjectID = p.ProjectID"""

# Inferred skills in canonical spelling, lower-cased, in order of their first appearance.
_LIKELY_SQL = """
SELECT BriefID, list(lower(value) ORDER BY pos) AS inferred FROM (
  SELECT BriefID, value, min(pos) AS pos FROM (
    SELECT t.BriefID, t.pos, arg_min(k.value, (k.key <> t.low, k.ord)) AS value
    FROM (SELECT BriefID, lower(trim(unnest(items))) AS low, generate_subscripts(items, 1) AS pos FROM items) t
    JOIN canon_keys k ON t.low <> '' AND (contains(t.low, k.key) OR contains(k.key, t.low)) GROUP BY t.BriefID, t.pos) m
  GROUP BY BriefID, value) f GROUP BY BriefID"""

# Soft skills only where no skill is explicit; once relaxed nothing is required and the inferred ones (else the explicit ones) are soft.
_ASKED_SQL = """
SELECT BriefID, budget, Domain, required, CASE WHEN len(required) > 0 THEN []::VARCHAR[] ELSE inferred END AS soft,
  CASE WHEN len(inferred) > 0 THEN inferred ELSE required END AS relaxed_soft
FROM (SELECT p.BriefID, bud.budget, d.Domain, coalesce(l.inferred, []::VARCHAR[]) AS inferred,
        list_filter(list_transform(p.required_skills, lambda s: lower(trim(s))), lambda s: list_contains(ck.keys, s)) AS required
      FROM parsed p JOIN bud ON bud.BriefID = p.BriefID JOIN bdom d ON d.BriefID = p.BriefID LEFT JOIN likely l ON l.BriefID = p.BriefID,
        (SELECT list(key) AS keys FROM canon_keys) ck) x"""

_JUDGED_SQL = """
SELECT a.BriefID, s.source, any_value(a.budget) AS budget, any_value(a.required) AS required, any_value(a.soft) AS soft, any_value(a.relaxed_soft) AS relaxed_soft,
  count(e.EmployeeID) AS team_size, sum(e.Cost_per_Hour) AS cost, avg(e.Age) AS age, sum(round_even(e.Cost_per_Hour * 100, 0)) AS cents,
  sum(round_even((e.Age - 30) * 100, 0)) AS age_shift,
  sum(3 * round_even((coalesce(bf.base_fit, 0.0) + CASE WHEN e.Domain_Expertise = a.Domain THEN 0.3 ELSE 0.0 END) * 1000, 0)
      + 2 * round_even(least(1.0, greatest(0.0, e.Avg_Performance)) * 1000, 0)) AS points,
  coalesce(string_agg(lower(e.Skills), chr(10)), '') AS texts
FROM asked a CROSS JOIN (SELECT unnest(['fallback', 'history']) AS source) s LEFT JOIN members t ON t.BriefID = a.BriefID AND t.source = s.source
LEFT JOIN (SELECT * FROM emp WHERE Availability = 'Available') e ON e.EmployeeID = t.EmployeeID
LEFT JOIN bf ON bf.BriefID = a.BriefID AND bf.EmployeeID = e.EmployeeID
GROUP BY a.BriefID, s.source"""

_SKILLS_SQL = """
SELECT *, list_filter(list_distinct(required), lambda s: NOT contains(texts, s)) AS missing, list_filter(required, lambda s: NOT contains(everyone, s)) AS absent,
  list_filter(soft, lambda s: contains(everyone, s) AND NOT contains(texts, s)) AS uncovered,
  list_filter(relaxed_soft, lambda s: contains(everyone, s) AND NOT contains(texts, s)) AS relaxed_uncovered
FROM judged, (SELECT string_agg(lower(Skills), chr(10)) AS everyone FROM emp WHERE Availability = 'Available') w"""

_STATUS_SQL = """
SELECT *, CASE WHEN everyone IS NULL THEN 'nobody_available' WHEN team_size = 0 THEN 'no_members'
       WHEN len(missing) = 0 AND cents <= round_even(budget * 100, 0) AND age_shift >= 0 THEN 'ok'
       WHEN cents <= round_even(round_even(budget * 1.3, 2) * 100, 0) AND age_shift >= 0 THEN 'ok_relaxed'
       WHEN len(absent) > 0 THEN 'skill_absent' WHEN len(missing) > 0 THEN 'skill_missing'
       WHEN cents > round_even(budget * 100, 0) THEN 'over_budget' WHEN age_shift < 0 THEN 'too_young' ELSE 'too_large' END AS status
FROM skilled"""

_VERDICT_SQL = """
SELECT BriefID, source, status, team_size, budget, cost AS total_cost_per_hour, age AS avg_age,
  CASE status WHEN 'ok' THEN (points - 1000 * len(uncovered)) / 1000.0 WHEN 'ok_relaxed' THEN (points - 1000 * len(relaxed_uncovered)) / 1000.0 END AS objective,
  array_to_string(list_sort(missing), '|') AS missing_required,
  array_to_string(list_sort(CASE WHEN status = 'ok' THEN uncovered ELSE relaxed_uncovered END), '|') AS uncovered_soft
FROM stated"""

_TEAM_CTES = [("likely", _LIKELY_SQL), ("asked", _ASKED_SQL), ("members", _MEMBERS_SQL), ("judged", _JUDGED_SQL), ("skilled", _SKILLS_SQL), ("stated", _STATUS_SQL), ("verdict", _VERDICT_SQL)]


def _team_sql(select: str) -> str:
    return chain(["parsed", "canon_keys", "items", "bdom", "bf", "emp", "bud", "projects"]).rstrip() + ", " + ", ".join(f"{n} AS ({q})" for n, q in _TEAM_CTES) + "\n" + select


@register("team_summary", _team_sql("SELECT * FROM verdict"), round_cols=["budget", "objective", "total_cost_per_hour", "avg_age"], bench=True)
def q_team_summary(spark: SparkSession, d: str) -> DataFrame:
    """The fallback team and the domain's latest team of every brief, measured
    against its budget, age and skill rules, strictly and relaxed."""
    return _given_teams(spark, d)[3]


@register("team_status", _team_sql("SELECT source, status, count(*) AS briefs FROM verdict GROUP BY ALL"))
def q_team_status(spark: SparkSession, d: str) -> DataFrame:
    """Teams per outcome."""
    return _given_teams(spark, d)[3].groupBy("source", "status").agg(F.count(F.lit(1)).alias("briefs"))


@register("team_details", _team_sql("""SELECT m.BriefID, m.source, m.EmployeeID, e.Name, e.Age, e.Role, e.Skills, e.Cost_per_Hour, e.Avg_Performance
FROM members m JOIN emp e ON e.EmployeeID = m.EmployeeID"""), round_cols=["Avg_Performance"])
def q_team_details(spark: SparkSession, d: str) -> DataFrame:
    """Each member of the given teams with their profile."""
    _, emp, members, _ = _given_teams(spark, d)
    return TM.team_details(members, emp)


@register("fallback_per_brief", _team_sql("SELECT BriefID, EmployeeID, 'fallback' AS status FROM members WHERE source = 'fallback'"))
def q_fallback_per_brief(spark: SparkSession, d: str) -> DataFrame:
    """T9 for every brief: the three cheapest available people."""
    wf = Workforce(spark, d)
    return TM.fallback_members(wf.briefs, wf.employees).withColumnRenamed("source", "status")


def _completed(wf: Workforce, members: DataFrame, teams: DataFrame) -> DataFrame:
    """Briefs whose domain team passes, as completed projects."""
    done = teams.where("source = 'history' and status in ('ok', 'ok_relaxed')").select("BriefID", "source")
    # read by the new ids and by the members
    return written(U.completed_from_teams(members.join(done, ["BriefID", "source"]).groupBy("BriefID").agg(F.collect_list("EmployeeID").alias("team")), wf.briefs), "completed")


@register("lifecycle_batch", _team_sql("""
, done AS (SELECT BriefID, (SELECT max(ProjectID) FROM projects) + row_number() OVER (ORDER BY BriefID) AS ProjectID
           FROM verdict WHERE source = 'history' AND status IN ('ok', 'ok_relaxed')),
recs AS (SELECT d.ProjectID, e.EmployeeID, b.BriefText, e.Skills, e.Domain_Expertise, e.Role, coalesce(e.Avg_Performance, 0.85) AS score
         FROM done d JOIN members m ON m.BriefID = d.BriefID AND m.source = 'history' JOIN emp e ON e.EmployeeID = m.EmployeeID JOIN briefs b ON b.BriefID = d.BriefID)
SELECT ProjectID, EmployeeID, 'New Project based on: ' || substring(BriefText, 1, 30) || '…' AS Project_Name,
  'Completed project based on request: ' || BriefText AS Project_Description, Skills AS Tech_Stack_Used, Domain_Expertise AS Domain, Role AS Project_Role,
  avg(score) OVER (PARTITION BY ProjectID) AS Project_Success_Score, score AS Individual_Performance_Score FROM recs"""),
    round_cols=["Project_Success_Score", "Individual_Performance_Score"])
def q_lifecycle_batch(spark: SparkSession, d: str) -> DataFrame:
    """Every passing team becomes a completed project, scored member by member
    (their mean performance so far), appended to the history."""
    wf, emp, members, teams = _given_teams(spark, d)
    scores = members.where("source = 'history'").join(emp.select("EmployeeID", F.col("Avg_Performance").alias("score")), "EmployeeID")
    recs = U.completion_records(_completed(wf, members, teams), emp, wf.projects, scores)
    table = history_table(wf)
    version = table.append(recs, "WRITE (append)", base=0)
    return table.read(version).where(F.col("ProjectID") > wf.projects.select(F.max("ProjectID")).scalar()).select(*wf.projects.columns)


_HISTORY: dict[tuple[str, str], TB.VersionedTable] = {}


def history_table(wf: Workforce) -> TB.VersionedTable:
    """The projects history as a versioned table, committed once a session; queries append to version 0."""
    key = (wf.spark.sparkContext.applicationId, wf.sf_dir)
    if key not in _HISTORY:
        table = TB.VersionedTable(wf.spark, scratch_path(wf.spark, "projects-history"), partition_col="Domain")
        table.overwrite(wf.projects, "WRITE")
        _HISTORY[key] = table
    return _HISTORY[key]


# Completed team for the SQL-checked lifecycle queries: the reference's
# fallback team (three cheapest available people).
FALLBACK_SQL = """
SELECT EmployeeID FROM employees WHERE Availability = 'Available' ORDER BY Cost_per_Hour, EmployeeID LIMIT 3"""


def _fallback_completion(wf: Workforce) -> DataFrame:
    from ..operators.analytics import fallback_team

    team = fallback_team(wf.employees).agg(F.collect_list("EmployeeID").alias("team"))
    return team.select(F.lit(0).cast("long").alias("BriefID"), "team",
                       F.lit("New Project based on: fallback team…").alias("Project_Name"),
                       F.lit("Completed project based on request: fallback team").alias("Project_Description"))


_RECORDS_SQL = """
SELECT (SELECT coalesce(max(ProjectID), 5000) + 1 FROM projects) AS ProjectID, e.EmployeeID,
       'New Project based on: fallback team…' AS Project_Name,
       'Completed project based on request: fallback team' AS Project_Description,
       e.Skills AS Tech_Stack_Used, e.Domain_Expertise AS Domain, e.Role AS Project_Role,
       0.85 AS Project_Success_Score, 0.85 AS Individual_Performance_Score
FROM employees e WHERE e.EmployeeID IN (""" + FALLBACK_SQL + ")"


@register("lifecycle_records", with_views(["employees", "projects"]) + """
SELECT ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used, Domain, Project_Role,
       CAST(Project_Success_Score AS DOUBLE) AS Project_Success_Score,
       CAST(Individual_Performance_Score AS DOUBLE) AS Individual_Performance_Score
FROM (""" + _RECORDS_SQL + ") r", round_cols=["Project_Success_Score"])
def q_lifecycle_records(spark: SparkSession, d: str) -> DataFrame:
    """U1+U2: history rows for a completed team (team mean as project success)."""
    wf = Workforce(spark, d)
    return U.completion_records(_fallback_completion(wf), wf.employees, wf.projects)


@register("lifecycle_append", with_views(["employees", "projects"]) + """
SELECT ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used, Domain, Project_Role,
       CAST(Project_Success_Score AS DOUBLE) AS Project_Success_Score,
       CAST(Individual_Performance_Score AS DOUBLE) AS Individual_Performance_Score
FROM (SELECT * FROM projects UNION ALL """ + _RECORDS_SQL + ") r", round_cols=["Project_Success_Score"])
def q_lifecycle_append(spark: SparkSession, d: str) -> DataFrame:
    """Conform by name and append as a new table version; read the latest snapshot."""
    wf = Workforce(spark, d)
    t = history_table(wf)
    v = t.append(U.completion_records(_fallback_completion(wf), wf.employees, wf.projects), base=0)
    return t.read(v).select(*wf.projects.columns)


@register("next_project_ids", with_views(["briefs", "projects"]) + """
SELECT BriefID, (SELECT coalesce(max(ProjectID), 5000) + 1 FROM projects) + row_number() OVER (ORDER BY BriefID) - 1
       AS ProjectID FROM briefs""")
def q_next_ids(spark: SparkSession, d: str) -> DataFrame:
    """U1 for a batch: consecutive new ids after the current maximum, in BriefID order."""
    wf = Workforce(spark, d)
    start = wf.projects.select(F.coalesce(F.max("ProjectID"), F.lit(5000)) + 1).scalar()
    return U.consecutive_ids(wf.briefs.select("BriefID"), "BriefID", start, "ProjectID")


# ---------------------------------------------------------------- clustering
_F = K.FEATURES
_STD_SQL = ("SELECT f.EmployeeID, " + ", ".join(
    f"CASE WHEN s.s_{c} = 0 THEN 0.0 ELSE (f.{c} - s.m_{c}) / s.s_{c} END AS {c}" for c in _F) +
    " FROM (SELECT EmployeeID, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _F) +
    " FROM emp) f, (SELECT " + ", ".join(f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{c}, "
                                         f"stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS s_{c}" for c in _F) +
    " FROM emp) s")

_CENTRES_SQL = ("SELECT CAST(row_number() OVER (ORDER BY e.Domain_Expertise) - 1 AS BIGINT) AS cluster, " +
                ", ".join(f"avg(s.{c}) AS {c}" for c in _F) +
                " FROM std s JOIN emp e ON s.EmployeeID = e.EmployeeID GROUP BY e.Domain_Expertise")

_D2 = " + ".join(f"(s.{c} - c.{c}) * (s.{c} - c.{c})" for c in _F)
_ASSIGN_SQL = (f"SELECT EmployeeID, cluster FROM (SELECT s.EmployeeID, c.cluster, row_number() OVER "
               f"(PARTITION BY s.EmployeeID ORDER BY {_D2}, c.cluster) AS rn FROM std s CROSS JOIN centres c) x "
               f"WHERE rn = 1")

_CLUSTER_CTES = [("emp", ENRICHED_SQL), ("std", _STD_SQL), ("centres", _CENTRES_SQL), ("assigned", _ASSIGN_SQL)]


def _std(spark: SparkSession, d: str):
    emp = enriched_employees(Workforce(spark, d))
    return emp, K.standardize(emp)


def _domain_centres(emp: DataFrame, std: DataFrame) -> DataFrame:
    """Centres for K4: the mean standardised profile of each expertise domain (k = 6)."""
    from pyspark.sql import Window

    means = std.join(emp.select("EmployeeID", "Domain_Expertise"), "EmployeeID").groupBy("Domain_Expertise") \
        .agg(*[F.avg(c).alias(c) for c in _F])
    return means.withColumn("cluster", (F.row_number().over(Window.orderBy("Domain_Expertise")) - 1).cast("long"))


@register("standardize_features", with_views(["employees", "projects"], _CLUSTER_CTES[:2]) + "SELECT * FROM std",
          round_cols=_F)
def q_standardize(spark: SparkSession, d: str) -> DataFrame:
    return _std(spark, d)[1]


@register("kmeans_assign", with_views(["employees", "projects"], _CLUSTER_CTES) + "SELECT * FROM assigned")
def q_kmeans_assign(spark: SparkSession, d: str) -> DataFrame:
    """K4: nearest of the given centres (per-domain mean profiles)."""
    emp, std = _std(spark, d)
    return K.assign(std, _domain_centres(emp, std))


_SIL_SQL = (
    ", pts AS (SELECT s.*, a.cluster, " + " + ".join(f"s.{c} * s.{c}" for c in _F) + " AS nn FROM std s JOIN assigned a "
    "ON s.EmployeeID = a.EmployeeID), "
    "st AS (SELECT cluster AS cc, count(*) AS cn, sum(nn) AS cs, " + ", ".join(f"sum({c}) AS sum_{c}" for c in _F) +
    " FROM pts GROUP BY cluster), "
    "per AS (SELECT p.EmployeeID, p.cluster, st.cc, st.cn, st.cn * p.nn - 2 * (" +
    " + ".join(f"p.{c} * st.sum_{c}" for c in _F) + ") + st.cs AS tot FROM pts p CROSS JOIN st), "
    "own AS (SELECT EmployeeID, CASE WHEN cn > 1 THEN tot / (cn - 1) END AS a, cn FROM per WHERE cc = cluster), "
    "oth AS (SELECT EmployeeID, min(tot / cn) AS b FROM per WHERE cc <> cluster GROUP BY EmployeeID), "
    "sv AS (SELECT CASE WHEN own.cn = 1 OR oth.b IS NULL THEN 0.0 WHEN a < b THEN 1 - a / b "
    "WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM own LEFT JOIN oth ON own.EmployeeID = oth.EmployeeID) "
    "SELECT CASE WHEN (SELECT count(*) FROM pts) > (SELECT count(*) FROM st) THEN avg(s) "
    "ELSE CAST('nan' AS DOUBLE) END AS silhouette FROM sv")


@register("silhouette", with_views(["employees", "projects"], _CLUSTER_CTES).rstrip() + _SIL_SQL,
          round_cols=["silhouette"])
def q_silhouette(spark: SparkSession, d: str) -> DataFrame:
    """K5 on the K4 labels (squared-Euclidean silhouette, exact from cluster sums)."""
    emp, std = _std(spark, d)
    return K.silhouette(std, K.assign(std, _domain_centres(emp, std)))


@register("silhouette_euclidean", with_views(["employees", "projects"], _CLUSTER_CTES).rstrip() + """
, pts AS (SELECT s.*, a.cluster FROM std s JOIN assigned a ON a.EmployeeID = s.EmployeeID),
tot AS (SELECT x.EmployeeID, x.cluster, y.cluster AS other, sum(sqrt(""" + " + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in _F) + """)) AS total, count(*) AS size
        FROM pts x, pts y GROUP BY ALL),
per AS (SELECT EmployeeID, max(CASE WHEN cluster = other THEN size END) AS size, max(CASE WHEN cluster = other AND size > 1 THEN total / (size - 1) END) AS a,
          min(CASE WHEN cluster <> other THEN total / size END) AS b FROM tot GROUP BY EmployeeID)
SELECT avg(CASE WHEN size = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM per""", round_cols=["silhouette"])
def q_silhouette_euclidean(spark: SparkSession, d: str) -> DataFrame:
    """K5 on the K4 labels with Euclidean distances, every pair in bounded tiles."""
    emp, std = _std(spark, d)
    return K.silhouette_euclidean(std, K.assign(std, _domain_centres(emp, std)))


_K, _STARTS, _ROUNDS = 4, 10, 30


def _starts_sql() -> str:
    """All starts of K3 side by side, a round a CTE; rounds after the last change change nothing."""
    sel = ", ".join(f"round(avg(p.{c}), 9) AS {c}" for c in _F)
    keep = ", ".join(f"coalesce(n.{c}, c.{c}) AS {c}" for c in _F)
    near = (f"SELECT s.*, c.start, arg_min(c.cluster, ({_D2}, c.cluster)) AS cluster, min({_D2}) AS d2 FROM std s, {{}} c GROUP BY ALL")
    ctes = ["c0 AS MATERIALIZED (SELECT start, row_number() OVER (PARTITION BY start ORDER BY md5(start || ':' || EmployeeID), EmployeeID) - 1 AS cluster, "
            + ", ".join(f"round({c}, 9) AS {c}" for c in _F) + f" FROM std, (SELECT unnest(range({_STARTS})) AS start) t QUALIFY cluster < {_K})"]
    for r in range(_ROUNDS):
        ctes.append(f"c{r + 1} AS MATERIALIZED (SELECT c.start, c.cluster, {keep} FROM c{r} c LEFT JOIN (SELECT p.start, p.cluster, {sel} FROM ({near.format(f'c{r}')}) p GROUP BY ALL) n "
                    "ON n.start = c.start AND n.cluster = c.cluster)")
    ctes.append(f"fin AS MATERIALIZED ({near.format(f'c{_ROUNDS}')})")
    return ", " + ", ".join(ctes) + " SELECT EmployeeID, cluster FROM fin WHERE start = (SELECT arg_min(start, (cost, start)) FROM (SELECT start, round(sum(d2), 9) AS cost FROM fin GROUP BY start) t)"


@register("kmeans_best_of_starts", with_views(["employees", "projects"], [("emp", ENRICHED_SQL), ("std0", _STD_SQL), ("std", "SELECT * FROM std0")]).rstrip() + _starts_sql())
def q_kmeans_starts(spark: SparkSession, d: str) -> DataFrame:
    """K3: k=4, the best of ten starts chosen by hash, all advanced in one scan a round."""
    return K.kmeans_starts(_std(spark, d)[1], _K, _STARTS, _ROUNDS)[0]


@register("kmeans_clusters", None)
def q_kmeans(spark: SparkSession, d: str) -> DataFrame:
    """K3: k=4, seed 42, best of 10 starts (rows-only; invariants in tests)."""
    emp = enriched_employees(Workforce(spark, d))
    labels, _, _ = K.kmeans(emp, K.FEATURES, k=4, seed=42, starts=10)
    return labels


@register("pca_2d", None, round_cols=["pca1", "pca2"])
def q_pca(spark: SparkSession, d: str) -> DataFrame:
    """K6: two principal components of the standardised features (rows-only)."""
    return K.pca_2d(_std(spark, d)[1])


@register("reenrich_after_append", with_views(["employees", "projects"]) + """
, hist AS (SELECT ProjectID, EmployeeID, Individual_Performance_Score FROM projects
           UNION ALL SELECT ProjectID, EmployeeID, Individual_Performance_Score FROM (""" + _RECORDS_SQL + """) r)
SELECT e.*, coalesce(a.Avg_Performance, 0.0) AS Avg_Performance
FROM employees e LEFT JOIN (SELECT EmployeeID, avg(Individual_Performance_Score) AS Avg_Performance
                            FROM hist GROUP BY EmployeeID) a ON e.EmployeeID = a.EmployeeID""",
          round_cols=["Avg_Performance"])
def q_reenrich(spark: SparkSession, d: str) -> DataFrame:
    """U4: after a completed project is appended, mean performance is merged again."""
    from ..functions import schema as S
    from ..operators import analytics as A
    from ..operators import merge as M

    wf = Workforce(spark, d)
    t = history_table(wf)
    v = t.append(U.completion_records(_fallback_completion(wf), wf.employees, wf.projects), base=0)
    emp = S.with_default(wf.employees, "Avg_Performance", 0.0, S.T.DoubleType())
    return M.update_only(emp, A.avg_performance(t.read(v)), ["EmployeeID"], ["Avg_Performance"])


@register("reenrich_incremental", with_views(["employees", "projects"]) + """
, hist AS (SELECT ProjectID, EmployeeID, Individual_Performance_Score FROM projects
           UNION ALL SELECT ProjectID, EmployeeID, Individual_Performance_Score FROM (""" + _RECORDS_SQL + """) r)
SELECT e.*, coalesce(a.Avg_Performance, 0.0) AS Avg_Performance
FROM employees e LEFT JOIN (SELECT EmployeeID, avg(Individual_Performance_Score) AS Avg_Performance
                            FROM hist GROUP BY EmployeeID) a ON e.EmployeeID = a.EmployeeID""",
          round_cols=["Avg_Performance"])
def q_reenrich_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same as ``reenrich_after_append``, from the stored sums of the history and the appended rows alone."""
    from ..functions import schema as S
    from ..operators import merge as M

    wf = Workforce(spark, d)
    t = history_table(wf)
    v = t.append(U.completion_records(_fallback_completion(wf), wf.employees, wf.projects), base=0)
    state = U.updated_state(stored_performance(wf), t.appended(v))
    emp = S.with_default(wf.employees, "Avg_Performance", 0.0, S.T.DoubleType())
    return M.update_only(emp, U.state_averages(state), ["EmployeeID"], ["Avg_Performance"], check_unique=False)


@register("profile_merged", with_views(["employees", "projects"]) + """
, hist AS (SELECT ProjectID, EmployeeID, Tech_Stack_Used, Individual_Performance_Score FROM projects
           UNION ALL SELECT ProjectID, EmployeeID, Tech_Stack_Used, Individual_Performance_Score FROM (""" + _RECORDS_SQL + """) r)
""" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, {low} AS low, {high} AS high, true AS distinct_near FROM hist" for c, low, high in (
    ("ProjectID", "min(ProjectID)::DOUBLE", "max(ProjectID)::DOUBLE"), ("EmployeeID", "min(EmployeeID)::DOUBLE", "max(EmployeeID)::DOUBLE"), ("Tech_Stack_Used", "NULL::DOUBLE", "NULL::DOUBLE"),
    ("Individual_Performance_Score", "min(Individual_Performance_Score)::DOUBLE", "max(Individual_Performance_Score)::DOUBLE"))))
def q_profile_merged(spark: SparkSession, d: str) -> DataFrame:
    """The history's profile after an append, merged from the sketches of its two versions; distinct_near: the
    sketched number of distinct values is within 6 % of the exact one."""
    from ..operators import analytics as A
    from ..operators import profile as P

    wf = Workforce(spark, d)
    cols = ["ProjectID", "EmployeeID", "Tech_Stack_Used", "Individual_Performance_Score"]
    t = history_table(wf)
    v = t.append(U.completion_records(_fallback_completion(wf), wf.employees, wf.projects), base=0)
    kept = [written(P.sketch_profile(rows.select(*cols)), "profile") for rows in (t.read(0), t.appended(v))]
    report = P.profile_report(P.merged_profiles(*kept)).withColumnRenamed("distinct_values", "sketched")
    exact = A.table_profile(t.read(v).select(*cols)).select("column_name", "distinct_values")
    near = F.abs(F.col("sketched") - F.col("distinct_values")) <= 0.06 * F.col("distinct_values")
    return report.join(exact, "column_name").select("column_name", "rows", "nulls", "low", "high", near.alias("distinct_near"))


_STATES: dict[tuple[str, str], DataFrame] = {}


def stored_performance(wf: Workforce) -> DataFrame:
    """The performance state of the projects history's version 0, written once a session."""
    key = (wf.spark.sparkContext.applicationId, wf.sf_dir)
    if key not in _STATES:
        _STATES[key] = written(U.performance_state(history_table(wf).read(0)), "performance-state")
    return _STATES[key]


def _changed_entries(wf: Workforce) -> DataFrame:
    """Index entries of the projects that the update batch touches, after the merge; other projects are not merged."""
    from ..operators import merge as M
    from ..operators import similarity as V

    keys = wf.project_updates.select("ProjectID").distinct()
    rows = wf.projects.join(keys, "ProjectID", "left_semi")
    return V.build_index(M.upsert(rows, wf.project_updates, ["ProjectID", "EmployeeID"]).select(*wf.projects.columns))


_REINDEXED_SQL = with_views(["projects", "project_updates"]) + """
, merged AS (SELECT coalesce(u.ProjectID, t.ProjectID) AS ProjectID,
                    CASE WHEN u.__hit THEN u.Domain ELSE t.Domain END AS Domain,
                    CASE WHEN u.__hit THEN u.Project_Description ELSE t.Project_Description END AS Project_Description
             FROM projects t FULL OUTER JOIN (SELECT *, true AS __hit FROM project_updates) u
               ON t.ProjectID = u.ProjectID AND t.EmployeeID = u.EmployeeID),
pindex AS (SELECT ProjectID, min(Domain) AS Domain, min(Project_Description) AS Project_Description FROM merged GROUP BY ProjectID),
cterms AS (SELECT t, token, count(*) AS tf FROM (SELECT t, unnest(regexp_extract_all(lower(t), '[a-z0-9+#]+')) AS token FROM (SELECT DISTINCT Project_Description AS t FROM pindex WHERE Project_Description IS NOT NULL) x) y GROUP BY t, token),
idf AS (SELECT token, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM cterms, (SELECT count(DISTINCT t) AS n FROM cterms) x GROUP BY token, n),
norms AS (SELECT c.t, count(*) AS n_terms, sqrt(sum(tf * idf * tf * idf)) AS norm FROM cterms c JOIN idf ON idf.token = c.token GROUP BY c.t)
SELECT i.ProjectID, i.Domain, i.Project_Description, n.n_terms, n.norm FROM pindex i LEFT JOIN norms n ON n.t = i.Project_Description"""


@register("reindex_incremental", _REINDEXED_SQL, round_cols=["norm"])
def q_reindex_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The index after merging project updates, by striking out and adding the changed projects only."""
    from ..operators import similarity as V

    wf = Workforce(spark, d)
    index = V.DescriptionIndex.build(V.build_index(wf.projects)).updated(_changed_entries(wf))
    return index.entries.withColumn("did", F.md5("Project_Description")).join(index.norms(), "did", "left").drop("did")


@register("reindex_after_merge", with_views(["projects", "project_updates"]) + """
, merged AS (SELECT coalesce(u.ProjectID, t.ProjectID) AS ProjectID,
                    CASE WHEN u.__hit THEN u.Domain ELSE t.Domain END AS Domain,
                    CASE WHEN u.__hit THEN u.Project_Description ELSE t.Project_Description END AS Project_Description
             FROM projects t FULL OUTER JOIN (SELECT *, true AS __hit FROM project_updates) u
               ON t.ProjectID = u.ProjectID AND t.EmployeeID = u.EmployeeID)
SELECT ProjectID, min(Domain) AS Domain, min(Project_Description) AS Project_Description FROM merged GROUP BY ProjectID""")
def q_reindex(spark: SparkSession, d: str) -> DataFrame:
    """Merge project updates, then rebuild the index from the merged history."""
    from ..operators import merge as M
    from ..operators import similarity as V

    wf = Workforce(spark, d)
    return V.build_index(M.upsert(wf.projects, wf.project_updates, ["ProjectID", "EmployeeID"]))
