"""Registered queries: reports, merges, versions, files and text functions.

Each entry runs the library operator on the fixture views of one scale
folder; the oracle is the same question in DuckDB SQL over the same views.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schema as S
from ..functions import skills as X
from ..operators import analytics as A
from ..operators import merge as M
from ..session import scratch_path, written
from ..sources import tables as TB
from ..sources.fixtures import Workforce, with_views
from .registry import register

DOMAIN = "Finance"
SKILL = "Python"

ENRICHED_SQL = """
SELECT e.*, coalesce(a.Avg_Performance, 0.0) AS Avg_Performance
FROM employees e LEFT JOIN (SELECT EmployeeID, avg(Individual_Performance_Score) AS Avg_Performance
                            FROM projects GROUP BY EmployeeID) a ON e.EmployeeID = a.EmployeeID
"""


def W(views: list[str], extra: list[tuple[str, str]] | None = None) -> str:
    return with_views(views, extra)


def enriched_employees(wf: Workforce) -> DataFrame:
    """Employees plus mean performance (0.0 for people without history)."""
    emp = S.with_default(wf.employees, "Avg_Performance", 0.0, S.T.DoubleType())
    return M.update_only(emp, A.avg_performance(wf.projects), ["EmployeeID"], ["Avg_Performance"],
                         check_unique=False)


# ---------------------------------------------------------------- A / P / L
@register("avg_performance", W(["projects"]) +
          "SELECT EmployeeID, avg(Individual_Performance_Score) AS Avg_Performance FROM projects GROUP BY EmployeeID",
          round_cols=["Avg_Performance"])
def q_avg_performance(spark: SparkSession, d: str) -> DataFrame:
    return A.avg_performance(Workforce(spark, d).projects)


@register("enrich_avg_performance", W(["employees", "projects"]) + ENRICHED_SQL,
          round_cols=["Avg_Performance"], bench=True)
def q_enrich(spark: SparkSession, d: str) -> DataFrame:
    return enriched_employees(Workforce(spark, d))


@register("available_staff", W(["employees"]) + "SELECT * FROM employees WHERE Availability = 'Available'")
def q_available(spark: SparkSession, d: str) -> DataFrame:
    return A.available_staff(Workforce(spark, d).employees)


@register("domain_projects", W(["projects"]) + f"SELECT * FROM projects WHERE Domain = '{DOMAIN}'")
def q_domain_projects(spark: SparkSession, d: str) -> DataFrame:
    return A.domain_projects(Workforce(spark, d).projects, DOMAIN)


@register("comprehensive_view", W(["employees", "projects"]) + """
SELECT e.EmployeeID, e.Name, e.Role AS Current_Role, p.Project_Name, p.Project_Role, p.Domain,
       p.Individual_Performance_Score, p.Tech_Stack_Used
FROM employees e JOIN projects p ON e.EmployeeID = p.EmployeeID""")
def q_comprehensive(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return A.comprehensive_view(wf.employees, wf.projects)


@register("top_performers", W(["employees", "projects"]) + """
SELECT e.EmployeeID, e.Name, e.Role, count(p.ProjectID) AS Projects_Completed,
       round(avg(p.Individual_Performance_Score), 2) AS Avg_Performance
FROM employees e JOIN projects p ON e.EmployeeID = p.EmployeeID
GROUP BY e.EmployeeID, e.Name, e.Role
ORDER BY Avg_Performance DESC, e.EmployeeID LIMIT 10""", bench=True)
def q_top_performers(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return A.top_performers(wf.employees, wf.projects)


@register("domain_skill_experts", W(["employees", "projects"]) + f"""
SELECT e.EmployeeID, e.Name, e.Role, count(p.ProjectID) AS Domain_Skill_Projects
FROM employees e JOIN projects p ON e.EmployeeID = p.EmployeeID
WHERE p.Domain = '{DOMAIN}'
  AND list_contains(list_filter(list_transform(string_split(p.Tech_Stack_Used, ','), lambda t: trim(t)),
                                lambda t: t <> ''), '{SKILL}')
GROUP BY e.EmployeeID, e.Name, e.Role
ORDER BY Domain_Skill_Projects DESC, e.EmployeeID LIMIT 10""")
def q_domain_skill_experts(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return A.domain_skill_experts(wf.employees, wf.projects, DOMAIN, SKILL)


@register("cost_per_role", W(["employees"]) + """
SELECT Role, count(EmployeeID) AS Number_of_Employees,
       CAST(avg(Cost_per_Hour) AS DECIMAL(10, 2)) AS Average_Hourly_Cost
FROM employees GROUP BY Role""")
def q_cost_per_role(spark: SparkSession, d: str) -> DataFrame:
    return A.cost_per_role(Workforce(spark, d).employees)


@register("top_roles", W(["employees"]) + "SELECT Role, count(*) AS cnt FROM employees GROUP BY Role", bench=True)
def q_top_roles(spark: SparkSession, d: str) -> DataFrame:
    return A.top_roles(Workforce(spark, d).employees)


@register("avg_perf_by_role", W(["employees", "projects"], [("emp", ENRICHED_SQL)]) +
          "SELECT Role, avg(Avg_Performance) AS avg_perf FROM emp GROUP BY Role", round_cols=["avg_perf"])
def q_avg_perf_by_role(spark: SparkSession, d: str) -> DataFrame:
    return A.avg_perf_by_role(enriched_employees(Workforce(spark, d)))


@register("domain_staff_counts", W(["employees"]) +
          "SELECT Domain_Expertise AS Domain, count(*) AS cnt FROM employees GROUP BY Domain_Expertise")
def q_domain_staff(spark: SparkSession, d: str) -> DataFrame:
    return A.domain_staff_counts(Workforce(spark, d).employees)


@register("project_count_per_employee", W(["projects"]) + """
SELECT EmployeeID, count(DISTINCT ProjectID) AS projects FROM projects GROUP BY EmployeeID
ORDER BY projects DESC, EmployeeID LIMIT 20""")
def q_project_count(spark: SparkSession, d: str) -> DataFrame:
    return A.project_count_per_employee(Workforce(spark, d).projects)


@register("next_project_id", W(["projects"]) +
          "SELECT coalesce(max(ProjectID), 5000) + 1 AS next_project_id FROM projects")
def q_next_project_id(spark: SparkSession, d: str) -> DataFrame:
    return A.next_project_id(Workforce(spark, d).projects)


@register("cost_histogram", W(["employees"]) + """
, s AS (SELECT min(Cost_per_Hour) AS lo, max(Cost_per_Hour) AS hi, (max(Cost_per_Hour) - min(Cost_per_Hour)) / 25.0 AS w
        FROM employees),
c AS (SELECT CASE WHEN s.w = 0 THEN 0 ELSE least(24, CAST(floor((e.Cost_per_Hour - s.lo) / s.w) AS INT)) END AS bin,
             count(*) AS cnt
      FROM employees e, s WHERE e.Cost_per_Hour IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INT) AS bin FROM range(25))
SELECT g.bin, round(s.lo + g.bin * s.w, 6) AS bin_lo, round(s.lo + (g.bin + 1) * s.w, 6) AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS cnt
FROM g CROSS JOIN s LEFT JOIN c ON g.bin = c.bin""", bench=True)
def q_cost_histogram(spark: SparkSession, d: str) -> DataFrame:
    return A.cost_histogram(Workforce(spark, d).employees)


@register("top_domain_performers", W(["employees", "projects"]) + f"""
SELECT e.EmployeeID, e.Name, e.Role, p.ProjectID, p.Project_Name, p.Individual_Performance_Score
FROM employees e JOIN projects p ON e.EmployeeID = p.EmployeeID
WHERE p.Domain = '{DOMAIN}'
ORDER BY p.Individual_Performance_Score DESC, e.EmployeeID, p.ProjectID LIMIT 5""")
def q_top_domain_performers(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return A.top_domain_performers(wf.employees, wf.projects, DOMAIN)


@register("fallback_team", W(["employees"]) + """
, av AS (SELECT count(*) > 0 AS has FROM employees WHERE Availability = 'Available')
SELECT EmployeeID, Name, Role, Cost_per_Hour FROM employees, av
WHERE (Availability = 'Available') OR NOT av.has
ORDER BY CASE WHEN av.has THEN Cost_per_Hour ELSE 0.0 END, EmployeeID LIMIT 3""")
def q_fallback_team(spark: SparkSession, d: str) -> DataFrame:
    return A.fallback_team(Workforce(spark, d).employees)


@register("distinct_projects", W(["projects"]) +
          "SELECT DISTINCT ProjectID, Project_Description, Domain FROM projects")
def q_distinct_projects(spark: SparkSession, d: str) -> DataFrame:
    return A.distinct_projects(Workforce(spark, d).projects)


@register("coerce_numeric", W(["employees", "projects"], [("emp", ENRICHED_SQL)]) + """
SELECT EmployeeID,
       coalesce(TRY_CAST(CAST(Age AS VARCHAR) AS DOUBLE), 0.0) AS Age,
       coalesce(TRY_CAST(CAST(Cost_per_Hour AS VARCHAR) AS DOUBLE), 0.0) AS Cost_per_Hour,
       coalesce(TRY_CAST(Skills AS DOUBLE), 0.0) AS Skills_as_number,
       greatest(0.0, least(1.0, coalesce(TRY_CAST(CAST(Avg_Performance AS VARCHAR) AS DOUBLE), 0.0))) AS Avg_Performance
FROM emp""", round_cols=["Avg_Performance"])
def q_coerce(spark: SparkSession, d: str) -> DataFrame:
    return A.coerced_employees(enriched_employees(Workforce(spark, d)))


_EMP_COLS = ["EmployeeID", "Name", "Age", "Role", "Domain_Expertise", "Availability", "Skills", "Cost_per_Hour"]


@register("table_profile", W(["employees"]) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values, "
    f"count(*) AS rows FROM employees" for c in _EMP_COLS))
def q_profile(spark: SparkSession, d: str) -> DataFrame:
    return A.table_profile(Workforce(spark, d).employees)


@register("adhoc_sql", W(["employees", "projects"], [("emp", ENRICHED_SQL)]) +
          A.SQL_TEMPLATES["Top roles"].replace("FROM employees", "FROM emp").replace(" ORDER BY cnt DESC", ""))
def q_adhoc(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return A.run_sql(spark, A.SQL_TEMPLATES["Top roles"], employees=enriched_employees(wf), projects=wf.projects)


# ---------------------------------------------------------------- merges / versions
def _case_cols(cols: list[str], t: str, s: str) -> str:
    return ",\n".join(f"CASE WHEN {s}.__hit THEN {s}.{c} ELSE {t}.{c} END AS {c}" for c in cols)


@register("upsert_employees", W(["employees", "projects", "employee_updates"], [("emp", ENRICHED_SQL)]) + f"""
SELECT coalesce(u.EmployeeID, t.EmployeeID) AS EmployeeID,
{_case_cols(_EMP_COLS[1:], 't', 'u')},
t.Avg_Performance AS Avg_Performance
FROM emp t FULL OUTER JOIN (SELECT *, true AS __hit FROM employee_updates) u ON t.EmployeeID = u.EmployeeID""",
          round_cols=["Avg_Performance"], bench=True)
def q_upsert_employees(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return M.upsert(enriched_employees(wf), wf.employee_updates, ["EmployeeID"])


_PROJ_COLS = ["Project_Name", "Project_Description", "Tech_Stack_Used", "Domain", "Project_Role",
              "Project_Success_Score", "Individual_Performance_Score"]


@register("upsert_projects", W(["projects", "project_updates"]) + f"""
SELECT coalesce(u.ProjectID, t.ProjectID) AS ProjectID, coalesce(u.EmployeeID, t.EmployeeID) AS EmployeeID,
{_case_cols(_PROJ_COLS, 't', 'u')}
FROM projects t FULL OUTER JOIN (SELECT *, true AS __hit FROM project_updates) u
  ON t.ProjectID = u.ProjectID AND t.EmployeeID = u.EmployeeID""", bench=True)
def q_upsert_projects(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return M.upsert(wf.projects, wf.project_updates, ["ProjectID", "EmployeeID"])


def _diff_sql(before: str, after: str) -> str:
    cols = _EMP_COLS[1:]
    differs = " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in cols)
    names = ", ".join(f"CASE WHEN b.{c} IS DISTINCT FROM a.{c} THEN '{c}' END" for c in cols)
    return f"""
SELECT coalesce(b.EmployeeID, a.EmployeeID) AS EmployeeID,
       CASE WHEN b.EmployeeID IS NULL THEN 'insert' WHEN a.EmployeeID IS NULL THEN 'delete' ELSE 'update' END AS change_type,
       CASE WHEN b.EmployeeID IS NOT NULL AND a.EmployeeID IS NOT NULL THEN concat_ws(',', {names}) ELSE '' END
         AS changed_columns
FROM ({before}) b FULL OUTER JOIN ({after}) a ON b.EmployeeID = a.EmployeeID
WHERE b.EmployeeID IS NULL OR a.EmployeeID IS NULL OR {differs}"""


_V0 = f"SELECT {', '.join(_EMP_COLS)} FROM employee_versions WHERE version = 0"
_V1 = f"SELECT {', '.join(_EMP_COLS)} FROM employee_versions WHERE version = 1"


@register("version_diff", W(["employee_versions"]) + _diff_sql(_V0, _V1), bench=True)
def q_version_diff(spark: SparkSession, d: str) -> DataFrame:
    ev = Workforce(spark, d).employee_versions
    return M.version_diff(ev.where("version = 0").drop("version"), ev.where("version = 1").drop("version"),
                          ["EmployeeID"])


@register("version_diff_reverse", W(["employee_versions"]) + _diff_sql(_V1, _V0))
def q_version_diff_rev(spark: SparkSession, d: str) -> DataFrame:
    ev = Workforce(spark, d).employee_versions
    return M.version_diff(ev.where("version = 1").drop("version"), ev.where("version = 0").drop("version"),
                          ["EmployeeID"])


@register("version_diff_buckets", W(["employee_versions"]) + _diff_sql(_V0, _V1))
def q_version_diff_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The same as ``version_diff`` between two stored snapshots, joining only buckets whose digests differ."""
    ev = Workforce(spark, d).employee_versions
    before, after = (TB.BucketedSnapshot(spark, scratch_path(spark, f"employees-v{v}"), ["EmployeeID"]).write(ev.where(F.col("version") == v).drop("version")) for v in (0, 1))
    return before.diff(after)


def _employee_table(spark: SparkSession, d: str) -> TB.VersionedTable:
    """Commit the employee lifecycle of the reference: load, add column, merge averages."""
    wf = Workforce(spark, d)
    t = TB.VersionedTable(spark, scratch_path(spark, "employees"), partition_col="Domain_Expertise")
    t.overwrite(wf.employees, "WRITE")
    t.overwrite(S.with_default(t.read(), "Avg_Performance", 0.0, S.T.DoubleType()), "ADD COLUMN")
    merged = M.update_only(t.read(), A.avg_performance(wf.projects), ["EmployeeID"], ["Avg_Performance"])
    t.overwrite(merged, "MERGE")
    return t


@register("employees_scan", W(["employees", "projects"]) + ENRICHED_SQL, round_cols=["Avg_Performance"])
def q_employees_scan(spark: SparkSession, d: str) -> DataFrame:
    return _employee_table(spark, d).read()


@register("snapshot_as_of", W(["employees"]) + "SELECT *, CAST(0.0 AS DOUBLE) AS Avg_Performance FROM employees")
def q_snapshot_as_of(spark: SparkSession, d: str) -> DataFrame:
    return _employee_table(spark, d).read(version=1)


@register("version_history", W(["employees"]) + """
SELECT CAST(v AS BIGINT) AS version, op AS operation, CAST(n AS VARCHAR) AS numOutputRows
FROM (SELECT 0 AS v, 'WRITE' AS op, (SELECT count(*) FROM employees) AS n
      UNION ALL SELECT 1, 'ADD COLUMN', (SELECT count(*) FROM employees)
      UNION ALL SELECT 2, 'MERGE', (SELECT count(*) FROM employees)) h""")
def q_version_history(spark: SparkSession, d: str) -> DataFrame:
    h = TB.recent_history(_employee_table(spark, d), 10)
    return h.select("version", "operation", F.col("operationMetrics")["numOutputRows"].alias("numOutputRows"))


@register("add_column_default", W(["employees"]) + "SELECT *, CAST(0.0 AS DOUBLE) AS Avg_Performance FROM employees")
def q_add_column(spark: SparkSession, d: str) -> DataFrame:
    return S.with_default(Workforce(spark, d).employees, "Avg_Performance", 0.0, S.T.DoubleType())


@register("csv_roundtrip", W(["employees"]) + "SELECT * FROM employees")
def q_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "employees-csv")
    TB.write_csv(Workforce(spark, d).employees, path)
    return TB.read_csv(spark, path, S.EMPLOYEES)


@register("csv_corrupt_rows", W(["employees"]) + """
SELECT Availability, corrupt, count(*) AS people FROM (SELECT Availability, Role = 'QA Engineer' AS corrupt FROM employees) x GROUP BY ALL""")
def q_csv_corrupt(spark: SparkSession, d: str) -> DataFrame:
    """A landing file in which QA engineers' ages are words: those lines are kept as they came, not read as nulls."""
    path = scratch_path(spark, "employees-dirty-csv")
    people = Workforce(spark, d).employees
    TB.write_csv(people.withColumn("Age", F.when(F.col("Role") == "QA Engineer", F.concat(F.lit("about "), F.col("Age").cast("string"))).otherwise(F.col("Age").cast("string"))), path)
    rows, corrupt = TB.read_csv_checked(spark, path, S.EMPLOYEES)
    states = corrupt.select(F.regexp_extract(TB.CORRUPT, ",(Available|Busy),", 1).alias("Availability"), F.lit(True).alias("corrupt"))
    return rows.select("Availability", F.lit(False).alias("corrupt")).unionByName(states).groupBy("Availability", "corrupt").agg(F.count(F.lit(1)).alias("people"))


@register("partitioned_load", W(["projects"]) + f"SELECT * FROM projects WHERE Domain = '{DOMAIN}'")
def q_partitioned_load(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "projects-by-domain")
    TB.write_partitioned(Workforce(spark, d).projects, path, "Domain")
    back = spark.read.parquet(path).where(F.col("Domain") == DOMAIN)
    return back.select(*[f.name for f in S.PROJECTS.fields])


@register("compact_sort", W(["projects"]) + "SELECT * FROM projects")
def q_compact_sort(spark: SparkSession, d: str) -> DataFrame:
    t = TB.VersionedTable(spark, scratch_path(spark, "projects"), partition_col="Domain")
    rows = Workforce(spark, d).projects
    t.overwrite(rows.repartition(max(16, math.ceil(rows.count() / TB.SLOT_ROWS))), "WRITE")
    t.compact(["Project_Success_Score", "Individual_Performance_Score"], files_per_partition=4)
    return t.read().select(*[f.name for f in S.PROJECTS.fields])


@register("lifecycle_append_schema", W(["projects", "project_updates"]) + """
SELECT * FROM projects UNION ALL SELECT ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used, Domain,
  Project_Role, Project_Success_Score, Individual_Performance_Score FROM project_updates""")
def q_append_schema(spark: SparkSession, d: str) -> DataFrame:
    """Appended rows, all strings in another column order, are cast by name to the table schema."""
    wf = Workforce(spark, d)
    t = TB.VersionedTable(spark, scratch_path(spark, "projects-append"))
    t.overwrite(wf.projects, "WRITE")
    extra = wf.project_updates.select(
        *[F.col(c).cast("string").alias(c) for c in reversed(wf.project_updates.columns)])
    t.append(extra)
    return t.read()


# ---------------------------------------------------------------- text functions
_TOKENS_SQL = "list_filter(list_transform(string_split({c}, ','), lambda t: trim(t)), lambda t: t <> '')"

CANONICAL_SQL = ("SELECT DISTINCT t AS Skill FROM (SELECT unnest(" + _TOKENS_SQL.format(c="Skills") +
                 ") AS t FROM employees) x")


@register("canonical_skills", W(["employees"]) + CANONICAL_SQL)
def q_canonical(spark: SparkSession, d: str) -> DataFrame:
    return X.canonical_skills(Workforce(spark, d).employees)


@register("skill_tokens", W(["employees"]) +
          "SELECT EmployeeID, array_to_string(" + _TOKENS_SQL.format(c="Skills") + ", '|') AS tokens FROM employees")
def q_skill_tokens(spark: SparkSession, d: str) -> DataFrame:
    e = Workforce(spark, d).employees
    return e.select("EmployeeID", F.array_join(X.skill_tokens("Skills"), "|").alias("tokens"))


def dedup_sql(lst: str) -> str:
    """Order-preserving de-duplication of a DuckDB list expression."""
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def phrase_sql(text: str) -> str:
    parts = []
    for p, sk in X.GENERIC_SKILL_MAP:
        arr = "[" + ", ".join(f"'{s}'" for s in sk) + "]"
        parts.append(f"CASE WHEN contains(lower(coalesce({text}, '')), '{p}') THEN {arr} ELSE []::VARCHAR[] END")
    return dedup_sql("flatten([" + ", ".join(parts) + "])")


def domain_sql(text: str) -> str:
    whens = []
    for dom, kws in X.DOMAIN_KEYWORDS:
        cond = " OR ".join(f"contains(lower(coalesce({text}, '')), '{k}')" for k in kws)
        whens.append(f"WHEN {cond} THEN '{dom}'")
    return "CASE " + " ".join(whens) + " END"


BUDGET_SQL = (r"CASE WHEN regexp_extract(lower(coalesce({t}, '')), '(\$|usd\s*)?(\d{{2,6}})(?:\s*/?\s*hour)?', 2) <> '' "
              r"THEN CAST(regexp_extract(lower(coalesce({t}, '')), '(\$|usd\s*)?(\d{{2,6}})(?:\s*/?\s*hour)?', 2) AS DOUBLE) END")


@register("phrase_skills", W(["briefs"]) +
          f"SELECT BriefID, array_to_string({phrase_sql('BriefText')}, '|') AS skills FROM briefs")
def q_phrase_skills(spark: SparkSession, d: str) -> DataFrame:
    b = Workforce(spark, d).briefs
    return b.select("BriefID", F.array_join(X.phrase_skills("BriefText"), "|").alias("skills"))


@register("infer_domain", W(["briefs"]) + f"SELECT BriefID, {domain_sql('BriefText')} AS Domain FROM briefs")
def q_infer_domain(spark: SparkSession, d: str) -> DataFrame:
    b = Workforce(spark, d).briefs
    return b.select("BriefID", X.infer_domain("BriefText").alias("Domain"))


@register("brief_budget", W(["briefs"]) + f"SELECT BriefID, {BUDGET_SQL.format(t='BriefText')} AS budget FROM briefs")
def q_brief_budget(spark: SparkSession, d: str) -> DataFrame:
    b = Workforce(spark, d).briefs
    return b.select("BriefID", X.budget_from_text("BriefText").alias("budget"))


PARSED_SQL = r"""
SELECT BriefID, BriefText, ok,
  CASE WHEN NOT ok THEN []::VARCHAR[]
       WHEN rs IS NULL OR json_extract_string(s, '$.required_skills') = '' THEN []::VARCHAR[]
       WHEN json_type(rs) = 'ARRAY' THEN from_json(rs, '["VARCHAR"]')
       ELSE [json_extract_string(s, '$.required_skills')] END AS required_skills,
  CASE WHEN ok THEN coalesce(TRY_CAST(json_extract_string(s, '$.max_budget_per_hour') AS DOUBLE), 0.0)
       ELSE coalesce(""" + BUDGET_SQL.format(t="BriefText") + r""", 0.0) END AS max_budget_per_hour,
  CASE WHEN ok AND coalesce(json_extract_string(s, '$.project_description'), '') <> ''
       THEN json_extract_string(s, '$.project_description') ELSE BriefText END AS project_description
FROM (
  SELECT *, s <> '' AND json_valid(s) AS ok, CASE WHEN s <> '' AND json_valid(s) THEN json_extract(s, '$.required_skills') END AS rs
  FROM (SELECT BriefID, BriefText,
               trim(regexp_replace(regexp_extract(coalesce(Reply, ''), '(?s)\{.*\}'), '""" + X.REPLY_NOISE + r"""', '\1', 'g')) AS s
        FROM briefs) c) j
"""


@register("parse_brief_json", W(["briefs"], [("parsed", PARSED_SQL)]) + """
SELECT BriefID, array_to_string(required_skills, '|') AS required_skills, max_budget_per_hour,
       project_description, ok AS reply_parsed FROM parsed""")
def q_parse(spark: SparkSession, d: str) -> DataFrame:
    p = X.parse_reply(Workforce(spark, d).briefs)
    return p.select("BriefID", F.array_join("required_skills", "|").alias("required_skills"),
                    "max_budget_per_hour", "project_description", "reply_parsed")


CANON_KEYS_SQL = "SELECT lower(Skill) AS key, max(Skill) AS value, min(Skill) AS ord FROM canonical GROUP BY lower(Skill)"

SPLIT_SQL = """
SELECT p.BriefID,
       coalesce(string_agg(CASE WHEN k.key IS NOT NULL THEN x.item END, '|' ORDER BY x.pos), '') AS explicit_skills,
       coalesce(string_agg(CASE WHEN k.key IS NULL AND trim(x.item) <> '' THEN x.item END, '|' ORDER BY x.pos), '')
         AS missing_skills
FROM parsed p
LEFT JOIN (SELECT BriefID, unnest(required_skills) AS item, generate_subscripts(required_skills, 1) AS pos
           FROM parsed) x ON p.BriefID = x.BriefID
LEFT JOIN canon_keys k ON lower(trim(x.item)) = k.key
GROUP BY p.BriefID
"""


@register("split_known_skills", W(["briefs", "employees"], [("parsed", PARSED_SQL), ("canonical", CANONICAL_SQL),
                                                            ("canon_keys", CANON_KEYS_SQL)]) + SPLIT_SQL)
def q_split_known(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    out = X.split_known_skills(X.parse_reply(wf.briefs), X.canonical_skills(wf.employees))
    return out.select("BriefID", F.array_join("explicit_skills", "|").alias("explicit_skills"),
                      F.array_join("missing_skills", "|").alias("missing_skills"))


def normalize_sql(items_cte: str) -> str:
    """DuckDB twin of X2 over a CTE ``items_cte(BriefID, items)``."""
    return f"""
, tok AS (SELECT BriefID, unnest(items) AS item, generate_subscripts(items, 1) AS pos FROM {items_cte}),
m AS (SELECT t.BriefID, t.pos, k.value,
             row_number() OVER (PARTITION BY t.BriefID, t.pos ORDER BY (k.key = lower(trim(t.item))) DESC, k.ord) AS rn
      FROM tok t JOIN canon_keys k
        ON lower(trim(t.item)) <> '' AND (k.key = lower(trim(t.item)) OR contains(lower(trim(t.item)), k.key)
                                         OR contains(k.key, lower(trim(t.item))))),
f AS (SELECT BriefID, value, min(pos) AS pos FROM m WHERE rn = 1 GROUP BY BriefID, value)
SELECT i.BriefID, coalesce(string_agg(f.value, '|' ORDER BY f.pos), '') AS skills
FROM {items_cte} i LEFT JOIN f ON i.BriefID = f.BriefID GROUP BY i.BriefID"""


@register("normalize_skills", W(["briefs", "employees"], [
    ("parsed", PARSED_SQL), ("canonical", CANONICAL_SQL), ("canon_keys", CANON_KEYS_SQL),
    ("items", f"SELECT BriefID, list_concat(required_skills, {phrase_sql('project_description')}) AS items FROM parsed"),
]).rstrip() + normalize_sql("items"))
def q_normalize(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    p = X.parse_reply(wf.briefs)
    # read by every step of the matching
    items = written(p.select("BriefID", F.concat("required_skills", X.phrase_skills("project_description")).alias("items")), "brief-items")
    out = X.normalize_skills(items, X.canonical_skills(wf.employees))
    return out.select("BriefID", F.array_join("skills", "|").alias("skills"))


def skill_holders(employees: DataFrame, skills: DataFrame, skill_col: str = "skill") -> DataFrame:
    """X9 at scale: holders per requested skill string among available employees, by distinct
    skills texts and distinct requests."""
    sk = skills.select(F.col(skill_col).alias("skill")).distinct()
    texts = A.available_staff(employees).groupBy(F.lower("Skills").alias("text")).agg(F.count(F.lit(1)).alias("people"))
    wanted = sk.select("skill", F.lower(F.trim("skill")).alias("low"))
    pairs = X.contained(texts.select("text"), "text", wanted.select("low").distinct(), "low")
    hits = pairs.join(texts, "text").groupBy("low").agg(F.sum("people").alias("holders"))
    return wanted.join(hits, "low", "left").select("skill", F.coalesce("holders", F.lit(0)).cast("long").alias("holders"))


@register("skill_coverage", W(["employees"], [("canonical", CANONICAL_SQL)]) + """
SELECT c.Skill AS skill, count(e.EmployeeID) AS holders
FROM canonical c LEFT JOIN (SELECT * FROM employees WHERE Availability = 'Available') e
  ON contains(lower(e.Skills), lower(trim(c.Skill)))
GROUP BY c.Skill""")
def q_skill_coverage(spark: SparkSession, d: str) -> DataFrame:
    e = Workforce(spark, d).employees
    return skill_holders(e, X.canonical_skills(e).withColumnRenamed("Skill", "skill"))


def unmet_required(wf: Workforce) -> DataFrame:
    """Per brief, explicit required skills (lower, trimmed) that no available person holds."""
    split = X.split_known_skills(X.parse_reply(wf.briefs), X.canonical_skills(wf.employees))
    req = split.select("BriefID", F.explode(X.clean_skill_list("explicit_skills")).alias("skill"))
    holders = skill_holders(wf.employees, req)
    return req.join(holders, "skill").where("holders = 0").select("BriefID", "skill").distinct()


@register("unmet_required_skills", W(["briefs", "employees"], [
    ("parsed", PARSED_SQL), ("canonical", CANONICAL_SQL), ("canon_keys", CANON_KEYS_SQL),
    ("req", "SELECT DISTINCT p.BriefID, lower(trim(x.item)) AS skill FROM parsed p, "
            "(SELECT BriefID, unnest(required_skills) AS item FROM parsed) x, canon_keys k "
            "WHERE p.BriefID = x.BriefID AND lower(trim(x.item)) = k.key"),
]) + """
SELECT r.BriefID, r.skill FROM req r
WHERE NOT EXISTS (SELECT 1 FROM employees e WHERE e.Availability = 'Available'
                  AND contains(lower(e.Skills), r.skill))""")
def q_unmet(spark: SparkSession, d: str) -> DataFrame:
    return unmet_required(Workforce(spark, d))


@register("project_rows_per_domain", W(["projects"]) +
          "SELECT Domain, count(*) AS cnt FROM projects GROUP BY Domain", bench=True)
def q_project_rows_per_domain(spark: SparkSession, d: str) -> DataFrame:
    """History rows per project domain (second group-by of the reference's micro-benchmark)."""
    return Workforce(spark, d).projects.groupBy("Domain").agg(F.count(F.lit(1)).alias("cnt"))


@register("upsert_from_csv", W(["employees", "projects", "employee_updates"], [("emp", ENRICHED_SQL)]) + f"""
SELECT coalesce(u.EmployeeID, t.EmployeeID) AS EmployeeID,
{_case_cols(_EMP_COLS[1:], 't', 'u')},
t.Avg_Performance AS Avg_Performance
FROM emp t FULL OUTER JOIN (SELECT *, true AS __hit FROM employee_updates) u ON t.EmployeeID = u.EmployeeID""",
          round_cols=["Avg_Performance"])
def q_upsert_from_csv(spark: SparkSession, d: str) -> DataFrame:
    """An uploaded CSV (read with the table schema, no inference) merged into the table."""
    wf = Workforce(spark, d)
    path = scratch_path(spark, "employee-upload")
    TB.write_csv(wf.employee_updates, path)
    upload = TB.read_csv(spark, path, S.EMPLOYEES)
    return M.upsert(enriched_employees(wf), upload, ["EmployeeID"])


@register("list_versions", W(["employees"]) +
          "SELECT CAST(v AS BIGINT) AS version FROM (VALUES (0), (1), (2)) t(v)")
def q_list_versions(spark: SparkSession, d: str) -> DataFrame:
    """The versions recorded in a table's history."""
    return _employee_table(spark, d).history().select("version").distinct()


@register("adhoc_sql_avg_perf", W(["employees", "projects"], [("emp", ENRICHED_SQL)]) +
          "SELECT Role, avg(Avg_Performance) AS avg_perf FROM emp GROUP BY Role", round_cols=["avg_perf"])
def q_adhoc_avg_perf(spark: SparkSession, d: str) -> DataFrame:
    """Q1/Q2: the 'Avg perf by role' template, run verbatim through spark.sql."""
    wf = Workforce(spark, d)
    return A.run_sql(spark, A.SQL_TEMPLATES["Avg perf by role"], employees=enriched_employees(wf),
                     projects=wf.projects)


@register("adhoc_sql_domain_staff", W(["employees"]) +
          "SELECT Domain_Expertise AS Domain, count(*) AS cnt FROM employees GROUP BY Domain_Expertise")
def q_adhoc_domain_staff(spark: SparkSession, d: str) -> DataFrame:
    """Q1/Q2: the 'Domain staff counts' template (group by an alias), run verbatim through spark.sql."""
    wf = Workforce(spark, d)
    return A.run_sql(spark, A.SQL_TEMPLATES["Domain staff counts"], employees=enriched_employees(wf),
                     projects=wf.projects)
