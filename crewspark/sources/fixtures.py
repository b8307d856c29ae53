"""Fixture views built from the driver's Parquet tables.

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB, so
the Spark jobs and the DuckDB oracle read identical inputs.  The views only
shape rows into the workforce schema; none of them does a query's work.

Row sources: ``supplier`` → employees, ``lineitem``/``orders`` → project
history (one row per order and supplier), ``customer`` → project briefs,
``embeddings`` → project and brief vectors.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.analytics import run_sql

# --- fixed values of the workforce model (from the reference generator) ---
SKILLS = [
    "Python", "SQL", "Spark", "Scala", "Java", "Go", "React", "Vue",
    "Docker", "Kubernetes", "TensorFlow", "PyTorch", "NLP", "LLMs",
    "Delta Lake", "Airflow", "DBT", "AWS", "GCP", "Azure",
]
DOMAINS = ["Finance", "Healthcare", "Retail", "EdTech", "Media", "GovTech"]
ROLES = [
    "Data Scientist", "ML Engineer", "Data Engineer", "Backend Engineer",
    "Frontend Engineer", "DevOps Engineer", "Product Manager", "QA Engineer",
]
PROJECT_ROLES = ["Lead", "Developer", "Analyst", "Engineer", "QA"]
# --- end of fixed values ---

RAW_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

_SK = ",".join(SKILLS)
_DOM = ",".join(DOMAINS)
_ROLE = ",".join(ROLES)
_PROLE = ",".join(PROJECT_ROLES)


def _pick(csv: str, idx_sql: str) -> str:
    return f"split_part('{csv}', ',', CAST({idx_sql} AS INT))"


EMPLOYEES_SQL = f"""
SELECT s_suppkey AS EmployeeID,
       s_name AS Name,
       CAST(22 + (s_suppkey * 7) % 37 AS INT) AS Age,
       {_pick(_ROLE, '1 + s_suppkey % 8')} AS Role,
       {_pick(_DOM, '1 + s_nationkey % 6')} AS Domain_Expertise,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Busy' ELSE 'Available' END AS Availability,
       concat_ws(', ',
         {_pick(_SK, '1 + (s_suppkey * 3 + 0) % 20')},
         {_pick(_SK, '1 + (s_suppkey * 3 + 7) % 20')},
         {_pick(_SK, '1 + (s_suppkey * 3 + 14) % 20')},
         CASE WHEN s_suppkey % 2 = 0 THEN {_pick(_SK, '1 + (s_suppkey * 3 + 21) % 20')} END,
         CASE WHEN s_suppkey % 24 = 0 THEN 'COBOL' END) AS Skills,
       round(20 + (s_acctbal + 1000) * 120 / 11000, 2) AS Cost_per_Hour
FROM supplier
"""

PROJECTS_SQL = f"""
SELECT ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used, Domain,
       Project_Role, Project_Success_Score, Individual_Performance_Score
FROM (
  SELECT l_orderkey AS ProjectID,
         l_suppkey AS EmployeeID,
         concat('Project-', CAST(l_orderkey AS STRING)) AS Project_Name,
         concat(Domain, ' project using ', Tech_Stack_Used, ' to deliver analytics and applications.') AS Project_Description,
         Tech_Stack_Used,
         Domain,
         {_pick(_PROLE, '1 + (l_orderkey + l_suppkey) % 5')} AS Project_Role,
         round(CAST(succ AS DOUBLE) / 100, 2) AS Project_Success_Score,
         round(least(1.0, greatest(0.0, (CAST(succ AS DOUBLE) + floor(q / n) - 25) / 100)), 2) AS Individual_Performance_Score
  FROM (
    SELECT m.l_orderkey, m.l_suppkey, m.q, m.n,
           {_pick(_DOM, '1 + o_custkey % 6')} AS Domain,
           concat_ws(', ',
             {_pick(_SK, '1 + (m.l_orderkey * 3 + 0) % 20')},
             {_pick(_SK, '1 + (m.l_orderkey * 3 + 9) % 20')},
             {_pick(_SK, '1 + (m.l_orderkey * 3 + 18) % 20')}) AS Tech_Stack_Used,
           55 + m.l_orderkey % 44 AS succ
    FROM (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS q, count(*) AS n
          FROM lineitem GROUP BY l_orderkey, l_suppkey) m
    JOIN orders ON m.l_orderkey = o_orderkey) p
) x
"""

# The reply column stands in for the language model's JSON answer to the
# brief.  It carries the cases the reply cleanup must survive: code fences,
# comment lines, a null budget, a single skill given as a string, a skill
# outside the workforce vocabulary and an unparseable (cut) reply.
_BRIEF_TEXT = f"""concat('Build a ', lower({_pick(_DOM, '1 + c_nationkey % 6')}), ' ',
         split_part('website,dashboard,api,streaming platform', ',', CAST(1 + c_custkey % 4 AS INT)),
         ' with ', {_pick(_SK, '1 + (c_custkey * 3 + 0) % 20')},
         ' and ', {_pick(_SK, '1 + (c_custkey * 3 + 7) % 20')},
         CASE WHEN c_custkey % 5 = 0 THEN ''
              ELSE concat(' under $', CAST(150 + c_custkey % 350 AS STRING), '/hour') END)"""

_REPLY_SKILLS = f"""CASE WHEN c_custkey % 3 = 0
            THEN concat('"', {_pick(_SK, '1 + (c_custkey * 3 + 0) % 20')}, '"')
            ELSE concat('["', {_pick(_SK, '1 + (c_custkey * 3 + 0) % 20')}, '", "',
                        CASE WHEN c_custkey % 17 = 0 THEN 'Kafka'
                             ELSE lower({_pick(_SK, '1 + (c_custkey * 3 + 7) % 20')}) END, '"]') END"""

BRIEFS_SQL = f"""
SELECT BriefID, BriefText,
       CASE WHEN BriefID % 13 = 0 THEN substring(body, 1, 40)
            WHEN BriefID % 7 = 0 THEN concat('```json', chr(10), body, chr(10), '```')
            WHEN BriefID % 11 = 0 THEN concat('// extracted fields', chr(10), body)
            WHEN BriefID % 19 = 5 THEN concat('Here are the fields:', chr(10), '```json', chr(10),
              replace(body, ', "max_budget_per_hour"', concat(', // skills', chr(10), ' "max_budget_per_hour"')), chr(10), '```', chr(10), 'Anything else?')
            WHEN BriefID % 23 = 7 THEN '42'
            WHEN BriefID % 29 = 11 THEN '["Go"]'
            WHEN BriefID % 31 = 9 THEN replace(body, 'Build a', 'Build /* kept */ a // kept')
            WHEN BriefID % 37 = 4 THEN replace(body, '"required_skills": ', '"required_skills": ["COBOL"], "alternatives": ')
            ELSE body END AS Reply
FROM (
  SELECT c_custkey AS BriefID,
         {_BRIEF_TEXT} AS BriefText,
         concat('{{"required_skills": ', {_REPLY_SKILLS},
                ', "max_budget_per_hour": ',
                CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE CAST(150 + c_custkey % 350 AS STRING) END,
                ', "project_description": "', {_BRIEF_TEXT}, '"}}') AS body
  FROM customer
) b
"""

# Upsert source: busy people come back available at a higher rate, and every
# QA engineer brings a new hire (new key) with the same profile.
EMPLOYEE_UPDATES_SQL = """
SELECT EmployeeID, Name, Age, Role, Domain_Expertise, 'Available' AS Availability, Skills,
       Cost_per_Hour + 5 AS Cost_per_Hour
FROM employees WHERE Availability = 'Busy'
UNION ALL
SELECT EmployeeID + 1000000 AS EmployeeID, concat(Name, '-new') AS Name, Age, Role, Domain_Expertise,
       Availability, Skills, Cost_per_Hour
FROM employees WHERE Role = 'QA Engineer'
"""

# Composite-key upsert source: Retail scores are revised, and every project
# lead's row is filed again under a new project id.
PROJECT_UPDATES_SQL = """
SELECT ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used, Domain, Project_Role,
       Project_Success_Score, CAST(0.5 AS DOUBLE) AS Individual_Performance_Score
FROM projects WHERE Domain = 'Retail'
UNION ALL
SELECT ProjectID + 10000000 AS ProjectID, EmployeeID, Project_Name, Project_Description, Tech_Stack_Used,
       Domain, Project_Role, Project_Success_Score, Individual_Performance_Score
FROM projects WHERE Project_Role = 'Lead'
"""

# Two versions of the employee table: version 1 applies the rate changes of
# the update batch and drops product managers.
EMPLOYEE_VERSIONS_SQL = """
SELECT 0 AS version, EmployeeID, Name, Age, Role, Domain_Expertise, Availability, Skills, Cost_per_Hour
FROM employees
UNION ALL
SELECT 1 AS version, e.EmployeeID, e.Name, e.Age, e.Role, e.Domain_Expertise, e.Availability, e.Skills,
       coalesce(u.Cost_per_Hour, e.Cost_per_Hour) AS Cost_per_Hour
FROM employees e LEFT JOIN employee_updates u ON e.EmployeeID = u.EmployeeID
WHERE e.Role <> 'Product Manager'
"""

VIEW_SQL = {
    "employees": EMPLOYEES_SQL,
    "projects": PROJECTS_SQL,
    "briefs": BRIEFS_SQL,
    "employee_updates": EMPLOYEE_UPDATES_SQL,
    "project_updates": PROJECT_UPDATES_SQL,
    "employee_versions": EMPLOYEE_VERSIONS_SQL,
}

VIEW_DEPS = {
    "employees": [],
    "projects": [],
    "briefs": [],
    "employee_updates": ["employees"],
    "project_updates": ["projects"],
    "employee_versions": ["employees", "employee_updates"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in VIEW_DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(names: list[str], extra: list[tuple[str, str]] | None = None) -> str:
    """A ``WITH`` prefix defining the named fixture views (and their inputs)."""
    ctes = [f"{n} AS ({VIEW_SQL[n].strip()})" for n in _closure(names)]
    ctes += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n"


# Stored layout of the materialised views: the reference partitions its
# tables by these columns.
PARTITION_BY = {"employees": "Domain_Expertise", "projects": "Domain"}

# Rows of a raw table that one writing task of a view gets, and the key they are dealt by (None: in turn).
DEALT = {"lineitem": ("l_orderkey", 1 << 18), "customer": (None, 1 << 14), "supplier": (None, 1 << 16)}

_WRITTEN: dict[tuple[str, str, str], tuple[str, list[str]]] = {}


@dataclass
class Workforce:
    """Fixture tables for one scale folder.

    With ``materialize`` (default) each view is written once per application
    as a Parquet table in the shared checkpoint folder (partitioned as the
    reference stores it) and every query scans that table — column pruning,
    pushed filters and partition pruning apply as on stored tables.
    """

    spark: SparkSession
    sf_dir: str
    materialize: bool = True

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """A raw table, cut into more tasks the more rows it has (counted from the files' footers)."""
        rows = self.raw(name)
        if name not in DEALT:
            return rows
        key, most = DEALT[name]
        tasks = math.ceil(rows.count() / most)
        return rows if tasks <= 1 else rows.repartition(tasks, *([key] if key else []))

    def _build(self, name: str) -> DataFrame:
        raw_needed = {
            "employees": ["supplier"],
            "projects": ["lineitem", "orders"],
            "briefs": ["customer"],
            "employee_updates": ["supplier"],
            "project_updates": ["lineitem", "orders"],
            "employee_versions": ["supplier"],
        }[name]
        sql = with_views([d for d in _closure([name]) if d != name]) if VIEW_DEPS[name] else ""
        return run_sql(self.spark, sql + VIEW_SQL[name], **{t: self.dealt(t) for t in raw_needed})

    def view(self, name: str) -> DataFrame:
        if not self.materialize:
            return self._build(name)
        from ..session import ensure_checkpoint_dir

        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        hit = _WRITTEN.get(key)
        if hit is None:
            base = ensure_checkpoint_dir(self.spark).rstrip("/")
            tag = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
            path = f"{base}/crewspark/tables/{key[0]}/{tag}/{name}"
            df = self._build(name)
            w = df.write.mode("overwrite")
            if name in PARTITION_BY:
                w = w.partitionBy(PARTITION_BY[name])
            w.parquet(path)
            hit = _WRITTEN[key] = (path, df.schema)
        path, schema = hit
        # the view's types and column order (a partition column is read back last)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    @property
    def employees(self) -> DataFrame:
        return self.view("employees")

    @property
    def projects(self) -> DataFrame:
        return self.view("projects")

    @property
    def briefs(self) -> DataFrame:
        return self.view("briefs")

    @property
    def employee_updates(self) -> DataFrame:
        return self.view("employee_updates")

    @property
    def project_updates(self) -> DataFrame:
        return self.view("project_updates")

    @property
    def employee_versions(self) -> DataFrame:
        return self.view("employee_versions")

    @property
    def embeddings(self) -> DataFrame:
        return self.raw("embeddings")
