"""Workforce reports: aggregations, filters, top-k and the ad-hoc SQL surface.

A1–A11, L1–L2, P1–P4, P8, P10, S12, Q1–Q3.  All built-in DataFrame
operators: partial/final hash aggregates, TakeOrderedAndProject for
``orderBy().limit()``, scalar subqueries for one-row statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.schema import clip01, coerce_numeric
from ..functions.skills import skill_tokens

# --- fixed values: the reference's four SQL templates (analytics page) ---
SQL_TEMPLATES = {
    "Top roles": "SELECT Role, count(*) AS cnt FROM employees GROUP BY Role ORDER BY cnt DESC",
    "Avg perf by role": "SELECT Role, avg(Avg_Performance) AS avg_perf FROM employees GROUP BY Role ORDER BY avg_perf DESC",
    "Domain staff counts": "SELECT Domain_Expertise AS Domain, count(*) AS cnt FROM employees GROUP BY Domain ORDER BY cnt DESC",
    "Project count per employee": "SELECT EmployeeID, count(DISTINCT ProjectID) AS projects FROM projects GROUP BY EmployeeID ORDER BY projects DESC LIMIT 20",
}
# --- end of fixed values ---


def avg_performance(projects: DataFrame) -> DataFrame:
    """A1: mean individual performance per employee."""
    return (projects.groupBy("EmployeeID")
            .agg(F.avg("Individual_Performance_Score").cast("double").alias("Avg_Performance")))


def available_staff(employees: DataFrame) -> DataFrame:
    """P1."""
    return employees.where(F.col("Availability") == "Available")


def domain_projects(projects: DataFrame, domain: str) -> DataFrame:
    """Pruned to one partition when the table is partitioned by Domain."""
    return projects.where(F.col("Domain") == domain)


def comprehensive_view(employees: DataFrame, projects: DataFrame) -> DataFrame:
    """Employees joined to every project row they worked on."""
    e = employees.select("EmployeeID", "Name", F.col("Role").alias("Current_Role"))
    p = projects.select("EmployeeID", "Project_Name", "Project_Role", "Domain",
                        "Individual_Performance_Score", "Tech_Stack_Used")
    return e.join(p, "EmployeeID")


def top_performers(employees: DataFrame, projects: DataFrame, n: int = 10) -> DataFrame:
    """A2: project count and mean score (2 decimals) per person, best ``n``.

    Grouped by EmployeeID as well as Name/Role so namesakes stay apart; ties
    broken by id.
    """
    e = employees.select("EmployeeID", "Name", "Role")
    p = projects.select("EmployeeID", "ProjectID", "Individual_Performance_Score")
    return (e.join(p, "EmployeeID")
            .groupBy("EmployeeID", "Name", "Role")
            .agg(F.count("ProjectID").alias("Projects_Completed"),
                 F.round(F.avg("Individual_Performance_Score"), 2).alias("Avg_Performance"))
            .orderBy(F.col("Avg_Performance").desc(), F.col("EmployeeID"))
            .limit(n))


def domain_skill_experts(employees: DataFrame, projects: DataFrame, domain: str, skill: str,
                         n: int = 10) -> DataFrame:
    """People with the most projects in ``domain`` whose stack lists ``skill``."""
    p = (projects.where(F.col("Domain") == domain)
         .where(F.array_contains(skill_tokens("Tech_Stack_Used"), skill))
         .select("EmployeeID", "ProjectID"))
    e = employees.select("EmployeeID", "Name", "Role")
    return (e.join(p, "EmployeeID")
            .groupBy("EmployeeID", "Name", "Role")
            .agg(F.count("ProjectID").alias("Domain_Skill_Projects"))
            .orderBy(F.col("Domain_Skill_Projects").desc(), F.col("EmployeeID"))
            .limit(n))


def cost_per_role(employees: DataFrame) -> DataFrame:
    """A4: headcount and mean hourly cost per role as DECIMAL(10,2)."""
    return (employees.groupBy("Role")
            .agg(F.count("EmployeeID").alias("Number_of_Employees"),
                 F.avg("Cost_per_Hour").cast("decimal(10,2)").alias("Average_Hourly_Cost"))
            .orderBy(F.col("Average_Hourly_Cost").desc(), "Role"))


def top_roles(employees: DataFrame) -> DataFrame:
    """A5."""
    return employees.groupBy("Role").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), "Role")


def avg_perf_by_role(employees: DataFrame) -> DataFrame:
    """A6 (employees must be enriched)."""
    return (employees.groupBy("Role").agg(F.avg("Avg_Performance").alias("avg_perf"))
            .orderBy(F.col("avg_perf").desc(), "Role"))


def domain_staff_counts(employees: DataFrame) -> DataFrame:
    """Group by an aliased column."""
    return (employees.groupBy(F.col("Domain_Expertise").alias("Domain"))
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), "Domain"))


def project_count_per_employee(projects: DataFrame, n: int = 20, approximate: bool = False) -> DataFrame:
    """Distinct projects per person, top ``n`` (ties by id)."""
    agg = (F.approx_count_distinct("ProjectID") if approximate else F.countDistinct("ProjectID"))
    return (projects.groupBy("EmployeeID").agg(agg.alias("projects"))
            .orderBy(F.col("projects").desc(), "EmployeeID").limit(n))


def next_project_id(projects: DataFrame) -> DataFrame:
    """One row, max id + 1 (5001 on an empty history)."""
    return projects.agg((F.coalesce(F.max("ProjectID"), F.lit(5000)) + 1).alias("next_project_id"))


def cost_histogram(employees: DataFrame, bins: int = 25) -> DataFrame:
    """Equal-width histogram between min and max cost, empty bins included."""
    # two numbers; as literals they are not computed again for every column that uses them
    low, high = employees.agg(F.min("Cost_per_Hour").cast("double"), F.max("Cost_per_Hour").cast("double")).first()
    lo, width = F.lit(low).cast("double"), F.lit(None if low is None else (high - low) / bins).cast("double")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("Cost_per_Hour") - lo) / width).cast("int")))
    counts = (employees.where(F.col("Cost_per_Hour").isNotNull())
              .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt")))
    spark = employees.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin",
                    F.round(lo + F.col("bin") * width, 6).alias("bin_lo"),
                    F.round(lo + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
                    F.coalesce("cnt", F.lit(0)).cast("long").alias("cnt")))


def top_domain_performers(employees: DataFrame, projects: DataFrame, domain: str, n: int = 5) -> DataFrame:
    """L1: best individual project scores in one domain."""
    e = employees.select("EmployeeID", "Name", "Role")
    p = (projects.where(F.col("Domain") == domain)
         .select("EmployeeID", "ProjectID", "Project_Name", "Individual_Performance_Score"))
    return (e.join(p, "EmployeeID")
            .orderBy(F.col("Individual_Performance_Score").desc(), "EmployeeID", "ProjectID")
            .limit(n)
            .select("EmployeeID", "Name", "Role", "ProjectID", "Project_Name", "Individual_Performance_Score"))


def fallback_team(employees: DataFrame, size: int = 3) -> DataFrame:
    """The ``size`` cheapest available people; if nobody is available,
    the first ``size`` employees by id."""
    avail = available_staff(employees)
    has_avail = avail.select(F.count(F.lit(1)) > 0).scalar()
    pool = employees.where(F.when(has_avail, F.col("Availability") == "Available").otherwise(F.lit(True)))
    order = [F.when(has_avail, coerce_numeric("Cost_per_Hour")).otherwise(F.lit(0.0)), F.col("EmployeeID")]
    return pool.orderBy(*order).limit(size).select("EmployeeID", "Name", "Role", "Cost_per_Hour")


def distinct_projects(projects: DataFrame) -> DataFrame:
    """P10: distinct (ProjectID, description, domain) rows."""
    return projects.select("ProjectID", "Project_Description", "Domain").distinct()


def coerced_employees(employees: DataFrame) -> DataFrame:
    """Numeric coercion (bad text → 0) and clipping of performance to [0, 1]."""
    perf = F.col("Avg_Performance") if "Avg_Performance" in employees.columns else F.lit(0.0)
    return employees.select(
        "EmployeeID",
        coerce_numeric(F.col("Age").cast("string")).alias("Age"),
        coerce_numeric(F.col("Cost_per_Hour").cast("string")).alias("Cost_per_Hour"),
        coerce_numeric("Skills").alias("Skills_as_number"),
        clip01(coerce_numeric(perf)).alias("Avg_Performance"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One aggregate pass → per column: rows, nulls, distinct values."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggs.append((F.count(F.lit(1)) - F.count(F.col(c))).alias(f"n__{c}"))
        aggs.append(F.countDistinct(F.col(c)).alias(f"d__{c}"))
    one = df.agg(*aggs)
    stacked = ", ".join(f"'{c}', `n__{c}`, `d__{c}`" for c in df.columns)
    return one.selectExpr(f"stack({len(df.columns)}, {stacked}) AS (column_name, nulls, distinct_values)",
                          "__rows AS rows")


def run_sql(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Q1: ad-hoc SQL over the given frames by name; the result stays a DataFrame.

    The names hold for this statement only: it is given as common table expressions, so no view of the
    session is made or replaced and several users of a session don't meet.
    """
    named = ", ".join(f"`{name}` AS (SELECT * FROM {{{name}}})" for name in views)
    body = sql.strip().rstrip(";").replace("{", "{{").replace("}", "}}")
    if not named:
        return spark.sql(sql)
    if body[:4].lower() == "with":
        body = f"SELECT * FROM ({body})"
    return spark.sql(f"WITH {named} {body}", **views)
