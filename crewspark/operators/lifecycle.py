"""Completed projects back into the history.

A batch of completed teams becomes project-history rows: each completed
brief gets the next free ProjectID, each member a row carrying their skills
as the stack, their expertise as the domain, their role, their own score and
the team's mean score as the project's success.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.schema import PROJECTS, conform
from ..session import written

# --- fixed values: the default final score per member and the texts of a completed project ---
DEFAULT_SCORE = 0.85
NAME_TEXT, DESCRIPTION_TEXT = "New Project based on: ", "Completed project based on request: "
# --- end of fixed values ---


def consecutive_ids(df: DataFrame, order_col: str, start, out: str = "seq") -> DataFrame:
    """Number rows ``start, start+1, …`` in ``order_col`` order without a single-task window.

    One range shuffle sorts the rows; inside a partition the row number is
    read off ``monotonically_increasing_id`` (partition index in the upper
    bits).  The numbered rows are written once, so that the partitions' counts
    and the rows are of the same range exchange (its bounds are sampled); each
    partition is shifted by the row counts of the earlier ones, a table of one
    row per partition.  ``start`` may be a literal or a scalar-subquery column.
    """
    ranged = written(df.repartitionByRange(order_col).sortWithinPartitions(order_col)
                     .withColumn("_pid", F.spark_partition_id())
                     .withColumn("_rn", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)),
                     "consecutive-ids")
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(
        F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start_col = start if not isinstance(start, (int, float)) else F.lit(start)
    return (ranged.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(out, (start_col + F.col("_off") + F.col("_rn")).cast("long"))
            .drop("_pid", "_rn", "_off"))


def completion_records(completed: DataFrame, employees: DataFrame, projects: DataFrame,
                       scores: DataFrame | None = None) -> DataFrame:
    """U1+U2: ``completed`` has (BriefID, team array<long>, Project_Name, Project_Description);
    ``scores`` optionally (BriefID, EmployeeID, score), else every member scores 0.85."""
    next_id = projects.select(F.coalesce(F.max("ProjectID"), F.lit(5000)) + 1).scalar()
    briefs = consecutive_ids(completed.select("BriefID", "Project_Name", "Project_Description"),
                             "BriefID", next_id, "ProjectID")
    members = completed.select("BriefID", F.explode(F.array_distinct("team")).alias("EmployeeID"))
    if scores is not None:
        members = members.join(scores.select("BriefID", "EmployeeID", "score"), ["BriefID", "EmployeeID"], "left")
        members = members.withColumn("score", F.coalesce("score", F.lit(DEFAULT_SCORE)))
    else:
        members = members.withColumn("score", F.lit(DEFAULT_SCORE))
    emp = employees.select("EmployeeID", "Skills", "Domain_Expertise", "Role")
    rows = members.join(briefs, "BriefID").join(emp, "EmployeeID")
    team = Window.partitionBy("ProjectID")
    out = rows.select(
        "ProjectID", "EmployeeID", "Project_Name", "Project_Description",
        F.col("Skills").alias("Tech_Stack_Used"), F.col("Domain_Expertise").alias("Domain"),
        F.col("Role").alias("Project_Role"),
        F.avg("score").over(team).alias("Project_Success_Score"),
        F.col("score").alias("Individual_Performance_Score"))
    return conform(out, PROJECTS)


def completed_from_teams(teams: DataFrame, briefs: DataFrame) -> DataFrame:
    """Name and describe each brief's recommended team as the reference's form does."""
    text = briefs.select("BriefID", F.col("BriefText").alias("q"))
    return (teams.where(F.size("team") > 0).select("BriefID", "team").join(text, "BriefID")
            .select("BriefID", "team",
                    F.concat(F.lit(NAME_TEXT), F.substring("q", 1, 30), F.lit("…")).alias("Project_Name"),
                    F.concat(F.lit(DESCRIPTION_TEXT), F.col("q")).alias("Project_Description")))


def performance_state(rows: DataFrame) -> DataFrame:
    """U4: (EmployeeID, total, n) of the history rows' scores; states of several parts of a history add up."""
    return rows.groupBy("EmployeeID").agg(F.sum("Individual_Performance_Score").alias("total"), F.count("Individual_Performance_Score").alias("n"))


def updated_state(state: DataFrame, appended: DataFrame) -> DataFrame:
    """The state after an append: the appended rows' own state is added, the history is not read."""
    return state.unionByName(performance_state(appended)).groupBy("EmployeeID").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def state_averages(state: DataFrame) -> DataFrame:
    """(EmployeeID, Avg_Performance): the mean of a person's scores, null where all are null."""
    return state.select("EmployeeID", F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("Avg_Performance"))
