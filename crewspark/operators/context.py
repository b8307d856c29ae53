"""Brief context: everything the team builder derives from a brief, for all briefs.

reply → (required skills, budget, description) → known/missing split →
keyword domain → similar projects → modal-domain fallback → inferred skills
(phrases + similar stacks, normalised) → budget default → fit scores.
Each step is a DataFrame keyed by BriefID.

What follows from the description alone is worked out once for each different description, on the brief of
the smallest id, and handed to the others at the end (``BriefContext.for_all``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import skills as X
from ..session import materialize, written
from . import similarity as V
from . import teams as TM


@dataclass
class BriefContext:
    parsed: DataFrame       # BriefID, BriefText, required_skills, max_budget_per_hour, project_description
    split: DataFrame        # BriefID, explicit_skills, missing_skills
    budget: DataFrame       # BriefID, budget
    canonical: DataFrame    # Skill
    asked: DataFrame        # the rows of parsed that stand for all
    of: DataFrame           # BriefID, asked_id, salt: the brief in asked that a brief is answered by
    heavy: DataFrame        # asked_id, salts: briefs in asked that answer for very many
    # by the BriefIDs of asked:
    similar: DataFrame      # BriefID, ProjectID, score, rank
    rows: DataFrame         # similar projects' member rows (BriefID, ProjectID, EmployeeID)
    stacks: DataFrame       # similar projects' stacks with member counts
    asked_domain: DataFrame    # BriefID, Domain
    asked_inferred: DataFrame  # BriefID, inferred (normalised skills)

    def for_all(self, rows: DataFrame) -> DataFrame:
        """``rows`` by the BriefIDs of ``asked``, for every brief that each of them answers for."""
        dealt = rows.withColumnRenamed("BriefID", "_id").join(F.broadcast(self.heavy), F.col("_id") == F.col("asked_id"), "left").drop("asked_id") \
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        return self.of.join(dealt, F.col("asked_id").eqNullSafe(F.col("_id")) & (F.col("salt") == F.col("_salt"))).drop("asked_id", "salt", "_id", "_salt")

    @cached_property
    def domain(self) -> DataFrame:
        """BriefID, Domain."""
        return self.for_all(self.asked_domain)

    @cached_property
    def inferred(self) -> DataFrame:
        """BriefID, inferred (normalised skills)."""
        return self.for_all(self.asked_inferred)

    @cached_property
    def asked_fit(self) -> DataFrame:
        """BriefID, EmployeeID, base_fit of the briefs in ``asked``; read by the scores and by the teams, written when first asked for."""
        return written(V.base_fit(self.rows), "base-fit")

    def fit_of(self, members: DataFrame) -> DataFrame:
        """BriefID, EmployeeID, base_fit of the given pairs that have one."""
        pairs = members.select("BriefID", "EmployeeID").distinct().join(self.of.select("BriefID", "asked_id"), "BriefID")
        fit = self.asked_fit.select(F.col("BriefID").alias("asked_id"), "EmployeeID", "base_fit")
        return pairs.join(fit, ["asked_id", "EmployeeID"]).select("BriefID", "EmployeeID", "base_fit")

    def fit(self, employees: DataFrame, boost: float = 0.30) -> DataFrame:
        """``project_fit`` of all briefs; a domain's roster meets the briefs of a description as one array, not as rows of each description."""
        asked, roster = V.brief_domains(self.asked_domain), V.domain_roster(employees)
        hits = V.roster_hits(self.asked_fit, asked, roster)
        told = self.of.groupBy("asked_id", "salt").agg(F.sort_array(F.collect_list(F.struct("BriefID"))["BriefID"]).alias("ids")).select(F.col("asked_id").alias("BriefID"), "ids")
        return self.for_all(V.boosted_fit(self.asked_fit, hits, boost)).unionByName(V.roster_fit(asked, hits, roster, boost, told))


FOUND_IDS = 1 << 18  # ids of similar projects that every task may hold
ANSWERED = 4096  # briefs that meet the rows of their answer under one join key


def answered_by(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(of, heavy) of BriefContext.  Briefs with the same description have the one of the smallest BriefID as theirs;
    a BriefID that is null or has several rows is its own."""
    ids = parsed.groupBy("BriefID").agg(F.count(F.lit(1)).alias("n"), F.min(F.md5("project_description")).alias("q"))
    single = F.col("BriefID").isNotNull() & (F.col("n") == 1) & F.col("q").isNotNull()
    ids = written(ids.withColumn("q", F.when(single, F.col("q"))).drop("n"), "brief-texts")
    texts = written(ids.where("q is not null").groupBy("q").agg(F.min("BriefID").alias("asked_id"), F.ceil(F.count(F.lit(1)) / ANSWERED).cast("int").alias("salts")), "brief-answers")
    of = ids.join(texts, "q", "left").select("BriefID", F.coalesce("asked_id", "BriefID").alias("asked_id"),
                                             F.pmod(F.xxhash64("BriefID"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    return written(of, "brief-answered"), texts.where("salts > 1").select("asked_id", "salts")


def brief_context(briefs: DataFrame, employees: DataFrame, projects: DataFrame,
                  k: int = 50, top_tokens: int = 8, index: DataFrame | None = None) -> BriefContext:
    parsed = written(X.parse_reply(briefs).select("BriefID", "BriefText", "required_skills",
                                                  "max_budget_per_hour", "project_description"), "parsed-briefs")
    canonical = X.canonical_skills(employees)
    split = X.split_known_skills(parsed, canonical)
    idx = index if index is not None else V.build_index(projects)
    of, heavy = answered_by(parsed)
    own = of.where(F.col("BriefID").eqNullSafe(F.col("asked_id"))).select(F.col("BriefID").alias("_own"))
    asked = written(parsed.join(own, F.col("BriefID").eqNullSafe(F.col("_own")), "left_semi"), "asked-briefs")
    # the table of similar projects feeds fit, domain and inferred skills: computed once
    similar = materialize(V.top_k_by_text(asked, idx, k=k))
    found = similar.select("ProjectID").distinct()
    if found.count() <= FOUND_IDS:  # other projects' rows need not be shuffled to meet none
        projects = projects.join(F.broadcast(found), "ProjectID", "left_semi")
    rows = V.similar_rows(similar, projects.select("ProjectID", "EmployeeID"))
    stacks = written(V.similar_stacks(similar, projects), "similar-stacks")
    domain = V.brief_domain(asked, stacks)
    vec_tokens = V.ranked_list(V.tech_top_n(stacks, top_tokens), "token", "vec_items")
    items = (asked.select("BriefID", X.phrase_skills("project_description").alias("phr"))
             .join(vec_tokens, "BriefID", "left")
             .select("BriefID", F.concat("phr", F.coalesce("vec_items", F.array().cast("array<string>")))
                     .alias("items")))
    inferred = X.normalize_skills(items, canonical, out="inferred")
    budget = TM.budget_heuristic(parsed.select("BriefID", "max_budget_per_hour"), employees).select("BriefID", "budget")
    return BriefContext(parsed, split, budget, canonical, asked, of, heavy, similar, rows, stacks, domain, inferred)
