"""Registered queries: embeddings, similar projects and what derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import skills as X
from ..operators import similarity as V
from ..operators import teams as TM
from ..operators.context import brief_context
from ..operators.lifecycle import consecutive_ids
from ..operators.textvectors import text_vectors
from ..session import scratch_path, written
from ..sources.fixtures import Workforce, with_views
from .registry import register
from .reports import (CANON_KEYS_SQL, CANONICAL_SQL, ENRICHED_SQL, PARSED_SQL, domain_sql,
                      enriched_employees, normalize_sql, phrase_sql)

K = 50
INDEX_DOMAIN = "Finance"

_TOK = "list_filter(list_transform(string_split({c}, ','), lambda t: trim(t)), lambda t: t <> '')"


_TERMS = "SELECT t, token, count(*) AS tf FROM (SELECT t, unnest(regexp_extract_all(lower(t), '[a-z0-9+#]+')) AS token FROM ({texts}) x) y GROUP BY t, token"


def _sim_sql(where: str = "") -> str:
    return f"""
SELECT BriefID, ProjectID, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY BriefID ORDER BY score DESC, ProjectID) AS rank
  FROM (SELECT p.BriefID, i.ProjectID, s.score FROM parsed p JOIN tsim s ON s.qt = p.project_description
        JOIN (SELECT * FROM pindex {where}) i ON i.Project_Description = s.ct WHERE s.score > 0) h) r
WHERE rank <= {K}"""


def _topn_sql(n: int, include_domain: bool) -> str:
    dom = " UNION ALL SELECT BriefID, Domain AS token FROM simrows WHERE Domain IS NOT NULL" if include_domain else ""
    return f"""
SELECT * FROM (
  SELECT BriefID, token, cnt, row_number() OVER (PARTITION BY BriefID ORDER BY cnt DESC, token) AS rank
  FROM (SELECT BriefID, token, count(*) AS cnt
        FROM (SELECT BriefID, unnest({_TOK.format(c='Tech_Stack_Used')}) AS token FROM simrows{dom}) t
        GROUP BY BriefID, token) c) r
WHERE rank <= {n}"""


# Oracle CTEs by name: (sql, dependencies).  Fixture views resolve through with_views.
CTES: dict[str, tuple[str, list[str]]] = {
    "parsed": (PARSED_SQL, ["briefs"]),
    "emp": (ENRICHED_SQL, ["employees", "projects"]),
    "canonical": (CANONICAL_SQL, ["employees"]),
    "canon_keys": (CANON_KEYS_SQL, ["canonical"]),
    "pindex": ("SELECT ProjectID, min(Domain) AS Domain, min(Project_Description) AS Project_Description FROM projects GROUP BY ProjectID",
               ["projects"]),
    "cterms": (_TERMS.format(texts="SELECT DISTINCT Project_Description AS t FROM pindex WHERE Project_Description IS NOT NULL"), ["pindex"]),
    "qterms": (_TERMS.format(texts="SELECT DISTINCT project_description AS t FROM parsed WHERE project_description IS NOT NULL"), ["parsed"]),
    "idf": ("SELECT token, ln((1 + n) / (1 + count(*))) + 1 AS idf FROM cterms, (SELECT count(DISTINCT t) AS n FROM cterms) x GROUP BY token, n", ["cterms"]),
    "cw": ("SELECT c.t, c.token, tf * idf AS w FROM cterms c JOIN idf ON idf.token = c.token", ["cterms", "idf"]),
    "qw": ("SELECT q.t, q.token, tf * coalesce(idf, ln(1.0 + (SELECT count(DISTINCT t) FROM cterms)) + 1) AS w FROM qterms q LEFT JOIN idf ON idf.token = q.token",
           ["qterms", "idf", "cterms"]),
    "tsim": ("SELECT q.t AS qt, c.t AS ct, round(sum(q.w * c.w) / (any_value(qn.n) * any_value(cn.n)), 6) AS score FROM qw q JOIN cw c ON c.token = q.token "
             "JOIN (SELECT t, sqrt(sum(w * w)) AS n FROM qw GROUP BY t) qn ON qn.t = q.t JOIN (SELECT t, sqrt(sum(w * w)) AS n FROM cw GROUP BY t) cn ON cn.t = c.t "
             "GROUP BY q.t, c.t", ["qw", "cw"]),
    "sim": (_sim_sql(), ["parsed", "tsim", "pindex"]),
    "simrows": ("SELECT s.BriefID, p.ProjectID, p.EmployeeID, p.Tech_Stack_Used, p.Domain "
             "FROM sim s JOIN projects p ON s.ProjectID = p.ProjectID", ["sim", "projects"]),
    "topn": (_topn_sql(8, False), ["simrows"]),
    "modal": ("SELECT BriefID, Domain AS modal_domain FROM (SELECT BriefID, Domain, row_number() OVER "
              "(PARTITION BY BriefID ORDER BY count(*) DESC, Domain) AS rn FROM simrows WHERE Domain IS NOT NULL "
              "GROUP BY BriefID, Domain) m WHERE rn = 1", ["simrows"]),
    "bdom": (f"SELECT p.BriefID, coalesce({domain_sql('p.project_description')}, m.modal_domain) AS Domain "
             "FROM parsed p LEFT JOIN modal m ON p.BriefID = m.BriefID", ["parsed", "modal"]),
    "vl": ("SELECT BriefID, list(token ORDER BY rank) AS vec_items FROM topn GROUP BY BriefID", ["topn"]),
    "items": (f"SELECT p.BriefID, list_concat({phrase_sql('p.project_description')}, "
              "coalesce(vl.vec_items, []::VARCHAR[])) AS items FROM parsed p LEFT JOIN vl ON p.BriefID = vl.BriefID",
              ["parsed", "vl"]),
    "bf": ("SELECT BriefID, EmployeeID, n / max(n) OVER (PARTITION BY BriefID) AS base_fit "
           "FROM (SELECT BriefID, EmployeeID, count(*) AS n FROM simrows GROUP BY BriefID, EmployeeID) c", ["simrows"]),
    "fit": ("SELECT coalesce(bf.BriefID, mem.BriefID) AS BriefID, coalesce(bf.EmployeeID, mem.EmployeeID) AS EmployeeID, "
            "coalesce(bf.base_fit, 0.0) + CASE WHEN mem.EmployeeID IS NOT NULL THEN 0.3 ELSE 0.0 END AS fit "
            "FROM bf FULL OUTER JOIN (SELECT d.BriefID, e.EmployeeID FROM bdom d JOIN employees e "
            "ON e.Domain_Expertise = d.Domain) mem ON bf.BriefID = mem.BriefID AND bf.EmployeeID = mem.EmployeeID",
            ["bf", "bdom", "employees"]),
    "med": ("SELECT median(Cost_per_Hour) AS m, count(*) AS c FROM employees WHERE Availability = 'Available'",
            ["employees"]),
    "bud": ("SELECT p.BriefID, CASE WHEN p.max_budget_per_hour > 0 THEN p.max_budget_per_hour "
            "WHEN med.c > 0 THEN greatest(1.0, round(med.m * 4.0, 2)) ELSE 100.0 END AS budget FROM parsed p, med",
            ["parsed", "med"]),
}


def chain(names: list[str]) -> str:
    """``WITH`` clause holding the named oracle CTEs and everything they read."""
    views: list[str] = []
    order: list[str] = []

    def visit(n: str) -> None:
        if n in CTES:
            for d in CTES[n][1]:
                visit(d)
            if n not in order:
                order.append(n)
        elif n not in views:
            views.append(n)

    for n in names:
        visit(n)
    return with_views(views, [(n, CTES[n][0]) for n in order])


_CONTEXTS: dict[tuple[str, str], tuple] = {}


def context(spark: SparkSession, d: str):
    """(workforce, people, brief context) of a folder; the similar projects are searched and written once a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CONTEXTS:
        wf = Workforce(spark, d)
        emp = enriched_employees(wf)
        _CONTEXTS[key] = wf, emp, brief_context(wf.briefs, emp, wf.projects, k=K)
    return _CONTEXTS[key]


def _stored_index(spark: SparkSession, wf: Workforce) -> DataFrame:
    """The index written partitioned by Domain and read back."""
    path = scratch_path(spark, "project-index")
    index = V.build_index(wf.projects)
    index.write.partitionBy("Domain").parquet(path)
    return spark.read.schema(index.schema).parquet(path)


@register("embedding_index", chain(["pindex", "cw"]) + """
SELECT i.ProjectID, i.Domain, i.Project_Description, coalesce(n.n_terms, 0) AS n_terms, n.norm
FROM pindex i LEFT JOIN (SELECT t, count(*) AS n_terms, sqrt(sum(w * w)) AS norm FROM cw GROUP BY t) n ON n.t = i.Project_Description""",
          round_cols=["norm"])
def q_embedding_index(spark: SparkSession, d: str) -> DataFrame:
    """Every project with its description's token weights (their number and norm)."""
    idx = _stored_index(spark, Workforce(spark, d))
    norms = V.index_weights(idx)[1]
    return idx.join(norms, "Project_Description", "left").select(
        "ProjectID", "Domain", "Project_Description", F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"), "norm")


@register("similar_projects", chain(["sim"]) + "SELECT * FROM sim", bench=True)
def q_similar(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return V.top_k_by_text(X.parse_reply(wf.briefs), V.build_index(wf.projects), k=K)


@register("similar_projects_in_domain",
          chain(["parsed", "tsim", "pindex"]) + _sim_sql(f"WHERE Domain = '{INDEX_DOMAIN}'"))
def q_similar_domain(spark: SparkSession, d: str) -> DataFrame:
    """V4: the per-domain collection is the index's Domain partition (partition-pruned read)."""
    wf = Workforce(spark, d)
    return V.top_k_by_text(X.parse_reply(wf.briefs), _stored_index(spark, wf), k=K, within=INDEX_DOMAIN)


@register("similar_project_rows", chain(["simrows"]) + "SELECT BriefID, ProjectID, EmployeeID FROM simrows")
def q_similar_rows(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    sim = V.top_k_by_text(X.parse_reply(wf.briefs), V.build_index(wf.projects), k=K)
    return V.similar_rows(sim, wf.projects).select("BriefID", "ProjectID", "EmployeeID")


def vector_queries(vectors: DataFrame) -> DataFrame:
    """The query set of the vector searches: every row whose id is divisible by 100."""
    return vectors.where(F.col("vec_id") % 100 == 0).select("vec_id", F.col("embedding").alias("qvec"))


@register("similar_vectors", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour) AS rank FROM (
  SELECT q.vec_id, c.vec_id AS neighbour,
    round(list_dot_product(q.v, c.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(c.v, c.v))), 6) AS score
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 100 = 0) q, (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) c) s) r
WHERE rank <= {K}""")
def q_similar_vectors(spark: SparkSession, d: str) -> DataFrame:
    """V3 on given vectors: exact nearest neighbours by the blocked product."""
    vectors = Workforce(spark, d).embeddings
    return V.top_k_similar(vector_queries(vectors), vectors.withColumnRenamed("vec_id", "neighbour"), k=K, qid="vec_id", cid="neighbour")


@register("similar_tech_topn", chain(["topn"]) + "SELECT BriefID, token, cnt, rank FROM topn")
def q_topn(spark: SparkSession, d: str) -> DataFrame:
    _, _, ctx = context(spark, d)
    return ctx.for_all(V.tech_top_n(ctx.stacks, 8).select("BriefID", "token", "cnt", "rank"))


@register("modal_domain", chain(["modal"]) + "SELECT * FROM modal")
def q_modal(spark: SparkSession, d: str) -> DataFrame:
    _, _, ctx = context(spark, d)
    return ctx.for_all(V.modal_domain(ctx.stacks))


@register("brief_domain", chain(["bdom"]) + "SELECT * FROM bdom")
def q_brief_domain(spark: SparkSession, d: str) -> DataFrame:
    _, _, ctx = context(spark, d)
    return ctx.domain


@register("inferred_skills", chain(["items", "canon_keys"]).rstrip() + normalize_sql("items"), bench=True)
def q_inferred(spark: SparkSession, d: str) -> DataFrame:
    """V6 (team-builder form): phrase skills + top-8 stack tokens of similar projects, normalised."""
    _, _, ctx = context(spark, d)
    return ctx.inferred.select("BriefID", F.array_join("inferred", "|").alias("skills"))


@register("inferred_skills_history", chain(["simrows", "parsed"]) + f"""
, t6 AS ({_topn_sql(6, True)})
SELECT p.BriefID, coalesce(string_agg(t6.token, '|' ORDER BY t6.rank), '') AS skills
FROM parsed p LEFT JOIN t6 ON p.BriefID = t6.BriefID GROUP BY p.BriefID""")
def q_inferred_history(spark: SparkSession, d: str) -> DataFrame:
    """V6 (history form): stack tokens plus the Domain, top 6, not normalised."""
    _, _, ctx = context(spark, d)
    lst = V.ranked_list(V.tech_top_n(ctx.stacks, 6, include_domain=True), "token", "items")
    return ctx.for_all(ctx.asked.select("BriefID").join(lst, "BriefID", "left")
                       .select("BriefID", F.coalesce(F.array_join("items", "|"), F.lit("")).alias("skills")))


@register("project_fit", chain(["fit"]) + "SELECT * FROM fit", round_cols=["fit"])
def q_project_fit(spark: SparkSession, d: str) -> DataFrame:
    wf, emp, ctx = context(spark, d)
    return ctx.fit(wf.employees)


@register("budget_heuristic", chain(["bud"]) + "SELECT * FROM bud")
def q_budget(spark: SparkSession, d: str) -> DataFrame:
    wf = Workforce(spark, d)
    return TM.budget_heuristic(X.parse_reply(wf.briefs).select("BriefID", "max_budget_per_hour"), wf.employees).select("BriefID", "budget")


@register("candidate_scores", chain(["bf", "bdom", "emp", "parsed"]).rstrip() + """
, cand AS (SELECT BriefID, EmployeeID FROM bf
           UNION SELECT p.BriefID, f.EmployeeID FROM parsed p,
             (SELECT EmployeeID FROM emp WHERE Availability = 'Available' ORDER BY Cost_per_Hour, EmployeeID LIMIT 3) f),
scored AS (SELECT c.BriefID, c.EmployeeID, coalesce(bf.base_fit, 0.0) + CASE WHEN a.Domain_Expertise = d.Domain THEN 0.3 ELSE 0.0 END AS fit,
             greatest(0.0, least(1.0, coalesce(a.Avg_Performance, 0.0))) AS perf
           FROM cand c JOIN (SELECT * FROM emp WHERE Availability = 'Available') a ON a.EmployeeID = c.EmployeeID
           LEFT JOIN bf ON bf.BriefID = c.BriefID AND bf.EmployeeID = c.EmployeeID LEFT JOIN bdom d ON d.BriefID = c.BriefID)
SELECT BriefID, EmployeeID, fit, perf, CAST(3 * round_even(fit * 1000, 0) + 2 * round_even(perf * 1000, 0) AS BIGINT) AS score FROM scored""",
          round_cols=["fit", "perf"], bench=True)
def q_candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    """Members of similar projects and the fallback team of every brief, scored."""
    _, emp, ctx = context(spark, d)
    listed = ctx.asked_fit.select("BriefID", "EmployeeID").unionByName(TM.fallback_members(ctx.asked, emp).select("BriefID", "EmployeeID"))
    return ctx.for_all(TM.candidate_scores(listed, ctx.asked_fit, ctx.asked_domain, emp))


@register("embed_text", None)
def q_embed_text(spark: SparkSession, d: str) -> DataFrame:
    """V1: TF-IDF unit vectors of every project description (rows-only check)."""
    wf = Workforce(spark, d)
    docs = wf.projects.select("ProjectID", "Project_Description").distinct()
    emb = V.embed_text(docs, "ProjectID", "Project_Description", sparse=True)
    return emb.select("ProjectID", F.size(F.filter("embedding.values", lambda x: x != 0)).alias("nnz"),
                      F.round(F.sqrt(F.aggregate("embedding.values", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("norm"))


@register("similar_projects_ann", None)
def q_similar_ann(spark: SparkSession, d: str) -> DataFrame:
    """V5: approximate neighbours by random-projection codes; rows-only, recall against V3 is tested."""
    vectors = Workforce(spark, d).embeddings
    return V.similar_by_codes(vector_queries(vectors), vectors.withColumnRenamed("vec_id", "neighbour"), k=K, qid="vec_id", cid="neighbour")


@register("text_vector_neighbours", chain(["cw", "pindex"]) + """
, nn AS (SELECT t, sqrt(sum(w * w)) AS n FROM cw GROUP BY t),
asked AS (SELECT DISTINCT Project_Description AS t FROM pindex WHERE ProjectID % 100 = 0 AND Project_Description IS NOT NULL),
s AS (SELECT a.t AS q, c.t AS d, round(sum(a.w * c.w) / (any_value(na.n) * any_value(nc.n)), 6) AS score
      FROM cw a JOIN asked ON asked.t = a.t JOIN cw c ON c.token = a.token JOIN nn na ON na.t = a.t JOIN nn nc ON nc.t = c.t GROUP BY a.t, c.t)
SELECT md5(q) AS query, md5(d) AS neighbour, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, md5(d)) AS rank FROM s QUALIFY rank <= 10""", round_cols=["score"])
def q_text_vector_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """V1 with V5: the ten nearest descriptions by dense text vectors of each description of a project whose id is
    divisible by 100.  The vectors hold as many dimensions as these descriptions span, so the cosines are exact."""
    wf = Workforce(spark, d)
    index = V.build_index(wf.projects)
    vectors, _ = text_vectors(index, dims=64)
    # a number for each text, in the order of its hash: ties go to the smaller
    numbered = written(consecutive_ids(vectors, "did", 0, "id").withColumn("vec", F.col("vec").cast("array<float>")), "numbered-vectors")
    asked = index.where(F.col("ProjectID") % 100 == 0).select(F.md5("Project_Description").alias("did")).distinct()
    near = V.similar_by_codes(numbered.join(asked, "did").select("id", F.col("vec").alias("qvec")), numbered.select(F.col("id").alias("other"), "vec"), k=10, share=1.0, qid="id", cid="other", cvec="vec")
    name = numbered.select("id", "did")
    return near.join(name.withColumnRenamed("did", "query"), "id").join(name.select(F.col("id").alias("other"), F.col("did").alias("neighbour")), "other") \
        .where("score > 0").select("query", "neighbour", "score", "rank")


@register("phrase_skills_of_description", chain(["parsed"]) +
          f"SELECT BriefID, array_to_string({phrase_sql('project_description')}, '|') AS skills FROM parsed")
def q_phrase_desc(spark: SparkSession, d: str) -> DataFrame:
    p = X.parse_reply(Workforce(spark, d).briefs)
    return p.select("BriefID", F.array_join(X.phrase_skills("project_description"), "|").alias("skills"))

