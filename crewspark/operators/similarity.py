"""Vector retrieval and what the team builder derives from it.

Exact k-nearest search (V3) is a blocked matrix product: queries are hashed
into ``nq`` query blocks and the corpus into ``nc`` corpus blocks; every
query row is replicated to the ``nc`` corpus blocks and every corpus row to
the ``nq`` query blocks, so each (query block, corpus block) cogroup holds a
bounded slice of both sides.  The cogroup multiplies the two slices in numpy, a tile
of queries at a time, and emits only its top-k per query; a window merges the per-block lists.
Nothing is collected to the driver and no pair is materialised as a row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skills import infer_domain, skill_tokens
from ..session import parallelism, ship_code, written

QUERY_BLOCK_ROWS = 20_000     # queries per cogroup slice
CORPUS_BLOCK_ROWS = 50_000    # corpus vectors per cogroup slice
MIN_BLOCK_ROWS = 4_096        # corpus vectors below which a block is not cut further
QUERY_TILE_ROWS = 256         # queries multiplied at a time inside a slice
SCORE_PLACES = 6              # scores are ranked at this precision, ties by id
ROSTER_ROWS = 8_192           # people in a part of the rosters
CELL_PAIRS = 1 << 28          # pairs of briefs and people of one domain and salt


def unit_vector(c: Column | str) -> Column:
    """L2-normalise an array column (zero vectors stay zero)."""
    col = F.col(c) if isinstance(c, str) else c
    d = F.transform(col, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(d, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


TERM = r"[a-z0-9+#]+"  # a token of a text, after lower-casing


def text_terms(texts: DataFrame, text: str) -> DataFrame:
    """(text, token, tf) of every distinct non-null text."""
    tokens = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0)))
    return texts.where(F.col(text).isNotNull()).select(text).distinct().select(text, tokens.alias("token")).groupBy(text, "token").agg(F.count(F.lit(1)).alias("tf"))


def build_index(projects: DataFrame, domain: str | None = None) -> DataFrame:
    """One row per project (lowest Domain and description when a project's rows
    disagree): ProjectID, Domain, Project_Description; optionally of a single domain."""
    index = (projects.groupBy("ProjectID")
             .agg(F.min("Domain").alias("Domain"), F.min("Project_Description").alias("Project_Description")))
    return index if domain is None else index.where(F.col("Domain") == domain)


def index_weights(index: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """V1: (weights, norms, idf) of the index's distinct descriptions.

    A token's weight in a text is tf * (ln((1 + texts) / (1 + texts with the token)) + 1).
    """
    terms = text_terms(index, "Project_Description")
    n = index.where("Project_Description is not null").select(F.count_distinct("Project_Description")).scalar()
    idf = terms.groupBy("token").agg(F.count(F.lit(1)).alias("df")).select("token", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    weights = terms.join(idf, "token").select("Project_Description", "token", (F.col("tf") * F.col("idf")).alias("w"))
    norms = weights.groupBy("Project_Description").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.count(F.lit(1)).alias("n_terms"))
    return weights, norms, idf


BLOCK_TEXTS = 256     # texts in a block of a token's postings
SALT_BLOCKS = 64      # blocks of a token that meet under one join key
SEED_TEXTS = 64       # texts that set a query's first bar
LEVELS = 63           # steps of impact, four a halving
SLACK = 2e-6          # a bound has to miss by more than scores are rounded


@dataclass
class TextIndex:
    """Impact-ordered postings of the distinct texts of an index, written in the shared folder."""

    texts: DataFrame      # did, held: a text and how many of its projects are wanted at most
    vectors: DataFrame    # did, weights: token -> impact (its share of the text's unit vector)
    blocks: DataFrame     # token, level, sub, salt, top, held, docs: postings of like impact, best first
    tokens: DataFrame     # token, top, n_salt, seed: best impact, join keys, the best block that holds k projects
    idf: DataFrame        # token, idf
    n: int                # distinct texts


def text_index(index: DataFrame, k: int, within: str | None = None) -> TextIndex:
    """V2: postings of every token over the distinct texts, in blocks of like impact.

    A block is (token, level of impact, part of it by hash), at most about BLOCK_TEXTS texts with
    their best impact: a search reads the blocks that can still matter and skips the others
    whole.  No token's postings meet in one task, however common it is.
    """
    used = F.count_if(F.lit(True) if within is None else F.col("Domain") == within)
    every = written(index.where("Project_Description is not null").groupBy("Project_Description").agg(used.alias("used"))
                    .select("Project_Description", F.md5("Project_Description").alias("did"), F.least("used", F.lit(k)).alias("held")), "text-index-texts")
    weights, norms, idf = index_weights(every)
    texts = every.where("held > 0").select("did", "held")
    impacts = weights.join(norms.select("Project_Description", "norm"), "Project_Description") \
        .select(F.md5("Project_Description").alias("did"), "token", (F.col("w") / F.col("norm")).alias("impact")).join(texts, "did")
    impacts = written(impacts.withColumn("level", F.least(F.lit(LEVELS), F.floor(F.log2("impact") * -4)).cast("int")), "text-index-impacts")
    parts = impacts.groupBy("token", "level").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).alias("parts"))
    blocks = impacts.join(parts, ["token", "level"]).withColumn("sub", F.pmod(F.xxhash64("did"), "parts").cast("int")) \
        .groupBy("token", "level", "sub").agg(F.max("impact").alias("top"), F.sum("held").alias("held"), F.sort_array(F.collect_list(F.struct("impact", "did", "held")), False).alias("docs"))
    blocks = written(blocks, "text-index-blocks")
    full = F.when(F.col("held") >= k, F.struct("top", "level", "sub"))  # a block that holds k projects by itself
    tokens = blocks.groupBy("token").agg(F.max("top").alias("top"), F.ceil(F.count(F.lit(1)) / SALT_BLOCKS).alias("n_salt"), F.max(full).alias("seed"))
    vectors = impacts.groupBy("did").agg(F.map_from_entries(F.collect_list(F.struct("token", "impact"))).alias("weights"))
    return TextIndex(texts, vectors, blocks, tokens, idf, every.count())


def _dot(terms: str, weights: str) -> Column:
    """Sum of the products of an array of (token, qn) with a map token -> impact."""
    return F.aggregate(F.col(terms), F.lit(0.0), lambda acc, t: acc + t["qn"] * F.coalesce(F.try_element_at(F.col(weights), t["token"]), F.lit(0.0)))


def text_candidates(queries: DataFrame, idx: TextIndex, k: int, qtext: str) -> tuple[DataFrame, DataFrame]:
    """(seeds, scored): (q, did, held, score) of the texts that set each query's bar, and of all that may reach it.

    Max-score in three steps.  A query's bar is the score that ``k`` projects of its best seed texts
    reach: those of the highest impact for its weightiest token.  Its tokens, from the
    least bound (query weight times best impact) up, are common as long as their bounds
    together miss the bar; a text of common tokens alone cannot reach it.  So only the other,
    telling tokens open texts, and of their postings only blocks and texts whose impact, with the bounds of
    all other tokens, reaches the bar.  Common tokens finish the scores of the texts opened.
    """
    terms = text_terms(queries, qtext).join(idx.idf, "token", "left") \
        .select(F.md5(qtext).alias("q"), "token", (F.col("tf") * F.coalesce("idf", F.log(F.lit(1.0 + idx.n)) + 1)).alias("qw"))
    norms = terms.groupBy("q").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("q_norm"))
    terms = written(terms.join(idx.tokens, "token").join(norms, "q")
                    .select("q", "token", "n_salt", "seed", (F.col("qw") / F.col("q_norm")).alias("qn"), (F.col("qw") / F.col("q_norm") * F.col("top")).alias("bound")), "text-query-terms")

    vectors = terms.groupBy("q").agg(F.collect_list(F.struct("token", "qn")).alias("terms"))
    seeds = terms.where("seed is not null").groupBy("q").agg(F.max_by(F.struct("token", "seed"), "bound").alias("s")).select("q", "s.token", "s.seed.level", "s.seed.sub") \
        .join(idx.blocks.select("token", "level", "sub", "docs"), ["token", "level", "sub"]).select("q", F.explode(F.slice("docs", 1, max(SEED_TEXTS, k))).alias("d")).select("q", "d.did", "d.held")
    seeds = seeds.join(vectors, "q").join(idx.vectors, "did").select("q", "did", "held", F.round(_dot("terms", "weights"), SCORE_PLACES).alias("score"))
    filled = F.sum("held").over(Window.partitionBy("q").orderBy(F.desc("score"), "did"))
    bars = seeds.withColumn("filled", filled).where(F.col("filled") >= k).groupBy("q").agg(F.max("score").alias("bar"))

    upwards = Window.partitionBy("q").orderBy("bound", "token")
    ranked = terms.join(bars, "q", "left").withColumn("bar", F.coalesce("bar", F.lit(0.0)) - SLACK) \
        .withColumn("below", F.sum("bound").over(upwards.rowsBetween(Window.unboundedPreceding, 0))).withColumn("all", F.sum("bound").over(Window.partitionBy("q")))
    ranked = written(ranked.withColumn("telling", F.col("below") >= F.col("bar")).withColumn("need", (F.col("bar") - F.col("all") + F.col("bound")) / F.col("qn")).drop("seed"), "text-query-plan")
    finish = ranked.groupBy("q").agg(F.first("bar").alias("bar"), F.coalesce(F.sum(F.when(~F.col("telling"), F.col("bound"))), F.lit(0.0)).alias("rest"),
                                     F.filter(F.collect_list(F.when(~F.col("telling"), F.struct("token", "qn"))), lambda t: t.isNotNull()).alias("common"))
    opened = ranked.where("telling").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n_salt") - 1))) \
        .join(idx.blocks.join(F.broadcast(idx.tokens.where("n_salt > 1").select("token", F.col("n_salt").alias("keys"))), "token", "left")
              .withColumn("salt", F.pmod(F.xxhash64("level", "sub"), F.coalesce("keys", F.lit(1)))).select("token", "salt", "top", "docs"), ["token", "salt"]) \
        .where("top >= need").select("q", "qn", "need", F.explode("docs").alias("d")).where("d.impact >= need")
    partial = opened.groupBy("q", F.col("d.did").alias("did")).agg(F.sum(F.col("qn") * F.col("d.impact")).alias("partial"), F.first("d.held").alias("held"))
    scored = partial.join(finish, "q").where(F.col("partial") + F.col("rest") >= F.col("bar")).join(idx.vectors, "did") \
        .select("q", "did", "held", F.round(F.col("partial") + _dot("common", "weights"), SCORE_PLACES).alias("score"))
    return seeds, scored.where("score > 0")


@dataclass
class DescriptionIndex:
    """An index that takes changes: projects, the distinct texts they use, and their terms.

    entries: ProjectID, Domain, Project_Description; texts: did, Project_Description, users (projects that use it);
    terms: did, token, tf; tokens: token, df (texts that hold it); n: distinct texts.
    """

    entries: DataFrame
    texts: DataFrame
    terms: DataFrame
    tokens: DataFrame
    n: int

    @staticmethod
    def build(entries: DataFrame) -> "DescriptionIndex":
        spark = entries.sparkSession
        empty = DescriptionIndex(entries.limit(0), spark.createDataFrame([], "did string, Project_Description string, users long"),
                                 spark.createDataFrame([], "did string, token string, tf long"), spark.createDataFrame([], "token string, df long"), 0)
        return empty.updated(entries)

    def updated(self, changed: DataFrame, gone: DataFrame | None = None) -> "DescriptionIndex":
        """The index after projects were changed, added (``changed``: as entries) or removed (``gone``: ProjectID).

        Old entries of those projects are struck out; only texts that no project used before are read for
        tokens, and document frequencies change by the texts that came and went.
        """
        changed = written(changed.select(*self.entries.columns), "index-changed")
        ids = changed.select("ProjectID") if gone is None else changed.select("ProjectID").unionByName(gone.select("ProjectID")).distinct()
        struck = self.entries.join(ids, "ProjectID", "left_semi")
        use = lambda rows, sign: rows.where("Project_Description is not null").select(F.md5("Project_Description").alias("did"), "Project_Description", F.lit(sign).cast("long").alias("users"))
        counts = self.texts.withColumn("before", F.col("users")).unionByName(use(changed, 1).unionByName(use(struck, -1)).withColumn("before", F.lit(0).cast("long")))
        counts = written(counts.groupBy("did").agg(F.first("Project_Description").alias("Project_Description"), F.sum("users").alias("users"), F.sum("before").alias("before")), "index-texts")
        came, went = counts.where("before = 0 and users > 0"), counts.where("before > 0 and users = 0")
        fresh = written(text_terms(came, "Project_Description").select(F.md5("Project_Description").alias("did"), "token", "tf"), "index-terms")
        lost = self.terms.join(went.select("did"), "did", "left_semi")
        df = self.tokens.unionByName(fresh.groupBy("token").agg(F.count(F.lit(1)).alias("df"))).unionByName(lost.groupBy("token").agg((-F.count(F.lit(1))).alias("df")))
        tokens = written(df.groupBy("token").agg(F.sum("df").alias("df")).where("df > 0"), "index-tokens")
        texts = counts.where("users > 0").select("did", "Project_Description", "users")
        entries = written(self.entries.join(ids, "ProjectID", "left_anti").unionByName(changed), "index-entries")
        terms = written(self.terms.join(went.select("did"), "did", "left_anti").unionByName(fresh), "index-all-terms")
        return DescriptionIndex(entries, texts, terms, tokens, self.n + came.count() - went.count())

    def norms(self) -> DataFrame:
        """(did, n_terms, norm) of every text, as ``index_weights`` gives them."""
        idf = F.log((F.lit(1) + self.n) / (1 + F.col("df"))) + 1
        w = self.terms.join(self.tokens, "token").select("did", (F.col("tf") * idf).alias("w"))
        return w.groupBy("did").agg(F.count(F.lit(1)).alias("n_terms"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def top_k_by_text(queries: DataFrame, index: DataFrame, k: int = 50, within: str | None = None,
                  qid: str = "BriefID", qtext: str = "project_description") -> DataFrame:
    """V3/V4: the ``k`` projects whose descriptions are most similar to each query's text, exactly.

    Cosine of the token weights, rounded to six places, above zero; ties by the smaller
    ProjectID.  ``within`` keeps one domain's projects.  Distinct texts are compared, not
    rows; ``text_candidates`` tells which are scored at all.  Descriptions that can reach the
    best k are joined to at most k projects each, and queries with one text share the result.
    """
    # both are read several times
    index = written(index.select(*[c for c in ("ProjectID", "Domain", "Project_Description") if c in index.columns]), "text-index-projects")
    queries = written(queries.select(qid, qtext), "text-queries")
    kept = index if within is None else index.where(F.col("Domain") == within)
    _, scored = text_candidates(queries, text_index(index, k, within), k, qtext)
    first = kept.select("ProjectID", F.md5("Project_Description").alias("did")).where("did is not null") \
        .withColumn("nth", F.row_number().over(Window.partitionBy("did").orderBy("ProjectID"))).where(F.col("nth") <= k).drop("nth")
    # a description is of use while those of higher scores hold fewer than k projects
    upto = F.sum("held").over(Window.partitionBy("q").orderBy(F.desc("score")))
    alike = F.sum("held").over(Window.partitionBy("q", "score"))
    best = scored.withColumn("above", upto - alike).where(F.col("above") < k)
    hits = best.join(first, "did") \
        .withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "ProjectID")).cast("long")).where(F.col("rank") <= k)
    return queries.select(qid, F.md5(qtext).alias("q")).join(hits, "q").select(qid, "ProjectID", "score", "rank")


def _unit(M: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(M, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return M / n


def _top_rows(qids: np.ndarray, Q: np.ndarray, cids: np.ndarray, C: np.ndarray, k: int) -> pd.DataFrame:
    """Best ``k`` corpus rows of each query; QUERY_TILE_ROWS queries are multiplied at a time."""
    order = np.argsort(cids, kind="stable")  # among equal scores the smaller id comes first
    cids, C = cids[order], _unit(C[order])
    kk = min(k, len(cids))
    parts = []
    for at in range(0, len(qids), QUERY_TILE_ROWS if kk else 1 << 62):
        S = np.round(_unit(Q[at:at + QUERY_TILE_ROWS]) @ C.T, SCORE_PLACES)
        least = np.partition(S, len(cids) - kk, axis=1)[:, len(cids) - kk]
        r, c = np.nonzero(S >= least[:, None])
        by = np.lexsort((c, -S[r, c], r))
        r, c = r[by], c[by]
        rank = np.arange(len(r)) - np.searchsorted(r, r) + 1
        keep = rank <= kk
        parts.append(pd.DataFrame({"qid": qids[at + r[keep]], "cid": cids[c[keep]], "score": S[r[keep], c[keep]], "rank": rank[keep]}))
    return pd.concat(parts) if parts else pd.DataFrame({"qid": [], "cid": [], "score": [], "rank": []})


def top_k_similar(queries: DataFrame, corpus: DataFrame, k: int = 50, qid: str = "BriefID",
                  qvec: str = "qvec", cid: str = "ProjectID", cvec: str = "embedding",
                  n_queries: int | None = None, n_corpus: int | None = None) -> DataFrame:
    """V3: the ``k`` most cosine-similar corpus rows per query.

    Returns ``(qid, cid, score, rank)``; scores rounded to six places, ties
    broken by the smaller corpus id.  Block counts follow the row counts so a
    cogroup never holds more than ``QUERY_BLOCK_ROWS`` × ``CORPUS_BLOCK_ROWS``.
    ``n_queries`` / ``n_corpus`` may pass upper bounds of the row counts (for
    example a stored table's row count) to skip counting the inputs.
    """
    spark = queries.sparkSession
    n_q = queries.count() if n_queries is None else int(n_queries)
    n_c = corpus.count() if n_corpus is None else int(n_corpus)
    # the corpus is copied once per QUERY_BLOCK_ROWS queries, whatever the cluster's size; more cores cut the corpus
    nq = max(1, math.ceil(n_q / QUERY_BLOCK_ROWS))
    nc = max(1, math.ceil(n_c / CORPUS_BLOCK_ROWS), min(parallelism(spark), n_c // MIN_BLOCK_ROWS))
    q = (queries.select(F.col(qid).cast("long").alias("qid"), F.col(qvec).alias("vec"))
         .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq)).cast("int"))
         .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))))
    c = (corpus.select(F.col(cid).cast("long").alias("cid"), F.col(cvec).alias("vec"))
         .withColumn("cb", F.pmod(F.xxhash64("cid"), F.lit(nc)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)))))

    def block(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if qpdf.empty or cpdf.empty:
            return pd.DataFrame({"qid": [], "cid": [], "score": [], "rank": []})
        Q = np.stack(qpdf["vec"].to_numpy()).astype(np.float64)
        C = np.stack(cpdf["vec"].to_numpy()).astype(np.float64)
        return _top_rows(qpdf["qid"].to_numpy(), Q, cpdf["cid"].to_numpy(), C, k)

    ship_code()
    hits = (q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb"))
            .applyInPandas(block, "qid long, cid long, score double, rank long"))
    if nc > 1:
        w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid"))
        hits = hits.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    return hits.select(F.col("qid").alias(qid), F.col("cid").alias(cid), "score", "rank")


def similar_rows(similar: DataFrame, projects: DataFrame) -> DataFrame:
    """Project history rows of each brief's similar projects."""
    return similar.select("BriefID", "ProjectID").join(projects, "ProjectID")


def project_stacks(projects: DataFrame) -> DataFrame:
    """Member rows per (project, domain, stack): the history pre-aggregated to
    about one row per project, so per-brief token and domain counts join
    projects instead of member rows."""
    return (projects.groupBy("ProjectID", "Domain", "Tech_Stack_Used")
            .agg(F.count(F.lit(1)).alias("n")))


def similar_stacks(similar: DataFrame, projects: DataFrame) -> DataFrame:
    """The similar projects of each brief with their stacks and member counts."""
    return similar.select("BriefID", "ProjectID").join(project_stacks(projects), "ProjectID")


def _weight(rows: DataFrame):
    return F.col("n") if "n" in rows.columns else F.lit(1)


def tech_top_n(rows: DataFrame, n: int = 8, include_domain: bool = False) -> DataFrame:
    """Most frequent stack tokens (optionally plus the Domain) over the
    similar projects' member rows, top ``n`` per brief (ties: token).

    ``rows`` is either member rows or ``similar_stacks`` (weighted by ``n``)."""
    wt = _weight(rows)
    toks = rows.select("BriefID", F.explode(skill_tokens("Tech_Stack_Used")).alias("token"), wt.alias("w"))
    if include_domain:
        toks = toks.unionByName(rows.where(F.col("Domain").isNotNull())
                                .select("BriefID", F.col("Domain").alias("token"), wt.alias("w")))
    counts = toks.groupBy("BriefID", "token").agg(F.sum("w").cast("long").alias("cnt"))
    w = Window.partitionBy("BriefID").orderBy(F.col("cnt").desc(), F.col("token"))
    return counts.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def ranked_list(ranked: DataFrame, value: str = "token", out: str = "items") -> DataFrame:
    """Collect a per-brief top-n (bounded by n) into an ordered array."""
    return (ranked.groupBy("BriefID")
            .agg(F.array_sort(F.collect_list(F.struct("rank", value))).alias("_r"))
            .select("BriefID", F.transform("_r", lambda s: s[value]).alias(out)))


def modal_domain(rows: DataFrame) -> DataFrame:
    """Most frequent Domain over the similar projects' member rows (ties: name).

    ``rows`` is either member rows or ``similar_stacks`` (weighted by ``n``)."""
    counts = (rows.where(F.col("Domain").isNotNull()).groupBy("BriefID", "Domain")
              .agg(F.sum(_weight(rows)).alias("cnt")))
    w = Window.partitionBy("BriefID").orderBy(F.col("cnt").desc(), F.col("Domain"))
    return (counts.withColumn("rn", F.row_number().over(w)).where("rn = 1")
            .select("BriefID", F.col("Domain").alias("modal_domain")))


def brief_domain(briefs: DataFrame, rows: DataFrame, text: str = "project_description") -> DataFrame:
    """Keyword domain of the description, else the modal domain of similar projects."""
    return (briefs.select("BriefID", infer_domain(text).alias("kw_domain"))
            .join(modal_domain(rows), "BriefID", "left")
            .select("BriefID", F.coalesce("kw_domain", "modal_domain").alias("Domain")))


def base_fit(rows: DataFrame) -> DataFrame:
    """Member rows per person in the similar projects ÷ the brief's maximum."""
    counts = rows.groupBy("BriefID", "EmployeeID").agg(F.count(F.lit(1)).alias("n"))
    mx = Window.partitionBy("BriefID")
    return counts.select("BriefID", "EmployeeID",
                         (F.col("n") / F.max("n").over(mx)).alias("base_fit"))


def domain_roster(employees: DataFrame) -> DataFrame:
    """(Domain, EmployeeID, times, part): everyone of a domain and the part of its roster they are in, written once."""
    parts = max(1, math.ceil(employees.count() / ROSTER_ROWS))
    return written(employees.where(F.col("Domain_Expertise").isNotNull()).groupBy(F.col("Domain_Expertise").alias("Domain"), "EmployeeID").agg(F.count(F.lit(1)).alias("times"))
                   .withColumn("part", F.pmod(F.xxhash64("EmployeeID"), F.lit(parts)).cast("int")), "domain-roster")


def brief_domains(domains: DataFrame) -> DataFrame:
    """(BriefID, Domain, asked): the domains of a brief and how often each comes, written once."""
    return written(domains.where(F.col("Domain").isNotNull()).groupBy("BriefID", "Domain").agg(F.count(F.lit(1)).alias("asked")), "brief-domains")


def roster_hits(fit: DataFrame, asked: DataFrame, roster: DataFrame) -> DataFrame:
    """(BriefID, Domain, EmployeeID, part, copies): people with a base fit who are on the roster of the brief's domain, written once."""
    hits = fit.select("BriefID", "EmployeeID").distinct().join(asked, "BriefID").join(roster, ["Domain", "EmployeeID"])
    return written(hits.select("BriefID", "Domain", "EmployeeID", "part", (F.col("asked") * F.col("times")).alias("copies")), "roster-hits")


def boosted_fit(fit: DataFrame, hits: DataFrame, boost: float = 0.30) -> DataFrame:
    """BriefID, EmployeeID, fit of the people with a base fit: a row for each time they get the boost, one row without it."""
    copies = hits.groupBy("BriefID", "EmployeeID").agg(F.sum("copies").alias("copies"))
    total = F.coalesce("base_fit", F.lit(0.0)) + F.when(F.col("copies").isNotNull(), F.lit(float(boost))).otherwise(F.lit(0.0))
    return fit.join(copies, ["BriefID", "EmployeeID"], "left").select("BriefID", "EmployeeID", total.alias("fit"), F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce("copies", F.lit(1))))).drop("col")


def _one_by_one(values: str) -> Column:
    """``explode`` of an array column that hands on each row before it makes the next.  Generated code would hold all
    rows that come of one input row; a lambda keeps an operator out of it, at the price of one call an array."""
    return F.explode(F.filter(F.array(values), lambda v: v.isNotNull())[0])


def roster_fit(asked: DataFrame, hits: DataFrame, roster: DataFrame, boost: float = 0.30, told: DataFrame | None = None,
               salt_buckets: int | None = None) -> DataFrame:
    """BriefID, EmployeeID, fit of the people on the roster of the brief's domain who have no base fit: the boost alone.

    ``told`` (BriefID, ids: an array) names the briefs that a brief answers for, itself included; by default each answers for itself.

    The pairs are only formed in the tasks that return them.  What is shuffled are the briefs, as arrays with those people of each part
    of the roster that are left out, and the rosters, as arrays of a part.  Domain has a handful of values, so every value is
    a hot join key; briefs are salted and a domain's roster is replicated once per salt, so that a salt's pairs stay about CELL_PAIRS.
    """
    spark = asked.sparkSession
    known = hits.groupBy("BriefID", "Domain", "part").agg(F.collect_list("EmployeeID").alias("_e")) \
        .groupBy("BriefID", "Domain").agg(F.map_from_entries(F.collect_list(F.struct("part", "_e"))).alias("known"))
    if told is None:
        told = asked.select("BriefID").distinct().select("BriefID", F.array("BriefID").alias("ids"))
    told = told.withColumnRenamed("BriefID", "_id")
    briefs = asked.join(known, ["BriefID", "Domain"], "left")
    briefs = written(briefs.join(told, F.col("BriefID").eqNullSafe(F.col("_id"))).drop("_id"), "fit-briefs")
    sizes = briefs.groupBy("Domain").agg(F.sum(F.col("asked") * F.size("ids")).cast("double").alias("_b")).join(roster.groupBy("Domain").agg(F.sum("times").alias("_r")), "Domain")
    pairs = F.col("_b") * F.col("_r")
    most, every = (v or 0.0 for v in sizes.agg(F.max(pairs), F.sum(pairs)).first())
    cell = min(CELL_PAIRS, max(1 << 16, every / (8 * parallelism(spark))))
    n_salt = max(1, int(salt_buckets or math.ceil(most / cell)))
    tasks = max(parallelism(spark), math.ceil(2 * every / cell))  # a fixed number: what a task reads says nothing about the pairs it returns
    dealt = briefs.withColumn("salt", F.pmod(F.xxhash64("BriefID", F.col("ids")[0]), F.lit(n_salt)).cast("int")).repartition(tasks, "Domain", "salt")
    staff = F.sort_array(F.collect_list(F.struct("EmployeeID"))["EmployeeID"])  # keeps a null EmployeeID
    staff = roster.groupBy("Domain", "part", "times").agg(staff.alias("staff")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n_salt - 1)))).repartition(tasks, "Domain", "salt")
    left_out = F.try_element_at("known", F.col("part"))
    cells = dealt.hint("merge").join(staff.hint("merge"), ["Domain", "salt"]) \
        .select("ids", F.when(left_out.isNull(), F.col("staff")).otherwise(F.array_except("staff", left_out)).alias("staff"), F.sequence(F.lit(1).cast("long"), F.col("asked") * F.col("times")).alias("copies"))
    return cells.select("ids", "staff", _one_by_one("copies")).select(_one_by_one("ids").alias("BriefID"), "staff") \
        .select("BriefID", _one_by_one("staff").alias("EmployeeID"), F.lit(float(boost)).alias("fit"))


def project_fit(fit: DataFrame, domains: DataFrame, employees: DataFrame, boost: float = 0.30,
                salt_buckets: int | None = None) -> DataFrame:
    """Base fit plus ``boost`` for everyone whose expertise is the brief's domain.

    Sparse, like the reference's dict: only people with a base fit or the
    boost appear.
    """
    asked, roster = brief_domains(domains), domain_roster(employees)
    hits = roster_hits(fit, asked, roster)
    return boosted_fit(fit, hits, boost).unionByName(roster_fit(asked, hits, roster, boost, salt_buckets=salt_buckets))


def embed_text(docs: DataFrame, id_col: str, text_col: str, num_features: int = 1 << 12, sparse: bool = False) -> DataFrame:
    """V1: text → unit TF-IDF vector (tokenise, hash, IDF, L2 normalise) as ``array<double>``, or
    (``sparse``) as a struct of ``indices`` and ``values``: its tokens' places alone, not all ``num_features``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=r"\W+", toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0),
    ])
    src = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    model = pipe.fit(src)
    unit = model.transform(src)
    if sparse:
        return unit.select(id_col, F.unwrap_udt("_unit").alias("_v")).select(id_col, F.struct("_v.indices", "_v.values").alias("embedding"))
    return unit.select(id_col, vector_to_array("_unit").alias("embedding"))


CODE_BITS = 512
CODE_SHARE = 0.2      # of a block's vectors that are compared in full


def _codes(M: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """On which side of ``bits`` random planes each row lies, packed into bytes."""
    planes = np.random.default_rng(seed).normal(size=(M.shape[1], bits))
    return np.packbits(M @ planes > 0, axis=1)


def similar_by_codes(queries: DataFrame, corpus: DataFrame, k: int = 50, share: float = CODE_SHARE, bits: int = CODE_BITS,
                     seed: int = 42, qid: str = "BriefID", qvec: str = "qvec", cid: str = "ProjectID", cvec: str = "embedding") -> DataFrame:
    """V5: approximate neighbours by random-projection codes, nearest codes first until enough rows are found.

    Every vector gets a code once: the sides of ``bits`` random planes it lies on; the share of bits in which two
    codes differ estimates their angle.  In each block of the corpus a query opens the vectors in
    growing distance of the codes, ring after ring, until it has ``share`` of the block and at least ``k`` (all of a
    smaller block), and compares only those in full.  So a query always gets ``k`` rows if the corpus has them, no
    block is larger for being crowded, and the result is exact for share 1.  Codes pay where vectors are longer
    than bits / 64 numbers; for short ones the exact product of V3 is as quick.
    """
    spark = queries.sparkSession
    nq = max(1, math.ceil(queries.count() / QUERY_BLOCK_ROWS))
    n_c = corpus.count()
    nc = max(1, math.ceil(n_c / CORPUS_BLOCK_ROWS), min(parallelism(spark), n_c // MIN_BLOCK_ROWS))

    def coded(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(code=[c.tobytes() for c in _codes(_unit(np.stack(pdf["vec"].to_numpy()).astype(np.float64)), bits, seed)])

    ship_code()
    side = lambda rows, id_, vec, own, n, other, m: rows.select(F.col(id_).cast("long").alias("id"), F.col(vec).alias("vec")) \
        .mapInPandas(coded, "id long, vec array<float>, code binary") \
        .withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    q, c = side(queries, qid, qvec, "qb", nq, "cb", nc), side(corpus, cid, cvec, "cb", nc, "qb", nq)

    def block(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"qid": [], "cid": [], "score": [], "rank": []})]
        if qpdf.empty or cpdf.empty:
            return out[0]
        cpdf = cpdf.sort_values("id")  # among equal scores the smaller id comes first
        cids, C = cpdf["id"].to_numpy(), _unit(np.stack(cpdf["vec"].to_numpy()).astype(np.float64))
        codes = np.frombuffer(b"".join(cpdf["code"]), np.uint64).reshape(len(cids), -1)
        opened = min(len(cids), max(k, math.ceil(share * len(cids))))
        qids, Q = qpdf["id"].to_numpy(), _unit(np.stack(qpdf["vec"].to_numpy()).astype(np.float64))
        asked = np.frombuffer(b"".join(qpdf["code"]), np.uint64).reshape(len(qids), -1)
        for i in range(len(qids)):
            far = np.bitwise_count(codes ^ asked[i]).sum(1, dtype=np.int64)
            ring = np.partition(far, opened - 1)[opened - 1]
            near = np.flatnonzero(far < ring)
            near = np.sort(np.concatenate([near, np.flatnonzero(far == ring)[:opened - len(near)]]))
            score = np.round(C[near] @ Q[i], SCORE_PLACES)
            best = np.argsort(-score, kind="stable")[:k]
            out.append(pd.DataFrame({"qid": qids[i], "cid": cids[near[best]], "score": score[best], "rank": np.arange(1, len(best) + 1)}))
        return pd.concat(out)

    hits = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(block, "qid long, cid long, score double, rank long")
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("cid"))
    hits = hits.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
    return hits.select(F.col("qid").alias(qid), F.col("cid").alias(cid), "score", "rank")
