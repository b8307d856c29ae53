"""Text → skills, domain and budget, as Spark column expressions and joins.

X1 tokens, X2 canonical normalisation, X3 phrase skills, X4 domain keywords,
X5 known/unknown split, X6 budget regex, X7 reply parsing, X9 holder test,
A16 canonical vocabulary.  Everything stays JVM-side: no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values (the reference's phrase and keyword tables, in its order) ---
GENERIC_SKILL_MAP = [
    ("web development", ["React", "Python", "SQL", "AWS"]),
    ("website", ["React", "Python", "SQL", "AWS"]),
    ("frontend", ["React"]),
    ("backend", ["Python", "SQL"]),
    ("api", ["Python", "SQL"]),
    ("dashboard", ["Python", "SQL"]),
    ("data streaming", ["Spark", "Delta Lake", "Airflow", "AWS"]),
    ("streaming", ["Spark", "Delta Lake", "Airflow", "AWS"]),
    ("cloud", ["AWS"]),
    ("analytics", ["SQL", "Python"]),
    ("machine learning", ["Python", "TensorFlow", "PyTorch"]),
    ("healthcare", ["Python", "SQL", "AWS"]),
    ("finance", ["Python", "SQL", "AWS"]),
    ("retail", ["Python", "SQL", "AWS"]),
    ("edtech", ["Python", "SQL", "AWS"]),
    ("media", ["Python", "SQL", "AWS"]),
    ("govtech", ["Python", "SQL", "AWS"]),
]

DOMAIN_KEYWORDS = [
    ("Healthcare", ["health", "clinic", "patient", "medical", "ehr", "hipaa", "doctor", "hospital"]),
    ("Finance", ["finance", "bank", "trading", "payment", "fintech", "investment", "credit", "risk"]),
    ("Retail", ["retail", "ecommerce", "shop", "store", "inventory", "catalog", "pos"]),
    ("EdTech", ["education", "student", "learning", "school", "course", "lms"]),
    ("Media", ["media", "content", "stream", "video", "audio", "news", "advert"]),
    ("GovTech", ["government", "public", "civic", "policy", "permit", "municipal", "ministry", "gov"]),
]

BUDGET_PATTERN = r"(\$|usd\s*)?(\d{2,6})(?:\s*/?\s*hour)?"
# --- end of fixed values ---


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skill_tokens(c: Column | str) -> Column:
    """``"a, b,,c "`` → ``[a, b, c]`` (split on commas, trim, drop empties)."""
    parts = F.transform(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda t: F.trim(t))
    return F.filter(parts, lambda t: t != "")


def canonical_skills(employees: DataFrame) -> DataFrame:
    """The distinct trimmed skill tokens of the workforce, one row each (column ``Skill``)."""
    return (employees
            .select(F.explode(skill_tokens("Skills")).alias("Skill"))
            .distinct())


def canonical_keys(canonical: DataFrame) -> DataFrame:
    """Lower-case lookup keys of the canonical list, as the reference's dict builds them.

    For each lower-case key: ``value`` is the last canonical spelling in sorted
    order (later dict writes win) and ``ord`` the first, which fixes the key's
    place in the containment scan.
    """
    return (canonical
            .groupBy(F.lower("Skill").alias("key"))
            .agg(F.max("Skill").alias("value"), F.min("Skill").alias("ord")))


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct stretches of ``size`` characters of a text; one pass over it."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def contained(texts: DataFrame, text: str, needles: DataFrame, needle: str) -> DataFrame:
    """Pairs (``text``, ``needle``) where the needle is a substring of the text; both sides should be distinct.

    An index by stretches of GRAM characters: a text has one row for each of its different stretches, a
    needle is looked up by the one of its own that fewest texts have, and the pairs that share it are
    verified.  A needle of up to GRAM characters is a stretch itself (shorter stretches are
    indexed only if there are such needles).  Null texts, null needles and empty needles pair with nothing.
    """
    asked = needles.select(needle).where(F.length(needle) > 0)
    shortest = asked.agg(F.min(F.length(needle))).scalar()
    none = F.array().cast("array<string>")
    every = F.concat(*[_grams(F.col(text), GRAM)], *[F.when(shortest <= size, _grams(F.col(text), size)).otherwise(none) for size in range(1, GRAM)])
    rows = texts.select(text).where(F.col(text).isNotNull())
    long = asked.where(F.length(needle) > GRAM).select(needle, F.explode(_grams(F.col(needle), GRAM)).alias("_gram"))
    held = rows.select(F.explode(_grams(F.col(text), GRAM)).alias("_gram")).join(long.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    rarest = long.join(held, "_gram", "left").groupBy(needle).agg(F.min_by("_gram", F.struct(F.coalesce("_texts", F.lit(0)), "_gram")).alias("_gram"))
    keys = rarest.unionByName(asked.where(F.length(needle) <= GRAM).select(needle, F.col(needle).alias("_gram")))
    found = rows.select(text, F.explode(every).alias("_gram")).join(keys, "_gram")
    return found.where((F.length(needle) <= GRAM) | F.contains(F.col(text), F.col(needle))).select(text, needle)


def normalize_skills(items: DataFrame, canonical: DataFrame, key: str = "BriefID",
                     col: str = "items", out: str = "skills") -> DataFrame:
    """Map each item to a canonical skill; keep first occurrences in order.

    Exact lower-case match wins; otherwise the first key (in canonical order)
    that contains the item or is contained in it.  Items without a match drop.
    Returns ``(key, out array<string>)`` for every input row (empty when none match).
    """
    keys = canonical_keys(canonical)
    toks = (items.select(key, F.posexplode(col).alias("pos", "item"))
            .withColumn("low", F.lower(F.trim("item")))
            .where(F.col("low") != ""))
    # each distinct item is matched once: by equality, the rest by containment either way
    asked = toks.select("low").distinct()
    exact = asked.join(keys, F.col("low") == F.col("key")).select("low", "value")
    rest = asked.join(keys.select(F.col("key").alias("low")), "low", "left_anti")
    near = contained(rest, "low", keys.select("key"), "key").unionByName(
        contained(keys.select("key"), "key", rest, "low").select("low", "key"))
    first = near.join(keys, "key").groupBy("low").agg(F.min(F.struct("ord", "value"))["value"].alias("value"))
    matched = (toks.join(exact.unionByName(first), "low")
               .groupBy(key)
               .agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("pv")))
    return (items.select(key).distinct()
            .join(matched, key, "left")
            .select(key, F.coalesce(F.array_distinct(F.transform("pv", lambda s: s["value"])),
                                    F.array().cast("array<string>")).alias(out)))


def phrase_skills(text: Column | str) -> Column:
    """Skills of every phrase found in the text, in table order, first occurrences kept."""
    lt = F.lower(F.coalesce(_col(text), F.lit("")))
    empty = F.array().cast("array<string>")
    parts = [F.when(F.instr(lt, p) > 0, F.array(*[F.lit(s) for s in skills])).otherwise(empty)
             for p, skills in GENERIC_SKILL_MAP]
    return F.array_distinct(F.flatten(F.array(*parts)))


def infer_domain(text: Column | str) -> Column:
    """The first domain (table order) with any keyword as a substring; null if none."""
    lt = F.lower(F.coalesce(_col(text), F.lit("")))
    out = None
    for dom, kws in DOMAIN_KEYWORDS:
        cond = None
        for k in kws:
            c = F.instr(lt, k) > 0
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(dom)) if out is None else out.when(cond, F.lit(dom))
    return out


def budget_from_text(text: Column | str) -> Column:
    """The first 2–6 digit number (optionally after ``$``/``usd``) as a double; null if none."""
    m = F.regexp_extract(F.lower(F.coalesce(_col(text), F.lit(""))), BUDGET_PATTERN, 2)
    return F.when(m != "", m.cast("double"))


# A JSON string (kept), or a code fence, a line comment or a block comment (dropped).
REPLY_NOISE = r'("[^"\\]*(?:\\.[^"\\]*)*")|```[A-Za-z]*|//[^\n]*|(?s:/\*.*?\*/)'


def clean_reply(reply: Column | str) -> Column:
    """The reply's object, from its first ``{`` to its last ``}``, without code fences and
    ``//`` or ``/* */`` comments outside of strings; empty if it holds none."""
    s = F.regexp_extract(F.coalesce(_col(reply), F.lit("")), r"(?s)\{.*\}", 0)
    return F.trim(F.regexp_replace(s, REPLY_NOISE, "$1"))


def parse_reply(df: DataFrame, reply: str = "Reply", text: str = "BriefText") -> DataFrame:
    """Reply JSON → ``required_skills``, ``max_budget_per_hour``, ``project_description``.

    A reply without a JSON object falls back to: no skills, the budget regex on
    the brief text (0 if none), the brief text as description.  A single skill
    given as a string becomes a one-element list; a missing or non-numeric
    budget becomes 0.  The cleaned text and the raw fields are computed once
    (separate projections), not once per branch.
    """
    cols = df.columns
    step = df.select("*", clean_reply(reply).alias("_s"))
    step = step.select(*cols, "_s",
                       F.get_json_object("_s", "$").isNotNull().alias("_ok"),
                       F.trim(F.get_json_object("_s", "$.required_skills")).alias("_sk"),
                       F.get_json_object("_s", "$.max_budget_per_hour").alias("_bud"),
                       F.get_json_object("_s", "$.project_description").alias("_desc"))
    empty = F.array().cast("array<string>")
    sk = F.col("_sk")
    req = (F.when(sk.isNull() | (sk == "") | (sk == "[]"), empty)
           .when(sk.startswith("["), F.from_json(sk, "array<string>"))
           .otherwise(F.array(sk)))
    bud = F.coalesce(F.col("_bud").try_cast("double"), F.lit(0.0))
    desc = F.when(F.col("_desc").isNull() | (F.col("_desc") == ""), F.col(text)).otherwise(F.col("_desc"))
    ok = F.col("_ok")
    return step.select(
        *cols,
        F.when(ok, req).otherwise(empty).alias("required_skills"),
        F.when(ok, bud).otherwise(F.coalesce(budget_from_text(F.col(text)), F.lit(0.0))).alias("max_budget_per_hour"),
        F.when(ok, desc).otherwise(F.col(text)).alias("project_description"),
        ok.alias("reply_parsed"),
    )


def split_known_skills(df: DataFrame, canonical: DataFrame, key: str = "BriefID",
                       col: str = "required_skills") -> DataFrame:
    """Requested skills whose trimmed lower form is a canonical key (``explicit``)
    and the non-empty rest (``missing``), each in request order."""
    keys = canonical_keys(canonical).select("key")
    ex = (df.select(key, F.posexplode(col).alias("pos", "item"))
          .withColumn("low", F.lower(F.trim("item")))
          .join(keys.withColumn("known", F.lit(True)), F.col("low") == F.col("key"), "left"))
    agg = (ex.groupBy(key)
           .agg(F.array_sort(F.collect_list(F.struct("pos", "item", F.coalesce("known", F.lit(False)).alias("k"),
                                                    (F.trim("item") != "").alias("nonempty")))).alias("xs")))
    explicit = F.transform(F.filter("xs", lambda x: x["k"]), lambda x: x["item"])
    missing = F.transform(F.filter("xs", lambda x: (~x["k"]) & x["nonempty"]), lambda x: x["item"])
    empty = F.array().cast("array<string>")
    return (df.select(key).distinct().join(agg, key, "left")
            .select(key, F.coalesce(explicit, empty).alias("explicit_skills"),
                    F.coalesce(missing, empty).alias("missing_skills")))


def holds_skill(skills_text: Column | str, skill: Column | str) -> Column:
    """A person holds a skill when its trimmed lower form is a substring of their skills text."""
    return F.instr(F.lower(F.coalesce(_col(skills_text), F.lit(""))), F.lower(F.trim(_col(skill)))) > 0


def clean_skill_list(c: Column | str) -> Column:
    """Trim + lower each requested skill and drop empties."""
    return F.filter(F.transform(_col(c), lambda s: F.lower(F.trim(s))), lambda s: s != "")
