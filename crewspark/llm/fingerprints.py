"""Document fingerprints: a Merkle tree over the phrases, paragraphs and sections of a text.

DataFrame functions only.  A paragraph is a line.  A phrase is up to three words of it, ending
early after '.', '!' or '?'.  A section is a run of paragraphs that ends after one whose digest begins
with 0 to 3, so an inserted paragraph moves no border but its own.  Digests are SHA-256: of a
phrase's text, and of the digests below for paragraphs, sections and the root.

A fingerprint is the whole tree as one string, with digests shortened below the root:

    root/SECTION:PARAGRAPH.PHRASE.PHRASE,PARAGRAPH.PHRASE/SECTION:...

Equal roots are equal texts; unequal branches say where two texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

WORDS = 3
#: Phrases of a line: together they are the line.  Nothing in it can match in two ways, so it is read once.
PHRASE = r"[ \t]*+(?:[^ \t.!?]{1,64}+[ \t]++){0,%d}+[^ \t.!?]{0,64}+[.!?]*+[ \t]*+" % (WORDS - 1)
#: Characters kept of a section's, a paragraph's and a phrase's digest.
SECTION_CHARS, PARAGRAPH_CHARS, PHRASE_CHARS = 16, 8, 6
MAX_BUCKETS = 1 << 16
COARSE = 64


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty, an empty text is one paragraph without phrases."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    phrases = lambda line: F.transform(F.filter(F.regexp_extract_all(line, F.lit(PHRASE), F.lit(0)), lambda p: p != ""), lambda p: F.sha2(p, 256))
    # of each paragraph its digest and what is shown of it; a section's last one is marked
    shown = lambda made: F.concat(F.substring(made["digest"], 1, PARAGRAPH_CHARS), F.array_join(F.transform(made["phrases"], lambda p: F.concat(F.lit("."), F.substring(p, 1, PHRASE_CHARS))), ""))
    paragraphs = F.transform(F.transform(lines, phrases), lambda ps: F.struct(F.sha2(F.array_join(ps, ""), 256).alias("digest"), ps.alias("phrases")))
    entry = lambda made: F.concat(made["digest"], F.lit(" "), shown(made), F.when(F.substring(made["digest"], 1, 1) < "4", "/").otherwise(","))
    runs = F.split(F.regexp_replace(F.array_join(F.transform(paragraphs, entry), ""), "[/,]$", ""), "/")
    # a run of "digest shown" entries -> "digest of the section shown"
    section = lambda run: F.concat(F.sha2(F.regexp_replace(run, "[ ][^,]*,?", ""), 256), F.lit(":"), F.regexp_replace(run, "[0-9a-f]{64} ", ""))
    sections = F.transform(runs, section)
    root = F.sha2(F.array_join(F.transform(sections, lambda s: F.substring(s, 1, 64)), ""), 256)
    return F.concat(root, F.lit("/"), F.array_join(F.transform(sections, lambda s: F.concat(F.substring(s, 1, SECTION_CHARS), F.substring(s, 65, 1 << 30))), "/"))


def phrases_of(fingerprint: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit(r"\.([0-9a-f]+)"), F.lit(1)))


def root_of(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def likeness(a: str, b: str) -> Column:
    """1 for equal roots, else twice the distinct phrases in common over the distinct phrases of both (0 if neither has any).

    ``a`` and ``b`` name columns of fingerprints.
    """
    one, two = phrases_of(F.col(a)), phrases_of(F.col(b))
    both = F.size(F.array_intersect(one, two)) * 2.0
    return F.when(root_of(F.col(a)) == root_of(F.col(b)), 1.0).otherwise(F.coalesce(both / F.nullif(F.size(one) + F.size(two), F.lit(0)), F.lit(0.0)))


def first_difference(a: str, b: str) -> Column:
    """Where two fingerprints first differ, from the root down: (section, paragraph in it, phrase in it), from 0.

    Null where the roots are equal.  Only the first section whose digests differ is opened, and in
    it the first paragraph.  A place past the end of one text is where the longer one goes on.
    """
    def first(x: Column, y: Column) -> Column:
        """Place of the first unequal element of two arrays of branches."""
        return (F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.lit(False)) - 1).cast("int")

    def branches(fp: str) -> Column:
        return F.slice(F.split(F.col(fp), "/"), 2, 1 << 30)

    def at(array: Column, place: Column) -> Column:
        return F.coalesce(F.get(array, place), F.lit(""))

    section = first(branches(a), branches(b))
    paragraphs = lambda fp: F.split(F.regexp_replace(at(branches(fp), section), "^[^:]*:", ""), ",")
    paragraph = first(paragraphs(a), paragraphs(b))
    phrases = lambda fp: F.slice(F.split(at(paragraphs(fp), paragraph), "[.]"), 2, 1 << 30)
    phrase = first(phrases(a), phrases(b))
    return F.when(root_of(F.col(a)) != root_of(F.col(b)), F.struct(section.alias("section"), paragraph.alias("paragraph"), phrase.alias("phrase")))


def bucket_bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Ascending ids that cut the rows into about equal buckets, from a quantile sketch of all ids."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = docs.select(F.percentile_approx("doc_id", shares, max(10_000, 8 * buckets))).head()[0]
    return sorted(set(found or []))


def bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the bounds are at or below the id: first among every COARSE-th, then between two of those."""
    if not bounds:
        return F.lit(0)
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    below = lambda xs: F.size(F.filter(xs, lambda b: b <= doc_id))
    group = F.lit(0) if len(bounds) <= COARSE else below(longs(bounds[COARSE::COARSE]))
    return (group * COARSE + below(F.slice(longs(bounds), group * COARSE + 1, COARSE))).cast("int")


def with_next(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``docs`` (doc_id, text) with next_text and next_print, the text and fingerprint of the next document by doc_id, and its own print.

    After the last comes the first.  Rows that repeat a doc_id follow one another in the order of their
    texts.  A row without a doc_id is followed by itself, as the only row of a table is.

    Rows are dealt into ranges of doc_id of about equal size, one shuffle of the texts.  Each range
    also gets a copy of the first row of the range that follows, so no row looks beyond its own.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    buckets = buckets or min(MAX_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = bucket_bounds(docs, buckets)
    # rows without an id are spread over buckets of their own
    alone = -1 - F.pmod(F.xxhash64("text"), F.lit(buckets)).cast("int")
    dealt = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), alone).otherwise(bucket_of(F.col("doc_id"), bounds)))
    # at most a row a bucket
    opens = sorted(tuple(r) for r in dealt.where("doc_id is not null").groupBy("bucket").agg(F.min("doc_id").alias("first")).collect())
    before = [(first, opens[i - 1][0]) for i, (_, first) in enumerate(opens)]
    copies = spark.createDataFrame(before, "doc_id long, bucket int")
    firsts = docs.join(F.broadcast(copies), "doc_id").groupBy("doc_id", "bucket").agg(F.min("text").alias("text"))
    rows = dealt.withColumn("copy", F.lit(False)).unionByName(firsts.withColumn("copy", F.lit(True)))
    order = Window.partitionBy("bucket").orderBy("copy", "doc_id", "text")
    own = F.col("doc_id").isNull()
    rows = rows.withColumn("print", fingerprint(F.col("text")))
    return rows.withColumn("next_text", F.when(own, F.col("text")).otherwise(F.lead("text").over(order))) \
        .withColumn("next_print", F.when(own, F.col("print")).otherwise(F.lead("print").over(order))).where("not copy").drop("copy", "bucket")


def fingerprints(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edit), a row for every row of ``docs``.

    ``docs``: doc_id, text; other columns are ignored.  The edited text has its last floor(n_chars / 4)
    code points replaced by the first as many (or all) of the next document (see ``with_next``).
    ``edit`` is where its tree first differs.  Null texts count as empty, texts are read whole, and an
    empty table gives an empty result.
    """
    rows = with_next(spark, docs, buckets)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 4) as int)), substring(next_text, 1, cast(floor(length(text) / 4) as int)))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), F.col("print").alias("fingerprint"), fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_print")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                       likeness("fingerprint", "next_print").alias("near_next"), first_difference("fingerprint", "edited_fingerprint").alias("edit"))


def op11_merkle_fingerprints(spark, sf_dir):
    """Fingerprints of every document and of its edited text, and how like they and the next document's are.

    See ``fingerprints`` for nulls, repeats and empty tables.  first_edit: section, paragraph and phrase.
    """
    out = fingerprints(spark, table(spark, sf_dir, "documents"))
    place = F.concat_ws(".", "edit.section", "edit.paragraph", "edit.phrase")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", F.when(F.col("edit").isNotNull(), place).alias("first_edit"))


#: The same trees over unnested lines; greedy forms of the phrase pattern match the same.
ORACLE_11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
x AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id, text), first_value(text) OVER (ORDER BY doc_id, text)) AS next_text FROM d),
e AS (SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM x),
t AS (SELECT text FROM e UNION SELECT edited FROM e),
l AS (SELECT text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM t),
p AS (SELECT text, i, [sha256(x) for x in regexp_extract_all(line, '[ \t]*(?:[^ \t.!?]{1,64}[ \t]+){0,2}[^ \t.!?]{0,64}[.!?]*[ \t]*') if x <> ''] AS phrases FROM l),
g AS (SELECT *, sha256(array_to_string(phrases, '')) AS digest, left(sha256(array_to_string(phrases, '')), 8) || array_to_string(['.' || left(x, 6) for x in phrases], '') AS shown FROM p),
r AS (SELECT *, coalesce(sum((digest < '4')::INT) OVER (PARTITION BY text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM g),
s AS (SELECT text, run, sha256(string_agg(digest, '' ORDER BY i)) AS digest, string_agg(shown, ',' ORDER BY i) AS shown FROM r GROUP BY ALL),
f AS (SELECT text, sha256(string_agg(digest, '' ORDER BY run)) || '/' || string_agg(left(digest, 16) || ':' || shown, '/' ORDER BY run) AS print FROM s GROUP BY ALL),
q AS (
  SELECT e.doc_id, e.text, e.edited, a.print AS a, b.print AS b, c.print AS c, list_distinct(regexp_extract_all(a.print, '\.([0-9a-f]+)', 1)) AS pa,
    list_distinct(regexp_extract_all(b.print, '\.([0-9a-f]+)', 1)) AS pb, list_distinct(regexp_extract_all(c.print, '\.([0-9a-f]+)', 1)) AS pc
  FROM e JOIN f a ON a.text = e.text JOIN f b ON b.text = e.edited JOIN f c ON c.text = e.next_text
), k AS (
  SELECT *, (SELECT min(j) FROM range(1, 1 + greatest(len(string_split(a, '/')), len(string_split(b, '/')))) w(j) WHERE j > 1 AND string_split(a, '/')[j] IS DISTINCT FROM string_split(b, '/')[j]) AS sec FROM q
), k2 AS (
  SELECT *, string_split(regexp_replace(coalesce(string_split(a, '/')[sec], ''), '^[^:]*:', ''), ',') AS sa, string_split(regexp_replace(coalesce(string_split(b, '/')[sec], ''), '^[^:]*:', ''), ',') AS sb FROM k
), k3 AS (
  SELECT *, (SELECT min(j) FROM range(1, 1 + greatest(len(sa), len(sb))) w(j) WHERE sa[j] IS DISTINCT FROM sb[j]) AS par FROM k2
), k4 AS (SELECT *, string_split(coalesce(sa[par], ''), '.')[2:] AS fa, string_split(coalesce(sb[par], ''), '.')[2:] AS fb FROM k3),
k5 AS (SELECT *, (SELECT min(j) FROM range(1, 1 + greatest(len(fa), len(fb))) w(j) WHERE fa[j] IS DISTINCT FROM fb[j]) AS phr FROM k4)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, a AS fingerprint, b AS edited_fingerprint,
  CASE WHEN left(a, 64) = left(b, 64) THEN 1.0::DOUBLE WHEN len(pa) + len(pb) = 0 THEN 0.0 ELSE len(list_intersect(pa, pb)) * 2.0::DOUBLE / (len(pa) + len(pb)) END AS near_edited,
  CASE WHEN left(a, 64) = left(c, 64) THEN 1.0::DOUBLE WHEN len(pa) + len(pc) = 0 THEN 0.0 ELSE len(list_intersect(pa, pc)) * 2.0::DOUBLE / (len(pa) + len(pc)) END AS near_next,
  CASE WHEN left(a, 64) <> left(b, 64) THEN concat_ws('.', sec - 2, par - 1, phr - 1) END AS first_edit
FROM k5
"""

QUERIES = {"op11_merkle_fingerprints": op11_merkle_fingerprints}
ORACLES = {"op11_merkle_fingerprints": ORACLE_11}
