"""Merkle manifest of a dataset: a leaf a row, trees of fanout 8 per group, and a root over the groups.

Slot pivot: a node's place among its siblings is its slot; conditional aggregates spread the
children of one parent into as many columns as the fanout.  All columns concatenated and
hashed are the parent; all but a child's own column are its siblings.  The trees are built
upwards a level at a time and every proof is put together downwards, so a level's paths are
made once for each inner node and joined to the rows only at the bottom.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage, table

FANOUT = 8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as '-' if null, else its UTF-8 byte count, ':' and itself: no two lists of values look alike."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with pos, the place of each within its key in ascending order (nulls first), and n, the key's rows.

    One range shuffle over (key, order), written; a row's place is its place among its key's
    rows in its own partition plus those of the partitions before.  A hot key is as many
    partitions as its size asks for.
    """
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    ranged = stage(rows.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), name)
    sizes = ranged.groupBy(key, "part").agg(F.count(F.lit(1)).alias("here"))
    parts = Window.partitionBy(key)
    sizes = sizes.select(key, "part", F.sum("here").over(parts).alias("n"), (F.sum("here").over(parts.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("here")).alias("before"))
    inside = F.row_number().over(Window.partitionBy(key, "part").orderBy(*by[1:]))
    return ranged.withColumn("inside", inside).join(sizes, [key, "part"]).withColumn("pos", F.col("before") + F.col("inside") - 1).drop("part", "before", "inside")


def pivoted(nodes: DataFrame, payload: list[str], name: str) -> DataFrame:
    """Runs of FANOUT nodes (key, pos, n, digest, payload) as one row each: key, parent, n, s0 to s7 (null: no such child)."""
    slot = F.pmod("pos", F.lit(FANOUT))
    child = F.struct("digest", *payload)
    runs = nodes.groupBy("key", F.floor(F.col("pos") / FANOUT).alias("parent"), "n").agg(*[F.max(F.when(slot == j, child)).alias(f"s{j}") for j in range(FANOUT)])
    return stage(runs, name)


def parents(runs: DataFrame) -> DataFrame:
    """The node above each run."""
    whole = F.concat_ws("", *[F.col(f"s{j}.digest") for j in range(FANOUT)])
    return runs.select("key", F.col("parent").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"), F.sha2(whole, 256).alias("digest"))


def grown(nodes: DataFrame, payload: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels of runs from the bottom up, roots (key, digest)) of the trees over the nodes (key, pos, n, digest, payload)."""
    levels, roots = [], nodes.where("n = 1").select("key", "digest")
    more = nodes.where("n > 1")
    while not more.isEmpty():
        runs = pivoted(more, payload, name)
        levels.append(runs)
        above, payload = parents(runs), []
        roots = roots.unionByName(above.where("n = 1").select("key", "digest"))
        more = above.where("n > 1")
    return levels, roots


def children(runs: DataFrame, tops: DataFrame, above: DataFrame | None, carried: list[str]) -> DataFrame:
    """Every node of the runs with its path to the root: own siblings, then its parent's path.

    ``tops`` (key, path, carried) has the paths of the trees' roots, ``above`` (key, pos, path, carried)
    those of the nodes of the level above the runs.
    """
    known = runs.where(F.col("n") <= FANOUT).join(tops, "key")
    if above is not None:
        known = known.unionByName(runs.where(F.col("n") > FANOUT).join(above.withColumnRenamed("pos", "parent"), ["key", "parent"]))
    cols = [F.col(f"s{j}.digest") for j in range(FANOUT)]
    each = [F.when(F.col(f"s{j}").isNotNull(), F.struct(F.lit(j).alias("slot"), F.col(f"s{j}").alias("child"), F.struct(F.concat_ws("", *cols[:j]).alias("left"), F.concat_ws("", *cols[j + 1:]).alias("right")).alias("own"))) for j in range(FANOUT)]
    spread = known.select("key", "parent", "path", *carried, F.explode(F.array_compact(F.array(*each))).alias("c"))
    return spread.select("key", (F.col("parent") * FANOUT + F.col("c.slot")).alias("pos"), F.col("c.child").alias("child"), F.concat(F.array("c.own"), F.col("path")).alias("path"), *carried)


def with_paths(levels: list[DataFrame], tops: DataFrame, carried: list[str], name: str) -> DataFrame | None:
    """Nodes of the lowest level (key, pos, child, path, carried); None if no tree has more than one node."""
    above = None
    for i, runs in reversed(list(enumerate(levels))):
        above = children(runs, tops, above, carried)
        if i:
            above = stage(above.drop("child"), name)
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings, level by level, give."""
    return F.aggregate(path, start, lambda node, step: digest(step["left"], node, step["right"]))


def manifest(rows: DataFrame, key: Column, doc_id: str, leaf: Column, claimed: Column) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), a row for every row of ``rows``.

    ``key`` (string) groups the rows into trees, ``leaf`` is each row's digest and ``claimed`` the digest
    that is checked against the manifest.  Leaves of a group ascend by doc_id (nulls first, ties by
    leaf); runs of FANOUT become their H until one node, the subroot, is left; the
    subroots, ordered by key (null first, UTF-8 bytewise), give the root in the same way.
    proof_sha256 is the H of all siblings from the leaf's level to the root's, folded_root the
    root recomputed from ``claimed`` and them.  Nulls in any column are values of their own,
    repeated rows are leaves of their own, other columns are ignored, an empty table gives
    an empty result.  No group, and no list of subroots, meets in one task.
    """
    leaves = stage(rows.select(key.alias("named"), field(key).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), leaf.alias("digest"), claimed.alias("claimed")), "manifest-leaves")
    placed = stage(numbered(leaves.select("key", "doc_id", "digest", "claimed"), "key", ["doc_id", "digest"], "manifest-ranges"), "manifest-places")
    levels, roots = grown(placed, ["doc_id", "claimed"], "manifest-runs")
    # the groups' own names: their bytewise order isn't that of the prefixed keys
    names = leaves.groupBy("key").agg(F.min("named").alias("named"))
    subroots = stage(roots.join(names, "key"), "manifest-subroots")
    ranked = numbered(subroots.select(F.lit("").alias("key"), "named", F.col("key").alias("group"), "digest"), "key", ["named"], "manifest-groups")
    upper, top = grown(ranked, ["group"], "manifest-upper")
    empty = F.array().cast(PATH)
    above = with_paths(upper, top.select("key", empty.alias("path"), F.col("digest").alias("root")), ["root"], "manifest-upper-paths")
    if above is None:  # one group or none: its subroot is the root
        tops = subroots.select("key", empty.alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    else:
        tops = above.select(F.col("child.group").alias("key"), "path", F.col("child.digest").alias("subroot"), "root")
    tops = stage(tops, "manifest-tops")
    found = placed.where("n = 1").join(tops, "key").select("doc_id", "digest", "claimed", "subroot", "root", "path")
    below = with_paths(levels, tops, ["subroot", "root"], "manifest-paths")
    if below is not None:
        found = found.unionByName(below.select("child.doc_id", "child.digest", "child.claimed", "subroot", "root", "path"))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def document_leaf(text: Column) -> Column:
    return digest(*[field(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)])


def op13_merkle_dataset_manifest(spark, sf_dir):
    """The manifest of all documents by lang, checked against a copy in which every third document (by checksum) is lower-cased.

    A null doc_id is never tampered with; a null text stays null.  See ``manifest`` for the other cases.
    """
    docs = table(spark, sf_dir, "documents")
    lowered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tampered = F.when(F.coalesce(lowered, F.lit(False)), F.translate("text", CAPITALS, SMALL)).otherwise(F.col("text"))
    return manifest(docs, F.col("lang"), "doc_id", document_leaf(F.col("text")), document_leaf(tampered))


#: Trees by recursion, a level at a time; each row's proof climbs them from its leaf.
ORACLE_13 = """
WITH RECURSIVE d AS (
  SELECT *, coalesce(xor(list_reduce(range(8 * strlen(doc_id::VARCHAR)), lambda c, i:
      xor(xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) ELSE 0 END) >> 1,
          CASE WHEN xor(c, CASE WHEN i % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) ELSE 0 END) % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295), 4294967295) % 3 = 0, false) AS lowered,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents
), leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || CASE WHEN lowered THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS claimed FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), t(level, g, pos, n, digest) AS (
  SELECT 0, g, pos, n, leaf FROM placed
  UNION ALL SELECT level + 1, g, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY level, g, pos // 8, n
), subs AS (
  SELECT t.g, t.digest AS subroot, row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM t JOIN (SELECT DISTINCT g, lang FROM leaves) l ON l.g = t.g WHERE t.n = 1
), u(level, pos, n, digest) AS (
  SELECT 0, pos, n, subroot FROM subs
  UNION ALL SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 8, n
), tree AS (SELECT level, g, pos, n, digest FROM t UNION ALL SELECT level, '', pos, n, digest FROM u),
sib AS (
  SELECT a.level, a.g, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM tree a JOIN tree b ON b.level = a.level AND b.g = a.g AND b.pos // 8 = a.pos // 8 WHERE a.n > 1 GROUP BY ALL
), climb(leaf_pos, level, g, pos, n, proof, node) AS (
  SELECT pos, 0, g, pos, n, '', claimed FROM placed
  UNION ALL SELECT c.leaf_pos, c.level + 1, c.g, c.pos // 8, (c.n + 7) // 8, c.proof || s.l || s.r, sha256(s.l || c.node || s.r) FROM climb c JOIN sib s ON s.level = c.level AND s.g = c.g AND s.pos = c.pos
), climb2(leaf_pos, g, level, pos, n, proof, node) AS (
  SELECT c.leaf_pos, c.g, 0, s.pos, s.n, c.proof, c.node FROM climb c JOIN subs s ON s.g = c.g WHERE c.n = 1
  UNION ALL SELECT c.leaf_pos, c.g, c.level + 1, c.pos // 8, (c.n + 7) // 8, c.proof || s.l || s.r, sha256(s.l || c.node || s.r) FROM climb2 c JOIN sib s ON s.level = c.level AND s.g = '' AND s.pos = c.pos
)
SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM u WHERE n = 1) AS root, sha256(c.proof) AS proof_sha256, c.node AS folded_root, c.node = (SELECT digest FROM u WHERE n = 1) AS verified
FROM climb2 c JOIN placed p ON p.g = c.g AND p.pos = c.leaf_pos JOIN subs s ON s.g = p.g WHERE c.n = 1
"""

QUERIES = {"op13_merkle_dataset_manifest": op13_merkle_dataset_manifest}
ORACLES = {"op13_merkle_dataset_manifest": ORACLE_13}
