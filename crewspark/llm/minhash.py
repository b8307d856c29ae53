"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of word shingles (64-bit hashes) and one key for each band of
   its MinHash signature.  Texts with the same set form a class; one document stands for it.
2. Documents that share a band key are a bucket.  Each bucket belongs to its most central
   member, its hub (the one that shares most band keys overall); the hub's group is the
   members of all its buckets.  Only documents in a group send their signature and set on,
   each once for a group.
3. A group is dealt into blocks that each hold the hub.  In a block, members are compared
   with the hub, then those it isn't linked with are compared with all others.  A pair's
   signatures are read batch by batch and it is pruned as soon as the posterior probability
   that its similarity reaches the threshold falls below ``miss``; survivors are verified on
   the full sets, unless the links found so far connect them already.
4. In groups of several blocks, members not linked with the hub also visit the other blocks.
5. Blocks return the links that connect something new, never all pairs; links become components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, id_filter, stage, table
from .slices import MIX, mixed, some_texts, words_of

def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Distinct sorted hashes of each text's k-word shingles; fewer words: of the whole sequence; none: empty."""
    h, before, *_ = words_of(texts)
    out = np.full(max(len(h) - k + 1, 0), np.uint64(k))
    for at in range(k):
        out = mixed(out * MIX[0] + h[at:at + len(out)])
    sets = []
    for b, e in zip(before[:-1].tolist(), before[1:].tolist()):
        if e - b >= k:
            one = np.sort(out[b:e - k + 1])
            sets.append(one[np.concatenate([[True], one[1:] != one[:-1]])])
        else:
            one = np.full(min(e - b, 1), np.uint64(e - b))
            for at in range(b, e):
                one = mixed(one * MIX[0] + h[at])
            sets.append(one)
    return sets


class Signer:
    """MinHash of 32-bit halves of the shingle hashes by multiply-add permutations."""

    def __init__(self, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.mul = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.add = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """sets (none empty) x hashes."""
        out = np.empty((len(sets), self.bands * self.rows), np.uint32)
        if sets:
            flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
            starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
            for at in range(out.shape[1]):
                out[:, at] = np.minimum.reduceat(flat * self.mul[at] + self.add[at], starts)
        return out

    def keys(self, sig: np.ndarray) -> np.ndarray:
        """sets x bands."""
        out = np.zeros((len(sig), self.bands), np.uint64)
        for b in range(self.bands):
            for r in range(self.rows):
                out[:, b] = mixed(out[:, b] * MIX[0] + sig[:, b * self.rows + r].astype(np.uint64))
        return out.view(np.int64)


def sign(k: int, signer: Signer):
    """mapInPandas function: shingle count, set digest and band keys of each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids = [t or "" for t in pdf["text"]], pdf["doc_id"].to_numpy()
            for at, to in some_texts(texts, 1 << 18):
                sets = shingle_sets(texts[at:to], k)
                keys = iter(signer.keys(signer.signatures([s for s in sets if len(s)])))
                yield pd.DataFrame({
                    "doc_id": ids[at:to], "n_shingles": [len(s) for s in sets],
                    "digest": [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "keys": [next(keys) if len(s) else None for s in sets]})

    return run


def details(k: int, signer: Signer, wanted):
    """mapInPandas function: signature (16 bits a hash) and set of the documents that ``wanted`` may hold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = wanted()
        for pdf in batches:
            pdf = pdf[held(pdf["doc_id"].to_numpy(np.int64))]
            texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy()
            for at, to in some_texts(texts, 1 << 18):
                sets = shingle_sets(texts[at:to], k)
                some = [i for i, s in enumerate(sets) if len(s)]
                if not some:
                    continue
                sig = (signer.signatures([sets[i] for i in some]) & 0xFFFF).astype(np.uint16)
                yield pd.DataFrame({"doc": ids[at:to][some], "sig": [x.tobytes() for x in sig], "full": [sets[i].tobytes() for i in some]})

    return run


@lru_cache
def least_matches(n_hashes: int, batch: int, threshold: float, miss: float) -> tuple[tuple[int, int], ...]:
    """(hashes read, matches needed to go on) after each batch.

    With a uniform prior the posterior of the similarity after m matches in n hashes is
    Beta(m + 1, n - m + 1), and P(s >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in [*range(batch, n_hashes, batch), n_hashes]:
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def promising(a: np.ndarray, b: np.ndarray, steps) -> np.ndarray:
    """Which rows of the signatures a and b (each n x hashes) pass every step."""
    alive, seen, matches = np.arange(len(a)), 0, np.zeros(len(a), np.int32)
    for n, need in steps:
        matches[alive] += (a[alive, seen:n] == b[alive, seen:n]).sum(1, dtype=np.int32)
        alive, seen = alive[matches[alive] >= need], n
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


class Block:
    """Members of one block of a group, with what is known of their links.

    ``label`` is the smallest id each member is known to be connected with.
    """

    def __init__(self, docs, sigs, fulls, labels, steps, numerator: int, denominator: int):
        self.docs, self.label = np.array(docs, np.int64), np.array(labels, np.int64)
        self.given = self.label.copy()
        self.sig = np.stack([np.frombuffer(s, np.uint16) for s in sigs])
        self.full = [np.frombuffer(f, np.uint64) for f in fulls]
        self.steps, self.ratio = steps, (numerator, denominator)

    def similar(self, a: np.ndarray, b: np.ndarray) -> bool:
        """denominator * |A & B| >= numerator * |A | B| on sorted sets."""
        if len(a) > len(b):
            a, b = b, a
        numerator, denominator = self.ratio
        if denominator * len(a) < numerator * len(b):
            return False
        at = np.minimum(np.searchsorted(b, a), len(b) - 1)
        same = int((b[at] == a).sum())
        return denominator * same >= numerator * (len(a) + len(b) - same)

    def connect(self, doc: int, sig: np.ndarray, full: np.ndarray, label: int, todo: np.ndarray) -> list[tuple[int, int]]:
        """Links of a document with the members ``todo`` that connect what was not connected."""
        links = []
        todo = todo[self.label[todo] != label]
        todo = todo[promising(np.broadcast_to(sig, (len(todo), len(sig))), self.sig[todo], self.steps)]
        for j in todo.tolist():
            if self.label[j] != label and self.similar(full, self.full[j]):
                links.append((doc, int(self.docs[j])))
                low, high = min(label, int(self.label[j])), max(label, int(self.label[j]))
                self.label[self.label == high] = low
                label = low
        return links


def groups_of(batches: Iterator[pd.DataFrame], names: list[str]):
    """Rows of sorted batches, gathered while the first two columns stay the same."""
    key, held = None, []
    for pdf in batches:
        for row in zip(*(pdf[c] for c in names)):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def inside_blocks(steps, numerator: int, denominator: int):
    """mapInPandas function over rows sorted by (hub, blk): links of each block.

    Rows (hub, blk, doc, sig, full, blocks); the hub is in every block of its group.
    Returns links (doc <> to, kind 0) and, for groups of several blocks, each member's label (kind 1:
    linked with the hub, 2: not).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (hub, blk), rows in groups_of(batches, ["hub", "blk", "doc", "sig", "full", "blocks"]):
            rows = list({r[0]: r for r in rows}.values())  # one for a repeated doc_id
            block = Block([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [r[0] for r in rows], steps, numerator, denominator)
            here = int(np.flatnonzero(block.docs == hub)[0])
            links = block.connect(hub, block.sig[here], block.full[here], block.label[here], np.arange(len(rows)))
            outside = np.flatnonzero(block.label != block.label[here])
            for i in outside.tolist():
                later = np.flatnonzero((np.arange(len(rows)) > i) | ~np.isin(np.arange(len(rows)), outside))
                links += block.connect(int(block.docs[i]), block.sig[i], block.full[i], int(block.label[i]), later)
            out = [(hub, blk, a, b, 0) for a, b in links]
            if rows[0][3] > 1:
                main = block.label[here]
                out += [(hub, blk, int(d), int(x), 1 if x == main else 2) for d, x in zip(block.docs, block.label) if d != hub]
            yield pd.DataFrame(out, columns=["hub", "blk", "doc", "to", "kind"])

    return run


def between_blocks(steps, numerator: int, denominator: int):
    """mapInPandas function over rows sorted by (hub, blk, mover): links of visitors with a block's members.

    Rows (hub, blk, mover, doc, sig, full, label, own, outside): first the block's members, then
    the visitors, which are read one by one.  Two members that are both outside meet in the later block.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held, block, outside = None, [], None, None
        for pdf in batches:
            out = []
            for hub, blk, mover, doc, sig, full, label, own, out_ in zip(*(pdf[c] for c in ["hub", "blk", "mover", "doc", "sig", "full", "label", "own", "outside"])):
                if (hub, blk) != key:
                    key, held, block = (hub, blk), [], None
                if not mover:
                    held.append((doc, sig, full, label, out_))
                    continue
                if block is None:
                    if not held:
                        continue
                    held = list({h[0]: h for h in held}.values())
                    block = Block(*zip(*(h[:4] for h in held)), steps, numerator, denominator)
                    outside = np.array([h[4] for h in held])
                    held = []
                todo = np.arange(len(outside)) if own < blk else np.flatnonzero(~outside)
                # the visitor's label may have been joined with another one here
                same = np.flatnonzero(block.given == label)
                now = int(block.label[same[0]]) if len(same) else label
                out += block.connect(doc, np.frombuffer(sig, np.uint16), np.frombuffer(full, np.uint64), now, todo)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


#: Join keys that the documents of one text are dealt over.
SALTS = 16


def near_duplicates(docs: DataFrame, shingle: int = 3, similarity: tuple[int, int] = (85, 100), bands: int = 40, rows: int = 8,
                    batch: int = 40, miss: float = 1e-6, block: int = 512, seed: int = 11) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for every row of ``docs`` (doc_id, text).

    Documents are linked when ``denominator * |A & B| >= numerator * |A | B|`` on their
    sets of ``shingle``-word shingles (``similarity`` = numerator, denominator), confirmed
    on the full sets; fewer words than that make one shingle.  A null or wordless text has
    the empty set and links with nothing.  component_id is the least doc_id reachable,
    kept says that it is the document's own.  Texts of any length are read whole.  A row
    without a doc_id has no component and is not kept.  Rows that repeat a doc_id are
    judged each by its own text (their links follow one of the texts).  Extra columns are ignored.

    A pair at the threshold t misses every band with probability (1 - t**rows)**bands
    (3e-6 by default) and is pruned wrongly with about ``miss`` per batch.
    """
    spark = docs.sparkSession
    numerator, denominator = similarity
    steps = least_matches(bands * rows, batch, numerator / denominator, miss)
    signer = Signer(bands, rows, seed)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stage(docs.mapInPandas(sign(shingle, signer), "doc_id long, n_shingles long, digest binary, keys array<long>"), "minhash")
    classes = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("many"))
    reps = signed.join(classes, (signed["doc_id"] == classes["rep"]) & (signed["digest"] == classes["digest"]), "left_semi")

    keyed = reps.select(F.col("doc_id").alias("doc"), F.posexplode("keys").alias("band", "key"))
    full = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keyed.join(full, ["band", "key"]), "minhash-buckets")
    weighed = members.join(members.groupBy("doc").agg(F.sum("n").alias("weight")), "doc")
    hubs = weighed.groupBy("band", "key").agg(F.max(F.struct("weight", (-F.col("doc")).alias("d")))["d"].alias("hub")).withColumn("hub", -F.col("hub"))
    stars = stage(members.join(hubs, ["band", "key"]).where("doc <> hub").select("hub", "doc").distinct(), "minhash-groups")

    wanted = id_filter(stars.select("hub").unionByName(stars.select(F.col("doc").alias("hub"))).distinct(), "hub")
    held = docs.where("doc_id is not null and text is not null").mapInPandas(details(shingle, signer, wanted), "doc long, sig binary, full binary")
    held = stage(held, "minhash-sets")
    sizes = stars.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = stars.join(sizes, "hub").select("hub", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("blk"), "blocks")
    placed = placed.unionByName(sizes.select("hub", F.col("hub").alias("doc"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("blk"), "blocks"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    inside = placed.join(held, "doc").repartition(n, "hub", "blk").sortWithinPartitions("hub", "blk")
    found = stage(inside.mapInPandas(inside_blocks(steps, numerator, denominator), "hub long, blk int, doc long, to long, kind int"), "minhash-links")
    links = found.where("kind = 0").select(F.col("doc").alias("a"), F.col("to").alias("b"))

    several = found.where("kind > 0").select("hub", "blk", "doc", F.col("to").alias("label"), (F.col("kind") == 2).alias("outside"))
    if not several.where("outside").isEmpty():
        several = several.join(sizes, "hub")
        stay = several.select("hub", "blk", F.lit(False).alias("mover"), "doc", "label", F.col("blk").alias("own"), "outside")
        move = several.where("outside").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("other <> blk") \
            .select("hub", F.col("other").alias("blk"), F.lit(True).alias("mover"), "doc", "label", F.col("blk").alias("own"), "outside")
        tiles = stay.unionByName(move).join(held, "doc").repartition(n, "hub", "blk").sortWithinPartitions("hub", "blk", "mover")
        # written, as a task that runs two Python functions in a row holds two workers
        links = links.unionByName(stage(tiles.mapInPandas(between_blocks(steps, numerator, denominator), "a long, b long"), "minhash-between"))
    parts = connected_components(links, "minhash-components")

    # texts of several documents: a large group of copies is dealt over SALTS keys; a text of one document is found by its id
    copies = classes.where("many > 1").join(parts, F.col("rep") == F.col("id"), "left") \
        .select("digest", F.coalesce("component", "rep").alias("shared"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = signed.select("doc_id", "n_shingles", "digest", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")) \
        .join(copies, ["digest", "salt"], "left").join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left") \
        .withColumn("comp", F.when(F.col("digest").isNotNull(), F.coalesce("shared", "component")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept"))


def keep_one_of_each(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies (five-word shingles, similarity 0.8) the one of least id stays; rows without an id and wordless texts stay, every column is kept."""
    gone = near_duplicates(docs, shingle=5, similarity=(80, 100), bands=50, rows=7).where("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def op4_minhash_near_dedup(spark, sf_dir):
    """Shingle counts, components and kept flags of every document; edge cases as in ``near_duplicates``."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Every pair with a common shingle, by exact set sizes; components by recursion.
ORACLE_4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 85 * (x.n + y.n - both_n)),
reach(id, seen) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.seen),
comp AS (SELECT id, min(seen) AS c FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c AS component_id, c = d.doc_id AS kept
FROM d JOIN comp ON comp.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

QUERIES = {"op4_minhash_near_dedup": op4_minhash_near_dedup}
ORACLES = {"op4_minhash_near_dedup": ORACLE_4}
