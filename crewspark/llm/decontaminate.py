"""Benchmark decontamination by spaced-seed hashing.

A mask such as 1101001101 reads the words of a window at its ones and ignores the others, so
a hash over a window survives substitutions at the ignored places.  Hashes of every window of
every benchmark item are joined with those of the documents; every hit gives a pair and a
shift, and the pair is verified word by word around it.

Documents send only windows that may be in the benchmark: a Bloom filter over its hashes,
2**FILTER_BITS bits whatever the benchmark's size, goes to every task.  A fuller filter lets
more windows through to the join, nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, table
from .slices import MIX, mixed, some_texts, words_of

MASKS = ("1111110000", "1101001101", "1010110011", "1100110101")
SPAN = 10
#: For items below 13 words, where fewer offsets fit: with those of SPAN words no two substitutions in 10 to 12 words
#: break every mask, with the others no single one does in 5 to 9 words (found by enumeration).  An item of up to four
#: words has to agree in all of them: it is one hash.
MORE_MASKS = ("0001111110", "0111001011", "1110001110", "1011000111", "0010111101", "0101110011")
SHORT_MASKS = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("00111", "11011", "11100"),
    6: ("001111", "110011", "111100"), 7: ("0011111", "1100111", "1111000"),
    8: ("00111111", "11000111", "11111000"), 9: ("000111111", "111000111", "111111000"),
}
ENOUGH = 13  # words from which on the offsets of MASKS are enough
SALTS = 8  # join keys that a seed's rows are dealt over
FILTER_BITS = 26
#: ASCII punctuation counts as white space.
PUNCTUATION = bytes(32 if not (chr(c).isalnum() or c >= 128) else c for c in range(256))


def plain_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words without ASCII punctuation, and the words before each text and in all."""
    return words_of([t.lower() for t in texts], PUNCTUATION)[:2]


def windows(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of len(mask) words, reading those at the mask's ones."""
    out = np.full(max(len(h) - len(mask) + 1, 0), np.uint64(int(mask, 2)))
    for at, bit in enumerate(mask):
        if bit == "1":
            out = mixed(out * MIX[0] + h[at:at + len(out)])
    return out


def masks_of(n_words: int, masks: tuple[str, ...]) -> tuple[str, ...]:
    """Masks for an item: the spaced ones, more of them if fewer offsets fit, shorter ones if it is shorter than they are."""
    if n_words >= SPAN:
        return masks if n_words >= ENOUGH else masks + MORE_MASKS
    return SHORT_MASKS[n_words]


def item_seeds(masks):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            h, before = plain_words(pdf["text"].tolist())
            out = []
            for item, b, e in zip(pdf["item_id"].tolist(), before[:-1].tolist(), before[1:].tolist()):
                for mask in masks_of(e - b, masks):
                    seed = windows(h[b:e], mask).view(np.int64)
                    out.append(pd.DataFrame({"item_id": item, "length": len(mask), "seed": seed, "at": np.arange(len(seed))}))
            if out:
                yield pd.concat(out)

    return run


def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digest of each text's words (null without words) and how many it has."""
    for pdf in batches:
        texts, out, sizes = [t or "" for t in pdf["text"]], [], []
        for at, to in some_texts(texts):
            h, before = plain_words(texts[at:to])
            out += [blake2b(h[b:e].tobytes(), digest_size=16).digest() if e > b else None for b, e in zip(before[:-1], before[1:])]
            sizes += np.diff(before).tolist()
        yield pdf.drop(columns="text").assign(digest=pd.Series(out, pdf.index, object), n_words=sizes)


def document_seeds(masks: list[str], places: np.ndarray, bits: np.ndarray):
    """mapInPandas function: windows of the documents that pass the filter (word numbers and 64 bits of each)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = np.zeros(1 << FILTER_BITS >> 6, np.uint64)
        filled[places] = bits
        low, six = np.uint64((1 << FILTER_BITS) - 1), np.uint64(6)

        def held(x: np.ndarray) -> np.ndarray:
            return (filled[(x >> six).astype(np.int64)] >> (x & np.uint64(63)) & np.uint64(1)).astype(bool)

        for pdf in batches:
            texts, ids = [t or "" for t in pdf["text"]], pdf["doc_id"].to_numpy()
            for at, to in some_texts(texts):
                h, before = plain_words(texts[at:to])
                out = []
                for mask in masks:
                    seed = windows(h, mask)
                    hit = np.flatnonzero(held(seed & low))
                    hit = hit[held(seed[hit] >> np.uint64(FILTER_BITS) & low)]
                    doc = np.searchsorted(before, hit, "right") - 1
                    whole = hit + len(mask) <= before[doc + 1]  # not across two texts
                    hit, doc = hit[whole], doc[whole]
                    if len(mask) < 5 and len(hit):  # one hash is the whole item: a text's first place of it will do
                        first = np.unique(np.stack([doc, seed[hit].view(np.int64)]), axis=1, return_index=True)[1]
                        hit, doc = hit[first], doc[first]
                    out.append(pd.DataFrame({"doc_id": ids[at:to][doc], "length": len(mask), "seed": seed[hit].view(np.int64), "at": hit - before[doc]}))
                if out:
                    yield pd.concat(out)

    return run


def overlapping(window: int, share: float):
    """mapInPandas function: pairs with a stretch of ``window`` words (or the whole item) of which ``share`` agree."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep, last, doc = [], None, None
            for doc_id, text, item_text, shifts in zip(pdf["doc_id"], pdf["text"], pdf["item_text"], pdf["shifts"]):
                if doc_id != last:
                    last, doc = doc_id, plain_words([text])[0]
                item = plain_words([item_text])[0]
                w, found = min(window, len(item)), False
                for shift in shifts:
                    a, b = max(0, -int(shift)), min(len(item), len(doc) - int(shift))
                    if b - a >= w and not found:
                        same = np.concatenate([[0], np.cumsum(item[a:b] == doc[a + shift:b + shift])])
                        found = bool((same[w:] - same[:-w]).max() >= share * w)
                keep.append(found)
            yield pdf.loc[keep, ["doc_id", "item_id"]]

    return run


def contaminated_pairs(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, window: int = 13, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(pairs, classes): (doc_id, item_id) of documents that hold a benchmark passage, and item classes.

    ``docs``: doc_id, text.  ``items``: item_id, text.  Words are lower-cased runs without
    ASCII punctuation or white space.  Items of the same words are a class, named by the
    least item_id; classes: (item_id, class_id), pairs name classes.  A pair is returned when,
    at the shift of some hit, a stretch of ``window`` words (all of a shorter item) agrees
    in at least ``share`` of its words; with the default masks, window and share every such shift has a hit.
    Items of any length are looked for inside the texts (a one-word item in all that hold the word); those
    without words never.  Null texts count as empty; rows without an id are left out; documents are read whole.  Rows
    that repeat a doc_id give its pairs once; extra columns are ignored.  Empty tables give no pairs.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = stage(items.mapInPandas(digest, "item_id long, digest binary, n_words long").where("n_words > 0"), "benchmark-items")
    reps = known.groupBy("digest").agg(F.min("item_id").alias("class_id"), F.min("n_words").alias("n_words"))
    classes = stage(known.select("item_id", "digest").join(reps, "digest"), "benchmark-classes")
    chosen = stage(items.join(classes.where("item_id = class_id").select("item_id", "n_words").distinct(), "item_id").dropDuplicates(["item_id"]), "benchmark-texts")

    seeds = stage(chosen.select("item_id", "text").mapInPandas(item_seeds(masks), "item_id long, length int, seed long, at long"), "benchmark-seeds")
    size = F.lit((1 << FILTER_BITS) - 1)
    bit = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(size), F.shiftrightunsigned("seed", FILTER_BITS).bitwiseAND(size))).alias("bit"))
    # at most 2**20 rows of 64 bits
    filled = bit.groupBy(F.shiftright("bit", 6).alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toPandas()
    sizes = [r[0] for r in chosen.select(F.least("n_words", F.lit(ENOUGH))).distinct().collect()]
    used = sorted({m for n in sizes for m in masks_of(n, masks)})
    found = docs.mapInPandas(document_seeds(used, filled["place"].to_numpy(np.int64), filled["bits"].to_numpy(np.int64).view(np.uint64)), "doc_id long, length int, seed long, at long")
    # a passage that very many documents hold is one seed: its rows are dealt over several keys
    salted = seeds.select("length", "seed", "item_id", F.col("at").alias("item_at"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    hits = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["length", "seed", "salt"]) \
        .groupBy("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.count(F.lit(1)).alias("n"))
    near = stage(hits.groupBy("doc_id", "item_id").agg(F.collect_list("shift").alias("shifts")), "benchmark-hits")
    wanted = docs.join(near.select("doc_id").distinct(), "doc_id", "left_semi")
    both = wanted.join(near, "doc_id").join(chosen.select("item_id", F.col("text").alias("item_text")), "item_id")
    pairs = both.select("doc_id", "text", "item_id", "item_text", "shifts").mapInPandas(overlapping(window, share), "doc_id long, item_id long")
    return stage(pairs.distinct(), "benchmark-pairs"), classes.select("item_id", "class_id")


def flagged(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_items, item_ids, contaminated) of every distinct doc_id; item_ids: the classes found, ascending."""
    pairs, _ = contaminated_pairs(docs, items)
    lists = pairs.groupBy("doc_id").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return ids.join(lists, "doc_id", "left").select("doc_id", F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                                                    F.coalesce("item_ids", F.expr("cast(array() as array<bigint>)")).alias("item_ids"), F.col("item_ids").isNotNull().alias("contaminated"))


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark passage go; rows without an id stay, all others as in ``contaminated_pairs``."""
    pairs, _ = contaminated_pairs(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(pairs.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def op5_spaced_seed_decontamination(spark, sf_dir):
    """Every document with the benchmark items that it holds a passage of; edge cases as in ``contaminated_pairs``."""
    return flagged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op5_spaced_seed_decontamination": op5_spaced_seed_decontamination}
ORACLES: dict[str, str] = {}
