"""Language ID by interpolated Kneser-Ney character models, one per language.

A text becomes its lower-cased letters with one space for whatever lies between them.  Spark
counts every four-character sequence of every labelled training text; from all of those counts come,
for each language, Kneser-Ney models of order four down to one, kept as sorted arrays of
64-bit hashes.  A text gets the language of lowest cross-entropy a character.

Models of up to HELD_ROWS sequences go to every task.  Larger ones stay in Spark: the texts are dealt
into groups, each group's different sequences are joined with the models' tables, and the values come
back to the group.  Both ways give the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import LETTER, code_point_classes
from .common import crc_fold, keep_rows, stage, table
from .slices import MIX, mixed, some_texts

ORDER = 4
UNKNOWN = "und"
#: Sequences of all languages that a process holds; larger models are joined.
HELD_ROWS = 1 << 21
#: Slopes among which the score's is chosen.
SLOPES = 2.0 ** np.arange(-2, 7, 0.5)
#: Values that a process remembers, over all languages.
REMEMBERED = 1 << 22
#: Characters of a group of texts that meets its sequences' values in one task (expected number).
GROUP_CHARS = 1 << 23
PARTIAL = 1 << 20


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with ORDER - 1 spaces before it, and where each text begins (and the end)."""
    padded = [" " * (ORDER - 1) + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, padded), np.int64, len(padded)))])
    letter = code_point_classes()[points] == LETTER
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character after a letter stands for the gap
    pad = begin[:-1, None] + np.arange(ORDER - 1)
    keep[pad.ravel()] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, points, 32)[keep].astype(np.uint64), before[begin]


def grams(chars: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first two, last two) characters of each sequence that ends in a text, and how many end before each text."""
    ends = np.ones(len(chars), bool)
    ends[(begin[:-1, None] + np.arange(ORDER - 1)).ravel()] = False
    at = np.flatnonzero(ends)
    bits = np.uint64(21)
    return chars[at - 3] << bits | chars[at - 2], chars[at - 1] << bits | chars[at], np.concatenate([[0], np.cumsum(ends)])[begin]


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function over (lang, text): each sequence's count, summed over much of the partition."""
    held: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(lang: str, hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> None:
        if lang in held:
            hi, lo, n = (np.concatenate(x) for x in zip(held[lang], (hi, lo, n)))
        order = np.lexsort((lo, hi))
        hi, lo, n = hi[order], lo[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
        held[lang] = hi[first], lo[first], np.add.reduceat(n, first)

    def out(lang: str) -> pd.DataFrame:
        hi, lo, n = held.pop(lang)
        return pd.DataFrame({"lang": lang, "hi": hi.view(np.int64), "lo": lo.view(np.int64), "n": n})

    for pdf in batches:
        for lang, part in pdf.groupby("lang"):
            texts = part["text"].tolist()
            for at, to in some_texts(texts):
                hi, lo, _ = grams(*letters(texts[at:to]))
                if len(hi):
                    add(lang, hi, lo, np.ones(len(hi), np.int64))
                if lang in held and len(held[lang][0]) > PARTIAL:
                    yield out(lang)
    for lang in list(held):
        yield out(lang)


def key_of(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of sequences of one to four characters."""
    h = np.full(len(parts[0]), np.uint64(len(parts)))
    for p in parts:
        h = mixed(h * MIX[0] + p)
    return h


def split(hi: np.ndarray, lo: np.ndarray) -> list[np.ndarray]:
    bits, low = np.uint64(21), np.uint64((1 << 21) - 1)
    return [hi >> bits, hi & low, lo >> bits, lo & low]


def grouped(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and each one's sum."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def discount_of(ones: int, twos: int) -> float:
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class KneserNey:
    """One language's model: for each order sorted sequence hashes with their discounted shares,
    and sorted context hashes with the weight that their lower order gets."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, n: np.ndarray, alphabet: int):
        self.alphabet = alphabet
        self.orders = []
        chars, counts = split(hi, lo), n.astype(np.float64)
        for order in range(ORDER, 0, -1):
            grams_, context = key_of(chars), key_of(chars[:-1]) if order > 1 else np.zeros(len(counts), np.uint64)
            discount = discount_of((counts == 1).sum(), (counts == 2).sum())
            contexts, total = grouped(context, counts)
            _, kinds = grouped(context, np.ones(len(counts)))
            at = np.searchsorted(contexts, context)
            order_of = np.argsort(grams_)
            share = (np.maximum(counts - discount, 0) / total[at])[order_of]
            self.orders.append((grams_[order_of], share, contexts, discount * kinds / total))
            if order > 1:  # the next order counts in how many ways its sequences are preceded
                key = key_of(chars[1:])
                _, first, times = np.unique(key, return_index=True, return_counts=True)
                chars, counts = [c[first] for c in chars[1:]], times.astype(np.float64)

    def log_probability(self, chars: list[np.ndarray]) -> np.ndarray:
        """Of the last character after the others, by interpolation from order one up."""
        p = np.full(len(chars[0]), 1 / self.alphabet)
        for order in range(1, ORDER + 1):
            sequences, share, contexts, weight = self.orders[ORDER - order]
            part = chars[ORDER - order:]
            context = key_of(part[:-1]) if order > 1 else np.zeros(len(p), np.uint64)
            p = found(sequences, share, key_of(part), 0.0) + found(contexts, weight, context, 1.0) * p
        return np.log(p)


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


class Scorer:
    """Log-probabilities of sequences in all languages, with a direct-mapped memory of recent ones."""

    def __init__(self, models: list[KneserNey]):
        self.models = models
        self.bits = np.uint64(min(19, max(8, (REMEMBERED // max(len(models), 1)).bit_length() - 1)))
        self.hi = np.zeros(1 << int(self.bits), np.uint64)  # no real sequence has two zero characters
        self.lo = np.zeros(1 << int(self.bits), np.uint64)
        self.value = np.zeros((1 << int(self.bits), len(models)), np.float32)

    def scores(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        slot = ((hi * MIX[0] ^ lo * MIX[2]) >> (np.uint64(64) - self.bits)).astype(np.int64)
        known = (self.hi[slot] == hi) & (self.lo[slot] == lo)
        out = self.value[slot]
        miss = np.flatnonzero(~known)
        if len(miss):
            h, l = hi[miss], lo[miss]
            order = np.lexsort((l, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (l[order][1:] != l[order][:-1])])
            first = order[new]
            values = np.stack([m.log_probability(split(h[first], l[first])) for m in self.models], 1).astype(np.float32)
            out[miss[order]] = values[np.cumsum(new) - 1]
            spot = slot[miss[first]]
            self.hi[spot], self.lo[spot], self.value[spot] = h[first], l[first], values
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats a character of each text in each language, and how many characters it has."""
        return text_entropies(texts, len(self.models), self.scores)


def text_entropies(texts: list[str], languages: int, scores) -> tuple[np.ndarray, np.ndarray]:
    """Nats a character in each language and characters of each text; ``scores`` (hi, lo) gives a row a sequence."""
    total, size = np.zeros((len(texts), languages)), np.zeros(len(texts), np.int64)
    for at, to in some_texts(texts):
        hi, lo, before = grams(*letters(texts[at:to]))
        size[at:to] = np.diff(before)
        some = np.flatnonzero(size[at:to])
        if not len(some):
            continue
        if len(hi) * languages <= 1 << 23:
            total[at + some] = np.add.reduceat(scores(hi, lo), before[:-1][some], axis=0, dtype=np.float64)
            continue
        for i in some.tolist():  # a text's values a piece at a time
            for b in range(before[i], before[i + 1], max(1, (1 << 22) // languages)):
                e = min(before[i + 1], b + max(1, (1 << 22) // languages))
                total[at + i] += scores(hi[b:e], lo[b:e]).sum(0, dtype=np.float64)
    return -total / np.maximum(size, 1)[:, None], size


class LanguageModel:
    """Languages in order, the fitted slope and each language's rejection limit; ``models`` is None where the models are joined."""

    def __init__(self, langs: list[str], models: list[KneserNey] | None, counts: DataFrame | None = None):
        self.langs, self.models, self.counts = langs, models, counts
        self.slope = 1.0
        self.limits = np.full(len(langs), np.inf)
        self._scorer: Scorer | None = None

    def __getstate__(self):
        return self.__dict__ | {"_scorer": None, "counts": None}

    @property
    def scorer(self) -> Scorer:
        self._scorer = self._scorer or Scorer(self.models)
        return self._scorer

    def judged(self, h: np.ndarray, size: np.ndarray) -> pd.DataFrame:
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        score = 1 / np.exp(-self.slope * (h - low[:, None])).sum(1)
        any_letter = size > 0
        return pd.DataFrame({
            "lang_pred": np.where(any_letter, np.array(self.langs, object)[best], UNKNOWN), "score": np.where(any_letter, score, 0.0),
            "cross_entropy": np.where(any_letter, low, 0.0), "rejected": ~any_letter | (low > self.limits[best]),
        })

    def judge(self, rows: DataFrame, run, schema) -> DataFrame:
        """``run(rows as an Arrow table, entropies, sizes)`` over all rows of ``rows`` (with a text column), as a frame of ``schema``."""
        if self.models is None:
            return joined_entropies(rows, self, run, schema)

        def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table_ = pa.Table.from_batches([batch])
                texts = texts_of(table_)
                for at, to in some_texts(texts):
                    yield from run(table_.slice(at, to - at), *self.scorer.entropies(texts[at:to])).to_batches()

        return rows.mapInArrow(held, schema)


def texts_of(rows: pa.Table) -> list[str]:
    return [t or "" for t in rows.column("text").to_pylist()]


def discounts(level: DataFrame) -> Column:
    """Discount of an order from its counts, as an aggregate over one language's rows."""
    ones, twos = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    return F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5)


def order_tables(counts: DataFrame) -> list[tuple[list[str], DataFrame, list[str], DataFrame]]:
    """For each order from four down to one: (keys, key -> language -> share, context keys, context -> language -> weight).

    ``counts``: i (the language's number), a, b, c, d (characters), n.
    """
    out, level = [], counts
    chars = ["a", "b", "c", "d"]
    for order in range(ORDER, 0, -1):
        keys, context = chars[-order:], chars[-order:-1]
        weights = level.groupBy("i", *context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        by = F.broadcast(level.groupBy("i").agg(discounts(level).alias("discount")))  # a row a language
        weights = stage(weights.join(by, "i"), "language-contexts")
        shares = level.join(weights, ["i", *context]).select("i", *keys, (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("value"))
        weights = weights.select("i", *context, (F.col("discount") * F.col("kinds") / F.col("total")).alias("value"))
        spread = lambda t, k, name: stage(t.groupBy(*k).agg(F.map_from_entries(F.collect_list(F.struct("i", "value"))).alias(name)), f"language-{name}")
        out.append((keys, spread(shares, keys, f"p{order}"), context, spread(weights, context, f"w{order}")))
        if order > 1:
            level = stage(level.groupBy("i", *keys[1:]).agg(F.count(F.lit(1)).alias("n")), "language-level")
    return out


def four(hi: str, lo: str) -> list[Column]:
    low = (1 << 21) - 1
    return [F.shiftright(hi, 21).alias("a"), F.col(hi).bitwiseAND(low).alias("b"), F.shiftright(lo, 21).alias("c"), F.col(lo).bitwiseAND(low).alias("d")]


def whole_weights(weights: DataFrame) -> Column:
    """The weights of order one, which have no context: one row, a number a language."""
    entries = [F.struct(F.lit(i).cast("int"), F.lit(float(w))) for i, w in sorted(weights.head()[0].items())]
    return F.map_from_entries(F.array(*entries))


def joined_values(wanted: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """(hi, lo, value: array<float>) of the distinct sequences ``wanted``: log-probabilities by language, as ``KneserNey`` has them."""
    spark = wanted.sparkSession
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(langs)), "i int, lang string"))
    rows = stage(counts.join(numbers, "lang").select("i", *four("hi", "lo"), "n"), "language-numbered")
    letters_ = rows.select(F.explode(F.array("a", "b", "c", "d")).alias("x")).distinct().count() + 1
    found = wanted.select("hi", "lo", *four("hi", "lo"))
    tables = order_tables(rows)
    for keys, shares, context, weights in tables:
        found = found.join(shares, keys, "left")
        found = found.join(weights, context, "left") if context else found.withColumn("w1", whole_weights(weights))
    at = lambda name, j, otherwise: F.coalesce(F.try_element_at(F.col(name), j), F.lit(otherwise))

    def log_probability(j: Column) -> Column:
        p = F.lit(1 / letters_)
        for order in range(1, ORDER + 1):
            p = at(f"p{order}", j, 0.0) + at(f"w{order}", j, 1.0) * p
        return F.log(p).cast("float")

    return found.select("hi", "lo", F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), log_probability).alias("value"))


def joined_entropies(rows: DataFrame, model: LanguageModel, run, schema) -> DataFrame:
    """``LanguageModel.judge`` for models that no process holds: texts are written once, in groups by hash."""
    names, languages = rows.columns, len(model.langs)
    size = rows.select(F.sum(F.length("text"))).head()[0] or 0
    groups = 1 + size // GROUP_CHARS
    dealt = stage(rows.withColumn("_group", F.pmod(F.xxhash64(*names), F.lit(groups))).repartition("_group"), "language-groups")

    def sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for group, part in pdf.groupby("_group"):
                hi, lo, _ = grams(*letters([t or "" for t in part["text"]]))
                yield pd.DataFrame({"_group": group, "hi": hi.view(np.int64), "lo": lo.view(np.int64)}).drop_duplicates()

    used = stage(dealt.select("_group", "text").mapInPandas(sequences, "_group long, hi long, lo long").distinct(), "language-used")
    values = stage(joined_values(used.select("hi", "lo").distinct(), model.counts, model.langs), "language-values")
    values = used.join(values, ["hi", "lo"])

    def score(texts: pa.Table, known: pa.Table) -> pa.Table:
        key = key_of([known.column(c).to_numpy().view(np.uint64) for c in ("hi", "lo")])
        order = np.argsort(key)
        key = key[order]
        value = known.column("value").combine_chunks().flatten().to_numpy().reshape(len(key), languages)[order]
        h, n = text_entropies(texts_of(texts), languages, lambda hi, lo: value[np.searchsorted(key, key_of([hi, lo]))])
        return run(texts.select(names), h, n)

    return dealt.groupBy("_group").cogroup(values.groupBy("_group")).applyInArrow(score, schema)


def train(labelled: DataFrame) -> LanguageModel | None:
    """A model from rows (doc_id, text, lang); rows without text or lang teach nothing.  None without any.

    All rows are counted, every sequence is kept and every value of lang is a language, however many there
    are (each costs a look at every sequence).  The slope and the limits are fitted on all rows, too.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    counts = stage(rows.select("lang", "text").mapInPandas(counted, "lang string, hi long, lo long, n long").groupBy("lang", "hi", "lo").agg(F.sum("n").alias("n")), "language-counts")
    kinds = {r["lang"]: r["count"] for r in counts.groupBy("lang").count().collect()}
    if not kinds:
        return None
    langs = sorted(kinds)
    models = None
    if sum(kinds.values()) <= HELD_ROWS:
        held = counts.toPandas()
        hi, lo = (held[c].to_numpy(np.int64).view(np.uint64) for c in ("hi", "lo"))
        alphabet = len(np.unique(np.concatenate(split(hi, lo)))) + 1
        own = held.groupby("lang").indices
        models = [KneserNey(hi[own[lang]], lo[own[lang]], held["n"].to_numpy()[own[lang]], alphabet) for lang in langs]
    model = LanguageModel(langs, models, counts)
    calibrate(model, rows)
    return model


def calibrate(model: LanguageModel, rows: DataFrame) -> None:
    """Slope of least log loss; a text is rejected beyond six deviations (one nat at least) above its language's mean."""
    places = {lang: i for i, lang in enumerate(model.langs)}

    def losses(rows: pa.Table, h: np.ndarray, size: np.ndarray) -> pa.Table:
        """Of each row its language's number and entropy, and for each slope the share of its language and the mean log share."""
        truth = np.array([places.get(lang, -1) for lang in rows.column("lang").to_pylist()], np.int64)
        kept = np.flatnonzero((size > 0) & (truth >= 0))
        h, truth = h[kept], truth[kept]
        gap = h - h.min(1, keepdims=True)
        right, every = np.empty((len(h), len(SLOPES))), np.empty((len(h), len(SLOPES)))
        for i, slope in enumerate(SLOPES):
            p = -slope * gap - np.log(np.exp(-slope * gap).sum(1, keepdims=True))
            right[:, i], every[:, i] = p[np.arange(len(h)), truth], p.mean(1)
        return pa.table({"truth": truth, "own": h[np.arange(len(h)), truth], "right": pa.array(list(right), pa.list_(pa.float64())), "every": pa.array(list(every), pa.list_(pa.float64()))})

    parts = model.judge(rows.select("text", "lang"), losses, "truth long, own double, right array<double>, every array<double>")
    each = parts.groupBy("truth").agg(F.count(F.lit(1)).alias("n"), F.avg("own").alias("mean"), F.stddev_pop("own").alias("spread"),
                                      *[F.sum(F.col(c)[i]).alias(f"{c}{i}") for c in ("right", "every") for i in range(len(SLOPES))]).toPandas()
    if not len(each):
        return
    # one part in the number of rows of every label counts as wrong: the texts were learnt from
    smooth = 1 / (each["n"].sum() + 2)
    loss = [-((1 - smooth) * each[f"right{i}"].sum() + smooth * each[f"every{i}"].sum()) for i in range(len(SLOPES))]
    model.slope = float(SLOPES[int(np.argmin(loss))])
    model.limits[each["truth"].to_numpy()] = each["mean"].to_numpy() + np.maximum(6 * each["spread"].to_numpy(), 1.0)


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, lang_pred, score, cross_entropy, rejected), a row for every row.

    A text that is null or holds no letter is 'und' with score 0 and rejected; others get
    the language of least cross-entropy (ties: the first in order) and are rejected when
    it lies beyond the limit of that language.  Texts are read whole; null and repeated ids
    pass through and other columns are ignored.  Without a model every text is 'und'.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("cross_entropy"), F.lit(True).alias("rejected"))
    schema = "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean"
    return model.judge(rows, lambda part, h, size: pa.Table.from_pandas(model.judged(h, size), preserve_index=False).add_column(0, "doc_id", part.column("doc_id")), schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc_fold("doc_id", 3) != 1).select("doc_id", "text", "lang")


def keep_known_languages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents go whose text is in none of the learnt languages, or has no letter.

    Where nothing is labelled no language is known and nothing can be told apart: all documents stay.
    Null and repeated ids and extra columns pass through; an empty table gives an empty result.
    """
    model = train(training_rows(docs))
    if model is None:
        return docs
    if model.models is None:
        return model.judge(docs, lambda part, h, size: part.filter(pa.array(~model.judged(h, size)["rejected"].to_numpy(bool), pa.bool_())), docs.schema)

    def keep(texts: list[str]) -> np.ndarray:
        parts = [~model.judged(*model.scorer.entropies(texts[at:to]))["rejected"].to_numpy() for at, to in some_texts(texts)]
        return np.concatenate([np.empty(0, bool), *parts])

    return keep_rows(docs, keep)


def op10_kneser_ney_language_id(spark, sf_dir):
    """Language and score of every document, learnt from the training fold's text and lang; edge cases as in ``predict``."""
    docs = table(spark, sf_dir, "documents")
    held_out = docs.select("doc_id", "text")
    out = predict(held_out, train(training_rows(docs)))
    return out.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


QUERIES = {"op10_kneser_ney_language_id": op10_kneser_ney_language_id}
ORACLES: dict[str, str] = {}
