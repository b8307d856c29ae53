"""Toxicity: a support vector machine on a subsequence string kernel with Nystroem landmarks.

The kernel of two words counts their common subsequences of three characters, each occurrence
weighed DECAY ** (characters it spans), spans up to SPAN; gaps and inserted characters cost
decay, not the match.  Words are looked at by their letters and digits and, where three or more fragments
of at most two characters follow one another ("s t u pi d"), joined.  A sentence's kernel
with a landmark word is that of its nearest word, however small: the machine weighs it.  Landmarks are
the words most typical of toxic labelled documents; the machine is trained on labelled sentences.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, stage, table
from .linear import dual_coordinate_descent, fitted_sigmoid, labelled_sample, sigmoid
from .slices import WHITE, SliceCache, some_texts

DECAY = 0.75
SPAN = 10
LANDMARKS = 128
#: Longer words are read in windows of so many characters, a new one every STEP: every stretch of up to
#: LONGEST - STEP + 1 characters lies whole in one, with what a landmark of that length can match.
LONGEST, STEP = 32, 8
LONGEST_LANDMARK = LONGEST - STEP + 1
#: Codes of a triple up to which their places are one array; more are looked up in order.
DENSE = 1 << 22
#: Kernel of a word with one or two characters inserted and the word itself, about (0.66 and 0.45 for five letters).
ALTERED = 0.55
#: Words whose kernels a task remembers; beyond it they are forgotten and made again.
MAX_ROWS = 1 << 18
PIECE = 16
#: Labelled training rows that landmarks and machine are fitted on (expected number).
SAMPLE_ROWS = 8_000
ENDS = np.isin(np.arange(256), list(b".!?"))
SKIPPED = re.compile(r"[\W_]+")


def triples(words: list[str], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight) of every occurrence of three characters that all have a symbol above 0."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    base = np.int64(symbol.max(initial=0)) + 1
    s = symbol[np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32)]
    at = np.flatnonzero(s)  # only these can be part of a triple; their places count the gaps
    owner, s = np.repeat(np.arange(len(words), dtype=np.int32), sizes)[at], s[at].astype(np.int64)
    out_w, out_c, out_v = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0)]
    for j in range(2, min(SPAN, len(s))):
        ends = np.flatnonzero((owner[:-j] == owner[j:]) & (at[j:] - at[:-j] < SPAN))
        if not len(ends):
            break
        last = s[ends + j]
        weight = DECAY ** (at[ends + j] - at[ends] + 1.0)
        for i in range(1, j):
            out_w.append(owner[ends])
            out_c.append((s[ends] * base + s[ends + i]) * base + last)
            out_v.append(weight)
    return np.concatenate(out_w), np.concatenate(out_c), np.concatenate(out_v)


def alphabet(words) -> np.ndarray:
    """Symbol from 1 of every code point in the words, 0 of all others."""
    out = np.zeros(0x110000, np.int32)
    seen = np.unique(np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32))
    out[seen] = np.arange(1, len(seen) + 1)
    return out


def self_kernels(words: list[str]) -> np.ndarray:
    symbol = alphabet(words)
    codes = (int(symbol.max(initial=0)) + 1) ** 3
    if len(words) > 1 and len(words) * codes * SPAN >= 1 << 62:  # a key is one integer
        return np.concatenate([self_kernels(words[:len(words) // 2]), self_kernels(words[len(words) // 2:])])
    w, c, v = triples(words, symbol)
    if not len(w):
        return np.zeros(len(words))
    weights = DECAY ** np.arange(1.0, SPAN + 1)
    key = (w * np.int64(codes) + c) * SPAN + (np.rint(np.log(v) / np.log(DECAY)).astype(np.int64) - 1)
    key.sort()
    pair, v = key // SPAN, weights[key % SPAN]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    return np.bincount(pair[first] // codes, np.add.reduceat(v, first) ** 2, len(words))


class Kernel:
    """Normalised kernels of words with the landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.symbol = alphabet(landmarks)
        self.base = int(self.symbol.max()) + 1
        w, c, v = triples(landmarks, self.symbol)
        pair, at = np.unique(c * len(landmarks) + w, return_inverse=True)
        value = np.bincount(at, v, len(pair)) if len(pair) else np.empty(0)
        self.norm = np.sqrt(np.bincount(pair % max(len(landmarks), 1), value**2, len(landmarks)))
        self.who, self.value = pair % max(len(landmarks), 1), value  # landmarks that have a triple, code by code
        self.value = self.value / np.maximum(self.norm, 1e-30)[self.who]
        codes, first = np.unique(pair // max(len(landmarks), 1), return_index=True)
        self.codes, self.place = codes, None
        if self.base**3 <= DENSE:
            self.place = np.zeros(self.base**3, np.int32)  # of a code among the landmarks' triples, from 1
            self.place[codes] = np.arange(1, len(codes) + 1)
        self.begin = np.concatenate([[0], first, [len(pair)]])
        self.begin[0] = self.begin[1] if len(codes) else 0

    def places(self, c: np.ndarray) -> np.ndarray:
        """Place of each code among the landmarks' triples, from 1; 0 for others."""
        if self.place is not None or not len(self.codes):
            return self.place[c] if self.place is not None else np.zeros(len(c), np.int64)
        at = np.minimum(np.searchsorted(self.codes, c), len(self.codes) - 1)
        return np.where(self.codes[at] == c, at + 1, 0)

    def values(self, words: list[str]) -> np.ndarray:
        """words x landmarks."""
        m = len(self.landmarks)
        out = np.zeros((len(words), m))
        if not words or not m:
            return out
        w, c, v = triples(words, self.symbol)
        place = self.places(c)
        hit = np.flatnonzero(place)
        w, place, v = w[hit].astype(np.int64), place[hit], v[hit]
        sizes = self.begin[place + 1] - self.begin[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        each = np.repeat(self.begin[place] - total[:-1], sizes) + np.arange(total[-1])
        out += np.bincount(np.repeat(w * m, sizes) + self.who[each], np.repeat(v, sizes) * self.value[each], len(words) * m).reshape(len(words), m)
        some = np.flatnonzero(out.any(1))
        if len(some):
            out[some] /= np.sqrt(self_kernels([words[i] for i in some.tolist()]))[:, None]
        return out


class WordKernels(SliceCache):
    """Row in ``table`` of each word's kernels; row 0 (all zeros) for words that have none."""

    def __init__(self, kernel: Kernel):
        self.kernel = kernel
        super().__init__()

    def forget(self):
        super().forget()
        self.table = np.zeros((1 << 10, len(self.kernel.landmarks)), np.float32)
        self.rows = 1

    def entries(self, data, begin, end):
        if self.rows > MAX_ROWS:
            self.forget()
        return super().entries(data, begin, end)

    def make(self, slices):
        values = np.concatenate([self.kernel.values([SKIPPED.sub("", s.decode("utf-8", "replace")) for s in slices[at:at + 4096]]) for at in range(0, len(slices), 4096)]) if slices else np.empty((0, 1))
        some = np.flatnonzero(values.any(1))
        while self.rows + len(some) > len(self.table):
            more = np.empty((2 * len(self.table), self.table.shape[1]), np.float32)
            more[:self.rows] = self.table[:self.rows]
            self.table = more
        at = np.zeros(len(slices), np.int64)
        at[some] = np.arange(self.rows, self.rows + len(some))
        self.table[self.rows:self.rows + len(some)] = values[some]
        self.rows += len(some)
        return at, np.ones(len(slices), np.int64)

    def largest(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest values of the rows from each of ``first`` to the next, PIECE rows at a time."""
        sizes = np.diff(np.append(first, len(rows)))
        parts = -(-sizes // PIECE)
        opens = np.cumsum(parts) - parts
        begin = np.repeat(first, parts) + PIECE * (np.arange(parts.sum()) - np.repeat(opens, parts))
        size = np.minimum(PIECE, np.repeat(first + sizes, parts) - begin)
        order = np.argsort(-size, kind="stable")
        begin, size = begin[order], size[order]
        out = self.table[rows[begin]]
        for k in range(1, int(size.max(initial=1))):
            n = np.searchsorted(-size, -k)  # those of more than k rows
            np.maximum(out[:n], self.table[rows[begin[:n] + k]], out=out[:n])
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        out = out[back]
        return out if (parts == 1).all() else np.maximum.reduceat(out, opens, axis=0)


def remembered(kernel: Kernel) -> WordKernels:
    """What this process has found for the landmarks, kept from task to task; those of other landmarks are dropped.

    It hangs on a module of its own, so it is never pickled with this package's code.
    """
    held = sys.modules.setdefault("crewspark_remembered", ModuleType("crewspark_remembered"))
    if getattr(held, "landmarks", None) != kernel.landmarks:
        held.landmarks, held.words = kernel.landmarks, WordKernels(kernel)
    return held.words


def bare(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, sentence) of the words of the lower-cased bytes; sentences end at line ends and at . ! ? before white space.

    Words of over LONGEST characters are read in windows of LONGEST, STEP apart.
    """
    code = np.frombuffer(data, np.uint8)
    white = WHITE[code]
    ends = (code == 10) | ENDS[code] & np.append(white[1:], True)
    inside = np.concatenate([[False], ~white, [False]])
    begin = np.flatnonzero(inside[1:] & ~inside[:-1])
    end = np.flatnonzero(inside[:-1] & ~inside[1:])
    if (end - begin > LONGEST).any():
        chars = np.append(np.flatnonzero((code & 0xC0) != 0x80), len(code))  # first byte of each character, and the end
        first, last = np.searchsorted(chars, begin), np.searchsorted(chars, end)
        parts = 1 + np.maximum(0, -(-(last - first - LONGEST) // STEP))
        opens = np.repeat(first, parts) + STEP * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        begin, end = chars[opens], chars[np.minimum(opens + LONGEST, np.repeat(last, parts))]
    return begin, end, np.cumsum(ends)[begin]


class ToxicityModel:
    """Landmark kernels, Nystroem map folded into one weight a landmark, bias, and the score's sigmoid."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        m = len(landmarks)
        value, vector = np.linalg.eigh(self.kernel.values(landmarks) if m else np.zeros((0, 0)))
        keep = value > 1e-6
        self.map = vector[:, keep] / np.sqrt(value[keep])  # kernels to Nystroem features
        self.weights, self.bias, self.a, self.b = np.ones(m), 0.0, 1.0, 0.0

    def sentences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels of the sentences that have any (nearest word by landmark), and the text of each."""
        known = remembered(self.kernel)
        raw = [t.lower().encode("utf-8", "replace") + b"\n" for t in texts]
        data = b"".join(raw)
        opens = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))])
        begin, end, sentence = bare(data)
        joined = spelt_out(data, begin, end, sentence)
        if joined:
            extra = b" ".join(w for _, w in joined)
            sizes = np.fromiter((len(w) for _, w in joined), np.int64, len(joined))
            at = len(data) + np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
            where = np.fromiter((i for i, _ in joined), np.int64, len(joined))
            owner = np.searchsorted(opens, begin[where], "right") - 1
            data, begin, end, sentence = data + extra, np.concatenate([begin, at]), np.concatenate([end, at + sizes]), np.concatenate([sentence, sentence[where]])
            text = np.concatenate([np.searchsorted(opens, begin[:-len(joined)], "right") - 1, owner])
        else:
            text = np.searchsorted(opens, begin, "right") - 1
        rows = known.gather(known.entries(data, begin, end))[0] if len(begin) else np.empty(0, np.int64)
        some = np.flatnonzero(rows)
        if not len(some):
            return np.zeros((0, len(self.kernel.landmarks)), np.float32), np.empty(0, np.int64)
        some = some[np.argsort(sentence[some], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], sentence[some][1:] != sentence[some][:-1]]))
        return known.largest(rows[some], first), text[some[first]]

    def margins(self, texts: list[str]) -> np.ndarray:
        """A text's margin is its most toxic sentence's."""
        out = np.full(len(texts), self.bias)
        phi, text = self.sentences(texts)
        np.maximum.at(out, text, phi @ self.weights + self.bias)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        parts = [self.margins(texts[at:to]) for at, to in some_texts(texts)]
        return sigmoid(self.a * np.concatenate([np.empty(0), *parts]) + self.b)

    def witnesses(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's sentence of largest margin (zeros if none has a kernel)."""
        phi, text = self.sentences(texts)
        out = [np.zeros(len(self.kernel.landmarks))] * len(texts)
        order = np.argsort(phi @ self.weights, kind="stable")
        for i in order.tolist():
            out[text[i]] = phi[i].astype(np.float64)
        return out


def spelt_out(data: bytes, begin: np.ndarray, end: np.ndarray, sentence: np.ndarray) -> list[tuple[int, bytes]]:
    """(first word, joined word) of runs of at least three fragments of one or two bytes in a sentence, cut at 24 fragments with half overlapping."""
    short = np.concatenate([[False], end - begin <= 2, [False]])
    same = np.concatenate([[False], sentence[1:] == sentence[:-1], [False]]) if len(sentence) else np.zeros(1, bool)
    starts = np.flatnonzero(short[1:-1] & ~(short[:-2] & same[:-1])) if len(begin) else np.empty(0, np.int64)
    stops = np.flatnonzero(short[1:-1] & ~(short[2:] & same[1:])) if len(begin) else np.empty(0, np.int64)
    out = []
    for a, b in zip(starts.tolist(), stops.tolist()):
        for at in range(a, max(a + 1, b - 11), 12):
            to = min(at + 24, b + 1)
            if to - at >= 3:
                out.append((at, b"".join(data[begin[i]:end[i]] for i in range(at, to))))
    return out


def unit_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function over (text, y): each different word of a text of three to LONGEST_LANDMARK characters."""
    for pdf in batches:
        for text, y in zip(pdf["text"], pdf["y"]):
            data = text.lower().encode("utf-8", "replace")
            begin, end, _ = bare(data)
            words = {SKIPPED.sub("", data[b:e].decode("utf-8", "replace")) for b, e in zip(begin.tolist(), end.tolist())}
            words = [w for w in words if 3 <= len(w) <= LONGEST_LANDMARK]
            if words:
                yield pd.DataFrame({"word": np.array(words, object), "toxic": y, "clean": 1 - y})


def choose_landmarks(counts: pd.DataFrame, n: int) -> list[str]:
    """Words most typical of toxic texts, leaving out near copies of those already chosen."""
    chosen: list[str] = []
    for word in counts.sort_values(["odds", "toxic", "word"], ascending=[False, False, True])["word"]:
        if len(chosen) >= n:
            break
        if chosen and Kernel(chosen).values([word]).max() > 0.9:
            continue
        chosen.append(word)
    return chosen


def train(sample: DataFrame) -> ToxicityModel:
    """A model from labelled rows (doc_id, text, y); without both classes no text is toxic (or all are).

    Landmarks: words that at least three toxic texts hold, by the log-odds of the classes, at
    most LANDMARKS.  Every text gives one labelled sentence, its most toxic by the model
    so far; the machine is fitted on those, twice.  The driver gets that sentence's kernels, one row a text of the
    bounded sample, and at most 64 * LANDMARKS words.
    """
    sample = stage(sample, "toxicity-sample")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        model = ToxicityModel([])
        model.b = 2.0 if sizes.get(1) else -2.0
        return model
    odds = (F.log((F.col("toxic") + 0.5) / sizes[1]) - F.log((F.col("clean") + 0.5) / sizes[0])).alias("odds")
    words = sample.select("text", "y").mapInPandas(unit_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    typical = words.where("toxic >= 3").select("*", odds).where("odds > 1.5").orderBy(F.desc("odds"), F.desc("toxic"), "word").limit(64 * LANDMARKS).toPandas()
    model = ToxicityModel(choose_landmarks(typical, LANDMARKS))
    if not model.kernel.landmarks:
        model.b = float(np.log(sizes[1] / sizes[0]))
        return model
    for _ in range(2):
        def sentences(batches, model=model):
            for pdf in batches:
                texts, out = pdf["text"].tolist(), []
                for at, to in some_texts(texts):
                    out += model.witnesses(texts[at:to])
                yield pd.DataFrame({"y": pdf["y"].to_numpy(), "phi": out})

        rows = sample.select("text", "y").mapInPandas(sentences, "y int, phi array<double>").toPandas()
        phi, y = np.stack(rows["phi"]), rows["y"].to_numpy()
        order = np.lexsort((*phi.T, y))  # the fit doesn't depend on the rows' order
        phi, y = phi[order], y[order]
        # a landmark's own word has kernel 1, which altered ones don't reach: such rows are also learnt as if it had been altered
        less = np.where(phi > 0.999, ALTERED, phi)
        other = (less != phi).any(1)
        rows_, labels_ = np.concatenate([phi, less[other]]), np.concatenate([y, y[other]])
        features = rows_ @ model.map
        every = np.arange(features.shape[1] + 1)
        w = dual_coordinate_descent([(every, np.append(f, 1.0)) for f in features], np.where(labels_ == 1, 1, -1), len(every), epochs=30)
        model.weights, model.bias = model.map @ w[:-1], float(w[-1])
        model.a, model.b = fitted_sigmoid(rows_ @ model.weights + model.bias, labels_)
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score), a row for every row of ``docs`` (doc_id, text).

    A null text counts as empty, texts are read whole, null and repeated ids pass through, other columns are
    ignored and an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.scores([t or "" for t in pdf["text"]])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, score double")


def op6_subsequence_kernel_toxicity(spark, sf_dir):
    """Toxicity score of every document, learnt from the training fold's labels; edge cases as in ``score``."""
    docs = table(spark, sf_dir, "documents")
    model = train(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", 4, 2, SAMPLE_ROWS))
    return score(docs, model).select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES = {"op6_subsequence_kernel_toxicity": op6_subsequence_kernel_toxicity}
ORACLES: dict[str, str] = {}
