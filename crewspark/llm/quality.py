"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

A text is read three times: as shapes (runs of capitals, other letters or digits are one symbol
each, white space and every other character stand for themselves), as words that do or do
not repeat words just before them, and as the words themselves.  Indicators of n-grams of each are scaled by
their log-count ratio between the classes, and a linear hinge-loss model is fitted on them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import LETTER, NUMBER, SPACE, code_point_classes
from .common import crc_fold, keep_rows, stage, table
from .linear import dual_coordinate_descent, fitted_sigmoid, labelled_sample, sigmoid
from .slices import MIX, mixed, some_texts, words_of

BITS = 16  # of the places of shapes and repeats; words have as many of their own
PLACES = 2 << BITS
LONGEST = 4
#: Words of the longest word n-gram, and training texts that have to hold one for it to count.
LONGEST_WORDS, LEAST_TEXTS = 1, 5
#: Labelled training rows that a model is fitted on (expected number).
SAMPLE_ROWS = 12_000
UPPER, LOWER, DIGIT, LINE, BLANK = range(1, 6)


@cache
def shapes() -> np.ndarray:
    """Shape of each code point: a symbol below 6, or the code point itself plus 6."""
    kind = code_point_classes()
    out = np.arange(len(kind), dtype=np.int64) + 6
    letter = np.flatnonzero(kind == LETTER)
    out[letter] = LOWER
    out[[c for c in letter.tolist() if unicodedata.category(chr(c)) in ("Lu", "Lt")]] = UPPER
    out[kind == NUMBER] = DIGIT
    out[kind == SPACE] = BLANK
    out[[10, 13]] = LINE
    return out


def ngram_places(symbols: np.ndarray, begin: np.ndarray, salt: int, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed place) of every n-gram of one to ``longest`` symbols; texts begin at ``begin``."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    texts, places = [], []
    h = np.full(len(symbols), np.uint64(salt))
    for n in range(1, longest + 1):
        h = mixed(h[:max(len(symbols) - n + 1, 0)] * MIX[0] + symbols[n - 1:].astype(np.uint64))
        if not len(h):
            break
        inside = owner[:len(h)] == owner[n - 1:]
        texts.append(owner[:len(h)][inside])
        places.append((h[inside] >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate([np.empty(0, np.int64), *texts]), np.concatenate([np.empty(0, np.int64), *places])


def indicators(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams that each text has, ascending, and where each text's begin (and the end)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    symbol = shapes()[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(symbol), bool)
    keep[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] > DIGIT)
    keep[begin[:-1][sizes > 0]] = True
    t1, p1 = ngram_places(symbol[keep], np.concatenate([[0], np.cumsum(keep)])[begin], 1)
    h, before, *_ = words_of(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(before))
    repeat = np.zeros(len(h), np.int64)
    for back in (4, 3, 2, 1):  # the same word just before, or two to four words before
        same = np.flatnonzero((h[back:] == h[:-back]) & (owner[back:] == owner[:-back])) + back if len(h) > back else np.empty(0, np.int64)
        repeat[same] = 1 if back == 1 else 2
    t2, p2 = ngram_places(repeat, before, 2)
    t3, p3 = ngram_places(h, before, 3, LONGEST_WORDS)
    seen = np.zeros((len(texts), PLACES), bool)
    seen[t1, p1] = True
    seen[t2, p2] = True
    seen[t3, p3 + (1 << BITS)] = True
    flat = np.flatnonzero(seen.ravel())
    return flat % PLACES, np.searchsorted(flat, np.arange(len(texts) + 1) * PLACES)


class QualityModel:
    """Weights by place (class log-count ratio times hinge-loss weight), a bias and the score's sigmoid."""

    def __init__(self, weights: np.ndarray, ratio: np.ndarray, bias: float):
        self.weights, self.ratio, self.bias, self.a, self.b = weights, ratio, bias, 1.0, 0.0

    def margins(self, texts: list[str]) -> np.ndarray:
        out = [np.empty(0)]
        for at, to in some_texts(texts, 1 << 19):
            for low in range(at, to, 256):  # rows of the indicator table
                part = texts[low:min(low + 256, to)]
                places, begin = indicators(part)
                sums = np.zeros((2, len(part)))
                some = np.flatnonzero(np.diff(begin))
                if len(some):
                    first = begin[:-1][some]
                    sums[0, some] = np.add.reduceat(self.weights[places], first)
                    sums[1, some] = np.add.reduceat(self.ratio[places] ** 2, first)
                out.append(sums[0] / np.sqrt(np.maximum(sums[1], 1e-12)) + self.bias)
        return np.concatenate(out)

    def scores(self, texts: list[str]) -> np.ndarray:
        return sigmoid(self.a * self.margins(texts) + self.b)


def sample_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """mapInPandas function over (text, y): how many of the partition's texts of each class have each place."""
    count = np.zeros((2, PLACES), np.int64)
    for pdf in batches:
        for low in range(0, len(pdf), 256):
            part = pdf.iloc[low:low + 256]
            places, begin = indicators(part["text"].tolist())
            np.add.at(count, (np.repeat(part["y"].to_numpy(), np.diff(begin)), places), 1)
    y, place = np.nonzero(count)
    yield pd.DataFrame({"y": y, "place": place, "n": count[y, place]})


def sample_indicators(useful: np.ndarray):
    """mapInPandas function over (text, y): the useful places that each text has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for low in range(0, len(pdf), 256):
                part = pdf.iloc[low:low + 256]
                places, begin = indicators(part["text"].tolist())
                each = [places[b:e] for b, e in zip(begin[:-1], begin[1:])]
                yield pd.DataFrame({"y": part["y"].to_numpy(), "places": [x[useful[x]].astype("<i4").tobytes() for x in each]})

    return run


def train(sample: DataFrame) -> QualityModel:
    """A model from labelled rows (text, y); without both classes every text gets the same score.

    Places are counted in Spark, at most 2 * PLACES sums.  Those that tell the classes apart are then gathered on the
    driver, row by row, for the fit: ``sample`` is bounded by whoever chose it (SAMPLE_ROWS).
    """
    sample = stage(sample.select("text", "y"), "quality-sample")
    sums = sample.mapInPandas(sample_counts, "y int, place int, n long").groupBy("y", "place").agg(F.sum("n").alias("n")).toPandas()
    rows_of = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    if len(rows_of) < 2:
        model = QualityModel(np.zeros(PLACES), np.zeros(PLACES), 0.0)
        model.b = 0.0 if not rows_of else 2.0 if 1 in rows_of else -2.0
        return model
    count = np.ones((2, PLACES))
    count[sums["y"], sums["place"]] += sums["n"]
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    held = (count - 1).sum(0)
    ratio[(held == 0) | ((held < LEAST_TEXTS) & (np.arange(PLACES) >= 1 << BITS))] = 0
    rows = sample.mapInPandas(sample_indicators(ratio != 0), "y int, places binary").toPandas()
    rows = rows.sort_values(["places", "y"], kind="stable")  # the fit doesn't depend on the rows' order
    label = rows["y"].to_numpy()
    data = []
    for raw in rows["places"]:
        at = np.frombuffer(raw, "<i4")
        v = ratio[at]
        v = (v / max(np.sqrt(v @ v), 1e-6)).astype(np.float32)
        data.append((np.append(at, PLACES).astype(np.int32), np.append(v, np.float32(1.0))))  # the last place is the bias
    del rows
    w = dual_coordinate_descent(data, np.where(label == 1, 1, -1), PLACES + 1)
    model = QualityModel(w[:-1] * ratio, ratio, float(w[-1]))
    margins = np.array([w[at] @ v for at, v in data])
    model.a, model.b = fitted_sigmoid(margins, label)
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score), a row for every row of ``docs`` (doc_id, text).

    A null text counts as empty, texts are read whole, null and repeated ids pass through, other columns are
    ignored and an empty table gives an empty result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": model.scores([t or "" for t in pdf["text"]])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, score double")


def fitted(spark, docs: DataFrame, sf_dir: str) -> QualityModel:
    return train(labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", 3, 1, SAMPLE_ROWS))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents go whose text scores below 0.5; empty and null texts are scored like others, every column stays."""
    model = fitted(spark, docs, sf_dir)
    return keep_rows(docs, lambda texts: model.scores(texts) >= 0.5)


def op2_nb_svm_quality(spark, sf_dir):
    """Quality score of every document, learnt from the training fold's labels; edge cases as in ``score``."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fitted(spark, docs, sf_dir)).select("doc_id", (crc_fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op2_nb_svm_quality": op2_nb_svm_quality}
ORACLES: dict[str, str] = {}
