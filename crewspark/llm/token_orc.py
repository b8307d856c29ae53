"""Token ids as ORC: one row per document, in ascending document order.

The files keep ORC's own integer run-length encoding for the ids, row indexes (min and max
of each row group) and Bloom filters on the document id, so readers split a file by
stripes and skip stripes and row groups that cannot hold a wanted document.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path
from .common import stage, table
from .slices import WHITE, SliceCache, some_texts

END_ID = 2
SCHEMA = "doc_id long, n_tokens int, ids array<int>"
LETTERS = (np.arange(256) >= ord("a")) & (np.arange(256) <= ord("z"))
#: ASCII punctuation that always ends a run of letters and begins a part of its own (an apostrophe may not).
MARKS = np.array([32 < c < 127 and not chr(c).isalnum() and chr(c) != "'" for c in range(256)])
#: First byte of U+0300 in UTF-8; those of later code points are larger, all other bytes smaller.
LATE = 0xCC


class WordEncoder(SliceCache):
    """Ids of whole texts by the tokenizers library, a word at a time.

    The tokenizer file composes characters (NFC), drops white space, cuts letters from punctuation
    and lower-cases, so a text's ids are those of its words, cut at ASCII white space.  Below
    U+0300 nothing composes: words without a later code point are lower-cased in the Latin-1 range and also cut
    between a letter and punctuation.  Other words go to the library as they are.  It encodes each
    different part once.  A text that holds the string of an added token goes to it whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # found by the library before or after it lower-cases: looked for in either case
        self.added = [t.content.encode("utf-8").lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the file's model alone: what the other steps make of a-z words is those words
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        super().__init__()

    def words(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one unit each to the tokenizer, many of them in one call.

        A unit's last id, and no other, is of a token that ends a word.
        """
        lines = [" ".join(words[at:at + 200]) for at in range(0, len(words), 200)]
        ids = np.array([i for e in tokenizer.encode_batch_fast(lines, add_special_tokens=False) for i in e.ids], np.int64)
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) != len(words):
            raise ValueError("the tokenizer's model does not mark the ends of words")
        return ids, np.diff(last, prepend=-1)

    def make(self, slices):
        texts = [s.decode("utf-8") for s in slices]
        kind = np.fromiter((0 if s.isalpha() else 1 if t.isalpha() and max(t) < "\u0100" else 2 for s, t in zip(slices, texts)), np.int64, len(slices))
        sizes, parts = np.zeros(len(slices), np.int64), []
        for k, tokenizer in enumerate((self.plain, self.tokenizer)):
            at = np.flatnonzero(kind == k)
            ids, sizes[at] = self.words(tokenizer, [texts[i] for i in at.tolist()])
            parts.append((at, ids))
        at = np.flatnonzero(kind == 2)
        each = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in at.tolist()], add_special_tokens=False)]
        sizes[at] = [len(x) for x in each]
        parts.append((at, np.array([i for x in each for i in x], np.int64)))
        out = np.empty(sizes.sum(), np.int64)
        owner = np.repeat(kind, sizes)
        for k, (_, ids) in enumerate(parts):
            out[owner == k] = ids
        return out, sizes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many come before each text and in all."""
        raw = [t.encode("utf-8") for t in texts]
        low = [r.lower() for r in raw]  # bytes.lower() changes A-Z only
        whole = [i for i, r in enumerate(low) if any(a in r for a in self.added)]
        for i in whole:
            raw[i] = low[i] = b""
        ids, before = self.encode_words(raw, low)
        if not whole:
            return ids, before
        parts = np.split(ids, before[1:-1])
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int64)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])

    def encode_words(self, raw: list[bytes], low: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        code = np.frombuffer(b"\n".join(low), np.uint8).copy()
        opens = np.concatenate([[0], np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 1)])
        if not len(code):
            return np.empty(0, np.int64), np.zeros(len(low) + 1, np.int64)
        inside = ~WHITE[code]
        # words with a code point from U+0300 on stay as they are
        late = code >= LATE
        if late.any():
            word = np.cumsum(~inside)
            asis = np.zeros(word[-1] + 1, bool)
            asis[word[late]] = True
            asis = asis[word]
            code[asis] = np.frombuffer(b"\n".join(raw), np.uint8)[asis]
        else:
            asis = late
        # U+00C0 to U+00FF: two bytes, the first 0xC3; all letters but the signs for times and division
        second = np.flatnonzero((code[:-1] == 0xC3) & ~asis[:-1]) + 1
        sign = (code[second] == 0x97) | (code[second] == 0xB7)
        capital = second[(code[second] < 0x9F) & ~sign]
        code[capital] += 0x20
        letter, mark = LETTERS[code] & ~asis, MARKS[code] & ~asis
        ends_letter = letter.copy()
        ends_letter[second[~sign]] = True
        joined = np.zeros(len(code) + 1, bool)  # no cut before this byte
        joined[1:-1] = inside[:-1] & inside[1:] & ~(ends_letter[:-1] & mark[1:]) & ~(mark[:-1] & letter[1:])
        begin = np.flatnonzero(inside & ~joined[:-1])
        end = np.flatnonzero(inside & ~joined[1:]) + 1
        data = code.tobytes()
        ids, _, total = self.gather(self.entries(data, begin, end))
        return ids, total[np.searchsorted(begin, opens)]


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoded(path: str | None, end_id: int):
    """mapInArrow function over (doc_id, text): rows of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from crewspark.llm import token_orc  # the module's own copy keeps its caches between tasks

        coder = token_orc.word_encoder(path or token_orc.word_bpe_path())
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for at, to in some_texts(texts):
                ids, before = coder.encode(texts[at:to])
                sizes = np.diff(before) + 1
                ends = np.cumsum(sizes)
                flat = np.full(ends[-1], end_id, np.int32)
                flat[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = ids
                rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, to - at), pa.array(sizes.astype(np.int32)), rows], ["doc_id", "n_tokens", "ids"])

    return run


def write_token_ids(docs: DataFrame, out: str, path: str | None = None, end_id: int = END_ID, stride: int = 1000, fpp: float = 0.01) -> None:
    """Write the ids of ``docs`` (doc_id, text) to the folder ``out`` as ORC in ascending doc_id order.

    Files hold ascending ranges of doc_id and are sorted inside; how many there are follows
    from the data's size (adaptive partitions of the range shuffle).  ``path`` names a
    tokenizer file present on every worker.  A null text counts as empty, so its row holds
    the end id alone; a null doc_id sorts first; rows that repeat a doc_id stay, in no set
    order among themselves.  Other columns are not written.  An empty table makes no rows.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    options = {"compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": str(stride), "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": str(fpp)}
    ordered.mapInArrow(encoded(path, end_id), SCHEMA).write.options(**options).orc(out)


def read_token_ids(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files, all or those of a stated list of documents (pruned by index and Bloom filter)."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function over (doc_id, ids, file): the ids' number and checksum, read from the column's own buffer."""
    for batch in batches:
        ids = batch.column(1)
        at = ids.offsets.to_numpy().tolist()
        data = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        crc = [zlib.crc32(data[4 * b:4 * e]) for b, e in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "file", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of the documents in the files.

    start: ids of all documents before it.  Each file's documents are counted up by
    themselves; the files' totals, one row a file, give each file's own start.
    """
    rows = read_token_ids(spark, path).select("doc_id", "ids", F.col("_metadata.file_name").alias("file"))
    counts = rows.mapInArrow(digests, "doc_id long, file string, n_tokens long, ids_crc32 long")
    counts = stage(counts, "token-counts")
    files = counts.groupBy("file").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy(F.col("low").asc_nulls_first(), F.col("high").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(files, "file").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "file")


def op1_token_ids_orc(spark, sf_dir):
    """Start, count and checksum of every document's ids, read back from the ORC files; edge cases as in ``write_token_ids``."""
    out = scratch_path(spark, "token-ids")
    write_token_ids(table(spark, sf_dir, "documents"), out)
    return token_index(spark, out).drop("file")


QUERIES = {"op1_token_ids_orc": op1_token_ids_orc}
ORACLES: dict[str, str] = {}
