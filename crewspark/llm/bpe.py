"""Byte-level BPE encoding and decoding, vectorised over a batch of texts.

Pre-tokenisation uses no regular expression.  Each code point becomes a symbol (its class,
and for white space and apostrophes what follows); each symbol is a function from scanner
state to scanner state; a prefix scan with function composition, which is associative,
gives the state before every code point and so every boundary.  Slices of up to 15 bytes
are packed into two integers and looked up as arrays; the merges of a new slice run for
many slices at once, and its ids are remembered.  Byte offsets of tokens are kept.

The scanner accepts the language of this fixed pattern, a published constant:
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table
from .slices import SliceCache, some_texts

LETTER, NUMBER, OTHER, SPACE = range(4)

# Scanner states: at a boundary, in white space, after a space that joins what follows,
# in letters, in numbers, in other characters, before the last / last two contraction letters.
BOUNDARY, WHITE, JOINED, LETTERS, NUMBERS, OTHERS, LAST1, LAST2 = range(8)
# Symbols: letter, number, other, apostrophe before s t m d, apostrophe before re ve ll,
# white space that white space or the end follows, a run's last white space (not a space), a run's last space.
L, N, P, SHORT, LONG, W, X, S = range(8)


@cache
def code_point_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other.

    Asked of the tiktoken library, whose Unicode version decides what its patterns match: it gives back
    the bytes of the characters that a pattern finds among all of them.
    """
    import tiktoken

    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        finder = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        out[np.frombuffer(bytes(finder.encode_ordinary(every)).decode().encode("utf-32-le"), np.uint32)] = kind
    return out


def step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a token begins at this code point)."""
    if state == LAST2:
        return LAST1, False
    if state == LAST1:
        return BOUNDARY, False
    if symbol == W:
        return WHITE, state != WHITE
    if symbol in (X, S):
        return (BOUNDARY if symbol == X else JOINED), True
    if state == JOINED or state == OTHERS:
        if symbol in (P, SHORT, LONG):
            return OTHERS, False
    if symbol in (SHORT, LONG):
        return (LAST1 if symbol == SHORT else LAST2), True
    into = {L: LETTERS, N: NUMBERS, P: OTHERS}[symbol]
    return into, state not in (into, JOINED)


@cache
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Element of each symbol (then of each symbol that opens a text), products, images of BOUNDARY, begin flags."""
    symbols = [tuple(step(s, x)[0] for s in range(8)) for x in range(8)]
    opening = [(step(BOUNDARY, x)[0],) * 8 for x in range(8)]
    elements = list(dict.fromkeys([tuple(range(8)), *symbols, *opening]))
    at = 0
    while at < len(elements):  # close under composition with the generators
        for g in [*symbols, *opening]:
            made = tuple(g[s] for s in elements[at])
            if made not in elements:
                elements.append(made)
        at += 1
    index = {e: i for i, e in enumerate(elements)}
    product = np.array([[index[tuple(g[s] for s in f)] for g in elements] for f in elements], np.uint16)
    start = np.array([index[e] for e in [*symbols, *opening]], np.uint16)
    image = np.array([e[BOUNDARY] for e in elements], np.uint8)
    begins = np.array([[step(s, x)[1] for x in range(8)] for s in range(8)])
    return start, product, image, begins


def scan(elements: np.ndarray, product: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix products of monoid elements, in rows of ``width`` and then over the rows."""
    n, m = len(elements), np.uint32(len(product))
    if n <= width:
        out = elements.copy()
        for i in range(1, n):
            out[i] = product[out[i - 1], out[i]]
        return out
    flat = product.ravel()
    rows = -(-n // width)
    grid = np.zeros((width, rows), np.uint16)  # transposed: a column of the text's rows is contiguous
    padded = np.zeros(rows * width, np.uint16)
    padded[:n] = elements
    grid[:] = padded.reshape(rows, width).T
    for i in range(1, width):
        grid[i] = flat[grid[i - 1] * m + grid[i]]
    ends = scan(grid[-1].copy(), product, width)
    before = np.concatenate([[0], ends[:-1]]).astype(np.uint32)  # element 0 is the identity
    for i in range(width):
        grid[i] = flat[before * m + grid[i]]
    return grid.T.reshape(-1)[:n]


def boundaries(points: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Positions in ``points`` (code points of texts laid end to end) where a token begins.

    ``opens``: positions where a text begins.
    """
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    start, product, image, begins = monoid()
    kind = code_point_classes()[points]
    first = np.zeros(n + 1, bool)
    first[opens] = True
    first[n] = True
    symbol = kind.copy()  # letter, number and other have the numbers of L, N and P
    white = kind == SPACE
    white_next = np.zeros(n, bool)
    white_next[:-1] = white[1:]
    white_next |= first[1:]  # the end of a text counts as white space
    symbol[white] = np.where(white_next[white], W, np.where(points[white] == 32, S, X))
    quote = np.flatnonzero(points == 39)
    if len(quote):
        near = lambda k: np.where((quote + k < n), points[np.minimum(quote + k, n - 1)], 0)
        one, two = near(1), near(2)
        in1 = ~first[np.minimum(quote + 1, n)]
        in2 = in1 & ~first[np.minimum(quote + 2, n)]
        symbol[quote[in1 & np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = in2 & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        symbol[quote[pair]] = LONG
    elements = start[symbol + 8 * first[:n].astype(np.uint8)]
    after = image[scan(elements, product)]
    before = np.concatenate([[BOUNDARY], after[:-1]])
    before[first[:n]] = BOUNDARY
    return np.flatnonzero(begins[before, symbol])


class Encoder(SliceCache):
    """Ids of byte slices by merge ranks, remembered; ``ranks`` maps bytes to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.width = np.array([len(t) for t in self.tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)  # of all tokens, and where each begins
        self.opens = np.cumsum(self.width) - self.width
        self.single = np.full(256, -1, np.int64)
        for c in range(256):
            self.single[c] = ranks.get(bytes([c]), -1)
        # every merge (left id, right id) -> id, as a sorted array of packed pairs
        packed, made = [], []
        for token, i in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    packed.append(left << 32 | right)
                    made.append(i)
        order = np.argsort(np.array(packed, np.int64), kind="stable")
        self.pairs = np.array(packed, np.int64)[order]
        self.made = np.array(made, np.int64)[order]
        bits = 20
        self.shift = np.uint64(64 - bits)
        self.slot = np.full(1 << bits, -1, np.int32)  # an open-addressed table of the pairs
        self.mask = (1 << bits) - 1
        free = np.arange(len(self.pairs))
        where = self.home(self.pairs)
        self.probes = 0
        while len(free):
            taken = self.slot[where]
            empty = taken < 0
            self.slot[where[empty]] = free[empty]
            lost = self.slot[where] != free
            free, where = free[lost], (where[lost] + 1) & self.mask
            self.probes += 1
        super().__init__()

    def home(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each adjacent pair merges into; a large number if none."""
        pair = left << 32 | right
        out = np.full(len(pair), 1 << 40, np.int64)
        todo, where = np.arange(len(pair)), self.home(pair)
        for _ in range(self.probes):
            at = self.slot[where]
            hit = (at >= 0) & (self.pairs[at] == pair[todo])
            out[todo[hit]] = self.made[at[hit]]
            go = (at >= 0) & ~hit
            todo, where = todo[go], (where[go] + 1) & self.mask
            if not len(todo):
                break
        return out

    def merge_many(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices end to end and how many each has: its lowest-ranked adjacent pair merges, leftmost first, until none is left.

        All slices advance together, a merge each per round, over linked lists in flat arrays.
        """
        sizes = np.fromiter(map(len, slices), np.int64, len(slices))
        ids = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        owner = np.repeat(np.arange(len(slices)), sizes)
        into = np.full(len(ids), 1 << 40, np.int64)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        into[inner] = self.merged(ids[inner], ids[inner + 1])
        while True:
            best = np.minimum.reduceat(into, starts[:-1][: len(slices)]) if len(ids) else into
            live = np.flatnonzero(best < 1 << 40)
            if not len(live):
                break
            hit = np.flatnonzero(into == best[owner])
            hit = hit[into[hit] < 1 << 40]
            hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])]  # leftmost of each slice
            ids[hit] = into[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            spot = np.cumsum(keep)[hit] - 1  # where the merged ids lie once the right halves are gone
            ids, owner, into = ids[keep], owner[keep], into[keep]
            sizes = np.bincount(owner, minlength=len(slices))
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for at in (spot - 1, spot):
                at = at[at >= 0]
                inside = at + 1 < len(ids)
                same = np.zeros(len(at), bool)
                same[inside] = owner[at[inside]] == owner[at[inside] + 1]
                into[at[same]] = self.merged(ids[at[same]], ids[at[same] + 1])
                lone = at[~same]
                into[lone] = 1 << 40
        return ids, sizes

    def make(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        whole = np.fromiter((self.ranks.get(s, -1) for s in slices), np.int64, len(slices))
        sizes = np.ones(len(slices), np.int64)
        parts: dict[int, np.ndarray] = {}
        rest = np.flatnonzero(whole < 0).tolist()
        for i in rest:
            if len(slices[i]) > 256:
                parts[i] = self.merge_long(slices[i])
        rest = [i for i in rest if len(slices[i]) <= 256]
        for at in range(0, len(rest), 1 << 14):
            some = rest[at:at + (1 << 14)]
            ids, many = self.merge_many([slices[i] for i in some])
            sizes[some] = many
            parts.update(zip(some, np.split(ids, np.cumsum(many)[:-1])))
        for i, ids in parts.items():
            sizes[i] = len(ids)
        out = np.repeat(whole, sizes)
        if parts:
            order = sorted(parts)
            out[np.repeat(whole < 0, sizes)] = np.concatenate([parts[i] for i in order])
        return out, sizes

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long slice, by a heap: n log n in its length."""
        import heapq

        ids = [int(self.single[c]) for c in piece]
        nxt, prv = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        text, ranks = [self.tokens[i] for i in ids], self.ranks
        heap = [(r, i, i + 1, text[i] + text[i + 1]) for i in range(len(ids) - 1) if (r := ranks.get(text[i] + text[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j, joined = heapq.heappop(heap)
            if nxt[i] != j or text[i] is None or text[j] is None or text[i] + text[j] != joined:
                continue
            text[i], text[j] = joined, None
            nxt[i] = nxt[j]
            if nxt[i] >= 0:
                prv[nxt[i]] = i
                if (q := ranks.get(joined + text[nxt[i]])) is not None:
                    heapq.heappush(heap, (q, i, nxt[i], joined + text[nxt[i]]))
            if prv[i] >= 0 and (q := ranks.get(text[prv[i]] + joined)) is not None:
                heapq.heappush(heap, (q, prv[i], i, text[prv[i]] + joined))
        return np.array([ranks[t] for t in text if t is not None], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts end to end, tokens before each text (and in all), byte offset of each token in the joined texts."""
        data = "".join(texts).encode("utf-8")
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        chars = np.fromiter(map(len, texts), np.int64, len(texts))
        opens = np.concatenate([[0], np.cumsum(chars)])
        begin = boundaries(points, opens[:-1][chars > 0])
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        first = byte_at[begin]
        at = self.entries(data, first, np.concatenate([first[1:], [len(data)]]) if len(first) else first)
        ids, sizes, total = self.gather(at)
        before = total[np.searchsorted(begin, opens)]
        # a token lies as far behind its slice's begin as the slice's tokens before it are long
        wide = self.width[ids]
        run = np.cumsum(wide) - wide
        return ids, before, np.repeat(first - run[total[:-1]], sizes) + run if len(ids) else run

    def decode(self, ids: np.ndarray, before: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Bytes of each text, every token's put at its offset; ``before`` and ``offsets`` as encode() returns them."""
        wide = self.width[ids]
        run = np.cumsum(wide) - wide
        within = np.arange(wide.sum()) - np.repeat(run, wide)
        size = int((offsets + wide).max()) if len(ids) else 0
        data = np.zeros(size, np.uint8)
        data[np.repeat(offsets, wide) + within] = self.bytes[np.repeat(self.opens[ids], wide) + within]
        whole, at = data.tobytes(), np.concatenate([offsets, [size]])[before].tolist()
        return [whole[b:e] for b, e in zip(at[:-1], at[1:])]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks from the text of a rank file: base64 token, space, rank on each line."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@cache
def encoder(path: str) -> Encoder:
    with open(path, "rb") as f:
        return Encoder(read_ranks(f.read()))


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


EXTRA = {"ids": "array<int>", "offsets": "array<long>", "decoded": "string"}


def encoded(path: str | None, extra: tuple[str, ...]):
    """mapInPandas function over (doc_id, text): counts, digests and the extra columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from crewspark.llm import bpe  # the module's own copy keeps its caches between tasks

        coder = bpe.encoder(path or bpe.byte_bpe_path())
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for at, to in some_texts(texts):
                ids, before, offsets = coder.encode(texts[at:to])
                words = ids.astype("<u4")
                parts = [words[b:e] for b, e in zip(before[:-1], before[1:])]
                backs = coder.decode(ids, before, offsets)
                out = pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[at:to].to_numpy(), "n_tokens": np.diff(before),
                    "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in parts],
                    "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in backs],
                })
                if "ids" in extra:
                    out["ids"] = [x.astype(np.int32) for x in parts]
                if "offsets" in extra:
                    out["offsets"] = [offsets[b:e] - (offsets[b] if e > b else 0) for b, e in zip(before[:-1], before[1:])]
                if "decoded" in extra:
                    out["decoded"] = [b.decode("utf-8") for b in backs]
                yield out

    return run


def encode_decode(docs: DataFrame, path: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for every row of ``docs`` (doc_id, text).

    ``extra`` may name ids (array<int>), offsets (array<long>: the byte of the text at which each
    token begins) and decoded (the text that ids and offsets give back).
    ``path`` names a rank file present on every worker (by default the installed public
    one).  A null text counts as empty: no tokens, the digests of no bytes.  Null ids and
    repeated rows pass through; extra columns are ignored; texts of any length are encoded
    whole, an empty table gives an empty result.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + "".join(f", {name} {EXTRA[name]}" for name in EXTRA if name in extra)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(encoded(path, extra), schema)


def encode_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document left, with its token ids, their count and the digests.

    Null texts, null or repeated ids and empty tables as in ``encode_decode``.
    """
    small_batches(spark)
    return encode_decode(docs, extra=("ids",))


def op7_byte_bpe(spark, sf_dir):
    """Token counts, id digests and round-trip digests of every document; edge cases as in ``encode_decode``."""
    return encode_decode(table(spark, sf_dir, "documents"))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLES: dict[str, str] = {}
