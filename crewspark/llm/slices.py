"""Slices of byte strings as arrays: their hashes, and their token ids looked up and remembered."""

from __future__ import annotations

import numpy as np
import xxhash

#: Multipliers of the 64-bit mixing function.
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
WHITE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
LONG_WORD = 1 << 12


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[1]
    h = (h ^ (h >> np.uint64(27))) * MIX[2]
    return h ^ (h >> np.uint64(31))


def slice_hashes(data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the slices data[begin:end], eight bytes of all of them at a time."""
    size = end - begin
    h = size.astype(np.uint64)
    room = np.frombuffer(data + b"\0" * 8, np.uint8)
    windows = np.lib.stride_tricks.as_strided(room, (len(data) + 1, 8), (1, 1))
    todo, at = np.flatnonzero((size > 0) & (size <= LONG_WORD)), 0
    while len(todo):
        part = windows[begin[todo] + at].view(np.uint64).ravel()
        left = size[todo] - at
        bits = np.where(left < 8, left * 8, 0).astype(np.uint64)
        part = np.where(left < 8, part & ((np.uint64(1) << bits) - np.uint64(1)), part)
        h[todo] = mixed(h[todo] * MIX[0] ^ part)
        todo, at = todo[left > 8], at + 8
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(data[begin[i]:end[i]])
    return h


def words_of(texts: list[str], translate: bytes | None = None) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Words of the texts after lower-casing A-Z, cut at ASCII white space (0x20, 0x09 to 0x0D).

    ``translate`` maps bytes to bytes first.  Returns their hashes, the words before each text and in all, the bytes and the words' ends.
    """
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes.lower() changes A-Z only
    data = b"\n".join(raw)
    if translate:
        data = data.translate(translate)
    opens = np.concatenate([[0], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)])
    inside = np.concatenate([[False], ~WHITE[np.frombuffer(data, np.uint8)], [False]])
    begin = np.flatnonzero(inside[1:] & ~inside[:-1])
    end = np.flatnonzero(inside[:-1] & ~inside[1:])
    return slice_hashes(data, begin, end), np.searchsorted(begin, opens), data, begin, end


def some_texts(texts: list[str], size: int = 1 << 18):
    """Ranges (from, to) of about ``size`` characters each."""
    at = 0
    while at < len(texts):
        to, held = at, 0
        while to < len(texts) and (held == 0 or held + len(texts[to]) <= size):
            held += len(texts[to])
            to += 1
        yield at, to
        at = to


SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
MAX_ENTRIES = 3 << 18


class SliceCache:
    """Ids of the slices of a byte string; ``make`` finds those of slices not met before.

    A slice of up to 15 bytes is two integers; it is looked up in a two-way table of SLOTS
    places, so a batch costs a few array operations.  A slice that loses its place is made
    again.  Everything is forgotten when there are MAX_ENTRIES entries: memory is bounded
    whatever the texts are.
    """

    def __init__(self):
        self.forget()

    def make(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices end to end, and how many each has."""
        raise NotImplementedError

    def forget(self) -> None:
        self.lo = np.zeros(SLOTS, np.uint64)
        self.hi = np.zeros(SLOTS, np.uint64)  # its top byte is the length, so no slice packs to zero
        self.at = np.zeros(SLOTS, np.int32)
        self.long: dict[bytes, int] = {}
        self.count, self.used = 0, 0
        self.flat = np.empty(1 << 16, np.int32)  # ids of all entries, and where each begins
        self.begin = np.zeros(1 << 16, np.int64)

    def learn(self, slices: list[bytes]) -> np.ndarray:
        """New entries for the slices, which differ; returns their numbers."""
        ids, sizes = self.make(slices)
        count, used = self.count + len(sizes), self.used + len(ids)
        if count >= len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros(max(count, len(self.begin)), np.int64)])
        if used > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(used, len(self.flat)), np.int32)])
        self.flat[self.used:used] = ids
        self.begin[self.count + 1:count + 1] = self.used + np.cumsum(sizes)
        numbers = np.arange(self.count, count)
        self.count, self.used = count, used
        return numbers

    def entries(self, data: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entry number of each slice data[begin:end]."""
        if self.count > MAX_ENTRIES:
            self.forget()
        size = end - begin
        out = np.empty(len(begin), np.int64)
        short = np.flatnonzero(size <= 15)
        room = np.frombuffer(data + b"\0" * 16, np.uint8)
        windows = np.lib.stride_tricks.as_strided(room, (len(data) + 1, 16), (1, 1))
        packed = windows[begin[short]].view(np.uint64).reshape(-1, 2)
        bits = (size[short] * 8).astype(np.uint64)
        low = np.where(bits < 64, (np.uint64(1) << np.minimum(bits, np.uint64(63))) - np.uint64(1), ~np.uint64(0))
        high = np.where(bits > 64, (np.uint64(1) << np.where(bits > 64, bits - np.uint64(64), np.uint64(0))) - np.uint64(1), np.uint64(0))
        lo = packed[:, 0] & low
        hi = packed[:, 1] & high | size[short].astype(np.uint64) << np.uint64(56)
        mix = lo * np.uint64(0x9E3779B97F4A7C15) ^ hi * np.uint64(0xC2B2AE3D27D4EB4F)
        one = (mix >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        two = ((mix * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        got = np.where((self.lo[one] == lo) & (self.hi[one] == hi), self.at[one], -1)
        miss = np.flatnonzero(got < 0)
        spot = two[miss]
        got[miss] = np.where((self.lo[spot] == lo[miss]) & (self.hi[spot] == hi[miss]), self.at[spot], -1)
        miss = miss[got[miss] < 0]
        if len(miss):
            order = np.lexsort((lo[miss], hi[miss]))
            l, h = lo[miss][order], hi[miss][order]
            new = np.concatenate([[True], (l[1:] != l[:-1]) | (h[1:] != h[:-1])])
            raw = np.stack([l[new], h[new]], 1).tobytes()
            made = self.learn([raw[i:i + raw[i + 15]] for i in range(0, len(raw), 16)])
            first = miss[order[new]]
            spot = np.where(self.hi[one[first]] == 0, one[first], two[first])
            # slices that meet in one place: the last write of each array is the same slice's
            self.lo[spot], self.hi[spot], self.at[spot] = l[new], h[new], made
            got[miss[order]] = made[np.cumsum(new) - 1]
        out[short] = got
        rest = np.flatnonzero(size > 15)
        if len(rest):
            slices = [data[b:e] for b, e in zip(begin[rest].tolist(), end[rest].tolist())]
            only = [s for s in dict.fromkeys(slices) if s not in self.long]
            if only:
                self.long.update(zip(only, self.learn(only).tolist()))
            out[rest] = [self.long[s] for s in slices]
        return out

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the entries end to end, how many each has, and the running total of those from 0."""
        sizes = self.begin[at + 1] - self.begin[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[np.repeat(self.begin[at] - total[:-1], sizes) + np.arange(total[-1])].astype(np.int64), sizes, total
