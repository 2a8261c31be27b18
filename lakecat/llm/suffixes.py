"""Repeated strings in byte texts, in numpy: tiles of windows, suffix orders of shards, merged Burrows-Wheeler transforms.

Helpers of `repeats`. A window is a string of `WINDOW` bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

WINDOW = 100
#: Bytes of an anchor, and how many places of it a window has.
ANCHOR = 12
PLACES = WINDOW - ANCHOR + 1
HALF = PLACES // 2
PLACE_BITS = 24
LETTER = 4  # bytes of one letter of the transforms; divides WINDOW
DEPTH = WINDOW // LETTER

#: One tile: its anchor, its bytes' hash, where it begins, hashes of what is left and right of the anchor, its windows, the anchor's place.
TILE = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("at", "<i8"), ("left", "<u2"), ("right", "<u2"), ("windows", "u1"), ("place", "u1")])
#: `windows` consecutive windows, the first of which begins at `at`.
RUN = np.dtype([("at", "<i8"), ("windows", "<i8")])


def joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two neighbouring strings from theirs."""
    total = one * np.uint64(0x9E3779B97F4A7C15) + other
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def doubled(gram: np.ndarray, size: int) -> np.ndarray:
    """Hashes of strings of twice the size."""
    return joined(gram[:-size], gram[size:])


def tiles(data: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tiles of texts that lie behind each other in `data` (bytes); text i ends before ends[i] and begins at at[i] of the whole.

    The anchor of a window is the place of its smallest hash of `ANCHOR` bytes, the first of equal ones. It depends on
    the window's bytes alone, so equal windows have equal anchors at equal places. A tile is a run of windows with one anchor.
    """
    count = len(data) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, TILE)
    starts = np.concatenate(([0], ends[:-1]))
    with np.errstate(over="ignore"):
        one = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        two = doubled(one, 1)
        four = doubled(two, 2)
        eight = doubled(four, 4)
        gram = joined(eight[:len(data) - ANCHOR + 1], four[8:8 + len(data) - ANCHOR + 1])
        wide = doubled(doubled(eight, 8), 16) if len(data) >= 32 else np.zeros(0, np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while 2 * size <= PLACES:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    best = np.minimum(best[:count], best[PLACES - size:PLACES - size + count])
    anchor = (best & low).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), ends - starts)[:count]
    inside = np.arange(count) + WINDOW <= ends[text]
    begins = np.empty(count, bool)
    begins[0] = True
    begins[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(begins & inside)
    if not len(first):
        return np.zeros(0, TILE)
    bounds = np.concatenate((np.flatnonzero(begins | ~inside), [count]))
    last = bounds[np.searchsorted(bounds, first, "right")] - 1
    out = np.zeros(len(first), TILE)
    place = anchor[first]
    out["anchor"] = gram[place]
    out["windows"], out["place"] = last - first + 1, place - first
    out["at"] = at[text[first]] + first - starts[text[first]]
    shallow, deep = place - last, place - first  # the anchor's places in the windows
    body = data.tobytes()
    digest = xxhash.xxh3_64_intdigest
    out["content"] = np.fromiter(
        (digest(body[a:b]) for a, b in zip(first.tolist(), (last + WINDOW).tolist())), np.uint64, len(first))
    with np.errstate(over="ignore"):
        out["content"] += out["place"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for side, fits, one_at, other_at in (
                ("left", deep >= HALF, place - HALF, place - 32),
                ("right", shallow <= HALF, place, place + WINDOW - HALF - 32)):
            value = joined(wide[np.where(fits, one_at, 0)], wide[np.where(fits, other_at, 0)]) >> np.uint64(49)
            out[side] = np.where(fits, value.astype(np.uint16) + 1, 0)
    return out


def firsts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tiles sorted by anchor, content and place, and which of them are the first of their content."""
    found = found[np.lexsort((found["at"], found["content"], found["anchor"]))]
    new = np.ones(len(found), bool)
    new[1:] = (found["anchor"][1:] != found["anchor"][:-1]) | (found["content"][1:] != found["content"][:-1])
    return found, new


def doubtful(first: np.ndarray) -> np.ndarray:
    """Those of different tiles that may share a window with another one, cut to the windows that may be shared.

    A window that two tiles share has the anchor in its second half, and then they agree on the `HALF` bytes left of
    it, or in its first half, and then on those to its right.
    """
    may = {}
    for side in ("left", "right"):
        key = first["anchor"] ^ (first[side].astype(np.uint64) << np.uint64(48))
        rows = np.flatnonzero(first[side])
        order = rows[np.argsort(key[rows])]
        equal = key[order][1:] == key[order][:-1]
        may[side] = np.zeros(len(first), bool)
        may[side][order[1:][equal]] = True
        may[side][order[:-1][equal]] = True
    deepest, shallowest = first["place"].astype(np.int64), first["place"].astype(np.int64) - first["windows"] + 1
    high = np.where(may["left"], deepest, np.minimum(deepest, HALF))
    low = np.where(may["right"], shallowest, np.maximum(shallowest, HALF))
    kept = may["left"] | may["right"]
    out = first[kept].copy()
    out["at"] += (deepest - high)[kept]
    out["place"], out["windows"] = high[kept], (high - low + 1)[kept]
    return out


def runs(at: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Runs of windows, sorted, those that touch put together."""
    if not len(at):
        return np.zeros(0, RUN)
    order = np.argsort(at, kind="stable")
    at, end = at[order].astype(np.int64), (at[order] + windows[order]).astype(np.int64)
    reach = np.maximum.accumulate(end)
    new = np.concatenate(([True], at[1:] > reach[:-1]))
    begin = np.flatnonzero(new)
    out = np.zeros(len(begin), RUN)
    out["at"] = at[begin]
    out["windows"] = np.concatenate((reach[begin[1:] - 1], reach[-1:])) - out["at"]
    return out


class Shard:
    """The suffixes of some strings in order, and their Burrows-Wheeler transform in letters of four bytes.

    Every string is padded to a whole number of letters and read as a circle, so each suffix has a letter before it. The
    order is that of the first 128 bytes at least.
    """

    def __init__(self, strings: list[bytes]):
        lengths = np.array([len(s) for s in strings], np.int64)
        sizes = (lengths + LETTER) // LETTER * LETTER
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(s + bytes(int(n) - len(s)) for s, n in zip(strings, sizes)), np.uint8)
        self.string = np.repeat(np.arange(len(strings)), sizes)
        self.offset = np.arange(len(data)) - starts[self.string]
        start, size = starts[self.string], sizes[self.string]

        def ahead(by: int) -> np.ndarray:
            return start + (self.offset + by) % size

        letters = np.zeros(len(data), np.uint64)
        for i in range(LETTER):
            letters = (letters << np.uint64(8)) | data[ahead(i)].astype(np.uint64)
        key, depth = (letters << np.uint64(32)) | letters[ahead(LETTER)], 2 * LETTER
        while True:
            self.order = np.argsort(key)
            found = key[self.order]
            new = np.concatenate(([False], found[1:] != found[:-1]))
            rank = np.empty(len(key), np.uint64)
            rank[self.order] = np.cumsum(new).astype(np.uint64)
            if depth >= WINDOW or (len(new) and new[1:].all()):
                break
            key = (rank << np.uint64(32)) | rank[ahead(depth)]
            depth *= 2
        self.transform = letters[ahead(-LETTER)][self.order].astype(np.uint32)
        self.whole = self.offset + WINDOW <= lengths[self.string]


def merged(shards: list[Shard]) -> np.ndarray:
    """The block of every suffix of every shard, in the shards' orders one after the other.

    Two suffixes have one block if their first `WINDOW` bytes are equal. The transforms are interleaved, first in any
    order. One refinement moves every suffix's letter to the front, keeping the order of what follows, so after h of them the
    suffixes stand by their first h letters; a boundary between blocks is a place where the letter or the block behind it changes.
    """
    sizes = [len(s.order) for s in shards]
    transform = np.concatenate([s.transform for s in shards])
    shard = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) <= 256 else np.uint16), sizes)
    block = np.zeros(len(shard), np.int64)
    for _ in range(DEPTH):
        letter = np.empty(len(shard), np.uint32)
        letter[np.argsort(shard, kind="stable")] = transform
        order = np.argsort((letter & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
        order = order[np.argsort((letter[order] >> np.uint32(16)).astype(np.uint16), kind="stable")]
        letter, behind = letter[order], block[order]
        new = (letter[1:] != letter[:-1]) | (behind[1:] != behind[:-1])
        block = np.concatenate(([0], np.cumsum(new)))
        shard = shard[order]
    return block[np.argsort(shard, kind="stable")]


def repeated(strings: list[bytes], at: np.ndarray, shard_bytes: int = 1 << 18) -> np.ndarray:
    """The places of windows that also begin at an earlier place. String i begins at at[i]; at[i] < 2 ** 63."""
    if not strings:
        return np.zeros(0, np.int64)
    parts = np.cumsum([len(s) for s in strings]) // shard_bytes
    cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(strings)]
    shards = [Shard(strings[a:b]) for a, b in zip(cuts, cuts[1:])]
    block = merged(shards)
    whole = np.concatenate([s.whole[s.order] for s in shards])
    place = np.concatenate([at[a:b][s.string[s.order]] + s.offset[s.order] for s, a, b in zip(shards, cuts, cuts[1:])])
    block, place = block[whole], place[whole]
    order = np.lexsort((place, block))
    block, place = block[order], place[order]
    later = np.concatenate(([False], block[1:] == block[:-1])) if len(block) else np.zeros(0, bool)
    later[1:] &= place[1:] > np.minimum.reduceat(place, np.flatnonzero(~later))[np.cumsum(~later) - 1][1:]
    return np.unique(place[later])
