"""Difference covers, substring hashes and blockwise suffix sorting over a block of texts.

A difference cover of modulus v is a set of residues in which every difference mod v occurs. Of any
two positions, both therefore reach a position of the cover after the same number of bytes, less
than v: the sample at cover residues is sparse, yet wherever two strings of at least v + k - 1 bytes
agree, two samples of k bytes agree inside them.
"""

from __future__ import annotations

from functools import cached_property, lru_cache

import numpy as np

# Perfect difference sets by their modulus: fixed values.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (3, 6, 7, 12, 14),
    31: (1, 5, 11, 24, 25, 27),
    57: (1, 6, 7, 9, 19, 38, 42, 49),
}
SEED = 20240501
# Positions whose substrings are compared as numbers at the same time.
SLICE = 1 << 18
NO_ID = np.int64(np.iinfo(np.int64).max)


def cover_of(length: int) -> int:
    """The largest modulus whose samples keep at least as many bytes of a string of `length`."""
    return max(v for v in COVERS if v <= (length + 1) // 2 or v == 1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the high bits of a product over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


@lru_cache(4)
def _powers(factor: int, size: int) -> np.ndarray:
    """The powers of a number modulo 2 ** 64, at least `size` of them."""
    powers = np.full(size, np.uint64(factor))
    powers[0] = 1
    return np.multiply.accumulate(powers)


class Hash:
    """64-bit hashes of all substrings of a byte array, from one pass over it.

    A byte's random number is multiplied by a falling power of an odd number before it is summed, so
    the difference of two sums, times a rising power, does not depend on the place.
    """

    def __init__(self, data: np.ndarray, number: int):
        draw = np.random.default_rng([SEED, number])
        table = draw.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        factor = int(draw.integers(1 << 60, 1 << 61)) * 8 + 5
        # Blocks of like sizes use the same powers.
        size = 1 << max(20, len(data).bit_length())
        self.rising = _powers(factor, size)
        falling = _powers(pow(factor, -1, 1 << 64), size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(table[data], falling[: len(data)], out=self.sums[1:])
        np.cumsum(self.sums, out=self.sums)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.rising[starts])


class Block:
    """Texts one after the other, the ids of their rows, and what is asked of their positions.

    `length` is the number of bytes of the strings that are compared, the windows.
    """

    def __init__(self, data: bytes, sizes: np.ndarray, ids: np.ndarray, length: int):
        self.data, self.length = np.frombuffer(data, np.uint8), length
        self.sizes, self.ids = sizes.astype(np.int64), ids
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.modulus = cover_of(length)
        self.reach = length - self.modulus + 1

    @cached_property
    def text_of(self) -> np.ndarray:
        """The number of the text at each position."""
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    @cached_property
    def place(self) -> np.ndarray:
        """Each position counted from its text's start."""
        kind = np.int32 if len(self.data) < 1 << 31 else np.int64
        starts = np.repeat(self.starts.astype(kind), self.sizes)
        return np.subtract(np.arange(len(self.data), dtype=kind), starts, out=starts)

    @cached_property
    def room(self) -> np.ndarray:
        """Bytes from each position to its text's end."""
        return np.repeat(self.sizes.astype(self.place.dtype), self.sizes) - self.place

    @cached_property
    def windows(self) -> np.ndarray:
        """Whether a whole window starts at each position."""
        return self.room >= self.length

    @cached_property
    def first(self) -> Hash:
        return Hash(self.data, 1)

    @cached_property
    def second(self) -> Hash:
        return Hash(self.data, 2)

    def keys(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each substring."""
        return self.first.of(starts, ends), self.second.of(starts, ends)

    def ids_at(self, positions: np.ndarray) -> np.ndarray:
        return self.ids[self.text_of[positions]]

    def samples(self, wanted: np.ndarray | None) -> np.ndarray:
        """The cover positions, counted within a text, that a window can be told by.

        `wanted` narrows them to those inside the first bytes of these windows.
        """
        of_cover = np.isin(np.arange(self.modulus), COVERS[self.modulus])
        chosen = of_cover[self.place % self.modulus] & (self.room >= self.reach)
        if wanted is not None:
            chosen &= _any_of_last(wanted, self.modulus)
        return np.flatnonzero(chosen)

    def windows_with(self, samples: np.ndarray) -> np.ndarray:
        """Windows with at least one of these samples among the cover positions that tell them."""
        marks = np.zeros(len(self.data), bool)
        marks[samples] = True
        return self.windows & _any_of_last(marks[::-1], self.modulus)[::-1]

    def chunks(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, end of its last window) of chunks that end by content.

        Chunks begin at a text's start and where the hash of the 8 bytes before has `bits` zero bits.
        """
        at = np.flatnonzero(self.place >= 8)
        cut = (self.first.of(at - 8, at) & np.uint64((1 << bits) - 1)) == 0
        begins = np.zeros(len(self.data) + 1, bool)
        begins[at[cut]] = True
        begins[self.starts[self.sizes > 0]] = True
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(self.data))[: len(starts)]
        last = self.ends[self.text_of[starts]]
        return starts, ends, np.minimum(ends + self.length - 1, last)


def _any_of_last(marks: np.ndarray, count: int) -> np.ndarray:
    """Whether one of the last `count` positions, this one included, is marked."""
    sums = np.cumsum(marks, dtype=np.int32 if len(marks) < 1 << 31 else np.int64)
    some = sums > 0
    some[count:] = sums[count:] > sums[:-count]
    return some


def covered(marks: np.ndarray, length: int) -> np.ndarray:
    """Bytes inside a marked window."""
    return _any_of_last(marks, length)


def _words(data: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """The first `depth` bytes at each position as rows of big-endian numbers, zero-padded."""
    width = -(-depth // 8) * 8
    padded = np.concatenate((data, np.zeros(max(COVERS) + width, np.uint8)))
    cells = np.lib.stride_tricks.sliding_window_view(padded, width)[positions].copy()
    cells[:, depth:] = 0
    return cells.view(">u8").astype(np.uint64)


def _sorted_rows(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, whether each row in that order differs from the one before).

    Rows are sorted by their first word; each further word sorts what is level so far.
    """
    order = np.argsort(words[:, 0])
    first = words[order, 0]
    new = np.ones(len(order), bool)
    new[1:] = first[1:] != first[:-1]
    for depth in range(1, words.shape[1]):
        level = ~new
        level[:-1] |= ~new[1:]
        level = np.flatnonzero(level)
        if not len(level):
            break
        group = np.cumsum(new)[level]
        rows = order[level]
        word = words[rows, depth]
        sort = np.lexsort((word, group))
        order[level], word = rows[sort], word[sort]
        new[level[1:]] |= word[1:] != word[:-1]
    return order, new


class Ranks:
    """Ranks of the cover samples near some positions of a block, by their first `depth` bytes."""

    def __init__(self, data: np.ndarray, positions: np.ndarray, modulus: int, depth: int):
        self.modulus = modulus
        residues = np.array(COVERS[modulus])
        inside = np.zeros(modulus, bool)
        inside[residues] = True
        steps = np.arange(modulus)
        # The least step after which positions of two residues both are at cover residues.
        both = inside[(steps[:, None] + steps) % modulus]
        self.step = (both[:, None, :] & both[None, :, :]).argmax(2)
        near = np.zeros(len(data) + modulus, bool)
        for step in range(modulus):
            near[positions + step] = True
        near &= np.resize(inside, len(near))
        samples = np.flatnonzero(near)
        self.rank = np.zeros(len(near), np.int32 if len(near) < 1 << 31 else np.int64)
        order, new = _sorted_rows(_words(data, samples, depth))
        self.rank[samples[order]] = np.cumsum(new)

    def at(self, positions: np.ndarray) -> np.ndarray:
        return self.rank[positions]


def sorted_windows(block: Block, positions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order, whether each window differs from the one before).

    One bucket of suffixes, those of one first byte, is sorted at a time: by as many bytes as the
    cover's modulus, and longer ties by the ranks of the samples that both suffixes reach. Suffixes
    of one residue reach theirs after the same step and need no comparison of pairs; one suffix of
    each rank then stands for them among the residues of the tie.
    """
    if not len(positions):
        return positions, np.zeros(0, bool)
    data, modulus = block.data, block.modulus
    ranks = Ranks(data, positions, modulus, block.length)
    own_step = ranks.step.diagonal()
    ordered = []
    firsts = data[positions]
    for first in np.unique(firsts):
        bucket = positions[firsts == first]
        order, new = _sorted_rows(_words(data, bucket, modulus))
        bucket, tie = bucket[order], np.cumsum(new) - 1
        residue = bucket % modulus
        rank = ranks.at(bucket + own_step[residue])
        order = np.lexsort((rank, residue, tie))
        bucket, tie, residue, rank = (x[order] for x in (bucket, tie, residue, rank))
        fresh = np.ones(len(bucket), bool)
        fresh[1:] = (
            (tie[1:] != tie[:-1]) | (residue[1:] != residue[:-1]) | (rank[1:] != rank[:-1])
        )
        ordered.append(_merged(bucket, tie, fresh, ranks))
    positions = np.concatenate(ordered)
    differs = np.ones(len(positions), bool)
    for start in range(1, len(positions), SLICE):
        words = _words(data, positions[start - 1 : start + SLICE], block.length)
        differs[start : start + SLICE] = (words[1:] != words[:-1]).any(1)
    return positions, differs


def _merged(bucket: np.ndarray, tie: np.ndarray, fresh: np.ndarray, ranks: Ranks) -> np.ndarray:
    """A bucket's suffixes with the residues of every tie merged by comparing sample ranks.

    All ties are sorted at once: each is split into what is below, level with and above its first
    suffix, and the parts on both sides are split again.
    """
    heads = np.flatnonzero(fresh)
    lengths = np.diff(np.append(heads, len(bucket)))
    order, part = np.arange(len(heads)), tie[heads]
    left = np.arange(len(heads))
    while len(left):
        own = part[left]
        new = np.concatenate(([True], own[1:] != own[:-1]))
        pivot = left[np.flatnonzero(new)][np.cumsum(new) - 1]
        a, b = bucket[heads[order[left]]], bucket[heads[order[pivot]]]
        step = ranks.step[a % ranks.modulus, b % ranks.modulus]
        side = np.sign(ranks.at(a + step) - ranks.at(b + step))
        sort = np.lexsort((side, own))
        order[left] = order[left[sort]]
        own, side = own[sort], side[sort]
        split = np.ones(len(left), bool)
        split[1:] = (own[1:] != own[:-1]) | (side[1:] != side[:-1])
        part[left] = left[np.flatnonzero(split)][np.cumsum(split) - 1]
        sizes = np.diff(np.append(np.flatnonzero(split), len(left)))
        left = left[(side != 0) & (np.repeat(sizes, sizes) > 1)]
    lengths = lengths[order]
    offsets = np.repeat(heads[order] - (np.cumsum(lengths) - lengths), lengths)
    return bucket[offsets + np.arange(len(bucket))]
