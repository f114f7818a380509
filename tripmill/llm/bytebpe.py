"""Byte-level BPE by ranks, in numpy matrices.

Texts are cut into pieces by a pattern; the distinct pieces a worker has not met yet are merged
together. Pieces of similar length stand as rows of one padded matrix of token ids. In each round
every row merges its leftmost pair of minimum rank; pair ranks come from an open-addressing hash
table over (left id, right id). Merged cells are closed up, finished rows leave the matrix.

Only distinct pieces are Python objects: pieces are slices of a group's bytes, told apart by Arrow,
and ids and decoded texts are taken from tables of pieces and tokens.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import map_batches, paused_collector, row_groups, without

NO_RANK = np.int32(2**31 - 1)
EMPTY = np.uint64(2**64 - 1)
HASH_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Cells of one matrix of ids.
MATRIX_CELLS = 1 << 18
# Longer pieces are merged one by one with a heap, whose cost is not quadratic in the length.
LONGEST_ROW = 256
# Pieces whose ids a worker remembers; reaching it only costs time.
REMEMBERED = 250_000
# Texts beyond this many bytes are cut into pieces as a stream.
STREAMED_CHARS = 1 << 20
STREAMED_PIECES = 1 << 17
# A pattern whose pieces follow from the classes of characters, so that no text is searched for them.
CLASS_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
OTHER, LETTER, NUMBER, BLANK = range(4)
SPACE, APOSTROPHE = map(ord, " '")


def read_ranks(path: str) -> bytes:
    """A rank file as it is: lines of base64 token and rank. Some hundred kilobytes."""
    with open(path, "rb") as file:
        return file.read()


class PairTable:
    """(left id, right id) -> rank of the merged token, by linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, EMPTY, np.uint64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int32)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == EMPTY]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]] = keys[placed]
            self.ranks[slots[placed]] = ranks[placed]
            left = left[self.keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * HASH_FACTOR) >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_RANK where a pair does not merge. Ids are not negative."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((found != keys) & (found != EMPTY))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != EMPTY)]
        return out


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point, as the library of the patterns has it."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    classes = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for found in regex.finditer(pattern, every):
            classes[found.start() : found.end()] = kind
    return classes


def code_points(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)


def char_offsets(data: np.ndarray) -> np.ndarray:
    """The byte at which each character begins."""
    return np.flatnonzero((data & 0xC0) != 0x80)


def class_cuts(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Offsets of the pieces by `CLASS_PATTERN` of texts that begin at the offsets `edges`.

    A piece is a run of one class, but the last of several blanks before something else stands
    alone, or is the first of the next piece if it is a space, and an apostrophe that begins a piece
    takes one of the endings with it.
    """
    if not len(data):
        return np.empty(0, np.int64)
    codes, at = code_points(data), char_offsets(data)
    size, kinds = len(codes), char_classes()[codes]
    fresh = np.zeros(size + 3, bool)
    fresh[np.searchsorted(at, edges[edges < len(data)])] = True
    begins = np.ones(size, bool)
    begins[1:] = (kinds[1:] != kinds[:-1]) | fresh[1:size]
    after = np.flatnonzero((kinds[:-1] == BLANK) & (kinds[1:] != BLANK) & ~fresh[1:size]) + 1
    begins[after - 1] = True
    begins[after[codes[after - 1] == SPACE]] = False
    marks = np.flatnonzero((codes == APOSTROPHE) & begins)
    if len(marks):
        one, two = (
            np.where(fresh[marks + k], 0, codes[np.minimum(marks + k, size - 1)])
            * (marks + k < size)
            for k in (1, 2)
        )
        two = np.where(one == 0, 0, two)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(marks), bool)
        for first, second in ("re", "ve", "ll"):
            long |= (one == ord(first)) & (two == ord(second))
        taken = short | long
        begins[marks[taken] + 1] = False
        ends = marks[taken] + np.where(short[taken], 2, 3)
        begins[ends[ends < size]] = True
    return at[begins]


def class_parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts with the same pieces by `CLASS_PATTERN` as the whole.

    A part ends where one class follows another, but not after a blank, nor after what may be an
    apostrophe with an ending.
    """
    start, size = 0, STREAMED_CHARS
    while start + size < len(data):
        end = start + size
        while end > start and data[end] & 0xC0 == 0x80:
            end -= 1
        kinds = char_classes()[code_points(data[start:end])]
        left, right = kinds[:-1], kinds[1:]
        cuts = np.flatnonzero(
            (left != right) & (left != BLANK) & ~((left == OTHER) & (right == LETTER))
        )
        if not len(cuts):
            size *= 2
            continue
        stop = start + int(char_offsets(data[start:end])[cuts[-1] + 1])
        yield data[start:stop]
        start, size = stop, STREAMED_CHARS
    yield data[start:]


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of texts or byte strings; null has none."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def binary_array(offsets: np.ndarray, data: np.ndarray | pa.Buffer) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def taken(table: pa.Array, indices: pa.Array, firsts: np.ndarray) -> pa.Array:
    """Entries of a table one after the other, as one byte string for each range of indices."""
    if not len(indices):
        return pa.array([b""] * (len(firsts) - 1), pa.large_binary())
    ends, data = binary_parts(table.take(indices))
    return binary_array(ends[firsts], data)


class ByteBpe:
    def __init__(self, rank_file: bytes, pattern: str):
        lines = (line.split() for line in rank_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a rank file must hold all 256 single bytes")
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.whole = pa.array(self.ranks, pa.large_binary())
        numbers = np.fromiter(self.ranks.values(), "<u4", len(self.ranks))
        self.whole_ids = binary_array(4 * np.arange(len(numbers) + 1), numbers.view(np.uint8))
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.by_class = pattern == CLASS_PATTERN
        self.pattern = regex.compile(pattern)
        # Pieces that were met, beside their ids.
        self.known = self.known_ids = pa.array([], pa.large_binary())

    @cached_property
    def pairs(self) -> PairTable:
        """Made for encoding only."""
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        return PairTable(
            np.fromiter(pairs.keys(), np.uint64, len(pairs)),
            np.fromiter(pairs.values(), np.int32, len(pairs)),
        )

    def learn(self, pieces: pa.Array) -> pa.Array:
        """The ids of pieces, each a byte string of little-endian 32-bit integers."""
        ends, data = binary_parts(pieces)
        lengths, token = np.diff(ends), pc.index_in(pieces, value_set=self.whole)
        merges = token.is_null().to_numpy(False)
        places, out = [np.flatnonzero(~merges)], [self.whole_ids.take(token.drop_null())]
        for row in np.flatnonzero(merges & (lengths > LONGEST_ROW)):
            places.append(np.array([row]))
            ids = self.merge_long(data[ends[row] : ends[row + 1]].tobytes())
            out.append(pa.array([ids], pa.large_binary()))
        rows = np.flatnonzero(merges & (lengths <= LONGEST_ROW))
        bits = np.frexp(lengths[rows] - 1)[1]
        for bit in np.unique(bits).tolist():
            bucket, height = rows[bits == bit], max(1, MATRIX_CELLS >> bit)
            for start in range(0, len(bucket), height):
                part = bucket[start : start + height]
                places.append(part)
                out.append(self.merge_rows(pieces.take(pa.array(part))))
        return pa.concat_arrays(out).take(pa.array(np.argsort(np.concatenate(places))))

    def merge_rows(self, raws: pa.Array) -> pa.Array:
        """Ids of byte strings of two bytes or more."""
        ends, data = binary_parts(raws)
        lengths = np.diff(ends).astype(np.int32)
        width = int(lengths.max())
        ids = np.full((len(raws), width), -1, np.int32)
        inside = np.arange(width, dtype=np.int32) < lengths[:, None]
        ids[inside] = self.byte_ids[data]
        ranks = np.full((len(raws), width - 1), NO_RANK, np.int32)
        paired = inside[:, 1:]
        ranks[paired] = self.pairs.ranks_of(ids[:, :-1][paired], ids[:, 1:][paired])
        rows, finished = np.arange(len(raws)), []
        while len(rows):
            every = np.arange(len(rows))
            if ranks.shape[1]:
                at = ranks.argmin(1).astype(np.int32)
                best = ranks[every, at]
            else:
                at, best = np.zeros(len(rows), np.int32), np.full(len(rows), NO_RANK)
            done = best == NO_RANK
            if done.any():
                ended = np.arange(ids.shape[1], dtype=np.int32) < lengths[done][:, None]
                finished.append((rows[done], lengths[done], ids[done][ended]))
                live = ~done
                rows, ids, ranks, lengths = rows[live], ids[live], ranks[live], lengths[live]
                at, best, every = at[live], best[live], every[: len(rows)]
                if not len(rows):
                    break
            ids[every, at] = best
            cells = np.arange(ids.shape[1] - 1, dtype=np.int32)
            ids = np.where(cells > at[:, None], ids[:, 1:], ids[:, :-1])
            lengths = lengths - 1
            cells = np.arange(ranks.shape[1] - 1, dtype=np.int32)
            ranks = np.where(cells >= at[:, None], ranks[:, 1:], ranks[:, :-1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.ranks_of(
                ids[left, at[left] - 1], ids[left, at[left]]
            )
            right = np.flatnonzero(at + 1 < lengths)
            ranks[right, at[right]] = self.pairs.ranks_of(
                ids[right, at[right]], ids[right, at[right] + 1]
            )
        ended, sizes, merged = (np.concatenate(part) for part in zip(*finished, strict=True))
        ends = np.concatenate([[0], 4 * np.cumsum(sizes, dtype=np.int64)])
        table = binary_array(ends, merged.astype("<u4").view(np.uint8))
        return table.take(pa.array(np.argsort(ended)))

    def merge_long(self, raw: bytes) -> bytes:
        """The same merges for one long byte string."""
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)]
        first = self.pairs.ranks_of(ids[:-1], ids[1:])
        ids, size = ids.tolist(), len(raw)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        current = first.tolist() + [int(NO_RANK)]
        heap = [(rank, at) for at, rank in enumerate(current) if rank != NO_RANK]
        heapq.heapify(heap)

        def ranked(at: int) -> None:
            following = after[at]
            current[at] = int(NO_RANK)
            if following < size:
                pair = np.array([ids[at]]), np.array([ids[following]])
                current[at] = int(self.pairs.ranks_of(*pair)[0])
                if current[at] != NO_RANK:
                    heapq.heappush(heap, (current[at], at))

        while heap:
            rank, at = heapq.heappop(heap)
            if current[at] != rank or ids[at] < 0:
                continue
            gone = after[at]
            ids[at], ids[gone], current[gone] = rank, -1, int(NO_RANK)
            after[at] = after[gone]
            if after[gone] < size:
                before[after[gone]] = at
            ranked(at)
            if before[at] >= 0:
                ranked(before[at])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text by any pattern, a bounded number at a time."""
        if len(text) <= STREAMED_CHARS:
            yield [m for m in self.pattern.findall(text) if m]
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, STREAMED_PIECES)):
            yield [m for m in part if m]

    def cut(self, offsets: np.ndarray, data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of short texts, and which is each text's first."""
        if self.by_class:
            starts = class_cuts(data, offsets[:-1])
            pieces = binary_array(np.append(starts, len(data)), data)
            return pieces, np.searchsorted(starts, offsets)
        texts = binary_array(offsets, data).cast(pa.large_string()).to_pylist()
        lists = [[p for part in self.pieces(text) for p in part] for text in texts]
        pieces = pa.array(chain.from_iterable(lists), pa.large_string())
        return pieces.cast(pa.large_binary()), np.cumsum([0, *map(len, lists)])

    def streamed(self, data: np.ndarray) -> Iterator[pa.Array]:
        """The pieces of a long text, a bounded number at a time."""
        if self.by_class:
            for part in class_parts(data):
                yield self.cut(np.array([0, len(part)]), part)[0]
        else:
            for part in self.pieces(data.tobytes().decode()):
                yield pa.array(part, pa.large_string()).cast(pa.large_binary())

    def ids_of(self, pieces: pa.Array, firsts: np.ndarray) -> pa.Array:
        """The ids of ranges of pieces."""
        coded = pieces.dictionary_encode()
        return taken(self.look_up(coded.dictionary), coded.indices, firsts)

    def look_up(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; what is new is learnt at once.

        What is met in text after text is met in these, so when too many are known these remain.
        """
        found = pc.index_in(pieces, value_set=self.known)
        missing = found.is_null()
        if not found.null_count:
            return self.known_ids.take(found)
        new = pieces.filter(missing)
        ids = pa.concat_arrays([self.known_ids, self.learn(new)])
        at, missing = found.fill_null(0).to_numpy().copy(), missing.to_numpy(False)
        at[missing] = len(self.known) + np.arange(len(new))
        table = ids.take(pa.array(at))
        if len(ids) > REMEMBERED:
            self.known, self.known_ids = pieces, table
        else:
            self.known, self.known_ids = pa.concat_arrays([self.known, new]), ids
        return table

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """Ids of every text; short texts are cut and looked up together."""
        offsets, data = binary_parts(texts)
        long = np.flatnonzero(np.diff(offsets) > STREAMED_CHARS).tolist()
        out, start = [], 0
        for row in [*long, len(texts)]:
            if row > start:
                part = offsets[start : row + 1]
                short = data[part[0] : part[-1]]
                out.append(self.ids_of(*self.cut(part - part[0], short)))
            if row < len(texts):
                parts = self.streamed(data[offsets[row] : offsets[row + 1]])
                ids = [self.ids_of(p, np.array([0, len(p)]))[0].as_py() for p in parts]
                out.append(pa.array([b"".join(ids)], pa.large_binary()))
            start = row + 1
        return pa.concat_arrays(out).cast(pa.binary()) if out else pa.array([], pa.binary())

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def decode_array(self, ids: pa.Array) -> pa.Array:
        """Bytes of the tokens of every row; null has none."""
        offsets, data = binary_parts(ids)
        if (offsets % 4).any():
            raise ValueError("ids are 32-bit integers")
        tokens = pa.array(np.frombuffer(data.tobytes(), "<u4"))
        return taken(self.tokens, tokens, offsets // 4).cast(pa.binary())


@lru_cache(maxsize=4)
def _codec(rank_file: bytes, pattern: str) -> ByteBpe:
    return ByteBpe(rank_file, pattern)


def encode(
    docs: DataFrame, rank_path: str, pattern: str, column: str = "text", keep_text: bool = False
) -> DataFrame:
    """Adds `n_tokens`, `ids` (binary, little-endian unsigned 32-bit) and `round_trip` to every row.

    `round_trip` tells whether the ids decode to the bytes of the text. The text column is replaced
    by them unless `keep_text`. A null or empty text has no ids. Other columns pass through, except
    that columns of these names give way. Repeated rows stay repeated; an empty table gives an empty
    one. The rank file is read once on the driver.
    """
    docs = without(docs, "n_tokens", "ids", "round_trip")
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    kept = [c for c in docs.columns if keep_text or c != column]
    schema = docs.select(*kept).withColumn("n_tokens", F.lit(0).cast("long"))
    schema = schema.withColumns({"ids": F.lit(b""), "round_trip": F.lit(True)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            for group in row_groups(batch, column):
                texts = group.column(column)
                with paused_collector():
                    ids = codec.encode_array(texts)
                same = pc.equal(codec.decode_array(ids), texts.cast(pa.binary()).fill_null(b""))
                columns = [group.column(c) for c in kept]
                counts = pa.array(np.diff(binary_parts(ids)[0]) // 4, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*columns, counts, ids, same], [*kept, "n_tokens", "ids", "round_trip"]
                )

    return map_batches(docs, run, schema)


def decode(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Adds `decoded` (binary) to rows with `ids` as `encode` gives them; null ids decode to none."""
    encoded = without(encoded, "decoded")
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    names = encoded.columns
    schema = encoded.withColumn("decoded", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            for group in row_groups(batch, "ids"):
                decoded = codec.decode_array(group.column("ids"))
                yield pa.RecordBatch.from_arrays([*group.columns, decoded], [*names, "decoded"])

    return map_batches(encoded, run, schema)
