"""Removal of byte strings that repeat across documents, by blockwise suffix sorting.

Every string of `length` bytes, a window, that also starts in a document of a smaller id goes. All
windows of a corpus are too many to sort or to send, so:

1. Texts are packed into blocks of some megabytes, stored once and bucketed by block; later steps
   meet them in place, and only short answers travel.
2. Cover samples (`suffixes`) of all texts are sorted, one bucket at a time; those in one document
   alone leave out the windows that only they could tell. What remains could be repeated.
3. There, chunks that end by content and equal a chunk of an earlier document, with all of their
   windows, are settled as a whole. The cover samples of what is left are compared once more.
4. The windows still left are sorted in each block as suffixes, one bucket at a time, long ties by
   ranks of the cover samples; one of each, with its least document, meets the other blocks'.

In all steps a block sends each distinct key once, so copies of one text, however many, cost a
bucket no more than one entry a block. A bucket and a block are what a task holds. Samples are compared
by 31 bits beside their bucket, which can only keep windows that a later step drops; chunks and windows
by 128 bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches, stored
from tripmill.llm.suffixes import NO_ID, Block, covered, sorted_windows
from tripmill.sources.workdir import new_workdir

# Bytes of texts in a block, of texts whose keys meet in one bucket, and in one task.
BLOCK_BYTES, BUCKET_BYTES, TASK_BYTES = 4 << 20, 8 << 20, 32 << 20
# Most buckets: beyond, a block would send a bucket only a handful of samples.
MOST_BUCKETS = 1 << 18
# A chunk ends where so many bits of a hash are zero: every 16 bytes on average.
CHUNK_BITS = 4
SAMPLE_BITS = 31
# Kinds of rows that travel to buckets: what a block knows by now, and its keys.
STATE, KEYS = 0, 1
SENT = "bucket int, block long, kind int, data binary"


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).reshape(-1).view(kind)


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences; the lowest may be any."""
    return pack(np.diff(numbers, prepend=numbers.dtype.type(0)))


def unpack_sorted(data: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def pack_mask(mask: np.ndarray) -> bytes:
    """A mask as the places where it changes."""
    return pack_sorted(np.flatnonzero(np.diff(mask, prepend=False)).astype(np.uint64))


def unpack_mask(data: bytes, size: int) -> np.ndarray:
    changes = np.zeros(size, bool)
    changes[unpack_sorted(data, np.uint64).astype(np.int64)] = True
    return np.logical_xor.accumulate(changes)


def pack_state(state: tuple[np.ndarray, ...]) -> bytes:
    """Masks of a block's windows, and a number for each window of the first mask."""
    parts = [pack_mask(part) if part.dtype == bool else pack(part) for part in state]
    return with_lengths(parts)


def unpack_state(data: bytes, size: int) -> tuple[np.ndarray, ...]:
    wanted, gone, *numbers = without_lengths(data)
    masks = unpack_mask(wanted, size), unpack_mask(gone, size)
    return *masks, *[unpack(n, np.uint32) for n in numbers]


def with_lengths(parts: list[bytes]) -> bytes:
    """Some byte strings as one."""
    sizes = np.array([len(parts), *map(len, parts)], np.int64)
    return sizes.tobytes() + b"".join(parts)


def without_lengths(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, count, 8)
    ends = 8 * (count + 1) + np.cumsum(sizes)
    return [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def order_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """The order of keys below 2 ** `bits`; sorting plain numbers is the fastest, where they fit."""
    places = max(1, len(keys).bit_length())
    if bits + places > 64:
        return np.argsort(keys)
    packed = (keys << np.uint64(places)) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << places) - 1)).astype(np.int64)


class Distinct:
    """The distinct keys of a block in the order of their buckets, and the least id of each.

    `owner` gives the buckets of sorted keys.
    """

    def __init__(
        self,
        columns: tuple[np.ndarray, ...],
        ids: np.ndarray,
        owner: Callable[[np.ndarray], np.ndarray],
        bits: int = 64,
    ):
        order = order_of(columns[0], bits) if len(columns) == 1 else np.lexsort(columns[::-1])
        rows = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        new[1:] = np.any([r[1:] != r[:-1] for r in rows], axis=0)
        begins = np.flatnonzero(new)
        self.columns = [r[begins] for r in rows]
        self.least = np.minimum.reduceat(ids[order], begins) if len(begins) else ids[:0]
        most = np.maximum.reduceat(ids[order], begins) if len(begins) else ids[:0]
        self.many = most > self.least
        self.group = np.zeros(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        owners = owner(self.columns[0]).astype(np.int64)
        self.cuts = np.flatnonzero(np.diff(owners, prepend=-1))
        self.buckets = owners[self.cuts]

    def slices(self) -> Iterator[tuple[int, slice]]:
        ends = np.append(self.cuts, len(self.columns[0]))[1:]
        for bucket, start, end in zip(
            self.buckets.tolist(), self.cuts.tolist(), ends.tolist(), strict=True
        ):
            yield bucket, slice(start, end)


# Samples: a block tells its distinct samples and whether it has them in several documents; the
# answer is a bit for each, whether any two documents have it.


def sample_keys(block: Block, wanted: np.ndarray | None, buckets: int):
    at = block.samples(wanted)
    keys = block.first.of(at, at + block.reach)
    # What a bucket compares is the low bits; the high ones choose the bucket.
    shift = np.uint64(SAMPLE_BITS)
    keys = (bucket_of(keys, buckets) << shift) | (keys & np.uint64((1 << SAMPLE_BITS) - 1))
    bits = SAMPLE_BITS + buckets.bit_length()
    return at, Distinct((keys,), block.ids_at(at), lambda k: k >> shift, bits)


def tell_samples(found: Distinct) -> Iterator[tuple[int, bytes]]:
    low = (found.columns[0] & np.uint64((1 << SAMPLE_BITS) - 1)).astype(np.uint32)
    told = (low << np.uint32(1)) | found.many
    for bucket, own in found.slices():
        yield bucket, pack_sorted(told[own])


def meet_samples(blobs: list[bytes]) -> list[bytes]:
    told = [unpack_sorted(b, np.uint32) for b in blobs]
    joined = np.concatenate(told)
    keys = (joined >> np.uint32(1)).astype(np.uint64)
    order = order_of(keys, SAMPLE_BITS)
    keys = keys[order]
    new = np.append(True, keys[1:] != keys[:-1])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(keys)))
    many = np.logical_or.reduceat((joined & np.uint32(1)).astype(bool)[order], begins)
    shared = np.zeros(len(keys), bool)
    shared[order] = np.repeat(many | (sizes > 1), sizes)
    ends = np.cumsum([len(t) for t in told])[:-1]
    return [np.packbits(s).tobytes() for s in np.split(shared, ends)]


def heard_samples(found: Distinct, answers: dict[int, bytes]) -> np.ndarray:
    """Whether each distinct sample is shared."""
    shared = np.zeros(len(found.columns[0]), bool)
    for bucket, own in found.slices():
        bits = np.frombuffer(answers[bucket], np.uint8)
        shared[own] = np.unpackbits(bits, count=own.stop - own.start).astype(bool)
    return shared


# Chunks and windows: a block tells its distinct keys and the least id of each; the answer is the
# least id of all blocks.


def tell_least(found: Distinct) -> Iterator[tuple[int, bytes]]:
    for bucket, own in found.slices():
        first, second = (c[own] for c in found.columns)
        yield bucket, with_lengths([pack_sorted(first), second.tobytes(), pack(found.least[own])])


def meet_least(blobs: list[bytes]) -> list[bytes]:
    told = [without_lengths(b) for b in blobs]
    first = np.concatenate([unpack_sorted(t[0], np.uint64) for t in told])
    second = np.concatenate([np.frombuffer(t[1], np.uint64) for t in told])
    ids = [unpack(t[2], np.int64) for t in told]
    found = Distinct((first, second), np.concatenate(ids), np.zeros_like)
    least = found.least[found.group]
    return [pack(x) for x in np.split(least, np.cumsum([len(i) for i in ids])[:-1])]


def heard_least(found: Distinct, answers: dict[int, bytes]) -> np.ndarray:
    """The least id of each distinct key among all blocks."""
    least = np.zeros(len(found.columns[0]), np.int64)
    for bucket, own in found.slices():
        least[own] = unpack(answers[bucket], np.int64)
    return least


def chunk_keys(block: Block, wanted: np.ndarray, buckets: int):
    """Chunks with a wanted window: their numbers, and distinct keys of all that their windows hold."""
    starts, ends, last = block.chunks(CHUNK_BITS)
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(wanted)))
    some = sums[ends] > sums[starts]
    starts, ends, last = starts[some], ends[some], last[some]
    owner = partial(bucket_of, buckets=buckets)
    return starts, ends, Distinct(block.keys(starts, last), block.ids_at(starts), owner)


def window_keys(block: Block, wanted: np.ndarray, buckets: int):
    """Wanted windows in suffix order, the run of equal ones each is in, distinct keys of the runs."""
    at, new = sorted_windows(block, np.flatnonzero(wanted))
    begins = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    ids = block.ids_at(at)
    least = np.minimum.reduceat(ids, begins) if len(begins) else ids[:0]
    heads = at[begins]
    owner = partial(bucket_of, buckets=buckets)
    return at, run, Distinct(block.keys(heads, heads + block.length), least, owner)


# Rounds. Each tells keys; the next hears the answers, narrows what is wanted, and tells its own.


def tell_all(block: Block, buckets: int):
    return None, tell_samples(sample_keys(block, None, buckets)[1])


def hear_all_tell_chunks(block: Block, _, answers: dict[int, bytes], buckets: int):
    at, found = sample_keys(block, None, buckets)
    wanted = block.windows_with(at[heard_samples(found, answers)[found.group]])
    return (wanted, wanted & False), tell_least(chunk_keys(block, wanted, buckets)[2])


def hear_chunks_tell_samples(block: Block, state, answers: dict[int, bytes], buckets: int):
    wanted, gone = state
    starts, ends, found = chunk_keys(block, wanted, buckets)
    settled = block.ids_at(starts) > heard_least(found, answers)[found.group]
    marks = np.zeros(len(block.data) + 1, np.int8)
    marks[starts[settled]] += 1
    marks[ends[settled]] -= 1
    settled = np.cumsum(marks[:-1]).astype(bool)
    gone, wanted = gone | (settled & block.windows), wanted & ~settled
    return (wanted, gone), tell_samples(sample_keys(block, wanted, buckets)[1])


def hear_samples_tell_windows(block: Block, state, answers: dict[int, bytes], buckets: int):
    wanted, gone = state
    at, found = sample_keys(block, wanted, buckets)
    wanted = wanted & block.windows_with(at[heard_samples(found, answers)[found.group]])
    at, run, found = window_keys(block, wanted, buckets)
    key = np.zeros(len(block.data), np.uint32)
    key[at] = found.group[run]
    return (wanted, gone, key[wanted]), tell_least(found)


def hear_windows(block: Block, state, answers: dict[int, bytes]) -> np.ndarray:
    """The windows that go. The answers follow the keys in the order of their buckets."""
    wanted, gone, key = state
    at = np.flatnonzero(wanted)
    if len(at):
        least = np.concatenate([unpack(answers[b], np.int64) for b in sorted(answers)])
        gone[at[block.ids_at(at) > least[key]]] = True
    return gone


ROUNDS = (
    (tell_all, meet_samples),
    (hear_all_tell_chunks, meet_least),
    (hear_chunks_tell_samples, meet_samples),
    (hear_samples_tell_windows, meet_least),
)


def blocks_of(docs: DataFrame, key: str, column: str) -> tuple[DataFrame, int]:
    """(block, ids, sizes, text) of all rows, bucketed by block, and the bytes of all texts."""
    rows = docs.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    schema = "block long, ids array<bigint>, sizes array<bigint>, text binary"

    def run(batches: Batches) -> Batches:
        number = TaskContext.get().partitionId() << 33
        ids, texts, held = [], [], 0

        def packed() -> pa.RecordBatch:
            data = zstandard.ZstdCompressor(1).compress(b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([data], pa.binary()),
                ],
                ["block", "ids", "sizes", "text"],
            )

        for batch in batches:
            for one, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                if texts and held + len(text) > BLOCK_BYTES:
                    yield packed()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(one)
                texts.append(text)
                held += len(text)
        if texts:
            yield packed()

    spark = docs.sparkSession
    found = map_batches(rows, run, schema)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(max(parts, -(-total // TASK_BYTES)), 100_000)
    name = f"tripmill_blocks_{uuid.uuid4().hex}"
    writer = found.write.bucketBy(parts, "block").option("path", new_workdir(spark, "suffix-blocks"))
    writer.saveAsTable(name)
    blocks = spark.table(name)
    # The files stay where they are; only the name is needed no longer.
    spark.sql(f"drop table {name}")
    return blocks, total


def opened(batch: pa.RecordBatch, row: int, length: int) -> tuple[int, Block]:
    """The number and the block of a row."""
    ids = batch.column("ids")[row].values.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    sizes = batch.column("sizes")[row].values.to_numpy(zero_copy_only=False)
    data = zstandard.ZstdDecompressor().decompress(batch.column("text")[row].as_py())
    return batch.column("block")[row].as_py(), Block(data, sizes, ids, length)


def heard(batch: pa.RecordBatch, row: int, size: int) -> tuple:
    """(state, answers by bucket) of a row; no answers if the table has none yet."""
    if "answers" not in batch.schema.names:
        return None, {}
    state, answers = None, {}
    for answer in batch.column("answers")[row].as_py() or []:
        if answer["kind"] == KEYS:
            answers[answer["bucket"]] = answer["data"]
        else:
            state = unpack_state(answer["data"], size)
    return state, answers


def told(blocks: DataFrame, step: Callable, length: int, buckets: int, first: bool) -> DataFrame:
    """What the blocks send to the buckets in a round, in rows of `SENT`."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in range(batch.num_rows):
                number, block = opened(batch, row, length)
                if first:
                    state, keys = step(block, buckets)
                else:
                    state, answers = heard(batch, row, len(block.data))
                    state, keys = step(block, state, answers, buckets)
                rows = [(bucket, KEYS, data) for bucket, data in keys]
                if state is not None:
                    rows.append((number % buckets, STATE, pack_state(state)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([number] * len(rows), pa.int64()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([r[2] for r in rows], pa.binary()),
                    ],
                    ["bucket", "block", "kind", "data"],
                )

    return map_batches(blocks, run, SENT)


def met(sent: DataFrame, meet: Callable) -> DataFrame:
    """The answers of the buckets, rows of `SENT` again; one bucket is held at a time."""

    def run(batches: Batches) -> Batches:
        held: list[tuple[int, bytes]] = []
        now = None

        def answered() -> Iterator[pa.RecordBatch]:
            if held:
                data = meet([d for _, d in held])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([now] * len(held), pa.int32()),
                        pa.array([b for b, _ in held], pa.int64()),
                        pa.array([KEYS] * len(held), pa.int32()),
                        pa.array(data, pa.binary()),
                    ],
                    ["bucket", "block", "kind", "data"],
                )

        for batch in batches:
            states = pa.compute.equal(batch.column("kind"), STATE)
            yield batch.filter(states)
            keys = batch.filter(pa.compute.invert(states))
            columns = [keys.column(c).to_pylist() for c in ("bucket", "block", "data")]
            for bucket, block, data in zip(*columns, strict=True):
                if bucket != now:
                    yield from answered()
                    held, now = [], bucket
                held.append((block, data))
        yield from answered()

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return map_batches(dealt, run, SENT)


def answered(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """The blocks with the answers that are for them; only the answers travel."""
    answer = F.struct("bucket", "kind", "data")
    gathered = answers.groupBy("block").agg(F.collect_list(answer).alias("answers"))
    return blocks.join(gathered, "block", "left")


def without_repeats(
    docs: DataFrame, length: int = 50, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """(key, n_bytes, spans, kept) of every row of `docs`: its text less what repeats.

    A text is its UTF-8 bytes. Every byte inside a string of `length` bytes that also starts in a row
    of a smaller key goes; strings overlap, lie within one row, and are judged on the texts as they
    are given. `spans` are the maximal runs removed from a row (start, end exclusive), `kept` is what
    is left of its bytes, which may end inside a character. Rows of one key do not count against each
    other; null keys come after all others. Null texts are empty, and nothing goes from texts shorter
    than `length`. Repeated rows stay repeated, extra columns are left out whatever they are called,
    and an empty table gives an empty one. A task holds one block, or one text longer than that, a few
    dozen times over.
    """
    if length < 1:
        raise ValueError("strings have at least one byte")
    blocks, total = blocks_of(docs, key, column)
    buckets = max(1, min(-(-total // BUCKET_BYTES), MOST_BUCKETS))
    rows = blocks
    for number, (step, meet) in enumerate(ROUNDS):
        sent = told(rows, step, length, buckets, number == 0)
        rows = answered(blocks, stored(met(sent, meet), f"suffix-answers-{number + 1}"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in range(batch.num_rows):
                _, block = opened(batch, row, length)
                gone = hear_windows(block, *heard(batch, row, len(block.data)))
                gone = covered(gone, length)
                yield cleaned(block, gone, batch.column("ids")[row].values)

    span = "array<struct<start: long, end: long>>"
    schema = f"id long, n_bytes long, spans {span}, kept binary"
    return map_batches(rows, run, schema).withColumnRenamed("id", key)


def cleaned(block: Block, gone: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    """The rows of a block without the bytes that go."""
    edges = np.zeros(len(gone) + 1, bool)
    edges[block.starts] = True
    begins = gone.copy()
    begins[1:] &= ~gone[:-1] | edges[1:-1]
    begins = np.flatnonzero(begins)
    stops = gone.copy()
    stops[:-1] &= ~gone[1:] | edges[1:-1]
    stops = np.flatnonzero(stops) + 1
    owner = block.text_of[begins] if len(begins) else np.zeros(0, np.int64)
    offsets = np.searchsorted(owner, np.arange(len(block.sizes) + 1))
    shift = block.starts[owner] if len(begins) else np.zeros(0, np.int64)
    spans = pa.StructArray.from_arrays(
        [pa.array(begins - shift), pa.array(stops - shift)], ["start", "end"]
    )
    left = block.data[~gone]
    sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(~gone)))
    kept_offsets = np.append(sums[block.starts], len(left)).astype(np.int32)
    kept = pa.BinaryArray.from_buffers(
        pa.binary(), len(block.sizes), [None, pa.py_buffer(kept_offsets), pa.py_buffer(left)]
    )
    return pa.RecordBatch.from_arrays(
        [
            ids.cast(pa.int64()),
            pa.array(block.sizes),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans),
            kept,
        ],
        ["id", "n_bytes", "spans", "kept"],
    )
