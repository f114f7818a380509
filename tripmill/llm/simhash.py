"""SimHash near-duplicates by a byte-position index with count filtering.

Fingerprints of 64 bits that differ in at most `bits` bits share at least 8 - `bits` of their 8
positional bytes. Postings of single positional bytes would pair everything with everything, so the
index is kept on sets of byte positions such that any 8 - `bits` positions contain one of the sets
whole: every pair that reaches the minimum shares a posting. In a posting the shared bytes of a
pair are tallied, pairs below the minimum are dropped, and the rest verified by their bit distance.

Only distinct fingerprints are indexed. A posting list longer than `BLOCK` is cut into blocks and
every two blocks meet in a task of their own; what leaves a task is a spanning forest of its links,
never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import map_batches, row_groups, stored, text_key, without
from tripmill.llm.components import lowest_reachable

SEED = 42
# Fingerprints of a block of a long posting list.
BLOCK = 1024
# Shingle hashes expanded into bits at once.
BIT_ROWS = 1 << 15
# Runs up to this length are compared by shifts of the whole batch, longer ones one by one.
SHORT_RUN = 8
BYTES = 8


def fingerprint(text: str | None, shingle: int) -> int:
    """SimHash of the word shingles, repeats included; zero without words.

    Words are what lies between ASCII white space, A-Z in lower case. Fewer words than `shingle`
    are one shingle. A bit is set if over half of the shingles' XXH64 values have it.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    reach = min(shingle, len(words)) - 1
    spans = zip(starts[: len(words) - reach].tolist(), ends[reach:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), BIT_ROWS):
        part = hashes[start : start + BIT_ROWS].view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, column: str = "text") -> DataFrame:
    """The rows with `fingerprint` (64 bits as a signed long) instead of the text."""
    docs = without(docs, "fingerprint")
    kept = [c for c in docs.columns if c != column]
    schema = docs.select(*kept).withColumn("fingerprint", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in row_groups(batch, column):
                texts = group.column(column).to_pylist()
                marks = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[group.column(c) for c in kept], marks], [*kept, "fingerprint"]
                )

    return map_batches(docs, run, schema)


def position_sets(shared: int) -> list[tuple[int, ...]]:
    """Sets of byte positions of which any `shared` positions contain one whole.

    The 8 positions form as many parts as `shared` positions can fill with more than one each;
    by the pigeonhole principle some part receives its share.
    """
    if shared < 1:
        raise ValueError("at most 7 bits may differ")
    parts = 2 if shared >= 3 else 1
    size, take = BYTES // parts, -(-shared // parts)
    return [
        tuple(part * size + position for position in chosen)
        for part in range(parts)
        for chosen in combinations(range(size), take)
    ]


def postings(marks: DataFrame, shared: int) -> DataFrame:
    """(posting, fingerprint): one row for each position set; the key holds set and bytes."""
    keys = []
    for number, positions in enumerate(position_sets(shared)):
        mask = sum(0xFF << (8 * p) for p in positions)
        mask = mask - (1 << 64) if mask >> 63 else mask
        keys.append(
            F.struct(
                F.lit(number).alias("set"),
                F.col("fingerprint").bitwiseAND(F.lit(mask)).alias("bytes"),
            )
        )
    return marks.select(F.explode(F.array(*keys)).alias("posting"), "fingerprint")


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Count filter, then verification."""
    differ = a ^ b
    cells = np.ascontiguousarray(differ).view(np.uint8).reshape(*differ.shape, BYTES)
    near = (cells == 0).sum(-1) >= BYTES - bits
    near[near] = np.bitwise_count(differ[near]) <= bits
    return near


def _forest(marks: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs of one run connect.

    Breadth-first: every reached fingerprint is compared with those not reached yet.
    """
    links, left = [], marks
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _linked(left, np.full(len(left), at, np.uint64), bits)
            if near.any():
                found = left[near]
                links += [(int(at), int(x)) for x in found]
                queue += list(found)
                left = left[~near]
    return links


def links_of_runs(keys: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    """Links inside the runs of equal keys; keys are sorted, marks unsigned."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate(([0], cuts))
    lengths = np.diff(np.concatenate((starts, [len(keys)])))
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    pairs = []
    for shift in range(1, min(SHORT_RUN, len(keys))):
        same = np.flatnonzero((keys[shift:] == keys[:-shift]) & short[shift:])
        if not len(same):
            break
        near = same[_linked(marks[same], marks[same + shift], bits)]
        pairs.append(np.stack((marks[near], marks[near + shift]), 1))
    for start, length in zip(
        starts[lengths > SHORT_RUN], lengths[lengths > SHORT_RUN], strict=True
    ):
        found = _forest(marks[start : start + length], bits)
        pairs.append(np.array(found, np.uint64).reshape(-1, 2))
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), np.uint64)


def links(marks: DataFrame, bits: int) -> DataFrame:
    """(a, b) between distinct fingerprints: enough links to connect all that are linked."""
    shared = BYTES - bits
    listed = postings(marks, shared)
    sizes = listed.groupBy("posting").agg(F.count("*").alias("size")).filter("size > 1")
    sized = listed.join(stored(sizes, "simhash-sizes"), "posting")
    blocks = F.ceil(F.col("size") / BLOCK)
    block = F.pmod(F.xxhash64("fingerprint"), blocks)
    met = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    dealt = sized.select("posting", "fingerprint", block.alias("own"), met.alias("met"))
    keyed = dealt.select(
        F.xxhash64("posting", F.least("own", "met"), F.greatest("own", "met")).alias("key"),
        "fingerprint",
    )
    keyed = keyed.repartition("key").sortWithinPartitions("key", "fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.concatenate((held_keys, batch.column("key").to_numpy()))
            marks = np.concatenate(
                (held, batch.column("fingerprint").to_numpy().view(np.uint64))
            )
            if not len(keys):
                continue
            end = np.searchsorted(keys, keys[-1])
            held_keys, held = keys[end:], marks[end:]
            if end:
                yield _pairs(links_of_runs(keys[:end], marks[:end], bits))
        if len(held):
            yield _pairs(links_of_runs(held_keys, held, bits))

    return map_batches(keyed, run, "a long, b long")


def _pairs(found: np.ndarray) -> pa.RecordBatch:
    ends = np.ascontiguousarray(found).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"]
    )


def _named(marked: DataFrame, order: list, bits: int) -> DataFrame:
    """(fingerprint, first): the least `order` among the rows of a fingerprint's component."""
    position_sets(BYTES - bits)
    groups = marked.groupBy("fingerprint").agg(F.min(F.struct(*order)).alias("first"))
    groups = stored(groups, "simhash-groups")
    edges = links(groups.select("fingerprint"), bits)
    roots = stored(lowest_reachable(edges, "a", "b"), "simhash-roots")
    rooted = groups.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = stored(
        rooted.withColumn("root", F.coalesce("root", "fingerprint")), "simhash-rooted"
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    named = rooted.drop("first").join(stored(firsts, "simhash-firsts"), "root")
    return stored(named.select("fingerprint", "first"), "simhash-named")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id) for every row: the smallest key its fingerprint reaches.

    Rows link when their fingerprints differ in at most `bits` bits (7 at most). Null and empty
    texts have fingerprint zero and link like any other. Null keys never become a component's id;
    a component of null keys alone has a null id. Repeated rows stay repeated. Extra columns are
    left out, whatever they are called. An empty table gives an empty one.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(column).alias("text"))
    marked = stored(fingerprints(rows, shingle), "simhash-marks")
    order = [F.col("id").isNull().alias("none"), F.col("id")]
    named = _named(marked, order, bits)
    return marked.join(named, "fingerprint").select(
        F.col("id").alias(key), "fingerprint", F.col("first.id").alias("component_id")
    )


def one_of_each_group(
    docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id", column: str = "text"
) -> DataFrame:
    """One whole row of each group of near duplicates, with the columns of `docs`.

    The row of the smallest key stays, a null key only if no other is there; among rows of that
    key the one with the least text hash, and any one of rows that are equal in key and text.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.col(column).alias("text"),
        F.struct(
            F.col(key).isNull().alias("none"),
            F.col(key).alias("id"),
            text_key(column).alias("text"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
    )
    marked = stored(fingerprints(rows, shingle), "simhash-docs")
    first = _named(marked.select("fingerprint", "place"), [F.col("place")], bits)
    kept = first.select(F.col("first.place.row").alias("row")).distinct()
    found = marked.withColumn("row", F.col("place.row")).join(kept, "row", "left_semi")
    return found.select("doc.*")
