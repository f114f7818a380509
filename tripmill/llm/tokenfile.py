"""Token ids of documents as Parquet list columns that can be read in part.

Rows are ordered by document id over all files. `ids` is a dictionary-encoded list column, the
numbers are delta-encoded, row groups and pages are kept small and carry Parquet's page indexes:
a reader of some documents, or of counts alone, touches only their pages and columns.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import map_batches, paused_collector, row_groups

SCHEMA = "part int, doc_id long, part_start long, n_tokens long, ids array<int>"
# How the files are written: Spark hands these to Parquet's writer.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "1000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#part_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
# Words whose ids a worker remembers; reaching it only costs time.
REMEMBERED = 700_000
# Words, and parts of words, that the library gets at once.
AT_ONCE = 500
# Bytes of text whose words are numbered together.
AT_A_TIME = 4 << 20
# The tokenizer's own pattern; words of Latin-1 characters are cut by it before they are looked up.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LAST_LATIN = "\xff"
# A single mark after a letter is a part of its own; this sets it apart from the word.
STOP, APART = r"([a-z])([.,;:!?])(\s|$)", r"\1 \2\3"


class WordTokenizer:
    """A tokenizer that drops white space, applied to each distinct word of a group of texts.

    Its normaliser and pattern never look across white space, so the ids of a text are those of
    its words in turn. Words of Latin-1 characters, where lower case and normal form are plain, are
    cut into the pattern's parts, which repeat more often. All ids come from the tokenizers library.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        # For parts that are cut and in lower case already: the same model, without those steps.
        self.plain = Tokenizer.from_str(definition)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = regex.compile("|".join(regex.escape(t.content) for t in added) or r"(?!)")
        if not all("<" in t.content for t in added):
            raise ValueError("added tokens are looked for in words with a < alone")
        self.known: dict[str, bytes] = {}

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of every text, and all their ids; `end_id` ends each text.

        Arrow lowers ASCII letters (the tokenizer lowers all), sets single stops apart, cuts the
        texts at ASCII white space (other white space is left inside a word for the tokenizer) and
        numbers the distinct words, so Python meets each word once.
        """
        texts = texts.fill_null("")
        # Lower case would turn other text into an added token.
        if not pc.any(pc.match_substring(texts, "<")).as_py():
            texts = pc.replace_substring_regex(pc.ascii_lower(texts), STOP, APART)
        cut = pc.ascii_split_whitespace(texts)
        numbered = cut.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.learn([word for word in distinct if word not in self.known])
        own = [self.known[word] for word in distinct]
        own.append(np.array([end_id], "<u4").tobytes())
        pool = np.frombuffer(b"".join(own), "<i4")
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
        starts = np.cumsum(sizes) - sizes
        borders = pc.list_value_length(cut).to_numpy().astype(np.int64).cumsum()
        words = np.insert(numbered.indices.to_numpy().astype(np.int64), borders, len(distinct))
        lengths = sizes[words]
        reached = np.cumsum(lengths)
        at = np.arange(reached[-1]) + np.repeat(starts[words] - (reached - lengths), lengths)
        ends = reached[borders + np.arange(len(borders))]
        return np.diff(ends, prepend=0), pool[at]

    def is_plain(self, word: str) -> bool:
        """Latin-1 alone, and none of the tokenizer's added tokens, which it finds first."""
        if not word.isascii() and max(word) > LAST_LATIN:
            return False
        return "<" not in word or self.added.search(word) is None

    def learn(self, words: list[str]) -> None:
        """Puts the ids of words into `known`, and those of the parts they are cut into."""
        known, parts, cut, whole = self.known, set(), {}, []
        for word in words:
            if not self.is_plain(word):
                whole.append(word)
            elif word.isalpha() and word.islower():
                parts.add(word)
            else:
                cut[word] = PARTS.findall(word.lower())
        parts.update(part for own in cut.values() for part in own if part not in known)
        parts = list(parts)
        for start in range(0, len(parts), AT_ONCE):
            some = parts[start : start + AT_ONCE]
            encoded = self.plain.encode(" ".join(some), add_special_tokens=False)
            raw = np.array(encoded.ids, "<u4").tobytes()
            ends = np.searchsorted(np.array(encoded.word_ids), np.arange(len(some)), "right")
            ends = (4 * ends).tolist()
            for part, first, last in zip(some, [0, *ends], ends, strict=False):
                known[part] = raw[first:last]
        for word, own in cut.items():
            known[word] = b"".join([known[part] for part in own])
        for start in range(0, len(whole), AT_ONCE):
            some = whole[start : start + AT_ONCE]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            for word, own in zip(some, encoded, strict=True):
                known[word] = np.array(own.ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def _tokenizer(definition: str) -> WordTokenizer:
    return WordTokenizer(definition)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encodes every whole text, appends `end_id`, and writes the ids in order of doc_id.

    Null texts count as empty. Rows without a doc_id come first; rows of one id follow their place in
    the input. Every task writes the files of one range of ids, numbered from 0 in `part`, and counts
    its own ids in `part_start`. The tokenizer's definition is read once on the driver.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(
        F.col("doc_id").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").alias("text"),
    )
    order = ["doc_id", "row"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        tokenizer = _tokenizer(shared.value)
        for batch in batches:
            for group in row_groups(batch, "text", AT_A_TIME):
                with paused_collector():
                    counts, ids = tokenizer.encode_all(group.column("text"), end_id)
                ends = np.cumsum(counts)
                offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), part, np.int32)),
                        group.column("doc_id"),
                        pa.array(start + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(offsets, pa.array(ids)),
                    ],
                    ["part", "doc_id", "part_start", "n_tokens", "ids"],
                )
                start += int(ends[-1])

    encoded = map_batches(ranged, run, SCHEMA)
    encoded.write.options(**FILE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; `start` counts the ids of all before it.

    The parts' totals, one number for each writing task, are added up on the driver; they come from
    the `n_tokens` column alone. Filters on doc_id and unused columns reach the Parquet pages.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens")).collect()
    totals.sort(key=lambda row: row[0])
    starts = accumulate((row[1] for row in totals), initial=0)
    bases = [(row[0], start) for row, start in zip(totals, starts, strict=False)]
    based = F.broadcast(spark.createDataFrame(bases, "part int, base long"))
    return files.join(based, "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids"
    )


def with_crc32(tokens: DataFrame) -> DataFrame:
    """`ids` replaced by `ids_crc32` of the ids as little-endian unsigned 32-bit integers."""
    kept = [c for c in tokens.columns if c != "ids"]
    schema = tokens.select(*kept).withColumn("ids_crc32", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
            ends = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(sums, pa.int64())],
                [*kept, "ids_crc32"],
            )

    return map_batches(tokens, run, schema)
