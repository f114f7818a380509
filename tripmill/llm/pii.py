"""Personal data by fixed formats, and by patterns that are learnt from their contexts.

Formats find e-mail and IP addresses, card and phone numbers. These seeds vote for the word pairs
before and after them (patterns); patterns vote for the identifier-like words and runs of digit
groups (instances) they stand at. Spark passes scores over the pattern-instance graph a few times. Patterns that end with
high confidence and enough support mark identifiers the formats do not know.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import Batches, map_batches, row_groups, stored, without

KINDS = ("email", "ip", "card", "phone")
# The formats; possessive repeats and the look-behind keep them linear without changing matches.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKED = re.compile(r"[0-9@]")
WORD = re.compile(r"\S+")
DIGIT = re.compile(r"[0-9]")
# Characters beside a span that are searched for its context's words.
CONTEXT_CHARS, CONTEXT_WORDS = 60, 2
WRAPPING = ".,;:!?\"'()[]{}<>="
BREAKING = ".,;:!?\"'[]{}<>="
LEAST_LENGTH = 5
# A word of digits that can be part of a run, what may stand between two, the digits of a whole
# number in one word, of the least number, and of the longest one.
GROUP = re.compile(r"[+(]{0,2}[0-9][0-9().+-]*+")
GAP = re.compile(r"[ \t\xa0\u2009\u202f]{1,2}")
WHOLE_DIGITS, LEAST_DIGITS, MOST_DIGITS = 10, 7, 19
# Learning: passes over the graph, least support in instances, least confidence, and the share of
# seeds among the instances of a pattern from which the others there are no counter-examples.
PASSES, SUPPORT, CONFIDENCE, NEAR = 3, 3.0, 0.8, 0.1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ signs."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [d * 2 - 9 * (d > 4) for d in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the formats, in order of kind and start."""
    spans = [(0, *span) for span in emails(text)]
    if not DIGIT.search(text):
        return spans
    for match in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            spans.append((1, *match.span()))
    for match in CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *match.span()))
    for match in PHONE.finditer(text):
        if 8 <= len(DIGIT.findall(match.group())) <= 15:
            spans.append((3, *match.span()))
    return spans


def possible_kinds(word: str) -> int:
    """Bits of the kinds whose shape a word could have, more loosely than the formats."""
    digits = len(DIGIT.findall(word))
    bits = 1 if "@" in word[1:-1] else 0
    if word.count(":") >= 3 or word.count(".") >= 3 and digits >= 4:
        bits |= 2
    if digits >= LEAST_DIGITS and not any(c.isalpha() for c in word):
        bits |= 4 * (12 <= digits <= MOST_DIGITS) | 8 * (digits <= 15)
    return bits


def contexts(text: str, start: int, end: int) -> tuple[str, str]:
    """The words before and after a span, in lower case, digits as 0; empty where there are none."""
    before = text[max(0, start - CONTEXT_CHARS) : start].split()[-CONTEXT_WORDS:]
    after = text[end : end + CONTEXT_CHARS].split()[:CONTEXT_WORDS]
    left, right = (DIGIT.sub("0", " ".join(words).lower()) for words in (before, after))
    return left, right


def cut_run(digits: list[int]) -> Iterator[tuple[int, int]]:
    """Parts of a run of digit groups, given by their digits, that can each be one number.

    A run that repeats itself, as "867 5309 867 5310", is cut where it does if that gives numbers;
    else it is one number, or, with too many digits, cut as late as possible again and again.
    """
    size = len(digits)
    periods = (n for n in range(1, min(size, MOST_DIGITS + 1)) if digits[n:] == digits[:-n])
    period = next(periods, size)
    if size % period == 0 and LEAST_DIGITS <= sum(digits[:period]) <= MOST_DIGITS:
        yield from ((at, at + period) for at in range(0, size, period))
        return
    start, held = 0, 0
    for at, count in enumerate(digits):
        if at > start and held + count > MOST_DIGITS:
            yield start, at
            start, held = at, 0
        held += count
    yield start, size


def unwrapped(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without the brackets that enclose it or have no partner in it."""
    word = text[start:end]
    if word.startswith("(") and word.find(")") in (-1, len(word) - 1):
        start += 1
    if word.endswith(")") and word.rfind("(") in (-1, 0):
        end -= 1
    return start, end


def instances(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words with a digit or @ outside base spans; adjacent groups of digits are one, as cut above."""
    taken = sorted((start, end) for _, start, end in base)
    starts = np.array([start for start, _ in taken])
    reach = np.maximum.accumulate([end for _, end in taken]) if taken else starts
    run: list[tuple[int, int]] = []
    open_until = -1

    def parts() -> Iterator[tuple[int, int]]:
        for first, after in cut_run([len(DIGIT.findall(text[s:e])) for s, e in run]):
            start, end = run[first][0], run[after - 1][1]
            if after - first > 1:
                yield unwrapped(text, start, end)
            else:
                word = text[start:end].strip(WRAPPING)
                start += text[start:end].index(word)
                yield start, start + len(word)

    for match in WORD.finditer(text):
        raw = match.group()
        if not MARKED.search(raw):
            continue
        word = raw.strip(WRAPPING)
        start = match.start() + raw.index(word)
        end = start + len(word)
        before = np.searchsorted(starts, end) - 1
        if before >= 0 and reach[before] > start:
            continue
        bare = raw.strip(BREAKING)
        if not GROUP.fullmatch(bare) or len(DIGIT.findall(bare)) >= WHOLE_DIGITS:
            yield start, end
            continue
        own = match.start() + raw.index(bare)
        if run and not (
            own == match.start()
            and open_until == run[-1][1]
            and GAP.fullmatch(text, open_until, match.start())
        ):
            yield from parts()
            run = []
        run.append((own, own + len(bare)))
        open_until = match.end()
    if run:
        yield from parts()


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Base spans and identifier-like instances outside them, with their contexts."""
    found = [(start, end, 1 << kind, True) for kind, start, end in base]
    if MARKED.search(text):
        for start, end in instances(text, base):
            kinds = possible_kinds(text[start:end]) if end - start >= LEAST_LENGTH else 0
            if kinds:
                found.append((start, end, kinds, False))
    out = []
    for start, end, kinds, seed in found:
        left, right = contexts(text, start, end)
        out.append(
            {
                "start": start, "end": end, "kinds": kinds, "seed": seed,
                "word": text[start:end], "left": left, "right": right,
            }
        )
    return out


SPANS = "array<struct<kind:int,start:int,end:int>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
)
SEEN = (
    "array<struct<start:int,end:int,kinds:int,seed:boolean,word:string,left:string,right:string>>"
)
SEEN_TYPE = pa.list_(
    pa.struct(
        [
            ("start", pa.int32()), ("end", pa.int32()), ("kinds", pa.int32()),
            ("seed", pa.bool_()), ("word", pa.string()), ("left", pa.string()),
            ("right", pa.string()),
        ]
    )
)


def scan(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows with `base` and `seen` instead of the text."""
    docs = without(docs, "base", "seen")
    kept = [c for c in docs.columns if c != column]
    schema = docs.select(*kept).withColumns(
        {"base": F.lit(None).cast(SPANS), "seen": F.lit(None).cast(SEEN)}
    ).schema

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for group in row_groups(batch, column):
                texts = [t or "" for t in group.column(column).to_pylist()]
                base = [base_spans(t) for t in texts]
                seen = [occurrences(t, b) for t, b in zip(texts, base, strict=True)]
                spans = [
                    [{"kind": k, "start": s, "end": e} for k, s, e in own] for own in base
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[group.column(c) for c in kept],
                        pa.array(spans, SPAN_TYPE),
                        pa.array(seen, SEEN_TYPE),
                    ],
                    [*kept, "base", "seen"],
                )

    return map_batches(docs, run, schema)


def pattern_words() -> dict[str, Column]:
    """What can be a pattern: the words before, the words after, and a label just before."""
    last = F.substring_index("left", " ", -1)
    return {
        "left": F.col("left"),
        "right": F.col("right"),
        "label": F.when(last.rlike("[:=#]$"), last).otherwise(""),
    }


def graph(seen: DataFrame) -> DataFrame:
    """(pattern, instance, kind, shape, seed): one row for each edge, by kind.

    A pattern is a side and the words there; an instance is a hash of the word in lower case, its
    shape one of the word with digits as 0 and letters in a row as a.
    """
    sides = [
        F.struct(F.lit(side).alias("side"), words.alias("words"))
        for side, words in pattern_words().items()
    ]
    numbers = F.array(*[F.lit(k) for k in range(len(KINDS))])
    possible = F.filter(numbers, lambda k: F.col("kinds").bitwiseAND(_bit(k)) > 0)
    shape = F.regexp_replace(F.regexp_replace("word", "[0-9]", "0"), r"\p{L}+", "a")
    edges = seen.select(
        F.explode(F.array(*sides)).alias("pattern"),
        F.xxhash64(F.lower("word")).alias("instance"),
        F.xxhash64(shape).alias("shape"),
        possible.alias("possible"),
        "seed",
    ).filter("pattern.words <> ''")
    edges = edges.select(
        "pattern", "instance", "shape", F.explode("possible").alias("kind"), "seed"
    )
    return edges.groupBy("pattern", "instance", "kind").agg(
        F.min("shape").alias("shape"), F.max("seed").alias("seed")
    )


def _bit(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(1 << k) for k in range(len(KINDS))]), kind + 1)


def seeds_and_doubts(edges: DataFrame) -> DataFrame:
    """(instance, kind, seeded, doubt): whether it is a seed, and how likely one that is not is wrong.

    An instance that is no seed is unknown if it stands at a pattern with enough seeds, else a
    counter-example. The doubt is the share of counter-examples among those of the same shape.
    """
    seeded = F.col("seed").cast("int")
    near = edges.groupBy("pattern", "kind").agg(
        F.sum(seeded).alias("support"), F.count("*").alias("instances")
    )
    near = near.filter(
        (F.col("support") >= SUPPORT) & (F.col("support") >= NEAR * F.col("instances"))
    ).select("pattern", "kind", F.lit(1).alias("near"))
    found = edges.join(near, ["pattern", "kind"], "left").groupBy("instance", "kind").agg(
        F.max(seeded).cast("double").alias("seeded"),
        F.max(F.coalesce("near", F.lit(0))).alias("near"),
        F.min("shape").alias("shape"),
    )
    found = stored(found, "pii-instances")
    shapes = found.filter("seeded = 0").groupBy("shape", "kind").agg(
        F.avg(1 - F.col("near")).alias("doubt")
    )
    shapes = shapes.filter("doubt < 1")
    return found.join(shapes, ["shape", "kind"], "left").select(
        "instance", "kind", "seeded", F.coalesce("doubt", F.lit(1.0)).alias("doubt")
    )


def pattern_scores(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(pattern, kind, confidence, support): the scores of a pattern's instances against the doubts.

    What an instance lacks to the score 1 counts against the pattern by its doubt, and the less the
    more of the pattern's instances are scored. Half of them unknown is well above `CONFIDENCE`,
    whatever the doubt; a few scored among very many unknown are not.
    """
    scored = edges.join(scores, ["instance", "kind"])
    sums = scored.groupBy("pattern", "kind").agg(
        F.sum("score").alias("support"),
        F.sum((1 - F.col("score")) * F.col("doubt")).alias("doubts"),
        F.count("*").alias("instances"),
    )
    unscored = 1 - F.col("support") / F.col("instances")
    against = F.col("doubts") * unscored * unscored
    confidence = F.when(
        F.col("support") > 0, F.col("support") / (F.col("support") + against)
    ).otherwise(0.0)
    return sums.select("pattern", "kind", "support", confidence.alias("confidence"))


def learn_patterns(edges: DataFrame) -> DataFrame:
    """(pattern, kind) of high confidence after some passes of scores over the graph.

    Seeds keep the score 1. Another instance gets the chance that at least one of its trusted
    patterns is right. A pattern's support is the sum of the scores of its distinct instances, its
    confidence that sum against the doubts in the others; it is trusted from `SUPPORT` and `CONFIDENCE` on. Each pass stores its
    scores, sums combine before they are exchanged, and nothing reaches the driver.
    """
    edges = stored(edges, "pii-edges")
    seeds = stored(seeds_and_doubts(edges), "pii-seeds")
    scores, trusted = seeds.withColumnRenamed("seeded", "score"), None
    for _ in range(PASSES):
        patterns = pattern_scores(edges, scores)
        trusted = patterns.filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))
        trusted = stored(trusted, "pii-patterns")
        doubt = F.sum(F.log1p(-F.least("confidence", F.lit(0.999))))
        voted = edges.join(trusted, ["pattern", "kind"]).groupBy("instance", "kind")
        voted = stored(voted.agg((1 - F.exp(doubt)).alias("voted")), "pii-votes")
        score = F.greatest("seeded", F.coalesce("voted", F.lit(0.0)))
        scores = seeds.join(voted, ["instance", "kind"], "left").select(
            "instance", "kind", score.alias("score"), "doubt"
        )
        scores = stored(scores, "pii-scores")
    return trusted.select("pattern", "kind")


def personal_data(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, base, added): the spans found in every whole text, in code points, end exclusive.

    `base` are those of the formats, `added` those of the learnt patterns, never overlapping a base
    span; a word that patterns of several kinds mark is added for each. Kinds are numbered as in
    `KINDS`. Null and empty texts have none. Repeated rows stay repeated and count once in learning.
    Extra columns are left out. An empty table gives an empty one.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(column).alias("text"))
    scanned = stored(
        scan(rows).withColumn("row", F.monotonically_increasing_id()), "pii-scanned"
    )
    seen = scanned.select("row", F.explode("seen").alias("one")).select("row", "one.*")
    edges = graph(seen)
    trusted = stored(learn_patterns(edges), "pii-trusted")
    unknown = seen.filter("not seed")
    marked = None
    for side, words in pattern_words().items():
        own = trusted.filter(F.col("pattern.side") == side)
        own = own.select(F.col("pattern.words").alias("words"), "kind")
        possible = F.col("kinds").bitwiseAND(_bit(F.col("kind"))) > 0
        found = unknown.withColumn("words", words).join(own, "words").filter(possible).select("row", "kind", "start", "end")
        marked = found if marked is None else marked.unionByName(found)
    spans = marked.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("kind", "start", "end"))).alias("added")
    )
    joined = scanned.drop("seen").join(stored(spans, "pii-added"), "row", "left")
    added = F.coalesce("added", F.array().cast(SPANS))
    return joined.select(F.col("id").alias(key), "base", added.alias("added"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, in order of kind and start, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    texts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
    )
    return F.array_join(texts, ",")


def count_of(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("long")
