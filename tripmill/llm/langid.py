"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text's features are the hashed letter n-grams of its words, word boundaries included. Their
embeddings are averaged, a linear layer and a softmax follow. Embeddings and layer are trained by
stochastic gradient descent on a bounded, documented sample of labelled rows; a temperature and a
rejection threshold are fitted on a part of that sample the training does not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import map_batches, row_groups, without

UNDETERMINED = "und"
BUCKET_BITS = 15
ORDERS = 4
DIMENSIONS = 16
# Characters whose features are held at once; a word across such a border counts as two.
CHUNK_CHARS = 1 << 19
# Words of the windows that one sampled text gives to the training, and the most characters that
# such a window has for each of them, for texts without blanks.
WINDOW_WORDS, WORD_CHARS = (4, 12, 160), 32
HASH_FACTOR = np.uint64(0x9E3779B97F4A7C15)
CALIBRATION_SHARE = 5
# Groups of languages that are left out in turn, and the share of their texts to be rejected.
LEFT_OUT, UNLEARNT_REJECTED = 4, 0.99


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def features(text: str) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, chunk by chunk."""
    lowered = text.lower()
    for start in range(0, len(lowered), CHUNK_CHARS):
        raw = lowered[start : start + CHUNK_CHARS].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, "<u4")
        codes = np.where(_letters()[codes], codes, 0)
        codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
        gap = codes == 0
        codes = codes[~(gap & np.concatenate(([False], gap[:-1])))]
        gap = codes == 0
        rolled, inner, found = codes, np.zeros(len(codes), bool), []
        for order in range(1, ORDERS + 1):
            if order > 1:
                if len(rolled) < 2:
                    break
                inner = inner[:-1] | (gap[order - 2 : -1] if order > 2 else False)
                rolled = rolled[:-1] * HASH_FACTOR + codes[order - 1 :]
            valid = ~inner if order > 1 else ~gap
            mixed = (rolled[valid] + np.uint64(order)) * HASH_FACTOR
            mixed ^= mixed >> np.uint64(29)
            found.append((mixed * HASH_FACTOR >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        yield np.concatenate(found)


@dataclass(frozen=True)
class LanguageModel:
    """What training leaves: under 3 MB, whatever the input."""

    languages: tuple[str, ...]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, text: str) -> np.ndarray:
        total, count = np.zeros(DIMENSIONS), 0
        for buckets in features(text):
            total += self.embeddings[buckets].sum(0, dtype=np.float64)
            count += len(buckets)
        return self._chances(total / max(count, 1))

    def _chances(self, mean: np.ndarray) -> np.ndarray:
        return softmax((mean @ self.weights + self.bias)[None, :] / self.temperature)[0]

    def best_of_counts(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        """Language and calibrated probability of a text given by how often it has each bucket."""
        chances = self._chances(counts @ self.embeddings[buckets].astype(np.float64) / counts.sum())
        return self.languages[int(chances.argmax())], float(chances.max())

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, rejected."""
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        chances = self.probabilities(text)
        best = int(chances.argmax())
        score = float(chances[best])
        return self.languages[best], score, score < self.threshold


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(1, keepdims=True))
    return raised / raised.sum(1, keepdims=True)


def held_out(key: str = "doc_id") -> Column:
    """Whether a row is kept from training; a null key is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(4)) == 2, F.lit(False))


def training_windows(
    docs: DataFrame, per_language: int, seed: int
) -> tuple[list[tuple], list[tuple]]:
    """The sampled rows' windows as (language, calibration, buckets), in a fixed order.

    And the whole texts that are held back for calibration, as (language, buckets, counts).

    Rows are chosen by a hash of key and text at the rate that gives `per_language` rows of each
    language, twice that at most. Rows that are held out, or lack a language, a key or letters,
    are not learned from. Only windows of bounded size and counts by bucket leave the tasks, so a
    text of any length sends under half a megabyte.
    """
    labelled = docs.select(
        F.col("doc_id").alias("id"), F.col("text").alias("text"), F.col("lang").alias("lang")
    ).filter(~held_out("id") & F.col("id").isNotNull() & F.col("lang").isNotNull())
    counts = {row[0]: row[1] for row in labelled.groupBy("lang").count().collect()}
    if not counts:
        return [], []
    span = 1 << 30
    limits = [
        x
        for lang, count in counts.items()
        for x in (F.lit(lang), F.lit(min(span, -(-per_language * span // count))))
    ]
    drawn = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(span))
    sample = labelled.filter(drawn < F.create_map(*limits)[F.col("lang")])
    most = 2 * per_language * len(counts) * (1 + len(WINDOW_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if not has_letter(row["text"]):
                    continue
                words = row["text"].split()
                mark = crc32(f"{seed} {row['id']}".encode())
                if held_back(mark):
                    counts = np.zeros(1 << BUCKET_BITS, np.int64)
                    for buckets in features(row["text"]):
                        counts += np.bincount(buckets, minlength=len(counts))
                    own = np.flatnonzero(counts)
                    pairs = np.concatenate((own, counts[own])).astype("<i4").tobytes()
                    rows.append((row["lang"], mark, 0, pairs))
                for size in WINDOW_WORDS:
                    window = window_of(words, size, mark)
                    buckets = np.concatenate([np.zeros(0, np.int64), *features(window)])
                    if len(buckets):
                        rows.append(
                            (row["lang"], mark, size, buckets.astype("<i4").tobytes())
                        )
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.binary()),
                ],
                ["lang", "mark", "size", "buckets"],
            )

    found = map_batches(sample, run, "lang string, mark long, size int, buckets binary")
    rows = found.limit(most).orderBy("lang", "mark", "size", "buckets").collect()
    windows = [
        (lang, held_back(mark), np.frombuffer(buckets, "<i4"))
        for lang, mark, size, buckets in rows
        if size
    ]
    texts = [
        (lang, *np.frombuffer(pairs, "<i4").reshape(2, -1))
        for lang, _, size, pairs in rows
        if not size
    ]
    return windows, texts


def window_of(words: list[str], size: int, mark: int) -> str:
    """Some words in a row, at a place by a hash; a part of them where they are very long."""
    at = mark % max(1, len(words) - size)
    window, most = " ".join(words[at : at + size]), size * WORD_CHARS
    at = mark % max(1, len(window) - most) if len(window) > most else 0
    return window[at : at + most]


def held_back(mark: int) -> bool:
    return (mark >> 8) % CALIBRATION_SHARE == 0


def descend(
    examples: list[np.ndarray], labels: np.ndarray, classes: int, epochs: int, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, weights and bias after minibatch gradient descent with a falling rate."""
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    weights = random.normal(0, 0.1, (DIMENSIONS, classes)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    size = 16
    steps, step = epochs * -(-len(examples) // size), 0
    for _ in range(epochs):
        order = random.permutation(len(examples))
        for start in range(0, len(order), size):
            rate = np.float32(1 - step / steps)
            step += 1
            chosen = order[start : start + size]
            lengths = np.array([len(examples[i]) for i in chosen])
            buckets = np.concatenate([examples[i] for i in chosen])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            means = np.add.reduceat(embeddings[buckets], starts, 0) / lengths[:, None]
            wrong = softmax(means @ weights + bias).astype(np.float32)
            wrong[np.arange(len(chosen)), labels[chosen]] -= 1
            pull = (wrong @ weights.T / lengths[:, None]).astype(np.float32)
            weights -= rate * 0.3 * (means.T @ wrong).astype(np.float32)
            bias -= rate * np.float32(0.02) * wrong.sum(0)
            np.add.at(embeddings, buckets, -rate * np.float32(3.0) * np.repeat(pull, lengths, 0))
    return embeddings, weights, bias


def calibrate(
    logits: np.ndarray, labels: np.ndarray, lost: float, most: float
) -> tuple[float, float]:
    """Temperature of the lowest log loss, and a threshold for the calibrated probability.

    The threshold is so low that at most a share `lost` of the rightly predicted windows is below
    it, and never above `most`.
    """
    if not len(labels):
        return 1.0, most
    every = np.arange(len(labels))
    temperatures = np.geomspace(0.2, 20, 60)
    losses = [
        -np.log(np.maximum(softmax(logits / t)[every, labels], 1e-12)).mean() for t in temperatures
    ]
    temperature = float(temperatures[int(np.argmin(losses))])
    chances = softmax(logits / temperature)
    right = np.sort(chances.max(1)[chances.argmax(1) == labels])
    least = right[int(lost * len(right))] if len(right) else most
    return temperature, min(most, float(least))


def rejection(known: list[float], unknown: list[float], lost: float, least: float) -> float:
    """The threshold for whole texts from scores of learnt and of unlearnt languages.

    The lowest that rejects all of the unlearnt but a hundredth, or `least` if there are none; but
    at most a share `lost` of the learnt may be below it. Fewer texts than show such a share lower
    the least odds seen by as much as they are too few.
    """
    if not known:
        return 0.0
    if unknown:
        least = sorted(unknown)[min(int(UNLEARNT_REJECTED * len(unknown)), len(unknown) - 1)]
        least = float(np.nextafter(least, 1))
    lowest = sorted(known)[int(lost * len(known))]
    few = min(1.0, lost * len(known))
    return min(least, lowest * few / (lowest * few + 1 - lowest))


def train(
    docs: DataFrame,
    per_language: int = 600,
    epochs: int = 6,
    lost: float = 0.001,
    seed: int = 7,
) -> LanguageModel:
    """Fits the model on about `per_language` labelled rows of each language.

    Its threshold comes from the held-back texts: as the model scores those of learnt languages,
    and as models that lack a language score its texts. Languages are left out in at most
    `LEFT_OUT` groups; of two languages none, since a model of one is always sure. Without any
    labelled row the model knows no language and predicts `und`.
    """
    windows, texts = training_windows(docs, per_language, seed)
    languages = sorted({lang for lang, _, _ in windows})
    if not languages:
        empty = np.zeros((1 << BUCKET_BITS, DIMENSIONS), np.float32)
        return LanguageModel((), empty, np.zeros((DIMENSIONS, 0)), np.zeros(0), 1.0, 0.0)
    model, unknown = fit(windows, epochs, lost, seed), []
    groups = min(LEFT_OUT, len(languages)) if len(languages) > 2 else 0
    for group in range(groups):
        left = set(languages[group::groups])
        other = fit([w for w in windows if w[0] not in left], epochs, lost, seed)
        unknown += [other.best_of_counts(*own)[1] for lang, *own in texts if lang in left]
    scored = [(lang, *model.best_of_counts(*own)) for lang, *own in texts]
    known = [score for lang, best, score in scored if lang == best]
    return replace(model, threshold=rejection(known, unknown, lost, model.threshold))


def fit(windows: list[tuple], epochs: int, lost: float, seed: int) -> LanguageModel:
    """The model of the windows' languages, its threshold one that loses a share of windows."""
    languages = tuple(sorted({lang for lang, _, _ in windows}))
    number = {lang: i for i, lang in enumerate(languages)}
    learnt = [w for w in windows if not w[1]] or windows
    labels = np.array([number[lang] for lang, _, _ in learnt])
    embeddings, weights, bias = descend(
        [buckets for _, _, buckets in learnt], labels, len(languages), epochs, seed
    )
    kept = [w for w in windows if w[1]]
    means = [embeddings[buckets].mean(0, dtype=np.float64) for _, _, buckets in kept]
    logits = np.array(means).reshape(-1, DIMENSIONS) @ weights + bias
    truth = np.array([number[lang] for lang, _, _ in kept], int)
    temperature, threshold = calibrate(logits, truth, lost, 1.0)
    return LanguageModel(languages, embeddings, weights, bias, temperature, threshold)


def identify(docs: DataFrame, model: LanguageModel, keep_text: bool = True) -> DataFrame:
    """Adds `lang_pred`, `score` and `rejected` to every row, predicted from the whole text.

    Null texts and texts without a letter are `und` with score 0 and rejected. Columns of those
    names give way; others pass through. Repeated rows stay repeated.
    """
    docs = without(docs, "lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if keep_text or c != "text"]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = schema.withColumns(
        {"lang_pred": F.lit(""), "score": F.lit(0.0), "rejected": F.lit(True)}
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in row_groups(batch, "text"):
                found = [shared.value.predict(t) for t in group.column("text").to_pylist()]
                columns = [group.column(c) for c in kept]
                for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_())):
                    columns.append(pa.array([x[i] for x in found], kind))
                yield pa.RecordBatch.from_arrays(
                    columns, [*kept, "lang_pred", "score", "rejected"]
                )

    return map_batches(docs, run, schema)


def accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose language the model does not reject, with the columns of `docs`."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text")
    )
    return identify(rows, model, keep_text=False).filter(~F.col("rejected")).select("doc.*")
