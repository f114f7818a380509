from __future__ import annotations

from zlib import crc32

import numpy as np

from tests.llm.helpers import ENGLISH, GERMAN, documents, empty, odd_documents, with_clashing
from tripmill.llm import langid, queries


def test_held_out_accuracy(spark, data_dir):
    got = queries.op1_language_id(spark, data_dir).collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "lang", "text")
    truth = {row[0]: (row[1], row[2]) for row in docs.collect()}
    assert len(got) == len(truth)
    held = [row for row in got if row["held_out"]]
    assert {row["doc_id"] for row in held} == {
        i for i in truth if crc32(str(i).encode()) % 4 == 2
    }
    right = [row["lang_pred"] == truth[row["doc_id"]][0] for row in held]
    assert np.mean(right) >= 0.97
    assert np.mean([row["rejected"] for row in got]) < 0.01
    assert all(0 <= row["score"] <= 1 for row in got)


def small_model(spark):
    words = {"en": ENGLISH.split(), "de": GERMAN.split()}
    rows = [
        (i, " ".join(np.random.default_rng(i).choice(words[lang], 12)), lang, "s")
        for i, lang in enumerate(["en", "de"] * 60)
    ]
    return langid.train(documents(spark, rows), epochs=10)


def test_odd_rows(spark):
    model = small_model(spark)
    docs = with_clashing(odd_documents(spark))
    found = langid.identify(docs, model)
    rows = found.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row["lang_pred"] in ("en", "de", "und")
        assert (row["lang_pred"] == "und") == (not langid.has_letter(row["text"]))
    known = {row["doc_id"]: row["lang_pred"] for row in rows}
    assert known[1] == "en" and known[3] == "de" and known[7] == "en"
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {1, 2, 3, 7} <= {row["doc_id"] for row in kept.collect()}
    assert not {4, 5, 6, 9} & {row["doc_id"] for row in kept.collect()}


def test_unlearnt_languages_go_and_learnt_ones_stay(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = [row for row in docs.collect() if langid.has_letter(row["text"])]
    for out in ("fr", "de"):
        model = langid.train(docs.filter(docs["lang"] != out))
        gone = {known: [] for known in (True, False)}
        for row in rows:
            gone[row["lang"] != out].append(model.predict(row["text"])[2])
        assert np.mean(gone[False]) >= 0.5
        assert np.mean(gone[True]) <= 0.005


def test_rejection():
    known, unknown = [0.9 + i / 10_000 for i in range(1000)], [i / 200 for i in range(100)]
    assert langid.rejection(known, unknown, 0.001, 0.5) == np.nextafter(0.495, 1)
    assert abs(langid.rejection(known, [0.99] * 9, 0.001, 0.5) - known[1]) < 1e-9
    few = langid.rejection(known[::10], [0.99] * 9, 0.001, 0.5)
    assert abs(few / (1 - few) - 0.9) < 1e-9
    assert langid.rejection(known, [], 0.001, 0.6) == 0.6
    assert langid.rejection([], [0.5], 0.001, 0.6) == 0.0


def test_texts_without_blanks_send_bounded_windows(spark):
    """A million letters without a blank are one word; windows and counts stay small."""
    signs = "".join(chr(0x4E00 + i * 7919 % 20_000) for i in range(1_000_000))
    rows = [(i, signs[i:] + signs[:i], "zh", "s") for i in range(20)]
    windows, texts = langid.training_windows(documents(spark, rows), 600, 7)
    assert 3 * 10 < len(windows) <= 3 * 20
    longest = langid.ORDERS * (max(langid.WINDOW_WORDS) * langid.WORD_CHARS + 2)
    assert max(len(buckets) for _, _, buckets in windows) <= longest
    assert all(len(buckets) <= 1 << langid.BUCKET_BITS for _, buckets, _ in texts)
    lengths = {len(langid.window_of(["x" * 40] * 300, size, 5)) for size in langid.WINDOW_WORDS}
    assert lengths == {size * langid.WORD_CHARS for size in langid.WINDOW_WORDS}
    assert langid.window_of(["ab", "cd", "ef"], 4, 5) == "ab cd ef"


def test_same_result_again(spark):
    first, second = small_model(spark), small_model(spark)
    assert np.array_equal(first.embeddings, second.embeddings)
    assert first.threshold == second.threshold


def test_without_labels(spark):
    model = langid.train(empty(spark))
    assert model.predict("some text") == ("und", 0.0, True)
    docs = documents(spark, [(1, ENGLISH, None, "a")])
    assert langid.identify(docs, langid.train(docs)).first()["lang_pred"] == "und"
    assert langid.identify(empty(spark), model).collect() == []


def test_long_text_counts_every_character():
    text = "ab " * langid.CHUNK_CHARS
    assert sum(len(x) for x in langid.features(text)) >= 2 * langid.CHUNK_CHARS


def test_threshold_loses_few_that_are_right():
    logits = np.array([[4.0, 0], [3.0, 0], [0.6, 0], [0.1, 0], [0, 0.05]])
    truth = np.array([0, 0, 0, 1, 0])
    temperature, threshold = langid.calibrate(logits, truth, 0.0, 0.99)
    chances = langid.softmax(logits / temperature).max(1)
    assert (chances >= threshold).tolist() == [True, True, True, False, False]
    assert langid.calibrate(logits, truth, 0.0, 0.3)[1] == 0.3
