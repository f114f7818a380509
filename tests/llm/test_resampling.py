from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ENGLISH, documents, empty, odd_documents, rows_of, with_clashing
from tests.oracle import connect, rows_of_spark, rows_of_sql
from tripmill.llm import queries, resampling

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text):
    words = re.findall(WORDS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def drawn(rows, target, buckets, percent, seed, least):
    """The plain form over (doc_id, text) rows with distinct ids."""

    def counts(texts):
        found = Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])
        return found, sum(found.values())

    (own, all_own), (wanted, all_wanted) = counts(t for _, t in rows), counts(target)
    out = []
    for doc_id, text in rows:
        words, found = features(text)
        gains = []
        for feature in found:
            b = zlib.crc32(feature.encode()) % buckets
            ratio = (wanted[b] + 1) * (all_own + buckets) / ((own[b] + 1) * (all_wanted + buckets))
            gains.append(math.floor(1000 * math.log(ratio)))
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(found), weight, weight + noise, len(words)))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0]))
    ranks = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted((*r[:4], ranks.get(r[0])) for r in out)


def test_query_against_sql(spark, data_dir):
    got = rows_of_spark(queries.op11_importance_resampling(spark, data_dir))
    assert got == rows_of_sql(connect(data_dir), queries.RESAMPLING_SQL)


@pytest.mark.parametrize("window", [4, 64, 1 << 20])
def test_against_the_plain_form(spark, monkeypatch, window):
    monkeypatch.setattr(resampling, "WINDOW", window)
    odd = "Grüße ÄÖ, naïve-x 東京 0a\x00b\x7fc ſK \n\n a-b"
    texts = [odd, None, "", "A a A", *[f"{ENGLISH} {i} {odd}" * (i % 3) for i in range(40)]]
    rows = list(enumerate(texts))
    target = [ENGLISH, "0a b c", None]
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, wanted, 40, 50, 2, 3, 9)
    assert rows_of(got) == sorted(drawn(rows, target, 50, 40, 9, 3), key=repr)


def test_runs_never_leave_their_text():
    texts = [b"a b", b"c", None, b"", b"d e f"]
    found = [(n, rows.tolist()) for n, rows, _ in resampling.hashed_runs(texts, 3)]
    assert found == [(1, [0, 0, 1, 4, 4, 4]), (2, [0, 4, 4]), (3, [4])]


def test_windows_give_the_same_runs(monkeypatch):
    texts = [ENGLISH.encode() * 5, b"x", b"y" * 100 + b" z"]

    def all_runs():
        found = Counter()
        for length, rows, values in resampling.hashed_runs(texts, 3):
            found.update(zip([length] * len(rows), rows.tolist(), values.tolist()))
        return found

    whole = all_runs()
    for window in (1, 7, 50):
        monkeypatch.setattr(resampling, "WINDOW", window)
        assert all_runs() == whole


def test_odd_rows(spark):
    docs = with_clashing(odd_documents(spark)).withColumn("rank", F.lit("mine"))
    got = resampling.resample(docs, docs, percent=100, least_words=1).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[4]["n_features"] == by_id[5]["weight"] == 0 and by_id[6]["rank"] is None
    ranks = sorted(r["rank"] for r in got if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1))
    twice = sorted(r["rank"] for r in got if r["doc_id"] == 1)
    assert len(twice) == 2 and twice[1] == twice[0] + 1


def test_empty_tables(spark):
    docs = documents(spark, [(1, ENGLISH, "en", "a")])
    assert resampling.resample(empty(spark), docs).count() == 0
    row = resampling.resample(docs, empty(spark), percent=100, least_words=1).first()
    assert row["rank"] == 1 and np.isfinite(row["score"])
