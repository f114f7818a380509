from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import corpus_pipeline
from tests.llm.helpers import empty, odd_documents
from tripmill.llm import bytebpe, queries


@pytest.fixture(scope="module")
def stages(spark, data_dir, tmp_path_factory):
    """What each stage returns, written and read again as a driver does."""
    docs, out = spark.read.parquet(f"{data_dir}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, data_dir).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def ids(df):
    return {row[0] for row in df.select("doc_id").distinct().collect()}


def test_columns_and_order(stages):
    names = list(stages)
    assert names == ["documents", *[name for name, _ in corpus_pipeline.STAGES]]
    for name in names[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_stages_take_effect(stages):
    before, accepted = ids(stages["documents"]), ids(stages["language_id"])
    assert accepted <= before and len(accepted) > 0.98 * len(before)
    lined = stages["line_dedup"]
    assert ids(lined) == accepted
    assert lined.filter("n_chars <> char_length(text)").count() == 0
    kept = stages["simhash_dedup"]
    assert kept.count() == len(ids(kept)) < lined.count()
    assert ids(stages["source_mixing"]) == ids(kept)
    tokens = stages["byte_bpe"]
    assert tokens.count() == stages["source_mixing"].count()
    assert tokens.filter(~F.col("round_trip")).count() == 0


def test_near_duplicates_against_brute_force(stages):
    from tests.llm.test_simhash import plain_components, plain_fingerprint

    rows = stages["line_dedup"].select("doc_id", "text").collect()
    marks = {row[0]: plain_fingerprint(row[1]) for row in rows}
    assert ids(stages["simhash_dedup"]) == set(plain_components(marks, 3).values())


def test_ids_are_those_of_the_codec(stages):
    codec = bytebpe.ByteBpe(bytebpe.read_ranks(queries.BYTE_BPE), public_tokenizers.PATTERN)
    texts = dict(stages["source_mixing"].select("doc_id", "text").limit(40).collect())
    for row in stages["byte_bpe"].filter(F.col("doc_id").isin(list(texts))).collect():
        assert bytes(row["ids"]) == codec.encode_all([texts[row["doc_id"]]])[0]


def test_run_is_the_stages(spark, data_dir, stages):
    got = corpus_pipeline.run(spark, data_dir)
    digest = F.sum(F.crc32("ids") + F.coalesce("doc_id", F.lit(0)))
    assert got.agg(F.count("*"), digest).first() == stages["byte_bpe"].agg(F.count("*"), digest).first()


@pytest.mark.parametrize("make", [odd_documents, empty])
def test_stages_on_odd_rows(spark, make):
    docs = make(spark).withColumn("owner", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "").cache()
        docs.count()


def test_registered():
    names = set(registry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert len({name.split("_")[0] for name in queries.QUERIES}) == 13
    assert set(queries.ORACLE_SQL) <= set(registry.oracle_sql())
