from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, empty, odd_documents, rows_of, with_clashing
from tripmill.llm import mixing, queries


BLOCK = 70


def sized(spark, sizes, words=7):
    rows = [
        (10_000 * i + j, "w " * words, "en", name)
        for i, (name, count) in enumerate(sizes.items())
        for j in range(count)
    ]
    return documents(spark, rows)


def plain_exponent(tokens, entropy, repeats, budget):
    total = sum(tokens.values())
    shares = [t / total for t in tokens.values() if t]

    def state(e):
        z = sum(p**e for p in shares)
        q = [p**e / z for p in shares]
        most = budget or total * z * max(shares) ** (1 - e)
        return (
            -sum(x * math.log(x) for x in q),
            max(x * most / (p * total) for x, p in zip(q, shares)),
        )

    grid = [i / 20000 for i in range(20001)]
    exponent = 1.0
    if entropy is not None:
        exponent = max(e for e in grid if state(e)[0] >= entropy * math.log(len(shares)) - 1e-9)
    elif repeats is not None:
        exponent = 0.0
    if repeats is not None:
        allowed = [e for e in grid if e >= exponent and state(e)[1] <= repeats + 1e-9]
        exponent = min(allowed, default=1.0)
    return exponent


@pytest.mark.parametrize(
    "entropy, repeats, budget",
    [(0.9, None, None), (0.95, 2.0, None), (None, 3.0, None), (0.99, 1.5, 2000), (None, None, 900)],
)
def test_weights_and_budgets(spark, entropy, repeats, budget):
    sizes = {"a": 200, "b": 90, "c": 60, "d": 41}
    docs = sized(spark, sizes)
    tokens = {name: 7 * count for name, count in sizes.items()}
    total = sum(tokens.values())
    exponent = plain_exponent(tokens, entropy, repeats, budget)
    mixed = mixing.mix(docs, entropy, repeats, budget, block_tokens=BLOCK).collect()
    powers = {name: (t / total) ** exponent for name, t in tokens.items()}
    weights = {name: x / sum(powers.values()) for name, x in powers.items()}
    found = {row["source"]: row["mix_weight"] for row in mixed}
    assert found == pytest.approx(weights, rel=2e-4)
    whole = budget or max(tokens[n] / weights[n] for n in tokens)
    drawn = Counter(row["source"] for row in mixed)
    for name in tokens:
        quota = weights[name] * whole
        assert quota * 0.999 - 8 <= 7 * drawn[name] <= quota * 1.001 + 1
    passes = defaultdict(Counter)
    for row in mixed:
        passes[row["source"], row["mix_epoch"]][row["doc_id"]] += 1
    for (name, epoch), ids in passes.items():
        assert max(ids.values()) == 1
        if (name, epoch + 1) in passes:
            assert len(ids) == sizes[name]


def test_partial_pass_takes_whole_blocks_in_order(spark):
    docs = sized(spark, {"a": 400})
    some = mixing.mix(docs, None, None, 1400, block_tokens=BLOCK).collect()
    whole = mixing.mix(docs, None, None, None, block_tokens=BLOCK).collect()
    taken, every = Counter(r["mix_order"] for r in some), Counter(r["mix_order"] for r in whole)
    order = sorted(every)
    last = max(order.index(o) for o in taken)
    assert all(taken[o] == every[o] for o in order[:last])
    assert 1400 - 7 < 7 * sum(taken.values()) <= 1400


def test_query_keeps_every_document(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    mixed = queries.op4_source_mixing(spark, data_dir)
    counts = mixed.groupBy("doc_id").count()
    assert counts.count() == docs.select("doc_id").distinct().count()
    assert counts.agg(F.max("count")).first()[0] <= queries.MIX_REPEATS
    assert mixed.select("doc_id", "mix_epoch").distinct().count() == mixed.count()


def check_order(rows, tokens, passes, block_tokens):
    """Rows stand in blocks by position; each pass permutes the blocks; copies are a pass apart."""
    parts = {name: max(1, math.ceil(n / block_tokens)) for name, n in tokens.items()}
    keys = [r["mix_position"] for r in rows]
    assert keys == sorted(keys)
    blocks = [(r["source"], r["mix_epoch"], r["mix_order"]) for r in rows]
    changes = sum(a != b for a, b in zip(blocks, blocks[1:]))
    assert changes == len(set(blocks)) - 1
    for row in rows:
        within = row["mix_epoch"] + (row["mix_order"] + 0.5) / parts[row["source"]]
        assert row["mix_position"] == pytest.approx(within / passes[row["source"]], rel=1e-3)
    assert all(0 <= order < parts[name] for name, _, order in blocks)
    at = defaultdict(list)
    for row in rows:
        at[row["doc_id"]].append(row["mix_epoch"])
    assert all(epochs == sorted(set(epochs)) for epochs in at.values())


def test_sources_take_turns_by_weight(spark):
    sizes = {"a": 2000, "b": 900, "c": 600, "d": 410}
    rows = mixing.mix(sized(spark, sizes), 0.97, 2.0, block_tokens=BLOCK).collect()
    weights = {row["source"]: row["mix_weight"] for row in rows}
    whole = max(sizes[name] / weights[name] for name in sizes)
    passes = {name: weights[name] * whole / sizes[name] for name in sizes}
    check_order(rows, {name: 7 * n for name, n in sizes.items()}, passes, BLOCK)
    assert len(rows) > sum(sizes.values())
    assert all(a["doc_id"] != b["doc_id"] for a, b in zip(rows, rows[1:]))
    seen = Counter()
    for count, row in enumerate(rows, 1):
        seen[row["source"]] += 1
        if count >= 1000:
            assert all(abs(seen[name] / count - weights[name]) < 0.06 for name in sizes)


def test_query_rows_stand_in_order(spark, data_dir):
    rows = queries.op4_source_mixing(spark, data_dir).collect()
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").select("source", "text").collect()
    tokens = Counter()
    for source, text in docs:
        tokens[source] += len((text or "").split())
    exponent = plain_exponent(tokens, queries.MIX_ENTROPY, queries.MIX_REPEATS, None)
    # With the least budget that reads every source, passes go by (greatest / own) ** (1 - exponent).
    most = max(tokens.values())
    passes = {name: (most / n) ** (1 - exponent) for name, n in tokens.items()}
    check_order(rows, tokens, passes, queries.MIX_BLOCK)


@pytest.mark.parametrize("blocks", [1, 2, 7, 64, 1000, 4095])
def test_places_are_permutations(spark, blocks):
    rows = spark.range(blocks).select(
        F.lit("a").alias("source"), F.col("id").alias("hash"), F.lit(blocks).cast("long").alias("blocks")
    )
    orders = set()
    for epoch in range(9):
        place = mixing._block_place(11, F.lit(epoch).cast("long"))
        order = [row[0] for row in rows.select(place, "hash").orderBy("hash").collect()]
        assert sorted(order) == list(range(blocks))
        orders.add(tuple(order))
    assert len(orders) > 5 or blocks < 64


def test_blocks_of_one_source_are_summed_in_ranges(spark):
    """However many blocks a source has, no window holds them all."""
    docs = sized(spark, {"a": 3000, "b": 40})
    few = mixing.mix(docs, None, None, 15_000, block_tokens=BLOCK)
    assert 15_000 * 0.98 < 7 * few.count() <= 15_000


def test_odd_rows(spark):
    docs = with_clashing(odd_documents(spark))
    mixed = mixing.mix(docs)
    assert set(mixed.columns) == set(docs.columns)
    rows = mixed.collect()
    want = Counter(row["doc_id"] for row in docs.collect())
    first = Counter(row["doc_id"] for row in rows if row["mix_epoch"] == 0)
    assert first == want
    assert {row["source"] for row in rows} == {"a", "b", "c", None}


def test_without_tokens_and_empty(spark):
    docs = documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])
    assert {row["doc_id"] for row in mixing.mix(docs).collect()} == {1, 2}
    assert rows_of(mixing.mix(empty(spark))) == []
