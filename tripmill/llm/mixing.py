"""Mixing sources to target weights by a temperature.

Source token shares are raised to an exponent between 1 (as they are) and 0 (all alike). The
exponent is bisected until the mixture has a target entropy, or until no source is repeated more
often than a limit. The normalised weights become token budgets, and each source fills its budget
with permutations of its blocks: whole epochs first, then the first blocks of one more permutation,
the last of them in part. Every source's blocks are spread evenly over the mixture, so rows leave in
an order in which each stretch holds the sources by their weights.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import stored, without
from tripmill.operators.sequence import in_parts, running_total

# Tokens of a block. Blocks are what a permutation moves, and what sources take turns by.
BLOCK_TOKENS = 1 << 18
# The greatest primes below 2 ** 31. A source has fewer blocks, so each of them, times a
# block's number, modulo the blocks, permutes the blocks; passes take them in turn.
MULTIPLIERS = (
    2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497,
)
# Halvings of the exponent's interval per Spark job, and in all.
HALVINGS, PRECISION = 4, 32


@dataclass(frozen=True)
class Mixture:
    """The exponent, and the sums that turn shares into weights and budgets."""

    exponent: float
    total: int
    scale: float
    budget: float


def tokens_of(text: str | Column) -> Column:
    """Words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent: the sum of powers, and of powers times log share."""
    share = F.col("share")
    powers = [F.pow(share, F.lit(e)) for e in exponents]
    row = shares.agg(*[x for p in powers for x in (F.sum(p), F.sum(p * F.log(share)))]).first()
    return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]


def _bisect(shares: DataFrame, holds: Callable[[float, float, float], bool], rising: bool) -> float:
    """The end of the exponents in [0, 1] for which a monotone condition holds.

    `rising`: it holds from some exponent upwards, and the least such is wanted; otherwise up to
    some exponent, and the greatest is wanted. One job evaluates the interior points of several
    halvings.
    """
    low, high, parts = 0.0, 1.0, 1 << HALVINGS
    for _ in range(PRECISION // HALVINGS):
        points = [low + (high - low) * i / parts for i in range(1, parts)]
        met = [holds(e, *sums) for e, sums in zip(points, _sums(shares, points), strict=True)]
        wanted = [not m if rising else m for m in met]
        ends = [low, *points, high]
        at = sum(wanted)
        low, high = ends[at], ends[at + 1]
    return high if rising else low


def solve(
    sizes: DataFrame, entropy: float | None, repeats: float | None, budget: int | None
) -> Mixture | None:
    """The mixture of sources given as (source, tokens); None without any token.

    `entropy` is a share of the greatest possible entropy; the exponent is the greatest that
    reaches it. It is raised where a source would otherwise be repeated more than `repeats` times.
    Without a budget, the budget is the least with which every source is read in full.
    """
    shares = sizes.filter("tokens > 0")
    sources, total, least, most = shares.agg(
        F.count("*"), F.sum("tokens"), F.min("tokens"), F.max("tokens")
    ).first()
    if not sources:
        return None
    shares = stored(shares.select((F.col("tokens") / total).alias("share")), "mix-shares")
    low, high = least / total, most / total

    def entropy_of(exponent: float, powers: float, logs: float) -> float:
        return math.log(powers) - exponent * logs / powers

    def repeats_of(exponent: float, powers: float) -> float:
        if budget is None:
            return (high / low) ** (1 - exponent)
        return budget / total * low ** (exponent - 1) / powers

    exponent = 1.0
    if entropy is not None:
        target = entropy * math.log(sources)
        (natural,) = _sums(shares, [1.0])
        if entropy_of(1.0, *natural) < target:
            exponent = _bisect(shares, lambda e, z, s: entropy_of(e, z, s) >= target, False)
    elif repeats is not None:
        exponent = 0.0
    if repeats is not None:
        (now,) = _sums(shares, [exponent])
        if repeats_of(exponent, now[0]) > repeats:
            exponent = _bisect(shares, lambda e, z, s: repeats_of(e, z) <= repeats, True)
    exponent = round(exponent, 9)
    ((powers, _),) = _sums(shares, [exponent])
    whole = budget if budget is not None else total * powers * high ** (1 - exponent)
    return Mixture(exponent, total, powers, whole)


def mix(
    docs: DataFrame,
    entropy: float | None = 0.95,
    repeats: float | None = 2.0,
    budget: int | None = None,
    seed: int = 11,
    key: str = "doc_id",
    source: str = "source",
    column: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of `docs`, each as often as its source's budget takes it, with four more columns.

    `mix_weight` is the source's weight, `mix_epoch` numbers the passes over the source, and
    `mix_order` is the place in that pass of the row's block, of about `block_tokens` tokens.
    `mix_position` is the share of the source's passes up to the block, from 0 to about 1; rows are
    sorted by it (ties by source, then by the row's hash), so blocks stay together, copies of a row
    are in passes one after the other, and sources take turns by their weights. The sort is by ranges
    of the position. A null source is a source of its own. Sources without a token, and rows of an input without any, are read once, with
    weight 0. Rows without a token follow their hash. Rows equal in key and text are taken or left
    together, and a part of a block never exceeds what the budget leaves. Columns of these names
    give way; an empty table gives an empty one.
    """
    docs = without(docs, "mix_weight", "mix_epoch", "mix_order", "mix_position")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col(source).alias("source"),
        tokens_of(F.col(column)).alias("tokens"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(column)).alias("hash"),
    )
    light = stored(rows.drop("doc"), "mix-rows")
    sizes = stored(light.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sizes")
    mixture = solve(sizes, entropy, repeats, budget)
    plan = plan_of(light, sizes, mixture, budget is None, seed, block_tokens)
    plan = stored(plan, "mix-plan").withColumnRenamed("source", "planned")
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("planned")))
    place = _block_place(seed, F.col("full"))
    taken = (place < F.col("cut_block")) | (
        (place == F.col("cut_block")) & (F.col("hash") <= F.col("cut_row"))
    )
    passes = F.col("full") + F.coalesce(taken, F.lit(False)).cast("long")
    drawn = placed.filter(passes > 0).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), passes - 1))
    )
    drawn = drawn.withColumn("order", _block_place(seed, F.col("epoch")))
    within = (F.col("order") + 0.5) / F.col("blocks")
    drawn = drawn.withColumn("position", (F.col("epoch") + within) / F.col("passes"))
    return drawn.orderBy("position", "source", "hash").select(
        "doc.*",
        F.col("weight").alias("mix_weight"),
        F.col("epoch").cast("int").alias("mix_epoch"),
        F.col("order").alias("mix_order"),
        F.col("position").alias("mix_position"),
    )


def _block_place(seed: int, epoch: Column) -> Column:
    """Place of a row's block in a pass; needs the columns source, hash and blocks."""
    blocks = F.col("blocks")
    factor = F.element_at(
        F.array(*map(F.lit, MULTIPLIERS)), (F.pmod(epoch, F.lit(len(MULTIPLIERS))) + 1).cast("int")
    )
    shift = F.pmod(F.xxhash64(F.lit(seed), epoch, F.col("source")), blocks)
    number = F.pmod(F.col("hash"), blocks)
    return F.pmod(F.pmod(factor.cast("long"), blocks) * number + shift, blocks)


def plan_of(
    light: DataFrame,
    sizes: DataFrame,
    mixture: Mixture | None,
    whole: bool,
    seed: int,
    block_tokens: int,
) -> DataFrame:
    """What decides over each row of a source: (source, weight, passes, blocks, full, cut_block, cut_row).

    Tokens of the blocks in their order are summed in ranges, so a source's blocks may be many.
    """
    if mixture is None:
        weight, quota = F.lit(0.0), F.col("tokens")
    else:
        power = F.pow(F.col("tokens") / mixture.total, F.lit(mixture.exponent))
        weight = F.when(F.col("tokens") > 0, power / mixture.scale).otherwise(0.0)
        quota = F.round(weight * mixture.budget).cast("long")
        if whole:
            quota = F.greatest(quota, "tokens")
    some = F.col("tokens") > 0
    blocks = F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1))
    blocks = F.least(blocks, F.lit(MULTIPLIERS[-1] - 1)).cast("long")
    plan = sizes.select(
        "source", "tokens", weight.alias("weight"), blocks.alias("blocks"), quota.alias("quota")
    )
    plan = plan.withColumn(
        "full", F.when(some, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("long")
    ).withColumn("rest", F.when(some, F.col("quota") - F.col("full") * F.col("tokens")).otherwise(0))
    passes = F.when(some, F.col("quota") / F.col("tokens")).otherwise(1.0)
    plan = plan.withColumn("passes", passes)
    plan = stored(plan.drop("tokens", "quota"), "mix-quotas")
    partial = plan.filter("rest > 0").withColumnRenamed("source", "planned")
    placed = light.join(partial, F.col("source").eqNullSafe(F.col("planned"))).select(
        "source", "rest", "tokens", "hash", _block_place(seed, F.col("full")).alias("block")
    )
    sums = placed.groupBy("source", "rest", "block").agg(F.sum("tokens").alias("tokens"))
    parted = in_parts(sums, ["source", "block"], "mix-blocks")
    cut = running_total(parted, ["source"], ["block"], F.col("tokens"), "upto")
    cut = cut.withColumn("before", F.col("upto") - F.col("tokens")).filter("before < rest")
    cut = cut.groupBy("source").agg(F.max(F.struct("block", "before", "rest")).alias("last"))
    cut = cut.select(
        F.col("source").alias("cut_source"),
        F.col("last.block").alias("cut_block"),
        (F.col("last.rest") - F.col("last.before")).alias("left"),
    )
    cut = stored(cut, "mix-cuts")
    here = F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("block") == F.col("cut_block"))
    within = placed.join(cut, here).select("source", "tokens", "hash", "left")
    reached = F.sum("tokens").over(W.partitionBy("source").orderBy("hash"))
    rows = within.withColumn("reached", reached).filter("reached <= left")
    rows = rows.groupBy(F.col("source").alias("row_source")).agg(F.max("hash").alias("cut_row"))
    return (
        plan.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .join(rows, F.col("source").eqNullSafe(F.col("row_source")), "left")
        .select("source", "weight", "passes", "blocks", "full", "cut_block", "cut_row")
    )
