"""Does the stored fact account for every landed row, and for nothing else?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.operators.survivors import TRIP_PRECEDENCE, keyed, keyless

# What a trip says, without the file that brought it.
SAID = ["trip_id", *[name for name in TRIP_PRECEDENCE if name != "file_name"]]


def reconciliation(landed: DataFrame, fact: DataFrame, quarantine: DataFrame) -> DataFrame:
    """(part, trip_rows): landed rows as multisets against the fact and the quarantine.

    `landed` and `quarantine` are normalised trips. Every landed row is in exactly one of `stored`,
    `beaten` (a version the stored one equals or beats), `superseded_only` (a later version than the
    stored one), `missing` (no trip of its id is stored), `quarantined` and `not_quarantined`.
    `invented` and `quarantine_invented` are stored rows that never landed. Equal rows count as often
    as they occur. A sound load has no rows in the parts other than `landed`, `stored`, `beaten` and
    `quarantined`.
    """
    rows = landed.select(*SAID)
    with_id, without_id = keyed(rows), keyless(rows)
    kept, set_aside = fact.select(*SAID), quarantine.select(*SAID)
    rest = with_id.exceptAll(kept)
    stored = kept.select(F.col("trip_id").alias("_id"), _version().alias("_stored"))
    # Of the fact's versions of an id only the greatest can beat another, should there be several.
    stored = stored.groupBy("_id").agg(F.max("_stored").alias("_stored"))
    met = rest.select("trip_id", _version().alias("_version")).join(
        stored, F.col("trip_id") == F.col("_id"), "left"
    )
    judged = met.agg(
        F.count_if(F.col("_id").isNull()).alias("missing"),
        F.count_if(F.col("_version") <= F.col("_stored")).alias("beaten"),
        F.count_if(F.col("_version") > F.col("_stored")).alias("superseded_only"),
    )
    counted = {
        "landed": rows,
        "stored": with_id.intersectAll(kept),
        "invented": kept.exceptAll(with_id),
        "quarantined": without_id.intersectAll(set_aside),
        "not_quarantined": without_id.exceptAll(set_aside),
        "quarantine_invented": set_aside.exceptAll(without_id),
    }
    lines = [
        df.agg(F.lit(part).alias("part"), F.count("*").alias("trip_rows"))
        for part, df in counted.items()
    ]
    parts = ("missing", "beaten", "superseded_only")
    structs = [F.struct(F.lit(p).alias("part"), F.col(p).alias("trip_rows")) for p in parts]
    lines.append(judged.select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, lines)


def _version():
    return F.struct(*[F.col(name) for name in SAID[1:]])
