"""Cross-site boilerplate lines, by how many sites a line is spread over.

Every line hash gets a HyperLogLog sketch of its sites; sketches of parts merge in the aggregation.
A line whose estimate is clearly at or above the threshold is boilerplate, one clearly below is
not, and the lines between get exact distinct counts. Boilerplate lines are then removed from the
texts, but for one occurrence of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import stored, text_key

LINE_BREAK = "\n"
# Sketches of 2^10 registers have a standard error of 1.04 / 32; four of them decide without a count.
SKETCH_BITS = 10
BAND = 4 * 1.04 / 2 ** (SKETCH_BITS / 2)
# What counts as blank around a line.
BLANKS = " \t\r\x0b\x0c"


def lines_of(text: Column) -> Column:
    return F.split(text, LINE_BREAK, -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line, first): hashes of the lines on at least `min_sites` sites, and their first place.

    `lines` has `line`, `site` (a null site counts as one site) and `place`, which orders the
    occurrences.
    """
    # Sketches ignore empty texts, so no site is one.
    site = F.coalesce(F.concat(F.lit("="), "site"), F.lit("none"))
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_agg(site, F.lit(SKETCH_BITS)).alias("sketch"), F.min("place").alias("first")
    )
    sites = F.hll_sketch_estimate("sketch")
    judged = sketched.select("line", "first", sites.alias("sites"))
    judged = stored(judged.filter(F.col("sites") >= min_sites * (1 - BAND)), "lines-spread")
    certain = judged.filter(F.col("sites") > min_sites * (1 + BAND)).select("line", "first")
    near = judged.filter(F.col("sites") <= min_sites * (1 + BAND))
    places = lines.select("line", site.alias("site")).join(near, "line", "left_semi").distinct()
    counted = places.groupBy("line").count().filter(F.col("count") >= min_sites)
    exact = near.join(counted, "line", "left_semi").select("line", "first")
    return certain.unionByName(exact)


def without_spread_lines(
    docs: DataFrame,
    min_sites: int = 4,
    key: str = "doc_id",
    site: str = "source",
    column: str = "text",
) -> DataFrame:
    """The rows of `docs` with `text` less its boilerplate lines, and `n_lines`, `n_removed`.

    A line is what lies between line feeds; blanks around it do not count, and blank lines are
    never boilerplate. The occurrence in the row of the smallest key (null keys last), and there
    the first line, stays. No row is dropped: a text may become empty. A null text stays null and
    has no lines. Rows equal in key and text are treated alike, so a line stays in all of them.
    `n_chars`, if there, is set to the new length. Columns `n_lines` and `n_removed` give way.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.col(column).alias("text"),
        F.struct(
            F.col(key).isNull().alias("none"), F.col(key).alias("id"), text_key(column).alias("hash")
        ).alias("owner"),
        F.col(site).alias("site"),
    )
    lines = rows.select(
        "owner", "site", F.posexplode(lines_of(F.col("text"))).alias("at", "raw")
    ).select("owner", "site", "at", stripped(F.col("raw")).alias("raw"))
    lines = lines.filter("raw <> ''").select(
        text_key("raw").alias("line"), "site", F.struct("owner", "at").alias("place")
    )
    spread = stored(spread_lines(lines, min_sites), "lines-boilerplate")
    found = lines.join(spread, "line").filter(F.col("place") != F.col("first"))
    removals = found.groupBy("place.owner").agg(F.collect_set("place.at").alias("removed"))
    owned = rows.select("doc", "owner")
    joined = owned.join(stored(removals, "lines-removals"), "owner", "left")
    whole = F.col("doc").getField(column)
    kept = F.filter(
        lines_of(whole),
        lambda line, at: ~F.array_contains(F.coalesce("removed", F.array().cast("array<int>")), at),
    )
    text = F.when(F.col("removed").isNull(), whole).otherwise(
        F.array_join(kept, LINE_BREAK)
    )
    cleaned = joined.withColumn("text", text)
    replaced = {column.lower(): F.col("text"), "n_chars": F.char_length("text").cast("long")}
    out = [
        replaced.get(c.lower(), F.col(f"doc.`{c}`")).alias(c) for c in names
    ]
    return cleaned.select(
        *out,
        F.coalesce(F.size(lines_of(whole)), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
    )
