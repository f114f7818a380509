"""Small tables with every awkward case."""

from __future__ import annotations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns whose names operators use inside or for their results.
CLASHING = (
    "fingerprint", "component_id", "ids", "n_tokens", "decoded", "lang_pred", "score", "rejected",
    "n_lines", "n_removed", "line", "owner", "place", "doc", "row", "hash", "tokens", "mix_epoch",
    "mix_order", "mix_weight", "mix_position", "base", "seen", "added", "removed", "site", "key", "page", "low",
)

ENGLISH = "the cat and the dog went over the hill to see that this was the end of it"
GERMAN = "der hund und die katze gingen über den hügel und sahen dass es nicht das ende war"


def documents(spark, rows):
    """Documents given as (doc_id, text, lang, source)."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd_documents(spark):
    """Nulls everywhere, empty and long texts, repeated rows, ties."""
    long = " ".join(f"{ENGLISH} {i}" for i in range(4000))
    rows = [
        (1, ENGLISH, "en", "a"),
        (1, ENGLISH, "en", "a"),
        (2, ENGLISH, "en", "b"),
        (3, GERMAN, "de", None),
        (4, None, None, "a"),
        (5, "", "en", "a"),
        (6, " \n\t ", None, "b"),
        (7, long, "en", "a"),
        (8, "x" * 50_000, None, "c"),
        (None, ENGLISH + " again", "en", "a"),
        (None, None, None, None),
        (9, "12 + 34 = 46 !!", "de", "c"),
    ]
    return documents(spark, rows)


def with_clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("mine") for name in CLASHING if name not in df.columns})


def empty(spark, schema=DOCUMENTS):
    return spark.createDataFrame([], schema)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
