"""Normalisation of identifiers, categories and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identifier(name: str) -> Column:
    return F.upper(F.trim(F.col(name))).alias(name)


def category(name: str) -> Column:
    return F.lower(F.trim(F.col(name))).alias(name)


def label(name: str) -> Column:
    return F.trim(F.col(name)).alias(name)


def surrogate_key(normalised: Column) -> Column:
    """SHA-256 of an already normalised identifier, lower-case hex."""
    return F.sha2(normalised, 256)
