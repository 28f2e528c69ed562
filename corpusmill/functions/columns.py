"""Helpers on columns that shape the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once: a generator keeps Catalyst from inlining them into every later use.

    Collapsed projections would repeat an expensive expression (a long regular expression, say) for each reference and
    overflow the 64 KB limit of generated methods.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
