"""First, last, top and n-th rows of groups, at any group size.

``row_number`` over a window puts a group into one task. Where only a few rows of a group are kept, Spark limits the
group before the shuffle; where a whole group must be numbered, ``numbered`` splits it by a hash and adds the sizes of
the parts before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a part of a group, about.
PER_PART = 200_000


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order`` (which should end in a unique column); null keys are one group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """At most ``k`` rows per key, with their place ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def hashed(key: Column, seed: int = 42) -> Column:
    """A hexadecimal hash that orders rows at random but always alike."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")).cast("binary"))


def numbered(df: DataFrame, groups: list[str], order: Column, per_part: int = PER_PART) -> DataFrame:
    """Adds ``rank`` (from 1) and ``size`` of each row's group, by a hexadecimal ``order``; null groups are one group.

    A part holds the rows whose order starts alike, so parts follow each other in the order. Their number comes from the number of all rows, so
    that a part has at most about ``per_part`` rows even if one group holds all. Only the parts' counts meet in one window.
    """
    width = max(1, math.ceil(math.log(max(df.count() / per_part, 1), 16)))
    df = df.withColumn("__o", order).withColumn("__p", F.substring("__o", 1, width))
    counts = df.groupBy(*groups, "__p").agg(F.count(F.lit(1)).alias("__c"))
    g = Window.partitionBy(*groups)
    before = F.coalesce(F.sum("__c").over(g.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*[F.col(c).alias("__g_" + c) for c in groups], F.col("__p").alias("__q"), before.alias("__b"), F.sum("__c").over(g).alias("size"))
    same = F.col("__p") == F.col("__q")
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col("__g_" + c))
    local = F.row_number().over(Window.partitionBy(*groups, "__p").orderBy("__o"))
    out = df.withColumn("__n", local).join(counts, same).withColumn("rank", (F.col("__n") + F.col("__b")).cast("bigint"))
    return out.drop("__o", "__p", "__q", "__n", "__b", *["__g_" + c for c in groups])


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """``(col, n, share)`` in descending order of ``n``, ties by value; at most ``k`` rows if given."""
    n = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("__t"))
    out = n.join(F.broadcast(total)).select(col, "n", (F.col("n") / F.col("__t")).alias("share")).orderBy(F.desc("n"), col)
    return out.limit(k) if k else out


def crosstab(df: DataFrame, row: str, col: str, values: list, margins: bool = False) -> DataFrame:
    """Counts of ``row`` by ``col`` with one column for each of ``values``; with ``margins`` also totals, under ``All``."""
    name = lambda v: f"n_{v}"
    if not margins:
        return df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).na.fill(0).withColumnsRenamed({str(v): name(v) for v in values})
    cube = df.cube(row, col).agg(F.count(F.lit(1)).alias("n"), F.grouping(row).alias("gr"), F.grouping(col).alias("gc"))
    pick = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")
    key = F.when(F.col("gr") == 1, "All").otherwise(F.col(row)).alias(row)
    return cube.groupBy(key, "gr").agg(*[pick((F.col("gc") == 0) & (F.col(col) == v)).alias(name(v)) for v in values], pick(F.col("gc") == 1).alias("n_All")).drop("gr")
