"""Samples, quotas and splits. Chance is a hash of the row's id, so results don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators.ordering import hashed, numbered


def simple_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows, or all if there are fewer."""
    return df.orderBy(hashed(F.col(key), seed), key).limit(n)


def era_quota(df: DataFrame, ratio: float, seed: int = 42) -> DataFrame:
    """All rows but those of ``NEWS_`` groups, and of these at most ``int(ratio * max(others, 1))`` in each era."""
    df = df.withColumn("era", T.era(F.col("date_iso"))).withColumn("news", F.coalesce(F.startswith("dataset_name", F.lit("NEWS_")), F.lit(False)))
    cap = df.groupBy("era").agg(F.floor(ratio * F.greatest(F.count_if(~F.col("news")), F.lit(1))).alias("cap")).withColumnRenamed("era", "__era")
    ranked = numbered(df, ["era", "news"], hashed(F.col("rid"), seed))
    return ranked.join(F.broadcast(cap), F.col("era") == F.col("__era")).where(~F.col("news") | (F.col("rank") <= F.col("cap"))).drop("rank", "size", "cap", "__era", "news")


def strata(df: DataFrame, group: str, label: str, least: int = 10) -> DataFrame:
    """Adds ``stratum``: group and label, the label alone where that pair has fewer than ``least`` rows, and the largest stratum where that still has.

    Of equally large strata the first by name counts.
    """
    n = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("__c")).withColumnsRenamed({group: "__g", label: "__l"})
    out = df.join(n, df[group].eqNullSafe(n["__g"]) & df[label].eqNullSafe(n["__l"]))
    pair = F.concat_ws("|", F.coalesce(group, F.lit("")), F.coalesce(label, F.lit("")))
    out = out.withColumn("stratum", F.when(F.col("__c") < least, F.coalesce(F.col(label), F.lit(""))).otherwise(pair)).drop("__c", "__g", "__l")
    # Strata are as many as pairs of group and label at most.
    sizes = out.groupBy("stratum").agg(F.count(F.lit(1)).alias("__c"))
    largest = sizes.agg(F.min(F.struct((-F.col("__c")).alias("n"), "stratum")).alias("l")).select(F.col("l.stratum").alias("__largest"))
    sizes = sizes.withColumnRenamed("stratum", "__s").join(F.broadcast(largest))
    out = out.join(sizes, F.col("stratum") == F.col("__s"))
    return out.withColumn("stratum", F.when(F.col("__c") < least, F.col("__largest")).otherwise(F.col("stratum"))).drop("__c", "__s", "__largest")


def stratified_split(df: DataFrame, group: str, label: str, key: str, val: float = 0.15, test: float = 0.15, seed: int = 42, least: int = 10) -> DataFrame:
    """Adds ``split``: of each stratum the first ``test`` share is ``test``, the next ``val`` share ``val``, the rest ``train``."""
    ranked = numbered(strata(df, group, label, least), ["stratum"], hashed(F.col(key), seed))
    place = (F.col("rank") - 1) / F.col("size")
    return ranked.withColumn("split", F.when(place < test, "test").when(place < test + val, "val").otherwise("train")).drop("rank", "size", "stratum")


def held_out_split(df: DataFrame, channel: Column, held_out: str, group: str, label: str, key: str, val: float = 0.15, seed: int = 42) -> DataFrame:
    """Adds ``split``: the held-out channel is ``test``, the rest is split by strata, which are rare below 4 rows here."""
    df = df.withColumn("__held", F.coalesce(channel == held_out, F.lit(False)))
    rest = stratified_split(df.where(~F.col("__held")), group, label, key, val, 0.0, seed, least=4)
    return rest.unionByName(df.where("__held").withColumn("split", F.lit("test"))).drop("__held")


def length_batches(df: DataFrame, key: str, length: str, size: int, mega: int = 50, seed: int = 42) -> DataFrame:
    """Adds ``batch``: rows in random order are cut into mega-batches of ``size * mega``, and each of these, longest rows first, into batches of ``size``.

    Batches so hold rows of like length and still change with the seed. ``place`` is a row's place in its batch, from 1; ordering by batch and place and
    dropping both gives the rows back unchanged.
    """
    ranked = numbered(df.withColumn("__all", F.lit(0)), ["__all"], hashed(F.col(key), seed)).withColumn("__m", F.floor((F.col("rank") - 1) / (size * mega)))
    w = Window.partitionBy("__m").orderBy(F.desc(length), key)
    ranked = ranked.withColumn("__n", F.row_number().over(w) - 1)
    out = ranked.withColumn("batch", (F.col("__m") * mega + F.floor(F.col("__n") / size)).cast("bigint")).withColumn("place", (F.col("__n") % size + 1).cast("int"))
    return out.drop("__all", "rank", "size", "__m", "__n")


def cell_weights(df: DataFrame, group: str, target: str) -> DataFrame:
    """Adds ``weight``, by which every cell (group and target) weighs the same and the mean weight is 1."""
    n = df.groupBy(group, target).agg(F.count(F.lit(1)).alias("__c"))
    n = n.join(F.broadcast(n.agg(F.sum("__c").alias("__all"), F.count(F.lit(1)).alias("__k")))).withColumnsRenamed({group: "__g", target: "__t"})
    out = df.join(n, df[group].eqNullSafe(n["__g"]) & df[target].eqNullSafe(n["__t"]))
    return out.withColumn("weight", F.col("__all") / (F.col("__k") * F.col("__c"))).drop("__c", "__all", "__k", "__g", "__t")


def equal_cells(df: DataFrame, group: str, target: str, key: str, per_cell: int | None = None, seed: int = 42) -> DataFrame:
    """Rows repeated (``copy`` from 1) or left out so that every cell has ``per_cell`` rows, the median cell size if not given."""
    ranked = numbered(df, [group, target], hashed(F.col(key), seed))
    if per_cell is None:
        sizes = df.groupBy(group, target).agg(F.count(F.lit(1)).alias("__c")).agg(F.floor(F.expr("percentile(__c, 0.5)")).alias("__m"))
    else:
        sizes = df.sparkSession.range(1).select(F.lit(per_cell).cast("bigint").alias("__m"))
    out = ranked.join(F.broadcast(sizes))
    copies = (F.floor(F.col("__m") / F.col("size")) + F.when(F.col("rank") <= F.col("__m") % F.col("size"), 1).otherwise(0)).cast("int")
    return out.withColumn("__n", copies).where("__n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).drop("rank", "size", "__m", "__n")


def balanced_groups(df: DataFrame, group: str, target: str, fixed: list[str], prefixes: tuple[str, ...] = ("FC_", "EXT_", "NEWS_"), least: int = 200, minority: float = 0.15) -> DataFrame:
    """``(group, n, mean, minority, balanced)``: listed groups, and new ones with both classes and enough rows."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"))
    g = g.withColumn("minority", F.least("mean", 1 - F.col("mean")))
    new = F.col(group).rlike("^(" + "|".join(prefixes) + ")") & (F.col("n") >= least) & (F.col("minority") >= minority)
    return g.withColumn("balanced", F.coalesce(F.col(group).isin(fixed) | new, F.lit(False)))


def deficits(df: DataFrame, goals: dict[str, int]) -> DataFrame:
    """``(era, n, goal, deficit)`` of each wanted era."""
    n = df.groupBy(T.era(F.col("date_iso")).alias("era")).agg(F.count(F.lit(1)).alias("n"))
    wanted = df.sparkSession.createDataFrame(list(goals.items()), "era string, goal bigint")
    return wanted.join(n, "era", "left").select("era", F.coalesce("n", F.lit(0)).alias("n"), "goal", F.greatest(F.lit(0), F.col("goal") - F.coalesce("n", F.lit(0))).alias("deficit"))


def running_share(df: DataFrame, order: str, value: str) -> DataFrame:
    """Cumulative sum of already aggregated rows; meant for small tables, such as counts by day."""
    return df.withColumn("running", F.sum(value).over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
