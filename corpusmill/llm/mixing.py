"""Mixing sources to target weights (problem 9): Poisson replication.

Each source's repetition rate is what its share of the total needs: ``share * total / its tokens``. A document's number
of uses is Poisson distributed, cut off at ``max_repeats``; the distribution's mean is raised until the cut-off one has
the wanted rate, and it is inverted at a number hashed from the document's id. The mean is then fitted to the tokens the hashed
numbers really draw: they rise with the mean, so bisection finds the mean whose draw comes closest to the share. All sources are fitted at once, each round
one aggregation of the written sizes. A choice depends on ids, sizes and the seed only, not on partitions or on a retried task.
Copies then get a hashed place in one global order.

``total`` defaults to the most tokens at which every source can still deliver its share within its repeats.

Defined results
---------------
* sources not listed, null sources and texts without tokens are not used; a listed source without tokens reports a share of 0
* a share of 0 or null, or ``max_repeats`` below 1 or null, means no document; shares are taken relative to their sum
* a source of few documents comes as close to its share as adding or leaving out one use of a document can bring it
* repeated ``doc_id`` values of one source are one document, of the most tokens any of its texts has
* a source asked for more than its repeats allow (explicit ``total``) gives every document ``max_repeats`` times
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bpe
from corpusmill.session import written

SEED = 17
#: Rounds of bisection: each halves the range of a mean.
FITTED = 24


def _cut_mean(rate: float, most: int) -> float:
    """Mean of a Poisson number cut off at ``most``."""
    p, cdf, mean = math.exp(-rate), math.exp(-rate), 0.0
    for k in range(1, most + 1):
        mean += 1 - cdf
        p *= rate / k
        cdf += p
    return mean


def cut_steps(mean: float, most: int) -> list[float]:
    """The distribution function at 0 to ``most - 1`` of a Poisson number of a mean."""
    steps, p, cdf = [], math.exp(-mean), math.exp(-mean)
    for k in range(1, most + 1):
        steps.append(cdf)
        p *= mean / k
        cdf += p
    return steps


def poisson_mean(rate: float, most: int) -> float:
    """The mean of the Poisson number that, cut off at ``most``, has the mean ``rate``; at most 700."""
    if rate >= most:
        return 700.0
    lo, hi = 0.0, 1.0
    while _cut_mean(hi, most) < rate and hi < 700:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _cut_mean(mid, most) < rate else (lo, mid)
    return hi


def poisson_steps(rate: float, most: int) -> list[float]:
    """The distribution function at 0 to ``most - 1`` of the Poisson number that, cut off at ``most``, has mean ``rate``."""
    if rate >= most:
        return [0.0] * most
    return cut_steps(poisson_mean(rate, most), most)


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, seed: int = SEED, tokens: DataFrame | None = None) -> DataFrame:
    """``(doc_id, source, tokens, repeats)`` of the documents used at least once.

    The targets are parameters, one row per source; they and the listed sources' sizes are all the driver sees.
    """
    sized = bpe.count_tokens(docs, "doc_id", "text") if tokens is None else tokens
    goals = targets.where("target_share > 0 AND max_repeats >= 1 AND source IS NOT NULL").groupBy("source").agg(F.sum("target_share").alias("share"), F.min("max_repeats").alias("most"))
    # One row per document: a repeated id doesn't multiply itself in the join.
    sized = sized.where("tokens > 0").groupBy("doc_id").agg(F.max("tokens").alias("tokens"))
    listed = docs.select("doc_id", "source").distinct().join(F.broadcast(goals.select("source")), "source").join(sized, "doc_id").select("doc_id", "source", "tokens")
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11).cast("double") / F.lit(float(1 << 53))
    listed = written(listed.withColumn("u", u), "p9-sizes")
    have = {r["source"]: r["t"] for r in listed.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    wanted = [r for r in goals.collect() if r["source"] in have]
    shares = sum(r["share"] for r in wanted)
    size = total if total is not None else min((r["most"] * have[r["source"]] * shares / r["share"] for r in wanted), default=0.0)
    spark, uses = docs.sparkSession, F.size(F.filter("steps", lambda s: F.col("u") >= s))

    def drawn(steps: dict[str, list[float]]) -> DataFrame:
        table = spark.createDataFrame(list(steps.items()), "source string, steps array<double>")  # as many rows as targets
        return listed.join(F.broadcast(table), "source").withColumn("repeats", uses)

    def reached(steps: dict[str, list[float]]) -> dict[str, float]:
        return {r["source"]: r["t"] for r in drawn(steps).groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("t")).collect()}

    need = {r["source"]: min(r["share"] / shares * size, float(r["most"] * have[r["source"]])) for r in wanted}
    most = {r["source"]: r["most"] for r in wanted}
    first = {k: poisson_mean(need[k] / have[k], most[k]) for k in need}
    best = {k: (abs(t - need[k]), first[k]) for k, t in reached({k: cut_steps(m, most[k]) for k, m in first.items()}).items()} if need else {}
    full = {k for k in need if need[k] >= most[k] * have[k]}
    lo, hi = dict.fromkeys(need, 0.0), {k: min(700.0, 4 * m + 8 * math.sqrt(m) + 8) for k, m in first.items()}
    for _ in range(FITTED):
        open_ = [k for k in need if k not in full and best[k][0] > CLOSE * need[k]]
        if not open_:
            break
        mid = {k: (lo[k] + hi[k]) / 2 for k in open_}
        for k, t in reached({k: cut_steps(m, most[k]) for k, m in mid.items()}).items():
            best[k] = min(best[k], (abs(t - need[k]), mid[k]))
            lo[k], hi[k] = (mid[k], hi[k]) if t < need[k] else (lo[k], mid[k])
    steps = {k: [0.0] * most[k] if k in full else cut_steps(best[k][1], most[k]) for k in need}
    return drawn(steps).where("repeats > 0").select("doc_id", "source", "tokens", "repeats")


#: A share within this relative distance needs no further rounds.
CLOSE = 0.002


def sequence(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """``(doc_id, source, copy, place)``: every copy with its hashed place, ordered by place over all partitions."""
    copies = mixed.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("copy"))
    copies = copies.withColumn("place", F.xxhash64("doc_id", "copy", F.lit(seed + 1)))
    return copies.repartitionByRange("place", "doc_id", "copy").sortWithinPartitions("place", "doc_id", "copy")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, max_repeats, documents, copies, tokens, share)`` of each listed source."""
    got = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("repeats").cast("bigint").alias("copies"), F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most_repeats"))
    total = got.agg(F.sum("tokens").alias("all"))
    out = targets.join(got, "source", "left").join(F.broadcast(total))
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source", "target_share", "max_repeats", n("documents"), n("copies"), n("tokens"), n("most_repeats"), F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)).alias("share"))
