"""Near-duplicate removal with ordered precedence.

MinHash signatures in bands find pairs, their exact Jaccard similarity confirms them. Rows are then accepted in order: a
row is dropped if an earlier *accepted* row is near, so a chain A~B~C keeps C if A and C are not near. That rule is
solved in rounds over the graph of confirmed pairs; rows without pairs never take part.

Identical shingle sets collapse to one node first, so copies cost one row; only different near texts meet in a band.

Defined results
---------------
* null and blank texts are near to nothing and kept; ties in the order are broken by id
* the first reason wins: ``dup_base_exact``, ``dup_base_near``, ``dup_new_near``
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.session import shared_dir, ship, written

#: Near are texts of at least this similarity of their sets of sequences of WIDTH words.
BANDS, ROWS, THRESHOLD, WIDTH = 20, 5, 0.9, 5


def signatures(rows: DataFrame, text: Column, width: int = WIDTH) -> DataFrame:
    """Adds ``sh`` (sorted distinct shingle hashes), empty for texts without any."""
    s = F.transform(T.shingles(text, width), lambda x: F.xxhash64(x))
    return rows.withColumn("sh", F.array_sort(F.array_distinct(s)))


def bands(nodes: DataFrame) -> DataFrame:
    """``(band, id)``: each node's key in each band, a hash of ``ROWS`` minima of permuted shingle hashes.

    Arrow batches go through numpy, all permutations of a batch at once: built-in functions would interpret a lambda for every
    hash and permutation.
    """
    ship(nodes.sparkSession)
    odd = np.random.default_rng(7).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["sh"].map(len).to_numpy()
            if not len(sizes):
                continue
            h = np.concatenate(batch["sh"].to_numpy()).astype(np.int64).view(np.uint64)
            at = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            keys = np.zeros((len(sizes), BANDS), np.uint64)
            with np.errstate(over="ignore"):
                for k, m in enumerate(odd):
                    x = (h ^ (h >> np.uint64(29))) * m
                    low = np.minimum.reduceat(x ^ (x >> np.uint64(32)), at)
                    keys[:, k // ROWS] = (keys[:, k // ROWS] * np.uint64(0x9E3779B97F4A7C15) + low) ^ (low >> np.uint64(31))
                keys = keys * np.uint64(0xD6E8FEB86659FD93) + np.arange(BANDS, dtype=np.uint64)
            yield pd.DataFrame({"band": keys.view(np.int64).ravel(), "id": np.repeat(batch["id"].to_numpy(), BANDS)})

    return nodes.select("id", "sh").mapInPandas(run, "band bigint, id bigint")


def similar_pairs(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b)``, ``a < b``: confirmed pairs of written ``(id, node, sh)``, found in any band, of which ``node.kind`` is 1 for one at least."""
    at = bands(nodes)
    at = at.join(nodes.select("id", (F.col("node.kind") == 1).alias("open")), "id")
    # Pairs of two nodes that are accepted anyway decide nothing: only bands that hold an open node count, and pairs with one.
    many = at.groupBy("band").agg(F.count(F.lit(1)).alias("k"), F.bool_or("open").alias("o")).where("k > 1 AND o").select("band")
    at = written(at.join(many, "band"), "near-bands")
    pairs = at.where("open").select(F.col("id").alias("i"), "band").join(at.select(F.col("id").alias("j"), F.col("open").alias("jo"), "band"), "band").where("i <> j AND (NOT jo OR i < j)").select("i", "j").distinct()
    sa, sb = nodes.select(F.col("id").alias("i"), F.col("node").alias("x"), F.col("sh").alias("sa")), nodes.select(F.col("id").alias("j"), F.col("node").alias("y"), F.col("sh").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    p = pairs.join(sa, "i").join(sb, "j").where(F.least(F.size("sa"), F.size("sb")) >= threshold * F.greatest(F.size("sa"), F.size("sb")))
    return p.where(shared >= threshold * (F.size("sa") + F.size("sb") - shared)).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def accept_in_order(pairs: DataFrame) -> DataFrame:
    """``(node, accepted)`` of the nodes of ``pairs`` ``(a, b)``, ``a`` before ``b``: the greedy choice in order.

    A node is accepted once all its earlier neighbours are dropped, dropped once one of them is accepted. Each round settles at
    least the earliest open node of every component, so a chain takes at most as many rounds as it is long; settled nodes leave.
    """
    spark = pairs.sparkSession
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    pairs = pairs.checkpoint()
    state = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct().withColumn("accepted", F.lit(None).cast("boolean")).checkpoint()
    while True:
        earlier = pairs.join(state.withColumnsRenamed({"node": "a", "accepted": "fa"}), "a")
        known = earlier.groupBy(F.col("b").alias("node")).agg(F.coalesce(F.bool_or("fa"), F.lit(False)).alias("hit"), F.bool_and(F.coalesce(~F.col("fa"), F.lit(False))).alias("free"))
        now = F.when(F.col("hit").isNull() | F.col("free"), True).when(F.col("hit"), False)
        state = state.join(known, "node", "left").select("node", F.coalesce("accepted", now).alias("accepted")).checkpoint()
        if state.where("accepted IS NULL").isEmpty():
            return state


def deduplicate(new: DataFrame, base: DataFrame, text: str = "text_no_url", priority: Column | None = None, threshold: float = THRESHOLD, near: bool = True) -> DataFrame:
    """``(rid, reason)``: one row per row of ``new``, ``reason`` null for rows that are kept.

    Order: ``priority`` (small first, 1 if not given), date (missing last), id. Without ``near`` only equal keys of the base drop a
    row, and new rows are not compared with each other.
    """
    order = F.struct((F.lit(1) if priority is None else priority).alias("p"), F.when(T.blank(F.col("date_iso")), "9999").otherwise(F.col("date_iso")).alias("d"), F.col("rid").alias("r"))
    key = lambda df: F.md5(T.normalize_text(df[text]))
    n = new.where(~T.blank(F.col(text))).select("rid", key(new).alias("key"), order.alias("o"), F.col(text).alias("t"))
    b = base.where(~T.blank(F.col(text))).select(key(base).alias("key"), F.col(text).alias("t"))
    known = b.select("key").distinct().withColumn("known", F.lit(True))
    n = written(n.join(known, "key", "left"), "near-new")
    exact = n.where("known").select("rid", F.lit("dup_base_exact").alias("reason"))
    if not near:
        return new.select("rid").join(exact, "rid", "left")
    # One node per shingle set, base sets before new ones; a set's place is its earliest row's.
    sets = signatures(n.where("known IS NULL"), F.col("t")).select("sh", "o", F.lit(1).alias("kind"))
    base_sets = signatures(b, F.col("t")).select("sh", F.lit(None).cast(sets.schema["o"].dataType).alias("o"), F.lit(0).alias("kind"))
    place = F.struct("kind", "o")
    groups = sets.unionByName(base_sets).where("size(sh) > 0").groupBy(F.xxhash64("sh").alias("id"), "sh").agg(F.min(place).alias("place"))
    groups = written(groups.select("id", F.struct("place.kind", "place.o", "id").alias("node"), "sh"), "near-groups")
    pairs = similar_pairs(groups, threshold)
    state = accept_in_order(pairs)
    by_base = pairs.where("a.kind = 0").select(F.col("b").alias("node")).distinct().withColumn("base", F.lit(True))
    verdict = state.where("NOT accepted").select("node").join(by_base, "node", "left").select(F.col("node.id").alias("id"), F.when(F.col("base"), "dup_base_near").otherwise("dup_new_near").alias("verdict"))
    own = signatures(n.where("known IS NULL"), F.col("t")).select("rid", "o", F.xxhash64("sh").alias("id"))
    lead = groups.select(F.col("node.id").alias("id"), F.col("node.kind").alias("kind"), F.col("node.o").alias("lead"))
    got = own.join(lead, "id").join(verdict, "id", "left")
    reason = F.coalesce("verdict", F.when(F.col("kind") == 0, "dup_base_near").when(F.col("o") != F.col("lead"), "dup_new_near"))
    near_rows = got.select("rid", reason.alias("reason")).where("reason IS NOT NULL")
    return new.select("rid").join(exact.unionByName(near_rows), "rid", "left")
