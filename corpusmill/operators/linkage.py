"""Record linkage: texts to a claim index, new rows to known ones, names to lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.session import ship, written

#: Claims, and texts, that a task holds at once; counters of shared tokens at once; tokens that a pair must share beside the text's most common ones.
CHUNK, BLOCK, CELLS, RARE = 32_768, 4096, 125_000, 7
#: Claims are counted apart by size, from these sizes on, as what a pair must share follows the smaller set.
SIZES = (1, 4, 6, 9, 12, 16, 20, 25, 32, 48, 96)


def link_claims(texts: DataFrame, claims: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(rid, claim_id, score)``: for each text its best claim, of score at least ``threshold``.

    ``texts`` is ``(rid, text)``, ``claims`` is ``(claim_id, claim)``. Equal normalised texts score 1 and the first such claim
    counts; else the score is the share of the smaller token set that both have (never below their Jaccard similarity),
    with at least two shared tokens; ties go to the smaller ``claim_id``.

    Every claim is a candidate: see ``overlapping``.
    """
    q, c = _keyed(texts, claims)
    first = c.where("key <> ''").groupBy("key").agg(F.min("claim_id").alias("claim_id"))
    exact = q.join(first, "key").select("rid", "claim_id", F.lit(1.0).alias("score"))
    near = _near(q.join(exact.select("rid"), "rid", "left_anti"), c, threshold).groupBy("rid").agg(F.min(F.struct((-F.col("score")).alias("s"), "claim_id")).alias("b"))
    return exact.unionByName(near.select("rid", "b.claim_id", (-F.col("b.s")).alias("score")))


def link_all(texts: DataFrame, claims: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``(rid, claim_id, score)``: every claim that ``link_claims`` would score at least ``threshold`` for a text, not the best only.

    A text with an equal claim has its other claims as well. Copies multiply: give texts and claims once each.
    """
    q, c = _keyed(texts, claims)
    exact = q.where("key <> ''").join(c.select("claim_id", "key"), "key").select("rid", "claim_id", F.lit(1.0).alias("score"))
    return exact.unionByName(_near(q, c, threshold)).groupBy("rid", "claim_id").agg(F.max("score").alias("score"))


def _keyed(texts: DataFrame, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(rid, key, toks)`` and ``(claim_id, key, ctoks)``: normalised texts and their content tokens."""
    q = texts.select("rid", T.normalize_text(F.col("text")).alias("key"), T.content_tokens(F.col("text"), V.MATCH_STOP).alias("toks"))
    return q, claims.select("claim_id", T.normalize_text(F.col("claim")).alias("key"), T.content_tokens(F.col("claim"), V.MATCH_STOP).alias("ctoks"))


def _near(q: DataFrame, c: DataFrame, threshold: float) -> DataFrame:
    """``(rid, claim_id, score)`` of all pairs with a token score of at least ``threshold`` and two shared tokens."""
    return overlapping(q.select("rid", hashed_set(F.col("toks")).alias("toks")), c.select("claim_id", hashed_set(F.col("ctoks")).alias("toks")), threshold).select("rid", "claim_id", "score")


def hashed_set(c: Column) -> Column:
    """The 64-bit hashes of an array's distinct values, without null."""
    return F.transform(F.array_compact(F.array_distinct(c)), lambda x: F.xxhash64(x))


class _Sets:
    """The sets of a chunk of claims as one array of codes."""

    def __init__(self, sizes: np.ndarray, values: np.ndarray):
        self.sizes, self.at = sizes, np.cumsum(sizes) - sizes
        self.values, self.code = np.unique(values, return_inverse=True)

    def known(self, sizes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of a block of texts, in order, and codes of those of their values that any claim of the chunk has."""
        if not len(self.values):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        ok = self.values[code] == values
        return np.repeat(np.arange(len(sizes)), sizes)[ok], code[ok]

    def shared(self, known: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values text ``i``, in order, and claim ``j`` share, for each of these pairs."""
        out, few = np.zeros(len(i), np.int64), max(1, 32 * CELLS // max(1, len(self.values)))
        for first in np.unique(i // few) * few:
            # A table of these few texts and all codes.
            x, y = np.searchsorted(known[0], [first, first + few])
            has = np.zeros((few, len(self.values)), bool)
            has[known[0][x:y] - first, known[1][x:y]] = True
            x, y = np.searchsorted(i, [first, first + few])
            for z in range(x, y, CELLS):
                p, q = i[z : min(y, z + CELLS)], j[z : min(y, z + CELLS)]
                of, at = _spread(self.at[q], self.sizes[q])
                out[z : z + len(p)] = np.bincount(of[has[p[of] - first, self.code[at]]], minlength=len(p))
        return out


def _spread(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``sizes`` places from ``at`` on: the run's number and the place, one after the other."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) + (at - np.cumsum(sizes) + sizes)[of]


def _met(sets: _Sets, n: np.ndarray, known: tuple[np.ndarray, np.ndarray], threshold: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts, in order, and claims, as places in block and chunk, of all pairs that may share enough; ``n`` are the texts' sizes."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    row, code = known
    size = np.searchsorted(SIZES, sets.sizes, side="right")
    for k, low in enumerate(SIZES, 1):
        mine = np.flatnonzero(size == k)
        if not len(mine):
            continue
        of, at = _spread(sets.at[mine], sets.sizes[mine])
        order = np.argsort(sets.code[at], kind="stable")
        post, start = of[order], np.searchsorted(sets.code[at][order], np.arange(len(sets.values) + 1))
        # A pair that shares ``need`` tokens shares at least ``need - skip`` of the text's tokens but for the ``skip`` of them that most claims have.
        need = np.maximum(least, np.ceil(threshold * np.minimum(n, low) - 1e-9)).astype(np.int64)
        skip = np.maximum(0, need - RARE)
        long = np.diff(start)[code]
        order = np.lexsort((-long, row))
        r, c, long = row[order], code[order], long[order]
        kept = (np.arange(len(r)) - np.searchsorted(r, r) >= skip[r]) & (long > 0)
        r, c, long = r[kept], c[kept], long[kept]
        group = (np.cumsum(np.bincount(r, long, len(n)) + len(mine)) // CELLS).astype(np.int64)
        for g in range(int(group[-1]) + 1 if len(n) else 0):
            a, b = np.searchsorted(group, [g, g + 1])
            x, y = np.searchsorted(r, [a, b])
            if a == b or x == y:
                continue
            of, at = _spread(start[c[x:y]], long[x:y])
            count = np.bincount((r[x:y] - a)[of] * len(mine) + post[at], minlength=(b - a) * len(mine)).reshape(b - a, len(mine))
            i, j = np.divmod(np.flatnonzero(count >= (need - skip)[a:b, None]), len(mine))
            out.append((i + a, mine[j]))
    i, j = (np.concatenate([p[k] for p in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def overlapping(texts: DataFrame, claims: DataFrame, threshold: float, least: int = 2) -> DataFrame:
    """``(rid, claim_id, score, wide)``: all pairs of sets that share ``least`` values at least and ``threshold`` of the smaller set.

    ``texts`` is ``(rid, toks)``, ``claims`` is ``(claim_id, toks)``, sets of hashes (``hashed_set``). If both also have sets ``wide``, these must overlap
    by ``threshold`` as well, with two shared (their share is ``wide`` in the result, else null); if both have ``nums``, a text that has any must share one.

    Texts are written once; every task reads them block by block against its own claims and counts shared tokens there, so no pair is shuffled but
    those of the result. Of the tokens a pair must share, all but ``RARE`` may be a text's most common ones, so these are not counted, and pairs that
    share enough of the others are confirmed exactly. Work grows with texts times claims.
    """
    ship(claims.sparkSession)
    more = [c for c in ("wide", "nums") if c in texts.columns and c in claims.columns]
    path = written(texts.where(F.size("toks") >= least).select("rid", "toks", *more), "overlap-texts").inputFiles()
    path = [p.removeprefix("file://").removeprefix("file:") for p in path]
    kinds = dict(texts.dtypes)["rid"], dict(claims.dtypes)["claim_id"]

    def sets(t: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
        c = t.column(name)
        c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        return c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), c.flatten().to_numpy(zero_copy_only=False)

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        own = {c: _Sets(*sets(t, c)) for c in ("toks", *more)}
        for b in ds.dataset(path, format="parquet").to_batches(batch_size=BLOCK) if path else ():
            if not b.num_rows:
                continue
            has = {c: sets(b, c) for c in own}
            known = {c: own[c].known(*has[c]) for c in own}
            met = _met(own["toks"], has["toks"][0], known["toks"], threshold, least)

            def share(c: str, least: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                n = own[c].shared(known[c], i, j)  # noqa: B023
                s = n / np.maximum(1, np.minimum(has[c][0][i], own[c].sizes[j]))  # noqa: B023
                return (n >= least) & (s >= threshold), s

            ok, score = share("toks", least, *met)
            i, j, score, wide = met[0][ok], met[1][ok], score[ok], None
            if "wide" in own:
                ok, wide = share("wide", 2, i, j)
                i, j, score, wide = i[ok], j[ok], score[ok], wide[ok]
            if "nums" in own:
                ok = (has["nums"][0][i] == 0) | (own["nums"].shared(known["nums"], i, j) > 0)
                i, j, score, wide = i[ok], j[ok], score[ok], None if wide is None else wide[ok]
            ids = b.column("rid").take(pa.array(i)), t.column("claim_id").combine_chunks().take(pa.array(j))
            yield pa.RecordBatch.from_arrays([*ids, pa.array(score, pa.float64()), pa.nulls(len(i), pa.float64()) if wide is None else pa.array(wide, pa.float64())], ["rid", "claim_id", "score", "wide"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= CHUNK:
                yield from pairs(pa.Table.from_batches(held))
                held = []
        if sum(x.num_rows for x in held):
            yield from pairs(pa.Table.from_batches(held))

    return claims.where(F.size("toks") >= least).select("claim_id", "toks", *more).mapInArrow(run, f"rid {kinds[0]}, claim_id {kinds[1]}, score double, wide double")


def unseen(new: DataFrame, known: DataFrame, text: str = "text_no_url") -> DataFrame:
    """Rows of ``new`` whose normalised text no row of ``known`` has; only digests are shuffled for the known side."""
    key = F.md5(T.normalize_text(F.col(text)))
    return new.withColumn("__k", key).join(known.select(key.alias("__k")).distinct(), "__k", "left_anti").drop("__k")


def match_by_substring(rows: DataFrame, column: str, names: list[tuple[str, str]], out: str) -> DataFrame:
    """Adds ``out``: the value of the first listed name that the column contains, else null. The list is a parameter of fixed size."""
    found = F.lit(None).cast("string")
    for name, value in reversed(names):
        found = F.when(F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(name)), value).otherwise(found)
    return rows.withColumn(out, found)


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by ``order``: what a log that is only appended to says now. Pre-aggregates, so a hot key is no bottleneck."""
    rest = [c for c in df.columns if c != key]
    top = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return top.select(key, "r.*").select(df.columns)
