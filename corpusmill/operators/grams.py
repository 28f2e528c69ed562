"""Similarity of texts by TF-IDF of character grams: vectors live in tasks only, and only results are shuffled.

A text has as many grams as twice its letters, so its vector is many times its size: shuffled or written, vectors and the pairs that share a gram
would be many times the input. Here texts are shuffled once, whole. The grams that count and their weights (bounded by the language: the
words of more texts hold ever fewer new ones) are a table that every task reads; a task makes its own rows' vectors and reads the queries' in blocks.
Grams are known by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.session import ship, written

#: Letters of texts cut into grams at once; entries of vectors, and queries, that a task holds at once; cells of a table of sums.
LETTERS, ENTRIES, BLOCK, CELLS = 50_000, 2_000_000, 1024, 500_000
#: Grams of more than this share of the texts are multiplied as a matrix, so many at once.
COMMON, COLUMNS = 0.1, 1024
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
WIDEST, HEAD = 5, 0.85


def hashed(letters: np.ndarray) -> np.ndarray:
    """64-bit hashes of grams, each a row of ``WIDEST`` code points, 0 behind its end."""
    h = np.full(len(letters), WIDEST, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WIDEST):
            h = (h ^ ((letters[:, k].astype(np.uint64) + np.uint64(1)) * _ODD[k])) * _ODD[(k + 1) % WIDEST]
            h ^= h >> np.uint64(29)
    return h.view(np.int64)


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the texts, hashes of their distinct 4- and 5-grams (``models.char_grams`` of normalised text) and how often each is there."""
    c = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    n, word = len(c), c != 32
    there = np.zeros(c.max() + 1, bool)
    there[c] = True
    letters, base = np.append(0, np.flatnonzero(there)), int(there.sum()) + 1
    code = np.cumsum(there)[c]
    at = [(4, word[1 : n - 2] & word[2 : n - 1]), (5, word[1 : n - 3] & word[2 : n - 2] & word[3 : n - 1])]
    # A word shorter than a gram is one, with a space on either side.
    one = ~word[: n - 2] & word[1 : n - 1] & ~word[2:]
    at += [(3, one), (3, one), (4, ~word[: n - 3] & word[1 : n - 2] & word[2 : n - 1] & ~word[3:])]
    at = [(size, np.flatnonzero(ok)) for size, ok in at]
    # Grams are numbers to the base of the letters in use while that fits beside the place of the text; else they are numbered.
    if len(texts) * base**WIDEST < 1 << 62:
        three = (code[:-2] * base + code[1:-1]) * base + code[2:]
        four = three[:-1] * base + code[3:]
        number = {3: three * base**2, 4: four * base, 5: four[:-1] * base + code[4:]}
        key, tf = np.unique(np.concatenate([row[p] * base**WIDEST + number[size][p] for size, p in at]), return_counts=True)
        out = np.empty((len(key), WIDEST), np.int64)
        for k in reversed(range(WIDEST)):
            key, out[:, k] = np.divmod(key, base)
        return key, hashed(letters[out]), tf
    r = np.concatenate([row[p] for _, p in at])
    digits = [np.concatenate([c[p + k] if k < size else np.zeros(len(p), np.int64) for size, p in at]) for k in range(WIDEST)]
    grams, number = np.unique(hashed(np.stack(digits, 1)), return_inverse=True)
    key, tf = np.unique(r * max(1, len(grams)) + number, return_counts=True)
    return key // max(1, len(grams)), grams[key % max(1, len(grams))], tf


def slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of some ``LETTERS`` letters together."""
    end = np.searchsorted(np.cumsum([len(t) + 2 for t in texts]), np.arange(LETTERS, sum(len(t) + 2 for t in texts) + LETTERS, LETTERS))
    for a, b in zip([0, *(np.unique(end) + 1)], [*(np.unique(end) + 1), len(texts)], strict=True):
        if a < min(b, len(texts)):
            yield slice(a, min(b, len(texts)))


def whole(rows: DataFrame, key: str, text: Column) -> DataFrame:
    """``(id, t)``: the normalised text of each key, of all its rows if it has several, written once."""
    return written(rows.groupBy(F.col(key).alias("id")).agg(F.array_join(F.collect_list(T.norm_for_similarity(text)), " ").alias("t")), "gram-texts")


def fit(texts: DataFrame, n: DataFrame, least_df: int = 2) -> DataFrame:
    """``(gram, idf)`` of the grams of ``least_df`` texts of ``whole`` at least; ``n`` is one row with the number ``n`` of texts."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            grams, number = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            return grams, np.bincount(number, np.concatenate([k for _, k in held]), len(grams)).astype(np.int64)

        for b in batches:
            t = b.column("t").to_pylist()
            for s in slices(t):
                held.append(np.unique(counted(t[s])[1], return_counts=True))
                many += len(held[-1][0])
                if many > ENTRIES:
                    held = [summed()]
                    many = 0
        if held:
            g, k = summed()
            for x in range(0, len(g), 65_536):
                yield pa.RecordBatch.from_arrays([pa.array(g[x : x + 65_536]), pa.array(k[x : x + 65_536])], ["gram", "df"])

    df = texts.select("t").mapInArrow(run, "gram bigint, df bigint").groupBy("gram").agg(F.sum("df").alias("df")).where(F.col("df") >= least_df)
    return written(df.join(F.broadcast(n)).select("gram", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf")), "gram-weights")


def known(fitted: DataFrame) -> DataFrame:
    """A ``(gram, idf)`` table with grams as text, by their hashes."""
    ship(fitted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = np.array([[ord(x) for x in t.ljust(WIDEST, "\0")] for t in b.column("gram").to_pylist()], np.int64).reshape(-1, WIDEST)
            yield pa.RecordBatch.from_arrays([pa.array(hashed(g)), b.column("idf")], ["gram", "idf"])

    return written(fitted.select("gram", "idf").mapInArrow(run, "gram bigint, idf double"), "gram-weights")


def files(df: DataFrame) -> list[str]:
    return [p.removeprefix("file://").removeprefix("file:") for p in df.inputFiles()]


class Weights:
    """Grams by rank, the rarest first, and their weights."""

    def __init__(self, path: list[str]):
        import pyarrow.dataset as ds

        t = ds.dataset(path, format="parquet").to_table() if path else pa.table({"gram": pa.array([], pa.int64()), "idf": pa.array([], pa.float64())})
        g, idf = t.column("gram").to_numpy(), t.column("idf").to_numpy()
        by = np.lexsort((g, -idf))
        self.idf = idf[by]
        self.order = np.argsort(g[by])
        self.gram = g[by][self.order]
        #: The first rank of the common grams: a weight tells the share of texts.
        self.common = int(np.searchsorted(-self.idf, np.log(COMMON) - 1))

    def ranks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(size, gram, tf)``: for each text how many grams it has, then their ranks, in order, and counts, one text after the other."""
        sizes, grams, tfs = [], [], []
        for s in slices(texts):
            row, h, tf = counted(texts[s])
            p = np.minimum(np.searchsorted(self.gram, h), max(0, len(self.gram) - 1))
            ok = self.gram[p] == h if len(self.gram) else np.zeros(len(h), bool)
            row, g, tf = row[ok], self.order[p[ok]], tf[ok]
            by = np.argsort(row * max(1, len(self.idf)) + g)
            sizes.append(np.bincount(row, minlength=s.stop - s.start))
            grams.append(g[by])
            tfs.append(tf[by])
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *x]) for x in (sizes, grams, tfs))


class Vectors:
    """Vectors of length 1, one after the other: ``row`` and ``gram`` of each entry, in order, and its weight."""

    def __init__(self, weights: Weights, ids: np.ndarray, size: np.ndarray, gram: np.ndarray, tf: np.ndarray):
        self.ids, self.size, self.gram = ids, size, gram
        self.row, self.end = np.repeat(np.arange(len(ids)), size), np.cumsum(size)
        w = (1 + np.log(tf)) * weights.idf[gram]
        self.w = w / np.sqrt(np.bincount(self.row, w * w, len(ids)))[self.row]

    @functools.cached_property
    def rest(self) -> np.ndarray:
        """For each entry the length of what is left of its vector from there on."""
        c = np.cumsum(self.w * self.w)
        return np.sqrt(np.maximum(0, c[np.maximum(0, self.end - 1)][self.row] - c + self.w * self.w)) if len(c) else c

    @functools.lru_cache(1)  # noqa: B019
    def prefix(self, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the entries from where on a vector is at least so long, by gram, and these grams."""
        p = np.flatnonzero(self.rest >= least)
        p = p[np.argsort(self.gram[p], kind="stable")]
        return p, self.gram[p]

    def matrix(self, a: int, b: int, first: int, end: int) -> np.ndarray:
        """Rows ``a`` to ``b`` and grams ``first`` to ``end`` as a matrix."""
        x = slice(self.end[a] - self.size[a], self.end[b - 1])
        row, gram, w = self.row[x], self.gram[x], self.w[x]
        ok = (gram >= first) & (gram < end)
        m = np.zeros((b - a, end - first))
        m[row[ok] - a, gram[ok] - first] = w[ok]
        return m


def compared(queries: DataFrame, texts: DataFrame, fitted: DataFrame, f: Callable[[Weights, Vectors, Vectors], tuple], blocks: int = 1) -> DataFrame:
    """``(query_id, id, sim)``: what ``f`` picks of the pairs of so many blocks of queries and a run of rows, as places of both and their cosines.

    Queries and rows are ``(id, t)`` of ``whole``; those without a key or any known gram take no part.
    """
    ship(texts.sparkSession)
    weights, kind = files(fitted), dict(texts.dtypes)["id"]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = Weights(weights)
        for b in batches:
            t = b.column("t").to_pylist()
            for s in slices(t):
                size, gram, tf = w.ranks(t[s])
                at = pa.array(np.append(0, np.cumsum(size)), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("id").slice(s.start, s.stop - s.start), *(pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (gram, tf))], ["id", "gram", "tf"])

    q = written(queries.where("id IS NOT NULL").select("id", "t").mapInArrow(ranked, f"id {kind}, gram array<int>, tf array<int>").where(F.size("gram") > 0), "gram-queries")
    path = files(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        w = Weights(weights)

        def against(ids: pa.Array, ranks: list[tuple]) -> Iterator[pa.RecordBatch]:
            rows = Vectors(w, np.arange(len(ids)), *(np.concatenate([r[k] for r in ranks]) for k in range(3)))
            for b in ds.dataset(path, format="parquet").to_batches(batch_size=blocks * BLOCK) if path and len(rows.gram) else ():
                if not b.num_rows:
                    continue
                gram, tf = b.column("gram"), b.column("tf")
                block = Vectors(w, np.arange(b.num_rows), gram.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), gram.flatten().to_numpy(zero_copy_only=False).astype(np.int64), tf.flatten().to_numpy(zero_copy_only=False))
                # Keys by their order: the same key has the same number on both sides, so that a row is not compared with itself.
                both = pc.rank(pa.chunked_array([b.column("id"), ids]).combine_chunks(), tiebreaker="dense").to_numpy()
                block.ids, rows.ids = both[: b.num_rows], both[b.num_rows :]
                i, j, sim = f(w, block, rows)
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(i)), ids.take(pa.array(j)), pa.array(sim, pa.float64())], ["query_id", "id", "sim"])

        ids, ranks, many = [], [], 0
        for b in batches:
            t = b.column("t").to_pylist()
            for s in slices(t):
                ids.append(b.column("id").slice(s.start, s.stop - s.start))
                ranks.append(w.ranks(t[s]))
                many += len(ranks[-1][1])
                if many >= ENTRIES:
                    yield from against(pa.chunked_array(ids).combine_chunks(), ranks)
                    ids, ranks, many = [], [], 0
        if many:
            yield from against(pa.chunked_array(ids).combine_chunks(), ranks)

    return texts.where("id IS NOT NULL").select("id", "t").mapInArrow(run, f"query_id {kind}, id {kind}, sim double")


def spread(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of ``sizes`` places from ``at`` on: the run's number and the place, one after the other."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) + (at - np.cumsum(sizes) + sizes)[of]


def best(w: Weights, q: Vectors, r: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query that shares a gram with any other row: the row of greatest cosine, to 9 places, and smallest id.

    Every product of shared grams is summed: those of common grams by matrices, the others by the queries that have them.
    """

    def first(i: np.ndarray, j: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by = np.lexsort((r.ids[j], i))
        by = by[np.unique(i[by], return_index=True)[1]]
        return i[by], j[by], sim[by]

    rare = q.gram < w.common
    order = np.argsort(q.gram[rare], kind="stable")
    post, x = q.row[rare][order], q.w[rare][order]
    start = np.searchsorted(q.gram[rare][order], np.arange(w.common + 1))
    nq, out, end = len(q.ids), [], np.append(0, r.end)
    step = max(1, CELLS // nq)
    products = np.where(r.gram < w.common, np.diff(start)[np.minimum(r.gram, w.common - 1)], 0) if w.common else np.zeros(len(r.gram), np.int64)
    top = np.zeros(nq)
    slabs = [(c, min(c + COLUMNS, len(w.idf))) for c in range(w.common, len(w.idf), COLUMNS)]
    left = [q.matrix(0, nq, c, d) for c, d in slabs]
    for a in range(0, len(r.ids), step):
        b = min(a + step, len(r.ids))
        s = np.zeros((b - a, nq))
        x0, x1 = end[a], end[b]
        g, ww, rr, many = r.gram[x0:x1], r.w[x0:x1], r.row[x0:x1] - a, products[x0:x1]
        part = np.cumsum(many) // (8 * CELLS) if len(many) else many
        for k in range(int(part[-1]) + 1 if len(part) else 0):
            u, v = np.searchsorted(part, [k, k + 1])
            ok = np.flatnonzero(many[u:v]) + u
            if len(ok):
                of, at = spread(start[g[ok]], many[ok])
                s += np.bincount((rr[ok] * nq)[of] + post[at], ww[ok][of] * x[at], s.size).reshape(s.shape)
        for (c, d), m in zip(slabs, left, strict=True):
            s += r.matrix(a, b, c, d) @ m.T
        s = np.round(s, 9)
        s[r.ids[a:b, None] == q.ids[None, :]] = 0
        peak = s.max(0)
        top = np.maximum(top, peak)
        j, i = np.nonzero((s == peak) & (peak >= top) & (peak > 0))
        out.append(first(i, j + a, s[j, i]))
    i, j, sim = (np.concatenate([o[k] for o in out]) for k in range(3))
    ok = sim >= top[i]
    return first(i[ok], j[ok], sim[ok])


def sums(w: Weights, q: Vectors, r: Vectors, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For pairs of a query, in order, and a row the products with the row's first ``size`` entries, summed."""
    sim, few, rs, qs = np.zeros(len(i)), max(1, 2 * CELLS // max(1, len(w.idf))), r.end - r.size, q.end - q.size
    table = np.zeros((few, len(w.idf)))
    for first in np.unique(i // few) * few:
        last = min(first + few, len(q.ids))
        mine = slice(qs[first], q.end[last - 1])
        table[q.row[mine] - first, q.gram[mine]] = q.w[mine]
        u, v = np.searchsorted(i, [first, last])
        for z in range(u, v, 10_000):
            p = slice(z, min(v, z + 10_000))
            of, at = spread(rs[j[p]], size[j[p]])
            sim[p] = np.bincount(of, table[(i[p] - first)[of], r.gram[at]] * r.w[at], p.stop - p.start)
        table[q.row[mine] - first, q.gram[mine]] = 0
    return sim


def above(threshold: float) -> Callable[[Weights, Vectors, Vectors], tuple]:
    """Picks all pairs of a cosine of at least ``threshold``, but for 1e-9.

    The rarest gram two texts share has all others they share behind it, so the cosine is at most the product of the lengths of what is left of both
    from there on. Pairs that meet at a gram where that reaches ``threshold`` are summed up exactly.
    """

    def pick(w: Weights, q: Vectors, r: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        least = threshold - 1e-9
        qr, rr, (qp, _), (rp, met) = q.rest, r.rest, q.prefix(least), r.prefix(least)
        start, stop = (np.searchsorted(met, q.gram[qp], side=x) for x in ("left", "right"))
        pairs = []
        part = np.cumsum(stop - start) // (8 * CELLS)
        for k in range(int(part[-1]) + 1 if len(part) else 0):
            u, v = np.searchsorted(part, [k, k + 1])
            of, at = spread(start[u:v], (stop - start)[u:v])
            a, b = qp[u:v][of], rp[at]
            ok = qr[a] * rr[b] >= least
            i, j = q.row[a[ok]], r.row[b[ok]]
            pairs.append(np.unique((i * len(r.ids) + j)[q.ids[i] != r.ids[j]]))
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *pairs]))
        i, j = np.divmod(pairs, max(1, len(r.ids)))
        # First the rarer part of each row, to where less than HEAD of its length is left: what is left of both from there on bounds the rest of the sum.
        head = np.bincount(r.row[r.rest >= HEAD], minlength=len(r.ids))
        sim, behind = sums(w, q, r, i, j, head), r.end - r.size + head
        more = np.flatnonzero(head[j] < r.size[j])
        at = behind[j[more]]
        p = np.minimum(np.searchsorted(q.row * len(w.idf) + q.gram, i[more] * len(w.idf) + r.gram[at]), len(q.gram) - 1)
        bound = sim.copy()
        bound[more] += r.rest[at] * np.where(q.row[p] == i[more], q.rest[p], 0)
        ok = bound >= least
        i, j = i[ok], j[ok]
        sim = sums(w, q, r, i, j, r.size)
        ok = sim >= least
        return i[ok], j[ok], sim[ok]

    return pick
