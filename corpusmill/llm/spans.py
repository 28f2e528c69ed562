"""Long exact spans shared between records (problem 10).

Token k-mers are the edges of a De Bruijn graph. A k-mer starts at a token and has as many tokens as make up ``EDGE``
code points; of those that start close together only the one of smallest hash is kept, chosen so that any run of ``RUN``
shared code points holds at least one that both texts cut at the same tokens and keep (see ``_starts``). A k-mer whose
every occurrence follows the same k-mer lies inside a nonbranching path and is dropped: whoever shares it shares the
path's head. Only heads are looked up again; windows of exactly ``RUN`` code points around them, compacted in the same
way, give the texts that meet, and the text at the source coordinates decides. Every shared stretch holds such a window in
both of its texts: from there it is followed to its ends, which gives the passages.

Identical texts are one node; pairs of copies are added at the end. All groupings pre-aggregate before their shuffle.

Defined results
---------------
* null texts and texts shorter than ``RUN`` share nothing; runs that occur twice in one document only don't count
* lengths are in code points; texts are compared unchanged, white space and control characters included
* repeated ``doc_id`` values are one document
* a stretch of two texts that can't be made longer at either end is a passage, unless both its places lie inside longer
  ones of the same two texts (the shifted matches of a text that repeats itself); equal texts share one passage, the whole
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.session import ship, written

RUN = 160
#: No token is longer than this: longer runs of letters or digits are cut at every code point.
TOKEN = 24
#: Least length of a k-mer, and the stretch of starts of which only the k-mer of smallest hash is kept. A run loses at most a part token at
#: its start; all k-mers that start in the next WINDOW code points then end before the token that its end may cut.
EDGE = 80
WINDOW = RUN - 2 * TOKEN - 2 - EDGE

#: Texts whose k-mers are handed over together: bounds the memory of a Python worker.
SLICE = 250

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _starts(cp: np.ndarray) -> np.ndarray:
    """Positions at which a k-mer may start or end, decided by the code points nearby only.

    A token is a run of letters and digits of at most ``TOKEN`` code points, or one other code point; white space starts
    a token only after white space. Both texts of a shared run therefore cut it alike, but for the first token.
    """
    n = len(cp)
    kind = np.where(cp < 128, _ASCII[np.minimum(cp, 127)], np.where((cp == 0xA0) | ((cp >= 0x2000) & (cp <= 0x200A)) | (cp == 0x3000), 1, 0))
    word, space = kind == 0, kind == 1
    before = np.concatenate([[2], kind[:-1]])
    start = (kind == 2) | (word & (before != 0)) | (space & (before == 1))
    # Runs longer than TOKEN are cut everywhere.
    change = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    length = np.diff(np.concatenate([change, [n]]))
    for at, size in zip(change[(length > TOKEN)], length[length > TOKEN], strict=True):
        start[at : at + size] = True
    return np.flatnonzero(start)


_ASCII = np.array([0 if chr(c).isalnum() else 1 if chr(c).isspace() else 2 for c in range(128)])


def _prefix(cp: np.ndarray) -> np.ndarray:
    """Sums of mixed code points times powers of a base: the hash of any stretch is a difference of two, moved to the origin."""
    with np.errstate(over="ignore"):
        x = (cp.astype(np.uint64) + np.uint64(1)) * _MIX
        x ^= x >> np.uint64(29)
        return np.concatenate([[np.uint64(0)], np.cumsum(x * _POWERS(len(cp))[: len(cp)], dtype=np.uint64)])


def _stretches(prefix: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches from ``lo`` to ``hi``."""
    with np.errstate(over="ignore"):
        h = (prefix[hi] - prefix[lo]) * _INVERSES(len(prefix))[lo]
        h ^= h >> np.uint64(32)
        h *= _MIX
        return h ^ (h >> np.uint64(29))


def _kmers(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions and hashes of all k-mers of one text."""
    starts = _starts(cp)
    end = np.searchsorted(starts, starts + EDGE)
    starts, end = starts[end < len(starts)], starts[end[end < len(starts)]]
    return starts, _stretches(_prefix(cp), starts, end)


def _kept(starts: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which k-mers have the smallest hash (the leftmost of equals) of all that start within WINDOW of some start."""
    best, at = h.copy(), np.arange(len(h))
    for k in range(1, len(h)):
        inside = starts[k:] - starts[:-k] <= WINDOW
        if not inside.any():
            break
        better = inside & (h[k:] < best[:-k])
        best[:-k][better] = h[k:][better]
        at[:-k][better] = np.flatnonzero(better) + k
    return np.unique(at)


class _Table:
    """Powers of a base modulo 2**64, grown to the longest text seen."""

    def __init__(self, base: np.uint64):
        self.base, self.values = base, np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            with np.errstate(over="ignore"):
                self.values = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, self.base, np.uint64), dtype=np.uint64)])
        return self.values


_POWERS, _INVERSES = _Table(_BASE), _Table(_INVERSE)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in (batch[i : i + SLICE] for batch in batches for i in range(0, len(batch), SLICE)):
        out = []
        for rep, text in zip(b["rep"], b["text"], strict=True):
            pos, h = _kmers(_code_points(text))
            if len(h):
                keep = _kept(pos, h)
                pos, h = pos[keep], h[keep]
                # The k-mer before counts with its distance, and only if the two overlap: then whoever shares both shares one stretch.
                gap = np.diff(pos, prepend=0)
                with np.errstate(over="ignore"):
                    prev = np.concatenate([[np.uint64(0)], h[:-1]]) ^ (gap.astype(np.uint64) * _MIX)
                linked = (np.arange(len(h)) > 0) & (gap <= EDGE)
                out.append((np.full(len(h), rep), pos.astype(np.int32), h.view(np.int64), prev.view(np.int64), linked))
        if out:
            rep, pos, h, prev, has = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pd.DataFrame({"rep": rep, "pos": pos, "h": h, "prev": pd.arrays.IntegerArray(prev, ~has)})


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows of RUN code points that hold one of a text's heads, each with the hash of the window one to the left if that is one too."""
    for b in (batch[i : i + SLICE] for batch in batches for i in range(0, len(batch), SLICE)):
        out = []
        for rep, text, at in zip(b["rep"], b["text"], b["at"], strict=True):
            cp = _code_points(text)
            hit = np.zeros(len(cp) + 1, np.int32)
            for pos in at:
                lo, hi = max(pos - (RUN - EDGE), 0), min(pos, len(cp) - RUN)
                if lo <= hi:
                    hit[lo] += 1
                    hit[hi + 1] -= 1
            begin = np.flatnonzero(np.cumsum(hit) > 0)
            if len(begin):
                h = _stretches(_prefix(cp), begin, begin + RUN).view(np.int64)
                out.append((np.full(len(h), rep), begin.astype(np.int32), h, np.concatenate([[0], h[:-1]]), np.diff(begin, prepend=-2) == 1))
        if out:
            rep, begin, h, prev, has = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pd.DataFrame({"rep": rep, "from": begin, "h": h, "prev": pd.arrays.IntegerArray(prev, ~has)})


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each head the stretches that add half of what is missing to ``RUN`` on its left, and on its right: a shared run holds one of them."""
    half = (RUN - EDGE) // 2
    for b in (batch[i : i + SLICE] for batch in batches for i in range(0, len(batch), SLICE)):
        out = []
        for rep, text, at in zip(b["rep"], b["text"], b["at"], strict=True):
            cp = _code_points(text)
            pos, prefix = np.array(at, np.int64), _prefix(cp)
            for lo, hi in ((pos - half, pos + EDGE), (pos, pos + EDGE + half)):
                ok = (lo >= 0) & (hi <= len(cp))
                if ok.any():
                    out.append((np.full(ok.sum(), rep), pos[ok].astype(np.int32), _stretches(prefix, lo[ok], hi[ok]).view(np.int64)))
        if out:
            rep, pos, key = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pd.DataFrame({"rep": rep, "pos": pos, "key": key})


def heads(edges: DataFrame, key: str = "h", prev: str = "prev", member: str = "rep") -> DataFrame:
    """The keys that at least two members share and that don't always follow one and the same key."""
    g = edges.groupBy(key).agg(F.min(member).alias("m1"), F.max(member).alias("m2"), F.min(prev).alias("p1"), F.max(prev).alias("p2"), F.count_if(F.col(prev).isNull()).alias("open"))
    return g.where((F.col("m1") < F.col("m2")) & ((F.col("open") > 0) | (F.col("p1") < F.col("p2")))).select(key)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """``(rep, text)``: each distinct text long enough, under the smallest id that has it."""
    return docs.where(F.char_length("text") >= RUN).groupBy("text").agg(F.min("doc_id").alias("rep"))


def _meeting(texts: DataFrame) -> DataFrame:
    """``(rep, from, h, run)``: windows of which each pair of distinct texts that share a stretch has one in common in every such stretch."""
    ship(texts.sparkSession)
    edges = texts.select("rep", "text").mapInPandas(_edges, "rep bigint, pos int, h bigint, prev bigint")
    # A text's positions are bounded by its length.
    at = edges.join(heads(edges), "h").groupBy("rep").agg(F.collect_set("pos").alias("at"))
    wide = written(at.join(texts, "rep").select("rep", "text", "at").mapInPandas(_contexts, "rep bigint, pos int, key bigint"), "p10-contexts")
    shared = wide.groupBy("key").agg(F.min("rep").alias("m1"), F.max("rep").alias("m2")).where("m1 < m2").select("key")
    at = wide.join(shared, "key").groupBy("rep").agg(F.collect_set("pos").alias("at"))
    w = written(at.join(texts, "rep").select("rep", "text", "at").mapInPandas(_windows, "rep bigint, from int, h bigint, prev bigint"), "p10-windows")
    cut = lambda i: F.substr("text", i + 1, F.lit(RUN))
    meet = w.join(heads(w), "h").select("rep", "from", "h")
    return meet.join(texts, "rep").select("rep", "from", "h", cut(F.col("from")).alias("run"))


def shared_texts(texts: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of distinct texts that share a run, ``a < b``."""
    # The text at the source coordinates decides; hashes only led there.
    meet = written(_meeting(texts).select("rep", "h", "run").distinct(), "p10-runs")
    a, b = meet.withColumnRenamed("rep", "a"), meet.withColumnRenamed("rep", "b")
    return a.join(b, ["h", "run"]).where("a < b").select("a", "b").distinct()


def _by_copies(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(rep, doc_id)`` of every document whose text is long enough."""
    key = F.md5(F.encode("text", "UTF-8")).alias("key")
    return docs.where(F.char_length("text") >= RUN).select("doc_id", key).join(texts.select("rep", key), "key").select("rep", "doc_id").distinct()


def found(docs: DataFrame) -> DataFrame:
    """``(doc_a, doc_b)``: each pair of different documents that share a run of at least ``RUN`` code points."""
    texts = written(distinct_texts(docs.select("doc_id", "text")), "p10-texts")
    pairs = shared_texts(texts)
    copies = _by_copies(docs, texts)
    one, two = copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("da")), copies.select(F.col("rep").alias("b"), F.col("doc_id").alias("db"))
    other = pairs.join(one, "a").join(two, "b")
    same = one.join(two.withColumnRenamed("b", "a"), "a").where("da < db")
    both = other.select("da", "db").unionByName(same.select("da", "db"))
    return both.select(F.least("da", "db").alias("doc_a"), F.greatest("da", "db").alias("doc_b")).where("doc_a < doc_b").distinct()


def _windows_in(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Where the windows of ``RUN`` code points of ``x`` begin that also stand in ``y``: found by their hashes, confirmed by their code points."""
    at = np.arange(len(x) - RUN + 1)
    hx, hy = (_stretches(_prefix(v), np.arange(len(v) - RUN + 1), np.arange(len(v) - RUN + 1) + RUN) for v in (x, y))
    order = np.argsort(hy, kind="stable")
    place = np.minimum(np.searchsorted(hy[order], hx), len(hy) - 1)
    at = at[hy[order][place] == hx]
    there = order[place[at]]
    wx, wy = np.lib.stride_tricks.sliding_window_view(x, RUN), np.lib.stride_tricks.sliding_window_view(y, RUN)
    same = [(wx[at[k : k + 20_000]] == wy[there[k : k + 20_000]]).all(1) for k in range(0, len(at), 20_000)]
    return at[np.concatenate(same)] if same else at


def _covered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The stretches of each pair's first text that also stand in its second."""
    for b in batches:
        out = []
        for rep, one, two in zip(b["a"], b["ta"], b["tb"], strict=True):
            at = _windows_in(_code_points(one), _code_points(two))
            if len(at):
                cut = np.flatnonzero(np.diff(at) > RUN)
                lo, hi = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])] + RUN
                out.append(pd.DataFrame({"rep": rep, "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)}))
        yield pd.concat(out) if out else pd.DataFrame({"rep": [], "lo": [], "hi": []})


def shared_length(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, shared_chars, share)`` of every document: how much of it also stands in another one.

    A text that another document has too is shared whole. Documents with null or short texts have 0.
    """
    texts = written(distinct_texts(docs.select("doc_id", "text")), "p10-texts")
    pairs = written(shared_texts(texts), "p10-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ta, tb = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    stretches = both.join(ta, "a").join(tb, "b").select("a", "ta", "tb").mapInPandas(_covered, "rep bigint, lo int, hi int").distinct()
    # The union of a text's stretches: what each adds beyond the furthest end before it. A text has at most its length of them.
    w = Window.partitionBy("rep").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    added = stretches.withColumn("to", F.coalesce(F.max("hi").over(w), F.lit(0))).groupBy("rep").agg(F.sum(F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", "to"))).alias("c"))
    copies = _by_copies(docs, texts)
    many = copies.groupBy("rep").agg(F.count(F.lit(1)).alias("k"))
    per = copies.join(many, "rep").join(added, "rep", "left").select("doc_id", "k", "c")
    n = F.coalesce(F.char_length("text"), F.lit(0))
    shared = F.when(F.col("k") > 1, n).otherwise(F.coalesce("c", F.lit(0))).cast("bigint")
    out = docs.select("doc_id", "text").join(per, "doc_id", "left").select("doc_id", n.cast("bigint").alias("n_chars"), F.coalesce(shared, F.lit(0)).alias("shared_chars"))
    return out.withColumn("share", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)))


def _inside(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which stretches lie inside a different one."""
    each, of = np.unique(np.stack([at, -(at + size)], 1), axis=0, return_inverse=True)
    end = -each[:, 1]
    inside = np.concatenate([[False], np.maximum.accumulate(end)[:-1] >= end[1:]])
    return inside[of.reshape(-1)]


def _matches(x: np.ndarray, y: np.ndarray, seeds: list) -> np.ndarray:
    """Rows ``(from in x, from in y, length)`` of the passages of two texts. ``seeds`` are places of common windows: they tell the shifts to look at."""
    shifts = np.zeros(len(x) + len(y) + 1, bool)
    for s in seeds:
        there = np.asarray(s["fb"], np.int64)
        for here in s["fa"]:
            shifts[here - there + len(y)] = True
    out = []
    for d in np.flatnonzero(shifts) - len(y):
        lo, hi = max(d, 0), min(len(x), len(y) + d)
        same = x[lo:hi] == y[lo - d : hi - d]
        turn = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        begin, size = turn[::2] + lo, turn[1::2] - turn[::2]
        begin, size = begin[size >= RUN], size[size >= RUN]
        out.append(np.stack([begin, begin - d, size], 1))
    m = np.concatenate(out)
    return m[~(_inside(m[:, 0], m[:, 2]) & _inside(m[:, 1], m[:, 2]))]


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The passages of each pair of texts, at their places in both."""
    for b in batches:
        out = set()
        for one, two, ta, tb, seeds in zip(b["a"], b["b"], b["ta"], b["tb"], b["seeds"], strict=True):
            digests = {}
            for i, j, n in _matches(_code_points(ta), _code_points(tb), seeds).tolist():
                text = ta[i : i + n]
                digest = digests.get(text) or digests.setdefault(text, hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest())
                out |= {(one, i, n, digest), (two, j, n, digest)}
        yield pd.DataFrame(sorted(out), columns=["rep", "from", "length", "passage"])


def passages(docs: DataFrame) -> DataFrame:
    """``(doc_id, from, length, passage)``: every place at which a document has a passage that another one has too.

    ``from`` and ``length`` are in code points, the first is 0; ``passage`` is the MD5 of the passage's text, the same wherever it stands.
    """
    texts = written(distinct_texts(docs.select("doc_id", "text")), "p10-texts")
    meet = written(_meeting(texts).groupBy("rep", "h", "run").agg(F.collect_list("from").alias("at")), "p10-places")
    a, b = meet.withColumnsRenamed({"rep": "a", "at": "fa"}), meet.withColumnsRenamed({"rep": "b", "at": "fb"})
    seeds = a.join(b, ["h", "run"]).where("a < b").groupBy("a", "b").agg(F.collect_list(F.struct("fa", "fb")).alias("seeds"))
    ta, tb = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    places = seeds.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb", "seeds").mapInPandas(_passages, "rep bigint, from int, length int, passage string").distinct()
    copies = _by_copies(docs, texts)
    copied = copies.groupBy("rep").agg(F.count(F.lit(1)).alias("k")).where("k > 1").join(texts, "rep")
    whole = copied.select("rep", F.lit(0).alias("from"), F.char_length("text").alias("length"), F.md5(F.encode("text", "UTF-8")).alias("passage"))
    return places.unionByName(whole).distinct().join(copies, "rep").select("doc_id", "from", "length", "passage")
