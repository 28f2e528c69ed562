"""Deduplicating new batches against all history (problem 1): a prefix-tree hash forest.

Texts are reduced to sets of three-word sequences. Each of ``TREES`` trees gives an accepted text a signature of ``DEPTH``
labels, each the smallest hash of the set under one permutation, packed into one integer. The texts that share the first
``d`` labels of a tree stand together in that tree's order: they are one range.

The forest is a folder of runs, one per accepted batch. A run holds its leaves ``(tree, key, entry)`` sorted by tree and key and
cut into parts by fixed bounds, so that the place of a range tells its part; the sets of its entries, cut by entry; and the digests of
its texts' canonical forms (problem 7) with the earliest row of each, cut by digest. A search reads the parts its ranges, candidates
and digests lie in, of ``PER_PART`` rows each, and no others: what a batch costs is bounded by the batch, not by the history.
``merge_runs`` merges sorted runs into one. Signatures of accepted texts are never computed again.

A new text looks for one similar earlier text, from the longest prefix on: at each length it meets the earliest entry of its
range, and what is found similar is settled and leaves. What is left widens its prefix by ``WIDEN`` labels,
until ``d`` is short enough that two texts of the threshold's similarity meet in some tree with probability ``RECALL``; there it
meets all entries of its ranges. A crowd of near-copies is so settled by its earliest entries, at the longest prefixes.

Texts of one word sequence are one entry, so exact copies cost one row whatever their number. Sequences are compared by 32-bit
hashes: two texts of 40 sequences seem to share one more than they do with a probability of 4e-7.

Defined results
---------------
* null texts and texts without letters and digits repeat nothing; texts of fewer than three words repeat by equality only
* a null ``batch_no`` comes after all others; repeated ids in one batch are one row
* a run without its ``run.json``, written last, was cut short and is no part of the history; a merged run names those it replaces
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.text import folded_lower
from corpusmill.llm import canonical
from corpusmill.session import ship, shuffles_dropped, work_dir

THRESHOLD, RECALL = 0.6, 0.99
TREES, DEPTH, LABEL_BITS = 36, 6, 10
_LABELS = np.random.default_rng(20_240_601).integers(1, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def search_depth(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES) -> int:
    """The longest prefix at which texts of the threshold's similarity still meet with the wanted probability."""
    for d in range(DEPTH, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def words(text: Column) -> Column:
    """Lower case without accents, every character outside a-z and 0-9 a space, single spaces; null stays null."""
    return F.trim(F.regexp_replace(folded_lower(text), "[^a-z0-9]+", " "))


def shingle_hashes(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 32-bit hashes of three-word sequences of all texts in a row, and where each text's begin."""
    lists = [t.split() for t in texts]
    sizes = np.array([len(x) for x in lists])
    code, uniques = pd.factorize(np.array([w for x in lists for w in x], dtype=object))
    h = pd.util.hash_array(uniques.astype(object), categorize=False)[code] if len(code) else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        s = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + (h[1:-1] ^ (h[1:-1] >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:] * np.uint64(0x165667B19E3779F9)
        s ^= s >> np.uint64(33)
        s *= np.uint64(0xFF51AFD7ED558CCD)
        s ^= s >> np.uint64(33)
    owner = np.repeat(np.arange(len(lists)), sizes)
    inside = owner[:-2] == owner[2:] if len(owner) > 2 else np.zeros(0, bool)
    pairs = np.stack([owner[:-2][inside].astype(np.uint64), s[inside] & np.uint64(0xFFFFFFFF)]) if inside.any() else np.zeros((2, 0), np.uint64)
    key = np.unique((pairs[0] << np.uint64(32)) | pairs[1])
    who = (key >> np.uint64(32)).astype(np.int64)
    return (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.searchsorted(who, np.arange(len(lists) + 1))


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        h, at = shingle_hashes(b["words"])
        size = np.diff(at)
        some = np.flatnonzero(size)
        keys = np.zeros((len(some), TREES), np.int64)
        if len(some):
            begin = at[some]
            with np.errstate(over="ignore"):
                for t in range(TREES):
                    key = np.zeros(len(some), np.int64)
                    for k in range(DEPTH):
                        x = (h ^ (h >> np.uint32(15))) * _LABELS[t * DEPTH + k]
                        x ^= x >> np.uint32(16)
                        low = np.minimum.reduceat(x, begin)
                        # The label is taken from a remix: the smallest hashes all have small leading bits.
                        low = (low * np.uint32(0x85EBCA6B)) >> np.uint32(32 - LABEL_BITS)
                        key = (key << LABEL_BITS) | low.astype(np.int64)
                    keys[:, t] = key
        trees, parts = [None] * len(b), [None] * len(b)
        for row, i in enumerate(some):
            trees[i] = keys[row]
            parts[i] = h[at[i] : at[i + 1]].view(np.int32)
        yield pd.DataFrame({"entry": b["entry"], "ord": b["ord"], "n": size.astype(np.int32), "keys": trees, "set": parts}).loc[size > 0]


def entries(rows: DataFrame, batch: int | None = None) -> DataFrame:
    """``(entry, ord, words)`` of ``(rid, batch_no, text)``: distinct word sequences under their earliest row.

    ``batch`` names the one batch all rows are of, if they are: the smallest id is the earliest row then, and the grouping
    needs no sort.
    """
    w = rows.select("rid", "batch_no", words(F.col("text")).alias("words")).where("words <> ''")
    if batch is not None:
        return w.groupBy("words").agg(F.min("rid").alias("entry")).select("entry", F.lit(batch).alias("ord"), "words")
    e = w.groupBy("words").agg(F.min(F.struct(F.col("batch_no").alias("b"), F.col("rid").alias("r"))).alias("o"))
    return e.select(F.col("o.r").alias("entry"), F.col("o.b").alias("ord"), "words")


#: Ids that are broadcast at most: some 8 MB.
BROADCAST = 500_000
#: Sorted files of a run that may be written without a shuffle.
FILES = 1024
#: Rows of one part of a run, about: the least that a search reads for a range.
PER_PART = 1_000_000
_BITS = LABEL_BITS * DEPTH
#: Trees whose leaves are shuffled at a time: no range lies in two trees, and the files of one shuffle are gone before the next.
AT_ONCE = 12


def _place(tree: Column, key: Column, parts: int) -> Column:
    """The part in which a key of a tree stands: keys are spread evenly over their values."""
    return F.least(F.floor((tree + key / F.lit(float(1 << _BITS))) * F.lit(parts / TREES)), F.lit(parts - 1)).cast("int")


def _hashed(c: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")


class HashForest:
    """Sorted runs of signatures in the shared folder; ``accept`` takes a batch in and gives its repeats, ``append`` only takes it in."""

    def __init__(self, spark: SparkSession, path: str | None = None, per_part: int = PER_PART):
        ship(spark)
        self.spark, self.path, self.per_part = spark, (path or f"{work_dir(spark)}/forest-{uuid.uuid4().hex}").rstrip("/"), per_part
        root, fs = self._at(self.path)
        # A path of its own outlives the application: what is complete there is the history.
        names = sorted(s.getPath().getName() for s in (fs.listStatus(root) if fs.exists(root) else []))
        told = {f"{self.path}/{n}": self._told(f"{self.path}/{n}") for n in names}
        replaced = {run for meta in told.values() if meta for run in meta["replaces"]}
        self.runs = {run: meta for run, meta in told.items() if meta and run.rsplit("/", 1)[1] not in replaced}
        self.depth = search_depth()
        #: What has been read: table, parts read, parts there.
        self.read: list[tuple[str, int, int]] = []
        #: Folders of tables written for a step, by name.
        self._written: dict[str, list[str]] = {}

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _told(self, run: str) -> dict | None:
        """What ``run.json`` says: the parts of each table, and the runs this one replaces."""
        p, fs = self._at(f"{run}/run.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _write(self, name: str, *parts: DataFrame) -> DataFrame:
        """Writes tables of one schema one after the other and returns them as one written table."""
        path = f"{work_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        with shuffles_dropped(self.spark):
            for i, df in enumerate(parts):
                df.write.parquet(f"{path}/{i}")
        self._written.setdefault(name, []).append(path)
        return self.spark.read.schema(parts[0].schema).parquet(*[f"{path}/{i}" for i in range(len(parts))])

    def _drop(self, *names: str) -> None:
        """Deletes what ``_write`` wrote under these names."""
        for path in [x for name in names for x in self._written.pop(name, [])]:
            p, fs = self._at(path)
            fs.delete(p, True)

    def signed(self, rows: DataFrame, batch: int | None = None) -> DataFrame:
        """Signatures of ``(rid, batch_no, text)`` rows: ``(entry, ord, n, keys, set)``."""
        return entries(rows, batch).mapInPandas(_signatures, "entry bigint, ord int, n int, keys array<bigint>, set array<int>")

    def _cut(self, df: DataFrame, to: str, rows: int, place, order: list[str]) -> dict:
        """Writes a table in parts by ``place(parts)``, sorted by ``order`` within each file.

        While tasks and parts are few, each task writes a sorted file of its own to each part, without a shuffle. Beyond ``FILES`` files, rows are
        first drawn together by ranges of equal size, so a crowded part is spread over tasks.
        """
        parts = -(-rows // self.per_part) or 1
        placed = df.withColumn("part", place(parts))
        if parts == 1:
            placed = placed.coalesce(1)
        elif parts * df.rdd.getNumPartitions() > FILES:
            placed = placed.repartitionByRange(parts, "part", *order, "entry") if "entry" in df.columns else placed.repartitionByRange(parts, "part", *order)
        # Sorted keys compress well, and a history is read more often than written.
        with shuffles_dropped(self.spark):
            placed.sortWithinPartitions("part", *order).write.option("compression", "zstd").partitionBy("part").parquet(to)
        root, fs = self._at(to)
        return {"parts": parts, "some": sorted(int(s.getPath().getName()[5:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("part="))}

    def _seal(self, to: str, meta: dict) -> None:
        p, fs = self._at(f"{to}/run.json")
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(meta).encode()))
        stream.close()
        self.runs[to] = meta

    def append(self, rows: DataFrame, batch: int | None = None) -> str:
        """Accepts rows as one run and returns the run. Entries keep their signatures; nothing older is read."""
        to = f"{self.path}/run-{len(self.runs):05d}-{uuid.uuid4().hex[:8]}"
        rows = _ordered(rows, batch)
        with shuffles_dropped(self.spark):
            self.signed(rows, batch).write.parquet(f"{to}/signed")
        signed = self.spark.read.parquet(f"{to}/signed")
        n = signed.count()
        keys = self._write("p1-keys", _firsts(_keyed(rows, canonical.canonical(F.col("text")))))
        self._seal(to, {"replaces": [], **self._tables(to, signed, n, keys, keys.count())})
        self._drop("p1-keys")
        p, fs = self._at(f"{to}/signed")
        fs.delete(p, True)
        return to

    def _tables(self, to: str, signed: DataFrame, n: int, keys: DataFrame, k: int) -> dict:
        leaves = signed.select(F.posexplode("keys").alias("tree", "key"), "entry", "ord", "n")
        meta = {"leaves": self._cut(leaves, f"{to}/leaves", n * TREES, lambda p: _place(F.col("tree"), F.col("key"), p), ["tree", "key"])}
        meta["keys"] = self._cut(keys, f"{to}/keys", k, lambda p: _hashed(F.col("k"), p), ["k"])
        # Sets are no longer than their texts: parts of a tenth of the rows.
        meta["sets"] = self._cut(signed.select("entry", "set"), f"{to}/sets", 10 * n, lambda p: _hashed(F.col("entry"), p), [])
        return meta

    def _read(self, name: str, schema: str, touched=None, runs: list[str] | None = None) -> DataFrame:
        """A table of all runs; with ``touched(parts)``, a table of part numbers, only of the parts named there."""
        paths, wanted = [], {}
        for run in runs or self.runs:
            meta = self.runs[run][name]
            n, some = meta["parts"], meta["some"]
            if not some:
                continue
            if touched is not None and n > 1:
                if n not in wanted:
                    # Numbers of parts: as many as there are files at most.
                    wanted[n] = {r[0] for r in touched(n).distinct().collect()}
                some = [i for i in some if i in wanted[n]]
            self.read.append((name, len(some), len(meta["some"])))
            paths += [f"{run}/{name}/part={i}" for i in some]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def merge_runs(self) -> None:
        """Merges all runs into one, whose tables are sorted and cut as one batch's are."""
        if len(self.runs) > 1:
            to, old = f"{self.path}/merged-{uuid.uuid4().hex[:8]}", list(self.runs)
            leaves, sets = self._read("leaves", _LEAVES), self._read("sets", _SETS)
            keys = self._read("keys", _KEYS).groupBy("k").agg(F.min("first").alias("first"), F.max("final").alias("final"))
            n, k = leaves.count(), keys.count()
            meta = {"replaces": [run.rsplit("/", 1)[1] for run in old], "leaves": self._cut(leaves, f"{to}/leaves", n, lambda p: _place(F.col("tree"), F.col("key"), p), ["tree", "key"])}
            meta["keys"] = self._cut(keys, f"{to}/keys", k, lambda p: _hashed(F.col("k"), p), ["k"])
            meta["sets"] = self._cut(sets, f"{to}/sets", 10 * (n // TREES), lambda p: _hashed(F.col("entry"), p), [])
            self._seal(to, meta)
            # Sealed, the merged run stands for the old ones, whether or not they are gone.
            for run in old:
                del self.runs[run]
                p, fs = self._at(run)
                fs.delete(p, True)

    def accept(self, rows: DataFrame, batch: int | None = None) -> DataFrame:
        """Accepts ``(rid, batch_no, text)`` as one run and returns ``(rid)`` of each row that repeats an earlier one, of any run or its own."""
        rows = _ordered(rows, batch)
        run = self.append(rows, batch)
        # The same but for formatting: the batch's keys with their earliest row of all runs.
        own = self._read("keys", _KEYS, runs=[run]).select("k", "final")
        known = self._read("keys", _KEYS, lambda n: own.select(_hashed(F.col("k"), n))).select("k", "first").join(own, "k")
        known = known.groupBy("k").agg(F.min("first").alias("first"), F.max("final").alias("final"))
        equal = _later(_keyed(rows, canonical.canonical(F.col("text"))), known)
        # The same word sequence as an earlier row of the run; of such rows only the earliest is an entry of the forest.
        worded = _keyed(rows, F.when(F.size(F.split(words(F.col("text")), " ")) >= 3, words(F.col("text"))))
        near = self.similar(run).select(F.col("entry").alias("rid"))
        # Written, as the runs read here may be merged before the result is used.
        return self._write("p1-repeats", equal.unionByName(_later(worded, _firsts(worded))).unionByName(near).distinct())

    def touched(self, run: str) -> tuple[DataFrame, DataFrame]:
        """``(tree, key, entry, ord, n)`` of a run's own leaves that share a widest range with another leaf, and of all leaves in those ranges.

        Leaves of other runs are read from the parts that hold the ranges, and shuffled ``AT_ONCE`` trees at a time.
        """
        at = _range(self.depth).alias("range")
        own = self._read("leaves", _LEAVES, runs=[run]).withColumn("range", at)
        ranges = self._write("p1-ranges", own.groupBy("range", "tree").agg(F.count(F.lit(1)).alias("k")))
        shift = LABEL_BITS * (DEPTH - self.depth)
        low = F.shiftleft("range", shift)
        ends = ranges.select(F.col("tree").alias("t"), F.explode(F.array(low, low + (1 << shift) - 1)).alias("k"))
        others = [r for r in self.runs if r != run]

        def within(leaves: DataFrame, some: DataFrame) -> DataFrame:
            # The range, which tells leaves apart at once, comes before the tree: sorts go by the first key. It is worked out, not carried along.
            some = some.select(F.col("range").alias("__r"), F.col("tree").alias("__t"))
            return leaves.join(some, (_range(self.depth) == F.col("__r")) & (F.col("tree") == F.col("__t")), "left_semi")

        def among(tree: str, first: int) -> Column:
            return F.col(tree).between(first, first + AT_ONCE - 1)

        def found(first: int) -> DataFrame:
            some = ends.where(among("t", first))
            return within(self._read("leaves", _LEAVES, lambda n: some.select(_place(F.col("t"), F.col("k"), n)), others).where(among("tree", first)), ranges.where(among("tree", first)))

        older = self._write("p1-older", *(found(t) for t in range(0, TREES, AT_ONCE)))
        shared = older.select(at, "tree").unionByName(ranges.where("k > 1").select("range", "tree")).distinct()
        own = self._write("p1-own", within(own.drop("range"), shared))
        self._drop("p1-ranges")
        return own, older.unionByName(own)

    def similar(self, run: str) -> DataFrame:
        """Entries of ``run`` that are similar to an earlier entry of any run: ``(entry)``. Entries of the run itself count as earlier by their id."""
        own, leaves = self.touched(run)
        new = own.select("tree", "key", F.col("entry").alias("a"), F.col("ord").alias("ao"), F.col("n").alias("an"))
        old = leaves.withColumnsRenamed({"entry": "b", "ord": "bo", "n": "bn"})
        earlier = (F.col("bo") < F.col("ao")) | ((F.col("bo") == F.col("ao")) & (F.col("b") < F.col("a")))
        near = (F.col("bn") >= THRESHOLD * F.col("an")) & (F.col("an") >= THRESHOLD * F.col("bn"))

        def verified(pairs: DataFrame) -> DataFrame:
            pairs = self._write("p1-pairs", pairs)
            some = self._write("p1-some", pairs.select(F.explode(F.array("a", "b")).alias("entry")).distinct())
            # The sets of candidates alone go into the joins below. They are picked by a broadcast of ids while these are few, else by a shuffle.
            few = F.broadcast(some) if some.count() <= BROADCAST else some
            sets = self._write("p1-sets", self._read("sets", _SETS, lambda n: some.select(_hashed(F.col("entry"), n))).join(few, "entry", "left_semi"))
            p = pairs.join(sets.select(F.col("entry").alias("b"), F.col("set").alias("sb")), "b").join(sets.select(F.col("entry").alias("a"), F.col("set").alias("sa")), "a")
            shared = F.size(F.array_intersect("sa", "sb"))
            return p.where(shared >= THRESHOLD * (F.size("sa") + F.size("sb") - shared)).select("a").distinct()

        settled = None
        for depth, all_of_them in [*((d, False) for d in range(DEPTH, self.depth - 1, -WIDEN)), (self.depth, True)]:
            probe = new if settled is None else new.join(settled, "a", "left_anti")
            at = _range(depth)
            probe, there = probe.withColumn("range", at), old.withColumn("range", at)
            if not all_of_them:
                # The earliest entry of each range.
                there = there.groupBy("range", "tree").agg(F.min(F.struct("bo", "b", "bn")).alias("f")).select("range", "tree", "f.*")
            pairs = probe.join(there, ["range", "tree"]).where(earlier & near).select("a", "b").distinct()
            more = self._write("p1-settled", verified(pairs))
            self._drop("p1-pairs", "p1-some", "p1-sets")
            settled = more if settled is None else settled.unionByName(more)
        self._drop("p1-older", "p1-own")
        return settled.select(F.col("a").alias("entry"))


#: Labels by which a prefix is shortened at a time.
WIDEN = 2
_LEAVES = "tree int, key bigint, entry bigint, ord int, n int"
_SETS = "entry bigint, set array<int>"
_KEYS = "k binary, first struct<b:int,r:bigint>, final struct<b:int,r:bigint>"


def _range(depth: int) -> Column:
    """The range of its tree in which a leaf stands by its first ``depth`` labels."""
    return F.shiftright("key", LABEL_BITS * (DEPTH - depth))


def repeats(history: DataFrame, incoming: DataFrame, one_by_one: bool = False) -> DataFrame:
    """``(rid)`` of each incoming row that repeats a row of ``history``, of an earlier batch, or an earlier one of its batch.

    Both have ``rid, text``; ``incoming`` has ``batch_no``. The history is accepted as one run. Waiting batches are accepted as one run, too: a row
    only counts what is earlier by batch and id, so this gives what accepting batch after batch does (``one_by_one``).
    """
    forest = HashForest(history.sparkSession)
    forest.append(history.select("rid", F.lit(-1).alias("batch_no"), "text"), -1)
    rows = incoming.select("rid", F.coalesce(F.col("batch_no").cast("int"), F.lit(LAST)).alias("batch_no"), "text")
    if not one_by_one:
        return forest.accept(rows)
    out = [forest.accept(rows.where(F.col("batch_no") == b), b) for (b,) in sorted(map(tuple, rows.select("batch_no").distinct().collect()))]
    return functools.reduce(DataFrame.unionByName, out).distinct() if out else rows.select("rid").limit(0)


#: Where rows without a batch stand: after all others.
LAST = 2**31 - 1


def _ordered(rows: DataFrame, batch: int | None) -> DataFrame:
    """``(rid, batch_no, text)`` with the batch that counts."""
    return rows.select("rid", (F.coalesce(F.col("batch_no").cast("int"), F.lit(LAST)) if batch is None else F.lit(batch)).alias("batch_no"), "text")


def _keyed(rows: DataFrame, key: Column) -> DataFrame:
    """``(rid, o, k)``: each row's place in the order and the digest of its key; rows without a key are left out."""
    order = F.struct(F.col("batch_no").alias("b"), F.col("rid").alias("r"))
    return rows.select("rid", order.alias("o"), key.alias("__k")).where("__k <> ''").select("rid", "o", F.unhex(F.md5("__k")).alias("k"))


def _firsts(keyed: DataFrame) -> DataFrame:
    """``(k, first, final)``: the earliest and the latest place of each key."""
    return keyed.groupBy("k").agg(F.min("o").alias("first"), F.max("o").alias("final"))


def _later(keyed: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows that come after the first of their key. Rows meet the keys by digest, salted; only keys that have a later row take part."""
    salts = canonical.SALTS
    first = firsts.where("first < final").select("k", "first").withColumn("salt", F.explode(F.array(*[F.lit(s) for s in range(salts)])))
    salted = keyed.select("rid", "o", "k", F.pmod(F.xxhash64("rid"), F.lit(salts)).cast("int").alias("salt"))
    return salted.join(first, ["k", "salt"]).where("first < o").select("rid")
