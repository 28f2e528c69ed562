"""Encoding a corpus with a public byte-level BPE tokenizer (problem 8).

Texts are split by the tokenizer's pattern in the JVM. Each distinct word is encoded once: higher-order functions fold
ranked merges over its bytes, looking ranks up in a literal map. Bytes are held as characters of ISO-8859-1, one each.
Words come back to their texts by two joins: the frequent ones (at most ``FREQUENT`` words can each make up a share of
1 / ``FREQUENT`` of all occurrences) through a broadcast of that size, the others through a shuffle that then has no hot key.

Defined results
---------------
* null and empty texts give an empty list; repeated texts are encoded once and given to each row
* the strings of special tokens are ordinary text; a repeated id keeps its rows apart only if its texts differ
* words of more than ``LONGEST`` bytes take the tokenizer library's own merge loop, since the fold is quadratic in a word's length
"""

from __future__ import annotations

import base64
import functools
import json
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.columns import staged
from corpusmill.session import ship, written

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this tokenizer splits text before the merges, with Unicode white space.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS, LONGEST, FREQUENT = 16384, 40, 20000


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def _buckets_json(path: str) -> str:
    """The rank map as buckets by checksum: Spark searches a map from its start, so each bucket holds a few pairs only."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for token, rank in load_ranks(path).items():
        s = token.decode("latin-1")
        buckets[zlib.crc32(s.encode()) % BUCKETS][s] = rank
    return json.dumps(buckets, separators=(",", ":"))


def _rank(s: Column, path: str) -> Column:
    buckets = F.from_json(F.lit(_buckets_json(path)), "array<map<string,int>>")
    return F.try_element_at(F.get(buckets, (F.crc32(s.cast("binary")) % BUCKETS).cast("int")), s)


def _fold(word: Column, path: str) -> Column:
    """The ids of one word: at each step the leftmost pair of lowest rank becomes one piece, until no pair has a rank."""
    n = F.length(word)
    start = F.struct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(word, i, F.lit(1))).alias("p"), F.lit(False).alias("done"))

    def step(s: Column, _: Column) -> Column:
        p = s["p"]
        pairs = F.filter(
            F.transform(F.slice(p, 1, F.size(p) - 1), lambda x, i: F.struct(_rank(F.concat(x, F.get(p, i + 1)), path).alias("r"), i.alias("i"))),
            lambda x: x["r"].isNotNull(),
        )
        # The array of one lowest pair, bound once by transform instead of being worked out for each of its uses.
        best = F.array(F.array_min(pairs))
        merged = F.transform(best, lambda b: F.when(b.isNull(), p).otherwise(F.concat(F.slice(p, F.lit(1), b["i"]), F.array(F.concat(F.get(p, b["i"]), F.get(p, b["i"] + 1))), F.slice(p, b["i"] + 3, F.size(p)))))[0]
        next_ = F.transform(F.array(merged), lambda m: F.struct(m.alias("p"), (F.size(m) == F.size(p)).alias("done")))[0]
        return F.when(s["done"] | (F.size(p) < 2), s).otherwise(next_)

    pieces = F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: s["p"])
    whole = F.transform(F.array(_rank(word, path)), lambda r: F.when(r.isNotNull(), F.array(r)))[0]
    return F.coalesce(whole, F.transform(pieces, lambda x: _rank(x, path)))


def encode_words(words: DataFrame, path: str = RANKS) -> DataFrame:
    """Adds ``ids`` to distinct non-empty ``word`` values."""
    ship(words.sparkSession)
    b = staged(words, {"__b": F.decode(F.encode("word", "UTF-8"), "ISO-8859-1")})

    @F.pandas_udf("array<int>")
    def long_words(w: pd.Series) -> pd.Series:
        import tiktoken

        enc = tiktoken.Encoding("ranks", pat_str=r"(?s).+", mergeable_ranks=load_ranks(path), special_tokens={})
        return w.map(lambda x: enc._encode_single_piece(x.encode("utf-8")))

    short = b.where(F.length("__b") <= LONGEST).withColumn("ids", _fold(F.col("__b"), path))
    return short.unionByName(b.where(F.length("__b") > LONGEST).withColumn("ids", long_words("word"))).drop("__b")


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _encoded_words(docs: DataFrame, id_col: str, text_col: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The rows as ``(doc_id, tid)`` and, for each distinct text, its words' ids as ``(tid, pos, ids)``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.md5(F.encode(text_col, "UTF-8")).alias("tid"), F.col(text_col).alias("text"))
    texts = rows.where("text <> ''").groupBy("tid").agg(F.first("text").alias("text")).select("tid", split_words(F.col("text")).alias("words"))
    texts = written(texts, "p8-words")
    counts = texts.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocab = written(encode_words(counts, path), "p8-vocabulary")
    total = vocab.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * FREQUENT >= total
    frequent, others = vocab.where(hot).select("word", "ids"), vocab.where(~hot).select("word", F.col("ids").alias("more"))
    at = texts.select("tid", F.posexplode("words").alias("pos", "word")).join(F.broadcast(frequent), "word", "left")
    known = at.where(F.col("ids").isNotNull()).select("tid", "pos", "ids")
    rest = at.where(F.col("ids").isNull()).select("tid", "pos", "word").join(others, "word").select("tid", "pos", F.col("more").alias("ids"))
    return rows.select("doc_id", "tid"), known.unionByName(rest)


def encode(docs: DataFrame, id_col: str, text_col: str, path: str = RANKS) -> DataFrame:
    """``(doc_id, ids)``, one row per row of ``docs``."""
    rows, at = _encoded_words(docs, id_col, text_col, path)
    # Neighbouring words are gathered before the shuffle, so a text arrives in a few runs.
    done = at.groupBy("tid").agg(F.collect_list(F.struct("pos", "ids")).alias("w"))
    done = done.select("tid", F.flatten(F.transform(F.array_sort("w"), lambda x: x["ids"])).alias("ids"))
    return rows.join(done, "tid", "left").select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


def count_tokens(docs: DataFrame, id_col: str, text_col: str, path: str = RANKS) -> DataFrame:
    """``(doc_id, tokens)``, one row per row of ``docs``; 0 for null and empty texts."""
    rows, at = _encoded_words(docs, id_col, text_col, path)
    done = at.groupBy("tid").agg(F.sum(F.size("ids")).alias("tokens"))
    return rows.join(done, "tid", "left").select("doc_id", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """Adds ``text``, the concatenation of the ids' binary pieces; ids outside the vocabulary are left out."""
    spark = encoded.sparkSession
    pieces = spark.createDataFrame([(r, bytearray(t)) for t, r in load_ranks(path).items()], "id int, piece binary")  # a vocabulary: of fixed size
    at = encoded.withColumn("__row", F.monotonically_increasing_id())
    at = written(at, "p8-decode")
    got = at.select("__row", F.posexplode("ids").alias("pos", "id")).join(F.broadcast(pieces), "id")
    got = got.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("w"))
    text = F.decode(F.aggregate("w", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["piece"])), "UTF-8")
    return at.join(got.select("__row", text.alias("text")), "__row", "left").drop("__row").withColumn("text", F.coalesce("text", F.lit("")))
