"""Mapping freely typed values to the entries of a reference list (problem 4).

A prefix-filter set-similarity join. A value and every name or alias become sets of character tokens (letters, pairs at
distance one and two, first and last letter). Tokens are ordered by global rarity; two sets of a Jaccard similarity of
``threshold`` share a token among the first ``n - ceil(threshold * n) + 1`` of each, so only those prefixes are joined.
Length and positional filters follow, then the exact Jaccard similarity; the most similar entry is kept, if an exact
edit-distance check finds no unrelated word in it. Only distinct values take part.

A value is tried by its parts, one after the other, and of each part its first words, up to as many as the longest name has.

Defined results
---------------
* null and blank values are no values: they have no entry and are not reported
* a value without any letter or digit, or with none close enough, belongs to entry 0
* if more words follow the verdict, the verdict counts; a label before it (``Selo: ...``) is passed over
* of several near entries: the earlier part of the value, the more similar, the fewer edits, the longer name, the smaller id
* an empty reference gives entry 0 for every value
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.columns import staged
from corpusmill.functions.text import blank, bound, folded_lower
from corpusmill.session import written

# Letters of other scripts that look like Latin ones, and digits and signs typed for letters.
LOOKALIKES = ("аеорсухіѕјһԁԛѡкмтвнαοερικνυχ", "aeopcyxisjhdqwkmtbhaoepiknux")
TYPED_FOR = ("0134578@$", "oieastbas")
_PART = r"\s*(?:[:|(;→\n]|\s[-–—]+\s|\.\s|->|=>)\s*"
#: Copies of the table of values in the join that gives rows their entry, so that the rows of one common value meet in many tasks.
SALTS = 16


def _keyed(df: DataFrame, source: Column) -> DataFrame:
    """Adds ``k``: letters and digits only, with signs typed for letters undone and the last word's ending of gender and number made alike."""
    df = staged(df, {"__w": F.split(F.trim(F.regexp_replace(source, r"[^a-z0-9@$]+", " ")), " ")})
    undone = F.transform("__w", lambda w: F.when(w.rlike("[a-z]"), F.translate(w, *TYPED_FOR)).otherwise(w))
    # A word spelled with spaces is one word.
    spelled = (F.size("__w") > 2) & F.forall("__w", lambda w: F.length(w) == 1)
    df = staged(df, {"__k": F.when(spelled, F.array(F.translate(F.array_join("__w", ""), *TYPED_FOR))).otherwise(undone)})
    return df.withColumn("k", F.regexp_replace(F.array_join("__k", ""), r"(?<=[a-z]{3})[oa]s?$", "o")).drop("__w", "__k")


def _clean(value: Column) -> Column:
    t = F.translate(folded_lower(F.regexp_replace(value, r"<[^<>]*>", " ")), *LOOKALIKES)
    # A value spelled with spaces is one word, and its signs part nothing.
    t = bound(t, lambda x: F.when(x.rlike(r"^\s*(?:\S\s+){3,}\S\s*$"), F.regexp_replace(x, r"\s+", "")).otherwise(x))
    return F.regexp_replace(t, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")


def _tokens(s: Column) -> Column:
    n = F.length(s)
    at = lambda i, k: F.substring(s, i, k)
    idx = lambda m: F.when(m >= 1, F.sequence(F.lit(1), m)).otherwise(F.array().cast("array<int>"))
    one = F.transform(idx(n), lambda i: F.substr(s, i, F.lit(1)))
    two = F.transform(idx(n - 1), lambda i: F.substr(s, i, F.lit(2)))
    gap = F.transform(idx(n - 2), lambda i: F.concat(F.substr(s, i, F.lit(1)), F.substr(s, i + 2, F.lit(1))))
    return F.array_distinct(F.concat(one, two, gap, F.array(F.concat(F.lit("^"), at(1, 1)), F.concat(F.substr(s, n, F.lit(1)), F.lit("$")))))


def _ranked(sets: DataFrame, ids: list[str], rarity: DataFrame) -> DataFrame:
    """Each set's tokens with their position in the order of rarity; tokens no set of the other side has come first."""
    t = sets.select(*ids, F.size("toks").alias("n"), F.explode("toks").alias("tok")).join(rarity, "tok", "left")
    t = t.groupBy(*ids, "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "tok"))).alias("o"))
    return t.select(*ids, "n", F.posexplode(F.col("o.tok")).alias("pos", "tok"))


def map_values(values: DataFrame, value: str, reference: DataFrame, threshold: float = 0.28) -> DataFrame:
    """``(value, entry, name, similarity)`` for each distinct non-blank value; entry 0 where none is meant.

    ``reference`` has ``rating_id, rating_name, aliases``. The tokens of a value are bounded by its own length and those
    of all values by the alphabet, so the table of rarities has a few thousand rows at any size.
    """
    names = reference.select("rating_id", F.explode(F.concat(F.array("rating_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("name"))
    spoken = names.where(~blank(F.col("name")))
    names = _keyed(names.where(~blank(F.col("name"))), _clean(F.col("name"))).withColumnRenamed("k", "nk").where("nk <> ''").groupBy("nk").agg(F.min("rating_id").alias("rating_id"))
    # Written once, so that each of the following plans stays small.
    names = written(names.select("rating_id", "nk", _tokens(F.col("nk")).alias("toks")), "p4-names")
    longest = spoken.agg(F.max(F.size(F.split(F.trim("name"), r"\s+")))).first()[0] or 1

    distinct = values.where(~blank(F.col(value))).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    parts = staged(distinct, {"clean": _clean(F.col("value"))}).select("value", F.posexplode(F.split("clean", _PART)).alias("part", "text"))
    parts = staged(parts, {"w": F.filter(F.split("text", r"\s+"), lambda x: x != "")})
    heads = [F.array_join(F.slice("w", 1, k), " ") for k in range(1, longest + 1)]
    tails = F.array_join(F.filter("w", lambda x, i: i > 0), " ")  # after an article or a generic noun
    tries = F.array_distinct(F.array(F.col("text"), tails, *heads))
    tries = parts.select("value", "part", F.posexplode(tries).alias("cut", "try"))
    # The whole part comes before what is left of it without leading or trailing words.
    tries = tries.withColumn("part", F.col("part") * 2 + F.when(F.col("cut") > 0, 1).otherwise(0))
    tries = written(_keyed(tries, F.col("try")).where("k <> ''").groupBy("value", "k").agg(F.min("part").alias("part")), "p4-tries")
    # Keys repeat over many values (tails, above all): each is compared once.
    keys = tries.select("k").distinct()
    # The bytes are few and the work per key is not: AQE must not fold the partitions into one.
    tasks = max(8, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = written(staged(keys.repartition(tasks, "k"), {"toks": _tokens(F.col("k"))}), "p4-keys")

    rarity = names.select(F.explode("toks").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    left = _ranked(keys, ["k"], rarity)
    right = _ranked(names.withColumn("r", F.col("rating_id")), ["nk", "r"], rarity).withColumnsRenamed({"n": "rn", "pos": "rpos"})
    keep = lambda n, pos: F.col(pos) < F.col(n) - F.ceil(threshold * F.col(n)) + 1
    pairs = left.where(keep("n", "pos")).join(right.where(keep("rn", "rpos")), "tok")
    pairs = pairs.where((F.col("n") >= threshold * F.col("rn")) & (F.col("rn") >= threshold * F.col("n")))
    need = F.ceil(threshold / (1 + threshold) * (F.col("n") + F.col("rn")))
    pairs = pairs.groupBy("k", "nk", "r", "n", "rn").agg(F.min(F.struct("pos", "rpos")).alias("p"))
    pairs = pairs.where(1 + F.least(F.col("n") - F.col("p.pos") - 1, F.col("rn") - F.col("p.rpos") - 1) >= need)
    pairs = pairs.repartition(tasks, "k").join(keys, "k").join(names.select("nk", F.col("toks").alias("ntoks")), "nk")
    shared = F.size(F.array_intersect("toks", "ntoks"))
    scored = pairs.withColumn("similarity", shared / (F.col("n") + F.col("rn") - shared)).where(F.col("similarity") >= threshold)
    letters = lambda c: F.array_join(F.array_sort(F.split(c, "")), "")
    edits = F.levenshtein("k", "nk")
    edits = F.when((edits == 2) & (letters(F.col("k")) == letters(F.col("nk"))), 1).otherwise(edits)
    size = F.length("nk")
    most = F.when(size <= 6, 1).when(size <= 8, 2).otherwise(F.floor(size * 0.3))
    scored = scored.withColumn("edits", edits).where(F.col("edits") <= most)
    best = tries.join(scored, "k").groupBy("value").agg(F.min(F.struct("part", (-F.col("similarity")).alias("s"), "edits", (-size).alias("l"), "r", "nk")).alias("b"))
    return distinct.join(written(best, "p4-best"), "value", "left").select("value", F.coalesce("b.r", F.lit(0)).cast("int").alias("entry"), F.col("b.nk").alias("name"), (-F.col("b.s")).alias("similarity"), "rows")


def found(main: DataFrame, reference: DataFrame) -> DataFrame:
    """``(rid, rating_id)`` of each row whose rating is neither null nor blank nor, character by character, a name of the list."""
    rows = main.select("rid", F.col("factcheck_rating").alias("value")).where(~blank(F.col("value")))
    rows = rows.join(reference.select(F.col("rating_name").alias("value")).distinct(), "value", "left_anti")
    mapped = map_values(rows, "value", reference).select("value", F.col("entry").alias("rating_id"), F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
    return salted.join(mapped, ["value", "salt"]).select("rid", "rating_id")


def unmatched(main: DataFrame, reference: DataFrame) -> DataFrame:
    """``(value, rows)`` of the values that belong to no entry."""
    return map_values(main, "factcheck_rating", reference).where("entry = 0").select("value", "rows")
