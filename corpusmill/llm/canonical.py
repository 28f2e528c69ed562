"""Duplicates hidden by formatting differences (problem 7).

Byte-identical raw texts collapse first, with counts; only the distinct survivors are made canonical; these are grouped
again on the full canonical text, summing the counts. Both groupings pre-aggregate before their shuffle, so a text that
a third of all rows share costs one row per input partition.

Defined results
---------------
* null texts and texts without any letter or digit belong to no group
* case, accents (precomposed or combining) and all characters but letters and digits are ignored
* a text with two or more fields ``Name: value`` of a card, each at its start or after a bar, semicolon or line break,
  is the sorted list of its fields; whatever precedes the first field counts as a field without name
* repeated ``id`` values stay repeated rows; extra columns are ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import bound, folded_lower
from corpusmill.session import written

# The field names of a card, without accents, in lower case.
CARD_FIELDS = ["alegacao", "local", "data", "canal", "alcance"]
_FIELD = r"(?:^|[|;\r\n])[^\p{L}\p{N}|;\r\n]*(" + "|".join(CARD_FIELDS) + r")[^\p{L}\p{N}:|;\r\n]*:"
_NOISE = r"[^\p{L}\p{N}]+"
#: A raw text of more than one in HOT rows is hot: there are fewer than HOT of them, whatever the number of rows.
HOT = 1000
#: Copies of the small side where rows meet keys by a salted join (``forest``).
SALTS = 16


def canonical(text: Column) -> Column:
    """The canonical form by which two texts are the same; empty for texts without letters and digits, null for null."""

    def of_folded(t: Column) -> Column:
        marked = F.split(F.regexp_replace(t, _FIELD, "\u0001$1\u0002"), "\u0001")
        fields = F.transform(marked, lambda x: F.regexp_replace(x, r"[^\p{L}\p{N}\u0002]+", ""))
        card = F.array_join(F.array_sort(F.filter(fields, lambda x: x != "")), "\u0001")
        # A card has at least two colons: most texts are told apart without the pattern.
        return F.when((F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit(""))) > 1) & t.rlike(f"(?s){_FIELD}.*{_FIELD}"), card).otherwise(F.regexp_replace(t, _NOISE, ""))

    return bound(folded_lower(text), of_folded)


def survivors(rows: DataFrame, id_col: str, text_col: str, first: Column | None = None) -> DataFrame:
    """One row per distinct raw text: ``raw`` (its digest), ``n``, ``first`` (smallest id, or of ``first``), ``canon``."""
    first = F.col(id_col) if first is None else first
    raw = rows.where(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("__text")).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))
    return raw.select(F.md5(F.encode("__text", "UTF-8")).alias("raw"), "n", "first", canonical(F.col("__text")).alias("canon")).where("canon <> ''")


def deduplicate(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per text: ``rid_first`` (smallest id), ``copies`` (rows it stands for), ``variants`` (distinct raw texts)."""
    s = survivors(rows, id_col, text_col)
    return s.groupBy("canon").agg(F.min("first").alias("rid_first"), F.sum("n").alias("copies"), F.count(F.lit(1)).alias("variants")).drop("canon")


def membership(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(rid_first, rid, copies)`` of every row whose text has at least two copies, the first row included.

    Rows meet their group through 128-bit digests: of the raw text, then of the canonical one. Texts themselves are
    shuffled in the two groupings only. A hot text's rows, a third of all say, are not shuffled at all.
    """
    s = survivors(rows, id_col, text_col)
    groups = s.groupBy("canon").agg(F.min("first").alias("rid_first"), F.sum("n").alias("copies")).where("copies > 1")
    groups = groups.select(F.md5("canon").alias("ck"), "rid_first", "copies")
    of_raw = written(s.select("raw", "n", F.md5("canon").alias("ck")).join(groups, "ck").select("raw", "n", "rid_first", "copies"), "p7-groups")
    keyed = rows.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("rid"), F.md5(F.encode(text_col, "UTF-8")).alias("raw"))
    # Rows of hot texts meet their group by a broadcast of fewer than HOT rows; the others have no hot key left.
    limit = rows.count() / HOT
    hot = of_raw.where(F.col("n") > limit).drop("n")
    if hot.isEmpty():
        return keyed.join(of_raw.drop("n"), "raw").select("rid_first", "rid", "copies")
    few = keyed.join(F.broadcast(hot), "raw").select("rid_first", "rid", "copies")
    many = keyed.join(F.broadcast(hot.select("raw")), "raw", "left_anti").join(of_raw.where(F.col("n") <= limit).drop("n"), "raw")
    return few.unionByName(many.select("rid_first", "rid", "copies"))


def found(rows: DataFrame) -> DataFrame:
    """``(rid_first, rid_copy)``: for each group one row for each rid but the smallest."""
    return membership(rows.select("rid", "text_no_url"), "rid", "text_no_url").where("rid <> rid_first").select("rid_first", F.col("rid").alias("rid_copy"))
