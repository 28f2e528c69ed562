"""Building a new version of the table: filter, limit, de-duplicate, unite, and check what must not have changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.operators import cleaning, near_duplicates, sampling


class IntegrityError(ValueError):
    """A merge that would change the base, repeat an id or leave rows without a match."""


def eligible(new: DataFrame, base: DataFrame) -> DataFrame:
    """New rows with a known label, a text, three words at least (what is no number counts as none) and an id the base does not have."""
    words = F.coalesce(F.col("word_len").cast("string").try_cast("double"), F.lit(0.0))
    kept = new.where(F.col("label").isin("fake", "true") & ~T.blank(F.col("text")) & (words >= 3))
    return kept.withColumns({c: F.lit(0) for c in ("is_duplicated", "is_null", "too_short")}).join(base.select("rid"), "rid", "left_anti").select(new.columns)


def merge(base: DataFrame, new: DataFrame, provenance: DataFrame, ratio: float | None = 1.0, near: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(table, provenance of the new rows, decisions)``: the base unchanged, then the new rows that are kept, told apart by ``part``.

    Order: filters, quota of provenance-only rows by era, de-duplication with ratings before provenance, then date. Base rows are never
    touched, and nothing depends on positions.
    """
    rows = eligible(new, base)
    if ratio is not None:
        rows = sampling.era_quota(rows, ratio).select(new.columns)
    source = provenance.groupBy("rid").agg(F.min("label_source").alias("__source"))
    ranked = rows.join(source, "rid", "left")
    decisions = near_duplicates.deduplicate(ranked, base, priority=F.when(F.col("__source") == "rating", 1).otherwise(2), near=near)
    kept = rows.join(decisions.where("reason IS NULL").select("rid"), "rid", "left_semi").select(V.COLUMNS)
    table = base.select(V.COLUMNS).withColumn("part", F.lit("base")).unionByName(kept.withColumn("part", F.lit("new")))
    return table, provenance.join(kept.select("rid"), "rid", "left_semi"), decisions


def check_merge(table: DataFrame, base: DataFrame) -> None:
    """Fails if the base part's content or an id's uniqueness is broken."""
    was, now = (cleaning.content_digest(df, "rid", "text_no_url").first() for df in (base, table.where("part = 'base'")))
    if was != now:
        raise IntegrityError(f"the base changed: {was} before, {now} after")
    repeated = table.groupBy("rid").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("part") == "new").alias("k")).where("n > 1 AND k > 0")
    if not repeated.isEmpty():
        raise IntegrityError("an id of a new row is not its own")


def require_matches(left: DataFrame, right: DataFrame, key: str) -> None:
    """Fails if an id of ``left`` has no row in ``right``."""
    missing = left.select(key).join(right.select(key), key, "left_anti")
    if not missing.isEmpty():
        raise IntegrityError(f"{missing.count()} rows have no match by {key}")


def modelling_table(main: DataFrame, labels: DataFrame, provenance: DataFrame) -> DataFrame:
    """Rows to model: those the label table has a trainable label for, with target, group, channel, dialect, rating class and style rates.

    The label table's ``train_label`` replaces the source's label; rows without one are left out on purpose. ``is_balanced_group`` is
    judged on the rows that are left.
    """
    l = labels.groupBy("rid").agg(F.min(F.when(F.col("train_label").isin("fake", "true"), F.col("train_label"))).alias("train_label"))
    p = provenance.groupBy("rid").agg(F.min("label_source").alias("label_source"))
    x = main.join(l, "rid", "left").join(p, "rid", "left").withColumn("label", F.col("train_label"))
    x = x.where(F.col("label").isin("fake", "true") & ~T.blank(F.col("text")))
    w = F.greatest(F.coalesce("word_len", F.lit(0)), F.lit(0))
    x = x.withColumns({"target": (F.col("label") == "fake").cast("int"), "group": F.coalesce("dataset_name", F.lit("nan"))})
    balanced = sampling.balanced_groups(x, "group", "target", V.BALANCED_GROUPS).select("group", F.col("balanced").alias("is_balanced_group"))
    x = x.join(balanced, "group")
    both = F.concat_ws(" ", F.coalesce("url_review", F.lit("")), F.coalesce("factcheck_url", F.lit("")))
    return x.select(
        "rid", "label", "target", "group", "is_balanced_group", T.channel(F.col("group")).alias("channel"),
        both.rlike(f"(?i){V.PTPT_3}").alias("is_ptpt"), T.model_rating_class(F.col("factcheck_rating")).alias("rating_class"), F.coalesce("label_source", F.lit("")).alias("label_source"),
        (F.coalesce("num_exclamations", F.lit(0)) / (w + 1.0)).alias("excl_rate"), (F.coalesce("num_questions", F.lit(0)) / (w + 1.0)).alias("quest_rate"), (F.coalesce("num_ellipsis", F.lit(0)) / (w + 1.0)).alias("ellip_rate"),
        F.coalesce("uppercase_word_ratio", F.lit(0.0)).alias("upper_rate"), F.log1p(w).alias("log_word_len"),
    )


def length_band(words: Column) -> Column:
    """Bands of word counts, each closed at the right."""
    return F.when(words <= 10, "1-10").when(words <= 20, "11-20").when(words <= 40, "21-40").when(words <= 80, "41-80").when(words <= 200, "81-200").when(words.isNotNull(), "200+").otherwise("none")


def year_band(date_iso: Column) -> Column:
    """Bands of years, each closed at the right, and ``none`` for what is no date."""
    y = F.year(F.try_to_date(F.substring(date_iso, 1, 10), "yyyy-MM-dd"))
    return F.when(y <= 2015, "to 2015").when(y <= 2017, "2016-2017").when(y <= 2019, "2018-2019").when(y <= 2021, "2020-2021").when(y.isNotNull(), "2022 on").otherwise("none")


def closed_era(date_iso: Column) -> Column:
    """Eras with right-closed bounds, as the older report has them: the days of the cuts belong to the era before."""
    d = F.try_to_date(F.substring(date_iso, 1, 10), "yyyy-MM-dd")
    return F.when(d.isNull(), "sem_data").when(d <= F.lit("2018-01-01").cast("date"), "ate_2017").when(d <= F.lit("2022-12-01").cast("date"), "2018_2022").otherwise("pos_gpt35")
