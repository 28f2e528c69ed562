"""Conflicts, richness, sanitising, and the checks that judge a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators.ordering import first_per_key


def conflicting_texts(df: DataFrame) -> DataFrame:
    """``(text_clean, labels, subsets, row_count)`` of the texts that carry more than one label.

    The lists of the rows' labels and groups are given as ``(value, n)`` in the order of values: a list of all rows of a text would grow
    with its copies, this one with the groups there are.
    """
    seen = df.where("text_clean IS NOT NULL").groupBy("text_clean", "label", "dataset_name").agg(F.count("rid").alias("n"))

    def listed(of: str) -> DataFrame:
        one = seen.where(F.col(of).isNotNull()).groupBy("text_clean", of).agg(F.sum("n").alias("n"))
        return one.groupBy("text_clean").agg(F.array_sort(F.collect_list(F.struct(F.col(of).alias("value"), "n"))).alias("l"))

    labels = listed("label").where(F.size("l") > 1).withColumnRenamed("l", "labels")
    rows = seen.groupBy("text_clean").agg(F.sum("n").alias("row_count"))
    return labels.join(listed("dataset_name").withColumnRenamed("l", "subsets"), "text_clean", "left").join(rows, "text_clean").select("text_clean", "labels", "subsets", "row_count")


def conflict_audit(df: DataFrame) -> DataFrame:
    """Every row of a text with conflicting labels, whole, with its text's lists and number of rows."""
    c = conflicting_texts(df).withColumnsRenamed({"labels": "labels_involved", "subsets": "subsets_involved"})
    return df.join(c, "text_clean").select(*df.columns, "subsets_involved", "labels_involved", "row_count")


def richness(df: DataFrame) -> Column:
    """How much a row says about itself: address 4, rating 3, claimant 2, date 2, not a raw group 1."""
    has = lambda c, n: F.when(T.blank(F.col(c)), 0).otherwise(n)
    return has("url_review", 4) + has("factcheck_rating", 3) + has("factcheck_claimant", 2) + has("date_iso", 2) + F.when(F.coalesce(F.endswith("dataset_name", F.lit("_raw")), F.lit(False)), 0).otherwise(1)


def sanitize(df: DataFrame) -> DataFrame:
    """Rows of texts without conflict, the richest of each text (ties: smallest rid), with metrics worked out again.

    Rows without ``text_clean`` are one text. Columns keep their order.
    """
    bad = conflicting_texts(df).select("text_clean")
    kept = df.join(bad, "text_clean", "left_anti").select(df.columns)
    kept = first_per_key(kept.withColumn("__score", richness(kept)), ["text_clean"], [F.desc("__score"), F.asc("rid")]).drop("__score")
    tweets = F.col("dataset_name").isin("Fake.br", "Fake.br_raw") & (F.col("source_type") == "tweets")
    metrics = {k: c.cast(df.schema[k].dataType) for k, c in T.style_counts(F.col("text"), F.col("text_clean")).items()}
    return kept.withColumns({"source_type": F.when(tweets, "news").otherwise(F.col("source_type"))} | metrics)


def content_digest(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row ``(n, digest)`` that any change of a key or normalised text changes, whatever the order of the rows.

    Each row's SHA-256 over key and text contributes sixty bits to an exclusive or, which needs no sort and no list.
    """
    h = F.sha2(F.concat_ws("\t", F.col(key).cast("string"), T.normalize_text(F.col(text))).cast("binary"), 256)
    bits = F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(bits).alias("digest"))


def judge(df: DataFrame) -> DataFrame:
    """``(rule, violations)``: one row per check, all from one pass over the rows and two over keys."""
    zero = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(-1)) != 0)
    news_true = F.coalesce(F.startswith("dataset_name", F.lit("NEWS_")) & (F.col("label") == "true"), F.lit(False))
    one = df.agg(
        zero("is_duplicated").alias("is_duplicated"), zero("is_null").alias("is_null"), zero("too_short").alias("too_short"),
        F.count_if(T.blank(F.col("text"))).alias("blank_text"), F.count_if(F.coalesce("word_len", F.lit(0)) < 3).alias("word_len"),
        F.count_if(~F.coalesce(F.col("label").isin("fake", "true"), F.lit(False))).alias("label"), F.count_if(news_true & T.leaks_verdict(F.col("text"))).alias("leak"),
    )
    rules = one.unpivot([], one.columns, "rule", "violations")
    repeated = lambda keys, name: keys.groupBy("k").agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.lit(name).alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
    return rules.unionByName(repeated(df.select(F.col("rid").alias("k")), "repeated_rid")).unionByName(repeated(df.select(F.md5(T.normalize_text(F.col("text_no_url"))).alias("k")), "repeated_text"))


def judge_version(table: DataFrame, base: DataFrame, columns: list[str]) -> DataFrame:
    """``judge`` of a new version's rows, and what must hold between it and its base: ``(rule, violations)``.

    ``table`` has ``part``, ``base`` or ``new``. Violations of the base's digest and of the columns' order are 0 or 1; ``id_collision``
    counts new rows whose id the base has.
    """
    digest = lambda df: content_digest(df, "rid", "text_no_url").select(F.struct("n", "digest").alias("d"))
    was, now = digest(base).select(F.col("d").alias("was")), digest(table.where("part = 'base'")).select(F.col("d").alias("now"))
    changed = was.join(F.broadcast(now)).select(F.lit("base_changed").alias("rule"), (F.col("was") != F.col("now")).cast("bigint").alias("violations"))
    order = table.sparkSession.range(1).select(F.lit("column_order").alias("rule"), F.lit(int([c for c in table.columns if c != "part"] != columns)).cast("bigint").alias("violations"))
    new = table.where("part = 'new'")
    hit = new.select("rid").join(base.select("rid").distinct(), "rid", "left_semi").agg(F.lit("id_collision").alias("rule"), F.count(F.lit(1)).alias("violations"))
    return judge(new).unionByName(changed).unionByName(order).unionByName(hit)


def audit(df: DataFrame, top: int = 20) -> DataFrame:
    """``(section, key, n)``: rows by label, era, label and era, source type, the ``top`` largest groups, dialect and mentions of artificial intelligence."""
    from corpusmill.functions import vocabulary as V

    era = T.era(F.col("date_iso"))
    of = lambda c: F.coalesce(c.cast("string"), F.lit("nan"))
    marks = {
        "label": of(F.col("label")), "era": era, "label_by_era": F.concat(of(F.col("label")), F.lit(" | "), era), "source_type": of(F.col("source_type")), "dataset": of(F.col("dataset_name")),
        "ptpt": F.coalesce("url_review", F.lit("")).rlike(f"(?i){V.PTPT_6}").cast("string"), "mentions_ai": T.mentions_ai(F.col("text")).cast("boolean").cast("string"),
    }
    each = F.array(*[F.struct(F.lit(k).alias("section"), c.alias("key")) for k, c in marks.items()])
    n = df.select(F.inline(each)).groupBy("section", "key").agg(F.count(F.lit(1)).alias("n"))
    largest = n.where("section = 'dataset'").orderBy(F.desc("n"), "key").limit(top)
    return n.where("section <> 'dataset'").unionByName(largest)


def composition(df: DataFrame) -> DataFrame:
    """One row of counts: rows, labels, verdicts by source or provenance, dialect and its share in percent."""
    news = F.coalesce(F.startswith("dataset_name", F.lit("NEWS_")), F.lit(False))
    from corpusmill.functions import vocabulary as V

    pt = F.coalesce("url_review", F.lit("")).rlike(f"(?i){V.PTPT_6}")
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "fake").alias("fake"), F.count_if(F.col("label") == "true").alias("true"), F.count_if(news).alias("provenance"), F.count_if(~news).alias("verdict"),
        F.count_if(pt).alias("ptpt"), F.bround(F.coalesce(100 * F.try_divide(F.count_if(pt), F.count(F.lit(1))), F.lit(0.0)), 2).alias("ptpt_percent"),
    )


def with_contract_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The contract's columns in its order and types; absent ones are null, others are dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[c.lower()]) if c.lower() in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
