"""Readers with explicit schemas: delimited files, record logs, feeds, pages, site maps, news searches, external corpora.

Fetching over a network is not an engine's work: every reader takes files. Types are declared and never inferred (the label
``true`` would otherwise make a column boolean).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as T

MAIN_TYPES = dict(
    rid="bigint", dataset_name="string", source_type="string", source_description="string", label="string", date_iso="string", url_review="string", text="string", text_clean="string", text_no_url="string",
    extracted_urls="string", is_duplicated="int", is_null="int", too_short="int", factcheck_rating="string", factcheck_claimant="string", factcheck_url="string",
    char_len="int", word_len="int", num_exclamations="int", num_questions="int", num_ellipsis="int", uppercase_word_ratio="double",
)
PROVENANCE_TYPES = dict(rid="bigint", label_source="string", text_role="string", publisher="string", lang_variant="string", collector="string", source_url="string", collected_at="string", rating_norm="string", mentions_ai="int")


def ddl(types: dict[str, str]) -> str:
    return ", ".join(f"`{k}` {v}" for k, v in types.items())


def read_csv(spark: SparkSession, path: str | list[str], types: dict[str, str] = MAIN_TYPES, line_breaks: bool = True) -> DataFrame:
    """Delimited files with a header and doubled quotes. Only selected columns are parsed.

    Values may hold line breaks, so a file is read by one task: write many files. Where none do, ``line_breaks=False`` splits files.
    """
    return spark.read.schema(ddl(types)).option("header", True).option("multiLine", line_breaks).option("escape", '"').option("enforceSchema", False).csv(path)


def read_log(spark: SparkSession, path: str | list[str], schema: str, strict: bool = False) -> DataFrame:
    """Records line by line. Blank, partial and malformed lines are skipped, or fail the job if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def line_counts(spark: SparkSession, folder: str, glob: str = "*.jsonl") -> DataFrame:
    """``(file, lines)`` of each file of a folder that has any line."""
    return spark.read.option("pathGlobFilter", glob).text(folder).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("lines"))


def read_matrix(spark: SparkSession, path: str, ids: DataFrame | None = None, key: str = "rid") -> DataFrame:
    """``(file, row, vector)`` of the ``.npy`` matrices at a path, one task a file; with ``ids`` ``(file, row, key)`` the rows by id.

    Fails if an id has no row or a row has no id: a matrix that doesn't fit its ids must not be used.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").load(path).select(F.col("_metadata.file_name").alias("file"), "content")

    def rows(batches):
        import io

        import numpy as np
        import pandas as pd

        for b in batches:
            for name, content in zip(b["file"], b["content"], strict=True):
                m = np.load(io.BytesIO(content), allow_pickle=False)
                yield pd.DataFrame({"file": name, "row": np.arange(len(m)), "vector": list(m.astype(np.float32))})

    vectors = files.mapInPandas(rows, "file string, row bigint, vector array<float>")
    if ids is None:
        return vectors
    both = vectors.join(ids.select("file", "row", key), ["file", "row"], "full")
    bad = both.agg(F.count_if(F.col("vector").isNull()).alias("a"), F.count_if(F.col(key).isNull()).alias("b")).first()
    if bad["a"] or bad["b"]:
        raise ValueError(f"{bad['a']} ids without a row, {bad['b']} rows without an id")
    return both.select(key, "vector")


def read_log_folder(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All ``*.jsonl`` of a folder, with ``source_key``, the file's name without its ending."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.jsonl").json(folder)
    return rows.withColumn("source_key", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.jsonl$", 1))


def split_provenance(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that hold a ``_provenance`` struct become the main and the side table."""
    main = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in MAIN_TYPES.items()])
    have = rows.schema["_provenance"].dataType.fieldNames()
    return main, rows.select("rid", *[F.col(f"_provenance.{c}").cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in PROVENANCE_TYPES.items() if c != "rid"])


_REVIEW = (
    "array<struct<`@type`:string,url:string,claimReviewed:string,datePublished:string,reviewRating:struct<alternateName:string>,"
    "author:struct<name:string,url:string>,itemReviewed:struct<author:struct<name:string>>>>"
)


def read_claim_feed(spark: SparkSession, path: str) -> DataFrame:
    """One document with ``dataFeedElement[].item``, each null, an object or an array: one row per claim review."""
    doc = spark.read.schema("dataFeedElement array<struct<item:string>>").option("multiLine", True).json(path)
    item = doc.select(F.explode("dataFeedElement").alias("e")).select(F.col("e.item").alias("item")).where("item IS NOT NULL")
    many = F.when(F.startswith(F.ltrim("item"), F.lit("[")), F.col("item")).otherwise(F.concat(F.lit("["), "item", F.lit("]")))
    r = item.select(F.explode(F.from_json(many, _REVIEW)).alias("r")).where("r.`@type` = 'ClaimReview'")
    return r.select(
        F.col("r.url").alias("url"), F.col("r.claimReviewed").alias("claimReviewed"), F.col("r.reviewRating.alternateName").alias("rating"), F.col("r.itemReviewed.author.name").alias("claimant"),
        F.col("r.author.name").alias("review_author"), F.substring("r.datePublished", 1, 10).alias("date_iso"), T.domain(F.coalesce("r.url", "r.author.url")).alias("domain"),
    )


def first_per_claim(rows: DataFrame) -> DataFrame:
    """One row per address and claim, the smallest rating's."""
    rest = [c for c in rows.columns if c not in ("url", "claimReviewed")]
    return rows.groupBy("url", "claimReviewed").agg(F.min(F.struct(*rest)).alias("r")).select("url", "claimReviewed", "r.*").select(rows.columns)


def claim_rows(api: DataFrame, publishers: DataFrame) -> DataFrame:
    """Search results ``(text, claimant, claimDate, claimReview array)`` as one row per review, with its publisher's data (``site`` and more)."""
    r = api.select("text", "claimant", "claimDate", F.explode("claimReview").alias("r"))
    r = r.select("text", "claimant", F.col("r.url").alias("url"), F.coalesce(F.nullif("r.textualRating", F.lit("")), F.nullif("r.title", F.lit(""))).alias("rating"), F.substring(F.coalesce("r.reviewDate", "claimDate"), 1, 10).alias("date_iso"), F.col("r.publisher.site").alias("site"))
    return r.join(publishers, "site", "left")


def read_site_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, kind, url, day)`` of every ``<loc>``: pages, and nested maps as ``sitemap``; ``day`` from a dated path."""
    x = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    x = x.select("file", F.when(F.col("value").rlike(r"(?i)<sitemapindex"), "sitemap").otherwise("page").alias("kind"), F.explode(F.regexp_extract_all("value", F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("url"))
    x = x.withColumn("url", F.replace("url", F.lit("&amp;"), F.lit("&")))
    ymd = [F.regexp_extract("url", r"/(20\d\d)/(\d\d)/(\d\d)(?:/|$)", i) for i in (1, 2, 3)]
    return x.withColumn("day", F.try_to_date(F.concat_ws("-", *ymd), "yyyy-MM-dd")).distinct()


def page_fields(html: Column) -> dict[str, Column]:
    """Headings, open-graph title, description and the date published of a page, as expressions."""
    h1 = F.filter(F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<h1\b[^>]*>(.*?)</h1>"), F.lit(1)), lambda x: T.html_text(x)), lambda x: x != "")
    meta = lambda name: T.html_text(F.coalesce(F.nullif(F.regexp_extract(html, rf"(?is)<meta\b[^>]*?(?:property|name)\s*=\s*[\"']{name}[\"'][^>]*?content\s*=\s*[\"']([^\"']*)", 1), F.lit("")), F.regexp_extract(html, rf"(?is)<meta\b[^>]*?content\s*=\s*[\"']([^\"']*)[\"'][^>]*?(?:property|name)\s*=\s*[\"']{name}[\"']", 1)))
    return {
        "h1": h1, "og_title": meta("og:title"), "description": meta("(?:og:)?description"), "date_iso": F.substring(F.regexp_extract(html, r"\"datePublished\"\s*:\s*\"([^\"]+)\"", 1), 1, 10),
        "verdict": T.html_text(F.regexp_extract(html, r"(?is)<(?:span|div)\b[^>]*class\s*=\s*[\"'][^\"']*(?:verdict|rating|result)[^\"']*[\"'][^>]*>(.*?)</(?:span|div)>", 1)),
    }


def read_news_search(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, title, link, source, domain, pub)`` of each item of a news search's XML."""
    x = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.explode(F.regexp_extract_all("value", F.lit(r"(?is)<item\b.*?</item>"), F.lit(0))).alias("i"))
    one = lambda tag: T.html_text(T.html_text(F.regexp_replace(F.regexp_extract("i", rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1), r"^<!\[CDATA\[|\]\]>$", "")))
    site = F.regexp_extract("i", r"(?is)<source\b[^>]*url\s*=\s*[\"']([^\"']+)", 1)
    return x.select("file", one("title").alias("title"), one("link").alias("link"), one("source").alias("source"), T.domain(F.when(site != "", site).otherwise(one("link"))).alias("domain"), one("pubDate").alias("pub"))


def published(pub: Column) -> Column:
    """The instant of a mail-style date, null for what is none; without a zone it is UTC."""
    d = F.regexp_replace(pub, r"^\s*[A-Za-z]{3},\s*", "")
    d = F.regexp_replace(d, r"\s+(GMT|UT|UTC|Z)$", " +0000")
    d = F.when(d.rlike(r"[+-]\d{4}$"), d).otherwise(F.concat(d, F.lit(" +0000")))
    return F.coalesce(F.try_to_timestamp(d, F.lit("d MMM yyyy HH:mm:ss Z")), F.try_to_timestamp(d, F.lit("dd MMM yyyy HH:mm:ss Z")))


def external_claims(rows: DataFrame, text: str, labels: dict[str, str], date: str | None = None, least: int = 15) -> DataFrame:
    """``(text, label, date_iso)`` of an external corpus: texts of at least ``least`` characters whose label the map knows."""
    table = rows.sparkSession.createDataFrame(list(labels.items()), "__raw string, __mapped string")
    day = F.date_format(F.try_to_timestamp(F.col(date), F.lit("dd-MM-yyyy")), "yyyy-MM-dd") if date else F.lit(None).cast("string")
    x = rows.withColumn("__raw", F.lower(F.trim(F.col("label").cast("string")))).join(F.broadcast(table), "__raw")  # a parameter of fixed size
    return x.select(T.strip(F.col(text)).alias("text"), F.col("__mapped").alias("label"), day.alias("date_iso")).where(F.length("text") >= least)
