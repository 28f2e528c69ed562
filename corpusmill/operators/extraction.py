"""From raw source records to canonical rows: one ``select`` per kind of source, united and de-duplicated by id.

Raw rows have the columns they have; absent ones count as null. Every rule gives ``(text, label, text_role, rating, dataset_name,
source_type)``, and ``canonical_rows`` adds id, metrics and provenance. Rows without label, with a text under 15 characters
or (where a checker wrote it) with a verdict in the text are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V

LEAST = 15


def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _out(df: DataFrame, text: Column, label: Column, role: str, rating: Column, dataset: str | None = None, kind: str | None = None, leaky: bool = True) -> DataFrame:
    x = df.withColumns({"__text": T.strip(F.coalesce(text, F.lit(""))), "label": label, "text_role": F.lit(role), "rating": F.coalesce(rating, F.lit("")), "dataset_name": F.lit(dataset) if dataset else F.coalesce(_col(df, "dataset_name"), F.lit("FC_UNKNOWN")), "source_type": F.lit(kind) if kind else F.coalesce(_col(df, "source_type"), F.lit("news"))})
    x = x.where(F.col("label").isNotNull() & (F.length("__text") >= LEAST))
    return (x.where(~T.leaks_verdict(F.col("__text"))) if leaky else x).withColumn("text", F.col("__text")).drop("__text")


def feed(df: DataFrame) -> DataFrame:
    """Claims of a review feed, labelled by their rating."""
    return _out(df, F.col("claimReviewed"), T.label_of_class(T.rating_class(F.col("rating"))), "claim", F.col("rating"), kind="news")


def marked_claims(df: DataFrame, mark: str = "Boato", dataset: str = "FC_BOATOS") -> DataFrame:
    """The claim after a mark and a dash, and as a second row the first quoted block: none, one or two rows per record."""
    after = F.regexp_extract(F.coalesce(_col(df, "content"), F.lit("")), rf"(?is){mark}\s*[–\-—:]\s*(.+)", 1)
    claim = F.coalesce(F.nullif(T.first_sentence(after), F.lit("")), T.first_sentence(_col(df, "title")))
    quoted = T.html_text(F.regexp_extract(F.coalesce(_col(df, "content_html"), F.lit("")), r"(?is)<blockquote[^>]*>(.*?)</blockquote>", 1))
    quoted = F.regexp_replace(quoted, r"(?iu)^\s*vers[ãa]o\s*\d+\s*[:\-–]\s*", "")
    fake, rating = F.lit("fake"), F.lit("Falso")
    return _out(df, claim, fake, "claim", rating, dataset, "news").unionByName(_out(df, quoted, fake, "viral", rating, dataset + "_VIRAL", "social media post", leaky=False))


def _first_verdict(names: Column, order: list[tuple[str, str, str | None]]) -> tuple[Column, Column]:
    """Label and rating of the first listed verdict that any name contains; a verdict without label stops the search."""
    names = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: T.collapsed(T.folded_lower(n)))
    label, rating = F.lit(None).cast("string"), F.lit(None).cast("string")
    for key, shown, value in reversed(order):
        hit = F.array_join(names, "\n").contains(key)
        label, rating = F.when(hit, F.lit(value)).otherwise(label), F.when(hit, shown).otherwise(rating)
    return label, rating


def category_verdicts(df: DataFrame, dataset: str = "FC_EFARSAS") -> DataFrame:
    """The verdict among a post's categories; a title's opening question words are removed as whole words."""
    label, rating = _first_verdict(_col(df, "categories", "array<string>"), [("falso", "Falso", "fake"), ("fora de contexto", "Fora de Contexto", "fake"), ("impreciso", "Impreciso", "fake"), ("indeterminado", "Indeterminado", None), ("verdadeiro", "Verdadeiro", "true")])
    claim = F.btrim(F.regexp_replace(F.coalesce(_col(df, "title"), F.lit("")), r"(?iu)^(?:(?:é|e) verdade que|ser[áa](?: que)?|é|e)\s+", ""), F.lit(" ?!."))
    return _out(df, claim, label, "claim", rating, dataset)


def tag_verdicts(df: DataFrame, gate: str = "checamos", dataset: str = "FC_BEREIA") -> DataFrame:
    """The verdict among a post's tags, for posts of a category."""
    cats = F.transform(F.coalesce(_col(df, "categories", "array<string>"), F.array().cast("array<string>")), lambda n: T.folded_lower(n))
    label, rating = _first_verdict(_col(df, "tags", "array<string>"), [("enganoso", "Enganoso", "fake"), ("falso", "Falso", "fake"), ("impreciso", "Impreciso", "fake"), ("verdadeiro", "Verdadeiro", "true")])
    return _out(df.where(F.exists(cats, lambda n: F.contains(n, F.lit(gate)))), F.btrim(F.coalesce(_col(df, "title"), F.lit("")), F.lit(" ?!.")), label, "claim", rating, dataset)


def heading_verdicts(df: DataFrame, dataset: str = "FC_G1") -> DataFrame:
    """Headings that open with #FAKE or #FATO; headings on several claims are skipped."""
    h = F.coalesce(_col(df, "h1"), F.lit(""))
    many = h.rlike("(?iu)veja o que|o que é fato|o que e fato|#fato e #fake|fato ou fake|confira")
    fake, fact = h.rlike("(?i)#?fake"), h.rlike("(?i)#?fato")
    claim = F.btrim(F.regexp_replace(h, r"(?iu)^[ée]\s*#?(fake|fato)\s*(que\s*)?", ""), F.lit(" ?!.-"))
    return _out(df.where(~many), claim, F.when(fake, "fake").when(fact, "true"), "claim", F.when(fake, "FAKE").when(fact, "FATO"), dataset, "news")


def span_verdicts(df: DataFrame, site: str = "Pol[íi]grafo", dataset: str = "FC_POLIGRAFO") -> DataFrame:
    """Pages with a verdict of their own, else the title's; the site's name is cut from the title."""
    title = F.coalesce(F.nullif(_col(df, "og_title"), F.lit("")), _col(df, "h1"), F.lit(""))
    verdict = F.coalesce(F.nullif(_col(df, "verdict"), F.lit("")), _col(df, "og_title"))
    claim = F.btrim(F.regexp_replace(title, rf"(?iu)\s*[-|]\s*{site}\s*$", ""), F.lit(" ?!."))
    return _out(df, claim, T.label_of_class(T.rating_class(verdict)), "claim", _col(df, "verdict"), dataset, "news")


def headlines(df: DataFrame) -> DataFrame:
    """Headlines of 6 to 40 words without a verdict, true by provenance."""
    t = T.strip(F.coalesce(_col(df, "title"), F.lit("")))
    return _out(df.where(F.size(T.words(t)).between(6, 40)), t, F.lit("true"), "headline", F.lit(""), kind="news headline")


RULES = {"feed": feed, "marked": marked_claims, "category": category_verdicts, "tag": tag_verdicts, "heading": heading_verdicts, "span": span_verdicts, "headline": headlines}


def canonical_rows(x: DataFrame) -> DataFrame:
    """Main columns plus a ``_provenance`` struct of what a rule gave."""
    url = F.coalesce(F.nullif(_col(x, "link"), F.lit("")), F.nullif(_col(x, "url"), F.lit("")), F.lit(""))
    publisher = F.coalesce(F.nullif(_col(x, "publisher"), F.lit("")), _col(x, "source"), F.lit(""))
    ident = F.coalesce(_col(x, "id", "bigint").cast("string"), url)
    no_url = T.text_no_url(F.col("text"))
    clean = T.text_clean(no_url)
    rating = F.coalesce(F.nullif(F.col("rating"), F.lit("")), F.lit(""))
    prov = F.struct(
        F.coalesce(_col(x, "label_source"), F.lit("rating")).alias("label_source"), "text_role", publisher.alias("publisher"), F.coalesce(_col(x, "lang_variant"), F.lit("pt-BR")).alias("lang_variant"),
        F.coalesce(_col(x, "collector"), F.lit("")).alias("collector"), url.alias("source_url"), _col(x, "collected_at").alias("collected_at"), T.normalize_rating(rating).alias("rating_norm"), T.mentions_ai(F.col("text")).alias("mentions_ai"),
    )
    made = {
        "rid": T.stable_id(url, F.col("text_role"), ident), "source_description": publisher, "date_iso": F.nullif(_col(x, "date_iso"), F.lit("")), "url_review": url, "text_clean": clean, "text_no_url": no_url,
        "extracted_urls": T.urls(F.col("text")), "is_duplicated": F.lit(0), "is_null": F.lit(0), "too_short": F.lit(0), "factcheck_rating": rating, "factcheck_claimant": F.coalesce(_col(x, "claimant"), F.lit("")), "factcheck_url": url,
    } | T.style_counts(F.col("text"), clean)
    return x.select(*[(made[c] if c in made else F.col(c)).alias(c) for c in V.COLUMNS], prov.alias("_provenance"))


def extract_all(sources: dict[str, tuple[str, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """``(rows, stats)`` of sources by key, each with the name of its rule: one row per id, and rows read and kept of each source."""
    parts, stats = None, None
    for key, (rule, df) in sources.items():
        got = canonical_rows(RULES[rule](df)).withColumn("source_key", F.lit(key))
        n = df.agg(F.count(F.lit(1)).alias("raw")).withColumn("source_key", F.lit(key))
        parts, stats = (got, n) if parts is None else (parts.unionByName(got), stats.unionByName(n))
    rest = [c for c in parts.columns if c != "rid"]
    rows = parts.groupBy("rid").agg(F.min_by(F.struct(*rest), F.struct("source_key", "text")).alias("r")).select("rid", "r.*")
    kept = rows.groupBy("source_key").agg(F.count(F.lit(1)).alias("kept"))
    return rows.select(*V.COLUMNS, "_provenance", "source_key"), stats.join(kept, "source_key", "left").na.fill(0, ["kept"])


def corrections(answers: DataFrame, articles: DataFrame, noise: str = r"(?iu)\b(leia mais|saiba mais|clique|assine)\b") -> DataFrame:
    """Accepted correction sentences joined to their articles, as ``true`` claims: ``(key, text, label, link)``.

    A sentence of 40 to 600 characters, no question, without noise phrases, nine tenths of whose words stand in the article.
    """
    a = answers.join(articles, "key").withColumn("t", T.strip(F.col("answer")))
    said, there = T.content_tokens(F.col("t"), V.MATCH_STOP), T.content_tokens(F.col("content"), V.MATCH_STOP)
    share = F.coalesce(F.try_divide(F.size(F.array_intersect(said, there)), F.size(said)), F.lit(0.0))
    ok = F.length("t").between(40, 600) & ~F.endswith("t", F.lit("?")) & ~F.col("t").rlike(noise) & (share >= 0.9)
    return a.where(ok).select("key", F.col("t").alias("text"), F.lit("true").alias("label"), "link")
