"""Row-level text queries over the main table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.plans import sqlparts as S
from corpusmill.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
MAIN, PROV = "fakenewsbr_v6_public", "fakenewsbr_v6_provenance"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def main(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MAIN)


@query(f"SELECT rid, {S.norm('text')} AS norm FROM {MAIN}")
def text_normalized(spark, d):
    return main(spark, d).select("rid", T.normalize_text(F.col("text")).alias("norm"))


@query(rf"SELECT rid, {S.no_url('text')} AS no_url, {S.clean(S.no_url('text'))} AS clean, array_to_string(regexp_extract_all(text, 'https?://[^\s\x0B\x{{A0}}]+'), ' ') AS urls FROM {MAIN} WHERE text IS NOT NULL")
def text_clean_forms(spark, d):
    t = main(spark, d).where("text IS NOT NULL")
    return t.select("rid", T.text_no_url(F.col("text")).alias("no_url"), T.text_clean(T.text_no_url(F.col("text"))).alias("clean"), F.array_join(T.urls(F.col("text")), " ").alias("urls"))


_W = "list_filter(string_split(regexp_replace(coalesce(text, ''), '[^\\p{L}\\p{N}_]+', ' ', 'g'), ' '), lambda x: regexp_matches(x, '^[" + V.LATIN_WORD + "]+$'))"


@query(f"""
WITH m AS (SELECT rid, coalesce(text, '') AS t, {S.clean(S.no_url('text'))} AS c, {_W} AS w FROM {MAIN})
SELECT rid, length(c) AS char_len, len({S.words('c')}) AS word_len, len(regexp_extract_all(t, '!')) AS num_exclamations, len(regexp_extract_all(t, '\\?')) AS num_questions,
  len(regexp_extract_all(t, '\\.{{3,}}|…')) AS num_ellipsis,
  round(CASE WHEN len(w) > 0 THEN len(list_filter(w, lambda x: length(x) >= 3 AND upper(x) = x AND lower(x) <> x)) / len(w) ELSE 0.0 END, 6) AS uppercase_word_ratio FROM m""")
def text_metrics(spark, d):
    m = T.style_counts(F.col("text"), T.text_clean(T.text_no_url(F.col("text"))))
    return main(spark, d).select("rid", *[F.round(c, 6).alias(k) if k == "uppercase_word_ratio" else c.cast("bigint").alias(k) for k, c in m.items()])


@query(f"""
WITH k AS (SELECT rid, factcheck_rating AS raw, {S.rating('factcheck_rating')} AS rating_norm, {S.fold(S.strip("coalesce(factcheck_rating, '')"))} AS m FROM {MAIN}),
c AS (SELECT *, {S.rating_class('rating_norm')} AS rating_class FROM k)
SELECT rid, rating_norm, rating_class, CASE WHEN rating_class IN ('false_pure', 'hard') THEN 'fake' WHEN rating_class = 'true_rating' THEN 'true' END AS rating_label,
  CASE WHEN {S.blank('raw')} THEN 'none' WHEN m IN {S.strings(V.MODEL_HARD)} THEN 'hard' WHEN m IN {S.strings(V.MODEL_FALSE)} THEN 'false_pure' WHEN m IN {S.strings(V.MODEL_TRUE)} THEN 'true_rating' ELSE 'other' END AS model_class FROM c""")
def rating_classes(spark, d):
    r = F.col("factcheck_rating")
    out = main(spark, d).select("rid", T.normalize_rating(r).alias("rating_norm"), T.rating_class(r).alias("rating_class"), T.model_rating_class(r).alias("model_class"))
    return out.withColumn("rating_label", T.label_of_class(F.col("rating_class")))


@query(f"SELECT rid, array_to_string(list_sort({S.tokens('text', V.MATCH_STOP)}), ' ') AS tokens, array_to_string(list_sort({S.tokens('text', V.EVIDENCE_STOP)}), ' ') AS evidence_tokens FROM {MAIN}")
def text_tokens(spark, d):
    t = F.col("text")
    return main(spark, d).select("rid", F.array_join(F.array_sort(T.content_tokens(t, V.MATCH_STOP)), " ").alias("tokens"), F.array_join(F.array_sort(T.content_tokens(t, V.EVIDENCE_STOP)), " ").alias("evidence_tokens"))


_ORD = " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.ORDINALS.items())


@query(f"""
WITH n AS (SELECT rid, {S.norm('text')} AS t FROM {MAIN})
SELECT rid, array_to_string(list_sort(list_distinct(list_concat(list_transform(list_filter(string_split(t, ' '), lambda x: regexp_matches(x, '^\\d+$')), lambda x: try_cast(x AS BIGINT)),
  list_transform(list_filter(string_split(t, ' '), lambda w: w IN {S.strings(list(V.ORDINALS))}), lambda w: CAST(CASE w {_ORD} END AS BIGINT))))), ' ') AS numbers FROM n""")
def text_numbers(spark, d):
    return main(spark, d).select("rid", F.array_join(F.transform(T.numbers(F.col("text")), lambda x: x.cast("string")), " ").alias("numbers"))


@query(f"""
WITH n AS (SELECT rid, text, {S.norm('text')} AS k, {S.strip("coalesce(text, '')")} AS t FROM {MAIN})
SELECT rid, CASE WHEN regexp_matches(k, {S.text(V.TITLE_FALSE)}) THEN 'fake' WHEN regexp_matches(k, {S.text(V.TITLE_TRUE)}) THEN 'true' END AS title_verdict,
  {S.has('text', V.LEAK)} AS leaks, CAST({S.has('text', V.AI)} AS INT) AS ai,
  (len({S.words('t')}) BETWEEN 5 AND 40 AND NOT suffix(t, '?') AND NOT {S.has('t', V.OPINION)} AND {S.has('t', V.CLAIM_VERB)}) AS claim_like FROM n""")
def text_flags(spark, d):
    t = F.col("text")
    return main(spark, d).select("rid", T.title_verdict(t).alias("title_verdict"), T.leaks_verdict(t).alias("leaks"), T.mentions_ai(t).alias("ai"), T.claim_like(t).alias("claim_like"))


@query(rf"""
WITH c AS (SELECT rid, {S.collapsed("coalesce(text, '')")} AS s FROM {MAIN}), m AS (SELECT rid, s, regexp_extract(s, '^(.{{20,320}}?[.!?])(?:\s|$)', 1) AS m FROM c)
SELECT rid, trim(CASE WHEN m <> '' THEN m ELSE left(s, 320) END, ' .') AS sentence, right(s, 250) AS tail FROM m""")
def text_excerpts(spark, d):
    t = F.col("text")
    return main(spark, d).select("rid", T.first_sentence(t).alias("sentence"), F.right(T.collapsed(F.coalesce(t, F.lit(""))), F.lit(250)).alias("tail"))


@query(rf"""
SELECT rid, CASE WHEN regexp_extract(lower(coalesce(url_review, '')), '^https?://(?:www\.)?([^/?#\s]+)', 1) = '' THEN 'sem_url' ELSE regexp_extract(lower(url_review), '^https?://(?:www\.)?([^/?#\s]+)', 1) END AS domain,
  regexp_matches(coalesce(url_review, '') || ' ' || coalesce(factcheck_url, ''), {S.text(V.PTPT_3)}, 'i') AS ptpt_3, regexp_matches(coalesce(url_review, ''), {S.text(V.PTPT_6)}, 'i') AS ptpt_6 FROM {MAIN}""")
def url_facts(spark, d):
    both = F.concat_ws(" ", F.coalesce("url_review", F.lit("")), F.coalesce("factcheck_url", F.lit("")))
    return main(spark, d).select("rid", T.domain(F.col("url_review")).alias("domain"), both.rlike(f"(?i){V.PTPT_3}").alias("ptpt_3"), F.coalesce("url_review", F.lit("")).rlike(f"(?i){V.PTPT_6}").alias("ptpt_6"))


def _mask_sql(x: str) -> str:
    for pattern, tag in V.MASKS:
        body = pattern.removeprefix(r"\b").removesuffix(r"\b")
        for _ in range(2):  # neighbours share a boundary
            x = f"regexp_replace({x}, {S.text('(^|[^\\p{L}\\p{M}\\p{N}_])' + body + '($|[^\\p{L}\\p{M}\\p{N}_])')}, '\\1{tag}\\3', 'gi')"
    return S.collapsed(x)


@query(f"SELECT rid, {_mask_sql("coalesce(text, '')")} AS masked FROM {MAIN}")
def entity_masks(spark, d):
    return main(spark, d).select("rid", T.masked_entities(F.col("text")).alias("masked"))


def _pii_sql() -> str:
    ctes, prev = [f"p0 AS (SELECT rid, text AS t0 FROM {MAIN})"], "rid, t0"
    for k, (kind, pattern, tag) in enumerate(V.PII):
        p = pattern.replace(r"\w", r"\w")
        ctes.append(f"p{k + 1} AS (SELECT *, coalesce(len(regexp_extract_all(t{k}, {S.text(p)})), 0) AS {kind}, regexp_replace(t{k}, {S.text(p)}, '{tag}', 'g') AS t{k + 1} FROM p{k})")
    return f"WITH {', '.join(ctes)} SELECT rid, t{len(V.PII)} AS masked, {', '.join(k for k, *_ in V.PII)} FROM p{len(V.PII)}"


@query(_pii_sql())
def regular_pii_masks(spark, d):
    """E-mail, CPF and telephone by their fixed patterns, with counters."""
    masked, counts = T.masked_pii(F.col("text"))
    return main(spark, d).select("rid", masked.alias("masked"), *[c.cast("bigint").alias(k) for k, c in counts.items()])


@query(f"SELECT rid, CAST(concat('0x', left(sha1(concat_ws('|', coalesce(url_review, ''), 'claim', CAST(rid AS VARCHAR))), 15)) AS BIGINT) AS made FROM {MAIN}")
def stable_ids(spark, d):
    return main(spark, d).select("rid", T.stable_id(F.col("url_review"), F.lit("claim"), F.col("rid")).alias("made"))


@query(f"SELECT rid, {S.era('date_iso')} AS era, {S.channel('dataset_name')} AS channel, CAST(label = 'fake' AS INT) AS target, CASE WHEN dataset_name IN ('Fake.br', 'Fake.br_raw') AND source_type = 'tweets' THEN 'news' ELSE source_type END AS source_type FROM {MAIN}")
def derived_columns(spark, d):
    kind = F.when(F.col("dataset_name").isin("Fake.br", "Fake.br_raw") & (F.col("source_type") == "tweets"), "news").otherwise(F.col("source_type"))
    return main(spark, d).select("rid", T.era(F.col("date_iso")).alias("era"), T.channel(F.col("dataset_name")).alias("channel"), (F.col("label") == "fake").cast("int").alias("target"), kind.alias("source_type"))


@query(f"""
SELECT rid, round(coalesce(num_exclamations, 0) / (greatest(coalesce(word_len, 0), 0) + 1.0), 9) AS excl_rate, round(coalesce(num_questions, 0) / (greatest(coalesce(word_len, 0), 0) + 1.0), 9) AS quest_rate,
  round(coalesce(num_ellipsis, 0) / (greatest(coalesce(word_len, 0), 0) + 1.0), 9) AS ellip_rate, round(coalesce(uppercase_word_ratio, 0.0), 9) AS upper_rate, round(ln(1 + greatest(coalesce(word_len, 0), 0)), 9) AS log_word_len FROM {MAIN}""")
def style_rates(spark, d):
    w = F.greatest(F.coalesce("word_len", F.lit(0)), F.lit(0))
    rate = lambda c: F.round(F.coalesce(c, F.lit(0)) / (w + 1.0), 9)
    return main(spark, d).select("rid", rate("num_exclamations").alias("excl_rate"), rate("num_questions").alias("quest_rate"), rate("num_ellipsis").alias("ellip_rate"), F.round(F.coalesce("uppercase_word_ratio", F.lit(0.0)), 9).alias("upper_rate"), F.round(F.log1p(w), 9).alias("log_word_len"))


_NG = "list_distinct(list_transform(range(1, greatest(len(w) - 2, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 2), ' ')))"
_NC = "list_distinct(list_transform(range(1, greatest(length(f) - 4, 1) + 1), lambda i: substr(f, i, 5)))"


@query(f"""
WITH n AS (SELECT rid, {S.norm('text_no_url')} AS k FROM {MAIN}), w AS (SELECT rid, k, string_split(k, ' ') AS w, replace(k, ' ', '') AS f FROM n)
SELECT rid, CASE WHEN k = '' THEN 0 WHEN len(w) >= 20 THEN len({_NG}) ELSE len({_NC}) END AS shingles, CASE WHEN k = '' THEN NULL WHEN len(w) >= 20 THEN list_min({_NG}) ELSE list_min({_NC}) END AS smallest FROM w""")
def shingle_sets(spark, d):
    s = main(spark, d).select("rid", T.shingles(F.col("text_no_url")).alias("s"))
    return s.select("rid", F.size("s").cast("bigint").alias("shingles"), F.array_min("s").alias("smallest"))


@query(f"""
SELECT rid, CASE WHEN regexp_matches(content, '[<]') THEN 1 ELSE 0 END AS marked, {S.collapsed("replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(content, '(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&#39;', chr(39)), '&apos;', chr(39)), '&amp;', '&')")} AS plain
FROM (SELECT doc_id AS rid, coalesce(text, '') AS content FROM documents)""")
def html_plain_text(spark, d):
    """Documents hold mark-up: the text between it."""
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select(F.col("doc_id").alias("rid"), t.contains("<").cast("int").alias("marked"), T.html_text(t).alias("plain"))
