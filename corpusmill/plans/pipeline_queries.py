"""Queries that run the composite operators: extraction, evidence, label tiers, requests, pages, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.operators import evaluation, evidence, extraction, linkage, merging, models, near_duplicates, prompts, sampling
from corpusmill.plans import sqlparts as S
from corpusmill.session import shuffles_dropped, table, written
from corpusmill.sources import readers

QUERIES: dict = {}
SQL: dict[str, str] = {}
MAIN, PROV, LABELS = "fakenewsbr_v6_public", "fakenewsbr_v6_provenance", "fakenewsbr_v6_labels"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_RN = S.rating("factcheck_rating")


@query(f"""
WITH r AS (SELECT rid, {S.strip("coalesce(text, '')")} AS t, {_RN} AS k FROM {MAIN}), c AS (SELECT *, {S.rating_class('k')} AS c FROM r)
SELECT rid, t AS text, CASE WHEN c IN ('false_pure', 'hard') THEN 'fake' ELSE 'true' END AS label FROM c WHERE c <> 'other' AND length(t) >= 15 AND NOT {S.has('t', V.LEAK)}""")
def extracted_claims(spark, d):
    """The main table read as a review feed: claims labelled by their rating, those that give the verdict away dropped."""
    m = table(spark, d, MAIN).select("rid", F.col("text").alias("claimReviewed"), F.col("factcheck_rating").alias("rating"))
    return extraction.feed(m).select("rid", "text", "label")


@query(f"SELECT rid, {S.strip('text')} AS title FROM {MAIN} WHERE len({S.words('text')}) BETWEEN 6 AND 40 AND NOT {S.has('text', V.LEAK)} AND length({S.strip('text')}) >= 15")
def extracted_headlines(spark, d):
    m = table(spark, d, MAIN).select("rid", F.col("text").alias("title"), F.col("url_review").alias("link"))
    return extraction.headlines(m).select("rid", F.col("text").alias("title"))


@query()
def extracted_canonical_rows(spark, d):
    """Both readings through the whole path: rules, ids, metrics, provenance, one row per id."""
    m = table(spark, d, MAIN)
    feed = m.select(F.col("rid").alias("id"), F.col("text").alias("claimReviewed"), F.col("factcheck_rating").alias("rating"), F.col("url_review").alias("url"), "dataset_name", F.col("factcheck_claimant").alias("claimant"))
    news = m.select(F.col("rid").alias("id"), F.col("text").alias("title"), F.col("url_review").alias("link"), "dataset_name")
    return extraction.extract_all({"feed": ("feed", feed), "news": ("headline", news)})[0].select("rid", "text", "label", "text_clean", "word_len", F.col("_provenance.rating_norm").alias("rating_norm"), "source_key")


_LAB = f"(SELECT rid, label, auto_label, confidence, method FROM {LABELS} QUALIFY row_number() OVER (PARTITION BY rid, method ORDER BY confidence DESC NULLS LAST, auto_label) = 1)"


@query(f"""
WITH b AS (SELECT m.rid, m.label, CASE p.s WHEN 'rating' THEN 'checker' WHEN 'provenance' THEN 'provenance' WHEN 'correction' THEN 'correction' ELSE 'v1' END AS t0 FROM {MAIN} m LEFT JOIN (SELECT rid, min(label_source) AS s FROM {PROV} GROUP BY rid) p USING (rid)),
m AS (SELECT rid, auto_label AS v, confidence AS k FROM {_LAB} WHERE method = 'match' AND confidence >= 0.9 AND auto_label = label), l AS (SELECT rid, auto_label AS v, confidence AS k FROM {_LAB} WHERE method = 'llm_local' AND auto_label IN ('fake', 'true') AND confidence >= 0.8),
c AS (SELECT DISTINCT rid FROM {LABELS} WHERE method = 'vote' AND auto_label = 'true'), x AS (SELECT b.*, CASE WHEN m.rid IS NOT NULL THEN 'checker_match' ELSE t0 END AS t1, m.v AS mv, m.k AS mk, l.v AS lv, l.k AS lk, c.rid IS NOT NULL AS c FROM b LEFT JOIN m USING (rid) LEFT JOIN l USING (rid) LEFT JOIN c USING (rid)),
y AS (SELECT *, CASE WHEN lv IS NOT NULL AND t1 IN ('provenance', 'unknown') THEN 'llm_local' WHEN c AND t1 IN ('provenance', 'unknown') THEN 'corroborated' ELSE t1 END AS label_tier FROM x),
z AS (SELECT *, CASE label_tier WHEN 'llm_local' THEN lv WHEN 'corroborated' THEN 'true' ELSE mv END AS given FROM y),
u AS (SELECT *, CASE WHEN label_tier <> 'provenance' THEN CASE WHEN given IN ('fake', 'true') THEN given ELSE label END END AS train_label FROM z),
v AS (SELECT *, CASE WHEN NOT coalesce(train_label IN ('fake', 'true'), false) THEN 'unknown' WHEN label_tier IN ('v1', 'checker') THEN label ELSE coalesce(given, '') END AS auto_label FROM u)
SELECT rid, label, label_tier, auto_label, CASE WHEN label_tier = 'llm_local' THEN lk WHEN label_tier = 'corroborated' THEN NULL WHEN mv IS NOT NULL THEN mk END AS confidence,
  CASE WHEN label_tier = 'llm_local' THEN 'llm_local' WHEN label_tier = 'corroborated' THEN 'corroboracao' WHEN mv IS NOT NULL THEN 'claimreview:' ELSE '' END AS method, train_label, CASE WHEN auto_label IN ('fake', 'true') THEN auto_label ELSE 'unknown' END AS verified_label FROM v""")
def label_tiers(spark, d):
    p = table(spark, d, PROV).groupBy("rid").agg(F.min("label_source").alias("label_source"))
    base = table(spark, d, MAIN).select("rid", "label").join(p, "rid", "left")
    rows = table(spark, d, LABELS).select("rid", "label", "auto_label", "confidence", "method")
    top = linkage.latest(rows.where("confidence IS NOT NULL").select(F.struct("rid", "method").alias("k"), "label", "confidence", F.col("auto_label"), F.when(F.col("auto_label") == "fake", 1).otherwise(0).alias("o")), "k", ["confidence", "o"])
    top = top.select("k.rid", "k.method", "label", "confidence", "auto_label", F.lit(1).alias("at"))
    matches = top.where("method = 'match'").select("rid", F.col("confidence").alias("score"), (F.col("auto_label") == F.col("label")).alias("agrees"), F.col("auto_label").alias("verdict"), F.lit("").alias("publisher"), "at")
    verdicts = top.where("method = 'llm_local'").select("rid", F.col("auto_label").alias("verdict"), "confidence", "at")
    voted = rows.where("method = 'vote' AND auto_label = 'true'").select("rid", "auto_label")
    return evidence.consolidate(base, matches, verdicts, voted)


@query()
def evidence_votes(spark, d):
    """Each incoming text judged by the main table's rows that say the same (linked by shared words), as evidence items."""
    with shuffles_dropped(spark):
        return _evidence_votes(spark, d)


def _evidence_votes(spark, d):
    # Texts and titles meet by their digests; copies are linked once.
    key = lambda c: F.unhex(F.md5(c))
    t = table(spark, d, "incoming_rows").where("text_no_url IS NOT NULL")
    texts = t.select("rid", key("text_no_url").alias("tid"), T.domain(F.col("url_review")).alias("own_domain"), "date_iso")
    pub = F.date_format(F.try_to_timestamp("date_iso"), "d MMM yyyy HH:mm:ss Z")  # as news items have it
    title, domain = F.col("text_no_url"), T.domain(F.col("url_review"))
    checker, verdict = evidence.named_checker(F.concat_ws(" ", F.col("source_description"), domain, title), [("confere", "confere"), ("apura", "apura")]), T.title_verdict(title)
    # Rows that are neither a named site's nor a checker's verdict decide nothing.
    m = table(spark, d, MAIN).where("text_no_url IS NOT NULL").where(evidence.named(domain) | (checker.isNotNull() & verdict.isNotNull()))
    said, titles = (x.select("text_no_url").distinct().select(key("text_no_url").alias(k), F.col("text_no_url").alias(v)) for x, k, v in ((t, "rid", "text"), (m, "claim_id", "title")))
    link = written(evidence.linked(said, titles, 0.6), "evidence-links").withColumnsRenamed({"rid": "tid", "claim_id": "title_id"})
    # Only linked titles' rows are joined; of those that differ by id and address only, the first can decide.
    items = m.select("rid", key(title).alias("title_id"), checker.alias("checker"), verdict.alias("verdict"), domain.alias("domain"), pub.alias("pub"), F.col("url_review").alias("link")).join(link.select("title_id").distinct(), "title_id")
    items = items.groupBy("title_id", "checker", "verdict", "domain", "pub").agg(F.min("rid").alias("claim_id"), F.min_by("link", "rid").alias("link"))
    items = items.withColumn("link", F.when(F.col("checker").isNotNull() & F.col("verdict").isNotNull(), F.col("link")))
    e = texts.join(link.join(items, "title_id"), "tid")
    verdicts = e.where("checker IS NOT NULL AND verdict IS NOT NULL").select("rid", F.struct((-F.col("score")).alias("s"), "claim_id").alias("pos"), "verdict", "checker", "link", "sim")
    sites = e.where(evidence.named(F.col("domain")) & ~F.col("domain").eqNullSafe(F.col("own_domain")) & evidence.near_in_time(F.col("date_iso"), F.col("pub"))).select("rid", "domain")
    return evidence.decided(texts, verdicts, sites)


@query(f"""
WITH m AS (SELECT *, CASE WHEN contains(lower(coalesce(text_no_url, '')), 'fals') THEN ' [CHECADOR:fals]' ELSE '' END AS tag, {S.domain('url_review')} AS domain FROM {MAIN}),
v AS (SELECT rid, 'verify_headline' AS task, 'verification' AS schema, 'MANCHETE: ' || coalesce(text, '') || chr(10) || 'DATA: ' || coalesce(date_iso, '') || chr(10) || chr(10) || 'EVIDENCIAS (Google News):' || chr(10) ||
  CASE WHEN text_no_url IS NULL THEN '(nenhuma)' ELSE '[0] ' || domain || ' (' || left(coalesce(date_iso, ''), 16) || ')' || tag || ': ' || left(text_no_url, 160) END AS body, dataset_name, url_review FROM m
  UNION ALL SELECT rid, 'correction', 'correction', 'Extraia, literalmente, a frase que corrige a desinformacao neste artigo.' || chr(10) || chr(10) || '--- ARTIGO ---' || chr(10) || left(coalesce(text, ''), 12000), dataset_name, url_review FROM m)
SELECT rid, task, schema, 400 AS max_tokens, left(sha1(task || '|' || coalesce(dataset_name, '') || '|' || coalesce(url_review, '')), 24) AS custom_id, length(body) // 4 + 500 AS tokens, md5(body) AS body FROM v""")
def model_requests(spark, d):
    """Requests about each row: its headline beside one evidence item, and the correction in its text; bodies by their digest."""
    m = table(spark, d, MAIN)
    checker = F.when(F.contains(F.lower(F.coalesce("text_no_url", F.lit(""))), F.lit("fals")), "fals")
    item = F.struct(F.col("text_no_url").alias("title"), T.domain(F.col("url_review")).alias("domain"), F.col("date_iso").alias("pub"), checker.alias("checker"))
    items = F.when(F.col("text_no_url").isNotNull(), F.array(item))
    ask = lambda task, question: m.select("rid", prompts.request(task, F.col("dataset_name"), F.col("url_review"), F.col("text"), question).alias("r"))
    r = ask("verify_headline", prompts.prompt(F.col("text"), F.col("date_iso"), items)).unionByName(ask("correction", None))
    return r.select("rid", "r.task", "r.schema", "r.max_tokens", "r.custom_id", "r.tokens", F.md5("r.body").alias("body"))


@query(f"SELECT rid, CASE WHEN auto_label IN ('fake', 'true') THEN auto_label ELSE 'unknown' END AS verdict, CAST(coalesce(round_even(CASE WHEN confidence > 1 THEN confidence / 100 ELSE confidence END, 3), 0) AS DOUBLE) AS confidence FROM {LABELS}")
def parsed_answers(spark, d):
    """The label table's verdicts written as fenced JSON answers and parsed back."""
    raw = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.col("auto_label").alias("verdict"), "confidence")), F.lit("\n```"))
    return table(spark, d, LABELS).select("rid", prompts.parsed_answer(raw).alias("a")).select("rid", "a.verdict", "a.confidence")


@query()
def page_fields(spark, d):
    f = readers.page_fields(F.col("text"))
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.array_join(f["h1"], "|").alias("h1"), *[c.alias(k) for k, c in f.items() if k != "h1"])


@query()
def baseline_terms(spark, d):
    """The strongest terms of each class by the baseline model, without and with an extended stop list, fitted on four fifths of one split by label; beside them the accuracy and F1 on the last fifth."""
    rows = table(spark, d, MAIN).where("text IS NOT NULL AND label IN ('fake', 'true')").select("rid", "text", "label", F.lit("").alias("all"), (F.col("label") == "fake").cast("int").alias("y"))
    split = written(sampling.stratified_split(rows, "all", "label", "rid", val=0.0, test=0.2), "baseline-split")
    out = []
    for run, stop in (("naive", None), ("stopped", V.EVIDENCE_STOP)):
        _, terms, (accuracy, f1) = models.text_baseline(split.where("split = 'train'"), "text", stop, held_out=split.where("split = 'test'"))
        out.append(terms.select("*", F.lit(run).alias("run"), F.lit(accuracy).cast("double").alias("accuracy"), F.lit(f1).cast("double").alias("f1")))
    return out[0].unionByName(out[1])


@query()
def logistic_head(spark, d):
    """A head on embeddings: one label against the rest, split by id, chosen by macro F1."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding", (F.col("label") < 5).cast("int").alias("y")).withColumn("bias", F.lit(1.0) * (F.col("vec_id") % 3))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(10))
    _, strength, score = models.fit_head(e.where(part < 7), e.where(part >= 7), ["bias"], strengths=(0.1, 1.0), vector="embedding")
    return spark.createDataFrame([(strength, float(score))], "strength double, macro_f1 double")


@query()
def leaked_rows(spark, d):
    """How many test rows of each group have a near copy among the training rows of the same split."""
    rows = table(spark, d, MAIN).where("text IS NOT NULL AND label IN ('fake', 'true')").select("rid", "dataset_name", "label", "text")
    split = written(sampling.stratified_split(rows, "dataset_name", "label", "rid"), "leak-split")
    return models.leakage(split, "rid", "text", "dataset_name")


@query()
def head_variants(spark, d):
    """A head on style rates fitted on all rows, and one on balanced groups with equal cells."""
    m = modelling_table(spark, d).withColumn("y", F.col("target"))
    s = written(sampling.stratified_split(m, "group", "label", "rid"), "head-split")
    return models.head_variants(*(s.where(F.col("split") == k) for k in ("train", "val", "test")), ["excl_rate", "quest_rate", "ellip_rate", "upper_rate", "log_word_len"], "group")


@query()
def merged_version(spark, d):
    """The incoming rows merged into the main table; fails if the base changed or an id repeats."""
    base = table(spark, d, MAIN)
    t, _, _ = merging.merge(base, table(spark, d, "incoming_rows").drop("batch_no", "arrived_at"), table(spark, d, PROV))
    t = written(t, "merged")
    merging.check_merge(t, base)
    return t.groupBy("part", "label").agg(F.count(F.lit(1)).alias("n"))


_W = "(greatest(coalesce(word_len, 0), 0) + 1.0)"


@query(f"""
WITH l AS (SELECT rid, min(train_label) FILTER (train_label IN ('fake', 'true')) AS train_label FROM {LABELS} GROUP BY rid), p AS (SELECT rid, min(label_source) AS label_source FROM {PROV} GROUP BY rid),
x AS (SELECT m.* REPLACE (l.train_label AS label), p.label_source FROM {MAIN} m LEFT JOIN l USING (rid) LEFT JOIN p USING (rid)), k AS (SELECT *, {S.fold(S.strip("coalesce(factcheck_rating, '')"))} AS k, coalesce(dataset_name, 'nan') AS g FROM x WHERE label IN ('fake', 'true') AND NOT {S.blank('text')}),
b AS (SELECT g, (g IN {S.strings(V.BALANCED_GROUPS)} OR (regexp_matches(g, '^(FC_|EXT_|NEWS_)') AND count(*) >= 200 AND least(avg(CAST(label = 'fake' AS INT)), 1 - avg(CAST(label = 'fake' AS INT))) >= 0.15)) AS bal FROM k GROUP BY g)
SELECT rid, label, CAST(label = 'fake' AS INT) AS target, g AS "group", bal AS is_balanced_group, {S.channel('g')} AS channel, regexp_matches(coalesce(url_review, '') || ' ' || coalesce(factcheck_url, ''), {S.text(V.PTPT_3)}, 'i') AS is_ptpt,
  CASE WHEN {S.blank('factcheck_rating')} THEN 'none' WHEN k IN {S.strings(V.MODEL_HARD)} THEN 'hard' WHEN k IN {S.strings(V.MODEL_FALSE)} THEN 'false_pure' WHEN k IN {S.strings(V.MODEL_TRUE)} THEN 'true_rating' ELSE 'other' END AS rating_class,
  coalesce(label_source, '') AS label_source, round(coalesce(num_exclamations, 0) / {_W}, 9) AS excl_rate, round(coalesce(num_questions, 0) / {_W}, 9) AS quest_rate, round(coalesce(num_ellipsis, 0) / {_W}, 9) AS ellip_rate,
  round(coalesce(uppercase_word_ratio, 0.0), 9) AS upper_rate, round(ln({_W}), 9) AS log_word_len FROM k JOIN b USING (g)""")
def modelling_table(spark, d):
    m = merging.modelling_table(table(spark, d, MAIN), table(spark, d, LABELS), table(spark, d, PROV))
    rates = ("excl_rate", "quest_rate", "ellip_rate", "upper_rate", "log_word_len")
    return m.select(*[c for c in m.columns if c not in rates], *[F.round(c, 9).alias(c) for c in rates])


_MODEL = SQL["modelling_table"]


@query(f"SELECT rid, label, rating_class FROM ({_MODEL}) WHERE (rating_class = 'false_pure' AND label = 'true') OR (rating_class = 'true_rating' AND label = 'fake')")
def rating_contradictions(spark, d):
    """Rows to model whose rating says the opposite of their label."""
    return evaluation.contradictions(modelling_table(spark, d)).select("rid", "label", "rating_class")


_P = "CASE WHEN auto_label = 'fake' THEN confidence WHEN auto_label = 'true' THEN 1 - confidence ELSE 0.5 END"
_F = "coalesce(2.0 * {0} / nullif(2 * {0} + fp + fn, 0), 0.0)"
_CELLS = "count(*) AS n, sum(y) AS pos, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp, count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 0 AND p < 0.5) AS tn"
_WORST = f"SELECT '{{0}}' AS section, count(*) AS n, NULL AS acc, round(min(({_F.format('tp')} + {_F.format('tn')}) / 2), 6) AS macro_f1 FROM (SELECT \"group\", {_CELLS} FROM r WHERE {{1}} GROUP BY ALL HAVING n >= 100 AND least(pos, n - pos) >= 20)"


@query(f"""
WITH s AS (SELECT rid, min({_P}) AS p FROM {LABELS} WHERE confidence IS NOT NULL GROUP BY rid), r AS (SELECT m.*, m.target AS y, s.p FROM ({_MODEL}) m JOIN s USING (rid)),
t AS (SELECT y, p, unnest(list_filter([ 'global', CASE WHEN is_balanced_group THEN 'balanced' END, CASE rating_class WHEN 'hard' THEN 'hard' WHEN 'false_pure' THEN 'pure' END, CASE WHEN is_ptpt THEN 'ptpt' ELSE 'rest' END], lambda x: x IS NOT NULL)) AS section FROM r),
c AS (SELECT section, {_CELLS} FROM t GROUP BY section), f AS (SELECT min(n) AS few, count(*) AS two FROM c WHERE section IN ('ptpt', 'rest'))
SELECT section, n, round((tp + tn) / n, 6) AS acc, round(CASE WHEN pos > 0 AND pos < n THEN ({_F.format('tp')} + {_F.format('tn')}) / 2 END, 6) AS macro_f1 FROM c, f WHERE CASE WHEN section IN ('hard', 'pure') THEN n >= 20 WHEN section IN ('ptpt', 'rest') THEN two = 2 AND few >= 30 ELSE true END
UNION ALL {_WORST.format('worst_group', 'true')} UNION ALL {_WORST.format('worst_group_balanced', 'is_balanced_group')}""")
def nested_report(spark, d):
    """The label table's scores on the modelling table: all rows, balanced groups, hard and plain ratings, dialects, worst groups."""
    c = F.col("confidence")
    p = F.when(F.col("auto_label") == "fake", c).when(F.col("auto_label") == "true", 1 - c).otherwise(0.5)
    scores = table(spark, d, LABELS).where(c.isNotNull()).groupBy("rid").agg(F.min(p).alias("p"))
    rows = written(modelling_table(spark, d).withColumn("y", F.col("target")).join(scores, "rid"), "report-rows")
    return evaluation.report(rows, "group").select("section", "n", F.round("acc", 6).alias("acc"), F.round("macro_f1", 6).alias("macro_f1"))


_BANDS = "CASE WHEN word_len <= 10 THEN '1-10' WHEN word_len <= 20 THEN '11-20' WHEN word_len <= 40 THEN '21-40' WHEN word_len <= 80 THEN '41-80' WHEN word_len <= 200 THEN '81-200' WHEN word_len IS NOT NULL THEN '200+' ELSE 'none' END"
_DAY = "CASE WHEN regexp_matches(substr(date_iso, 1, 10), '^\\d{4}-\\d{2}-\\d{2}$') THEN try_cast(substr(date_iso, 1, 10) AS DATE) END"
_YEAR = f"CASE WHEN year({_DAY}) <= 2015 THEN 'to 2015' WHEN year({_DAY}) <= 2017 THEN '2016-2017' WHEN year({_DAY}) <= 2019 THEN '2018-2019' WHEN year({_DAY}) <= 2021 THEN '2020-2021' WHEN year({_DAY}) IS NOT NULL THEN '2022 on' ELSE 'none' END"
_CLOSED = f"CASE WHEN ({_DAY}) IS NULL THEN 'sem_data' WHEN ({_DAY}) <= DATE '2018-01-01' THEN 'ate_2017' WHEN ({_DAY}) <= DATE '2022-12-01' THEN '2018_2022' ELSE 'pos_gpt35' END"


@query(f"SELECT {_BANDS} AS length_band, {_YEAR} AS year_band, {_CLOSED} AS closed_era, count(*) AS n, count(*) FILTER (label = 'fake') AS fake FROM {MAIN} GROUP BY 1, 2, 3")
def banded_counts(spark, d):
    g = table(spark, d, MAIN).groupBy(merging.length_band(F.col("word_len")).alias("length_band"), merging.year_band(F.col("date_iso")).alias("year_band"), merging.closed_era(F.col("date_iso")).alias("closed_era"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == "fake").alias("fake"))


_S = f"""(SELECT l.rid, CAST(l.label = 'fake' AS INT) AS y, CASE WHEN l.auto_label = 'fake' THEN l.confidence WHEN l.auto_label = 'true' THEN 1 - l.confidence ELSE 0.5 END AS a, CASE WHEN regexp_matches(l.text, '[!?]') THEN 0.7 ELSE 0.3 END AS b,
  CASE WHEN contains(l.text, '?') THEN 'question' ELSE 'plain' END AS question, coalesce(l.method, '') AS method FROM {LABELS} l WHERE l.confidence IS NOT NULL AND l.label IN ('fake', 'true'))"""


@query(f"""
WITH m AS (SELECT question, method, y, 'a' AS model, a AS p FROM {_S} UNION ALL SELECT question, method, y, 'b', b FROM {_S})
SELECT question || ' | ' || method AS slice, model, count(*) AS n, round(avg(CAST((p >= 0.5) = (y = 1) AS INT)), 6) AS acc FROM m GROUP BY 1, 2 HAVING count(*) >= 30""")
def models_side_by_side(spark, d):
    """Two scores compared on the same slices."""
    c = F.col("confidence")
    a = F.when(F.col("auto_label") == "fake", c).when(F.col("auto_label") == "true", 1 - c).otherwise(0.5)
    rows = table(spark, d, LABELS).where(c.isNotNull() & F.col("label").isin("fake", "true")).select(
        "rid", (F.col("label") == "fake").cast("int").alias("y"), a.alias("a"), F.when(F.coalesce(F.col("text"), F.lit("")).rlike("[!?]"), 0.7).otherwise(0.3).alias("b"),
        F.when(F.coalesce(F.col("text"), F.lit("")).contains("?"), "question").otherwise("plain").alias("question"), F.coalesce("method", F.lit("")).alias("method"))
    return evaluation.side_by_side(rows, ["question", "method"], ["a", "b"]).select("slice", "model", "n", F.round("acc", 6).alias("acc"))


@query()
def near_duplicate_share(spark, d):
    """The share of each group's incoming rows that are near to known or earlier ones."""
    new = table(spark, d, "incoming_rows")
    got = near_duplicates.deduplicate(new, table(spark, d, MAIN).select("rid", "text_no_url"))
    return new.select("rid", "dataset_name").join(got, "rid").groupBy("dataset_name").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("reason").isNotNull().cast("int")).alias("share"))
