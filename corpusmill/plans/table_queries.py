"""Queries over whole tables: aggregates, windows, samples, joins, checks, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import measures as M
from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.operators import cleaning, evaluation, linkage, near_duplicates, nearest, ordering, sampling
from corpusmill.plans import sqlparts as S
from corpusmill.session import table

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


def main(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, MAIN)


def r6(c, name: str):
    return F.round(c, 6).alias(name)


# ------------------------------------------------------------- aggregates


@query(f"SELECT dataset_name, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM {MAIN} GROUP BY dataset_name ORDER BY n DESC, dataset_name LIMIT 20")
def top_datasets(spark, d):
    return ordering.value_counts(main(spark, d), "dataset_name", 20).select("dataset_name", "n", r6(F.col("share"), "share"))


_ERAS = ["ate_2017", "2018_2022", "pos_gpt35", "sem_data"]


@query(f"SELECT label, {', '.join(f'''count(*) FILTER (e = '{e}') AS \"n_{e}\"''' for e in _ERAS)} FROM (SELECT label, {S.era('date_iso')} AS e FROM {MAIN}) GROUP BY label")
def crosstab_label_era(spark, d):
    return ordering.crosstab(main(spark, d).select("label", T.era(F.col("date_iso")).alias("era")), "label", "era", _ERAS)


@query(f"SELECT coalesce(dataset_name, 'All') AS dataset_name, count(*) FILTER (label = 'fake') AS n_fake, count(*) FILTER (label = 'true') AS n_true, count(*) AS \"n_All\" FROM {MAIN} GROUP BY GROUPING SETS ((dataset_name), ())")
def crosstab_with_margins(spark, d):
    return ordering.crosstab(main(spark, d), "dataset_name", "label", ["fake", "true"], margins=True)


@query(f"""
SELECT count(*) AS n, count(*) FILTER (label = 'fake') AS fake, count(*) FILTER (label = 'true') AS "true", count(*) FILTER (coalesce(starts_with(dataset_name, 'NEWS_'), false)) AS provenance,
  count(*) FILTER (NOT coalesce(starts_with(dataset_name, 'NEWS_'), false)) AS verdict, count(*) FILTER (regexp_matches(coalesce(url_review, ''), {S.text(V.PTPT_6)}, 'i')) AS ptpt,
  CAST(round_even(100.0 * count(*) FILTER (regexp_matches(coalesce(url_review, ''), {S.text(V.PTPT_6)}, 'i')) / count(*), 2) AS DOUBLE) AS ptpt_percent FROM {MAIN}""")
def table_composition(spark, d):
    return cleaning.composition(main(spark, d))


@query(f"SELECT CAST(round_even(confidence, 1) AS DOUBLE) AS score, count(*) AS n FROM {LABELS} GROUP BY 1")
def confidence_histogram(spark, d):
    return table(spark, d, LABELS).groupBy(F.bround("confidence", 1).alias("score")).agg(F.count(F.lit(1)).alias("n"))


_GROUPS = f"""SELECT dataset_name, count(*) AS n, avg(CAST(label = 'fake' AS INT)) AS mean FROM {MAIN} GROUP BY dataset_name"""


@query(f"""
SELECT dataset_name, n, round(mean, 6) AS mean, round(least(mean, 1 - mean), 6) AS minority,
  (dataset_name IN {S.strings(V.BALANCED_GROUPS)} OR (regexp_matches(dataset_name, '^(FC_|EXT_|NEWS_)') AND n >= 200 AND least(mean, 1 - mean) >= 0.15)) AS balanced FROM ({_GROUPS})""")
def balanced_groups(spark, d):
    g = sampling.balanced_groups(main(spark, d).withColumn("target", (F.col("label") == "fake").cast("int")), "dataset_name", "target", V.BALANCED_GROUPS)
    return g.select("dataset_name", "n", r6(F.col("mean"), "mean"), r6(F.col("minority"), "minority"), "balanced")


@query(f"SELECT rid, round((SELECT count(*) FROM {MAIN}) / ((SELECT count(*) FROM (SELECT DISTINCT dataset_name, label FROM {MAIN})) * count(*) OVER (PARTITION BY dataset_name, label)), 6) AS weight FROM {MAIN}")
def cell_weights(spark, d):
    return sampling.cell_weights(main(spark, d).select("rid", "dataset_name", "label"), "dataset_name", "label").select("rid", r6(F.col("weight"), "weight"))


@query(f"SELECT quantile_cont(n, 0.5) AS median_cell, max(n) AS largest_cell, count(*) AS cells FROM (SELECT count(*) AS n FROM {MAIN} GROUP BY dataset_name, label)")
def cell_sizes(spark, d):
    n = main(spark, d).groupBy("dataset_name", "label").agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.expr("percentile(n, 0.5)").alias("median_cell"), F.max("n").alias("largest_cell"), F.count(F.lit(1)).alias("cells"))


@query(f"SELECT count(*) AS n, bit_xor(CAST(concat('0x', left(sha256(concat_ws(chr(9), CAST(rid AS VARCHAR), {S.norm('text_no_url')})), 15)) AS BIGINT)) AS digest FROM {MAIN}")
def content_digest(spark, d):
    return cleaning.content_digest(main(spark, d), "rid", "text_no_url")


@query(f"SELECT publisher, count(*) AS n, count(DISTINCT rid) AS rids, sum(mentions_ai) AS ai FROM {PROV} GROUP BY publisher")
def publisher_counts(spark, d):
    return table(spark, d, PROV).groupBy("publisher").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("rid").alias("rids"), F.sum("mentions_ai").alias("ai"))


@query(f"""
SELECT tok, count(*) AS df, round(ln((1 + (SELECT count(*) FROM {MAIN})) / (1 + count(*))) + 1, 6) AS idf FROM (SELECT rid, unnest({S.tokens('text', V.MATCH_STOP)}) AS tok FROM {MAIN}) GROUP BY tok HAVING count(*) >= 2""")
def document_frequency(spark, d):
    """Smoothed inverse document frequency of every token that at least two rows have."""
    m = main(spark, d)
    df = m.select(F.explode(T.content_tokens(F.col("text"), V.MATCH_STOP)).alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df >= 2")
    n = m.agg(F.count(F.lit(1)).alias("n"))
    return df.join(F.broadcast(n)).select("tok", "df", r6(F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1, "idf"))


# ------------------------------------------------------------- cleaning

_CONFLICTS = f"SELECT text_clean, list_sort(list(label)) AS labels, list_sort(list(dataset_name)) AS subsets, count(rid) AS row_count FROM {MAIN} WHERE text_clean IS NOT NULL GROUP BY text_clean HAVING count(DISTINCT label) > 1"


@query(f"SELECT m.rid, m.label, array_to_string(c.labels, ',') AS labels, array_to_string(c.subsets, ',') AS subsets, c.row_count FROM {MAIN} m JOIN ({_CONFLICTS}) c USING (text_clean)")
def label_conflicts(spark, d):
    """Each row of a text that carries several labels, with the labels and groups of all the text's rows."""
    c = cleaning.conflict_audit(main(spark, d))
    listed = lambda x: F.array_join(F.flatten(F.transform(x, lambda v: F.array_repeat(v["value"], v["n"].cast("int")))), ",")
    return c.select("rid", "label", listed(F.col("labels_involved")).alias("labels"), listed(F.col("subsets_involved")).alias("subsets"), "row_count")


def _has(c: str, n: int) -> str:
    return f"CASE WHEN {S.blank(c)} THEN 0 ELSE {n} END"


_RICH = f"{_has('url_review', 4)} + {_has('factcheck_rating', 3)} + {_has('factcheck_claimant', 2)} + {_has('date_iso', 2)} + CASE WHEN coalesce(suffix(dataset_name, '_raw'), false) THEN 0 ELSE 1 END"


@query(f"SELECT rid, {_RICH} AS richness FROM {MAIN}")
def richness_scores(spark, d):
    m = main(spark, d)
    return m.select("rid", cleaning.richness(m).alias("richness"))


@query(f"""
WITH kept AS (SELECT *, {_RICH} AS score FROM {MAIN} WHERE text_clean IS NULL OR text_clean NOT IN (SELECT text_clean FROM ({_CONFLICTS})))
SELECT rid, dataset_name, CASE WHEN dataset_name IN ('Fake.br', 'Fake.br_raw') AND source_type = 'tweets' THEN 'news' ELSE source_type END AS source_type, length(coalesce(text_clean, '')) AS char_len, len({S.words('text_clean')}) AS word_len
FROM kept QUALIFY row_number() OVER (PARTITION BY text_clean ORDER BY score DESC, rid) = 1""")
def sanitized(spark, d):
    return cleaning.sanitize(main(spark, d)).select("rid", "dataset_name", "source_type", "char_len", "word_len")


@query(f"""
WITH one AS (SELECT count(*) FILTER (coalesce(is_duplicated, -1) <> 0) AS is_duplicated, count(*) FILTER (coalesce(is_null, -1) <> 0) AS is_null, count(*) FILTER (coalesce(too_short, -1) <> 0) AS too_short,
  count(*) FILTER ({S.blank('text')}) AS blank_text, count(*) FILTER (coalesce(word_len, 0) < 3) AS word_len, count(*) FILTER (NOT coalesce(label IN ('fake', 'true'), false)) AS label,
  count(*) FILTER (coalesce(starts_with(dataset_name, 'NEWS_') AND label = 'true', false) AND {S.has('text', V.LEAK)}) AS leak FROM {MAIN})
SELECT rule, violations FROM (UNPIVOT one ON COLUMNS(*) INTO NAME rule VALUE violations)
UNION ALL SELECT 'repeated_rid', count(*) - count(DISTINCT rid) FROM {MAIN}
UNION ALL SELECT 'repeated_text', count(*) - count(DISTINCT {S.norm('text_no_url')}) FROM {MAIN}""")
def judged(spark, d):
    return cleaning.judge(main(spark, d))


_VERSION = f"(SELECT *, 'base' AS part FROM {MAIN} UNION ALL BY NAME SELECT * EXCLUDE (batch_no, arrived_at), 'new' FROM incoming_rows)"
_NEW = "incoming_rows"


@query(f"""
WITH one AS (SELECT count(*) FILTER (coalesce(is_duplicated, -1) <> 0) AS is_duplicated, count(*) FILTER (coalesce(is_null, -1) <> 0) AS is_null, count(*) FILTER (coalesce(too_short, -1) <> 0) AS too_short,
  count(*) FILTER ({S.blank('text')}) AS blank_text, count(*) FILTER (coalesce(word_len, 0) < 3) AS word_len, count(*) FILTER (NOT coalesce(label IN ('fake', 'true'), false)) AS label,
  count(*) FILTER (coalesce(starts_with(dataset_name, 'NEWS_') AND label = 'true', false) AND {S.has('text', V.LEAK)}) AS leak FROM {_NEW})
SELECT rule, violations FROM (UNPIVOT one ON COLUMNS(*) INTO NAME rule VALUE violations)
UNION ALL SELECT 'repeated_rid', count(*) - count(DISTINCT rid) FROM {_NEW} UNION ALL SELECT 'repeated_text', count(*) - count(DISTINCT {S.norm('text_no_url')}) FROM {_NEW}
UNION ALL SELECT 'base_changed', 0 UNION ALL SELECT 'column_order', 0 UNION ALL SELECT 'id_collision', count(*) FROM {_NEW} WHERE rid IN (SELECT rid FROM {MAIN})""")
def judged_version(spark, d):
    """The incoming rows as a new version's part, judged together with the base."""
    new = table(spark, d, "incoming_rows").select(V.COLUMNS).withColumn("part", F.lit("new"))
    base = main(spark, d)
    return cleaning.judge_version(base.select(V.COLUMNS).withColumn("part", F.lit("base")).unionByName(new), base, V.COLUMNS)


def _section(name: str, key: str) -> str:
    return f"SELECT '{name}' AS section, {key} AS key, count(*) AS n FROM {MAIN} GROUP BY ALL"


@query(" UNION ALL ".join([
    _section("label", "coalesce(label, 'nan')"), _section("era", S.era("date_iso")), _section("label_by_era", f"coalesce(label, 'nan') || ' | ' || {S.era('date_iso')}"), _section("source_type", "coalesce(source_type, 'nan')"),
    _section("ptpt", f"CAST(regexp_matches(coalesce(url_review, ''), {S.text(V.PTPT_6)}, 'i') AS VARCHAR)"), _section("mentions_ai", f"CAST({S.has('text', V.AI)} AS VARCHAR)"),
    f"(SELECT 'dataset' AS section, coalesce(dataset_name, 'nan') AS key, count(*) AS n FROM {MAIN} GROUP BY ALL ORDER BY n DESC, key LIMIT 20)",
]))
def audit_report(spark, d):
    return cleaning.audit(main(spark, d))


# ------------------------------------------------------------- windows and sets


@query(f"SELECT rid, collected_at, publisher FROM {PROV} WHERE collected_at IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rid ORDER BY collected_at DESC, publisher DESC, source_url DESC) = 1")
def latest_provenance(spark, d):
    """What an append-only log says now: the last row of each id."""
    p = table(spark, d, PROV).where("collected_at IS NOT NULL").select("rid", "collected_at", "publisher", "source_url")
    return linkage.latest(p, "rid", ["collected_at", "publisher", "source_url"]).select("rid", "collected_at", "publisher")


@query(f"SELECT rid, dataset_name, row_number() OVER (PARTITION BY dataset_name ORDER BY word_len DESC, rid) AS place, word_len FROM {MAIN} QUALIFY place <= 5")
def longest_per_dataset(spark, d):
    t = ordering.top_per_key(main(spark, d).select("rid", "dataset_name", "word_len"), ["dataset_name"], [F.desc("word_len"), F.asc("rid")], 5)
    return t.select("rid", "dataset_name", F.col("rank").cast("bigint").alias("place"), "word_len")


@query(f"SELECT i.rid FROM incoming_rows i WHERE {S.norm('i.text_no_url')} NOT IN (SELECT {S.norm('text_no_url')} FROM {MAIN})")
def unseen_incoming(spark, d):
    return linkage.unseen(table(spark, d, "incoming_rows"), main(spark, d)).select("rid")


@query(f"SELECT rid, dataset_name, 'base' AS part FROM {MAIN} UNION ALL SELECT rid, dataset_name, 'new' FROM incoming_rows")
def base_and_new(spark, d):
    pick = lambda t, part: table(spark, d, t).select("rid", "dataset_name", F.lit(part).alias("part"))
    return pick(MAIN, "base").unionByName(pick("incoming_rows", "new"))


@query(f"SELECT rid FROM {MAIN} EXCEPT SELECT rid FROM {LABELS}")
def unlabelled_ids(spark, d):
    return main(spark, d).select("rid").subtract(table(spark, d, LABELS).select("rid"))


@query(f"SELECT m.rid, m.label, coalesce(l.label_tier, '') AS label_tier, coalesce(l.train_label, '') AS train_label FROM {MAIN} m LEFT JOIN (SELECT rid, min(label_tier) AS label_tier, min(train_label) AS train_label FROM {LABELS} GROUP BY rid) l USING (rid)")
def with_labels(spark, d):
    l = table(spark, d, LABELS).groupBy("rid").agg(F.min("label_tier").alias("label_tier"), F.min("train_label").alias("train_label"))
    return main(spark, d).select("rid", "label").join(l, "rid", "left").na.fill("", ["label_tier", "train_label"])


@query(f"SELECT DISTINCT lower(url_review) AS url FROM {MAIN} WHERE url_review LIKE 'http%'")
def distinct_urls(spark, d):
    return main(spark, d).where(F.startswith("url_review", F.lit("http"))).select(F.lower("url_review").alias("url")).distinct()


# ------------------------------------------------------------- samples


@query(f"SELECT rid FROM {MAIN} ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42')), rid LIMIT 100")
def simple_sample(spark, d):
    return sampling.simple_sample(main(spark, d), "rid", 100).select("rid")


@query(f"""
WITH e AS (SELECT rid, {S.era('date_iso')} AS era, coalesce(starts_with(dataset_name, 'NEWS_'), false) AS news FROM {MAIN}),
r AS (SELECT *, row_number() OVER (PARTITION BY era, news ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42'))) AS k, count(*) FILTER (NOT news) OVER (PARTITION BY era) AS others FROM e)
SELECT rid, era FROM r WHERE NOT news OR k <= floor(0.5 * greatest(others, 1))""")
def era_quota(spark, d):
    return sampling.era_quota(main(spark, d).select("rid", "date_iso", "dataset_name"), 0.5).select("rid", "era")


def _strata(rows: str, least: int) -> str:
    return f"""s0 AS (SELECT rid, CASE WHEN count(*) OVER (PARTITION BY dataset_name, label) < {least} THEN coalesce(label, '') ELSE coalesce(dataset_name, '') || '|' || coalesce(label, '') END AS stratum FROM {rows}),
s1 AS (SELECT stratum, count(*) AS k FROM s0 GROUP BY stratum), s AS (SELECT rid, CASE WHEN k < {least} THEN (SELECT stratum FROM s1 ORDER BY k DESC, stratum LIMIT 1) ELSE stratum END AS stratum FROM s0 JOIN s1 USING (stratum))"""


@query(f"""
WITH {_strata(MAIN, 10)},
r AS (SELECT rid, (row_number() OVER (PARTITION BY stratum ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42'))) - 1) / count(*) OVER (PARTITION BY stratum) AS place FROM s)
SELECT rid, CASE WHEN place < 0.15 THEN 'test' WHEN place < 0.3 THEN 'val' ELSE 'train' END AS split FROM r""")
def stratified_split(spark, d):
    return sampling.stratified_split(main(spark, d).select("rid", "dataset_name", "label"), "dataset_name", "label", "rid").select("rid", "split")


@query(f"""
WITH c AS (SELECT rid, dataset_name, label, {S.channel('dataset_name')} = 'social' AS held FROM {MAIN}),
{_strata('(SELECT * FROM c WHERE NOT held)', 4)},
r AS (SELECT rid, (row_number() OVER (PARTITION BY stratum ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42'))) - 1) / count(*) OVER (PARTITION BY stratum) AS place FROM s)
SELECT rid, CASE WHEN place < 0.15 THEN 'val' ELSE 'train' END AS split FROM r UNION ALL SELECT rid, 'test' FROM c WHERE held""")
def held_out_channel(spark, d):
    return sampling.held_out_split(main(spark, d).select("rid", "dataset_name", "label"), T.channel(F.col("dataset_name")), "social", "dataset_name", "label", "rid").select("rid", "split")


@query(f"""
WITH r AS (SELECT rid, row_number() OVER (PARTITION BY dataset_name, label ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42'))) AS k, count(*) OVER (PARTITION BY dataset_name, label) AS n FROM {MAIN}),
m AS (SELECT CAST(floor(quantile_cont(n, 0.5)) AS BIGINT) AS m FROM (SELECT count(*) AS n FROM {MAIN} GROUP BY dataset_name, label)),
c AS (SELECT rid, m // n + CASE WHEN k <= m % n THEN 1 ELSE 0 END AS copies FROM r, m)
SELECT rid, CAST(unnest(range(1, copies + 1)) AS INT) AS copy FROM c WHERE copies > 0""")
def equal_cells(spark, d):
    return sampling.equal_cells(main(spark, d).select("rid", "dataset_name", "label"), "dataset_name", "label", "rid").select("rid", "copy")


@query(f"""
WITH r AS (SELECT rid, coalesce(word_len, 0) AS n, (row_number() OVER (ORDER BY md5(concat(CAST(rid AS VARCHAR), '-42')), rid) - 1) // 400 AS m FROM {MAIN}), s AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY n DESC, rid) - 1 AS k FROM r)
SELECT rid, CAST(m * 50 + k // 8 AS BIGINT) AS batch, CAST(k % 8 + 1 AS INT) AS place FROM s""")
def length_batches(spark, d):
    """Batches of eight rows of like length, for models that pad."""
    rows = main(spark, d).select("rid", F.coalesce("word_len", F.lit(0)).alias("n"))
    return sampling.length_batches(rows, "rid", "n", 8).select("rid", "batch", "place")


_GOALS = ", ".join(f"('{k}', {v})" for k, v in V.ERA_GOALS.items())


@query(f"SELECT g.era, coalesce(c.n, 0) AS n, CAST(goal AS BIGINT) AS goal, CAST(greatest(0, goal - coalesce(c.n, 0)) AS BIGINT) AS deficit FROM (VALUES {_GOALS}) g(era, goal) LEFT JOIN (SELECT {S.era('date_iso')} AS era, count(*) AS n FROM {MAIN} GROUP BY 1) c ON c.era = g.era")
def era_deficits(spark, d):
    return sampling.deficits(main(spark, d), V.ERA_GOALS)


# ------------------------------------------------------------- linkage


def _link_sql(threshold: float) -> str:
    t = S.tokens("{}", V.MATCH_STOP)
    return f"""
WITH q AS (SELECT rid, {S.norm('text_no_url')} AS key, {t.format('text_no_url')} AS toks FROM incoming_rows WHERE text_no_url IS NOT NULL),
c AS (SELECT rid AS claim_id, {S.norm('text_no_url')} AS key, {t.format('text_no_url')} AS ctoks FROM {MAIN} WHERE starts_with(dataset_name, 'FC_') AND text_no_url IS NOT NULL),
f AS (SELECT key, min(claim_id) AS claim_id FROM c WHERE key <> '' GROUP BY key), x AS (SELECT q.rid, f.claim_id, 1.0 AS score FROM q JOIN f USING (key)),
qt AS (SELECT rid, unnest(toks) AS tok FROM q WHERE rid NOT IN (SELECT rid FROM x)), ct AS (SELECT claim_id, unnest(ctoks) AS tok FROM c),
p AS (SELECT qt.rid, ct.claim_id, count(*) AS shared FROM qt JOIN ct USING (tok) GROUP BY ALL HAVING count(*) >= 2),
s AS (SELECT p.rid, p.claim_id, shared / least(len(q.toks), len(c.ctoks)) AS score FROM p JOIN q USING (rid) JOIN c USING (claim_id)),
b AS (SELECT * FROM s WHERE score >= {threshold} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, claim_id) = 1)
SELECT rid, claim_id, round(score, 6) AS score FROM (SELECT * FROM x UNION ALL SELECT * FROM b)"""


@query(_link_sql(0.9))
def claim_links(spark, d):
    texts = table(spark, d, "incoming_rows").where("text_no_url IS NOT NULL").select("rid", F.col("text_no_url").alias("text"))
    claims = main(spark, d).where(F.startswith("dataset_name", F.lit("FC_")) & F.col("text_no_url").isNotNull()).select(F.col("rid").alias("claim_id"), F.col("text_no_url").alias("claim"))
    return linkage.link_claims(texts, claims, 0.9).select("rid", "claim_id", r6(F.col("score"), "score"))


_SITES = [("zapnovas", "zap"), ("blogdavila", "blog"), ("acervo", "archive"), (".example", "other")]


@query(f"SELECT rid, CASE {' '.join(f"WHEN contains(lower(coalesce(url_review, '')), '{a}') THEN '{b}'" for a, b in _SITES)} END AS site FROM {MAIN}")
def sites_by_substring(spark, d):
    return linkage.match_by_substring(main(spark, d).select("rid", "url_review"), "url_review", _SITES, "site").select("rid", "site")


@query("""
WITH v AS (SELECT vec_id, embedding AS e FROM embeddings), s AS (SELECT q.vec_id AS query_id, v.vec_id AS nearest_id, list_cosine_similarity(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS sim FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, arg_max(nearest_id, sim) AS nearest_id, round(max(sim), 5) AS sim FROM s GROUP BY query_id""")
def nearest_vectors(spark, d):
    """The nearest other vector of every fiftieth one, against all vectors."""
    e = table(spark, d, "embeddings")
    return nearest.nearest(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding").select("query_id", "nearest_id", F.round("sim", 5).alias("sim"))


@query("""
WITH c AS (SELECT label, list(CAST(embedding AS DOUBLE[])) AS es FROM embeddings GROUP BY label), u AS (SELECT label, unnest(es) AS e FROM c),
x AS (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS v FROM u), m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY ALL),
n AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings)
SELECT n.vec_id, round(sum(n.v * m.v) / (sqrt(sum(n.v * n.v)) * sqrt(sum(m.v * m.v))), 5) AS sim FROM n JOIN m ON m.label = n.label AND m.i = n.i GROUP BY n.vec_id""")
def centroid_similarity(spark, d):
    """Cosine of each vector with the mean vector of its label."""
    e = table(spark, d, "embeddings")
    mean = e.select("label", F.posexplode("embedding").alias("i", "v")).groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    mean = mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("c"))  # as many rows as a vector has places
    return e.join(mean, "label").select("vec_id", F.round(M.cosine(F.col("embedding"), F.col("c")), 5).alias("sim"))


@query("""
SELECT a.doc_id, round(CASE WHEN len(ta) = 0 AND len(tb) = 0 THEN 1.0 ELSE len(list_intersect(ta, tb)) / greatest(len(list_distinct(list_concat(ta, tb))), 1) END, 6) AS jaccard,
  round(coalesce(len(list_intersect(ta, tb)) / nullif(least(len(ta), len(tb)), 0), 0.0), 6) AS overlap, (len(na) = 0 OR list_has_any(na, nb)) AS same_numbers
FROM (SELECT doc_id, TOKA AS ta, TOKB AS tb, list_distinct(regexp_extract_all(NORMA, '\\b\\d+\\b')) AS na, list_distinct(regexp_extract_all(NORMB, '\\b\\d+\\b')) AS nb FROM documents) a"""
    .replace("TOKA", S.tokens("text", V.MATCH_STOP)).replace("TOKB", S.tokens("other", V.MATCH_STOP)).replace("NORMA", S.norm("text")).replace("NORMB", S.norm("other"))
    .replace("FROM documents", "FROM (SELECT a.doc_id, a.text, b.text AS other FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1)"))
def set_measures(spark, d):
    """Jaccard, overlap and shared digits of each document with the next one, whole texts."""
    t = table(spark, d, "documents").select("doc_id", "text")
    t = t.join(t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("half")), "doc_id")
    t = t.select("doc_id", T.content_tokens(F.col("text"), V.MATCH_STOP).alias("a"), T.content_tokens(F.col("half"), V.MATCH_STOP).alias("b"), *[F.array_distinct(F.regexp_extract_all(T.normalize_text(F.col(c)), F.lit(r"\b\d+\b"), F.lit(0))).alias(n) for c, n in (("text", "na"), ("half", "nb"))])
    return t.select("doc_id", r6(M.jaccard(F.col("a"), F.col("b")), "jaccard"), r6(M.overlap(F.col("a"), F.col("b")), "overlap"), ((F.size("na") == 0) | F.arrays_overlap("na", "nb")).alias("same_numbers"))


# ------------------------------------------------------------- evaluation

_ROWS = f"(SELECT rid, label_source AS grp, label_tier, CAST(label = 'fake' AS INT) AS y, CASE WHEN auto_label = 'fake' THEN confidence WHEN auto_label = 'true' THEN 1 - confidence ELSE 0.5 END AS p FROM {LABELS} WHERE confidence IS NOT NULL AND label IN ('fake', 'true'))"


def scored(spark, d):
    """The label table as scores of the class ``fake``."""
    c = F.col("confidence")
    p = F.when(F.col("auto_label") == "fake", c).when(F.col("auto_label") == "true", 1 - c).otherwise(0.5)
    return table(spark, d, LABELS).where(c.isNotNull() & F.col("label").isin("fake", "true")).select("rid", F.col("label_source").alias("grp"), "label_tier", (F.col("label") == "fake").cast("int").alias("y"), p.alias("p"))


_F1 = "coalesce(2.0 * {0} / nullif(2 * {0} + fp + fn, 0), 0.0)"
_CONF = f"""SELECT {{g}}, count(*) AS n, sum(y) AS pos, count(*) FILTER (y = 1 AND p >= 0.5) AS tp, count(*) FILTER (y = 0 AND p >= 0.5) AS fp, count(*) FILTER (y = 1 AND p < 0.5) AS fn, count(*) FILTER (y = 0 AND p < 0.5) AS tn, avg((p - y) ** 2) AS brier FROM {_ROWS} GROUP BY 1"""


@query(f"SELECT label_tier, n, CAST(pos AS BIGINT) AS pos, round((tp + tn) / n, 6) AS acc, round({_F1.format('tp')}, 6) AS f1, round(CASE WHEN pos > 0 AND pos < n THEN ({_F1.format('tp')} + {_F1.format('tn')}) / 2 END, 6) AS macro_f1, round(CASE WHEN pos > 0 AND pos < n THEN brier END, 6) AS brier FROM ({_CONF.format(g='label_tier')})")
def confusion_metrics(spark, d):
    m = evaluation.confusion(scored(spark, d), ["label_tier"])
    return m.select("label_tier", "n", "pos", *[r6(F.col(c), c) for c in ("acc", "f1", "macro_f1", "brier")])


@query(f"""
WITH a AS (SELECT label_tier, p, sum(y) AS pos, sum(1 - y) AS neg FROM {_ROWS} GROUP BY ALL),
w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY label_tier ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under, sum(pos) OVER d AS tp, sum(pos + neg) OVER d AS seen FROM a WINDOW d AS (PARTITION BY label_tier ORDER BY p DESC))
SELECT label_tier, round(sum(pos * (under + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc, round(sum(pos * tp / seen) / sum(pos), 6) AS avg_precision FROM w GROUP BY label_tier""")
def ranking_metrics(spark, d):
    m = evaluation.ranking(scored(spark, d), ["label_tier"])
    return m.select("label_tier", r6(F.col("roc_auc"), "roc_auc"), r6(F.col("avg_precision"), "avg_precision"))


@query(f"""
WITH b AS (SELECT label_tier, CASE WHEN p >= 0.5 THEN p ELSE 1 - p END AS conf, CAST((p >= 0.5) = (y = 1) AS INT) AS ok FROM {_ROWS}), g AS (SELECT label_tier, ceil(conf * 15) AS bin, count(*) AS n, sum(ok) AS ok, sum(conf) AS conf FROM b GROUP BY ALL)
SELECT label_tier, round(sum(abs(ok - conf)) / sum(n), 6) AS ece FROM g GROUP BY label_tier""")
def calibration_errors(spark, d):
    return evaluation.calibration_error(scored(spark, d), ["label_tier"]).select("label_tier", r6(F.col("ece"), "ece"))


@query(f"SELECT CAST(greatest(ceil(p * 10), 1) AS INT) AS bin, count(*) AS n, round(avg(p), 6) AS mean_score, round(avg(y), 6) AS mean_label FROM {_ROWS} GROUP BY 1")
def reliability_table(spark, d):
    return evaluation.reliability(scored(spark, d)).select("bin", "n", r6(F.col("mean_score"), "mean_score"), r6(F.col("mean_label"), "mean_label"))


@query(f"""
WITH g AS (SELECT concat_ws(' | ', coalesce(grp, ''), coalesce(label_tier, '')) AS slice, count(*) AS n, avg(y) AS mean, sum(CAST((p >= 0.5) = (y = 1) AS INT)) AS k FROM {_ROWS} GROUP BY 1 HAVING count(*) >= 30), z AS (SELECT *, k / n AS a, 1.96 * 1.96 AS zz FROM g)
SELECT slice, n, round(mean, 6) AS mean, round(a, 6) AS acc, round(((a + zz / (2 * n)) - 1.96 * sqrt(a * (1 - a) / n + zz / (4 * n * n))) / (1 + zz / n), 6) AS low, round(((a + zz / (2 * n)) + 1.96 * sqrt(a * (1 - a) / n + zz / (4 * n * n))) / (1 + zz / n), 6) AS high FROM z""")
def slice_metrics(spark, d):
    m = evaluation.slices(scored(spark, d), ["grp", "label_tier"])
    return m.select("slice", "n", *[r6(F.col(c), c) for c in ("mean", "acc", "low", "high")])


@query(f"SELECT label_tier, rid, row_number() OVER (PARTITION BY label_tier ORDER BY abs(p - 0.5) DESC, rid) AS place, round(p, 6) AS p FROM {_ROWS} WHERE (p >= 0.5) <> (y = 1) QUALIFY place <= 40")
def confident_errors(spark, d):
    return evaluation.confident_errors(scored(spark, d), "label_tier", "rid").select("label_tier", "rid", F.col("rank").cast("bigint").alias("place"), r6(F.col("p"), "p"))


@query(f"SELECT round(min(({_F1.format('tp')} + {_F1.format('tn')}) / 2), 6) AS worst_macro_f1, count(*) AS groups FROM ({_CONF.format(g='label_tier')}) WHERE n >= 100 AND least(pos, n - pos) >= 20")
def worst_group(spark, d):
    return evaluation.worst_group(scored(spark, d), "label_tier").select(r6(F.col("worst_macro_f1"), "worst_macro_f1"), "groups")


@query()
def score_calibration(spark, d):
    """Temperature and Platt's parameters fitted on the label table's scores."""
    rows = scored(spark, d).withColumn("p", F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.col("p")))).select("y", F.log(F.col("p") / (1 - F.col("p"))).alias("z"))
    a, b = evaluation.fit_platt(rows)
    return spark.createDataFrame([(evaluation.fit_temperature(rows), a, b)], "temperature double, a double, b double")


# ------------------------------------------------------------- near-duplicates


@query()
def near_duplicate_decisions(spark, d):
    """For each incoming row whether it is kept, and else why: a copy or near to a known or an earlier kept row."""
    return near_duplicates.deduplicate(table(spark, d, "incoming_rows"), main(spark, d).select("rid", "text_no_url"))
