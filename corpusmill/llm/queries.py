"""The queries of this subpackage by name, and their DuckDB SQL where SQL can express them over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, canonical, forest, fusion, languages, mixing, personal, ratings, spans
from corpusmill.plans import queries as core
from corpusmill.session import table, written

QUERIES = {}
SQL: dict[str, str] = {}


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.found(table(spark, d, "fakenewsbr_v6_public"))


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    return canonical.deduplicate(table(spark, d, "fakenewsbr_v6_public"), "rid", "text_clean")


QUERIES |= {"p7_found": p7_found, "p7_texts": p7_texts}


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return ratings.found(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "rating_reference"))


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return ratings.unmatched(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "rating_reference"))


QUERIES |= {"p4_found": p4_found, "p4_unmatched": p4_unmatched}


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return fusion.found(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "source_registry"), table(spark, d, "fakenewsbr_v6_provenance"))


def p3_fused(spark: SparkSession, d: str) -> DataFrame:
    """The maximum-posterior value of each field, with its posterior and the number of independent votes."""
    c = fusion.claims(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "source_registry"), table(spark, d, "fakenewsbr_v6_provenance"))
    return fusion.fuse(written(c, "p3-claims"), "even").drop("rid")


QUERIES |= {"p3_found": p3_found, "p3_fused": p3_fused}


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


QUERIES |= {"p8_ids": p8_ids}


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.found(table(spark, d, "documents"))


def p10_shared(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_length(table(spark, d, "documents"))


def p10_passages(spark: SparkSession, d: str) -> DataFrame:
    return spans.passages(table(spark, d, "documents"))


QUERIES |= {"p10_found": p10_found, "p10_shared": p10_shared, "p10_passages": p10_passages}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    history = table(spark, d, "fakenewsbr_v6_public").select("rid", F.col("text_no_url").alias("text"))
    incoming = table(spark, d, "incoming_rows").select("rid", "batch_no", F.col("text_no_url").alias("text"))
    return forest.repeats(history, incoming)


QUERIES |= {"p1_found": p1_found}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.found(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "fakenewsbr_v6_provenance"))


def p2_segments(spark: SparkSession, d: str) -> DataFrame:
    return languages.segments(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "fakenewsbr_v6_provenance")).withColumnRenamed("id", "rid")


QUERIES |= {"p2_found": p2_found, "p2_segments": p2_segments}


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, d), table(spark, d, "mix_targets"))


def p9_sequence(spark: SparkSession, d: str) -> DataFrame:
    return mixing.sequence(p9_mix(spark, d))


QUERIES |= {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_sequence": p9_sequence}


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.found(table(spark, d, "fakenewsbr_v6_public"))


def p5_masked(spark: SparkSession, d: str) -> DataFrame:
    """Each row's text and claimant with typed placeholders."""
    main = table(spark, d, "fakenewsbr_v6_public")
    out = None
    for field in ("text", "factcheck_claimant"):
        one = personal.detect(main, "rid", field, mask=True).select(F.col("id").alias("rid"), F.lit(field).alias("field"), "kinds", "masked")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES |= {"p5_found": p5_found, "p5_masked": p5_masked}


# ------------------------------------------------------------- SQL

_FOLD = "strip_accents(lower({}))"
_FIELDS = "|".join(canonical.CARD_FIELDS)
_FIELD = rf"(?:^|[|;\r\n])[^\p{{L}}\p{{N}}|;\r\n]*({_FIELDS})[^\p{{L}}\p{{N}}:|;\r\n]*:"


def _canon_sql(text: str) -> str:
    t = _FOLD.format(text)
    fields = rf"list_filter(list_transform(string_split(regexp_replace({t}, '{_FIELD}', chr(1) || '\1' || chr(2), 'g'), chr(1)), lambda x: regexp_replace(x, '[^\p{{L}}\p{{N}}\x02]+', '', 'g')), lambda x: x <> '')"
    return rf"CASE WHEN regexp_matches({t}, '(?s){_FIELD}.*{_FIELD}') THEN array_to_string(list_sort({fields}), chr(1)) ELSE regexp_replace({t}, '[^\p{{L}}\p{{N}}]+', '', 'g') END"


SQL["p7_found"] = f"""
WITH c AS (SELECT rid, {_canon_sql('text_no_url')} AS k FROM fakenewsbr_v6_public WHERE text_no_url IS NOT NULL), g AS (SELECT rid, min(rid) OVER (PARTITION BY k) AS rid_first FROM c WHERE k <> '')
SELECT rid_first, rid AS rid_copy FROM g WHERE rid <> rid_first"""
SQL["p7_texts"] = f"""
SELECT rid_first, copies, variants FROM (SELECT k, min(rid) AS rid_first, count(*) AS copies, count(DISTINCT text_clean) AS variants FROM (SELECT rid, text_clean, {_canon_sql('text_clean')} AS k FROM fakenewsbr_v6_public WHERE text_clean IS NOT NULL) WHERE k <> '' GROUP BY k)"""
SQL["p10_found"] = f"""
WITH t AS (SELECT text, list(DISTINCT doc_id) AS ids, min(doc_id) AS rep FROM documents WHERE length(text) >= {spans.RUN} GROUP BY text), w AS (SELECT DISTINCT rep, substr(text, unnest(range(1, length(text) - {spans.RUN} + 2)), {spans.RUN}) AS run FROM t),
s AS (SELECT run FROM w GROUP BY run HAVING count(*) > 1), m AS (SELECT w.rep, w.run FROM w JOIN s USING (run)), p AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM m a JOIN m b ON a.run = b.run AND a.rep <= b.rep UNION SELECT rep, rep FROM t),
x AS (SELECT unnest(ta.ids) AS da, tb.ids AS idb FROM p JOIN t ta ON ta.rep = p.a JOIN t tb ON tb.rep = p.b), y AS (SELECT da, unnest(idb) AS db FROM x)
SELECT DISTINCT least(da, db) AS doc_a, greatest(da, db) AS doc_b FROM y WHERE da <> db"""
_WORDS = "trim(regexp_replace(strip_accents(lower({})), '[^a-z0-9]+', ' ', 'g'))"
SQL["p1_found"] = f"""
WITH r AS (SELECT rid, -1 AS b, text_no_url AS t FROM fakenewsbr_v6_public UNION ALL SELECT rid, batch_no, text_no_url FROM incoming_rows),
k AS (SELECT rid, b, {_canon_sql('t')} AS k, string_split({_WORDS.format('t')}, ' ') AS w FROM r WHERE t IS NOT NULL),
e AS (SELECT rid FROM (SELECT rid, b, row_number() OVER (PARTITION BY k ORDER BY b, rid) AS n FROM k WHERE k <> '') WHERE b >= 0 AND n > 1),
s AS (SELECT rid, b, list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS s FROM k WHERE len(w) >= 3),
u AS (SELECT rid, b, len(s) AS n, unnest(s) AS g FROM s),
q AS (SELECT x.rid, y.rid AS o, any_value(x.n) AS xn, any_value(y.n) AS yn, count(*) AS c FROM u x JOIN u y ON x.g = y.g AND (y.b < x.b OR (y.b = x.b AND y.rid < x.rid)) WHERE x.b >= 0 GROUP BY x.rid, y.rid)
SELECT rid FROM e UNION SELECT rid FROM q WHERE c >= 0.6 * (xn + yn - c)"""

_STAND_INS = "(" + ", ".join("'" + x + "'" for x in fusion.STAND_INS) + ")"
_BLANK = r"NOT regexp_matches({}, '[^\s\p{{Z}}\p{{Cf}}]')"
SQL["p3_found"] = rf"""
WITH bad AS (SELECT rid FROM ({core.SQL['p6_found']}) WHERE date_utc = 'invalid'),
c AS (SELECT rid, {_canon_sql('text_no_url')} AS k FROM fakenewsbr_v6_public WHERE text_no_url IS NOT NULL), g AS (SELECT rid, min(rid) OVER w AS grp, count(*) OVER w AS n FROM c WHERE k <> '' WINDOW w AS (PARTITION BY k)),
m AS (SELECT g.grp, p.*, r.trust_rank, (SELECT max(collected_at) FROM fakenewsbr_v6_provenance v WHERE v.rid = p.rid) AS seen FROM g JOIN fakenewsbr_v6_public p USING (rid) LEFT JOIN source_registry r USING (dataset_name) WHERE g.n > 1),
f AS (SELECT grp, rid, trust_rank, seen, 'url_review' AS field FROM m WHERE regexp_matches(trim(url_review), '(?i)^https?://[^\s/?#]+\S*$')
  UNION ALL SELECT grp, rid, trust_rank, seen, 'factcheck_rating' FROM m WHERE factcheck_rating IS NOT NULL AND NOT ({_BLANK.format('factcheck_rating')}) AND regexp_replace(strip_accents(lower(factcheck_rating)), '^[^\p{{L}}\p{{N}}★☆]+|[^\p{{L}}\p{{N}}★☆]+$', '', 'g') NOT IN {_STAND_INS}
  UNION ALL SELECT grp, rid, trust_rank, seen, 'date_iso' FROM m WHERE date_iso IS NOT NULL AND NOT ({_BLANK.format('date_iso')}) AND rid NOT IN (SELECT rid FROM bad)
  UNION ALL SELECT grp, rid, trust_rank, seen, 'dataset_name' FROM m WHERE dataset_name IS NOT NULL)
SELECT grp AS rid_first, field, rid AS rid_from FROM f QUALIFY row_number() OVER (PARTITION BY grp, field ORDER BY coalesce(trust_rank, 2147483647), coalesce(seen, '') DESC, rid) = 1"""


def _rating_key_sql(x: str) -> str:
    w = f"string_split(trim(regexp_replace({x}, '[^a-z0-9@$]+', ' ', 'g')), ' ')"
    typed = f"'{ratings.TYPED_FOR[0]}', '{ratings.TYPED_FOR[1]}'"
    words = f"CASE WHEN len({w}) > 2 AND len(list_filter({w}, lambda y: length(y) <> 1)) = 0 THEN translate(array_to_string({w}, ''), {typed}) ELSE array_to_string(list_transform({w}, lambda y: CASE WHEN regexp_matches(y, '[a-z]') THEN translate(y, {typed}) ELSE y END), '') END"
    return rf"regexp_replace({words}, '([a-z]{{3}})[oa]s?$', '\1o')"


def _rating_clean_sql(x: str) -> str:
    t = f"translate(strip_accents(lower(regexp_replace({x}, '<[^<>]*>', ' ', 'g'))), '{ratings.LOOKALIKES[0]}', '{ratings.LOOKALIKES[1]}')"
    return rf"regexp_replace(CASE WHEN regexp_matches({t}, '^\s*(?:\S\s+){{3,}}\S\s*$') THEN regexp_replace({t}, '\s+', '', 'g') ELSE {t} END, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"


_TOKS = "list_distinct(list_concat(list_concat(list_transform(range(1, length({0}) + 1), lambda i: substr({0}, i, 1)), list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))), list_concat(list_transform(range(1, length({0}) - 1), lambda i: substr({0}, i, 1) || substr({0}, i + 2, 1)), ['^' || left({0}, 1), right({0}, 1) || '$'])))"
_MAPPED = rf"""
WITH nm AS (SELECT rating_id, unnest(list_concat([rating_name], coalesce(aliases, []))) AS name FROM rating_reference), nk AS (SELECT k AS nk, min(rating_id) AS r FROM (SELECT rating_id, {_rating_key_sql('c')} AS k FROM (SELECT rating_id, {_rating_clean_sql('name')} AS c FROM nm WHERE NOT ({_BLANK.format('name')}))) WHERE k <> '' GROUP BY k),
n AS (SELECT *, {_TOKS.format('nk')} AS nt FROM nk),
v AS (SELECT factcheck_rating AS value, count(*) AS rows FROM fakenewsbr_v6_public WHERE factcheck_rating IS NOT NULL AND NOT ({_BLANK.format('factcheck_rating')}) GROUP BY 1),
p AS (SELECT value, unnest(regexp_split_to_array({_rating_clean_sql('value')}, '\s*(?:[:|(;→\n]|\s[-–—]+\s|\.\s|->|=>)\s*')) AS text, generate_subscripts(regexp_split_to_array({_rating_clean_sql('value')}, '\s*(?:[:|(;→\n]|\s[-–—]+\s|\.\s|->|=>)\s*'), 1) - 1 AS part FROM v),
w AS (SELECT value, part, text, list_filter(regexp_split_to_array(text, '\s+'), lambda y: y <> '') AS w FROM p WHERE text IS NOT NULL),
t AS (SELECT value, part * 2 AS part, text AS try FROM w UNION ALL SELECT value, part * 2 + 1, unnest(list_concat([array_to_string(w[2:], ' ')], list_transform(range(1, (SELECT max(len(regexp_split_to_array(trim(name), '\s+'))) FROM nm) + 1), lambda k: array_to_string(w[1:k], ' ')))) FROM w),
k AS (SELECT value, k, min(part) AS part FROM (SELECT value, part, {_rating_key_sql('try')} AS k FROM t) WHERE k <> '' GROUP BY value, k), d AS (SELECT k, {_TOKS.format('k')} AS kt FROM (SELECT DISTINCT k FROM k)),
s AS (SELECT d.k, n.r, n.nk, len(list_intersect(kt, nt)) / len(list_distinct(list_concat(kt, nt))) AS j, levenshtein(d.k, nk) AS e FROM d, n),
x AS (SELECT k, r, nk, j, CASE WHEN e = 2 AND list_sort(string_split(k, '')) = list_sort(string_split(nk, '')) THEN 1 ELSE e END AS e FROM s WHERE j >= 0.28),
b AS (SELECT value, r FROM k JOIN x USING (k) WHERE e <= CASE WHEN length(nk) <= 6 THEN 1 WHEN length(nk) <= 8 THEN 2 ELSE floor(length(nk) * 0.3) END QUALIFY row_number() OVER (PARTITION BY value ORDER BY part, j DESC, e, length(nk) DESC, r, nk) = 1),
m AS (SELECT value, coalesce(r, 0) AS entry, rows FROM v LEFT JOIN b USING (value))"""
SQL["p4_found"] = _MAPPED + " SELECT p.rid, CAST(m.entry AS INT) AS rating_id FROM fakenewsbr_v6_public p JOIN m ON m.value = p.factcheck_rating WHERE p.factcheck_rating NOT IN (SELECT rating_name FROM rating_reference)"
SQL["p4_unmatched"] = _MAPPED + " SELECT value, rows FROM m WHERE entry = 0"
