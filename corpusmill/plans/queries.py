"""The core queries by name, and the DuckDB SQL each is compared with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.operators import timestamps
from corpusmill.plans import pipeline_queries, stream_queries, table_queries, text_queries
from corpusmill.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return timestamps.found(table(spark, d, "fakenewsbr_v6_public"), table(spark, d, "source_registry"))


QUERIES: dict[str, Query] = {"p6_found": p6_found} | text_queries.QUERIES | table_queries.QUERIES | stream_queries.QUERIES | pipeline_queries.QUERIES
SQL: dict[str, str] = text_queries.SQL | table_queries.SQL | stream_queries.SQL | pipeline_queries.SQL


def _p6_sql() -> str:
    """An independent reading of the notations: cut into date and rest, then the rest into time and zone."""
    months = "MAP {" + ", ".join(f"'{n}': {k}" for k, names in enumerate(timestamps.MONTHS, 1) for n in names.split()) + "}"
    zones = "MAP {" + ", ".join(f"'{n}': {k}" for n, k in timestamps.ZONES.items()) + "}"
    v = "trim(regexp_replace(strip_accents(lower(date_iso)), '[\\s\\p{Z}\\p{Cf}]+', ' ', 'g'))"
    return f"""
WITH n AS (SELECT rid, date_iso AS raw, {v} AS v, coalesce(r.home_tz, 'UTC') AS tz, coalesce(r.date_order, 'DMY') AS o FROM fakenewsbr_v6_public m LEFT JOIN source_registry r USING (dataset_name) WHERE date_iso IS NOT NULL),
f AS (SELECT *, CASE
  WHEN regexp_matches(v, '^(\\d{{10}}|\\d{{13}})$') THEN {{'k': 'e', 'y': '', 'm': '', 'd': '', 'x': ''}}
  WHEN regexp_matches(v, '^\\d{{4}}[-/.]\\d') THEN struct_insert(regexp_extract(v, '^(\\d{{4}})[-/.](\\d{{1,2}})[-/.](\\d{{1,2}})(.*)$', ['y', 'm', 'd', 'x']), k := 'n')
  WHEN regexp_matches(v, '^\\d{{8}}(t\\d{{6}})?$') THEN struct_insert(regexp_extract(regexp_replace(v, 't(\\d\\d)(\\d\\d)(\\d\\d)$', ' \\1:\\2:\\3'), '^(\\d{{4}})(\\d\\d)(\\d\\d)(.*)$', ['y', 'm', 'd', 'x']), k := 'n')
  WHEN regexp_matches(v, '^\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d') AND o = 'MDY' THEN struct_insert(regexp_extract(v, '^(\\d{{1,2}})[-/.](\\d{{1,2}})[-/.](\\d{{4}}|\\d{{2}})(.*)$', ['m', 'd', 'y', 'x']), k := 'n')
  WHEN regexp_matches(v, '^\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d') THEN struct_insert(regexp_extract(v, '^(\\d{{1,2}})[-/.](\\d{{1,2}})[-/.](\\d{{4}}|\\d{{2}})(.*)$', ['d', 'm', 'y', 'x']), k := 'n')
  WHEN regexp_matches(v, '^([a-z]+, )?\\d{{1,2}}( de |-| )[a-z]') THEN struct_insert(regexp_extract(regexp_replace(v, '^[a-z]+, ', ''), '^(\\d{{1,2}})(?: de |-| )([a-z]+)\\.?(?: de |-| )(\\d{{4}})(.*)$', ['d', 'm', 'y', 'x']), k := 'w')
  ELSE struct_insert(regexp_extract(v, '^([a-z]+) (\\d{{1,2}}), (\\d{{4}})(.*)$', ['m', 'd', 'y', 'x']), k := 'w') END AS f FROM n WHERE v <> ''),
g AS (SELECT rid, raw, v, tz, f.k AS k, CASE WHEN length(f.y) = 2 THEN '20' || f.y ELSE f.y END AS y, CASE WHEN f.k = 'w' THEN CAST({months}[f.m] AS VARCHAR) ELSE f.m END AS m, f.d AS d, f.x AS x,
  regexp_extract(f.x, '^(?:[ t,]| as )+(\\d{{1,2}})[:h](\\d\\d)(?::(\\d\\d)(?:\\.\\d+)?)? ?(am|pm)? ?(.*)$', ['h', 'i', 's', 'p', 'z']) AS t FROM f),
h AS (SELECT *, try_cast(y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') AS DATE) AS day, CAST(nullif(t.h, '') AS INT) + CASE WHEN t.p = 'pm' AND t.h <> '12' THEN 12 WHEN t.p = 'am' AND t.h = '12' THEN -12 ELSE 0 END AS hour FROM g),
l AS (SELECT *, CAST(day AS TIMESTAMP) + to_hours(hour) + to_minutes(try_cast(t.i AS INT)) + to_seconds(CAST(coalesce(nullif(t.s, ''), '0') AS INT)) AS wall FROM (SELECT * REPLACE (CASE WHEN y = '0000' THEN NULL ELSE day END AS day) FROM h)),
z AS (SELECT *, CASE WHEN t.z = '' THEN tz WHEN t.z LIKE '[%]' THEN (SELECT any_value(name) FROM pg_timezone_names() WHERE lower(name) = trim(t.z, '[]')) END AS region, CASE WHEN regexp_matches(t.z, '^[+-]\\d\\d:?\\d\\d$')
  THEN (CASE WHEN t.z[1] = '-' THEN -1 ELSE 1 END) * (CAST(t.z[2:3] AS INT) * 60 + CAST(right(t.z, 2) AS INT)) ELSE {zones}[t.z] END AS off FROM l),
u AS (SELECT *, CASE WHEN k = 'e' THEN epoch_ms(CAST(v[1:10] AS BIGINT) * 1000) WHEN off IS NOT NULL THEN wall - to_minutes(off)
  ELSE (SELECT CASE WHEN ((w - INTERVAL 1 HOUR) AT TIME ZONE region) = wall THEN w - INTERVAL 1 HOUR ELSE w END FROM (SELECT wall AT TIME ZONE region AS w)) AT TIME ZONE 'UTC' END AS utc FROM z)
SELECT rid, CASE WHEN k = 'e' THEN strftime(utc, '%Y-%m-%dT%H:%M:%SZ') WHEN day IS NULL THEN 'invalid' WHEN x = '' THEN strftime(day, '%Y-%m-%d') WHEN utc IS NULL THEN 'invalid' ELSE strftime(utc, '%Y-%m-%dT%H:%M:%SZ') END AS date_utc
FROM u WHERE NOT (day IS NOT NULL AND regexp_matches(raw, '^\\d{{4}}-\\d\\d-\\d\\d$'))"""


SQL["p6_found"] = _p6_sql()
