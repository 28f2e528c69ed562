"""Event queries: the same operators over a table and, run to its end, over a stream of files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusmill.operators import models
from corpusmill.session import table, work_dir
from corpusmill.streaming import streams

QUERIES: dict = {}
SQL: dict[str, str] = {}

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def hourly_events(spark, d):
    w = streams.event_windows(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return w.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""
WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events), s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def user_sessions(spark, d):
    s = streams.sessions(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return s.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def streamed_events(spark, d):
    """The events read as a stream of files, each id once, appended to a table by micro-batches, then summed."""
    base = f"{work_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = streams.once_per_id(streams.files(spark, f"{d}/events.parque[t]", EVENTS, "parquet"), "event_id")
    streams.append_to(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(EVENTS).parquet(f"{base}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.round(F.sum("value"), 4).alias("total"))


_NORM = "trim(regexp_replace(regexp_replace(strip_accents(lower(coalesce(text, ''))), 'https?://[^\\s\\x0B\\x{A0}]+', ' ', 'g'), '[^\\p{L}\\p{N}_]+', ' ', 'g'))"


@query(f"""
WITH w AS (SELECT doc_id, ' ' || unnest(list_filter(string_split({_NORM}, ' '), lambda x: x <> '')) || ' ' AS w FROM documents),
g AS (SELECT doc_id, unnest(list_concat(list_transform(range(1, greatest(length(w) - 3, 1) + 1), lambda i: substr(w, i, 4)), list_transform(range(1, greatest(length(w) - 4, 1) + 1), lambda i: substr(w, i, 5)))) AS gram FROM w),
t AS (SELECT doc_id, gram, count(*) AS tf FROM g GROUP BY ALL), f AS (SELECT gram, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM t GROUP BY gram HAVING count(*) >= 2),
x AS (SELECT doc_id, gram, (1 + ln(tf)) * idf AS w FROM t JOIN f USING (gram)), n AS (SELECT doc_id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM x),
p AS (SELECT q.doc_id AS query_id, r.doc_id AS nearest_id, round(sum(q.w * r.w), 9) AS sim FROM n q JOIN n r USING (gram) WHERE q.doc_id % 50 = 0 AND r.doc_id <> q.doc_id GROUP BY ALL)
SELECT query_id, nearest_id, round(sim, 6) AS sim FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, nearest_id) = 1""")
def similar_documents(spark, d):
    """The document most like each fiftieth one, by TF-IDF of character 4- and 5-grams, against all documents."""
    t = table(spark, d, "documents").select("doc_id", "text")
    return models.most_similar(t.where("doc_id % 50 = 0"), t, "doc_id", "text").select("query_id", "nearest_id", F.round("sim", 6).alias("sim"))


