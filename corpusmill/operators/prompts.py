"""Requests for a language model as columns, and what it answers parsed back. The calls themselves are not an engine's work."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions import text as T


#: Instructions of the tasks, and the schema each answer must keep to.
TASKS = {
    "verdict_claim": ("Classifique a alegacao do artigo e extraia-a.", "verdict"),
    "correction": ("Extraia, literalmente, a frase que corrige a desinformacao neste artigo.", "correction"),
    "verify_headline": ("Verifique a manchete usando apenas as evidencias.", "verification"),
}
MAX_TOKENS = 400


def evidence_lines(items: Column, most: int = 8, title: int = 160, day: int = 16) -> Column:
    """At most ``most`` lines ``[n] domain (day) [CHECADOR:key]: title``, numbered from 0, of an array of ``(title, domain, pub, checker)``; the tag only with a checker."""
    empty = F.array().cast("array<struct<title:string,domain:string,pub:string,checker:string>>")
    text = lambda c: F.coalesce(c, F.lit(""))

    def line(x: Column, i: Column) -> Column:
        tag = F.when(text(x["checker"]) != "", F.concat(F.lit(" [CHECADOR:"), x["checker"], F.lit("]"))).otherwise("")
        return F.concat(F.lit("["), i.cast("string"), F.lit("] "), text(x["domain"]), F.lit(" ("), F.left(text(x["pub"]), F.lit(day)), F.lit(")"), tag, F.lit(": "), F.left(text(x["title"]), F.lit(title)))

    return F.array_join(F.transform(F.slice(F.coalesce(items, empty), 1, most), line), "\n")


def prompt(text: Column, date_iso: Column, items: Column) -> Column:
    """The question about a headline: its text, its date and the evidence found, or that there is none."""
    lines = evidence_lines(items)
    none = F.coalesce(F.size(items), F.lit(0)) < 1
    return F.concat(F.lit("MANCHETE: "), F.coalesce(text, F.lit("")), F.lit("\nDATA: "), F.coalesce(date_iso, F.lit("")), F.lit("\n\nEVIDENCIAS (Google News):\n"), F.when(none, "(nenhuma)").otherwise(lines))


def request(task: str, source: Column, url: Column, text: Column, question: Column | None = None, article: int = 12_000) -> Column:
    """Struct ``(custom_id, task, schema, max_tokens, body, tokens)``.

    The id is 24 digits of a hash of task, source and address. The body is the given question, or the task's instruction and the
    article's first ``article`` characters; its tokens are estimated at four characters each and 500 for the rest.
    """
    instruction, schema = TASKS[task]
    body = F.concat(F.lit(f"{instruction}\n\n--- ARTIGO ---\n"), F.left(F.coalesce(text, F.lit("")), F.lit(article))) if question is None else question
    key = F.concat(F.lit(f"{task}|"), F.coalesce(source, F.lit("")), F.lit("|"), F.coalesce(url, F.lit("")))
    return F.struct(
        F.substring(F.sha1(key.cast("binary")), 1, 24).alias("custom_id"), F.lit(task).alias("task"), F.lit(schema).alias("schema"), F.lit(MAX_TOKENS).alias("max_tokens"),
        body.alias("body"), (F.floor(F.length(body) / 4) + 500).alias("tokens"),
    )


def cost(tokens: Column, requests: Column, price_in: float, price_out: float, out_tokens: int = 220) -> Column:
    """Estimated price of summed input tokens and a number of requests; prices are per million tokens."""
    return (tokens * price_in + requests * out_tokens * price_out) / 1e6


def parsed_answer(raw: Column) -> Column:
    """Struct ``(verdict, confidence, reason)`` of an answer: plain JSON, fenced, or the outermost braces within prose.

    Unknown verdicts become ``unknown``; a confidence above 1 is a percentage; it is rounded to three places and 0 if missing.
    """
    body = F.regexp_replace(F.coalesce(raw, F.lit("")), r"(?is)^\s*```(?:json)?\s*|\s*```\s*$", "")
    braces = F.regexp_extract(body, r"(?s)\{.*\}", 0)
    shape = "verdict string, confidence double, motivo string"
    p = T.bound(F.from_json(F.when(braces != "", braces), shape), lambda p: F.struct(F.lower(F.trim(p["verdict"])).alias("v"), p["confidence"].alias("c"), p["motivo"].alias("m")))
    c = F.coalesce(F.when(p["c"] > 1, p["c"] / 100).otherwise(p["c"]), F.lit(0.0))
    return F.struct(F.when(p["v"].isin("fake", "true"), p["v"]).otherwise("unknown").alias("verdict"), F.bround(c, 3).alias("confidence"), F.coalesce(p["m"], F.lit("")).alias("reason"))
