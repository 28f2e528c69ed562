"""Selective voting over evidence: a checker's verdict, else agreement of several reputable sites, else abstention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions import vocabulary as V
from corpusmill.functions.measures import overlap
from corpusmill.operators import linkage
from corpusmill.sources.readers import published

NEAR_DAYS = 45


def near_in_time(date_iso: Column, pub: Column, days: int = NEAR_DAYS) -> Column:
    """Within so many days, the difference rounded down; true where either date is missing or no date."""
    a, b = F.try_to_timestamp(date_iso), published(pub)
    return F.coalesce(F.abs(F.floor((F.unix_seconds(a) - F.unix_seconds(b)) / 86400)) <= days, F.lit(True))


def named(domain: Column) -> Column:
    """Whether a site has a name."""
    return F.coalesce(domain, F.lit("")).isin("", "sem_url") == F.lit(False)


def named_checker(blob: Column, checkers: list[tuple[str, str]]) -> Column:
    """The key of the first listed checker that a text names, else null."""
    checker = F.lit(None).cast("string")
    for name, key in reversed(checkers):
        checker = F.when(F.contains(F.lower(blob), F.lit(name)), key).otherwise(checker)
    return checker


def linked(texts: DataFrame, titles: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``(rid, claim_id, sim, score)``: the pairs of ``texts`` ``(rid, text)`` and ``titles`` ``(claim_id, title)`` that are similar and agree in numbers as ``vote`` has it without cosines, and that ``linkage.link_all`` links.

    ``sim`` is the share of content words, ``score`` that of the link. Equal texts with three content words are similar and linked with 1 in any case.
    """

    def sets(c: Column) -> list[Column]:
        return [linkage.hashed_set(T.content_tokens(c, stop)).alias(name) for name, stop in (("toks", V.EVIDENCE_STOP), ("wide", V.MATCH_STOP))]

    # A number too large to read agrees with none, but the text has one.
    nums = F.transform(T.numbers(F.col("text")), lambda x: F.coalesce(x, F.lit(-1))).alias("nums")
    got = linkage.overlapping(texts.select("rid", *sets(F.col("text")), nums), titles.select("claim_id", *sets(F.col("title")), F.array_compact(T.numbers(F.col("title"))).alias("nums")), threshold, 3)
    return got.select("rid", "claim_id", F.col("score").alias("sim"), F.col("wide").alias("score"))


def classify(rows: DataFrame, checkers: list[tuple[str, str]], reputable: list[str] | None, least_sites: int = 3, similar_checker: float = 0.8, similar_site: float = 0.75) -> DataFrame:
    """``(rid, auto_label, confidence, method, evidence, sim)``, one row per row.

    ``rows`` is ``(rid, text, own_domain, date_iso, items)``, ``items`` an array of ``(title, link, source, domain, pub)`` and
    optionally ``sim``, a cosine; without it the shared share of content words counts, with three shared at least. The first item in
    order that names a checker, is similar, agrees in numbers and has a verdict decides; items of a row are few and stay together.
    """
    items = rows.select("rid", F.posexplode_outer("items").alias("pos", "it")).where("it IS NOT NULL")
    return vote(rows, items, checkers, reputable, least_sites, similar_checker, similar_site)


def vote(rows: DataFrame, items: DataFrame, checkers: list[tuple[str, str]], reputable: list[str] | None, least_sites: int = 3, similar_checker: float = 0.8, similar_site: float = 0.75) -> DataFrame:
    """``classify`` for any number of items: ``items`` is ``(rid, pos, it)``, a row each, ``pos`` of any type that orders them.

    ``reputable`` are the sites that count, all that have a name if None. No row's items come together: the first checker's item and the distinct sites pre-aggregate.
    """
    item = [f.name for f in items.schema["it"].dataType.fields]
    e = rows.select("rid", "text", "own_domain", "date_iso").join(items, "rid")
    a, b = T.content_tokens(F.col("text"), V.EVIDENCE_STOP), T.content_tokens(F.col("it.title"), V.EVIDENCE_STOP)
    e = e.withColumns({"lex": overlap(a, b), "inter": F.size(F.array_intersect(a, b)), "nums": T.numbers(F.col("text")), "tnums": T.numbers(F.col("it.title"))})
    cosine = F.col("it.sim") if "sim" in item else F.lit(None).cast("double")
    lexical = (F.col("lex") >= 0.6) & (F.col("inter") >= 3)
    alike = lambda bar: F.when(cosine.isNotNull(), cosine >= bar).otherwise(lexical)
    agree = (F.size("nums") == 0) | F.arrays_overlap("nums", "tnums")
    checker = named_checker(F.concat_ws(" ", F.col("it.source"), F.col("it.domain"), F.col("it.title")), checkers)
    e = e.withColumns({"checker": checker, "verdict": T.title_verdict(F.col("it.title")), "sim": F.coalesce(cosine, "lex"), "ok_c": alike(similar_checker) & agree, "ok_s": alike(similar_site) & agree})
    known = F.col("it.domain").isin(reputable) if reputable is not None else named(F.col("it.domain"))
    site = known & ~F.col("it.domain").eqNullSafe(F.col("own_domain")) & near_in_time(F.col("date_iso"), F.col("it.pub"))
    return decided(rows, e.where("checker IS NOT NULL AND verdict IS NOT NULL AND ok_c").withColumn("link", F.col("it.link")), e.where(F.col("ok_s") & site).select("rid", "it.domain"), least_sites)


def decided(rows: DataFrame, said: DataFrame, sites: DataFrame, least_sites: int = 3) -> DataFrame:
    """What ``vote`` gives, from checkers' items ``(rid, pos, verdict, checker, link, sim)`` and sites ``(rid, domain)`` that count."""
    first = said.groupBy("rid").agg(F.min_by(F.struct("verdict", "checker", "link", "sim"), "pos").alias("c"))
    sites = sites.groupBy("rid").agg(F.array_sort(F.collect_set("domain")).alias("sites")).where(F.size("sites") >= least_sites)
    out = rows.select("rid").join(first, "rid", "left").join(sites, "rid", "left")
    voted = F.col("sites").isNotNull()
    return out.select(
        "rid", F.coalesce("c.verdict", F.when(voted, "true"), F.lit("unknown")).alias("auto_label"), F.when(F.col("c").isNotNull(), "alta").when(voted, "media").otherwise("-").alias("confidence"),
        F.when(F.col("c").isNotNull(), F.concat(F.lit("factcheck:"), "c.checker")).when(voted, "corroboracao").otherwise("abstencao").alias("method"), F.coalesce("c.link", F.array_join("sites", ";"), F.lit("")).alias("evidence"), F.col("c.sim").alias("sim"),
    )


def latest_cache(log: DataFrame) -> DataFrame:
    """``(q, items)`` of an append-only cache ``(q, items, at)``: the last write of each query."""
    return log.groupBy("q").agg(F.max_by("items", "at").alias("items"))


def consolidate(base: DataFrame, matches: DataFrame, verdicts: DataFrame, voted: DataFrame) -> DataFrame:
    """Label tiers with precedence: ``(rid, label, label_tier, auto_label, confidence, method, train_label, verified_label)``.

    Checker matches of score 0.9 or more that agree replace any tier, the last by ``at`` counting; model verdicts of confidence 0.8
    or more replace weaker tiers than theirs, the first by ``at`` counting; corroborated rows replace still weaker ones.
    """
    tier = F.when(F.col("label_source") == "rating", "checker").when(F.col("label_source").isin("provenance", "correction"), F.col("label_source")).otherwise("v1")
    rank = F.create_map(*[F.lit(x) for kv in V.TIERS.items() for x in kv])
    b = base.select("rid", "label", tier.alias("t0"))
    m = matches.where("score >= 0.9 AND agrees").groupBy("rid").agg(F.max_by(F.struct("verdict", "score", "publisher"), "at").alias("m"))
    v = verdicts.where(F.col("verdict").isin("fake", "true") & (F.col("confidence") >= 0.8)).groupBy("rid").agg(F.min_by(F.struct("verdict", "confidence"), "at").alias("v"))
    c = voted.where("auto_label = 'true'").select("rid", F.lit(True).alias("c")).distinct()
    x = b.join(m, "rid", "left").join(v, "rid", "left").join(c, "rid", "left")
    t1 = F.when(F.col("m").isNotNull(), "checker_match").otherwise(F.col("t0"))
    by_model = F.col("v").isNotNull() & (F.element_at(rank, F.col("t1")) > V.TIERS["llm_local"])
    by_vote = F.coalesce("c", F.lit(False)) & ~F.col("by_model") & (F.element_at(rank, F.col("t1")) > V.TIERS["corroborated"])
    x = x.withColumn("t1", t1).withColumn("by_model", by_model).withColumn("by_vote", by_vote)
    x = x.withColumn("label_tier", F.when(F.col("by_model"), "llm_local").when(F.col("by_vote"), "corroborated").otherwise(F.col("t1")))
    given = F.when(F.col("by_model"), F.col("v.verdict")).when(F.col("by_vote"), "true").when(F.col("m").isNotNull(), F.col("m.verdict"))
    x = x.withColumn("given", given)
    train = F.when(F.col("label_tier").isin("v1", "checker", "correction", "checker_match", "corroborated", "llm_local"), F.when(F.col("given").isin("fake", "true"), F.col("given")).otherwise(F.col("label")))
    x = x.withColumn("train_label", train)
    auto = F.when(~F.coalesce(F.col("train_label").isin("fake", "true"), F.lit(False)), "unknown").when(F.col("label_tier").isin("v1", "checker"), F.col("label")).otherwise(F.coalesce("given", F.lit("")))
    x = x.withColumn("auto_label", auto)
    return x.select(
        "rid", "label", "label_tier", "auto_label", F.when(F.col("by_model"), F.col("v.confidence")).when(F.col("by_vote"), None).when(F.col("m").isNotNull(), F.col("m.score")).alias("confidence"),
        F.when(F.col("by_model"), "llm_local").when(F.col("by_vote"), "corroboracao").when(F.col("m").isNotNull(), F.concat(F.lit("claimreview:"), F.coalesce("m.publisher", F.lit("")))).otherwise("").alias("method"),
        "train_label", F.when(F.col("auto_label").isin("fake", "true"), F.col("auto_label")).otherwise("unknown").alias("verified_label"),
    )
