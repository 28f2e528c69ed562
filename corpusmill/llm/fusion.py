"""The best representative of each duplicate group (problem 3): Bayesian fusion with copy detection.

A claim is ``(grp, field, value, source)``. Claims of one source for one value, compared in normal form, are one vote. Sources
have accuracies, started from their trust rank and re-estimated from the posteriors of what they claim until they settle; two
sources that share false values more often than independent errors would are dependent, and the less accurate one's vote for a
value that both claim is discounted. A value's evidence is the sum of its discounted votes' log-odds.

The claim of greatest posterior log-odds survives, field by field: its value's evidence plus its prior. Two priors are offered.
``even`` gives all claims the same. ``ranked`` gives a claim prior log-odds by the trust rank of its source and by when its row
was collected. Votes number at most one for each source, so all evidence lies within a finite bound; the prior of a rank, or of
a microsecond, is set beyond it, as the required result (TESTDATA.md, ``p3_found``) lets no number of votes outweigh a rank or
a later time. Claims equal in both are kept apart by the smaller id.

Defined results
---------------
* a field without a usable value has no row; unknown sources rank last; a null ``collected_at`` is earliest
* groups of one row have no rows; equal posteriors go to the smaller id
* a null source is a source of its own
"""

from __future__ import annotations

import functools
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import blank, folded_lower
from corpusmill.llm import canonical
from corpusmill.operators.timestamps import normalise_timestamps
from corpusmill.session import written

FIELDS = ["url_review", "factcheck_rating", "date_iso", "dataset_name"]
# What is typed where a value is missing, without accents, in lower case, without outer signs.
STAND_INS = ["", "none", "nan", "null", "n/a", "n/d", "na", "nd", "sem rating", "sem classificacao", "sem data", "sem link", "desconhecido", "desconhecida", "data desconhecida", "und", "xx", "unknown"]
#: Wrong values a field may take besides the right one, and the share of a copier's claims that are copied.
WRONG_VALUES, COPY_SHARE = 10, 0.8
#: Accuracies have settled when none moves by more than this; the rounds are bounded, as the estimate may swing between two states.
SETTLED, ROUNDS = 0.01, 4


def stand_in(c: Column) -> Column:
    """True for null, blank and stand-ins for a missing value; signs alone (``-``, ``??``) are stand-ins."""
    return blank(c) | F.regexp_replace(folded_lower(c), r"^[^\p{L}\p{N}★☆]+|[^\p{L}\p{N}★☆]+$", "").isin(STAND_INS)


def claims(main: DataFrame, registry: DataFrame, provenance: DataFrame) -> DataFrame:
    """``(grp, field, value, source, rid, trust_rank, collected_at)``: every usable value of every row that has copies."""
    members = canonical.membership(main.select("rid", "text_no_url"), "rid", "text_no_url").select(F.col("rid_first").alias("grp"), "rid").distinct()
    rows = main.select("rid", *FIELDS).join(members, "rid")
    reg = registry.groupBy("dataset_name").agg(F.min("trust_rank").alias("trust_rank"), F.first("home_tz", True).alias("home_tz"), F.first("date_order", True).alias("date_order"))
    rows = rows.join(reg, "dataset_name", "left")
    seen = provenance.select("rid", "collected_at").join(members.select("rid"), "rid", "left_semi").groupBy("rid").agg(F.max("collected_at").alias("collected_at"))
    rows = normalise_timestamps(rows.join(seen, "rid", "left"), "date_iso", "home_tz", "date_order", "__when")
    usable = {
        "url_review": F.col("url_review").rlike(r"(?i)^\s*https?://[^\s/?#]+\S*\s*$"),
        "factcheck_rating": ~stand_in(F.col("factcheck_rating")),
        "date_iso": ~F.col("__when_status").isin("blank", "invalid"),
        "dataset_name": F.col("dataset_name").isNotNull(),
    }
    # Values are compared in a normal form: an address without scheme, case and closing slash, a rating without case, accents and outer signs, a date as the day or instant it names.
    normal = {
        "url_review": F.regexp_replace(F.lower(F.trim("url_review")), r"^https?://(?:www\.)?|/+$", ""),
        "factcheck_rating": F.regexp_replace(folded_lower(F.col("factcheck_rating")), r"^[^\p{L}\p{N}★☆]+|[^\p{L}\p{N}★☆]+$", ""),
        "date_iso": F.col("__when"),
        "dataset_name": F.col("dataset_name"),
    }
    each = F.array(*[F.when(usable[f], F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.coalesce(normal[f], F.col(f)).alias("normal"))) for f in FIELDS])
    kept = rows.select("grp", "rid", F.coalesce("dataset_name", F.lit("")).alias("source"), F.coalesce("trust_rank", F.lit(UNRANKED)).alias("trust_rank"), "collected_at", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("c"))
    return kept.select("grp", "c.field", "c.value", "c.normal", "source", "rid", "trust_rank", "collected_at")


#: The rank of sources without one.
UNRANKED = 10_000
#: The least and the greatest accuracy, and the log-odds of a vote with them.
LOW, HIGH = 0.05, 0.99
_LEAST, _MOST = (math.log(WRONG_VALUES * a / (1 - a)) for a in (LOW, HIGH))
#: Where rows without a time stand, and more microseconds than any two times can lie apart.
_EARLIEST, _SPAN = -(10**17), 10**18


def _log_odds(acc: Column) -> Column:
    return F.log(WRONG_VALUES * acc / (1 - acc))


def _dependence(told: DataFrame, accuracy: DataFrame) -> DataFrame:
    """``(s1, s2, dep)``: how probably source ``s2``, the less accurate, copies ``s1``. Pairs are pairs of sources that share a value that lost."""
    wrong = told.where(~F.col("won")).select("gf", "normal", "source")
    shared = wrong.alias("a").join(wrong.alias("b"), ["gf", "normal"]).where("a.source < b.source")
    shared = shared.groupBy(F.col("a.source").alias("x"), F.col("b.source").alias("y")).agg(F.count(F.lit(1)).alias("kf"))
    lost = wrong.groupBy("source").agg(F.count(F.lit(1)).alias("nf")).join(accuracy, "source")
    pair = shared.join(lost.select(F.col("source").alias("x"), F.col("nf").alias("n1"), F.col("acc").alias("a1")), "x").join(lost.select(F.col("source").alias("y"), F.col("nf").alias("n2"), F.col("acc").alias("a2")), "y")
    # Independent sources agree on one of WRONG_VALUES by chance; copiers on COPY_SHARE of them.
    odds = F.col("kf") * F.log(F.lit(COPY_SHARE * WRONG_VALUES)) + (F.least("n1", "n2") - F.col("kf")) * F.log(F.lit((1 - COPY_SHARE) / (1 - 1 / WRONG_VALUES)))
    dep = 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), F.least(F.lit(50.0), odds - 2))))
    first = F.col("a1") >= F.col("a2")
    return pair.select(F.when(first, F.col("x")).otherwise(F.col("y")).alias("s1"), F.when(first, F.col("y")).otherwise(F.col("x")).alias("s2"), dep.alias("dep"))


def _told(c: DataFrame) -> tuple[DataFrame, list[str]]:
    """Claims by ``gf``, which numbers a group's field, and by the 64-bit digest of the value; and the fields' names."""
    fields = sorted(r[0] for r in c.select("field").distinct().collect())  # names of columns
    number = functools.reduce(lambda x, i: F.when(F.col("field") == fields[i], i).otherwise(x), range(len(fields)), F.lit(None).cast("int"))
    return c.withColumn("normal", F.xxhash64("normal")).withColumn("gf", F.col("grp") * max(len(fields), 1) + number), fields


def _named(df: DataFrame, fields: list[str]) -> DataFrame:
    """``gf`` as ``(grp, field)`` again."""
    k = max(len(fields), 1)
    name = F.get(F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>"), F.pmod("gf", F.lit(k)).cast("int"))
    return df.select(F.expr(f"(gf - pmod(gf, {k})) div {k}").alias("grp"), name.alias("field"), *[c for c in df.columns if c != "gf"])


def evidence(c: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``_evidence`` of claims, by group and field."""
    told, fields = _told(c)
    return _named(_evidence(told, rounds), fields)


def _evidence(c: DataFrame, rounds: int) -> DataFrame:
    """``(grp, field, normal, evidence, votes, posterior, rid)`` of each claimed value, ``normal`` being the digest of its normal form: its log-odds by discounted votes, and its posterior at an even prior.

    Claims collapse to one per source first, so a group of any size costs one row per source and value. Sources are as many as the
    registry names; their accuracies and pairs are what is estimated again each round.
    """
    # Values go by a 64-bit digest, which need only differ within one group and field; their texts stay behind.
    votes = written(c.groupBy("gf", "normal", "source").agg(F.min("trust_rank").alias("trust_rank"), F.min("rid").alias("rid")), "p3-votes")
    accuracy = votes.groupBy("source").agg(F.greatest(F.lit(0.55), F.lit(0.95) - 0.08 * (F.least(F.min("trust_rank"), F.lit(6)) - 1)).alias("acc"))
    accuracy = written(accuracy, "p3-accuracy")
    weights = votes.withColumn("w", F.lit(1.0))
    for left in range(rounds - 1, -1, -1):
        v = weights.join(accuracy, "source")
        score = v.groupBy("gf", "normal").agg(F.sum(F.col("w") * _log_odds(F.col("acc"))).alias("s"), F.sum("w").alias("votes"), F.min("rid").alias("rid"))
        total = score.groupBy("gf").agg(F.max("s").alias("m"), F.count(F.lit(1)).alias("k"), F.max_by("normal", F.struct("s", -F.col("rid"))).alias("top"))
        near = score.join(total, ["gf"]).withColumn("e", F.exp(F.col("s") - F.col("m")))
        norm = near.groupBy("gf").agg((F.sum("e") + F.greatest(WRONG_VALUES + 1 - F.max("k"), F.lit(0)) * F.exp(-F.max("m"))).alias("z"))
        # Each round is written, so that the next one's plan doesn't hold it several times over.
        post = near.join(norm, ["gf"]).select("gf", "normal", F.col("s").alias("evidence"), "votes", (F.col("e") / F.col("z")).alias("posterior"), "rid", (F.col("normal") == F.col("top")).alias("won"))
        post = written(post, "p3-posteriors")
        if not left:
            break
        told = votes.join(post.select("gf", "normal", "posterior", "won"), ["gf", "normal"])
        before = accuracy.withColumnRenamed("acc", "old")
        accuracy = told.groupBy("source").agg(F.greatest(F.lit(LOW), F.least(F.lit(HIGH), (F.sum("posterior") + 4) / (F.count(F.lit(1)) + 5))).alias("acc"))
        accuracy = written(accuracy, "p3-accuracy")
        if (before.join(accuracy, "source").agg(F.max(F.abs(F.col("acc") - F.col("old")))).first()[0] or 0.0) <= SETTLED:
            break
        dependent = written(_dependence(told, accuracy), "p3-dependence")
        both = votes.select("gf", "normal", F.col("source").alias("s1")).join(dependent, "s1").join(votes.select("gf", "normal", F.col("source").alias("s2")), ["gf", "normal", "s2"])
        discount = both.groupBy("gf", "normal", F.col("s2").alias("source")).agg(F.exp(F.sum(F.log(1 - COPY_SHARE * F.col("dep")))).alias("w"))
        weights = written(votes.join(discount, ["gf", "normal", "source"], "left").withColumn("w", F.coalesce("w", F.lit(1.0))), "p3-weights")
    return post


def fuse(c: DataFrame, prior: str = "ranked", rounds: int = ROUNDS, ties: str = "id") -> DataFrame:
    """``(grp, field, value, rid, posterior, votes)``: the claim of greatest posterior log-odds of each group and field."""
    c, fields = _told(c)
    e = _evidence(c, rounds)
    if prior == "even":
        # All claims of a value are alike: the value of greatest evidence, told by its first row.
        best = e.groupBy("gf").agg(F.max_by(F.struct("normal", "posterior", "votes", "rid"), F.struct("evidence", -F.col("rid"))).alias("b")).select("gf", "b.*")
        first = c.groupBy("gf", "normal").agg(F.min_by("value", "rid").alias("value"))
        return _named(best.join(first, ["gf", "normal"]).select("gf", "value", "rid", "posterior", "votes"), fields)
    # A value has at most one vote of each source: BEYOND of them exceed all differences of evidence there can be.
    beyond = math.ceil((_MOST - _LEAST) * c.select("source").distinct().count()) + 1
    when = F.coalesce(F.unix_micros(F.try_to_timestamp("collected_at")), F.lit(_EARLIEST)).cast("decimal(38,0)")
    prior_odds = ((when - F.col("trust_rank").cast("decimal(12,0)") * F.lit(Decimal(_SPAN))).cast("decimal(25,0)") * F.lit(Decimal(beyond))).cast("decimal(32,6)")
    # Of one value's claims the one of greatest prior; then values meet, with their evidence.
    of_value = c.withColumn("prior", prior_odds).groupBy("gf", "normal").agg(F.max_by(F.struct("value", "rid"), F.struct("prior", -F.col("rid"))).alias("c"), F.max("prior").alias("prior"))
    scored = of_value.join(e.drop("rid"), ["gf", "normal"]).withColumn("odds", F.col("prior") + F.col("evidence").cast("decimal(20,6)"))
    # Values whose rows share rank and time are told apart by the smaller id, as required, unless ``ties`` leaves them to their evidence.
    order = F.struct("odds", -F.col("c.rid")) if ties == "votes" else F.struct("prior", -F.col("c.rid"), "odds")
    best = scored.groupBy("gf").agg(F.max_by(F.struct("c", "posterior", "votes"), order).alias("b"))
    return _named(best.select("gf", "b.c.value", "b.c.rid", "b.posterior", "b.votes"), fields)


def found(main: DataFrame, registry: DataFrame, provenance: DataFrame) -> DataFrame:
    """``(rid_first, field, rid_from)``: the row whose value survives, per group of at least two rows and field."""
    c = written(claims(main, registry, provenance), "p3-claims")
    return fuse(c).select(F.col("grp").alias("rid_first"), "field", F.col("rid").alias("rid_from"))
