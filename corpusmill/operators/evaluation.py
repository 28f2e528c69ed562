"""Evaluation of scores against labels: one pass of sums, exact rank statistics, calibration tables.

``rows`` have ``y`` (0 or 1) and ``p`` (score of class 1) and any group columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.measures import wilson


def confusion(rows: DataFrame, groups: list[str], threshold: float = 0.5) -> DataFrame:
    """Counts, accuracy, F1 of class 1, macro F1 and Brier score per group; macro F1 and Brier are null where one class is missing."""
    hit = F.col("p") >= threshold
    y = F.col("y") == 1
    g = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos"), F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"), F.count_if(y & ~hit).alias("fn"), F.count_if(~y & ~hit).alias("tn"),
        F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"),
    )
    f1 = lambda a: F.coalesce(F.try_divide(2.0 * F.col(a), 2 * F.col(a) + F.col("fp") + F.col("fn")), F.lit(0.0))
    two = (F.col("pos") > 0) & (F.col("pos") < F.col("n"))
    return g.select(
        *groups, "n", "pos", F.least(F.col("pos"), F.col("n") - F.col("pos")).alias("minority"), ((F.col("tp") + F.col("tn")) / F.col("n")).alias("acc"), f1("tp").alias("f1"),
        F.when(two, (f1("tp") + f1("tn")) / 2).alias("macro_f1"), F.when(two, F.col("brier")).alias("brier"),
    )


#: Ranges of scores that are summed up apart.
RUNS = 64


def ranking(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Exact ROC area (ties count half) and average precision (a step for each distinct score) per group.

    Equal scores collapse to one row first. Running sums go over ``RUNS`` ranges of scores of like size: within each by a window, and over the
    ranges' totals by another, so no task orders all scores of a group.
    """
    at = rows.groupBy(*groups, "p").agg(F.sum("y").cast("bigint").alias("pos"), (F.count(F.lit(1)) - F.sum("y")).cast("bigint").alias("neg"))
    cuts = [c for c in at.approxQuantile("p", [i / RUNS for i in range(1, RUNS)], 0.25 / RUNS) if c is not None]
    run = F.aggregate(F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>"), F.lit(0), lambda k, c: k + (F.col("p") >= c).cast("int"))
    at = at.withColumn("run", run)
    runs = at.groupBy(*groups, "run").agg(F.sum("pos").alias("rp"), F.sum("neg").alias("rn"))
    up, down = Window.partitionBy(*groups).orderBy("run").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*groups).orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    sums = {"n_below": F.sum("rn").over(up), "p_above": F.sum("rp").over(down), "n_above": F.sum("rn").over(down)}
    runs = runs.select(*[F.col(g).alias("__" + g) for g in groups], F.col("run").alias("__run"), *[F.coalesce(c, F.lit(0)).alias(k) for k, c in sums.items()])
    same = F.col("run") == F.col("__run")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col("__" + g))
    at = at.join(runs, same).drop("__run", *["__" + g for g in groups])
    below = Window.partitionBy(*groups, "run").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*groups, "run").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, 0)
    w = at.withColumn("under", F.col("n_below") + F.coalesce(F.sum("neg").over(below), F.lit(0))).withColumn("tp", F.col("p_above") + F.sum("pos").over(above))
    w = w.withColumn("all", F.col("p_above") + F.col("n_above") + F.sum(F.col("pos") + F.col("neg")).over(above))
    g = w.groupBy(*groups).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum(F.col("pos") * (F.col("under") + F.col("neg") / 2)).alias("u"), F.sum(F.col("pos") * F.col("tp") / F.col("all")).alias("s"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return g.select(*groups, F.when(both, F.try_divide(F.col("u"), F.col("P") * F.col("N"))).alias("roc_auc"), F.when(both, F.try_divide(F.col("s"), F.col("P"))).alias("avg_precision"))


def calibration_error(rows: DataFrame, groups: list[str], bins: int = 15) -> DataFrame:
    """Expected calibration error over equal bins of the predicted class's confidence, closed at the right."""
    hit = F.col("p") >= 0.5
    conf = F.when(hit, F.col("p")).otherwise(1 - F.col("p"))
    b = rows.select(*groups, F.ceil(conf * bins).alias("bin"), conf.alias("conf"), (hit.cast("int") == F.col("y")).cast("int").alias("ok"))
    b = b.groupBy(*groups, "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("ok").alias("ok"), F.sum("conf").alias("conf"))
    return b.groupBy(*groups).agg((F.sum(F.abs(F.col("ok") - F.col("conf"))) / F.sum("n")).alias("ece"))


def reliability(rows: DataFrame, bins: int = 10) -> DataFrame:
    """``(bin, n, mean_score, mean_label)``; the first bin is closed at both ends."""
    b = rows.groupBy(F.greatest(F.ceil(F.col("p") * bins), F.lit(1)).cast("int").alias("bin"))
    return b.agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_score"), F.avg("y").alias("mean_label"))


def per_group(rows: DataFrame, group: str, least: int = 30, trusted: int = 100, minority: int = 20) -> DataFrame:
    """All measures per group of at least ``least`` rows; ``reliable`` marks those large enough to be compared."""
    m = confusion(rows, [group]).where(F.col("n") >= least)
    for other in (ranking(rows, [group]), calibration_error(rows, [group])):
        o = other.withColumnRenamed(group, "__g")
        m = m.join(o, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")
    return m.withColumn("reliable", (F.col("n") >= trusted) & (F.col("minority") >= minority))


def worst_group(rows: DataFrame, group: str, **limits: int) -> DataFrame:
    """One row: the least macro F1 of the reliable groups; null if there is none."""
    return per_group(rows, group, **limits).where("reliable AND macro_f1 IS NOT NULL").agg(F.min("macro_f1").alias("worst_macro_f1"), F.count(F.lit(1)).alias("groups"))


def slices(rows: DataFrame, keys: list[str], least: int = 30) -> DataFrame:
    """Accuracy with Wilson's interval per slice of at least ``least`` rows; several keys are joined by a bar."""
    name = F.concat_ws(" | ", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    ok = ((F.col("p") >= 0.5).cast("int") == F.col("y")).cast("int")
    g = rows.groupBy(name.alias("slice")).agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.sum(ok).alias("k")).where(F.col("n") >= least)
    lo, hi = wilson(F.col("k"), F.col("n"))
    return g.select("slice", "n", "mean", (F.col("k") / F.col("n")).alias("acc"), lo.alias("low"), hi.alias("high"))


def confident_errors(rows: DataFrame, group: str, key: str, k: int = 40) -> DataFrame:
    """The ``k`` most confident errors of each group."""
    from corpusmill.operators.ordering import top_per_key

    wrong = rows.where((F.col("p") >= 0.5).cast("int") != F.col("y")).withColumn("sure", F.abs(F.col("p") - 0.5))
    return top_per_key(wrong, [group], [F.desc("sure"), F.asc(key)], k)


def platt(p: Column, a: float, b: float) -> Column:
    from corpusmill.functions.measures import sigmoid

    return sigmoid(a * p + b)


def fit_temperature(rows: DataFrame, grid: int = 120, rounds: int = 4) -> float:
    """The temperature of least mean log loss of ``z`` (difference of two logits) against ``y``.

    A logarithmic grid, refined around its best point; each round is one aggregation over all rows.
    """
    import numpy as np

    lo, hi = 0.05, 50.0
    for _ in range(rounds):
        points = np.geomspace(lo, hi, grid)
        sign = F.when(F.col("y") == 1, -F.col("z")).otherwise(F.col("z"))
        # log(1 + exp(x)) without overflow
        loss = lambda t: F.avg(F.greatest(sign / t, F.lit(0.0)) + F.log1p(F.exp(-F.abs(sign / t))))
        got = rows.agg(*[loss(float(t)).alias(f"t{i}") for i, t in enumerate(points)]).first()
        i = int(np.argmin([got[k] for k in range(grid)]))
        lo, hi = float(points[max(i - 1, 0)]), float(points[min(i + 1, grid - 1)])
    return (lo * hi) ** 0.5


def fit_platt(rows: DataFrame, rounds: int = 25) -> tuple[float, float]:
    """``(a, b)`` of ``sigmoid(a * z + b)`` by maximum likelihood: Newton steps, each one aggregation over all rows."""
    from corpusmill.functions.measures import sigmoid

    a, b = 1.0, 0.0
    ends = rows.agg(F.min("y"), F.max("y")).first()
    if ends[0] == ends[1]:
        return 1.0, 0.0
    for _ in range(rounds):
        q = sigmoid(a * F.col("z") + b)
        r, v = F.col("y") - q, q * (1 - q)
        s = rows.agg(F.sum(r * F.col("z")), F.sum(r), F.sum(v * F.col("z") * F.col("z")), F.sum(v * F.col("z")), F.sum(v)).first()
        det = s[2] * s[4] - s[3] * s[3]
        if not det:
            break
        da, db = (s[4] * s[0] - s[3] * s[1]) / det, (s[2] * s[1] - s[3] * s[0]) / det
        a, b = a + da, b + db
        if abs(da) + abs(db) < 1e-10:
            break
    return a, b


def report(rows: DataFrame, group: str, least: int = 20, least_dialect: int = 30) -> DataFrame:
    """``(section, n, pos, acc, f1, macro_f1, brier, roc_auc, avg_precision, ece)`` of all rows and of their parts.

    Sections: ``global``; ``balanced`` (``is_balanced_group``); ``hard`` and ``pure`` by ``rating_class``, of at least ``least`` rows; ``ptpt`` and
    ``rest`` by ``is_ptpt``, if both have at least ``least_dialect``; and the least macro F1 of reliable groups as ``worst_group`` and
    ``worst_group_balanced``. A row is told its sections once, so all come from one pass of each measure.
    """
    marks = {"global": F.lit(True), "balanced": F.col("is_balanced_group"), "hard": F.col("rating_class") == "hard", "pure": F.col("rating_class") == "false_pure", "ptpt": F.col("is_ptpt"), "rest": ~F.col("is_ptpt")}
    told = rows.select("y", "p", F.explode(F.array_compact(F.array(*[F.when(c, k) for k, c in marks.items()]))).alias("section"))
    m = confusion(told, ["section"])
    for other in (ranking(told, ["section"]), calibration_error(told, ["section"])):
        m = m.join(other, "section", "left")
    # Sections are six at most.
    dialects = m.agg(F.min(F.when(F.col("section").isin("ptpt", "rest"), F.col("n"))).alias("few"), F.count_if(F.col("section").isin("ptpt", "rest")).alias("both"))
    m = m.join(F.broadcast(dialects)).where(F.when(F.col("section").isin("hard", "pure"), F.col("n") >= least).when(F.col("section").isin("ptpt", "rest"), (F.col("both") == 2) & (F.col("few") >= least_dialect)).otherwise(True))
    m = m.select("section", "n", "pos", "acc", "f1", "macro_f1", "brier", "roc_auc", "avg_precision", "ece")
    for name, part in (("worst_group", rows), ("worst_group_balanced", rows.where("is_balanced_group"))):
        worst = worst_group(part, group).select(F.lit(name).alias("section"), F.col("groups").alias("n"), F.col("worst_macro_f1").alias("macro_f1"))
        m = m.unionByName(worst, allowMissingColumns=True)
    return m


def contradictions(rows: DataFrame) -> DataFrame:
    """Rows whose rating class says the opposite of their label: plainly false and ``true``, or true and ``fake``."""
    return rows.where(((F.col("rating_class") == "false_pure") & (F.col("label") == "true")) | ((F.col("rating_class") == "true_rating") & (F.col("label") == "fake")))


def side_by_side(rows: DataFrame, keys: list[str], models: list[str], least: int = 30) -> DataFrame:
    """``(slice, model, n, mean, acc, low, high)``: several score columns over the same slices."""
    long = rows.unpivot(["y", *keys], models, "model", "p")
    got = slices(long.withColumn("__slice", F.concat_ws(" | ", *keys)), ["model", "__slice"], least)
    at = F.locate(" | ", F.col("slice"))
    return got.select(F.col("slice").substr(at + 3, F.length("slice")).alias("slice"), F.col("slice").substr(F.lit(1), at - 1).alias("model"), "n", "mean", "acc", "low", "high")
