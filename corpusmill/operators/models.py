"""Features, similarity and linear models over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.operators import grams
from corpusmill.session import shuffles_dropped


def char_grams(text: Column, sizes: tuple[int, ...] = (4, 5)) -> Column:
    """Character n-grams within words padded by a space on either side, repeats kept."""

    def of_size(w: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), lambda i: F.substr(w, i, F.lit(n)))

    def of_word(w: Column) -> Column:
        return F.concat(*[of_size(w, n) for n in sizes])

    return F.flatten(F.transform(F.filter(F.split(T.norm_for_similarity(text), " "), lambda w: w != ""), lambda w: of_word(F.concat(F.lit(" "), w, F.lit(" ")))))


def tfidf(rows: DataFrame, key: str, grams: Column, least_df: int = 2, fitted: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(key, gram, w)`` with sublinear counts, smoothed inverse document frequency and unit length, and the ``(gram, idf)`` it used."""
    tf = rows.select(key, F.explode(grams).alias("gram")).groupBy(key, "gram").agg(F.count(F.lit(1)).alias("tf"))
    if fitted is None:
        n = rows.agg(F.count(F.lit(1)).alias("n"))
        df = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least_df)
        fitted = df.join(F.broadcast(n)).select("gram", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))
    w = tf.join(fitted, "gram").select(key, "gram", ((1 + F.log("tf")) * F.col("idf")).alias("w"))
    norm = w.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len")).withColumnRenamed(key, "__k")
    return w.join(norm, w[key] == norm["__k"]).select(key, "gram", (F.col("w") / F.col("len")).alias("w")), fitted


def most_similar(queries: DataFrame, rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(query_id, nearest_id, sim)``: the row of greatest TF-IDF cosine other than the query itself; ties go to the smaller id.

    Exact: the products of shared grams are summed, within tasks (``grams.best``). Rows without grams, and queries that share none, are absent.
    """
    with shuffles_dropped(rows.sparkSession):
        r = grams.whole(rows, key, F.col(text))
        q = grams.whole(queries, key, F.col(text))
        fitted = grams.fit(r, rows.agg(F.count(F.lit(1)).alias("n")))
    pairs = grams.compared(q, r, fitted, grams.best)
    return pairs.groupBy("query_id").agg(F.max(F.struct("sim", (-F.col("id")).alias("n"))).alias("b")).select("query_id", (-F.col("b.n")).alias("nearest_id"), "b.sim")


def similar_above(queries: DataFrame, rows: DataFrame, key: str, text: str, threshold: float = 0.9, fitted: DataFrame | None = None) -> DataFrame:
    """``(query_id, key, sim)``: every pair of a query and a row of at least ``threshold`` TF-IDF cosine, grams weighed as in ``rows`` or as ``(gram, idf)`` in ``fitted``.

    Pairs that can reach it are found by their rarest grams and summed up exactly, within tasks (``grams.above``).
    """
    with shuffles_dropped(rows.sparkSession):
        r = grams.whole(rows, key, F.col(text))
        q = grams.whole(queries, key, F.col(text))
        fitted = grams.fit(r, rows.agg(F.count(F.lit(1)).alias("n"))) if fitted is None else grams.known(fitted)
    return grams.compared(q, r, fitted, grams.above(threshold), blocks=4).withColumnRenamed("id", key)


def leakage(split: DataFrame, key: str, text: str, group: str, threshold: float = 0.9) -> DataFrame:
    """``(group, n, near, share)``: how many ``test`` rows of each group have a row of ``train`` of at least ``threshold`` cosine."""
    test = split.where("split = 'test'")
    near = similar_above(test, split.where("split = 'train'"), key, text, threshold).select(F.col("query_id").alias(key)).distinct().withColumn("near", F.lit(1))
    g = test.select(key, group).join(near, key, "left").groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count("near").alias("near"))
    return g.withColumn("share", F.col("near") / F.col("n"))


def head_variants(train: DataFrame, val: DataFrame, test: DataFrame, features: list[str], group: str, strengths: tuple[float, ...] = (0.003, 0.01, 0.03, 0.1, 0.3, 1.0), vector: str | None = None) -> DataFrame:
    """``(variant, strength, selected_by, score, acc, macro_f1)`` of two heads over six strengths, judged on ``test``.

    ``erm`` is fitted on all rows and chosen by macro F1; ``dfr`` on the rows of balanced groups, every cell of group and class weighing the same,
    and chosen by the worst group's macro F1. Rows have ``y``, ``is_balanced_group`` and the group.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from corpusmill.operators import evaluation, sampling

    balanced = sampling.cell_weights(train.where("is_balanced_group"), group, "y")
    fits = {"erm": (train, val, None, None), "dfr": (balanced, val.where("is_balanced_group"), "weight", group)}
    out = []
    for name, (rows, judged, weight, by) in fits.items():
        if rows.isEmpty() or judged.isEmpty():
            continue
        model, strength, score = fit_head(rows, judged, features, strengths, weight=weight, vector=vector, group=by)
        ready = test.withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double")))) if vector else test
        p = model.transform(ready).select("y", vector_to_array("probability")[1].alias("p"))
        m = evaluation.confusion(p, []).first()
        out.append((name, strength, "worst_group" if by else "macro_f1", float(score), m["acc"], m["macro_f1"]))
    return train.sparkSession.createDataFrame(out, "variant string, strength double, selected_by string, score double, acc double, macro_f1 double")


def fit_head(train: DataFrame, val: DataFrame, features: list[str], strengths: tuple[float, ...] = (0.01, 0.1, 1.0, 10.0), weight: str | None = None, vector: str | None = None, group: str | None = None):
    """A logistic head on standardised features, chosen by macro F1 (or the worst group's) on ``val``: ``(model, strength, score)``.

    ``train`` and ``val`` have ``y``, the ``features`` and optionally an array ``vector`` and a ``weight``. A strength is the inverse
    of the penalty on the sum of losses, as usual for this model.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from corpusmill.operators import evaluation

    def ready(df: DataFrame) -> DataFrame:
        return df.withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double")))) if vector else df

    train, val = ready(train).cache(), ready(val).cache()
    try:
        total = train.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0] or 1.0
        best = None
        for c in strengths:
            lr = LogisticRegression(featuresCol="scaled", labelCol="y", regParam=1.0 / (c * total), standardization=False, maxIter=100)
            lr = lr.setWeightCol(weight) if weight else lr
            stages = [VectorAssembler(inputCols=features + (["__v"] if vector else []), outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="scaled", withMean=True), lr]
            model = Pipeline(stages=stages).fit(train)
            p = model.transform(val).withColumn("p", vector_to_array("probability")[1])
            if group:
                score = evaluation.per_group(p.select("y", "p", group), group, least=1).where("macro_f1 IS NOT NULL").agg(F.min("macro_f1")).first()[0]
            else:
                score = evaluation.confusion(p.select("y", "p"), []).first()["macro_f1"]
            if best is None or (score or 0.0) > best[2]:
                best = (model, c, score or 0.0)
        return best
    finally:
        train.unpersist()
        val.unpersist()


def text_baseline(rows: DataFrame, text: str, stop: list[str] | None = None, size: int = 5000, top: int = 20, held_out: DataFrame | None = None):
    """Word 1- and 2-gram TF-IDF with a class-balanced logistic model: ``(model, table of the strongest terms and their weights)``.

    ``rows`` has ``y``. The table has the ``top`` terms of each class: positive weights speak for class 1, negative ones for 0. With
    ``held_out`` rows a third part follows, their ``(accuracy, f1)``. The vocabulary's ``size`` bounds what the driver holds.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
    from pyspark.ml.functions import vector_to_array

    from corpusmill.operators import evaluation

    words = F.filter(F.split(T.normalize_text(F.col(text)), " "), lambda w: (F.length(w) > 1) & ~w.isin(stop or [""]))
    pairs = T.bound(words, lambda w: F.concat(w, F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))))
    share = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    share = share.join(F.broadcast(share.agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("k")))).select("y", (F.col("all") / (F.col("k") * F.col("n"))).alias("weight"))
    x = rows.join(F.broadcast(share), "y").withColumn("terms", pairs)
    counts = CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=size, minDF=2).fit(x)
    x = counts.transform(x)
    idf, unit = IDF(inputCol="tf", outputCol="tfidf").fit(x), Normalizer(inputCol="tfidf", outputCol="features")
    x = unit.transform(idf.transform(x))
    # The usual strength of 1: the penalty is that on the sum of losses.
    model = LogisticRegression(featuresCol="features", labelCol="y", weightCol="weight", regParam=1.0 / max(1, rows.count())).fit(x)
    ranked = sorted(zip(counts.vocabulary, map(float, model.coefficients.toArray()), strict=True), key=lambda t: (-abs(t[1]), t[0]))
    ranked = [t for t in ranked if t[1] > 0][:top] + [t for t in ranked if t[1] < 0][:top]
    terms = rows.sparkSession.createDataFrame(ranked, "term string, weight double")
    if held_out is None:
        return model, terms
    scored = model.transform(unit.transform(idf.transform(counts.transform(held_out.withColumn("terms", pairs)))))
    score = evaluation.confusion(scored.select("y", vector_to_array("probability")[1].alias("p")), []).first()
    return model, terms, (score["acc"], score["f1"])
