import pytest
from pyspark.sql import functions as F

from corpusmill.functions import vocabulary as V
from corpusmill.operators import cleaning, evaluation, merging
from corpusmill.sources.readers import MAIN_TYPES


def table(spark, rows):
    df = spark.createDataFrame(rows, "rid bigint, dataset_name string, label string, date_iso string, text string, word_len int")
    return cleaning.with_contract_columns(df.withColumn("text_no_url", F.col("text")), MAIN_TYPES)


def words(seed, n=30):
    return " ".join(f"{seed}{i}" for i in range(n))


def test_merge_keeps_the_base_and_reports_every_drop(spark):
    base = table(spark, [(1, "A", "fake", "2017-01-01", words("a"), 30), (2, "A", "true", None, None, 0)])
    new = table(spark, [
        (1, "FC_X", "fake", "2019-01-01", words("q"), 30), (10, "FC_X", "fake", "2019-01-01", words("b"), 30), (11, "FC_X", "odd", "2019-01-01", words("c"), 30), (12, "FC_X", "fake", "2019-01-01", " ", 30), (13, "FC_X", "fake", "2019-01-01", words("d", 2), 2),
        (14, "FC_X", "fake", "2019-01-01", words("a").upper(), 30), (15, "FC_X", "true", "2018-06-01", words("b") + " z", 31), (20, "NEWS_N", "true", "2019-01-01", words("n"), 30), (21, "NEWS_N", "true", "2019-01-01", words("m"), 30), (22, "NEWS_N", "true", "2019-01-01", words("o"), 30),
    ])
    prov = spark.createDataFrame([(10, "rating"), (15, "provenance"), (20, "provenance"), (99, "rating")], "rid bigint, label_source string")
    t, p, decisions = merging.merge(base, new, prov, ratio=0.5)
    merging.check_merge(t, base)
    got = {(r["part"], r["rid"]) for r in t.collect()}
    assert {("base", 1), ("base", 2), ("new", 10)} <= got and ("new", 15) not in got and ("new", 14) not in got
    assert sum(1 for part, rid in got if rid >= 20) == 1
    assert {r["rid"]: r["reason"] for r in decisions.where("rid IN (14, 15)").collect()} == {14: "dup_base_exact", 15: "dup_new_near"}
    assert {r["rid"] for r in p.collect()} <= {10, 20}
    with pytest.raises(merging.IntegrityError):
        merging.check_merge(t.where("rid <> 1"), base)
    with pytest.raises(merging.IntegrityError):
        merging.check_merge(t.unionByName(t.where("rid = 10")), base)
    with pytest.raises(merging.IntegrityError):
        merging.require_matches(t, base, "rid")
    merging.require_matches(base, t, "rid")
    assert t.columns == [*V.COLUMNS, "part"]
    assert merging.merge(base, new.limit(0), prov)[0].count() == 2


def test_models_on_the_same_slices(spark):
    rows = spark.createDataFrame([(i % 2, 0.9 if i % 2 else 0.1, 0.5, "k") for i in range(40)], "y int, good double, coin double, g string")
    got = {r["model"]: r["acc"] for r in evaluation.side_by_side(rows, ["g"], ["good", "coin"]).collect()}
    assert got == {"good": 1.0, "coin": 0.5}
