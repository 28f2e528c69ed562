import random

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import measures as M
from corpusmill.functions import text as T
from corpusmill.operators import cleaning, evaluation, grams, linkage, models, near_duplicates, nearest, ordering, sampling


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, want",
    [("FALSO: texto", "false_pure"), ("Verdadeiro - texto", "true_rating"), ("Verdadeiro, mas falta", "hard"), ("Enganosíssimo", "hard"), ("", "other"), (None, "other"), ("Ainda é cedo", "other"), ("certeiro", "true_rating")],
)
def test_rating_class(spark, raw, want):
    assert one(spark, T.rating_class, raw) == want


def test_text_functions(spark):
    assert one(spark, T.normalize_text, "  Ção—É 1,5! ") == "cao e 1 5"
    assert one(spark, T.normalize_text, None) == ""
    assert one(spark, T.text_no_url, " a https://x.y/z b www.q.r ") == "a  b"
    assert one(spark, T.text_clean, '"Olá  😱 Mundo"') == "ola mundo"
    assert one(spark, T.text_clean, '"') == '"'
    assert one(spark, T.numbers, "a segunda de 7 e 007") == [2, 7]
    assert one(spark, T.title_verdict, "É falso que choveu, é verdade") == "fake"
    assert one(spark, T.domain, "HTTPS://www.Site.com/x") == "site.com"
    assert one(spark, T.domain, None) == "sem_url"
    assert one(spark, T.html_text, "<script>x</script><p>a&amp;b</p>") == "a&b"
    assert one(spark, T.shingles, None) == []
    assert one(spark, T.shingles, "abc") == ["abc"]
    assert one(spark, T.shingles, "ab cd ef") == ["abcde", "bcdef"]
    assert len(one(spark, T.shingles, " ".join(f"w{i}" for i in range(5000)))) == 4998
    assert one(spark, T.first_sentence, "Uma frase bem comprida aqui. Outra.") == "Uma frase bem comprida aqui"
    assert one(spark, T.last_part, "abc conclusão: fim") == "conclusão: fim"
    assert one(spark, T.claim_like, "O prefeito anunciou a obra nova ontem") is True
    assert one(spark, T.claim_like, "O prefeito anunciou a obra nova ontem?") is False


def test_measures_of_empty_sets(spark):
    r = spark.range(1).select(
        M.jaccard(F.array().cast("array<int>"), F.array().cast("array<int>")).alias("a"), M.jaccard(F.array(F.lit(1)), F.array().cast("array<int>")).alias("b"),
        M.overlap(F.array(F.lit(1)), F.array().cast("array<int>")).alias("c"), M.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("d"),
    ).first()
    assert tuple(r) == (1.0, 0.0, 0.0, 0.0)


def test_numbered_ranks_each_group_without_gaps(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else "g" if i % 3 else "h") for i in range(2000)], "rid bigint, g string")
    got = ordering.numbered(rows, ["g"], ordering.hashed(F.col("rid"))).collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["rank"], r["size"]))
    assert len(got) == 2000
    for v in by.values():
        assert sorted(x for x, _ in v) == list(range(1, len(v) + 1)) and {n for _, n in v} == {len(v)}


def test_quota_split_and_resample_on_empty_tables(spark):
    empty = spark.createDataFrame([], "rid bigint, dataset_name string, label string, date_iso string")
    assert sampling.era_quota(empty, 1.0).count() == 0
    assert sampling.stratified_split(empty, "dataset_name", "label", "rid").count() == 0
    assert sampling.equal_cells(empty, "dataset_name", "label", "rid").count() == 0
    assert sampling.cell_weights(empty, "dataset_name", "label").count() == 0
    few = spark.createDataFrame([(1, None, None, None)], empty.schema)
    assert sampling.stratified_split(few, "dataset_name", "label", "rid").first()["split"] == "test"


def test_link_claims_against_brute_force(spark):
    r = random.Random(3)
    vocab = [f"palavra{i}" for i in range(40)]
    texts = [(i, " ".join(r.sample(vocab, r.randint(2, 9)))) for i in range(120)] + [(900, None), (901, "")]
    claims = [(i, " ".join(r.sample(vocab, r.randint(2, 9)))) for i in range(150)] + [(800, texts[0][1]), (801, texts[0][1]), (802, None)]
    got = {x["rid"]: (x["claim_id"], round(x["score"], 9)) for x in linkage.link_claims(spark.createDataFrame(texts, "rid bigint, text string"), spark.createDataFrame(claims, "claim_id bigint, claim string"), 0.6).collect()}
    want = {}
    for rid, t in texts:
        same = [c for c, x in claims if x == t and t]
        if same:
            want[rid] = (min(same), 1.0)
            continue
        best = []
        for c, x in claims:
            a, b = set((t or "").split()), set((x or "").split())
            if len(a & b) >= 2 and len(a & b) / min(len(a), len(b)) >= 0.6:
                best.append((-len(a & b) / min(len(a), len(b)), c))
        if best:
            want[rid] = (min(best)[1], round(-min(best)[0], 9))
    assert got == want


def test_link_all_gives_every_link(spark):
    texts = spark.createDataFrame([(1, "onze dois tres quatro cinco"), (2, "Sozinho!"), (3, "nada em comum"), (4, None), (5, "...")], "rid bigint, text string")
    claims = [(10, "onze dois tres quatro cinco."), (11, "onze dois tres quatro cinco seis"), (12, "onze dois tres outro novo"), (13, "onze dois outro novo mais"), (14, "sozinho"), (15, "sozinho"), (16, None), (17, "...")]
    got = {(r["rid"], r["claim_id"], round(r["score"], 3)) for r in linkage.link_all(texts, spark.createDataFrame(claims, "claim_id bigint, claim string"), 0.6).collect()}
    assert got == {(1, 10, 1.0), (1, 11, 1.0), (1, 12, 0.6), (2, 14, 1.0), (2, 15, 1.0)}


def test_overlapping_sets_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    common, rare = [f"comum{i}" for i in range(12)], [f"raro{i}" for i in range(300)]
    one = lambda: (set(r.sample(common, r.randint(0, 12)) + r.sample(rare, r.randint(0, 6))), set(r.sample("abcdef", r.randint(0, 4))), set(r.sample(range(9), r.randint(0, 2))))
    texts, claims = [(i, *one()) for i in range(150)], [(i, *one()) for i in range(200)]
    frame = lambda rows, key: spark.createDataFrame([(k, *map(list, s)) for k, *s in rows], f"{key} bigint, t array<string>, w array<string>, nums array<bigint>").select(key, linkage.hashed_set(F.col("t")).alias("toks"), linkage.hashed_set(F.col("w")).alias("wide"), "nums")
    q, c = frame(texts, "rid"), frame(claims, "claim_id")
    monkeypatch.setattr(linkage, "CELLS", 500)
    monkeypatch.setattr(linkage, "BLOCK", 40)
    monkeypatch.setattr(linkage, "CHUNK", 30)
    monkeypatch.setattr(linkage, "RARE", 2)
    share = lambda a, b: len(a & b) / max(1, min(len(a), len(b)))
    near = {(i, j): round(share(a, b), 9) for i, a, *_ in texts for j, b, *_ in claims if len(a & b) >= 3 and share(a, b) >= 0.6}
    df = linkage.overlapping(q.select("rid", "toks"), c.select("claim_id", "toks"), 0.6, 3)
    assert {(x["rid"], x["claim_id"]): round(x["score"], 9) for x in df.collect()} == near and len(near) > 1000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan  # candidates are shuffled nowhere
    both = {(i, j): round(share(w, x), 9) for i, a, w, n in texts for j, b, x, m in claims if (i, j) in near and len(w & x) >= 2 and share(w, x) >= 0.6 and (not n or n & m)}
    assert {(x["rid"], x["claim_id"]): round(x["wide"], 9) for x in linkage.overlapping(q, c, 0.6, 3).collect()} == both and both
    assert linkage.overlapping(q.limit(0), c, 0.6).count() == 0 and linkage.overlapping(q, c.limit(0), 0.6).count() == 0


def test_near_duplicates_keep_a_chain_whose_middle_is_dropped(spark):
    w = [f"w{i}" for i in range(60)]
    a, b, c = w[:50], w[3:53], w[6:56]
    base = spark.createDataFrame([(99, "base " + " ".join(f"q{i}" for i in range(30)))], "rid bigint, text_no_url string")
    rows = [(1, "2020-01-01", " ".join(a)), (2, "2020-01-02", " ".join(b)), (3, "2020-01-03", " ".join(c)), (4, "2020-01-04", " ".join(a)), (5, None, None), (6, None, ""), (7, "2019-01-01", "Base! " + " ".join(f"q{i}" for i in range(30)))]
    new = spark.createDataFrame(rows, "rid bigint, date_iso string, text_no_url string")
    got = {r["rid"]: r["reason"] for r in near_duplicates.deduplicate(new, base, threshold=0.8).collect()}
    assert got == {1: None, 2: "dup_new_near", 3: None, 4: "dup_new_near", 5: None, 6: None, 7: "dup_base_exact"}
    assert {r["reason"] for r in near_duplicates.deduplicate(new, base, near=False).collect()} == {None, "dup_base_exact"}
    assert near_duplicates.deduplicate(new.limit(0), base).count() == 0
    assert near_duplicates.deduplicate(new, base.limit(0), threshold=0.8).where("reason IS NULL").count() == 5


def test_nearest_against_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 8))
    v[5] = 0
    rows = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(200)] + [(999, None)], "id bigint, v array<double>")
    got = {r["query_id"]: r["nearest_id"] for r in nearest.nearest(rows.where("id % 10 = 0"), rows, "id", "v").collect()}
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    s = u @ u.T
    np.fill_diagonal(s, -np.inf)
    assert got == {i: int(s[i].argmax()) for i in range(0, 200, 10)}


def test_metrics_against_plain_python(spark):
    r = random.Random(4)
    data = [(r.choice("ab"), r.randint(0, 1), round(r.random(), 2)) for _ in range(400)] + [("one", 1, 0.3)] * 30
    rows = spark.createDataFrame(data, "g string, y int, p double")
    auc = {x["g"]: x["roc_auc"] for x in evaluation.ranking(rows, ["g"]).collect()}
    for g in "ab":
        pos, neg = [p for k, y, p in data if k == g and y], [p for k, y, p in data if k == g and not y]
        want = sum((x > z) + 0.5 * (x == z) for x in pos for z in neg) / (len(pos) * len(neg))
        assert auc[g] == pytest.approx(want)
    assert auc["one"] is None
    m = {x["g"]: x for x in evaluation.per_group(rows, "g").collect()}
    assert m["one"]["macro_f1"] is None and not m["one"]["reliable"] and m["a"]["n"] + m["b"]["n"] == 400
    assert evaluation.worst_group(rows.limit(0), "g").first()["worst_macro_f1"] is None


def test_calibration_recovers_its_parameters(spark):
    import math

    r = random.Random(2)
    data = []
    for _ in range(4000):
        z = r.gauss(0, 2)
        data.append((int(r.random() < 1 / (1 + math.exp(-(0.5 * z - 0.4)))), z))
    rows = spark.createDataFrame(data, "y int, z double").cache()
    a, b = evaluation.fit_platt(rows)
    assert abs(a - 0.5) < 0.1 and abs(b + 0.4) < 0.1
    assert 1.2 < evaluation.fit_temperature(rows) < 4


def test_cleaning_defines_nulls_and_ties(spark):
    cols = "rid bigint, text_clean string, label string, dataset_name string, url_review string, factcheck_rating string, factcheck_claimant string, date_iso string, source_type string, text string, char_len int, word_len int, num_exclamations int, num_questions int, num_ellipsis int, uppercase_word_ratio double"
    row = lambda rid, clean, label, url=None: (rid, clean, label, "d", url, None, None, None, "news", "A B! ...", 0, 0, 0, 0, 0, 0.0)
    df = spark.createDataFrame([row(1, "x", "fake"), row(2, "x", "true"), row(3, "y", "fake"), row(4, "y", "fake", "http://a"), row(5, None, "fake"), row(6, None, "true")], cols)
    assert [r["rid"] for r in cleaning.sanitize(df).orderBy("rid").collect()] == [4, 5]
    assert cleaning.conflicting_texts(df).count() == 1
    assert cleaning.sanitize(df.limit(0)).count() == 0
    assert cleaning.sanitize(df).columns == df.columns


def test_written_tables_are_released(spark):
    from corpusmill import session

    df = session.written(spark.range(3), "x")
    assert df.count() == 3 and session.work_dir(spark) in df.inputFiles()[0].replace("file:///", "file:///")
    session.release(spark)
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(session.work_dir(spark) + "/*").count()


def test_report_sections_and_contradictions(spark):
    rows = [(i, i % 2, (0.9 if i % 2 else 0.1) if i % 10 else 0.5, "AB"[i % 4 // 2], i % 4 < 2, ("hard", "false_pure", "other")[i % 3], i % 5 == 0, "fake" if i % 2 else "true") for i in range(400)]
    df = spark.createDataFrame(rows, "rid bigint, y int, p double, g string, is_balanced_group boolean, rating_class string, is_ptpt boolean, label string")
    got = {r["section"]: r for r in evaluation.report(df, "g").collect()}
    assert set(got) == {"global", "balanced", "hard", "pure", "ptpt", "rest", "worst_group", "worst_group_balanced"}
    for k, keep in {"global": lambda r: True, "balanced": lambda r: r[4], "hard": lambda r: r[5] == "hard", "ptpt": lambda r: r[6]}.items():
        part = [r for r in rows if keep(r)]
        assert got[k]["n"] == len(part) and abs(got[k]["acc"] - sum((r[2] >= 0.5) == (r[1] == 1) for r in part) / len(part)) < 1e-9
    assert "ptpt" not in {r["section"] for r in evaluation.report(df.where("NOT is_ptpt OR rid < 50"), "g").collect()}
    assert {r["rid"] for r in evaluation.contradictions(df).collect()} == {r[0] for r in rows if r[5] == "false_pure" and r[7] == "true"}


def test_conflicts_list_every_row_and_versions_are_judged(spark):
    rows = [(1, "t", "fake", "A"), (2, "t", "true", "A"), (3, "t", "true", None), (4, "u", "fake", "B"), (5, None, "fake", "B"), (6, None, "true", "B")]
    got = cleaning.conflict_audit(spark.createDataFrame(rows, "rid bigint, text_clean string, label string, dataset_name string")).collect()
    assert {r["rid"] for r in got} == {1, 2, 3} and [tuple(x) for x in got[0]["labels_involved"]] == [("fake", 1), ("true", 2)]
    assert [tuple(x) for x in got[0]["subsets_involved"]] == [("A", 2)] and got[0]["row_count"] == 3
    from corpusmill.functions import vocabulary as V
    from corpusmill.sources.readers import MAIN_TYPES

    frame = lambda ids, part: cleaning.with_contract_columns(spark.createDataFrame([(i, f"texto {i} aqui", "fake", 3, 0, 0, 0) for i in ids], "rid bigint, text string, label string, word_len int, is_duplicated int, is_null int, too_short int").withColumn("text_no_url", F.col("text")), MAIN_TYPES).withColumn("part", F.lit(part))
    base = frame([1, 2], "base")
    good = base.unionByName(frame([3], "new"))
    judged = lambda t: {r["rule"]: r["violations"] for r in cleaning.judge_version(t, base.drop("part"), V.COLUMNS).collect()}
    assert not any(judged(good).values())
    bad = judged(base.where("rid = 1").unionByName(frame([2, 3], "new")).select("part", *reversed(V.COLUMNS)))
    assert bad["base_changed"] == 1 and bad["column_order"] == 1 and bad["id_collision"] == 1


def test_rare_strata_join_the_largest(spark):
    rows = [(i, "A", "x") for i in range(20)] + [(100 + i, "B", "x") for i in range(3)] + [(200, "C", "y")]
    got = {r["rid"]: r["stratum"] for r in sampling.strata(spark.createDataFrame(rows, "rid bigint, g string, l string"), "g", "l", 4).collect()}
    assert got[0] == "A|x" and got[100] == "A|x" and got[200] == "A|x"
    got = {r["rid"]: r["stratum"] for r in sampling.strata(spark.createDataFrame(rows + [(300, "D", "x")], "rid bigint, g string, l string"), "g", "l", 4).collect()}
    assert got[100] == "x" and got[300] == "x" and got[200] == "A|x"


def test_a_long_chain_of_near_duplicates_ends(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 60]), "2020-01-01") for i in range(90)]
    new = spark.createDataFrame(rows, "rid bigint, text_no_url string, date_iso string")
    base = spark.createDataFrame([], "rid bigint, text_no_url string")
    got = {r["rid"]: r["reason"] for r in near_duplicates.deduplicate(new, base).collect()}
    kept = []
    for i, t, _ in rows:
        w = t.split()
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if all(len(s & o) < near_duplicates.THRESHOLD * len(s | o) for o in kept):
            kept.append(s)
            assert got[i] is None
        else:
            assert got[i] == "dup_new_near"


def test_pairs_above_a_cosine_against_all_pairs(spark):
    r = random.Random(6)
    words = ["golpe", "vacina", "banco", "senha", "prefeitura", "chuva", "ponte", "escola", "urna", "voto"]
    texts = [" ".join(r.choice(words) for _ in range(12)) for _ in range(40)]
    texts += [t.replace("banco", "bancos", 1) for t in texts[:15]] + [texts[0], texts[1]]
    df = spark.createDataFrame(list(enumerate(texts)), "rid bigint, text string")
    rows, queries = df.where("rid < 40"), df.where("rid >= 40")
    got = {(x["query_id"], x["rid"]) for x in models.similar_above(queries, rows, "rid", "text").collect()}
    v, fitted = models.tfidf(rows, "rid", models.char_grams(F.col("text")))
    q, _ = models.tfidf(queries, "rid", models.char_grams(F.col("text")), fitted=fitted)
    vec = lambda d: {k: {x["gram"]: x["w"] for x in g} for k, g in __import__("itertools").groupby(sorted(d.collect(), key=lambda x: x["rid"]), key=lambda x: x["rid"])}
    a, b = vec(q), vec(v)
    want = {(i, j) for i, x in a.items() for j, y in b.items() if sum(w * y.get(g, 0) for g, w in x.items()) >= 0.9}
    assert got == want and len(want) >= 17
    split = df.withColumn("split", F.when(F.col("rid") < 40, "train").otherwise("test")).withColumn("g", F.lit("a"))
    leak = models.leakage(split, "rid", "text", "g").first()
    assert leak["n"] == 17 and leak["near"] == len({i for i, _ in want})
    assert models.similar_above(queries.limit(0), rows, "rid", "text").count() == 0


def _cosines(spark, queries, rows):
    """Of all pairs, by the grams as a column."""
    v, fitted = models.tfidf(rows, "rid", models.char_grams(F.col("text")))
    q, _ = models.tfidf(queries, "rid", models.char_grams(F.col("text")), fitted=fitted)
    pairs = q.select(F.col("rid").alias("q"), "gram", F.col("w").alias("x")).join(v, "gram").where("q <> rid").groupBy("q", "rid").agg(F.sum(F.col("x") * F.col("w")).alias("sim"))
    return {(r["q"], r["rid"]): r["sim"] for r in pairs.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_gram_similarity_is_exact_and_shuffles_no_grams(spark, monkeypatch, small):
    r = random.Random(8)
    words = ["golpe", "vacina", "banco", "é", "ao", "sim", "чума", "prefeitura", "病気です", "x1", "😀😀a", "urna"]
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 9))) for _ in range(70)] + ["a", "ao é", "", None, "Único!", "https://x.example/a"]
    texts += [t + " sim" for t in texts[:9]] + texts[:3]
    df = spark.createDataFrame([(7 * i % 101, t) for i, t in enumerate(texts)] + [(5, "golpe"), (5, "vacina"), (None, "banco"), (None, "urna")], "rid bigint, text string").repartition(3)
    queries = df.where("rid % 3 = 0 OR rid = 5")
    if small:  # all that is held at once is little, and few grams are common
        for name, x in (("LETTERS", 60), ("ENTRIES", 300), ("BLOCK", 4), ("CELLS", 20), ("COLUMNS", 3), ("COMMON", 0.3)):
            monkeypatch.setattr(grams, name, x)
    want = _cosines(spark, queries, df)
    near = {k: round(v, 9) for k, v in want.items() if v >= 0.6 - 1e-9}
    above = models.similar_above(queries, df, "rid", "text", 0.6)
    got = above.collect()
    assert {(x["query_id"], x["rid"]): round(x["sim"], 9) for x in got} == near and len(got) == len(near) > 30
    top = {q: min((-round(v, 9), k) for (p, k), v in want.items() if p == q) for q, _ in want}
    most = models.most_similar(queries, df, "rid", "text")
    assert {x["query_id"]: (-x["sim"], x["nearest_id"]) for x in most.collect()} == top
    for x in (above, most):
        plan = x._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "explode" not in plan
    _, fitted = models.tfidf(df, "rid", models.char_grams(F.col("text")))
    assert {(x["query_id"], x["rid"]) for x in models.similar_above(queries, df, "rid", "text", 0.6, fitted=fitted).collect()} == set(near)
    assert models.most_similar(queries, df.limit(0), "rid", "text").count() == 0


def test_two_heads_and_their_choice(spark):
    rows = [(i, i % 2, float(i % 2) + 0.3 * (i % 7), "AB"[i % 3 % 2], i % 4 > 0) for i in range(240)]
    df = spark.createDataFrame(rows, "rid bigint, y int, x double, g string, is_balanced_group boolean")
    got = {r["variant"]: r for r in models.head_variants(df, df, df, ["x"], "g", strengths=(0.1, 1.0)).collect()}
    assert set(got) == {"erm", "dfr"} and got["erm"]["selected_by"] == "macro_f1" and got["dfr"]["selected_by"] == "worst_group"
    assert all(0 <= r["acc"] <= 1 and r["strength"] in (0.1, 1.0) for r in got.values())
    assert models.head_variants(df.limit(0), df, df, ["x"], "g").count() == 0


def test_batches_of_like_length_give_all_rows_back(spark):
    df = spark.createDataFrame([(i, i * 7 % 101) for i in range(1000)], "rid bigint, n int")
    got = sampling.length_batches(df, "rid", "n", 8, mega=5).collect()
    assert sorted(r["rid"] for r in got) == list(range(1000))
    by: dict = {}
    for r in got:
        by.setdefault(r["batch"], []).append(r)
    assert sum(len(b) < 8 for b in by.values()) <= 1 and all(sorted(x["place"] for x in b) == list(range(1, len(b) + 1)) for b in by.values())
    spread = sum(max(x["n"] for x in b) - min(x["n"] for x in b) for b in by.values()) / len(by)
    assert spread < 30
    assert sampling.length_batches(df.limit(0), "rid", "n", 8).count() == 0
