import json

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import vocabulary as V
from corpusmill.operators import cleaning, evidence, extraction, models, prompts
from corpusmill.plans import pipeline_queries
from corpusmill.sources import readers, writers
from corpusmill.streaming import streams


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_round_trip_keeps_quotes_line_breaks_and_types(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", text\nwith lines', "true", ["u'1", "u2"]), (2, None, "fake", None)], "rid bigint, text string, label string, extracted_urls array<string>")
    writers.write_csv(df, str(tmp_path / "x"))
    types = {"rid": "bigint", "text": "string", "label": "string", "extracted_urls": "string"}
    got = {r["rid"]: r for r in readers.read_csv(spark, str(tmp_path / "x"), types).collect()}
    assert got[1]["text"] == 'a "quoted", text\nwith lines' and got[1]["label"] == "true" and got[1]["extracted_urls"] == "['u\\'1', 'u2']" and got[2]["extracted_urls"] == "[]"


def test_logs_skip_broken_lines_and_split_provenance(spark, tmp_path):
    put(tmp_path / "raw/a.jsonl", '{"rid": 1, "text": "x", "_provenance": {"publisher": "p"}}\n\n{"rid": 2, "te\n')
    put(tmp_path / "raw/b.jsonl", '{"rid": 3, "text": "y"}\n')
    put(tmp_path / "raw/c.txt", "no")
    schema = "rid bigint, text string, _provenance struct<publisher:string>"
    rows = readers.read_log_folder(spark, str(tmp_path / "raw"), schema)
    assert sorted((r["rid"], r["source_key"]) for r in rows.where("rid IS NOT NULL").collect()) == [(1, "a"), (3, "b")]
    main, prov = readers.split_provenance(rows.where("rid = 1"))
    assert main.columns == V.COLUMNS and prov.columns == V.PROVENANCE_COLUMNS and prov.first()["publisher"] == "p"
    writers.write_unique_log(spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "id int, at int, v string"), str(tmp_path / "log"), "id", ["at"])
    writers.append_log(spark.createDataFrame([(2, 5, "c")], "id int, at int, v string"), str(tmp_path / "log"))
    assert sorted(r["v"] for r in readers.read_log(spark, str(tmp_path / "log"), "id int, at int, v string").collect()) == ["a", "c"]


def test_claim_feed_takes_null_object_and_array(spark, tmp_path):
    one = {"@type": "ClaimReview", "url": "https://www.a.example/1", "claimReviewed": "c1", "reviewRating": {"alternateName": "Falso"}, "author": {"name": "n"}, "datePublished": "2020-01-02T00:00:00Z"}
    doc = {"dataFeedElement": [{"item": None}, {"item": one}, {"item": [one | {"claimReviewed": "c2"}, {"@type": "Other"}]}, {}]}
    got = readers.read_claim_feed(spark, put(tmp_path / "feed.json", json.dumps(doc)))
    assert sorted((r["claimReviewed"], r["domain"], r["date_iso"], r["rating"]) for r in got.collect()) == [("c1", "a.example", "2020-01-02", "Falso"), ("c2", "a.example", "2020-01-02", "Falso")]
    assert readers.first_per_claim(got.unionByName(got)).count() == 2


def test_pages_maps_and_searches(spark, tmp_path):
    html = "<html><meta property='og:title' content='T &amp; U'><h1>A <b>b</b></h1><h1> </h1><script type='application/ld+json'>{\"datePublished\": \"2021-05-06T01:00\"}</script><span class=\"x verdict\">Falso</span></html>"
    r = spark.createDataFrame([(html,)], "html string").select(*[c.alias(k) for k, c in readers.page_fields(F.col("html")).items()]).first()
    assert (r["h1"], r["og_title"], r["date_iso"], r["verdict"]) == (["A b"], "T & U", "2021-05-06", "Falso")
    m = readers.read_site_map(spark, put(tmp_path / "m.xml", "<urlset><url><loc> https://a/2020/01/31/x </loc></url><url><loc>https://a/y&amp;z</loc></url><url><loc>https://a/y&amp;z</loc></url></urlset>"))
    assert sorted((r["url"], str(r["day"])) for r in m.collect()) == [("https://a/2020/01/31/x", "2020-01-31"), ("https://a/y&z", "None")]
    n = readers.read_news_search(spark, put(tmp_path / "r.xml", "<rss><item><title><![CDATA[A &amp; B]]></title><link>https://n.example/1</link><pubDate>Wed, 05 Feb 2020 10:00:00 GMT</pubDate><source url='https://www.s.example'>S</source></item></rss>"))
    r = n.withColumn("at", readers.published(F.col("pub"))).first()
    assert (r["title"], r["domain"], r["source"], str(r["at"])) == ("A & B", "s.example", "S", "2020-02-05 10:00:00")


def test_external_and_searched_claims(spark):
    rows = spark.createDataFrame([("long enough statement", "False", "31-12-2019"), ("short", "true", None), ("another long statement", "odd", None)], "statement string, label string, day string")
    assert [tuple(r) for r in readers.external_claims(rows, "statement", {"false": "fake", "true": "true"}, "day").collect()] == [("long enough statement", "fake", "2019-12-31")]
    api = spark.createDataFrame([("t", "c", "2020-01-01T00:00:00Z", [("u", "", "Falso (título)", None, ("s.example",))])], "text string, claimant string, claimDate string, claimReview array<struct<url:string,textualRating:string,title:string,reviewDate:string,publisher:struct<site:string>>>")
    pubs = spark.createDataFrame([("s.example", "FC_S")], "site string, dataset_name string")
    r = readers.claim_rows(api, pubs).first()
    assert (r["rating"], r["date_iso"], r["dataset_name"]) == ("Falso (título)", "2020-01-01", "FC_S")


def test_extraction_rules(spark):
    feed = spark.createDataFrame([("Prefeito proibiu a circulação de cães", "FALSO: texto", "u1"), ("Isto é falso e todos sabem", "Falso", "u2"), ("Uma alegação sem veredito nenhum", "Explica", "u3")], "claimReviewed string, rating string, url string")
    marked = spark.createDataFrame([(7, "Título qualquer da página", "Texto. Boato – Governo vai taxar quem tem galinha no quintal. Mais.", "<blockquote>Versão 1: <b>Urgente</b> repassem já isto</blockquote>", "l")], "id bigint, title string, content string, content_html string, link string")
    cats = spark.createDataFrame([("É verdade que a lua encolheu ontem?", ["Falso"]), ("Estrada nova foi aberta em Goiás?", ["Indeterminado", "Verdadeiro"])], "title string, categories array<string>")
    tags = spark.createDataFrame([("Pastor anunciou fim do mundo", ["ENGANOSO"], ["Checamos"]), ("Pastor anunciou fim do mundo", ["Falso"], ["Outros"])], "title string, tags array<string>, categories array<string>")
    head = spark.createDataFrame([("É #FAKE que chuva de peixes caiu no Acre",), ("Veja o que é #FATO e #FAKE no debate",)], "h1 string")
    span = spark.createDataFrame([("Ministro vendeu praia inteira - Polígrafo", "Falso")], "og_title string, verdict string")
    news = spark.createDataFrame([("Câmara aprova orçamento do ano que vem hoje",), ("Curto",)], "title string")
    # Without an address or an id of their own, records of all sources would get one and the same id.
    cats, tags, head, span, news = (x.withColumn("url", F.concat(F.lit(n), F.xxhash64(*x.columns).cast("string"))) for n, x in zip("ctHsn", (cats, tags, head, span, news), strict=True))
    rows, stats = extraction.extract_all({"feed": ("feed", feed), "boatos": ("marked", marked), "efarsas": ("category", cats), "bereia": ("tag", tags), "g1": ("heading", head), "poligrafo": ("span", span), "portal": ("headline", news), "again": ("headline", news)})
    got = {(r["source_key"], r["text"]): (r["label"], r["_provenance"]["text_role"]) for r in rows.collect()}
    assert got == {
        ("feed", "Prefeito proibiu a circulação de cães"): ("fake", "claim"), ("boatos", "Governo vai taxar quem tem galinha no quintal"): ("fake", "claim"), ("boatos", "Urgente repassem já isto"): ("fake", "viral"),
        ("efarsas", "a lua encolheu ontem"): ("fake", "claim"), ("bereia", "Pastor anunciou fim do mundo"): ("fake", "claim"), ("g1", "chuva de peixes caiu no Acre"): ("fake", "claim"),
        ("poligrafo", "Ministro vendeu praia inteira"): ("fake", "claim"), ("again", "Câmara aprova orçamento do ano que vem hoje"): ("true", "headline"),
    }
    assert {r["source_key"]: (r["raw"], r["kept"]) for r in stats.collect()}["portal"] == (2, 0)
    assert cleaning.with_contract_columns(rows.drop("extracted_urls"), readers.MAIN_TYPES).columns == V.COLUMNS


def test_corrections(spark):
    art = spark.createDataFrame([("k", "O ministério informou que nenhuma vacina contém microchip algum dentro dela", "l")], "key string, content string, link string")
    ans = spark.createDataFrame([("k", "Nenhuma vacina contém microchip algum, informou o ministério"), ("k", "Curta"), ("k", "Outra coisa inteiramente inventada sobre extraterrestres marcianos")], "key string, answer string")
    assert [r["text"] for r in extraction.corrections(ans, art).collect()] == ["Nenhuma vacina contém microchip algum, informou o ministério"]


ITEM = "array<struct<title:string,link:string,source:string,domain:string,pub:string>>"


def test_evidence_votes_and_abstains(spark):
    text = "Governo anunciou vacina nova contra dengue em 2020"
    same = "Governo anunciou vacina nova contra dengue em 2020"
    check = ("É falso que governo anunciou vacina nova contra dengue em 2020", "L", "Lupa", "lupa.example", None)
    site = lambda d, pub=None: (same, "x", d, d, pub)
    rows = [
        (1, text, "own", "2020-02-01", [site("a"), check]), (2, text, "a", "2020-02-01", [site("a"), site("b"), site("c")]), (3, text, "own", "2020-02-01", [site("a"), site("b"), site("b"), site("c", "Wed, 05 Feb 2020 10:00:00 GMT")]),
        (4, text, "own", "2020-02-01", [site("a"), site("b"), site("c", "Wed, 05 Feb 2014 10:00:00 GMT")]), (5, text, "own", None, []), (6, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, f"rid bigint, text string, own_domain string, date_iso string, items {ITEM}")
    got = {r["rid"]: (r["auto_label"], r["method"], r["evidence"]) for r in evidence.classify(df, [("lupa", "lupa")], ["a", "b", "c"]).collect()}
    none = ("unknown", "abstencao", "")
    assert got == {1: ("fake", "factcheck:lupa", "L"), 2: none, 3: ("true", "corroboracao", "a;b;c"), 4: none, 5: none, 6: none}


def test_evidence_query_votes_on_every_link(spark, tmp_path):
    a, b, c, d = "Governo anunciou vacina nova contra dengue", "Prefeitura abriu escola municipal integral", "Hospital regional comprou ambulancias novas", "Senado aprovou reforma tributaria ampla"
    site = lambda x: f"https://{x}.example/1"
    main = [(1, a, site("w"), "w", "2020-02-01"), (2, f"É falso que {a.lower()}", site("confere"), "confere", None)]
    main += [(10 + i, b, site(x), x, "2020-02-0" + str(1 + i)) for i, x in enumerate("xyz")] + [(20, c, site("x"), "x", None), (21, c, site("y"), "y", None), (22, c, None, "z", None)]
    main += [(30, d, site("x"), "x", None), (31, d, site("y"), "y", "2020-02-03"), (32, d, site("z"), "z", "2014-02-03")]
    spark.createDataFrame(main, "rid bigint, text_no_url string, url_review string, source_description string, date_iso string").write.parquet(str(tmp_path / "fakenewsbr_v6_public.parquet"))
    new = [(100, a), (101, b), (102, b), (103, c), (104, d), (105, "outra coisa qualquer"), (106, None)]
    spark.createDataFrame([(i, t, site("own"), "2020-02-01") for i, t in new], "rid bigint, text_no_url string, url_review string, date_iso string").write.parquet(str(tmp_path / "incoming_rows.parquet"))
    got = {r["rid"]: (r["auto_label"], r["method"], r["evidence"]) for r in pipeline_queries.evidence_votes(spark, str(tmp_path)).collect()}
    none, voted = ("unknown", "abstencao", ""), ("true", "corroboracao", "x.example;y.example;z.example")
    assert got == {100: ("fake", "factcheck:confere", site("confere")), 101: voted, 102: voted, 103: none, 104: none, 105: none}


def test_label_tiers(spark):
    base = spark.createDataFrame([(1, "true", "provenance"), (2, "fake", "rating"), (3, "true", "provenance"), (4, "true", None), (5, "true", "correction"), (6, "true", "provenance")], "rid bigint, label string, label_source string")
    m = spark.createDataFrame([(1, 0.95, True, "fake", "p", 1), (1, 0.91, True, "true", "q", 2), (2, 0.8, True, "true", "p", 1)], "rid bigint, score double, agrees boolean, verdict string, publisher string, at int")
    v = spark.createDataFrame([(3, "fake", 0.9, 1), (3, "true", 0.99, 2), (1, "fake", 0.99, 1), (6, "fake", 0.5, 1)], "rid bigint, verdict string, confidence double, at int")
    c = spark.createDataFrame([(6, "true"), (3, "true")], "rid bigint, auto_label string")
    got = {r["rid"]: (r["label_tier"], r["auto_label"], r["train_label"], r["verified_label"]) for r in evidence.consolidate(base, m, v, c).collect()}
    assert got == {
        1: ("checker_match", "true", "true", "true"), 2: ("checker", "fake", "fake", "fake"), 3: ("llm_local", "fake", "fake", "fake"), 4: ("v1", "true", "true", "true"),
        5: ("correction", "", "true", "unknown"), 6: ("corroborated", "true", "true", "true"),
    }


def test_answers_are_parsed(spark):
    raw = ['{"verdict": "FAKE", "confidence": 87, "motivo": "m"}', '```json\n{"verdict": "true", "confidence": 0.91234}\n```', 'Well: {"verdict": "maybe"} ok', "nothing", None]
    got = [tuple(r["a"]) for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i").select(prompts.parsed_answer(F.col("x")).alias("a")).collect()]
    assert got == [("fake", 0.87, "m"), ("true", 0.912, ""), ("unknown", 0.0, ""), ("unknown", 0.0, ""), ("unknown", 0.0, "")]
    rows = [("t", [("x" * 200, "a.example", "2020-01-01 00:00:00 UTC", "lupa"), ("y", None, None, None)] * 5), (None, None), ("u", [])]
    df = spark.createDataFrame(rows, "t string, items array<struct<title:string,domain:string,pub:string,checker:string>>")
    asked = df.select(prompts.request("verify_headline", F.lit("s"), F.lit("u"), F.col("t"), prompts.prompt(F.col("t"), F.lit("2020-01-02"), F.col("items"))).alias("r")).select("r.*").collect()
    lines = asked[0]["body"].split("\n")
    assert lines[:4] == ["MANCHETE: t", "DATA: 2020-01-02", "", "EVIDENCIAS (Google News):"] and len(lines) == 12
    assert lines[4] == "[0] a.example (2020-01-01 00:00) [CHECADOR:lupa]: " + "x" * 160 and lines[5] == "[1]  (): y"
    assert all(r["body"].endswith("(nenhuma)") for r in asked[1:])
    import hashlib

    assert {r["custom_id"] for r in asked} == {hashlib.sha1(b"verify_headline|s|u").hexdigest()[:24]} and asked[0]["tokens"] == len(asked[0]["body"]) // 4 + 500
    article = df.select(prompts.request("correction", F.lit("s"), F.lit("u"), F.lit("z" * 13_000)).alias("r")).first()["r"]
    assert article["body"].count("z") == 12_000 and article["schema"] == "correction" and article["max_tokens"] == 400


def test_models_learn_a_separable_table(spark):
    rows = spark.createDataFrame([(i, i % 2, float(i % 2) + 0.1 * (i % 5), "gato preto mia" if i % 2 else "cachorro late alto", "ab"[i % 3 % 2]) for i in range(200)], "rid bigint, y int, x double, text string, g string")
    model, strength, score = models.fit_head(rows.where("rid < 140"), rows.where("rid >= 140"), ["x"])
    assert score == 1.0 and strength > 0
    assert models.fit_head(rows, rows, ["x"], strengths=(1.0,), group="g")[2] == 1.0
    _, terms = models.text_baseline(rows, "text")
    best = {r["term"]: r["weight"] for r in terms.collect()}
    assert best["gato"] > 0 > best["cachorro"] and "gato preto" in best


def test_baseline_scores_the_held_out_part_and_gives_terms_of_each_class(spark, tmp_path):
    text = lambda i: f"gato preto mia sempre w{i % 3}" if i % 10 else f"cachorro late alto w{i % 3}"
    rows = spark.createDataFrame([(i, text(i), "fake" if i % 10 else "true") for i in range(200)], "rid bigint, text string, label string")
    y = rows.withColumn("y", (F.col("label") == "fake").cast("int"))
    _, terms, scores = models.text_baseline(y, "text", top=2, held_out=y.withColumn("y", 1 - F.col("y")))
    w = [r["weight"] for r in terms.collect()]
    assert scores == (0.0, 0.0) and len([x for x in w if x > 0]) == len([x for x in w if x < 0]) == 2
    rows.write.parquet(str(tmp_path / "fakenewsbr_v6_public.parquet"))
    got = pipeline_queries.baseline_terms(spark, str(tmp_path)).collect()
    assert {(r["run"], r["accuracy"], r["f1"], r["weight"] > 0) for r in got} == {(run, 1.0, 1.0, sign) for run in ("naive", "stopped") for sign in (True, False)}


def test_streams_resume_and_drop_repeated_ids(spark, tmp_path):
    src, out, chk = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "chk")
    put(src / "1.json", '{"rid": 1, "v": "a"}\n{"rid": 1, "v": "b"}\n{"rid": 2, "v": "c"}\n')
    run = lambda: streams.append_to(streams.once_per_id(streams.files(spark, str(src), "rid bigint, v string"), "rid"), out, chk).awaitTermination()
    run()
    put(src / "2.json", '{"rid": 2, "v": "d"}\n{"rid": 3, "v": "e"}\n')
    run()
    run()
    assert sorted(r["rid"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    seen = []
    streams.in_batches(streams.unprocessed(streams.files(spark, str(src), "rid bigint, v string", per_batch=1), spark.createDataFrame([(1,)], "rid bigint"), "rid"), lambda df, n: seen.append((n, df.count())), str(tmp_path / "chk2")).awaitTermination()
    assert [n for n, _ in seen] == [0, 1] and sum(c for _, c in seen) == 3


def test_reports(spark):
    df = spark.createDataFrame([("a|b", 1234, 0.5)], "k string, n int, s double")
    assert "| a\\|b | 1,234 | 0.5000 |" in writers.markdown_table(df)
    assert json.loads(writers.metrics_json(df)) == [{"k": "a|b", "n": 1234, "s": 0.5}]


def test_matrices_by_id_and_lines_by_file(spark, tmp_path):
    import numpy as np

    for k in range(2):
        (tmp_path / "m").mkdir(exist_ok=True)
        np.save(tmp_path / "m" / f"part{k}.npy", np.arange(6, dtype=np.float32).reshape(3, 2) + 10 * k)
    ids = spark.createDataFrame([(f"part{k}.npy", i, 100 * k + i) for k in range(2) for i in range(3)], "file string, row bigint, rid bigint")
    got = {r["rid"]: list(r["vector"]) for r in readers.read_matrix(spark, str(tmp_path / "m"), ids).collect()}
    assert got[101] == [12.0, 13.0] and len(got) == 6
    with pytest.raises(ValueError):
        readers.read_matrix(spark, str(tmp_path / "m"), ids.where("rid <> 2"))
    put(tmp_path / "l" / "a.jsonl", "{}\n{}\n")
    put(tmp_path / "l" / "b.jsonl", "{}\n")
    assert sorted(map(tuple, readers.line_counts(spark, str(tmp_path / "l")).collect())) == [("a.jsonl", 2), ("b.jsonl", 1)]


def test_metrics_are_never_cut(spark):
    with pytest.raises(ValueError):
        writers.metrics_json(spark.range(writers.MOST + 1))
    assert writers.metrics_json(spark.range(2)).count("id") == 2
