import hashlib
import os
import random
import re
import time
import unicodedata
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import bpe, canonical, forest, fusion, languages, mixing, personal, personal_words, ratings, spans
from corpusmill.session import shuffles_dropped, work_dir


def folded(s):
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


# ------------------------------------------------------------- 7


def test_canonical_groups(spark):
    card = "Alegação: Um fato | Local: Cá | Data: 01/02/2020"
    rows = [
        (5, "Água e luz!"), (3, "agua  E​luz"), (9, "Água e luz"), (1, None), (2, ""), (4, " ... "), (7, "agua e luzes"),
        (20, card), (11, "DATA: 01/02/2020; alegacao: um fato; LOCAL: ca"), (30, "Local: Cá\nAlegação: Um fato\nData: 01/02/2020"), (31, "Local: Cá\nAlegação: Outro\nData: 01/02/2020"),
        (40, "x" * 200_000), (41, "X" * 200_000), (41, "X" * 200_000),
    ]
    df = spark.createDataFrame([(a, b, "clash", "clash") for a, b in rows], "rid bigint, text_no_url string, canon string, raw string")
    assert sorted(map(tuple, canonical.found(df).collect())) == [(3, 5), (3, 9), (11, 20), (11, 30), (40, 41), (40, 41)]
    assert canonical.found(df.limit(0)).count() == 0
    copies = {r["rid_first"]: (r["copies"], r["variants"]) for r in canonical.deduplicate(df, "rid", "text_no_url").collect()}
    assert copies[3] == (3, 3) and copies[40] == (3, 2) and copies[7] == (1, 1)


def test_hot_texts_meet_their_group_like_others(spark):
    rows = [(i, "quente" if i % 3 else f"Frio {i // 6}") for i in range(9000)] + [(10_000, "QUENTE!")]
    got = {(r["rid_first"], r["rid_copy"]) for r in canonical.found(spark.createDataFrame(rows, "rid bigint, text_no_url string")).collect()}
    first, want = {}, set()
    for i, t in rows:
        k = re.sub("[^a-z0-9]", "", t.lower())
        want |= {(first[k], i)} if k in first else set()
        first.setdefault(k, i)
    assert got == want


# ------------------------------------------------------------- 4

REFERENCE = [(1, "Falso", ["fake", "mentira", "boato"]), (4, "Fora de contexto", ["sem contexto"]), (10, "Verdadeiro", ["certo"]), (11, "Verdadeiro, mas", []), (12, "Comprovado", None), (13, "Meia verdade", [])]


@pytest.mark.parametrize(
    "value, entry",
    [
        ("FALSO", 1), ("Fals0", 1), ("fаke", 1), ("b o a t o", 1), ("Falsas", 1), ("Selo: mentira", 1), ("Conteúdo falso", 1), ("FALSO a foto não é de lá", 1), ("mentira - o vídeo verdadeiro é outro", 1),
        ("<b>sem_contexto</b>", 4), ("Foora de conmexto", 4), ("verdadero", 10), ("Verdadeiro, mas falta", 11), ("É certo", 10), ("meia-verdade", 13), ("entrevista", 0), ("?", 0), ("3 de 5", 0), ("x" * 5000, 0),
    ],
)
def test_rating_of_value(spark, mapped_values, value, entry):
    assert mapped_values[value] == entry


@pytest.fixture(scope="module")
def mapped_values(spark):
    values = ["FALSO", "Fals0", "fаke", "b o a t o", "Falsas", "Selo: mentira", "Conteúdo falso", "FALSO a foto não é de lá", "mentira - o vídeo verdadeiro é outro", "<b>sem_contexto</b>", "Foora de conmexto", "verdadero", "Verdadeiro, mas falta", "É certo", "meia-verdade", "entrevista", "?", "3 de 5", "x" * 5000, None, " ", "FALSO"]
    ref = spark.createDataFrame(REFERENCE, "rating_id int, rating_name string, aliases array<string>")
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "rid bigint, factcheck_rating string")
    got = ratings.map_values(df, "factcheck_rating", ref).collect()
    assert len(got) == len({v for v in values if v and v.strip()})
    assert ratings.found(df.limit(0), ref).count() == 0
    assert {r["rating_id"] for r in ratings.found(df, ref.limit(0)).collect()} == {0}
    return {r["value"]: r["entry"] for r in got}


def test_prefix_filter_loses_no_similar_pair(spark):
    r = random.Random(1)
    names = ["".join(r.choice("abcde") for _ in range(r.randint(7, 12))) for _ in range(30)]
    values = []
    for n in names * 4:
        k = r.randrange(len(n))
        values.append(n[:k] + r.choice("abcde") + n[k + 1 :])
    ref = spark.createDataFrame([(i + 1, n, []) for i, n in enumerate(names)], "rating_id int, rating_name string, aliases array<string>")
    got = {x["value"]: x["entry"] for x in ratings.map_values(spark.createDataFrame([(v,) for v in values], "v string"), "v", ref).collect()}
    assert all(got[v] for v in values)


# ------------------------------------------------------------- 3


def _fusion_tables(spark):
    main = [(1, "same text", "https://a/x", "nan", "2020-13-05", "A"), (2, "Same text!", "sem link", "Falso", "2020-01-01", "B"), (3, "same  TEXT", "http://b", "Enganoso", None, "B"), (4, "other", "http://c", "Falso", "2020-01-01", "B"), (5, None, "http://d", None, None, None), (6, "SAME text", None, None, " ", "C")]
    reg = [("A", 1, "UTC", "DMY"), ("B", 2, "UTC", "DMY")]
    prov = [(2, "2025-01-01T00:00:00+00:00"), (2, None), (3, "2025-02-01T00:00:00+00:00"), (3, "2024-01-01T00:00:00+00:00"), (1, None)]
    return (
        spark.createDataFrame(main, "rid bigint, text_no_url string, url_review string, factcheck_rating string, date_iso string, dataset_name string"),
        spark.createDataFrame(reg, "dataset_name string, trust_rank int, home_tz string, date_order string"), spark.createDataFrame(prov, "rid bigint, collected_at string"),
    )


def test_survivors_by_rank_then_time_then_id(spark):
    main, reg, prov = _fusion_tables(spark)
    assert sorted(map(tuple, fusion.found(main, reg, prov).collect())) == [(1, "dataset_name", 1), (1, "date_iso", 2), (1, "factcheck_rating", 3), (1, "url_review", 1)]
    assert fusion.found(main.limit(0), reg, prov).count() == 0
    assert fusion.found(main, reg.limit(0), prov.limit(0)).count() == 4


CLAIM = "grp bigint, field string, value string, normal string, source string, rid bigint, trust_rank int, collected_at string"


def test_copied_votes_count_less(spark):
    rows = []
    for g in range(40):
        # Three independent sources agree; B and C copy each other's wrong values.
        for s in "AXY":
            rows.append((g, "f", f"right{g}", f"right{g}", s, g * 10 + ord(s), 2, None))
        for s in "BC":
            rows.append((g, "f", f"wrong{g}", f"wrong{g}", s, g * 10 + ord(s), 2, None))
    c = spark.createDataFrame(rows, CLAIM)
    got = fusion.fuse(c, "even").collect()
    assert len(got) == 40 and all(r["value"].startswith("right") for r in got) and all(0 <= r["posterior"] <= 1 for r in got)
    assert fusion.fuse(c.limit(0), "even").count() == 0 and fusion.fuse(c.limit(0)).count() == 0
    assert all(r["votes"] > 2.5 for r in got)
    digest = {r["normal"]: r["h"] for r in c.select("normal", F.xxhash64("normal").alias("h")).distinct().collect()}
    told = {(r["grp"], r["normal"]): r["votes"] for r in fusion.evidence(c).collect()}
    assert all(told[g, digest[f"wrong{g}"]] < 1.5 for g in range(40))


def _fused(rows, rounds):
    """Evidence of each value by plain loops."""
    import math

    votes, rank = {}, {}
    for g, f, _, v, s, rid, tr, _ in rows:
        votes.setdefault((g, f), {}).setdefault(v, {}).setdefault(s, []).append(rid)
        rank[s] = min(rank.get(s, tr), tr)
    acc = {s: max(0.55, 0.95 - 0.08 * (min(r, 6) - 1)) for s, r in rank.items()}
    w = {}
    for left in range(rounds - 1, -1, -1):
        score = {k: {v: sum(w.get((k, v, s), 1.0) * math.log(10 * acc[s] / (1 - acc[s])) for s in ss) for v, ss in vs.items()} for k, vs in votes.items()}
        post, won = {}, {}
        for k, vs in score.items():
            z = sum(math.exp(x) for x in vs.values()) + max(0, 11 - len(vs))
            post[k] = {v: math.exp(x) / z for v, x in vs.items()}
            won[k] = max(vs, key=lambda v: (vs[v], -min(min(r) for r in votes[k][v].values())))
        if not left:
            break
        told = {}
        for k, vs in votes.items():
            for v, ss in vs.items():
                for s in ss:
                    told.setdefault(s, []).append(post[k][v])
        new = {s: max(0.05, min(0.99, (sum(x) + 4) / (len(x) + 5))) for s, x in told.items()}
        moved, acc = max(abs(new[s] - acc[s]) for s in new), new
        if moved <= fusion.SETTLED:
            break
        lost, both = {}, {}
        for k, vs in votes.items():
            for v, ss in vs.items():
                if v != won[k]:
                    for s in ss:
                        lost[s] = lost.get(s, 0) + 1
                        for t in ss:
                            if s < t:
                                both[s, t] = both.get((s, t), 0) + 1
        w = {}
        for (s, t), kf in both.items():
            odds = kf * math.log(8) + (min(lost[s], lost[t]) - kf) * math.log(0.2 / 0.9) - 2
            dep = 1 / (1 + math.exp(-max(-50, min(50, odds))))
            a, b = (s, t) if acc[s] >= acc[t] else (t, s)
            for k, vs in votes.items():
                for v, ss in vs.items():
                    if a in ss and b in ss:
                        w[k, v, b] = w.get((k, v, b), 1.0) * (1 - 0.8 * dep)
    return {(k[0], k[1], v): (score[k][v], post[k][v]) for k in votes for v in votes[k]}


def test_evidence_against_plain_loops(spark):
    r = random.Random(8)
    rows = [(g, "f", f"v{x}", f"v{x}", s, i * 7 + ord(s), 1 + ord(s) % 4, None) for i, g in enumerate(list(range(60)) * 2) for s, x in zip("ABCDE", [r.choice((0, 0, 1, 2)) for _ in range(4)] + [None], strict=True) if x is not None for _ in range(r.choice((1, 1, 2)))]
    c = spark.createDataFrame(rows, CLAIM)
    digest = {r["normal"]: r["h"] for r in c.select("normal", F.xxhash64("normal").alias("h")).distinct().collect()}
    got = {(x["grp"], x["field"], x["normal"]): x for x in fusion.evidence(c, 4).collect()}
    want = {(g, f, digest[v]): x for (g, f, v), x in _fused(rows, 4).items()}
    assert set(got) == set(want)
    for k, (s, p) in want.items():
        assert abs(got[k]["evidence"] - s) < 1e-6 and abs(got[k]["posterior"] - p) < 1e-6


def test_rank_and_time_outweigh_votes_and_votes_decide_ties(spark):
    many = [(1, "f", "told", "told", s, 100 + ord(s), 3, "2025-01-01T00:00:00+00:00") for s in "ABCDEFGH"]
    rows = [*many, (1, "f", "trusted", "trusted", "Z", 900, 1, None), (2, "f", "late", "late", "Y", 800, 3, "2025-01-01T00:00:01+00:00"), *[(2, *x[1:]) for x in many], (3, "f", "lone", "lone", None, 5, 3, None)]
    rows += [(4, "f", "lone", "lone", "Y", 1, 3, None), (4, "f", "told", "told", "A", 2, 3, None), (4, "f", "told", "told", "B", 3, 3, None)]
    c = spark.createDataFrame([tuple("" if i == 4 and x is None else x for i, x in enumerate(row)) for row in rows], CLAIM)
    assert {r["grp"]: r["value"] for r in fusion.fuse(c).collect()} == {1: "trusted", 2: "late", 3: "lone", 4: "lone"}
    assert {r["grp"]: r["value"] for r in fusion.fuse(c, ties="votes").collect()} == {1: "trusted", 2: "late", 3: "lone", 4: "told"}


# ------------------------------------------------------------- 8


def test_bpe_matches_the_library_and_decodes(spark):
    from tokenizers import Tokenizer

    texts = [None, "", " ", "  \n\t x", "Olá, mundo!!! 123", "<|endoftext|> it's we'll", "açãó ​ ﻿", "漢字かな العربية हिन्दी", "a" * 3000, "=" * 999, "word " * 2000, "👩‍👩‍👧 🏳️‍🌈", "\x00\x1f\x85 \xa0　x", "Olá, mundo!!! 123"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, word string")
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(df, "doc_id", "text").collect()}
    t = Tokenizer.from_file(bpe.RANKS.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    back = bpe.decode(bpe.encode(df, "doc_id", "text")).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {i: x or "" for i, x in enumerate(texts)}
    assert {r["doc_id"]: r["tokens"] for r in bpe.count_tokens(df, "doc_id", "text").collect()} == {i: len(x) for i, x in got.items()}
    assert bpe.encode(df.limit(0), "doc_id", "text").count() == 0


# ------------------------------------------------------------- 1


def _similar(a, b):
    def sh(t):
        w = re.sub("[^a-z0-9]+", " ", folded(t)).split()
        return set(zip(w, w[1:], w[2:], strict=False))

    x, y = sh(a), sh(b)
    return bool(x and y) and len(x & y) >= 0.6 * len(x | y)


def _texts(n, seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        if out and r.random() < 0.5:
            w = r.choice(out).split()
            for _ in range(r.choice((0, 1, 2, 6))):
                w[r.randrange(len(w))] = r.choice(vocab)
        else:
            w = [r.choice(vocab) for _ in range(r.randint(2, 40))]
        out.append(" ".join(w))
    return out


def test_repeats_against_brute_force(spark):
    t = _texts(400, 1)
    old = [(i, x) for i, x in enumerate(t[:200])] + [(900, None), (901, "")]
    new = [(1000 + i, 1 + i % 3, x) for i, x in enumerate(t[200:])] + [(2000, 1, None), (2001, 2, "..."), (2002, None, t[0]), (2003, 1, "a b"), (2004, 2, "A, b"), (2005, 1, "a c")]
    got = {r["rid"] for r in forest.repeats(spark.createDataFrame(old, "rid bigint, text string"), spark.createDataFrame(new, "rid bigint, batch_no int, text string")).collect()}
    seen, want = [x for _, x in old if x], set()
    for rid, _, x in sorted(new, key=lambda r: (r[1] or 99, r[0])):
        if x and re.search("[a-z0-9]", x.lower()):
            canon = re.sub("[^a-z0-9]", "", x.lower())
            if any(canon == re.sub("[^a-z0-9]", "", s.lower()) or _similar(x, s) for s in seen):
                want.add(rid)
            seen.append(x)
    assert len(want - got) <= 0.01 * len(want) and got <= want
    each = {r["rid"] for r in forest.repeats(spark.createDataFrame(old, "rid bigint, text string"), spark.createDataFrame(new, "rid bigint, batch_no int, text string"), one_by_one=True).collect()}
    assert len(each ^ got) <= 0.01 * len(want)


def test_batches_one_by_one_equal_one_pass(spark, tmp_path):
    t = _texts(300, 2)
    old = spark.createDataFrame([(i, -1, x) for i, x in enumerate(t[:150])], "rid bigint, batch_no int, text string")
    forest.HashForest(spark, str(tmp_path / "forest")).append(old, -1)
    got = set()
    for k in range(3):
        f = forest.HashForest(spark, str(tmp_path / "forest"))  # as another day's session would
        batch = spark.createDataFrame([(1000 + k * 100 + i, k, x) for i, x in enumerate(t[150 + k * 50 : 200 + k * 50])], "rid bigint, batch_no int, text string")
        run = f.append(batch, k)
        got |= {r["entry"] for r in f.similar(run).collect()}
        if k == 1:
            f.merge_runs()
            assert len(f.runs) == 1
    assert len(f.runs) == 2
    both = forest.HashForest(spark)
    both.append(old, -1)
    run = both.append(spark.createDataFrame([(1000 + k * 100 + i, k, x) for k in range(3) for i, x in enumerate(t[150 + k * 50 : 200 + k * 50])], "rid bigint, batch_no int, text string"))
    once = {r["entry"] for r in both.similar(run).collect()}
    # Copies within all batches are one entry in one pass, and an entry of each batch one by one.
    assert once <= got


def test_batches_one_by_one_give_all_repeats(spark, tmp_path):
    old = [(1, "Local: Rio; Data: hoje; Canal: rua"), (2, "Golpe!"), (3, "привет мир"), (4, "um dois três quatro cinco seis sete oito nove dez")]
    new = [
        (10, 1, "CANAL: rua | local: rio | data: Hoje"), (11, 1, "golpe"), (12, 1, "Привет, мир!"), (13, 1, "um dois tres quatro cinco seis sete oito nove onze"), (14, 1, "a b c d e"), (15, 1, "A, b c (d) e"), (16, 1, "ab cde"),
        (20, 2, "a-b c d e"), (21, 2, "novo"), (22, 2, "Novo."), (23, 2, "x y z w v"), (24, 2, "x y z w v"), (25, 2, "世界"), (30, 3, "世界!"), (31, 3, "x y z w v"), (32, 3, None), (33, 3, "..."), (40, None, "novo"), (41, None, "data: b; local: a"), (42, None, "local: A | data: B"),
    ]
    frame = lambda rows: spark.createDataFrame(rows, "rid bigint, batch_no int, text string")
    once = {r["rid"] for r in forest.repeats(spark.createDataFrame(old, "rid bigint, text string"), frame(new)).collect()}
    forest.HashForest(spark, str(tmp_path / "forest")).append(frame([(i, -1, t) for i, t in old]), -1)
    got = set()
    for k in (1, 2, 3, None):
        f = forest.HashForest(spark, str(tmp_path / "forest"))
        found = f.accept(frame([r for r in new if r[1] == k]))
        if k == 2:
            f.merge_runs()
        got |= {r["rid"] for r in found.collect()}
    assert got == once == {10, 11, 12, 13, 15, 16, 20, 22, 24, 30, 31, 40, 42}


def test_a_batch_reads_what_its_ranges_touch_however_long_the_history(spark, tmp_path):
    r = random.Random(4)
    text = lambda: " ".join(f"w{r.randrange(5000)}" for _ in range(12))
    frame = lambda rows: spark.createDataFrame(rows, "rid bigint, batch_no int, text string")
    read = []
    for name, n in (("short", 300), ("long", 3000)):
        f = forest.HashForest(spark, str(tmp_path / name), per_part=200)
        f.append(frame([(i, -1, text()) for i in range(n)]), -1)
        old = frame([(10_000, 0, "um dois tres quatro cinco seis sete oito nove dez")])
        assert f.accept(old, 0).count() == 0
        f.read.clear()
        assert [x["rid"] for x in f.accept(frame([(20_000, 1, "um dois tres quatro cinco seis sete oito nove dois"), (20_001, 1, "outra coisa sem par")]), 1).collect()] == [20_000]
        read.append({t: (sum(a for x, a, _ in f.read if x == t), max(b for x, _, b in f.read if x == t)) for t in ("leaves", "keys")})
    (short, long) = read
    assert long["leaves"][1] > 9 * short["leaves"][1] and long["keys"][1] > 9 * short["keys"][1] / 2
    assert long["leaves"][0] <= 2 * forest.TREES * 2 + 6 and long["keys"][0] <= 8


def test_a_merge_cut_short_and_a_merge_not_cleaned_up_change_nothing(spark, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, "rid bigint, batch_no int, text string")
    f = forest.HashForest(spark, str(tmp_path / "f"))
    f.append(frame([(1, -1, "um dois tres quatro cinco seis")]), -1)
    f.append(frame([(2, 0, "sete oito nove dez onze doze")]), 0)
    before = dict(f.runs)
    (tmp_path / "f" / "merged-half" / "leaves").mkdir(parents=True)
    assert set(forest.HashForest(spark, str(tmp_path / "f")).runs) == set(before)
    keep = [str(x) for x in before]
    import shutil

    for x in keep:
        shutil.copytree(x, x.replace("/f/", "/kept-"))
    f.merge_runs()
    for x in keep:
        shutil.copytree(x.replace("/f/", "/kept-"), x)
    again = forest.HashForest(spark, str(tmp_path / "f"))
    assert set(again.runs) == set(f.runs) and len(again.runs) == 1
    assert sorted(x["rid"] for x in again.accept(frame([(3, 1, "UM dois, tres quatro cinco seis"), (4, 1, "nada disso aqui hoje")]), 1).collect()) == [3]


def test_crowded_ranges_are_settled_exactly(spark):
    base = [f"k{i}" for i in range(60)]
    old = [(i, " ".join(base[:59] + [f"x{i}"])) for i in range(600)]
    new = [(1000 + i, 1, " ".join(base[:58] + [f"y{i}", "z"])) for i in range(30)] + [(2000, 1, " ".join(f"n{i}" for i in range(40)))]
    got = {r["rid"] for r in forest.repeats(spark.createDataFrame(old, "rid bigint, text string"), spark.createDataFrame(new, "rid bigint, batch_no int, text string")).collect()}
    assert got == {r for r, *_ in new[:30]}


def test_a_search_leaves_nothing_but_its_result_on_disk(spark):
    t, root = _texts(300, 5), Path(work_dir(spark).removeprefix("file://"))
    rows = lambda batch, texts: spark.createDataFrame([(1000 * (batch + 1) + i, batch, x) for i, x in enumerate(texts)], "rid bigint, batch_no int, text string")
    before = set(root.glob("p1-*"))
    f = forest.HashForest(spark)
    f.append(rows(-1, t[:200]), -1)
    found = f.accept(rows(0, t[200:]), 0)
    assert {x.name.rsplit("-", 1)[0] for x in set(root.glob("p1-*")) - before} == {"p1-repeats", "p1-settled"}
    assert found.count() > 0


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n.split("_")[1] for i in range(files.size()) if (n := files.apply(i).getName()).startswith("shuffle_")}

    before, key = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    with shuffles_dropped(spark):
        spark.range(10_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / "t"))
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before and spark.conf.get(key) == was
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7


def test_leaves_are_searched_some_trees_at_a_time(spark, monkeypatch):
    t, got = _texts(300, 6), []
    rows = lambda batch, texts: spark.createDataFrame([(1000 * (batch + 1) + i, batch, x) for i, x in enumerate(texts)], "rid bigint, batch_no int, text string")
    f = forest.HashForest(spark, per_part=500)
    f.append(rows(-1, t[:200]), -1)
    run = f.append(rows(0, t[200:]), 0)
    for at_once in (forest.TREES, 12, 5):
        monkeypatch.setattr(forest, "AT_ONCE", at_once)
        f.read.clear()
        got.append(tuple(sorted(map(tuple, x.collect())) for x in f.touched(run)))
        # The run's own leaves, and those of the one older run for some trees after others.
        assert len(f.read) == 1 + -(-forest.TREES // at_once)
    assert got[0] == got[1] == got[2] and {x[0] for x in got[0][0]} == set(range(forest.TREES))
    # Each leaf is there once, whichever trees were searched with its own.
    assert len(set(got[0][1])) == len(got[0][1]) > len(got[0][0])


def test_forest_of_nothing(spark):
    old = spark.createDataFrame([], "rid bigint, text string")
    new = spark.createDataFrame([(1, 1, "a b c d"), (2, 1, "a b c d")], "rid bigint, batch_no int, text string")
    assert [r["rid"] for r in forest.repeats(old, new).collect()] == [2]
    assert forest.repeats(old, new.limit(0)).count() == 0


def test_search_depth_keeps_the_recall():
    d = forest.search_depth()
    assert 1 - (1 - forest.THRESHOLD**d) ** forest.TREES >= forest.RECALL


# ------------------------------------------------------------- 10


def test_spans_against_brute_force(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.choice((1, 3, 7, 30))))
    passages = [" ".join(word() for _ in range(60))[:n] for n in (155, 159, 160, 161, 300, 700)] + ["x" * 400, " " * 200, "漢" * 170, "-- " * 80]
    docs = []
    for i in range(120):
        t = " ".join(word() for _ in range(r.randint(0, 40)))
        for p in r.sample(passages, r.choice((0, 0, 1, 1, 2))):
            t += r.choice(("", " ", "q", ". ")) + p + r.choice(("", " ", "z"))
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, docs[3][1]), (503, docs[3][1]), (504, passages[4] + " y " + passages[4])]
    got = {tuple(x) for x in spans.found(spark.createDataFrame([(a, b, "clash") for a, b in docs], "doc_id bigint, text string, rep string")).collect()}
    want, post = set(), {}
    for i, t in docs:
        for k in range(len(t or "") - spans.RUN + 1):
            post.setdefault(t[k : k + spans.RUN], set()).add(i)
    for ids in post.values():
        want |= {(a, b) for a in ids for b in ids if a < b}
    assert got == want
    length = {x["doc_id"]: x["shared_chars"] for x in spans.shared_length(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    for i, t in docs:
        hit = [False] * len(t or "")
        for k in range(len(t or "") - spans.RUN + 1):
            if len(post[t[k : k + spans.RUN]]) > 1:
                hit[k : k + spans.RUN] = [True] * spans.RUN
        assert length[i] == (len(t) if i in (3, 502, 503) and len(t) >= spans.RUN else sum(hit)), i


def test_passages_against_brute_force(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.choice((1, 3, 7, 30))))
    cut = [" ".join(word() for _ in range(60))[:n] for n in (159, 160, 161, 300, 500)]
    cut += [cut[4][:320], cut[4][150:], "漢😀" * 90, "x" * 240, "-- " * 70]
    docs = []
    for i in range(60):
        t = " ".join(word() for _ in range(r.randint(0, 30)))
        for p in r.sample(cut, r.choice((0, 1, 1, 2))):
            t += r.choice(("", " ", "q", ". ")) + p + r.choice(("", " ", "z"))
        docs.append((i, t))
    docs += [(500, None), (501, ""), (502, docs[3][1] + cut[3]), (503, docs[3][1] + cut[3]), (504, cut[3] + " y " + cut[3]), (505, "x" * 300), (506, "n" * 170), (507, "n" * 170)]
    want = set()
    for i, s in docs:
        for j, t in docs:
            if i < j and s and t:
                at = {}
                for k in range(len(t) - spans.RUN + 1):
                    at.setdefault(t[k : k + spans.RUN], []).append(k)
                m = [(p, q, p + n, q + n) for p in range(len(s) - spans.RUN + 1) for q in at.get(s[p : p + spans.RUN], ()) if not (p and q and s[p - 1] == t[q - 1]) for n in [len(os.path.commonprefix([s[p:], t[q:]]))]]
                inside = lambda k, x: any(y[k] <= x[k] and x[k + 2] <= y[k + 2] and (y[k], y[k + 2]) != (x[k], x[k + 2]) for y in m)  # noqa: B023, E731
                for x in m:
                    if not (inside(0, x) and inside(1, x)):
                        text = s[x[0] : x[2]]
                        want |= {(i, x[0], len(text), text), (j, x[1], len(text), text)}
    got = {tuple(x) for x in spans.passages(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == {(i, k, n, hashlib.md5(t.encode()).hexdigest()) for i, k, n, t in want} and len(want) > 100
    for i, n in [(x["doc_id"], x["shared_chars"]) for x in spans.shared_length(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()]:
        assert n == len({c for d, k, size, _ in got if d == i for c in range(k, k + size)})
    assert spans.passages(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_spans_of_nothing(spark):
    assert spans.found(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# ------------------------------------------------------------- 2

SENTENCES = {
    "pt": "O prefeito da cidade disse que a obra não foi feita. Os moradores ainda aguardam uma resposta da prefeitura sobre as ruas.",
    "es": "El alcalde de la ciudad dijo que la obra no se hizo. Los vecinos todavía esperan una respuesta del ayuntamiento sobre las calles.",
    "en": "The mayor of the city said that the work was not done. The people who live there are still waiting for an answer about the streets.",
    "fr": "Le maire de la ville a dit que les travaux ne sont pas faits. Les habitants attendent encore une réponse de la mairie sur les rues.",
    "it": "Il sindaco della città ha detto che i lavori non sono stati fatti. Gli abitanti aspettano ancora una risposta del comune sulle strade.",
}


def test_languages_of_mixed_texts(spark):
    rows = [(i * 10 + k, SENTENCES[lang], lang if k else {"pt": "pt-BR", "en": "eng"}.get(lang, lang)) for i, lang in enumerate(SENTENCES) for k in range(8)]
    rows += [(500, SENTENCES["pt"].upper() + " / " + SENTENCES["fr"], "pt"), (501, SENTENCES["it"], "pt_BR"), (502, SENTENCES["es"], "??"), (503, SENTENCES["en"], None), (504, None, "pt"), (505, "123 !!", None), (506, SENTENCES["pt"] * 300, "por")]
    main = spark.createDataFrame([(a, b) for a, b, _ in rows], "rid bigint, text string")
    prov = spark.createDataFrame([(a, c) for a, _, c in rows] + [(500, "pt")], "rid bigint, lang_variant string")
    got = sorted(map(tuple, languages.found(main, prov).collect()))
    assert got == [(500, "fr"), (500, "pt"), (501, "it"), (502, "es"), (503, "en")]
    seg = {(r["id"], r["segment"]): (r["lang"], r["confidence"]) for r in languages.segments(main, prov).where("id = 500").collect()}
    assert [v[0] for k, v in sorted(seg.items())] == ["pt", "fr"] and all(v[1] > 0.9 for v in seg.values())
    cut = {r["segment"]: (r["from"], r["to"]) for r in languages.segments(main, prov).where("id = 500").collect()}
    text = SENTENCES["pt"].upper() + " / " + SENTENCES["fr"]
    (a, b), (c, e) = [cut[k] for k in sorted(cut)]
    assert text[a:b] in SENTENCES["pt"].upper() and b - a > 0.9 * len(SENTENCES["pt"]) - 3 and text[c:e] in SENTENCES["fr"] and e - c > 0.9 * len(SENTENCES["fr"]) - 3
    assert languages.found(main.limit(0), prov).count() == 0
    assert list(SENTENCES) == languages.LANGS


def test_places_are_of_the_text_as_it_is():
    for text in ("Um dois. Três quatro!", "ﬁm de tarde. Straße İstanbul? é assim", "İİ abc. x́y z"):
        folded = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c))
        got = [text[a:b] for a, b in languages.places(text, folded)]
        assert len(got) == len(languages.sentences(folded))
        for span, words in zip(got, languages.sentences(folded), strict=True):
            assert span[:1].isalpha() and words[0][:1] == unicodedata.normalize("NFD", span.lower())[0]


def test_long_words_are_scored_whole():
    import numpy as np

    letters = "abcdefghijklmnopqrstuvwxyz"
    pieces = {p: i for i, p in enumerate([*letters, *("_" + c for c in letters), "ab", "_ab", "cab"])}
    prob = np.random.default_rng(2).random((len(pieces), 5)) * 0.01
    words = ["ab", "cab" * 9, "abc" * 30, "abcab" * 200, "a" * 5000]
    got = languages.score_words(words, pieces, prob)

    def plain(word: str) -> np.ndarray:
        marked, a = "_" + word, [np.zeros(5)] + [np.full(5, -np.inf)] * (len(word) + 1)
        for j in range(2, len(marked) + 1):
            for i in range(max(0, j - 3), j):
                k = pieces.get(marked[i:j])
                if i != 1 and k is not None:
                    a[j] = np.logaddexp(a[j], a[i] + np.log(prob[k]))
        return a[-1]

    for w, x in zip(words, got, strict=True):
        assert np.allclose(x, plain(w)), w[:10]


def test_forward_sum_is_the_sum_over_all_segmentations():
    import itertools

    import numpy as np

    pieces = {p: i for i, p in enumerate(["_a", "_ab", "b", "c", "bc", "_abc", "a"])}
    prob = np.random.default_rng(1).random((len(pieces), 2))
    word, want = "abcb", np.zeros(2)
    marked = "_" + word
    for cut in itertools.product([0, 1], repeat=len(word) - 1):
        ends = [i + 2 for i, c in enumerate(cut) if c] + [len(marked)]
        parts, at = [], 0
        for e in ends:
            parts.append(marked[at:e])
            at = e
        if all(p in pieces for p in parts):
            want += np.prod([prob[pieces[p]] for p in parts], axis=0)
    assert np.allclose(np.exp(languages.Lattice([word], pieces).score(prob))[0], want)


# ------------------------------------------------------------- 5


def test_personal_data_of_other_draws():
    tagger = personal.Tagger(personal.weights())
    good = bad = 0
    for text, gold in personal_words.training(600, seed=77):
        want, got = {k for *_, k in gold}, {k for *_, k in tagger.spans(text)}
        good, bad = good + len(want & got), bad + len(want ^ got)
    assert good / (good + bad) > 0.9


@pytest.mark.parametrize(
    "text, masked",
    [
        ("Falar com Ana da Silveira, zap (11) 91234-5678.", "Falar com [NAME], zap [PHONE]."), ("SOUZA, MARIA enviou", "[NAME] enviou"), ("escreva a fulano.tal [at] correio [ponto] example", "escreva a [EMAIL]"),
        ("CPF 123.456.789-00 na ficha", "CPF [ID_NUMBER] na ficha"), ("A ponte Dom Pedro foi lavada", "A ponte Dom Pedro foi lavada"), ("O perfil @canal_x9 publicou", "O perfil @canal_x9 publicou"),
        ("O protocolo é 72.225/2024.", "O protocolo é 72.225/2024."), ("", ""), ("👉 2 de março", "👉 2 de março"), ("Endereço: Rua das Flores, 123", "Endereço: [ADDRESS]"),
    ],
)
def test_masking(text, masked):
    assert personal.masked(text, personal.Tagger(personal.weights()).spans(text)) == masked


def test_best_labelling_against_all_subsets():
    import itertools

    r = random.Random(3)
    for _ in range(200):
        seg = [(a, a + r.randint(1, 6), "x") for a in (r.randint(0, 12) for _ in range(7))]
        score = [r.uniform(-1, 2) for _ in seg]
        best = 0.0
        for k in range(8):
            for pick in itertools.combinations(range(7), k):
                s = sorted(seg[i] for i in pick)
                if all(x[1] <= y[0] for x, y in zip(s, s[1:], strict=False)):
                    best = max(best, sum(score[i] for i in pick))
        got = personal.best_labelling(seg, score)
        assert abs(sum(max(score[i] for i in range(7) if seg[i] == g) for g in got) - best) < 1e-9


def test_personal_found(spark):
    df = spark.createDataFrame([(1, "Ligue (11) 91234-5678", "Ana Souza Prado"), (2, None, None), (3, "", ""), (4, "nada " * 50_000, "Vários"), (1, "Ligue (11) 91234-5678", None)], "rid bigint, text string, factcheck_claimant string")
    assert sorted(map(tuple, personal.found(df).collect())) == [(1, "factcheck_claimant", "name"), (1, "text", "phone")]
    assert personal.detect(df, "rid", "text", mask=True).count() == 5
    assert personal.found(df.limit(0)).count() == 0


# ------------------------------------------------------------- 9


def test_mix_reaches_shares_within_repeats(spark):
    sources = ("big", "mid", "tiny", None, "unlisted")
    docs = [(i, "palavra " * (5 + i % 7), sources[0 if i % 10 < 6 else 1 if i % 10 < 8 else 2 if i % 100 == 8 else 3 if i % 10 == 9 else 4]) for i in range(3000)] + [(9000, None, "big"), (9001, "", "mid")]
    # A source of three documents, an id that comes twice with its text, and one whose texts differ.
    docs += [(9100 + i, "palavra " * 12, "few") for i in range(3)] + [docs[0], docs[0], (1, "outra coisa", docs[1][2])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    goals = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.39, 3), ("tiny", 0.1, 5), ("few", 0.01, 9), ("absent", 0.0, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(df, goals).cache()
    assert {r["source"] for r in mixed.select("source").distinct().collect()} == {"big", "mid", "tiny", "few"}
    assert mixed.count() == mixed.select("doc_id", "source").distinct().count()
    got = {r["source"]: r for r in mixing.shares(mixed, goals).collect()}
    for k in ("big", "mid", "tiny"):
        assert abs(got[k]["share"] / got[k]["target_share"] - 1) < 0.05, (k, got[k])
    # One use more or less of a document is the least step of a source.
    total = sum(r["tokens"] for r in got.values())
    assert abs(got["few"]["tokens"] - 0.01 * total) <= 24 and got["absent"]["tokens"] == 0
    assert all(r["most_repeats"] <= r["max_repeats"] for r in got.values())
    order = [r["place"] for r in mixing.sequence(mixed).collect()]
    assert len(order) == mixed.agg(F.sum("repeats")).first()[0]
    assert sorted(map(tuple, mixing.mix(df.repartition(7), goals).collect())) == sorted(map(tuple, mixed.collect()))
    assert mixing.mix(df.limit(0), goals).count() == 0
    assert mixing.mix(df, goals.limit(0)).count() == 0


@pytest.mark.parametrize("rate, most", [(0.3, 1), (0.9, 2), (2.5, 4), (4.9, 5), (5, 5), (7, 5)])
def test_poisson_steps_have_the_wanted_mean(rate, most):
    steps = mixing.poisson_steps(rate, most)
    assert abs(sum(1 - s for s in steps) - min(rate, most)) < 1e-6
