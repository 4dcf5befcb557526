"""Language, quality, licences and benchmark passages: held-out accuracy, SQL and brute force."""

import random
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle.compare import compare, connect
from tests.conftest import SMALL
from tillwork.llm import decontamination, language, learning, licences, quality, registry, sql

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_agrees_with_sql(spark, name):
    assert compare(registry.QUERIES[name](spark, SMALL), connect(SMALL), registry.SQL[name]) == ""


def test_held_out_rows_are_those_of_the_crc(spark):
    import zlib
    got = {r["id"]: r["held"] for r in spark.range(200).withColumn("held", learning.held_out("id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    got = registry.QUERIES["op3_language"](spark, MIDDLE).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in got)
    assert len(got) > 200 and right >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_tables(docs, spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chat et le chien", "fr"), ("el gato y el perro", "es")] * 12)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 !!! 456", "fr"), (903, "el perro", None), (None, "der Hund", "de"), (903, "the dog", "en")]
    df = docs(rows).withColumn("text_", F.lit("x")).withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in language.identify(df, language.fit_languages(df)).collect()]
    found = {(r[0], r[2]) for r in got}
    assert len(got) == len(rows) and {(900, "und"), (901, "und"), (902, "und"), (None, "de"), (903, "es"), (903, "en")} <= found
    assert all(r[3] == 0 for r in got if r[2] == "und")
    empty = docs([])
    assert language.identify(empty, language.fit_languages(empty)).collect() == []
    unlabelled = docs([(1, "words", None)])
    assert [r["lang_pred"] for r in language.identify(unlabelled, language.fit_languages(unlabelled)).collect()] == ["und"]


def test_shares_of_any_number_of_rows(spark):
    ids = spark.range(400000)
    for rows, bound in ((100_000_000_000, 10_000_000_000), (100_000_000_000, 25_000_000), (400000, 400000), (3, 5)):
        got = ids.where(learning.hashed_share("id", rows, bound)).count()
        want = 400000 * min(1, bound / rows)
        assert abs(got - want) <= 5 * want ** 0.5 + 1e-9
    # A share far below a millionth still has a limit above zero.
    plan = ids.where(learning.hashed_share("id", 100_000_000_000, 2000))._jdf.queryExecution().optimizedPlan().toString()
    assert str((2000 << 63) // 100_000_000_000) in plan


def test_signs_that_are_no_letters_are_undetermined(docs):
    model = language.fit_languages(docs([(i, t, x) for i, (t, x) in enumerate([("der Hund", "de"), ("the dog", "en")] * 12)]))
    got = language.identify(docs([(1, "½ ²"), (2, "Ⅷ"), (3, "1_2"), (4, "ª"), (5, "中")]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in got} == {1: True, 2: True, 3: True, 4: False, 5: False}


def test_families():
    assert language.family_of("de") == language.family_of("en") != language.family_of("fr") and language.family_of("xx") == "xx"


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    got = registry.QUERIES["op1_quality"](spark, MIDDLE).join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_quality_of_odd_tables(docs, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    rows = [(1, "plain words of a text"), (2, None), (3, ""), (3, "$$$ !!! %%%"), (None, "x"), (4, "word " * 60000)]
    got = quality.score_quality(docs(rows), quality.fit_quality(docs(rows), labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.fit_quality(docs(rows), labels.limit(0))
    assert {r["score"] for r in quality.score_quality(docs(rows), none).collect()} == {0.5}
    assert quality.score_quality(docs([]), quality.fit_quality(docs([]), labels)).collect() == []


def test_prior_and_risk_of_known_mixtures():
    r = np.random.default_rng(3)
    p = r.normal(1.5, 1, (3000, 3))
    for share in (0.4, 0.8):
        good = int(4000 * share)
        u = np.vstack([r.normal(1.5, 1, (good, 3)), r.normal(-1.5, 1, (4000 - good, 3))])
        assert abs(quality.class_prior(p, u[r.permutation(4000)]) - share) < 0.08
        w = quality.non_negative_fit(p, u, share)
        side = np.hstack([u, np.ones((4000, 1))]) @ w > 0
        assert (side == (np.arange(4000) < good)).mean() > 0.97


def dice_brute(text, threshold):
    import re
    from collections import Counter
    norm = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda w: Counter(zip(w, w[1:]))
    out = {}
    for place, line in enumerate((text or "").split("\n")):
        a = grams(norm(line))
        best = max(((2 * (a & b).total() / (a.total() + b.total()), name) for name, t in licences.TEMPLATES.items()
                    for b in [grams(norm(t))]), key=lambda x: x[0]) if a else (0, "")
        if best[0] >= threshold:
            out[place] = (best[1], round(best[0], 6))
    return out


def test_licences_equal_brute_force(docs):
    random.seed(1)
    rows = []
    for i, notice in enumerate(list(licences.TEMPLATES.values()) * 3):
        words = notice.split()
        for _ in range(i // len(licences.TEMPLATES)):
            words[random.randrange(len(words))] = random.choice(["other", "the", "License"])
        rows.append((i, f"some text\n{' '.join(words)}\nmore of it"))
    rows += [(900, None), (901, ""), (902, "MIT"), (903, "w " * 70000), (904, "MIT License MIT License Released under the MIT License")]
    rows += [(905, rows[0][1]), (905, rows[0][1])]
    got = {}
    for r in licences.licence_notices(docs(rows).withColumn("n", F.lit("clash"))).where("kind = 'line'").collect():
        got.setdefault(r["doc_id"], {})[r["place"]] = (r["licence"], r["dice"])
    want = {i: found for i, t, *_ in rows if (found := dice_brute(t, 0.8))}
    assert {i: {k: v[1] for k, v in x.items()} for i, x in got.items()} == {i: {k: v[1] for k, v in x.items()} for i, x in want.items()}
    assert licences.licence_notices(docs([])).collect() == []


def test_templates_in_other_scripts_and_ties(docs):
    templates = {"b": "настоящая лицензия разрешает любое использование текста", "a": "настоящая лицензия разрешает любое использование текста",
                 "c": "эта совсем другая короткая запись здесь"}
    rows = [(1, "Настоящая лицензия разрешает любое использование текста!\nи ещё одна длинная строка без всякого смысла"), (2, "эта совсем другая запись")]
    got = [(r["doc_id"], r["kind"], r["place"], r["licence"], r["dice"]) for r in licences.licence_notices(docs(rows), templates).collect()]
    assert got == [(1, "line", 0, "a", 1.0)]


def test_a_notice_over_several_lines(docs):
    words = licences.TEMPLATES["MIT (permission)"].split()
    text = "Title\n\n" + "\n".join(" ".join(words[k:k + 9]) for k in range(0, len(words), 9)) + "\n\nThe rest"
    assert [(r["kind"], r["licence"]) for r in licences.licence_notices(docs([(1, text)])).collect() if r["dice"] == 1] == [("paragraph", "MIT (permission)")]


def test_notices_inside_longer_lines(docs):
    header = licences.TEMPLATES["GPL-3.0 (header)"].split()
    wrapped = "\n".join(" ".join(header[k:k + 9]) for k in range(0, len(header), 9))
    code = "\n".join(f"int value{i} = call{i}(x, y{i});" for i in range(40))
    mit = licences.TEMPLATES["MIT"]
    rows = [(1, f"Copyright 2024 Example Inc. {mit}"),
            (2, "Copyright (c) 2024 X. Licensed under the Apache License, Version 2.0."),
            (3, f"Acme tool\n{wrapped}\n{code}"),
            (4, f"some words {mit} and some more, {licences.TEMPLATES['CC-BY-4.0']} The end"),
            (5, f"first line\n{mit}\nlast line"), (6, f"{code} under the terms of a license"), (7, f"{mit} " * 50)]
    got = {}
    for r in licences.licence_notices(docs(rows)).collect():
        got.setdefault(r["doc_id"], []).append((r["place"], r["kind"], r["licence"], r["dice"]))
    got = {k: sorted(v) for k, v in got.items()}
    assert got[1] == [(4, "window", "MIT", 1)] and got[2] == [(4, "window", "Apache-2.0", 1)]
    assert got[3] == [(2, "window", "GPL-3.0 (header)", 1)]
    assert got[4] == [(2, "window", "MIT", 1), (10, "window", "CC-BY-4.0", 1)]
    assert got[5] == [(1, "line", "MIT", 1)] and 6 not in got
    assert [x for x in got[7] if x[1:] == ("window", "MIT", 1)] == [(5 * i, "window", "MIT", 1) for i in range(50)]


def test_common_words_equals_the_table():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = [0, *(0 for _ in b)] if not row else row
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randint(0, 15))] for _ in range(2))
        assert decontamination.common_words(a, b) == table(a, b)


VOICE = ["".join(x) for x in __import__("itertools").product("bdfgklmnprst", "aeiou", "lnrs")]


def test_leaks_are_found_and_clean_documents_are_not(spark, docs):
    r = random.Random(8)
    text = lambda n: " ".join(r.choices(VOICE, k=n))
    items = [(i, f"{text(r.randint(12, 50))}. {text(6)}.") for i in range(40)]
    bench = spark.createDataFrame(items + [(90, None), (91, ""), (92, "two words")], "item_id long, text string")
    rows, want = [], set()
    for i in range(300):
        body = text(r.randint(20, 400)).split()
        if i % 3 == 0:
            item = items[i % 40]
            words = item[1].split()
            if i % 2:
                words[r.randrange(len(words) - 6)] = "changed"
            at = r.randrange(len(body))
            body[at:at] = words
            want.add((i, item[0]))
        rows.append((i, " ".join(body)))
    rows += [(900, None), (901, ""), (902, items[3][1].upper()), (903, items[4][1] + " " + text(60000))]
    want |= {(902, 3), (903, 4)}
    found = decontamination.leaks(docs(rows).withColumn("item_id", F.lit("clash")), bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == want
    assert decontamination.leaks(docs([]), bench).collect() == []
    assert decontamination.leaks(docs(rows), bench.limit(0)).collect() == []
    blocks = decontamination.leaks(docs(rows), bench, block_items=15).collect()
    assert {(x["doc_id"], x["item_id"]) for x in blocks} == want


def test_no_paraphrase_is_lost_before_the_word_check(spark, docs):
    r = random.Random(18)
    text = lambda n: r.choices(VOICE, k=n)
    items = [(i, text(r.randint(10, 94)), text(6)) for i in range(60)] + [(60, text(3000), text(6))]
    bench = spark.createDataFrame([(i, f"{' '.join(q)}. {' '.join(a)}.") for i, q, a in items], "item_id long, text string")
    rows, want = [], set()
    for n in range(300):
        i, q, a = items[n % 61]
        kept = set(r.sample(range(len(q)), round(len(q) * r.uniform(0.55, 0.85)))) if i < 60 else set(range(3000))
        part = [w if k in kept else r.choice(VOICE) for k, w in enumerate(q)] + a
        rows.append((n, " ".join([*text(r.randint(0, 300)), *part, *text(r.randint(0, 300))])))
        if decontamination.common_words(q + a, part) >= 0.6 * len(q + a):
            want.add((n, i))
    found = {(x["doc_id"], x["item_id"]) for x in decontamination.leaks(docs(rows), bench).collect()}
    assert len(want) > 200 and want <= found
    assert all(i == n % 61 for n, i in found)


def test_a_better_copy_without_the_answer_hides_none(spark, docs):
    r = random.Random(28)
    q, a, other = r.sample(VOICE, 40), r.sample(VOICE, 6), lambda n: [f"zz{r.random()}"[:9].replace(".", "") for _ in range(n)]
    bench = spark.createDataFrame([(1, f"{' '.join(q)}. {' '.join(a)}.")], "item_id long, text string")
    text = [*other(99), *q[:25], *other(15), *a, *other(300), *q[:34], *other(99)]
    assert [x["item_id"] for x in decontamination.leaks(docs([(1, " ".join(text))]), bench).collect()] == [1]


def test_every_leak_of_the_small_tables(spark):
    con = duckdb.connect()
    want = con.execute(f"""SELECT doc_id, item_id FROM '{MIDDLE}/documents.parquet' d, '{MIDDLE}/benchmark.parquet' b
        WHERE contains(d.text, b.text)""").fetchall()
    got = {(r["doc_id"], r["item_id"]) for r in registry.QUERIES["op9_benchmark_leaks"](spark, MIDDLE).collect()}
    assert set(want) <= got and len(got) <= len(want) + 3
    assert sql.LICENCES.startswith("\nWITH")


def test_possible_candidates_equal_brute_force():
    random = np.random.default_rng(5)
    names = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join(random.choice(names, 20)), None) for i in range(6)]
    weights = random.random(decontamination.SIZE).astype("float32") + 0.1
    items = decontamination.Items(rows, np.ones((decontamination.SIZE, decontamination.RANK), "float32"), weights, 8, 0.8, 0.6)
    ids = decontamination._word_ids(" ".join([*random.choice(names, 3000), *(r[1] for r in rows)]))
    # Item 0 has windows all over the text, the others a few, and some are given twice.
    item = np.concatenate([np.zeros(2900, "int64"), random.integers(1, 6, 40), np.arange(6), np.arange(6)])
    begin = np.concatenate([np.arange(2900), random.integers(0, 2900, 40), 3000 + 20 * np.arange(6), 3000 + 20 * np.arange(6)])
    end = np.minimum(begin + 30, len(ids))
    want = set()
    for i, a, b in zip(item.tolist(), begin.tolist(), end.tolist()):
        rare = np.flatnonzero(np.unpackbits(items.rarer[i]))
        if np.isin(ids[a:b], rare).sum() >= items.needed[i]:
            want.add((i, a, b))
    got = list(items.possible(ids, item, begin, end))
    assert sorted(got) == sorted(want) and {(i, 3000 + 20 * i) for i in range(6)} <= {g[:2] for g in got}


def test_items_are_looked_up_once_for_many_small_candidate_sets():
    parts = [(np.array([k % 5]), np.array([k]), np.array([k + 8])) for k in range(1000)] + [(np.zeros(0, "int64"),) * 3]
    got = list(decontamination._together(iter(parts)))
    assert len(got) == 1 and got[0][1].tolist() == list(range(1000))
    assert [len(x[0]) for x in decontamination._together(iter(parts), 300)] == [300, 300, 300, 100]


def test_only_letters_and_digits_join_words():
    from tillwork.llm.shingles import word_hashes
    assert (word_hashes("Grüße — naïve“quoted”…x") == word_hashes("grüße naïve quoted x")).all()
    assert len(word_hashes("a\x7fb")) == 2


def test_a_fit_holds_one_matrix():
    r = np.random.default_rng(3)
    x, y = np.hstack([r.random((4000, 500), "float32"), np.ones((4000, 1), "float32")]), np.where(np.arange(4000) % 2, 1, -1).astype("float32")
    tracemalloc.start()
    try:
        w = learning.linear_svm(x, y, turns=3)
        assert tracemalloc.get_traced_memory()[1] < x.nbytes / 2
    finally:
        tracemalloc.stop()
    assert len(w) == 501


def test_features_are_in_the_order_of_the_other_columns(spark):
    rows = spark.createDataFrame([(k, f"word{k} " * (k + 1)) for k in range(50)], "k int, text string").repartition(7)
    x, (keys,) = learning.matrix(learning.featured(rows, learning.byte_grams, "k int"), "k", ones=True)
    assert x.shape == (50, 2049) and sorted(keys) == list(range(50))
    for row, k in zip(x, keys):
        assert (row == np.append(learning.byte_grams(f"word{k} " * (k + 1)), np.float32(1))).all()
