"""Lines, similar texts, vectors, repeats and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import forest, graph, lines, repeats, vectors
from tillwork.llm.shingles import shingle_set


def groups(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(201, 260)] + [(300, 300), (210, 400), (400, 20)]
    random.shuffle(edges)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if n != 300}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_are_runs_of_letters_and_digits(spark):
    from tillwork.llm.shingles import word_hashes
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    seen = {}
    for text in [*texts, "", "  ", "a", "!a", "a!", "é b", "x_y", "A1 b2", "ß Straße…“quoted”", "中文。字"]:
        words = re.sub(r"[^\w]+|_+", " ", text.lower()).split()
        hashes = word_hashes(text).tolist()
        assert len(words) == len(hashes)
        for word, h in zip(words, hashes):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) > 1000


WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "no", "si") for b in ("ra", "len", "s", "tor", "ma", "dig", "vu", "pek")]


def words(k, seed):
    return random.Random(seed).choices(WORDS, k=k)


def edited(base, seed, changes=1):
    out, r = list(base), random.Random(seed)
    for _ in range(changes):
        out[r.randrange(len(out))] = r.choice(WORDS) + "x"
    return out


def test_lines_keep_one_of_each_component(docs):
    base = [words(40, i) for i in range(12)]
    rows, n = [], 0
    for i in range(150):
        kind = i % 5
        text = [" ".join(edited(base[i % 12], i, kind)) if kind < 3 else " ".join(words(30, 1000 + i)) for _ in range(1)]
        rows.append((i, "\n".join([*text, "common footer line", "", "  " + text[0].upper() + " " if kind == 3 else "own " + str(i * 7919)])))
    rows += [(900, None), (901, ""), (902, "\n\n"), (902, "common footer line"), (903, "x" * 70000), (903, "x" * 70000)]
    got = lines.line_classes(docs(rows)).collect()
    place, sets = {}, {}
    for doc, text, *_ in rows:
        for no, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"\s+", " ", line.lower()).strip()
            if norm:
                place.setdefault(norm, (doc, no))
                place[norm] = min(place[norm], (doc, no))
                starts = [k for k in range(len(norm)) if not re.match("[a-z0-9]", norm[k - 1:k] if k else " ")]
                sets[norm] = {norm[k:k + 10] for k in starts}
    names = sorted(place)
    edges = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]
             if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    comp = groups(names, edges)
    first = {}
    for name, c in comp.items():
        first[c] = min(first.get(c, (10 ** 9, 0)), place[name])
    text_of = {}
    for doc, text, *_ in rows:
        for no, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"\s+", " ", line.lower()).strip()
            if norm:
                text_of.setdefault((doc, no), set()).add(first[comp[norm]])
    assert len(edges) > 50
    for r in got:
        assert (r["first_id"], r["first_no"]) in text_of[r["id"], r["no"]]
    kept = {(r["id"], r["no"]) for r in got if r["kept"]}
    assert kept == set(first.values())


def test_lines_equal_brute_force_over_all_characters(docs):
    r = random.Random(6)
    apart = ["session 1704067200123", "session 1704067200999", "order1000000001", "order1000000002", "Donaudampfschifffahrt beginnt", "Donaudampfmaschine beginnt"]
    hexes = ["".join(r.choices("0123456789abcdef", k=120)) for _ in range(12)]
    near = [x for h in hexes for x in (h, "_" + h[1:], h[:-1] + "_", h[:60] + "_" + h[61:])]
    found = [" ".join(words(60, 300 + i)) for i in range(12)]
    near += [x for t in found for x in (t, "x" + t, t + "s")]
    texts = apart + near
    got = {x["id"]: x["first_id"] for x in lines.line_classes(docs(list(enumerate(texts)))).collect()}
    chars = [{t.lower()[k:k + 10] for k in range(len(t))} for t in texts]
    starts = [set(re.findall(r"(?<![a-z0-9])(?=([a-z0-9]{11,}|.{1,10}))", t.lower())) for t in texts]
    edges = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
             if any(len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]) for s in (chars, starts))]
    assert got == groups(range(len(texts)), edges) and len(edges) > 60
    assert all(got[i] == i for i in range(len(apart)))


def test_band_keys_depend_on_the_set_alone(spark):
    r = random.Random(2)
    own = [r.randrange(-2 ** 63, 2 ** 63) for _ in range(200)]
    lists = [own, own + own[:1] * 5000, own[::-1] + own[:20] * 50]
    keys = lines.band_keys(F.col("h"), 8, 3)
    got = [x["k"] for x in spark.createDataFrame([(h,) for h in lists], "h array<long>").select(keys.alias("k")).collect()]
    assert got[0] == got[1] == got[2] and len(got[0]) == 8


def test_a_frequent_word_of_short_lines_is_no_band(spark):
    rows = [(i, f"common {'bcdfghjklm'[i % 10]}{i} item{i * 7919} of{i * 31}") for i in range(600)]
    keys = lines.line_bands(F.col("line"), 10, 8, 3)
    banded = spark.createDataFrame(rows, "i int, line string").select("i", F.explode(keys).alias("band")).distinct()
    assert banded.select("i").distinct().count() == 600
    assert (banded.groupBy("band").count().agg(F.max("count")).first()[0] or 0) <= 3


def test_short_sets_of_the_similarity_share_a_band(spark):
    r, rows = random.Random(4), []
    for n in range(1, 16):
        for _ in range(40):
            own = [r.randrange(-2 ** 63, 2 ** 63) for _ in range(n)]
            other = own + [r.randrange(-2 ** 63, 2 ** 63) for _ in range(n // 4)]  # similarity of 0.8 or more
            rows.append((own, other))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select(
        *(lines.band_keys(F.col(c), 8, 3).alias(c) for c in "ab"))
    missed = df.where(~F.arrays_overlap("a", "b")).count()
    assert missed <= 0.01 * len(rows)


def test_lines_fold_every_kind_of_blank(spark, docs):
    texts = ["One\ttwo  three\x0bfour\r", " one two three four", "\t \r", "one two\x0c\x0cthree four "]
    got = {r["id"]: r["line"] for r in lines.split_lines(docs(list(enumerate(texts))), "doc_id", "text").collect()}
    assert got == {i: re.sub(r"[ \t\n\x0b\f\r]+", " ", t.lower()).strip(" ") for i, t in enumerate(texts) if i != 2}


def test_lines_are_taken_out_of_texts(spark, docs):
    rows = [(1, "first line of all\nfooter of the site"), (2, "second line here\nfooter of the site\n"), (3, "first line of all"), (4, ""), (5, None)]
    df = docs(rows).withColumn("__x", F.lit(1)).withColumn("n_chars", F.length("text"))
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.without_repeated_lines(df).collect()}
    assert got == {1: ("first line of all\nfooter of the site", 36), 2: ("second line here\n", 17), 4: ("", 0), 5: (None, None)}
    assert lines.without_repeated_lines(docs([])).collect() == []


def similar_brute(rows):
    sets = {i: frozenset(shingle_set(t).tolist()) for i, t, *_ in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    return links, groups(list(sets), links)


@pytest.mark.parametrize("chunk", [256, 5])
def test_similar_texts_equal_brute_force(docs, chunk):
    rows = [(i, " ".join(edited(words(120, i % 9), i, i % 4))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "!!"), (203, "two words"), (204, "Two, WORDS!"), (205, " ".join(words(30000, 5))),
             (206, rows[0][1]), (207, rows[0][1].upper())]
    got = {r["doc_id"]: r for r in forest.similar_texts(docs(rows), chunk_rows=chunk).collect()}
    links, comp = similar_brute(rows)
    assert len(links) > 100 and len(got) == len(rows)
    for i in comp:
        assert got[i]["n_links"] == sum(i in e for e in links), i
        assert (got[i]["component_id"], got[i]["kept"]) == (comp[i], comp[i] == i)
    assert got[204]["class_id"] == 203 and got[207]["class_id"] == 0


def test_similar_texts_of_odd_tables(docs):
    assert forest.similar_texts(docs([])).collect() == []
    got = forest.similar_texts(docs([(7, "one two three four five six"), (7, "one two three four five six"), (None, "x")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"], r["kept"]) for r in got) == [(0, 0, True), (7, 1, True), (7, 1, True)]


def test_prefixes_are_shortened_to_the_recall():
    assert forest.prefix_length(0.8, 0.999) == 5 and forest.prefix_length(0.8, 0.9) > forest.prefix_length(0.8, 0.9999)
    with pytest.raises(ValueError):
        forest.prefix_length(0.05, 0.9999, trees=2)


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_equal_brute_force(spark, block):
    r = np.random.default_rng(4)
    base = r.standard_normal((15, 12))
    rows = [(int(i), (base[i % 15] + 0.07 * r.standard_normal(12)).astype("float32").tolist(), int(i % 3)) for i in range(150)]
    rows += [(500, rows[0][1], 0), (501, [2 * x for x in rows[0][1]], 0), (502, rows[0][1], None), (503, None, 0), (504, [0.0] * 12, 0),
             (505, [float("nan")] * 12, 0), (506, [None] * 12, 0), (507, [1.0], 0), (508, [], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("near", F.lit("clash"))
    got = {x["vec_id"]: x for x in vectors.near_vectors(df, block=block).collect()}
    unit = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and None not in v and np.isfinite(v).all() and any(v):
            u = np.array(v, "float64")
            unit[i] = (label, u / np.linalg.norm(u))
    links = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1])
             and unit[a][1] @ unit[b][1] >= 0.98]
    comp = groups([i for i, *_ in rows if i is not None], links)
    assert len(links) > 50 and len(got) == len(rows)
    for i in comp:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (sum(i in e for e in links), comp[i], comp[i] == i)
    assert vectors.near_vectors(df.limit(0)).collect() == []


def test_suffix_order():
    r = np.random.default_rng(0)
    for _ in range(200):
        s = r.integers(1, int(r.integers(2, 6)), int(r.integers(1, 300)))
        v = s.tolist()
        assert repeats.suffix_order(s).tolist() == sorted(range(len(v)), key=lambda i: v[i:])


def cut_brute(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(raw[s:s + length])
        keep = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for x in range(len(raw)) if gone[x] and (x == 0 or not gone[x - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(keep).hexdigest())
    return out


@pytest.mark.parametrize("hot", [5000, 2])
def test_repeats_equal_brute_force(docs, hot):
    passage = " ".join(words(25, 77))
    rows = [(i, " ".join(edited(words(60, i % 6), i, i % 5)) + (passage if i % 3 == 0 else "") + " é" * (i % 4)) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "short"), (103, "ab" * 400), (104, "x" * 99), (105, "x" * 100), (106, "x" * 101),
             (107, rows[0][1]), (108, rows[0][1]), (109, "zz" + rows[5][1] + rows[5][1])]
    got = {r["doc_id"]: tuple(r)[1:] for r in repeats.without_repeats(docs(rows), hot=hot).collect()}
    assert got == cut_brute(rows, 100)


def test_repeats_of_rows_without_an_id(docs):
    text = "".join(random.Random(4).choices("abcdefgh ", k=150))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in repeats.without_repeats(docs(
        [(None, text), (1, "abc " + text + " xyz"), (2, "other " * 3)])).collect()}
    assert got == {None: (150, 0, 0), 1: (158, 150, 1), 2: (18, 0, 0)}


def test_repeats_of_odd_tables(docs):
    assert repeats.without_repeats(docs([])).collect() == []
    text = "y" * 50 + "z" * 70
    got = sorted(tuple(r)[1:4] for r in repeats.without_repeats(docs([(1, text), (1, text), (1, text[::-1])])).collect())
    assert got[-1] == (120, 120, 1) and [g[1] for g in got] == [0, 0, 120]


def test_only_pairs_that_may_be_similar_are_compared(spark):
    r, texts = random.Random(8), []
    for i in range(12):  # a line, edits of it that come nearer and nearer to the least similarity, and unlike lines
        own = words(60, 700 + i)
        texts += [" ".join(own), *(" ".join([*own[:k], "edited", *own[k + 1 + k % 4:]]) for k in r.sample(range(60), 6))]
        texts += [" ".join(words(3 + 20 * k, 900 + 9 * i + k)) for k in range(4)] + [("%032x" % r.getrandbits(128)) * 3]
    sets = spark.createDataFrame(list(enumerate(texts)), "key int, line string").select(
        "key", "line", *(F.size(F.array_distinct(lines.cuts(F.col("line"), 10)[n])).alias(n) for n in lines.KINDS))
    marked = lines.with_parities(sets, 10)
    assert marked.count() == len(texts)
    sides = [marked.select(*(F.col(c).alias(f"{c}_{n}") for c in marked.columns)) for n in "ab"]
    kept = {tuple(x) for x in sides[0].crossJoin(sides[1]).where(F.col("key_a") < F.col("key_b")).where(
        lines.may_be_similar("words", 0.8) | lines.may_be_similar("chars", 0.8)).select("key_a", "key_b").collect()}
    chars = [{t[k:k + 10] for k in range(len(t))} for t in texts]
    starts = [set(re.findall(r"(?<![a-z0-9])(?=([a-z0-9]{11,}|.{1,10}))", t)) for t in texts]
    every = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    similar = {(a, b) for a, b in every if any(len(s[a] & s[b]) >= 0.8 * len(s[a] | s[b]) for s in (chars, starts))}
    assert len(similar) > 100 and similar <= kept
    assert len(kept - similar) < len(every) / 50


def test_a_pair_of_many_bands_is_one_row(spark, docs):
    texts = [" ".join([*words(60, 1), *words(1, 50 + k)]) for k in range(6)]
    sets = spark.createDataFrame(list(enumerate(texts)), "key int, line string").select(
        "key", "line", *(F.size(F.array_distinct(lines.cuts(F.col("line"), 10)[n])).alias(n) for n in lines.KINDS))
    bands = [(band, key, key) for band in range(5) for key in range(6) if (band + key) % 5]  # two lines share three bands or more
    banded = spark.createDataFrame(bands, "band long, key int, component int")
    got = sorted(tuple(x) for x in lines.possible_pairs(banded, lines.with_parities(sets, 10), 0.8).collect())
    assert got == [(a, b) for a in range(6) for b in range(a + 1, 6)]
