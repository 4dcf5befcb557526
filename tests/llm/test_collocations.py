"""Collocations against counts by brute force."""

import random
import re
from collections import Counter

import pytest

from tillwork.llm import collocations

UPPER = {i: i + 32 for i in range(65, 91)}


def expected(rows, least, top=2000, scale=2_000_000):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    longer = Counter()
    for (lang, p), a in counts.items():
        if len(p) > 2 and a >= least:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[lang, p[i:i + k]] = max(longer[lang, p[i:i + k]], a)
    found = {}
    for (lang, p), a in counts.items():
        if len(p) > 1 and a >= least and 100 * longer[lang, p] < 80 * a:
            cut = min((scale * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
            found.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), a, counts[lang, p[:cut[1]]], counts[lang, p[cut[1]:]]))
    return sorted((lang, n + 1, p.decode(), a, left, right, totals[lang], -s) for lang, best in found.items()
                  for n, (s, _, p, a, left, right) in enumerate(sorted(best)[:top]))


def got(docs, rows, **options):
    return sorted(tuple(r) for r in collocations.collocations(docs(rows), **options).collect())


def corpus(seed, number=300):
    r = random.Random(seed)
    words = [a + b for a in ("ka", "lo", "MI", "rü", "te") for b in ("", "ra", "len", "中", "x-1")]
    weights = [1 / (k + 1) for k in range(len(words))]
    fixed = [" ".join(r.choices(words, k=k)) for k in (3, 4, 5, 9)]
    rows = []
    for i in range(number):
        parts = [r.choice(fixed) if r.random() < 0.3 else " ".join(r.choices(words, weights, k=r.randrange(1, 9)))
                 for _ in range(r.randrange(1, 9))]
        rows.append((i, "".join(p + r.choice([" ", ". ", ",", "\n", "\t", "?!", "\x0b", "  "]) for p in parts), r.choice(["de", "fr", None])))
    return rows


AWKWARD = [(None, None, None), (1, "", "de"), (2, " \t\n.", "de"), (3, "a" * 3000, "de"), (3, "ka lo", "de"), (3, "ka lo", "de"),
           (4, "x" + chr(0) + "y z " * 40, "fr"), (5, "\x85 q " * 40, "fr"), (6, "Ä ß " * 40, "und"), (7, "end ." * 50, "en")]


@pytest.mark.parametrize("least", [1, 3, 30])
def test_all_columns_by_brute_force(docs, least):
    rows = corpus(least) + AWKWARD
    assert got(docs, rows, least=least) == expected(rows, least)


def test_ranges_of_the_streams_may_be_cut_anywhere(spark, docs):
    rows = corpus(9)
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "61"}
    old = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        assert got(docs, rows, least=2) == expected(rows, 2)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_flushes_slices_and_a_full_bit_table(docs, monkeypatch):
    rows = corpus(4, 120) + AWKWARD
    words = collocations.Words()
    monkeypatch.setattr(collocations, "SLICE", 50)
    for _, text, _ in rows:
        words.add(text or "")
    small = words.take()
    monkeypatch.undo()
    for _, text, _ in rows:
        words.add(text or "")
    whole = words.take()
    assert small[1] == whole[1] and small[0].tolist() == whole[0].tolist()
    monkeypatch.setattr(collocations, "_bit_table", lambda hashes: (__import__("numpy").full(1 << 16, 255, "uint8"), 19))
    assert got(docs, rows, least=3) == expected(rows, 3)


def test_first_rows_only_and_large_products(spark, docs):
    rows = corpus(5)
    assert got(docs, rows, least=3, top=7) == expected(rows, 3, top=7)
    big = spark.range(1).selectExpr("9000000000000000000L as a", "9000000000000000000L as l", "9100000000000000000L as r")
    score = big.select(collocations._score(2_000_000, big.a, big.l, big.r).alias("s")).first()[0]
    assert score == 2_000_000 * 9000000000000000000 // 18100000000000000000


def test_empty_and_extra_columns(spark, docs):
    assert got(docs, [(1, "ka lo. mi", "de")], least=3) == []
    assert got(docs, [], least=1) == []
    table = docs([(1, "ka lo ka lo", "de")] * 2).selectExpr("*", "1 as a", "2 as n", "'x' as words", "0 as part", "0 as score")
    assert [tuple(r) for r in collocations.collocations(table, least=2).collect()] == expected([(1, "ka lo ka lo", "de")] * 2, 2)
