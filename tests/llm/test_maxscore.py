"""Exact top-k by MaxScore against all scores."""

import numpy as np
from pyspark.sql import functions as F

from tillwork.llm import maxscore

SCHEMA = "vec_id long, embedding array<double>, row int, score string"


def held(score, limit=1 << 63):
    return min(max(score, -limit), limit - 1)


def all_scores(rows, k, every, scale=256):
    good = [(i, n, [int(np.floor(scale * x)) if abs(x) < 1e12 else int(x) * scale for x in v]) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, n, q in good:
        if i is not None and i % every == 0:
            found = sorted(((-held(sum(a * b for a, b in zip(q, v))), j is None, j or 0, m) for j, m, v in good if m != n))[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, m) in enumerate(found)]
    return sorted(out, key=str)


def answers(spark, rows, k=5, every=10, **options):
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    got = maxscore.top_by_inner_product(table, F.col("vec_id") % every == 0, k=k, **options)
    return sorted([tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()], key=str)


def test_best_rows_of_many_runs_are_those_of_all_scores():
    r = np.random.default_rng(3)
    for width in (1, 5, 64):
        x = np.floor(256 * r.normal(size=(900, width)) / np.sqrt(width))
        x[100:400] = x[7]  # ties
        q = x[::60]
        own = np.arange(0, 900, 60)
        for run in (16, 128, 4096):
            best, scores = maxscore.best_rows(x, q, own, 5, run)
            for i, o in enumerate(own):
                full = x @ q[i]
                full[o] = -np.inf
                want = np.lexsort((np.arange(900), -full))[:5]
                assert best[i].tolist() == want.tolist() and scores[i].tolist() == full[want].tolist()


def test_terms_that_cannot_win_are_not_traversed():
    x = np.zeros((300, 8))
    x[:, 7] = np.arange(300) % 3  # a weak term
    x[:40, 0] = np.arange(40) + 100
    seen = []

    class Spied(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and len(key) == 2 and isinstance(key[1], np.ndarray) and key[1].ndim == 1 and key[0].ndim == 2:
                seen.append(len(key[1]))
            return super().__getitem__(key)

    best, scores = maxscore.best_rows(x, x[[30]], np.array([30]), 3, run=50)
    full = x @ x[30]
    full[30] = -1
    assert best[0].tolist() == np.lexsort((np.arange(300), -full))[:3].tolist()
    bounds = np.maximum(x[30] * x[50:].max(axis=0), 0)
    assert bounds.sum() < scores[0][-1]  # later runs are skipped as a whole


def test_ties_repeats_nulls_and_lengths(spark):
    r = np.random.default_rng(5)
    rows = [(n, (r.normal(size=6) / 2).tolist()) for n in range(120)]
    rows += [(200 + n, rows[20][1]) for n in range(30)]  # copies: ties by id
    rows += [(20, rows[20][1]), (20, rows[20][1]), (30, rows[31][1]), (None, rows[20][1]), (None, rows[40][1])]
    rows += [(300, None), (310, [0.1, None]), (320, [float("nan")]), (330, [float("inf"), 1.0]), (340, []), (350, [0.5]),
             (360, [0.0] * 6), (370, [1.0] * 9), (380, [-1.0] * 6), (2 ** 62, [0.25] * 6)]
    for options in ({}, {"shard_rows": 9, "block_rows": 3}):
        assert answers(spark, rows, **options) == all_scores(rows, 5, 10)


def test_large_numbers_stay_exact(spark):
    rows = [(0, [3e7, 1.0, 2.0 ** 40]), (1, [2.0 ** 25, 0.25, 2.0 ** 20]), (2, [2.0 ** 25, 0.5, 2.0 ** 20]),
            (3, [2.0 ** 25 + 0.5, 0.0, 0.0]), (10, [2.0 ** 53, 1.0, -1.0]), (4, [0.001, 0.002, 0.003])]
    assert answers(spark, rows, k=3) == all_scores(rows, 3, 10)


def test_few_rows_and_empty_tables(spark):
    assert answers(spark, []) == []
    assert answers(spark, [(0, [1.0])]) == []
    assert answers(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert answers(spark, [(0, [1.0]), (2, [0.5])]) == [(0, 1, 2, 256 * 128)]
    assert answers(spark, [(0, []), (2, []), (1, [])], k=1) == [(0, 1, 1, 0)]
