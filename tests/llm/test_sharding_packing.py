"""Shards and packed sequences: laws, exact round trips, edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwork.llm import packing, sharding

EDGES = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "other"), (None, "no id"), (4, "ü" * 5000), (5, " \n  x  ")]


def test_shards_are_near_equal_and_gapless(spark, docs):
    random.seed(5)
    rows = [(i, "x" * random.choice([0, 1, 50, 400, 3000])) for i in range(700)] + EDGES
    got = sharding.balanced_shards(docs(rows).withColumn("size", F.lit("clash")), shards=7).collect()
    assert len(got) == len(rows)
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for shard in range(7):
        own = [r for r in got if r["shard"] == shard]
        assert abs(sum(r["size"] for r in own) - total / 7) <= largest
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    place = sorted((r["shard"], r["slot"], r["doc_id"] or -1) for r in got)
    assert [p[2] for p in place] == sorted(p[2] for p in place)


def test_no_documents_and_few_documents(docs):
    assert sharding.balanced_shards(docs([])).collect() == []
    assert len({r["shard"] for r in sharding.balanced_shards(docs([(1, "a"), (2, "a")]), shards=40).collect()}) == 2
    assert packing.pack(packing.token_pieces(docs([]))).collect() == []
    with pytest.raises(ValueError):
        sharding.balanced_shards(docs([]), shards=0)


def test_word_cache_gives_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.tokenizer_path())
    encoder = packing.WordIds(packing.tokenizer_path(), words=300)
    parts = [" ", "  ", "\n", "\t", "a", "b1", "é", ".", "'s", "<|endoftext|>", "中", "\r\n", "\x1c", "　", "\x85", "word,", "I'll"]
    random.seed(2)
    texts = ["".join(random.choices(parts, k=random.randint(0, 14))) for _ in range(1500)]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(60).collect()]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.tokenizer_path())
    random.seed(3)
    rows = EDGES + [(100 + i, " ".join(random.choices(["one", "two", "three,", "vier"], k=random.choice([1, 5, 5, 5, 30, 90]))))
                    for i in range(200)]
    got = packing.pack(packing.token_pieces(docs(rows), capacity=64, keep_ids=True), capacity=64).collect()
    tokens = sorted([*plain.encode(t or "", add_special_tokens=False).ids, 0] for _, t, *_ in rows)
    whole = {}
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) <= 64
    assert sum(r["length"] for r in got) == sum(map(len, tokens))
    for r in got:
        whole.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in whole.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(whole) <= -(-sum(map(len, tokens)) // 64) * 1.1 + 1
    for doc in {r["doc_id"] if "doc_id" in r else r["id"] for r in got if r["id"] not in (3,)}:
        mine = sorted((r["piece"], r["start"], r["length"]) for r in got if r["id"] == doc)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert all(length == 64 for _, _, length in mine[1:])


def test_plan_equals_best_fit_over_single_documents():
    random.seed(9)
    for _ in range(30):
        lengths = [random.randint(1, 40) for _ in range(random.randint(1, 120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        steps = packing.plan(counts, 40)
        bins = []
        for x in sorted(lengths, reverse=True):
            fit = [b for b in bins if b >= x]
            if fit:
                bins.remove(min(fit))
                bins.append(min(fit) - x)
            else:
                bins.append(40 - x)
        assert max(s[3] + s[2] - s[1] for s in steps) + 1 == len(bins)
        assert sum(s[2] - s[1] + 1 for s in steps) == len(lengths)


def test_a_length_that_a_third_shares(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same words here"))
                                  .otherwise(F.repeat(F.lit("w "), (F.col("id") % 50).cast("int"))).alias("text"))
    got = packing.pack(packing.token_pieces(df, capacity=128), 128)
    assert got.count() == 3000 and got.select("sequence_id", "offset").distinct().count() == 3000
