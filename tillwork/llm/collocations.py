"""Phrase collocations from count streams in prefix and in suffix order.

1. Counting. A task splits its texts into words, numbers them and adds up what it has. Words and
   their counts are summed over all tasks. Of pairs of neighbours only 64-bit hashes with counts are
   summed; the pairs that may reach the least count form a bit table of bounded size. A second
   read does the same for triples of such pairs, and on a third read only what both tables let
   through becomes phrases of two to four words, summed as strings: a phrase with the least count has
   no rarer pair or triple in it, and a collision only lets a phrase through that the exact count
   then removes.
2. Streams. The counts of all lengths together are sorted twice: by their words (prefix order) and
   by their words from the last to the first (suffix order). In prefix order the parts that begin a
   phrase come just before it, so one pass with a stack of open phrases, at most as deep as the
   longest phrase, gives the left counts of all cuts and the most frequent extension by a word on
   the right; suffix order gives right counts and extensions on the left. Nothing is looked up by
   hash. A stream is cut into ranges; the few open phrases at a cut are filled in from the ranges
   before (three for each cut at most).
3. Both results are merged in the order of the phrases; the cheapest cut is scored in decimals.

A longer phrase that holds another one inside holds an extension of it by one word, which is at least
as frequent: extensions by one word decide what is dropped.

A bit table has 32 bits for each entry, at most 2^29 bits (64 MB); beyond that it lets more through,
and the counts decide as before. No word or phrase is left out at any size.

Defined results: a null text has no words, a null language is ``und``; texts count once for each row,
repeated rows included; words and phrases never cross pieces or texts; a language without
phrases gives no rows, nor does an empty table; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from tillwork.llm.shingles import mix
from tillwork.session import written

BREAK = b"\xff"  # never part of UTF-8 text
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
# Upper case to lower case, the ends of pieces to BREAK, the tabulator to a space.
FOLD = bytes.maketrans(_UPPER + b".,;:!?\n\x0b\x0c\r\t", _LOWER + BREAK * 10 + b" ")
SLICE = 1 << 20  # bytes of a text that are split at a time
FLUSH, VOCABULARY = 1 << 21, 1 << 18  # running and different words that a task holds before it passes counts on
SEGMENT = 19  # bits of the bit table in one row
LONGEST = 4
MOST_BITS = 29


class Words:
    """The words of one language in a task, numbered from 1; 0 ends a piece."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = defaultdict(count(1).__next__)
        self.number[BREAK] = 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        data = text.encode("utf-8", "replace").translate(FOLD)
        at = 0
        while at < len(data):
            end = len(data) if at + SLICE >= len(data) else data.find(b" ", at + SLICE)
            end = len(data) if end < 0 else end
            tokens = data[at:end].replace(BREAK, b" \xff ").split()
            self.parts.append(np.fromiter(map(self.number.__getitem__, tokens), "int32", len(tokens)))
            self.size += len(tokens)
            at = end
        self.parts.append(np.zeros(1, "int32"))

    def take(self) -> tuple[np.ndarray, list[bytes]]:
        ids = np.concatenate(self.parts)
        words = [w for w, n in sorted(self.number.items(), key=lambda x: x[1])]
        self.__init__()
        return ids, words


def _word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode()) & 0xFFFFFFFF
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), "uint64", len(words))


def _levels(ids: np.ndarray, hashes: np.ndarray, tables: list[tuple[np.ndarray, int]], longest: int):
    """For phrases of 2, 3, ... words that no table rules out: length, first place, number and hash of each.

    A phrase is looked for where the phrases without its last and without its first word may be frequent.
    """
    follow, name_hash = np.where(ids > 0, 0, -1), None  # the number of the phrase that begins here
    for length in range(2, longest + 1):
        begin = np.flatnonzero((follow[:-1] >= 0) & (follow[1:] >= 0)) if length > 2 else np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        if not len(begin):
            return
        head = follow[begin].astype("int64") if length > 2 else ids[begin].astype("int64")
        _, first, inverse, number = np.unique(head << 32 | ids[begin + length - 1], return_index=True, return_inverse=True, return_counts=True)
        heads = name_hash[head[first]] if length > 2 else hashes[head[first]]
        first = begin[first]
        name_hash = mix(mix(heads) + hashes[ids[first + length - 1]])
        if length - 2 < len(tables):
            table, bits = tables[length - 2]
            places = name_hash >> np.uint64(64 - bits)
            known = table[(places >> np.uint64(3)).astype("int64")] >> (7 - (places & np.uint64(7)).astype("uint8")) & 1 > 0
            inverse = np.where(known, np.cumsum(known) - 1, -1)[inverse]
            first, number, name_hash = first[known], number[known], name_hash[known]
        if not len(first):
            return
        yield length, first, number, name_hash
        follow = np.full(len(ids), -1, "int64")
        follow[begin] = inverse


def _streams(batches, use):
    """Feed the words of every language to ``use(lang, ids, words)`` whenever there are enough."""
    open_words: dict[str, Words] = defaultdict(Words)
    size = known = 0
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            known += lang not in open_words  # the mark of a break
            words = open_words[lang]
            size, known = size - words.size, known - len(words.number)
            words.add(text)
            size, known = size + words.size, known + len(words.number)
            while size >= FLUSH or known >= VOCABULARY:
                lang = max(open_words, key=lambda x: open_words[x].size)
                words = open_words.pop(lang)
                size, known = size - words.size, known - len(words.number)
                yield from use(lang, *words.take())
    for lang, words in open_words.items():
        if words.size:
            yield from use(lang, *words.take())


def _blobs(hashes: np.ndarray, number: np.ndarray, buckets: int) -> pd.DataFrame:
    """Hashes by bucket; those that were met once come first, without a count."""
    hashes = hashes.view("int64")
    bucket = (hashes.view("uint64") % np.uint64(buckets)).astype("int64")
    order = np.lexsort((number > 1, bucket))
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    rows = []
    for part in np.split(order, cuts[1:]) if len(order) else []:
        several = number[part]
        rows.append((int(bucket[part[0]]), hashes[part].tobytes(), several[several > 1].tobytes()))
    return pd.DataFrame(rows, columns=["bucket", "phrases", "counts"])


def _first_counts(buckets: int):
    """Words with counts as rows, pairs as blobs."""
    def use(lang, ids, words):
        counts = np.bincount(ids, minlength=len(words))
        yield pd.DataFrame({"lang": lang, "word": [w.decode("utf-8", "replace") for w in words[1:]], "number": counts[1:],
                            "bucket": None, "phrases": None, "counts": None})
        for _, _, number, hashes in _levels(ids, _word_hashes(words, lang), [], 2):
            yield _blobs(hashes, number, buckets).assign(lang=None, word=None, number=None)

    return lambda batches: (f[["lang", "word", "number", "bucket", "phrases", "counts"]] for f in _streams(batches, use))


def _next_counts(shared, buckets: int):
    """Triples of pairs that may be frequent, as blobs."""
    def use(lang, ids, words):
        for length, _, number, hashes in _levels(ids, _word_hashes(words, lang), shared.value, 3):
            if length == 3:
                yield _blobs(hashes, number, buckets)

    return lambda batches: _streams(batches, use)


def _frequent(least: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes, numbers = [], []
        for phrases, counts in zip(group["phrases"], group["counts"]):
            h, several = np.frombuffer(phrases, "int64"), np.frombuffer(counts, "int64")
            hashes.append(h)
            numbers.append(np.concatenate([np.ones(len(h) - len(several), "int64"), several]))
        known, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate(numbers))
        return pd.DataFrame({"phrase": known[total >= least]})
    return run


def _bit_table(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the leading bits of every hash, and how many leading bits count."""
    bits = min(max((32 * hashes.count()).bit_length(), SEGMENT), MOST_BITS)

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        places = group["place"].to_numpy()
        table = np.zeros(1 << SEGMENT, bool)
        table[places & ((1 << SEGMENT) - 1)] = True
        return pd.DataFrame({"segment": [int(places[0]) >> SEGMENT], "bits": [np.packbits(table).tobytes()]})

    places = hashes.select(F.shiftrightunsigned("phrase", 64 - bits).alias("place")).distinct()
    rows = places.groupBy(F.shiftright("place", SEGMENT)).applyInPandas(fill, "segment long, bits binary")
    table = np.zeros((1 << bits) // 8, "uint8")
    for at, part in rows.collect():  # at most 2^(29 - 19) rows of 64 KB
        table[at << SEGMENT - 3:(at + 1) << SEGMENT - 3] = np.frombuffer(part, "uint8")
    return table, bits


def _phrase_counts(shared):
    def use(lang, ids, words):
        text = [w.decode("utf-8", "replace") for w in words]
        for length, first, number, _ in _levels(ids, _word_hashes(words, lang), shared.value, LONGEST):
            yield pd.DataFrame({"lang": lang, "phrase": [" ".join([text[i] for i in ids[b:b + length].tolist()]) for b in first.tolist()],
                                "number": number})

    return lambda batches: _streams(batches, use)


def phrase_counts(docs: DataFrame, least: int, text_column: str = "text", lang_column: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, words, a: phrases of one to four words with the least count; lang, n: all words)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_column).cast("string").alias("text")).where("text != ''")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, size >> 24)  # a few million pairs each
    blobs = "bucket long, phrases binary, counts binary"
    partial = written(texts.mapInPandas(_first_counts(buckets), f"lang string, word string, number long, {blobs}"), "collocation-partials")
    words = written(partial.where("word is not null").groupBy("lang", "word").agg(F.sum("number").alias("a")), "collocation-words")

    def table(counts: DataFrame, name: str) -> tuple[np.ndarray, int]:
        return _bit_table(written(counts.groupBy("bucket").applyInPandas(_frequent(least), "phrase long"), name))

    tables = [table(partial.where("phrases is not null").select("bucket", "phrases", "counts"), "collocation-pairs")]
    tables.append(table(texts.mapInPandas(_next_counts(spark.sparkContext.broadcast(tables), buckets), blobs), "collocation-triples"))
    phrases = texts.mapInPandas(_phrase_counts(spark.sparkContext.broadcast(tables)), "lang string, phrase string, number long")
    counted = (phrases.groupBy("lang", "phrase").agg(F.sum("number").alias("a"))
               .unionByName(words.select("lang", F.col("word").alias("phrase"), "a")).where(F.col("a") >= least)
               .select("lang", F.split("phrase", " ").alias("words"), "a"))
    return written(counted, "collocation-counts"), words.groupBy("lang").agg(F.sum("a").alias("n"))


def _scan(batches):
    """One pass over phrases in order: counts of the parts that begin each, and the largest count
    of an extension by one word. Parts that this range has not seen have no count (``a`` null)."""
    task = TaskContext.get().partitionId()
    stack: list[list] = []  # [words, count, counts of its beginnings, largest extension]
    out: list[tuple] = []
    lang = None

    def close(depth: int) -> None:
        while len(stack) > depth:
            words, a, heads, more = stack.pop()
            out.append((lang, words, a, heads, more, task))

    for batch in batches:
        for now, words, a in zip(batch["lang"], batch["words"], batch["a"]):
            words = list(words)
            if now != lang:
                close(0)
                lang = now
            same = 0
            while same < len(stack) and same < len(words) - 1 and stack[same][0][-1] == words[same]:
                same += 1
            close(same)
            for k in range(same + 1, len(words)):  # the beginnings lie in an earlier range
                stack.append([words[:k], None, [s[1] for s in stack], None])
            heads = [s[1] for s in stack]
            if stack:
                stack[-1][3] = a if stack[-1][3] is None else max(stack[-1][3], a)
            stack.append([words, a, heads, None])
            if len(out) >= 20000:
                yield _facts(out)
                out.clear()
    close(0)
    if out:
        yield _facts(out)


def _facts(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["lang", "words", "a", "heads", "more", "part"])
    return frame.astype({"a": "Int64", "more": "Int64"})


def _in_order(counts: DataFrame, backwards: bool) -> DataFrame:
    """lang, words, a, heads (counts of the beginnings, shortest first), more: of the stream in prefix
    order, or in suffix order (where beginnings are endings)."""
    turned = F.reverse("words") if backwards else F.col("words")
    stream = counts.select("lang", turned.alias("words"), "a").repartitionByRange("lang", "words").sortWithinPartitions("lang", "words")
    facts = written(stream.mapInPandas(_scan, "lang string, words array<string>, a long, heads array<long>, more long, part int"),
                    "collocation-suffixes" if backwards else "collocation-prefixes")
    # Beginnings left open at the cuts between ranges: three a range at most, whatever the counts.
    cut = facts.where("a is null").select("lang", "words", "part", "more")
    late = cut.groupBy("lang", "words").agg(F.max("more").alias("late"))
    found = (facts.where("a is not null").select("lang", "words", "a").join(F.broadcast(cut.select("lang", "words", "part")), ["lang", "words"])
             .groupBy("part").agg(*(F.max(F.when(F.size("words") == k, F.col("a"))).alias(f"open{k}") for k in range(1, LONGEST))))
    filled = F.transform("heads", lambda c, i: F.coalesce(c, F.get(F.array(*(F.col(f"open{k}") for k in range(1, LONGEST))), i)))
    return (facts.where("a is not null").join(F.broadcast(found), "part", "left").join(F.broadcast(late), ["lang", "words"], "left")
            .select("lang", (F.reverse("words") if backwards else F.col("words")).alias("words"), "a", filled.alias("heads"),
                    F.greatest("more", "late").alias("more")))


def _score(scale: int, a: Column, left: Column, right: Column) -> Column:
    """floor(scale * a / (left + right)), in decimals: the product may pass 64 bits."""
    whole = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(scale).cast("decimal(18,0)") * whole(a), whole(left) + whole(right))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, scale: int = 2_000_000, share: tuple[int, int] = (80, 100),
                 text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Columns lang, rank (from 1), phrase, a, l, r, n, score: each language's first ``top`` phrases.

    A phrase goes if one longer candidate around it has at least ``share`` (80 of 100) of its count.
    """
    counts, totals = phrase_counts(docs, least, text_column, lang_column)
    before = _in_order(counts, backwards=False).where(F.size("words") > 1)
    after = _in_order(counts, backwards=True).where(F.size("words") > 1).select(
        "lang", "words", F.col("heads").alias("tails"), F.col("more").alias("more_before"))
    met = before.join(after.hint("merge"), ["lang", "words"])
    exact = lambda c: c.cast("decimal(20,0)")
    longer = exact(F.coalesce(F.greatest("more", "more_before"), F.lit(0)))
    alone = longer * share[1] < exact(F.col("a")) * share[0]
    cuts = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        _score(scale, F.col("a"), F.get("heads", k - 1), F.get("tails", F.size("words") - k - 1)).alias("score"), k.alias("k"),
        F.get("heads", k - 1).alias("l"), F.get("tails", F.size("words") - k - 1).alias("r")))
    scored = met.where(alone).select("lang", F.array_join("words", " ").alias("phrase"), "a", F.array_min(cuts).alias("cut"))
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    # First the best of parts of a language, so that no task ranks more than the parts' best.
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    best = (scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
            .withColumn("place", F.row_number().over(parts)).where(F.col("place") <= top))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").cast("long").alias("score"))
