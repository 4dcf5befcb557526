"""Best-fit packing planned over the histogram of lengths.

The tokens are counted once, in Arrow batches; what is kept of a document is a narrow row per
piece. The plan is made from the number of pieces of each length alone: lengths are taken from
the longest to the shortest, and all pieces of a length are put at once into the fullest
sequences that still have room. Runs of sequences with equal room are kept as number ranges, so
that the plan has a few thousand rows whatever the corpus. Pieces then take their planned slot
by their rank among the pieces of their length; ranks come from counts per task, so that a
length which a third of all rows share is not one group.

Defined results: a null or empty text is the end token alone; a repeated id is packed for each
of its rows; a document longer than a sequence is cut into full pieces after a shorter first
one; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tillwork.session import written

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Words(dict):
    """Ids (as bytes) of " word" by word; what is not known yet is encoded once."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if word[-1:] in _MARKS and word[:-1].isalpha():  # marks are never merged with letters
            ids = self[word[:-1]] + _bytes(self.encode(word[-1]))
        else:
            ids = _bytes(self.encode(" " + word))
        self[word] = ids
        return ids


def _bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


_MARKS = frozenset(".,;:!?")


_ODD = re.compile(r"\s \s|\s $")  # a run of white space is a token of its own
_SAFE = re.compile(r"(?<=\S)(?= \S)")


class WordIds:
    """Token ids of texts by a bounded cache of words.

    A byte-level tokenizer never merges over the start of " word" after a non-space, so a text
    can be cut before every such blank and the ids of the parts put together. Words are encoded
    by the ranks of the vocabulary, which gives the ids of ``byte_bpe_50k.json`` (tested); a text
    that holds the special token's string goes to that tokenizer as a whole.
    """

    def __init__(self, path: str, words: int = 1_000_000):
        import tiktoken
        from public_tokenizers import PATTERN
        self.path, self.words, self.special = path, words, None
        with open(re.sub(r"[.]json$", ".tiktoken", path), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.known = Words(self.encode)

    def ids(self, text: str) -> bytes:
        if "<|endoftext|>" in text:
            if self.special is None:
                from tokenizers import Tokenizer
                self.special = Tokenizer.from_file(self.path)
            return _bytes(self.special.encode(text, add_special_tokens=False).ids)
        if len(self.known) > self.words:
            self.known.clear()
        if _ODD.search(text):
            first, *rest = _SAFE.split(text)
            rest = [part[1:] for part in rest]
        else:
            first, *rest = text.split(" ")
        return _bytes(self.encode(first)) + b"".join(map(self.known.__getitem__, rest))


def _counter(path: str, capacity: int, end: int, keep_ids: bool):
    tail = _bytes([end])

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordIds(path)
        for batch in batches:
            docs, texts = batch["id"].tolist(), batch["text"].fillna("").tolist()
            out = []
            for doc, text in zip(docs, texts):
                ids = encoder.ids(text) + tail
                size = len(ids) // 4
                cuts = [0, *range(size % capacity or capacity, size, capacity), size]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    part = ids[4 * a:4 * b]
                    out.append((doc, piece, a, b - a, zlib.crc32(part))
                               + ((np.frombuffer(part, dtype="<i4"),) if keep_ids else ()))
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
    return pieces


def token_pieces(docs: DataFrame, capacity: int = 2048, end: int = 0, path: str | None = None,
                 id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32 and, if asked for, ids."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInPandas(
        _counter(path or tokenizer_path(), capacity, end, keep_ids), schema)


def plan(counts: dict[int, int], capacity: int = 2048) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first: rows (length, first rank, last rank, sequence of the first, offset).

    Sequences in use are kept as number ranges by the room they have left; a range is taken as a
    whole as long as pieces of the length remain, so each step settles a range or a length.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
    steps, opened = [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit")
        rank, left = 0, counts[length]
        while left:
            room = next((r for r in range(length, capacity) if rooms[r]), capacity)
            if room < capacity:
                begin, number = rooms[room].pop()
            else:  # as many new sequences as the rest of this length fills
                begin, number = opened, -(-left // (capacity // length))
                opened += number
            used = min(left, number)
            if used < number:
                rooms[room].append((begin + used, number - used))
            rooms[room - length].append((begin, used))
            steps.append((length, rank, rank + used - 1, begin, capacity - room))
            rank, left = rank + used, left - used
    return steps


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to rows of :func:`token_pieces`; reads ``pieces`` once."""
    spark = pieces.sparkSession
    stored = written(pieces.withColumn("task", F.spark_partition_id())
                     .withColumn("row", F.monotonically_increasing_id()), "token-pieces")
    by_task = stored.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = spark.createDataFrame(plan(counts, capacity),
                                  "step_length long, first long, last long, begin long, offset long")
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(
        Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "task").orderBy("row")
    ranked = (stored.join(bases, ["length", "task"])
              .withColumn("rank", F.col("base") + F.row_number().over(inside) - 1))
    # The plan depends on the lengths that occur, at most `capacity`, not on the corpus.
    return (ranked.join(F.broadcast(steps), (F.col("length") == F.col("step_length"))
                        & F.col("rank").between(F.col("first"), F.col("last")))
            .withColumn("sequence_id", F.col("begin") + F.col("rank") - F.col("first"))
            .drop("task", "row", "base", "rank", "step_length", "first", "last", "begin"))
