"""Benchmark passages in documents by latent semantic retrieval, then word by word.

1. Document frequencies of hashed words over all documents give the weights.
2. A distributed randomised SVD of all TF-IDF passages (A, a row per passage): every task adds up
   its part of A'A times a random matrix; an orthonormal basis of the sum spans the leading right
   singular space, and the small matrix inside it whitens the latent coordinates, so that what
   all texts share weighs no more than what sets them apart.
3. Candidate search: windows of every document, in sizes that fit inside the items, against all
   items by cosine in the latent space (window sums are differences of running sums); and, so that
   no estimate decides, every place of an anchor. Anchors of an item are as many of its rarest
   words that a share of ``exact`` of the item cannot miss them all, and the rarest word of its
   answer, which a paraphrase must hold. Around a candidate, enough of the rarer words of the item
   must occur for a share of ``paraphrase`` to be possible. Both are bounds, not estimates: what
   step 4 accepts always gets there, if the passage is longer or shorter than the item by less
   than half.
4. Candidates are checked by the longest common subsequence of words between the item and the
   text around the window. A share of ``exact`` of the item is a leak; a share of ``paraphrase``
   is one if the answer (given, or else the item's last sentence) is there as well, in order.

The items are the query set: they are taken in blocks of bounded size. What tasks receive is a
weight and a latent vector per hash value and one block of items.

Defined results: a null or empty text has no leak, nor has an item of fewer than ``least`` words;
repeated ids are searched row by row and reported once per item; without documents or items there
are no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.shingles import word_hashes

SIZE, RANK, PASSAGE = 1 << 14, 32, 64
SIZES = (8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024, 1536, 2048, 3072, 4096)
SLICES = 64


def _word_ids(text: str | None) -> np.ndarray:
    return (word_hashes(text or "") & np.uint64(SIZE - 1)).astype("int64")


def word_weights(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of every hash value, from all documents."""
    def counts(batches):
        total, rows = np.zeros(SIZE, "int64"), 0
        for batch in batches:
            for text in batch["text"]:
                seen = np.zeros(SIZE, bool)
                seen[_word_ids(text)] = True
                total += seen
            rows += len(batch)
        yield pd.DataFrame({"place": np.arange(SIZE + 1), "n": np.append(total, rows)})

    sums = texts.mapInPandas(counts, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(SIZE + 1)
    for place, n in sums:
        found[place] = n
    return np.log((found[-1] + 1) / (found[:-1] + 0.5)).clip(min=0.01).astype("float32")


def _chunks(texts, words: int = 1 << 16):
    """Word ids of many texts put together: (numbers of the texts, ids, text starts)."""
    rows, parts, count = [], [], 0
    for row, text in enumerate(texts):
        ids = _word_ids(text)
        if len(ids):
            rows.append(row)
            parts.append(ids)
            count += len(ids)
        if count >= words:
            yield rows, np.concatenate(parts), np.cumsum([0, *map(len, parts)])
            rows, parts, count = [], [], 0
    if parts:
        yield rows, np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def _test_matrix() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((SIZE, RANK)).astype("float32")


def latent_space(texts: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Whitened latent vector (float32) of every hash value, by randomised SVD of all passages."""
    def sketch(batches):
        # A column of the test matrix at a time: what it needs stays in the processor's cache.
        omega, total = np.ascontiguousarray(_test_matrix().T), np.zeros((RANK, SIZE))
        for batch in batches:
            for _, ids, starts in _chunks(batch["text"]):
                cuts = np.unique(np.concatenate([starts[:-1], *(np.arange(a, b, PASSAGE) for a, b in zip(starts, starts[1:]))]))
                passage = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(ids))))
                value = weights[ids]
                value = value / np.sqrt(np.add.reduceat(value * value, cuts))[passage]
                for column, added_up in zip(omega, total):
                    y = np.add.reduceat(column.take(ids) * value, cuts)
                    added_up += np.bincount(ids, weights=y.take(passage) * value, minlength=SIZE)
        task = TaskContext.get().partitionId()
        step, total = SIZE // SLICES, np.ascontiguousarray(total.T)
        yield pd.DataFrame({"slice": np.arange(SLICES), "part": task // 256,
                            "sums": [total[k * step:(k + 1) * step].tobytes() for k in range(SLICES)]})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in group["sums"])
        return pd.DataFrame({"slice": group["slice"].iloc[:1], "part": 0, "sums": [total.tobytes()]})

    schema = "slice int, part int, sums binary"
    sums = (texts.mapInPandas(sketch, schema).groupBy("slice", "part").applyInPandas(added, schema)
            .groupBy("slice").applyInPandas(added, schema).collect())
    g, omega = np.zeros((SIZE, RANK)), _test_matrix()
    for slice_, _, part in sums:
        g[slice_ * (SIZE // SLICES):][:SIZE // SLICES] = np.frombuffer(part).reshape(-1, RANK)
    basis = np.linalg.qr(g)[0]
    inner = basis.T @ g @ np.linalg.pinv(basis.T @ omega)  # A'A within the basis
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    value = np.maximum(value, max(value.max(), 1e-12) * 1e-4)
    return (basis @ (vector / np.sqrt(value)) * weights[:, None]).astype("float32")


# --- word by word --------------------------------------------------------------------------

def word_places(item: list) -> dict:
    """The places of every word as bits."""
    places = defaultdict(int)
    for k, word in enumerate(item):
        places[word] |= 1 << k
    return dict(places)


def common_words(item: list, text: list, least: float = 0, places: dict | None = None) -> int:
    """Length of the longest common subsequence (bit-parallel); 0 if it is surely below ``least``."""
    places = word_places(item) if places is None else places
    met = [hit for word in text if (hit := places.get(word))]
    seen = 0
    for hit in met:
        seen |= hit
    if seen.bit_count() < least:
        return 0
    full = (1 << len(item)) - 1
    row = full
    for hit in met:
        hit &= row
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.sqrt((z * z).sum(axis=-1, keepdims=True)), 1e-12)


class Items:
    """A block of benchmark items with their word hashes, answers, anchors and latent vectors."""

    def __init__(self, rows: list[tuple], vectors: np.ndarray, weights: np.ndarray, least: int, exact: float, paraphrase: float):
        self.ids, self.words, self.places, self.answers, latent, size = [], [], [], [], [], []
        anchors, rarer, self.needed = [], [], []
        for item, text, answer in rows:
            words = word_hashes(text or "")
            if len(words) < least:
                continue
            if answer is None:
                sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if len(word_hashes(s))]
                answer = sentences[-1] if sentences else ""
            number, length = len(self.ids), len(words)
            self.ids.append(item)
            self.words.append(words.tolist())
            self.places.append(word_places(self.words[-1]))
            self.answers.append(word_hashes(answer).tolist())
            hashes = (words & np.uint64(SIZE - 1)).astype("int64")
            rarest = np.argsort(-weights[hashes], kind="stable")
            missed = [length - int(np.ceil(share * length - 1e-9)) for share in (exact, paraphrase)]
            anchors += [(hashes[k], number, k) for k in rarest[:missed[0] + 1]]
            anchors += [(h, number, k) for h, k in _answer_anchors(self.words[-1], self.answers[-1], weights)]
            some = rarest[:missed[1] + max((length - missed[1]) // 2, 1)]
            self.needed.append(len(some) - missed[1])
            rare = np.zeros(SIZE, bool)
            rare[hashes[some]] = True
            rarer.append(np.packbits(rare))
            latent.append(_unit(vectors[hashes].sum(axis=0)))
            size.append(max(s for s in SIZES if s <= max(length, SIZES[0])))
        self.length, self.needed = np.array([len(w) for w in self.words], "int64"), np.array(self.needed, "int64")
        self.rarer = np.array(rarer, "uint8").reshape(-1, SIZE // 8)
        table = np.unique(np.array(anchors, "int64").reshape(-1, 3), axis=0)
        self.anchor_item, self.anchor_place = table[:, 1], table[:, 2]
        self.anchor_at = np.searchsorted(table[:, 0], np.arange(SIZE + 1))
        self.by_size = {s: (np.flatnonzero(np.array(size) == s), np.array(latent)[np.array(size) == s]) for s in sorted(set(size))}

    def anchored(self, ids: np.ndarray, starts: np.ndarray):
        """Candidates (item, begin, end) around the anchors among the words of some texts."""
        count = self.anchor_at[ids + 1] - self.anchor_at[ids]
        place = np.flatnonzero(count)
        total = np.cumsum(count[place])
        for some in np.split(place, np.searchsorted(total, np.arange(1 << 19, total[-1], 1 << 19))) if len(place) else ():
            n = count[some]
            anchor = np.repeat(self.anchor_at[ids[some]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item, begin = self.anchor_item[anchor], np.repeat(some, n) - self.anchor_place[anchor]
            room, text = self.length[item] // 2 + 4, np.repeat(np.searchsorted(starts, some, "right") - 1, n)
            yield (item, np.maximum(begin - room, starts[text]),
                   np.minimum(begin + self.length[item] + room, starts[text + 1]))

    def possible(self, ids: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """The candidates, once each, around which enough of the item's rarer words occur."""
        size, most = len(ids) + 1, int((end - begin).max()) + 1
        key = np.sort((item * size + begin) * most + end - begin)
        key = key[np.diff(key, prepend=-1) != 0]
        item, begin, end = key // (size * most), key // most % size, key // most % size + key % most
        numbers, first = np.unique(item, return_index=True)
        rest = []
        for number, a, b in zip(numbers, first, [*first[1:], len(item)]):
            # Windows that together are longer than the texts: the places of the rarer words in these once.
            if 4 * (end[a:b] - begin[a:b]).sum() > size:
                met = np.flatnonzero(np.unpackbits(self.rarer[number]).view(bool).take(ids))
                near = np.searchsorted(met, end[a:b]) - np.searchsorted(met, begin[a:b]) >= self.needed[number]
                yield from zip(item[a:b][near].tolist(), begin[a:b][near].tolist(), end[a:b][near].tolist())
            else:
                rest.append(np.arange(a, b))
        if rest:
            some = np.concatenate(rest)
            yield from self._possible(ids, item[some], begin[some], end[some])

    def _possible(self, ids: np.ndarray, item: np.ndarray, begin: np.ndarray, end: np.ndarray):
        cuts = np.unique(np.searchsorted(np.cumsum(end - begin), np.arange(0, (end - begin).sum(), 1 << 20)))
        for a, b in zip(cuts, [*cuts[1:], len(item)]):
            n = (end - begin)[a:b]
            first = np.cumsum(n) - n
            word = ids[np.arange(n.sum()) - np.repeat(first - begin[a:b], n)]
            hit = self.rarer[np.repeat(item[a:b], n), word >> 3] >> (7 - (word & 7)).astype("uint8") & 1
            near = np.add.reduceat(hit, first, dtype="int64") >= self.needed[item[a:b]]
            yield from zip(item[a:b][near].tolist(), begin[a:b][near].tolist(), end[a:b][near].tolist())


def _answer_anchors(words: list, answer: list, weights: np.ndarray) -> list[tuple]:
    """The answer's rarest word with its place in the item; before and behind an item that does not end with it."""
    if not answer:
        return []
    hashes = [h & (SIZE - 1) for h in answer]
    best = max(range(len(answer)), key=lambda j: weights[hashes[j]])
    if words[-len(answer):] == answer:
        return [(hashes[best], len(words) - len(answer) + best)]
    return [(hashes[best], 0), (hashes[best], len(words))]


def _windows(starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of every text: a third of their size apart, one at each end; short texts whole."""
    length = np.diff(starts)
    long = length >= size
    grid = np.arange(0, starts[-1] - size + 1, max(size // 3, 1))
    text = np.searchsorted(starts, grid, "right") - 1
    grid = grid[grid + size <= starts[text + 1]]
    begin = np.unique(np.concatenate([grid, starts[:-1][long], starts[1:][long] - size]))
    short = ~long & (length >= size // 2)
    return np.concatenate([begin, starts[:-1][short]]), np.concatenate([begin + size, starts[1:][short]])


def _together(candidates, most: int = 1 << 18):
    """Candidates (item, begin, end) in few large pieces: each piece looks up an item's words in the texts once."""
    parts, count = [], 0
    for part in candidates:
        if len(part[0]):
            parts.append(part)
            count += len(part[0])
        if count >= most:
            yield tuple(map(np.concatenate, zip(*parts)))
            parts, count = [], 0
    if parts:
        yield tuple(map(np.concatenate, zip(*parts)))


def _searcher(items: Items, vectors: np.ndarray, cosine: float, exact: float, paraphrase: float):
    exact_vectors = vectors.astype("float64")

    def near(ids, starts):
        """Candidates by latent cosine and by anchors."""
        sums = np.zeros((len(ids) + 1, RANK))
        np.take(exact_vectors, ids, axis=0, out=sums[1:], mode="clip")
        for at in range(1, len(ids) + 1, 1024):  # in pieces that stay in the processor's cache
            part = sums[at - 1:at + 1024]
            np.cumsum(part, axis=0, out=part)
        for size, (numbers, latent) in items.by_size.items():
            begin, end = _windows(starts, size)
            for at in range(0, len(begin), 8192):
                a, b = begin[at:at + 8192], end[at:at + 8192]
                z = (sums[b] - sums[a]).astype("float32")
                close = z @ latent.T >= cosine * np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-12)[:, None]
                w, i = np.divmod(np.flatnonzero(close), len(numbers))
                # The window lies in the item, up to a third of it may stand out; room for edits.
                room = np.maximum(items.length[numbers[i]] - size, 0) + size // 2 + 4
                text = np.searchsorted(starts, a[w], "right") - 1
                yield numbers[i], np.maximum(a[w] - room, starts[text]), np.minimum(a[w] + size + room, starts[text + 1])
        yield from items.anchored(ids, starts)

    def search(batches):
        for batch in batches:
            docs, found = batch["id"].to_numpy(), {}
            texts = batch["text"].tolist()
            for rows, ids, starts in _chunks(texts):
                hits, limits = defaultdict(set), starts.tolist()
                for item, begin, end in _together(near(ids, starts)):
                    for i, a, b in items.possible(ids, item, begin, end):
                        text = bisect_right(limits, a) - 1
                        hits[text].add((i, a - limits[text], b - limits[text]))
                for text, some in hits.items():
                    words = word_hashes(texts[rows[text]]).tolist()
                    best = {}
                    for item, a, b in sorted(some):
                        own = items.words[item]
                        if best.get(item, (0, 0))[0] >= exact * len(own):
                            continue
                        part = words[a:b]
                        common = common_words(own, part, paraphrase * len(own), items.places[item])
                        if common >= paraphrase * len(own):
                            answer = items.answers[item]
                            whole = bool(answer) and common_words(answer, part) == len(answer)
                            most, held = best.get(item, (0, 0))
                            best[item] = max(most, common), max(held, int(whole))
                    for item, (common, whole) in best.items():
                        if common >= exact * len(items.words[item]) or whole:
                            found[rows[text], item] = common
            keys = list(found)
            yield pd.DataFrame({"id": docs[[r for r, _ in keys]] if keys else docs[:0], "item_id": [items.ids[i] for _, i in keys],
                                "common_words": [found[k] for k in keys], "item_words": [len(items.words[i]) for _, i in keys]})
    return search


def leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.55, exact: float = 0.8, paraphrase: float = 0.6,
          least: int = 8, block_items: int = 10_000, id_column: str = "doc_id", text_column: str = "text",
          item_column: str = "item_id", item_text: str = "text", answer_column: str | None = None) -> DataFrame:
    """A row per document and item that it holds: id, item_id, common_words, item_words."""
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = (f"id {docs.schema[id_column].dataType.simpleString()}, "
              f"item_id {benchmark.schema[item_column].dataType.simpleString()}, common_words int, item_words int")
    queries = benchmark.select(F.col(item_column), F.col(item_text),
                               F.col(answer_column) if answer_column else F.lit(None).cast("string")).toDF("item", "text", "answer")
    weights = word_weights(texts)
    vectors = latent_space(texts, weights)
    blocks = max(1, -(-queries.count() // block_items))
    found = None
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        items = Items([tuple(r) for r in rows], vectors, weights, least, exact, paraphrase)
        some = texts.select("id", "text").mapInPandas(_searcher(items, vectors, cosine, exact, paraphrase), schema)
        found = some if found is None else found.unionByName(some)
    return found.groupBy("id", "item_id").agg(F.max("common_words").alias("common_words"), F.max("item_words").alias("item_words")
                                             ).withColumnRenamed("id", id_column)
