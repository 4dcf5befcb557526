"""What the two text classifiers share: held-out rows, bounded samples, features, linear fitting."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

LETTER = regex.compile(r"\p{L}")


def held_out(id_column: str) -> Column:
    """Rows that no model learns from: the id's crc32 leaves 2 when divided by 4."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(4)) == 2


def hashed_share(name: str, rows: int, bound: int) -> Column:
    """About ``bound`` of ``rows`` rows, chosen by a hash of the column (all if there are fewer).

    The hash is compared with a limit of 63 bits, so the share is as fine as any number of rows needs.
    """
    if rows <= bound:
        return F.lit(True)
    return F.xxhash64(F.lit("sample"), F.col(name)).bitwiseAND((1 << 63) - 1) < (bound << 63) // rows


def featured(df: DataFrame, features: Callable[[str], np.ndarray], keep: str) -> DataFrame:
    """Replace column ``text`` by ``x``, an array of floats; ``keep`` is the schema of the rest."""
    names = [part.split()[0] for part in keep.split(",")]

    def run(batches):
        for batch in batches:
            out = batch[names].copy()
            out["x"] = [features(t or "") for t in batch["text"]]
            yield out
    return df.select(*names, "text").mapInPandas(run, f"{keep}, x array<float>")


def matrix(df: DataFrame, *names: str, ones: bool = False) -> tuple[np.ndarray, list[list]]:
    """Features (``ones``: and a last column of ones) and other columns of a bounded sample, on the driver.

    The features are copied once, into their place, and what carried them is given back: the driver
    holds one matrix of the sample, not several.
    """
    table = df.select("x", *names).toArrow()
    rows, at, out = table.num_rows, 0, np.zeros((0, 0), "float32")
    if not rows:
        return out, [[] for _ in names]
    others = [table[name].to_pylist() for name in names]
    for chunk in table["x"].iterchunks():
        if len(chunk):
            part = np.asarray(chunk.flatten(), dtype="float32").reshape(len(chunk), -1)
            if not at:
                out = np.ones((rows, part.shape[1] + ones), "float32")
            out[at:at + len(part), :part.shape[1]] = part
            at += len(part)
    part = chunk = table = None
    pa.default_memory_pool().release_unused()
    return out, others


# --- features ------------------------------------------------------------------------------

def byte_grams(text: str, size: int = 2048) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs and triples of the whole text, length 1."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype="uint8")
    out = np.zeros(size, "float64")
    step = 1 << 20  # bounds the memory for very long texts; the windows overlap, nothing is lost
    for at in range(0, max(len(raw) - 1, 0), step):
        b = raw[at:at + step + 2].astype("uint32")
        pairs = b[:-1] * 257 + b[1:] + 1
        triples = pairs[:-1] * 65_599 + b[2:] * 2_654_435_761
        for grams in (pairs[:step], triples[:step]):
            out += np.bincount((grams * np.uint32(2_246_822_519)) >> np.uint32(21), minlength=2048)[:size]
    norm = out.sum()
    return np.sqrt(out / norm).astype("float32") if norm else out.astype("float32")


CLASSES = 8
_CLASS = np.full(256, 7, "uint8")  # other symbols
_CLASS[list(range(ord("a"), ord("z") + 1)) + list(range(128, 256))] = 0
_CLASS[list(range(ord("A"), ord("Z") + 1))] = 1
_CLASS[list(range(ord("0"), ord("9") + 1))] = 2
_CLASS[[32, 9]] = 3
_CLASS[[10, 13]] = 4
_CLASS[[ord(c) for c in ".,;:'-()\""]] = 5
_CLASS[[ord(c) for c in "!?"]] = 6


def text_shape(text: str) -> np.ndarray:
    """How a text is built, whatever its language: shares of character-class triples, of repeated
    neighbouring words, of distinct words and lines, capital letters, and mean lengths."""
    raw = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), dtype="uint8")]
    triples = np.zeros(CLASSES ** 3)
    step = 1 << 20
    for at in range(0, max(len(raw) - 2, 0), step):
        c = raw[at:at + step + 2].astype("int64")
        triples += np.bincount(c[:-2] * 64 + c[1:-1] * 8 + c[2:], minlength=CLASSES ** 3)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(len(words), 1)
    letters = int((raw < 2).sum())
    here, low = (np.frombuffer(t.encode("utf-32-le", "replace"), dtype="uint32") for t in (text, text.lower()))
    capitals = int((here != low).sum()) if len(here) == len(low) else int((raw == 1).sum())
    dense = [
        sum(map(str.__eq__, words[1:], words)) / n,
        len(set(words)) / n ** 0.75,
        len(set(lines)) / max(len(lines), 1),
        capitals / max(letters, 1),
        letters / max(len(raw), 1),
        min(len(text) / n, 40) / 10,
        np.log1p(len(words)) / 10,
        np.log1p(len(lines)) / 10,
        float(not words),
    ]
    return np.concatenate([np.sqrt(triples / max(triples.sum(), 1)), dense]).astype("float32")


# --- fitting -------------------------------------------------------------------------------

def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, turns: int = 200) -> np.ndarray:
    """Weights (the last is the offset) of a linear support vector machine with squared hinge loss,
    each class weighing the same, by accelerated gradient descent. ``y`` holds 1 and -1, the last column of ``x`` ones."""
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype("float32")
    parts = (x[at:at + 256] for at in range(0, len(x), 256))  # squares of all rows at once would be another matrix
    rate = 1 / (2 * max((part * part).sum(axis=1).max() for part in parts) + penalty)
    w = look = np.zeros(x.shape[1], "float32")
    for turn in range(turns):
        loss = np.maximum(0, 1 - y * (x @ look))
        step = look - rate * (penalty * look - 2 * (x.T @ (weight * y * loss)))
        w, look = step, step + turn / (turn + 3) * (step - w)
    return w


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
