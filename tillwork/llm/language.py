"""Language identification in two steps: the family first, then the language within it.

The family is chosen by linear support vector machines, one against the rest; within it, every
two languages have a machine of their own, and the language with the most votes wins (margins
break ties). Features are hashed pairs and triples of bytes of the whole text.

The models are fitted on a bounded sample of labelled rows (``sample``, spread evenly over the
languages, chosen by a hash of the id); every row is read, counted and predicted.

Defined results: a null text, or one without any letter, is ``und`` with score 0, as is everything
if no row has a language; with a single language all texts with a letter are of that language;
repeated ids are predicted row by row; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.learning import LETTER, byte_grams, featured, held_out, hashed_share, linear_svm, logistic, matrix

#: Language families by language code (fixed values); a code that is not here is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "semitic": ("am", "ar", "he", "mt"),
}


def family_of(code: str) -> str:
    return next((f for f, codes in FAMILIES.items() if code in codes), code)


class LanguageModel:
    """Linear machines; small (languages squared), whatever the corpus. The last column of ``x`` is ones."""

    def __init__(self, x: np.ndarray, codes: list[str]):
        self.codes = sorted(set(codes))
        self.families = sorted({family_of(c) for c in self.codes})
        known, family = np.array(codes), np.array([family_of(c) for c in codes])
        self.top = {f: linear_svm(x, np.where(family == f, 1.0, -1.0).astype("float32"))
                    for f in self.families} if len(self.families) > 1 else {}
        self.pairs = {}
        for a, b in combinations(self.codes, 2):
            if family_of(a) == family_of(b):
                rows = (known == a) | (known == b)
                self.pairs[a, b] = linear_svm(x[rows], np.where(known[rows] == a, 1.0, -1.0).astype("float32"))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.codes or not LETTER.search(text):
            return "und", 0.0
        x = np.append(byte_grams(text), np.float32(1))
        family, score = self.families[0], 1.0
        if self.top:
            margins = {f: float(w @ x) for f, w in self.top.items()}
            family = max(margins, key=margins.get)
            rest = max(m for f, m in margins.items() if f != family)
            score = float(logistic(2 * (margins[family] - rest)))
        inside = [c for c in self.codes if family_of(c) == family]
        votes, total = dict.fromkeys(inside, 0), dict.fromkeys(inside, 0.0)
        for a, b in combinations(inside, 2):
            margin = float(self.pairs[a, b] @ x)
            votes[a if margin >= 0 else b] += 1
            total[a], total[b] = total[a] + margin, total[b] - margin
        best = max(inside, key=lambda c: (votes[c], total[c], c))
        closest = min((abs(float(self.pairs[a, b] @ x)) for a, b in combinations(inside, 2) if best in (a, b)), default=None)
        return best, score * (1.0 if closest is None else float(logistic(4 * closest)))


def fit_languages(docs: DataFrame, sample: int = 8000, id_column: str = "doc_id", text_column: str = "text",
                  lang_column: str = "lang") -> LanguageModel:
    """Learn from rows that are not held out and have a language and a letter."""
    rows = docs.where(~held_out(id_column) & F.col(lang_column).isNotNull()
                      & F.col(text_column).rlike(r"\p{L}")).select(
        F.xxhash64(id_column, text_column).alias("row"), F.col(lang_column).alias("code"),
        F.col(text_column).alias("text"))
    counts = {r["code"]: r["count"] for r in rows.groupBy("code").count().collect()}  # a row per language
    if not counts:
        return LanguageModel(np.zeros((0, 2049), "float32"), [])
    each = max(1, sample // len(counts))
    chosen = F.lit(False)
    for code, number in counts.items():
        chosen = chosen | ((F.col("code") == code) & hashed_share("row", number, each))
    x, (codes,) = matrix(featured(rows.where(chosen), byte_grams, "code string"), "code", ones=True)
    return LanguageModel(x, codes)


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns id, held_out, lang_pred, score."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "held_out": batch["held_out"],
                                "lang_pred": [x[0] for x in out], "score": [x[1] for x in out]})
    return docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"),
                       F.col(text_column).cast("string").alias("text")).mapInPandas(
        run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_column)


def with_language(docs: DataFrame, model: LanguageModel, column: str = "lang_pred", text_column: str = "text") -> DataFrame:
    """The rows as they are, with the predicted language in one more column."""
    @F.pandas_udf("string")
    def predicted(texts: pd.Series) -> pd.Series:
        return pd.Series([model.predict(t)[0] for t in texts])
    return docs.withColumn(column, predicted(F.col(text_column).cast("string")))
