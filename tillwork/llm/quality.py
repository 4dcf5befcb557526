"""Quality scores by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives P are labelled texts of quality 1; unlabelled texts U are any others, whatever
their label says. With the class prior p, the risk is

    p * loss(P as good) + max(0, loss(U as bad) - p * loss(P as bad)),

minimised over a linear model of the text's shape (see ``text_shape``) with logistic loss; when
the second term turns negative, the step goes against it, which keeps the model from explaining
the unlabelled positives away. The prior is estimated from the same two samples: for any set of
texts, U holds at least p times the share that P has of it, so p is at most the smallest such
ratio over the upper score ranges of a plain P-against-U model (held-out half of the sample).

The model is fitted on a bounded sample (``positives``, ``unlabelled``: documented bounds, chosen
by a hash of the id); every row is scored on its whole text.

Defined results: an empty or null text is scored as a text of no words; without any trusted
positive every score is 0.5; repeated ids are scored row by row, and a document is trusted if
any of its labels says so; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.learning import featured, held_out, hashed_share, logistic, matrix, text_shape


@dataclass
class QualityModel:
    weights: np.ndarray | None
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return logistic(z @ self.weights[:-1] + self.weights[-1]).astype("float64")


def _adam(gradient, size: int, turns: int, rate: float = 0.05) -> np.ndarray:
    w, m, v = (np.zeros(size) for _ in range(3))
    for turn in range(1, turns + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
    return w


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1), x.dtype)])


def class_prior(p: np.ndarray, u: np.ndarray, turns: int = 150, penalty: float = 1e-3) -> float:
    """Share of positives in ``u``: the smallest ratio of tail shares under a P-against-U score."""
    if min(len(p), len(u)) < 4:
        return 0.5  # too few to tell
    half = lambda x, k: x[k::2]
    p0, u0 = _with_one(half(p, 0)), _with_one(half(u, 0))

    def gradient(w):
        return ((logistic(p0 @ w) - 1) @ p0 / len(p0) + logistic(u0 @ w) @ u0 / len(u0)) / 2 + penalty * w
    w = _adam(gradient, p0.shape[1], turns)
    sp, su = (np.sort(_with_one(half(x, 1)) @ w) for x in (p, u))
    ratios = []
    for share in np.linspace(0.3, 1.0, 29):
        limit = sp[int((1 - share) * (len(sp) - 1))]
        a, b = (sp >= limit).mean(), (su >= limit).mean()
        ratios.append((b + np.sqrt(b * (1 - b) / len(su))) / max(a, 1e-9))
    return float(np.clip(min(ratios), 0.02, 0.98))


def non_negative_fit(p: np.ndarray, u: np.ndarray, prior: float, turns: int = 400, penalty: float = 1e-3) -> np.ndarray:
    """Weights of the linear model that minimises the non-negative risk with logistic loss."""
    p, u = _with_one(p), _with_one(u)

    def gradient(w):
        sp, su = logistic(p @ w), logistic(u @ w)
        good = prior * ((sp - 1) @ p) / len(p)
        bad = su @ u / len(u) - prior * (sp @ p) / len(p)
        zp, zu = p @ w, u @ w
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return (good + bad if risk >= 0 else -bad) + penalty * w
    return _adam(gradient, p.shape[1], turns)


def fit_quality(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 12000,
                id_column: str = "doc_id", text_column: str = "text") -> QualityModel:
    known = docs.where(~held_out(id_column)).select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    trusted = labels.where(F.col("quality") == 1).select(F.col(id_column).alias("id")).distinct()
    good = known.join(trusted, "id", "left_semi")
    counts = trusted.where(~held_out("id")).count(), known.count()
    p, _ = matrix(featured(good.where(hashed_share("id", counts[0], positives)), text_shape, "id " + _kind(docs, id_column)))
    u, _ = matrix(featured(known.where(hashed_share("id", counts[1], unlabelled)), text_shape, "id " + _kind(docs, id_column)))
    if not len(p) or not len(u):
        return QualityModel(None, np.zeros(1), np.ones(1), 0.5)
    every = np.vstack([p, u])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    prior = class_prior(p, u)
    return QualityModel(non_negative_fit(p, u, prior), mean, scale, prior)


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.7, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Columns id, held_out, score, predicted."""
    def run(batches):
        for batch in batches:
            x = np.array([text_shape(t or "") for t in batch["text"]], "float32").reshape(len(batch), -1)
            score = model.scores(x) if len(batch) else np.zeros(0)
            yield pd.DataFrame({"id": batch["id"], "held_out": batch["held_out"], "score": score,
                                "predicted": (score >= threshold).astype("int32")})
    return docs.select(F.col(id_column).alias("id"), held_out(id_column).alias("held_out"),
                       F.col(text_column).cast("string").alias("text")).mapInPandas(
        run, f"id {_kind(docs, id_column)}, held_out boolean, score double, predicted int"
    ).withColumnRenamed("id", id_column)
