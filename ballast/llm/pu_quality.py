"""Quality classifier from positive and unlabelled texts.

A linear scorer is fitted with the non-negative unbiased risk: trusted positives give
the risk of calling a positive negative, unlabelled web text gives the risk of calling
text positive, from which the share that hidden positives must have in it, the class
prior, is taken off. Where the remainder falls below zero, which only over-fitting can
do, the step goes back instead of on.

The prior is estimated from positives and unlabelled rows alone. A logistic scorer is
fitted to tell the two apart and applied to rows kept out of it, in folds. At any cut, the
share of unlabelled rows above it, over that of positives, bounds the prior from above;
the least bound over cuts is taken, less two standard errors. Rows labelled 0 count as
unlabelled. The fit uses a bounded sample, ``positives`` and ``unlabelled`` rows chosen
by a hash of the id. Features are made of each whole text, however long, in Spark tasks:
frequencies of adjacent pairs of character classes and a few measures of repetition.

A null text counts as empty and is scored like any text. Labels that are null, repeated
or for no document are combined by their mean, or ignored. Without positives every text
scores 0. Other columns pass through; one named as the score is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.llm.shared import whole

POSITIVES = 3000
UNLABELLED = 6000
STEPS = 800
THRESHOLD = 0.3
FOLDS = 4
FOLD_STEPS = 200
PRIORS = 0.02, 0.98
MARKS = b"|*&%$#!.,:;'\"-_"
CLASSES = 49
MEASURES = 6
# Brings frequencies and measures to the size the fit's steps suit.
SCALE = 5.0
WIDTH = CLASSES * CLASSES + MEASURES


def _classes() -> np.ndarray:
    """Class of each byte: letters one by one, marks one by one, the rest by kind."""
    kinds = np.full(256, 26, np.int32)  # other visible marks and control characters
    kinds[ord("a") : ord("z") + 1] = np.arange(26)
    kinds[ord("A") : ord("Z") + 1] = 27
    kinds[ord("0") : ord("9") + 1] = 28
    kinds[ord(" ")], kinds[ord("\n")], kinds[[9, 11, 12, 13]] = 29, 30, 31
    kinds[128:192], kinds[192:] = 32, 33
    kinds[list(MARKS)] = 34 + np.arange(len(MARKS))
    return kinds


KINDS = _classes()


def features(text: str) -> np.ndarray:
    out = np.zeros(WIDTH, np.float32)
    kinds = KINDS[np.frombuffer(text.encode(), np.uint8)]
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
        out[: CLASSES * CLASSES] = SCALE * np.sqrt(pairs / len(kinds))
    words = text.split()
    if words:
        lines = [line for line in text.split("\n") if line]
        same = sum(map(str.__eq__, words[:-1], words[1:]))
        out[-MEASURES:] = (
            1.0,
            np.log1p(len(words)) / 10,
            SCALE * len(set(words)) / len(words),
            SCALE * np.sqrt(same / len(words)),
            SCALE * len(set(lines)) / max(1, len(lines)),
            min(1.0, len(text) / len(words) / 20),
        )
    return out


def matrix(texts: list[str]) -> np.ndarray:
    return np.stack([features(t) for t in texts]) if texts else np.zeros((0, WIDTH), np.float32)


@dataclass
class Scorer:
    weights: np.ndarray | None
    bias: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.weights + self.bias if self.weights is not None else np.full(len(x), self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 11) -> Scorer:
    """Minimises prior * E_p[l(z, +)] + max(0, E_u[l(z, -)] - prior * E_p[l(z, -)])
    with the logistic loss l, by Adam over random batches."""
    draw = np.random.default_rng(seed)
    w = np.zeros(positive.shape[1], np.float32)
    b = float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        p = positive[draw.integers(0, len(positive), 512)].astype(np.float32)
        u = unlabelled[draw.integers(0, len(unlabelled), 1024)].astype(np.float32)
        zp, zu = p @ w + b, u @ w + b
        hidden = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up, uu = sigmoid(zp), sigmoid(zu)
        # d/dz of l(z, -) is sigmoid(z), of l(z, +) it is sigmoid(z) - 1.
        gp, gu = -prior * up / len(p), uu / len(u)
        if hidden < 0:
            gp, gu = -gp, -gu
        else:
            gp = gp + prior * (up - 1) / len(p)
        g = p.T @ gp + u.T @ gu + 1e-6 * w
        gb = gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.15 * (1 - step / (STEPS + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w = (w - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        b -= float(rate * mb / (np.sqrt(vb) + 1e-8))
    return Scorer(w, b)


def apart(positive: np.ndarray, unlabelled: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Weights that tell positives from unlabelled rows, both weighing the same."""
    w, b = np.zeros(positive.shape[1], np.float32), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, FOLD_STEPS + 1):
        p = positive[draw.integers(0, len(positive), 512)].astype(np.float32)
        u = unlabelled[draw.integers(0, len(unlabelled), 512)].astype(np.float32)
        gp, gu = (sigmoid(p @ w + b) - 1) / 1024, sigmoid(u @ w + b) / 1024
        g, gb = p.T @ gp + u.T @ gu + 1e-4 * w, gp.sum() + gu.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w = (w - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
        b -= float(rate * mb / (np.sqrt(vb) + 1e-8))
    return w


def least_bound(above_p: np.ndarray, above_u: np.ndarray, n_p: int, n_u: int) -> float:
    """The least of ``above_u / above_p`` with regard to its error, less two errors.
    Both are shares above the same cuts, of ``n_p`` and ``n_u`` rows."""
    spread = above_u * (1 - above_u) / n_u + above_p * (1 - above_p) / n_p
    error = np.sqrt(spread + 1 / n_p**2)
    best = np.argmin((above_u + error) / above_p)
    return float((above_u[best] / above_p[best] - 2 * error[best]).clip(*PRIORS))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 5) -> float:
    """Share of positives in the unlabelled rows; a half where either has one row only."""
    draw = np.random.default_rng(seed)
    folds = min(FOLDS, len(positive), len(unlabelled))
    if folds < 2:
        return 0.5
    above = []
    for fold in range(folds):
        out_p = np.arange(len(positive)) % folds == fold
        out_u = np.arange(len(unlabelled)) % folds == fold
        w = apart(positive[~out_p], unlabelled[~out_u], draw)
        p = np.sort(positive[out_p].astype(np.float32) @ w)
        u = np.sort(unlabelled[out_u].astype(np.float32) @ w)
        # Cuts that leave from half to all of the positives above.
        cuts = p[((1 - np.linspace(0.5, 1, 51)) * len(p)).astype(int)]
        above.append([1 - np.searchsorted(x, cuts) / len(x) for x in (p, u)])
    above_p, above_u = np.mean(above, axis=0)
    return least_bound(above_p, above_u, len(positive), len(unlabelled))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Scorer:
    """``trainable`` is a condition on ``doc_id``; labels of other rows are not read."""
    known = (
        labels.filter(trainable & F.col(quality).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg((F.avg(quality) >= 0.5).alias("good"))
    )
    good = known.filter("good")
    n_good, rows = good.count(), docs.filter(trainable).count()
    if not n_good or not rows:
        return Scorer(None, -50.0)

    def drawn(key: Column, share: float) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1

    # The positives drawn are about ``positives`` ids: a broadcast of bounded size.
    chosen = good.filter(drawn(F.col("id"), positives / n_good)).select("id")
    key = F.concat(F.lit("u"), F.col(doc_id).cast("string"))

    @F.pandas_udf("binary")
    def coded(batch: pd.Series) -> pd.Series:
        return pd.Series([features(t).astype(np.float16).tobytes() for t in batch])

    sample = (
        docs.filter(trainable)
        .select(
            F.col(doc_id).alias("id"),
            F.col(text).alias("text"),
            F.coalesce(drawn(key, unlabelled / rows), F.lit(False)).alias("is_u"),
        )
        .join(F.broadcast(chosen.withColumn("is_p", F.lit(True))), "id", "left")
        .filter("is_u or is_p")
        .select("id", "is_u", "is_p", coded(whole(F.col("text"))).alias("x"))
        .toPandas()
        .sort_values("id")
    )
    x = np.frombuffer(b"".join(sample["x"]), np.float16).reshape(-1, WIDTH)
    p = x[sample["is_p"].notna().to_numpy()]
    u = x[sample["is_u"].to_numpy()]
    if not len(p) or not len(u):
        return Scorer(None, -50.0)
    return train(p, u, class_prior(p, u))


def score(docs: DataFrame, scorer: Scorer, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score as ``out``."""

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = batch.tolist()
            parts = [
                scorer.scores(matrix(texts[i : i + 500])) for i in range(0, len(texts), 500)
            ]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return docs.withColumn(out, judged(whole(F.col(text))))
