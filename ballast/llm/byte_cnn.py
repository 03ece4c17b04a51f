"""Language identification by a small convolutional network over bytes.

Filters of several widths run over the UTF-8 bytes of a window of fixed length, each
filter's largest response in the window is kept, and a softmax layer maps those to
languages. A text is cut into windows from its first byte to its last; the window
probabilities, weighted by the bytes they cover, give the text's.

The network is trained in numpy on the driver, on windows of a bounded sample of
labelled rows: about ``per_language`` rows of each language, three windows each. The
sample is chosen by a hash of the id, the counts behind it are over all rows.

A null text and a text without a letter are ``und`` with score 0, and so is every text
if there are no labelled rows. Rows with a null or repeated id are predicted like any
other. Other columns pass through, except such as have the names of the two results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.llm.shared import free_name, give_back, whole

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANGUAGE = 600
EPOCHS = 24
UNKNOWN = "und"
CHUNK = 256  # windows at a time
TEXTS = 100  # texts at a time


@dataclass
class Network:
    languages: list[str]
    tables: dict[int, np.ndarray]  # by width: (width, 256, filters), response per byte
    biases: dict[int, np.ndarray]
    out: np.ndarray  # (all filters, languages)
    out_bias: np.ndarray

    def responses(self, windows: np.ndarray, width: int) -> np.ndarray:
        """(windows, places, filters) before the maximum."""
        places = windows.shape[1] - width + 1
        table = self.tables[width]
        total = table[0][windows[:, :places]]
        for j in range(1, width):
            total += table[j][windows[:, j : j + places]]
        return total

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        top = [self.responses(windows, w).max(axis=1) + self.biases[w] for w in self.tables]
        return np.maximum(np.concatenate(top, axis=1), 0)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        parts = [
            softmax(self.pooled(windows[i : i + CHUNK]) @ self.out + self.out_bias)
            for i in range(0, len(windows), CHUNK)
        ]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(text: bytes, window: int = WINDOW) -> np.ndarray:
    """All bytes as rows of one window, the last one filled up with zeros."""
    rows = max(1, -(-len(text) // window))
    padded = np.zeros(rows * window, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return padded.reshape(rows, window)


class Adam:
    def __init__(self, rate: float):
        self.rate, self.state, self.steps = rate, {}, 0

    def step(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.steps += 1
        for i, (value, gradient) in enumerate(pairs):
            m, v = self.state.setdefault(i, (np.zeros_like(value), np.zeros_like(value)))
            m += 0.1 * (gradient - m)
            v += 0.001 * (gradient * gradient - v)
            near = m / (1 - 0.9**self.steps)
            value -= self.rate * near / (np.sqrt(v / (1 - 0.999**self.steps)) + 1e-8)


def gradients(
    net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each of the network's parameters with the gradient of the mean cross-entropy, where
    a row counts by the weight of its language."""
    best, top = {}, []
    for w in WIDTHS:
        response = net.responses(x, w)
        best[w] = response.argmax(axis=1)
        top.append(np.take_along_axis(response, best[w][:, None], 1)[:, 0] + net.biases[w])
    before = np.concatenate(top, axis=1)
    hidden = np.maximum(before, 0)
    delta = softmax(hidden @ net.out + net.out_bias)
    delta[np.arange(len(y)), y] -= 1
    delta *= (weight[y] / len(y))[:, None]
    back = (delta @ net.out.T) * (before > 0)
    pairs = [(net.out, (hidden.T @ delta).astype(np.float32))]
    pairs.append((net.out_bias, delta.sum(axis=0).astype(np.float32)))
    for i, w in enumerate(WIDTHS):
        own = back[:, i * FILTERS : (i + 1) * FILTERS].astype(np.float32)
        gradient = np.zeros_like(net.tables[w])
        rows, columns = np.arange(len(y))[:, None], np.arange(FILTERS)[None]
        for j in range(w):
            np.add.at(gradient[j], (x[rows, best[w] + j], columns), own)
        pairs += [(net.tables[w], gradient), (net.biases[w], own.sum(axis=0))]
    return pairs


def train(
    windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7
) -> Network:
    """Cross-entropy, each language weighing the same; gradients go to the place of
    each filter's maximum."""
    draw = np.random.default_rng(seed)
    net = Network(
        languages,
        {w: draw.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.full(FILTERS, 0.1, np.float32) for w in WIDTHS},
        draw.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weight = len(labels) / (len(languages) * np.bincount(labels, minlength=len(languages)).clip(1))
    adam = Adam(0.01)
    for _ in range(EPOCHS):
        order = draw.permutation(len(labels))
        for begin in range(0, len(order), 128):
            pick = order[begin : begin + 128]
            x, y = windows[pick], labels[pick]
            pairs = gradients(net, x, y, weight)
            adam.step(pairs)
    return net


def fit(
    docs: DataFrame,
    trainable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Network | None:
    """Trains on rows where ``trainable`` holds and ``lang`` is known."""
    labelled = docs.filter(trainable & F.col(lang).isNotNull()).select(
        F.xxhash64(F.col(doc_id).cast("string")).alias("h"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
    )
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))]
    )
    size = F.char_length("text")
    sample = (
        labelled.filter(F.col("text").rlike(r"\p{L}"))
        .filter(F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
        .select(
            "h",
            "lang",
            F.explode(
                F.array(
                    *[
                        F.substring("text", (F.floor(size * at) + 1).cast("int"), F.lit(WINDOW))
                        for at in (0.05, 0.4, 0.75)
                    ]
                )
            ).alias("part"),
        )
        .filter("part != ''")
        .toPandas()
        .sort_values(["lang", "h", "part"])
    )
    if not len(sample):
        return None
    languages = sorted(counts)
    windows = np.concatenate([cut(p.encode()[:WINDOW]) for p in sample["part"]])
    labels = sample["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()
    return train(windows, labels, languages)


def predict_texts(net: Network, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Index of the most likely language and its probability, per text."""
    cuts, sizes, counts = [], [], []
    for t in texts:
        coded = t.encode()
        cuts.append(cut(coded))
        counts.append(len(cuts[-1]))
        size = np.full(counts[-1], WINDOW)
        size[-1] = max(1, len(coded) - WINDOW * (counts[-1] - 1))
        sizes.append(size)
    if not cuts:
        return np.zeros(0, int), np.zeros(0)
    weight = np.concatenate(sizes)[:, None]
    likely = net.probabilities(np.concatenate(cuts)) * weight
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    mean = np.add.reduceat(likely, starts) / np.add.reduceat(weight, starts)
    return mean.argmax(axis=1), mean.max(axis=1).astype(float)


def predict(
    docs: DataFrame,
    net: Network | None,
    text: str = "text",
    lang_pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its probability."""
    if net is None:
        return docs.withColumns({lang_pred: F.lit(UNKNOWN), score: F.lit(0.0)})

    @F.pandas_udf("struct<lang:string,score:double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        try:
            for batch in batches:
                langs = np.full(len(batch), UNKNOWN, object)
                scores = np.zeros(len(batch))
                texts = np.flatnonzero(batch.notna())
                for begin in range(0, len(texts), TEXTS):
                    some = texts[begin : begin + TEXTS]
                    best, scores[some] = predict_texts(net, batch.iloc[some].tolist())
                    langs[some] = np.array(net.languages, object)[best]
                yield pd.DataFrame({"lang": langs, "score": scores})
        finally:
            give_back()

    # Texts without a letter reach Python as nulls.
    lettered = F.when(F.col(text).rlike(r"\p{L}"), whole(F.col(text)))
    both = free_name(docs, "_judged")
    judged = docs.withColumn(both, judge(lettered))
    return judged.withColumns(
        {lang_pred: F.col(f"{both}.lang"), score: F.col(f"{both}.score")}
    ).drop(both)
