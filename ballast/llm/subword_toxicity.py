"""Toxicity from subword-bag embeddings under a linear softmax.

A word, lower-cased and wrapped in blanks, is the bag of its byte n-grams of 3 to 6,
hashed into ``BUCKETS`` vectors, so that an unseen misspelling shares most of its vectors
with the word it comes from. A window of ``WINDOW`` words is the average of its words'
averages; a linear softmax over that average gives its chance of being toxic. A text is
cut into such windows, overlapping by half, from its first word to its last, and scored
by the average of its ``TOP`` most toxic ones, so that few words in a long text count.

Embeddings and softmax are trained jointly in numpy on the driver. Labels are of whole
texts, so training goes from all windows to the highest ones: first a few windows of
each text drawn at random carry its label, then the average of its highest under the
present model does. The sample is bounded: about ``toxic`` and ``clean`` rows, and at most about
``MOST_CHARS`` characters of each class, chosen by a hash of the id; the counts behind
that are over all labelled rows.

As the model is linear, every bucket's vector comes down to one number. Tasks look these
up, average them by word and window, and keep the maximum: a few numpy passes over the
bytes of a text, in slices of bounded size.

A null text counts as empty; an empty text scores what the softmax gives an average of
nothing. Labels that are null, repeated or for no document are combined by their mean, or
ignored. With one class alone among the labelled rows every text scores 1 or 0 as that
class says, without labels 0. Very long texts are scored whole, slice by slice. Other
columns pass through, except one with the name of the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballast.llm.shared import whole

GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 17
WIDTH = 8
WINDOW = 4
STRIDE = WINDOW // 2
TOXIC = 1500
CLEAN = 3000
MOST_CHARS = 6_000_000
TOP = 3  # windows of a text that count
EARLY, LATE = 4, 8  # passes with drawn windows, passes with the highest
EARLY_STEPS, LATE_STEPS = 100, 300  # at least so many steps of either kind
BATCH = 128
RATE = 0.05
THRESHOLD = 0.7
SLICE = 1 << 19  # bytes looked at in one go
BLANK = 32
TO_BLANK = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)


def lowered(text: str) -> bytes:
    return text.lower().encode().translate(TO_BLANK)


@dataclass
class Bag:
    """Words of a stretch of text: where each one's n-grams begin among ``buckets``."""

    buckets: np.ndarray
    starts: np.ndarray

    def means(self, value: np.ndarray) -> np.ndarray:
        """The average of ``value`` over each word's n-grams."""
        if not len(self.starts):
            return np.zeros(0, np.float32)
        sizes = np.diff(np.append(self.starts, len(self.buckets)))
        return np.add.reduceat(value[self.buckets], self.starts) / sizes


def bag(data: bytes) -> Bag:
    """The n-grams of all words of a ``lowered`` text, word by word."""
    raw = np.frombuffer(b" " + data + b" ", np.uint8)
    # One blank between words.
    raw = raw[np.append(True, (raw[1:] != BLANK) | (raw[:-1] != BLANK))]
    blank = np.flatnonzero(raw == BLANK)
    if len(blank) < 2:
        return Bag(np.zeros(0, np.int64), np.zeros(0, np.int64))
    word = np.cumsum(raw == BLANK) - 1  # a blank counts to the word after it
    after = np.append(blank[1:], len(raw))[word]  # the blank that ends the word
    room = after - np.arange(len(raw)) + 1  # bytes up to that blank, itself included
    room[blank[-1] :] = 0
    code = raw.astype(np.uint32) + 1
    hashed = np.zeros(len(raw), np.uint32)
    found, owner = [], []
    for n in range(1, max(GRAMS) + 1):
        here = len(raw) - n + 1
        if here <= 0:
            break
        hashed = hashed[:here] * np.uint32(16777619) + code[n - 1 :]
        if n in GRAMS:
            # An n-gram lies within a word and its two blanks.
            at = np.flatnonzero(room[:here] >= n)
            h = hashed[at] * np.uint32(2654435761) + np.uint32(n)
            found.append(((h ^ (h >> np.uint32(15))) & np.uint32(BUCKETS - 1)).astype(np.int32))
            owner.append(word[at])
    if not found:
        return Bag(np.zeros(0, np.int64), np.zeros(0, np.int64))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    owner, found = owner[order], found[order]
    return Bag(found, np.flatnonzero(np.diff(owner, prepend=-1)))


def windows(values: np.ndarray) -> np.ndarray:
    """The average of ``values`` over each window; the last one reaches the end."""
    n = len(values)
    if n <= WINDOW:
        return values.mean(keepdims=True) if n else np.zeros(0, np.float32)
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    at = np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)
    return (total[at + WINDOW] - total[at]) / WINDOW


def top(values: np.ndarray) -> np.ndarray:
    """Places of the ``TOP`` highest, all if fewer."""
    return np.argpartition(values, len(values) - TOP)[-TOP:] if len(values) > TOP else np.arange(len(values))


def window_starts(n: int) -> np.ndarray:
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW) if n > WINDOW else np.zeros(1, np.int64)


@dataclass
class Model:
    weights: np.ndarray  # (BUCKETS,): the difference of the two classes' logits per n-gram
    bias: float

    def highest(self, text: str) -> float:
        """The logit of the most toxic windows."""
        data, best, tail = lowered(text), np.zeros(0), b""
        for at in range(0, max(1, len(data)), SLICE):
            part = tail + data[at : at + SLICE]
            if at + SLICE < len(data):
                part, tail = _split(part)
            values = bag(part).means(self.weights)
            if len(values):
                best = np.append(best, windows(values))
                best = best[top(best)]
        return (float(best.mean()) if len(best) else 0.0) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.array([self.highest(t) for t in texts], np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _split(part: bytes) -> tuple[bytes, bytes]:
    """What to look at now, and what the next slice begins with: the last words are in
    both, as far back as a window reaches. A word longer than a slice is cut."""
    at, cut = len(part), len(part)
    for i in range(WINDOW):
        at = part.rfind(b" ", 0, at)
        if at < 0:
            break
        if i == 0:
            cut = at
    return (part[:cut], part[at + 1 :]) if at > 0 else (part[:cut], part[cut:])


def _batch(bags: list[Bag], picks: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """buckets, their share in the average of each pick's windows, and where it begins."""
    buckets, shares, starts, at = [], [], [], 0
    for d, firsts in picks:
        b = bags[d]
        starts.append(at)
        ends = np.append(b.starts, len(b.buckets))
        for first in firsts.tolist():
            edges = ends[first : first + WINDOW + 1]
            sizes = np.diff(edges)
            part = b.buckets[edges[0] : edges[-1]]
            buckets.append(part)
            shares.append(np.repeat(1 / (sizes * len(sizes) * len(firsts)), sizes))
            at += len(part)
    return np.concatenate(buckets), np.concatenate(shares).astype(np.float32), np.array(starts)


def train(texts: list[str], labels: np.ndarray, seed: int = 3) -> Model:
    """Cross-entropy over windows, Adam on the vectors and the softmax together; both
    classes weigh the same."""
    draw = np.random.default_rng(seed)
    bags = [bag(lowered(t)) for t in texts]
    used = [i for i, b in enumerate(bags) if len(b.starts)]
    table = draw.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    soft = draw.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (table, soft, bias)]
    counts = np.bincount(labels[used], minlength=2).clip(1)
    weigh = len(used) / (2 * counts)
    step = done = 0
    for epoch in range(10_000):
        late = epoch >= EARLY and step >= EARLY_STEPS
        done += late
        if done > LATE and step >= EARLY_STEPS + LATE_STEPS or not used:
            break
        flat = table @ (soft[:, 1] - soft[:, 0])
        picks = []
        for d in used:
            at = window_starts(len(bags[d].starts))
            if late:
                picks.append((d, at[top(windows(bags[d].means(flat)))]))
            else:
                picks += [(d, at[i : i + 1]) for i in np.unique(draw.integers(0, len(at), 12))]
        order = draw.permutation(len(picks))
        for begin in range(0, len(order), BATCH):
            some = [picks[i] for i in order[begin : begin + BATCH]]
            buckets, shares, starts = _batch(bags, some)
            y = labels[[d for d, _ in some]]
            hidden = np.add.reduceat(table[buckets] * shares[:, None], starts)
            z = hidden @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= (weigh[y] / len(y))[:, None]
            p = p.astype(np.float32)
            back = np.repeat(p @ soft.T, np.diff(np.append(starts, len(buckets))), axis=0)
            touched, place = np.unique(buckets, return_inverse=True)
            grown = np.zeros((len(touched), WIDTH), np.float32)
            np.add.at(grown, place, back * shares[:, None])
            step += 1
            rate = RATE / (1 + step / LATE_STEPS)
            # Vectors are moved where the batch has their n-grams.
            for x, g, (m, v), rows in (
                (table, grown, state[0], touched),
                (soft, hidden.T @ p, state[1], slice(None)),
                (bias, p.sum(axis=0), state[2], slice(None)),
            ):
                m[rows] = 0.9 * m[rows] + 0.1 * g
                v[rows] = 0.99 * v[rows] + 0.01 * g * g
                x[rows] -= rate * m[rows] / (np.sqrt(v[rows]) + 1e-6)
    return Model((table @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    toxic_rows: int = TOXIC,
    clean_rows: int = CLEAN,
) -> Model:
    """``trainable`` is a condition on ``doc_id``; labels of other rows are not read."""
    known = (
        labels.filter(trainable & F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg((F.avg(toxic) >= 0.5).alias("bad"))
    )
    counts = {r["bad"]: r["n"] for r in known.groupBy("bad").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 50.0 if counts.get(True) else -50.0)
    # The rows drawn are about as many as asked for: a broadcast of bounded size.
    share = F.when(F.col("bad"), toxic_rows / counts[True]).otherwise(clean_rows / counts[False])
    drawn = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) < share * (1 << 20)
    rows = docs.select(F.col(doc_id).alias("id"), whole(F.col(text)).alias("text"))
    chosen = rows.join(F.broadcast(known.filter(drawn)), "id")
    # Characters first, so that few but long texts do not fill the driver.
    size = {r["bad"]: r["c"] for r in chosen.groupBy("bad").agg(F.sum(F.char_length("text")).alias("c")).collect()}
    part = {k: min(1.0, MOST_CHARS / max(1, size.get(k, 0))) for k in (True, False)}
    again = F.pmod(F.xxhash64(F.lit("chars"), F.col("id").cast("string")), F.lit(1 << 20))
    small = again < F.when(F.col("bad"), part[True]).otherwise(part[False]) * (1 << 20)
    sample = chosen.filter(small).toPandas().sort_values(["id", "text"])
    y = sample["bad"].to_numpy().astype(np.int64)
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(counts[True] / counts[False])))
    return train(sample["text"].tolist(), y)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with each text's chance of being toxic."""

    @F.pandas_udf("double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist()), dtype="float64")

    return docs.withColumn(out, judged(whole(F.col(text))))
