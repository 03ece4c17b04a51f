"""The trained models' arithmetic against plain loops and finite differences."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballast.llm import byte_cnn, pu_quality
from ballast.llm.shared import id_bucket

DOCS = "/root/testdata/sf0.001/documents.parquet"
LABELS = "/root/testdata/sf0.001/labels.parquet"
TEXTS = ["", "a", "ab", "A1 \n\t b b b\n\nb\n", "é\U0001f600x" * 9, "one two two\none two two\n" * 40, "z" * 3000]


def kind(byte: int) -> int:
    char = chr(byte)
    if "a" <= char <= "z":
        return byte - 97
    if byte < 128 and char in "|*&%$#!.,:;'\"-_":
        return 34 + "|*&%$#!.,:;'\"-_".index(char)
    if "A" <= char <= "Z":
        return 27
    if "0" <= char <= "9":
        return 28
    return {32: 29, 10: 30, 9: 31, 11: 31, 12: 31, 13: 31}.get(byte, 26 if byte < 128 else 32 if byte < 192 else 33)


def quality_features(text: str) -> list[float]:
    kinds = [kind(b) for b in text.encode()]
    pairs = Counter(zip(kinds, kinds[1:]))
    out = [0.0] * pu_quality.WIDTH
    for (a, b), n in pairs.items():
        out[a * pu_quality.CLASSES + b] = 5 * math.sqrt(n / len(kinds))
    words, lines = text.split(), [x for x in text.split("\n") if x]
    if words:
        same = sum(words[i] == words[i + 1] for i in range(len(words) - 1))
        out[-6:] = [
            1.0,
            math.log1p(len(words)) / 10,
            5 * len(set(words)) / len(words),
            5 * math.sqrt(same / len(words)),
            5 * len(set(lines)) / max(1, len(lines)),
            min(1.0, len(text) / len(words) / 20),
        ]
    return out


def language_score(net, text: str) -> list[float]:
    data, total, covered = text.encode(), [0.0] * len(net.languages), 0
    for begin in range(0, len(data), byte_cnn.WINDOW):
        part = data[begin : begin + byte_cnn.WINDOW]
        window = part + bytes(byte_cnn.WINDOW - len(part))
        hidden = []
        for w in byte_cnn.WIDTHS:
            table = net.tables[w].tolist()
            for f in range(byte_cnn.FILTERS):
                best = max(
                    sum(table[j][window[at + j]][f] for j in range(w))
                    for at in range(byte_cnn.WINDOW - w + 1)
                )
                hidden.append(max(0.0, best + float(net.biases[w][f])))
        raw = [float(sum(h * o for h, o in zip(hidden, net.out[:, c]))) + float(net.out_bias[c]) for c in range(len(total))]
        powers = [math.exp(r - max(raw)) for r in raw]
        for c, p in enumerate(powers):
            total[c] += len(part) * p / sum(powers)
        covered += len(part)
    return [t / covered for t in total]


@pytest.mark.parametrize("text", TEXTS)
def test_quality_features_are_those_of_a_loop(text):
    assert np.allclose(pu_quality.features(text), quality_features(text), atol=1e-5)


def test_quality_scores_are_those_of_a_loop(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text").withColumn("score", F.lit("x"))
    scorer = pu_quality.fit(docs, spark.read.parquet(LABELS), id_bucket(F.col("doc_id"), 5) != 0)
    got = pu_quality.score(docs, scorer, out="quality_score").collect()
    assert got and all(r.score == "x" for r in got)
    for r in got[:200]:
        z = sum(w * x for w, x in zip(scorer.weights.tolist(), quality_features(r.text or ""))) + scorer.bias
        assert r.quality_score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)
    replaced = pu_quality.score(docs, scorer)
    assert replaced.columns.count("score") == 1 and dict(replaced.dtypes)["score"] == "double"


@pytest.mark.parametrize("share", [0.2, 0.5, 0.85])
def test_prior_is_found_without_negative_labels(share):
    draw = np.random.default_rng(3)

    def rows(n, good):
        x = draw.normal(0, 1, (n, 20))
        x[:, 0] += np.where(good, 3, -3)
        return x.astype(np.float32)

    unlabelled = rows(4000, draw.random(4000) < share)
    prior = pu_quality.class_prior(rows(2000, np.ones(2000, bool)), unlabelled)
    assert abs(prior - share) < 0.04


def test_prior_of_few_rows_is_defined():
    one = np.ones((1, 4), np.float32)
    assert pu_quality.class_prior(one, one) == 0.5
    same = np.ones((5, 4), np.float32)
    assert 0.02 <= pu_quality.class_prior(same, same) <= 0.98


def test_negative_labels_do_not_change_the_quality_scorer(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    labels = spark.read.parquet(LABELS).select("doc_id", "quality")
    every = pu_quality.fit(docs, labels, F.lit(True))
    good = pu_quality.fit(docs, labels.filter("quality = 1"), F.lit(True))
    assert np.array_equal(every.weights, good.weights) and every.bias == good.bias


def test_language_gradients_are_finite_differences():
    draw = np.random.default_rng(2)
    x, y = draw.integers(0, 6, (7, 12), dtype=np.uint8), np.array([0, 1, 2, 0, 1, 2, 0])
    width = byte_cnn.FILTERS * len(byte_cnn.WIDTHS)
    net = byte_cnn.Network(
        ["a", "b", "c"],
        {w: draw.normal(0, 0.5, (w, 256, byte_cnn.FILTERS)) for w in byte_cnn.WIDTHS},
        {w: draw.normal(0, 0.1, byte_cnn.FILTERS) for w in byte_cnn.WIDTHS},
        draw.normal(0, 0.5, (width, 3)),
        draw.normal(0, 0.1, 3),
    )
    weight = np.array([0.5, 1.0, 2.0])

    def loss() -> float:
        likely = net.probabilities(x)[np.arange(len(y)), y]
        return float(-(weight[y] * np.log(likely)).mean())

    for value, gradient in byte_cnn.gradients(net, x, y, weight):
        largest = np.argsort(-np.abs(gradient).ravel())[:12]
        others = draw.integers(0, gradient.size, 12)
        for i in np.concatenate([largest, others]):
            at = np.unravel_index(i, value.shape)
            held = value[at]
            value[at] = held + 1e-5
            up = loss()
            value[at] = held - 1e-5
            down = loss()
            value[at] = held
            assert (up - down) / 2e-5 == pytest.approx(float(gradient[at]), abs=2e-5)


def test_language_scores_are_those_of_a_loop(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text", "lang")
    net = byte_cnn.fit(docs, id_bucket(F.col("doc_id"), 4) != 2)
    extra = spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate(TEXTS)], docs.schema)
    some = docs.orderBy("doc_id").limit(8).unionByName(extra)
    for r in byte_cnn.predict(some, net).collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        want = language_score(net, r.text)
        assert r.score == pytest.approx(max(want), abs=1e-4)
        assert want[net.languages.index(r.lang_pred)] == pytest.approx(max(want), abs=1e-4)
