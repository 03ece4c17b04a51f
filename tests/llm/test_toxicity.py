"""Toxicity: its parts against loops, its scores against held-out and planted rows."""

import random
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ballast.llm import subword_toxicity as toxicity
from ballast.llm.queries import queries

FOLDER = "/root/testdata/sf0.1"


def plain_grams(word: bytes) -> list[bytes]:
    whole = b" " + word + b" "
    return [whole[i : i + n] for n in toxicity.GRAMS for i in range(len(whole) - n + 1)]


def hashed(gram: bytes) -> int:
    h = 0
    for b in gram:
        h = (h * 16777619 + b + 1) % 2**32
    h = (h * 2654435761 + len(gram)) % 2**32
    return (h ^ (h >> 15)) % toxicity.BUCKETS


def plain_score(model: toxicity.Model, text: str) -> float:
    words = toxicity.lowered(text).split()
    means = [np.mean([model.weights[hashed(g)] for g in plain_grams(w)]) for w in words]
    n, w = len(means), toxicity.WINDOW
    starts = sorted({*range(0, n - w, toxicity.STRIDE), n - w}) if n > w else [0]
    logits = sorted((np.mean(means[s : s + w]) for s in starts) if n else [0.0])[-toxicity.TOP :]
    return 1 / (1 + np.exp(-(np.mean(logits) + model.bias)))


def test_scores_are_those_of_a_loop():
    draw = np.random.default_rng(5)
    model = toxicity.Model(draw.normal(0, 2, toxicity.BUCKETS).astype(np.float32), -0.5)
    texts = ["", " \t\n", "a", "Ab c", "Étrange été\tñ中文", "a b c d e f g", "x" * 300, "one two three four five"]
    got = model.scores(texts)
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-5)


def test_long_texts_are_scored_whole_in_slices(monkeypatch):
    draw = random.Random(1)
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), -3.0)
    for gram in plain_grams(b"awful"):
        model.weights[hashed(gram)] = 30.0
    words = ["".join(draw.choice("bcdf") for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    low = model.scores([" ".join(words)])[0]
    monkeypatch.setattr(toxicity, "SLICE", 500)
    for at in (0, 1, 77, 1500, 2998, 2999):
        some = [*words[:at], "awful", *words[at + 1 :]]
        assert model.scores([" ".join(some)])[0] > low + 0.2
        assert abs(model.scores(["\n".join(some)])[0] - model.scores([" ".join(some)])[0]) < 1e-9
    assert model.scores(["q" * 5000, "awful " * 1000])[1] > 0.99


def test_gradient_steps_learn_a_word_among_many():
    draw = random.Random(2)
    plain = [f"w{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(300):
        words = [draw.choice(plain) for _ in range(draw.randint(1, 120))]
        if i % 4 == 0:
            words.insert(draw.randint(0, len(words)), draw.choice(["dreadful", "horrid"]))
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.train(texts, np.array(labels))
    scores = model.scores(["w1 w2 dreadful w3", "w5 w6 dreadfull w7 w8", "horid w9", "w1 w2 w3", "w11 w12 " * 500])
    assert (scores[:3] > 0.7).all() and (scores[3:] < 0.3).all()


def test_held_out_rows(spark):
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{FOLDER}/labels.parquet'").fetchall())
    got = queries()["op12_subword_toxicity"](spark, FOLDER).collect()
    n = duckdb.sql(f"select count(*) from '{FOLDER}/documents.parquet'").fetchall()[0][0]
    assert len(got) == n and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    bad = [p for y, p in held if y]
    clean = [p for y, p in held if not y]
    assert sum(bad) >= 0.8 * len(bad) and sum(clean) <= 0.01 * len(clean)


def test_odd_rows_and_labels(spark):
    rows = [(1, None), (2, ""), (3, "nice words here"), (3, "nice words here"), (None, "rotten"), (4, "rotten " * 9)]
    rows += [(10 + i, "rotten apples" if i % 2 else "nice pears") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("bad", F.lit("x")).withColumn("score", F.lit("old"))
    marks = [(10 + i, i % 2) for i in range(40)] + [(12, 0), (12, None), (None, 1), (999, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and {r.bad for r in got} == {"x"}
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert by_text["rotten apples"] > 0.7 > 0.3 > by_text["nice pears"]
    # One class alone, no labels, no rows.
    assert toxicity.score(docs, toxicity.fit(docs, labels.filter("toxic = 1"), F.lit(True))).first().score > 0.99
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0), F.lit(True))).first().score < 0.01
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels, F.lit(True))).collect() == []
    other = docs.withColumnRenamed("score", "s")
    assert toxicity.score(other, model, out="tox").columns == [*other.columns, "tox"]
