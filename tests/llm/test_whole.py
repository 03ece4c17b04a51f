"""Whole results where groups are large and overlap."""

import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from ballast.llm import order_minhash, suffix_tree


def overlapping(seed: int, n: int, size: int, width: int) -> list[tuple]:
    """Texts that share a base, but for a stretch somewhere and a few words."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"b{j}" for j in range(size)]
        at = draw.randrange(size - width)
        for j in range(at, at + width):
            words[j] = f"r{j}"
        for j in draw.sample(range(size), 3):
            words[j] = f"x{i}_{j}"
        rows.append((i, " ".join(words)))
    return rows


def all_pairs(rows: list[tuple]) -> dict:
    """doc_id -> class, from every pair whose sets of runs allow 0.8."""
    texts = [plain.runs(t) for _, t in rows]
    number = {r: i for i, r in enumerate({r for t in texts for r in t})}
    has = np.zeros((len(rows), len(number)), np.float32)
    for i, t in enumerate(texts):
        has[i, [number[r] for r in t]] = 1
    shared, size = has @ has.T, has.sum(axis=1)
    label = list(range(len(rows)))
    for i, j in np.argwhere(np.triu(shared >= 0.8 * (size[:, None] + size - shared), 1)).tolist():
        if label[i] != label[j] and plain.aligned(texts[i], texts[j]) >= 0.8:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return {d: rows[label[i]][0] for i, (d, _) in enumerate(rows)}


def test_overlapping_large_groups_have_the_classes_of_all_pairs(spark, tmp_path):
    rows = overlapping(3, 800, 150, 45)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    got = order_minhash.classes(spark.read.parquet(f"{tmp_path}/d")).collect()
    want = all_pairs(rows)
    assert {r.doc_id: r.class_id for r in got} == want and len(set(want.values())) < len(rows)


def around_one_text(n: int) -> list[tuple]:
    """Texts that are near copies of the last one, but not of each other."""
    draw = random.Random(n)
    base = [f"b{j}" for j in range(150)]
    rows = []
    for i in range(n):
        new = set(draw.sample(range(150), 3))
        rows.append((i, " ".join(f"x{i}_{j}" if j in new else w for j, w in enumerate(base))))
    return [*rows, (n, " ".join(base))]


@pytest.mark.parametrize("n", [300, 900])
def test_near_copies_of_one_text_take_pairs_in_line_with_their_number(spark, tmp_path, monkeypatch, n):
    spark.createDataFrame(around_one_text(n), "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    tested, verified = [], order_minhash.verified

    def counted(pairs, texts):
        tested.append(pairs.count())
        return verified(pairs, texts)

    monkeypatch.setattr(order_minhash, "verified", counted)
    got = order_minhash.classes(spark.read.parquet(f"{tmp_path}/d")).collect()
    assert len(got) == n + 1 and {(r.class_id, r.class_size) for r in got} == {(0, n + 1)}
    assert sum(tested) <= 20 * n


def test_rare_runs_make_each_similar_pair_but_seldom_twice(spark, tmp_path, monkeypatch):
    draw = random.Random(5)
    swapped = [set(draw.sample(range(30), 2)) for _ in range(150)]
    rows = [(i, " ".join(f"{'r' if j // 5 in two and j % 5 == 2 else 'b'}{j}" for j in range(150))) for i, two in enumerate(swapped)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    _, texts = order_minhash.distinct_texts(spark.read.parquet(f"{tmp_path}/d"), "doc_id", "text")
    made, ordered = [], order_minhash._ordered
    monkeypatch.setattr(order_minhash, "_ordered", lambda pairs: made.append(ordered(pairs)) or made[-1])
    alone = texts.select("node", (F.size("ids") - order_minhash.K + 1).alias("n"), F.col("node").alias("label"))
    pairs = order_minhash._by_rare_runs(order_minhash._rare(alone, texts))
    found = order_minhash.verified(pairs, texts).count()
    runs = [plain.runs(t) for t in {t for _, t in rows}]
    similar = sum(plain.aligned(x, y) >= 0.8 for i, x in enumerate(runs) for y in runs[:i])
    assert found == similar > 100 and made[0].count() <= 3 * pairs.count()


def test_contexts_seen_often_are_kept_in_a_corpus_of_any_size(spark, tmp_path):
    draw = random.Random(1)
    rows = [(i, " ".join(draw.choice("abcdefgh") for _ in range(5000))) for i in range(200)]
    rows += [(1000 + i, "qzx7" if i % 2 else "kzx3") for i in range(200)]  # each 1/20,000 of all symbols
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/d")
    got = suffix_tree.scores(spark.read.parquet(f"{tmp_path}/d"), F.lit(False)).collect()
    assert min(r.score for r in got if r.doc_id >= 1000) > np.log10(0.2)
