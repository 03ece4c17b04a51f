"""Hard negatives against whole numbers in Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ballast.llm import rns_negatives
from ballast.llm.queries import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, anchor string, comps int"
COLUMNS = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def brute(rows: list[tuple]) -> list[tuple]:
    taken = []
    for place, (vec_id, vector, label, *_) in enumerate(rows):
        if vec_id is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        taken.append((place, vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for place, anchor, label, comps in taken:
        if anchor % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(comps, other)), vec_id, at, own)
            for at, vec_id, own, other in taken
        )
        positives = [s for s in scored if s[3] == label and s[2] != place][:5]
        for p, positive, *_ in positives:
            fit = [s for s in scored if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [
                (anchor, positive, rank, vec_id, -p, -s)
                for rank, (s, vec_id, *_) in enumerate(fit[:5], 1)
            ]
    return sorted(out)


def result(spark, folder) -> list[tuple]:
    got = queries()["op13_rns_negatives"](spark, str(folder))
    assert got.columns == COLUMNS
    return sorted(tuple(r) for r in got.collect())


def stored(spark, folder, rows):
    rows = [(*r, "s", "a", 1) for r in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/embeddings.parquet")


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = result(spark, folder)
    assert got == brute(rows) and got


@pytest.mark.parametrize("cell", [16, 2048])
def test_ties_copies_and_odd_rows(spark, tmp_path, monkeypatch, cell):
    monkeypatch.setattr(rns_negatives, "LEAST_CELL", cell)
    monkeypatch.setattr(rns_negatives, "ANCHORS", cell)
    draw = random.Random(4)
    rows = [
        (i, [draw.choice([-0.5, 0.25, 0.75, 1.0]) for _ in range(3)], draw.randrange(3)) for i in range(0, 4000, 10)
    ]
    rows += [(i, [0.5, 0.5, 0.5], i % 2) for i in range(5001, 5200)]  # a third, all alike
    rows += [(100, [1.0, 1.0, 1.0], 1), (100, [1.0, 1.0, 1.0], 1), (7700, [-1.0, 0.0, 0.0], 2)]
    rows += [
        (None, [1.0] * 3, 1), (6000, None, 1), (6100, [1.0, None, 1.0], 1), (6200, [1.0] * 3, None),
        (6300, [math.nan] * 3, 1), (6400, [1.0, math.inf, 1.0], 1), (6500, [], 1), (6600, [1.0], 1),
        (6700, [1.0, 1.0, 1.0, 1.0], 2), (6800, [0.0] * 3, 1), (6900, [1.0] * 3, 9),
    ]
    stored(spark, tmp_path, rows)
    got = result(spark, tmp_path)
    assert got == brute(rows)


def test_large_numbers_need_more_primes(spark, tmp_path):
    draw = random.Random(6)
    rows = [(i * 25, [draw.uniform(-2.0**20, 2.0**20) for _ in range(6)], i % 3) for i in range(120)]
    stored(spark, tmp_path, rows)
    got = result(spark, tmp_path)
    assert got == brute(rows) and max(r[4] for r in got) > 2**53


def test_empty_table(spark, tmp_path):
    stored(spark, tmp_path, [])
    assert result(spark, tmp_path) == []


def test_products_are_exact_up_to_the_limit():
    draw = np.random.default_rng(3)
    for top in (3, 1000, 1 << 20, 1 << 28):
        a, b = (draw.integers(-top, top + 1, (5, 9)) for _ in range(2))
        want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
        mods = rns_negatives.moduli(max(sum(int(x) ** 2 for x in r) for r in [*a, *b]))
        got = rns_negatives.Residues(a, mods).products(rns_negatives.Residues(b, mods), 0, 5)
        assert got.tolist() == want
    # Long rows are summed in parts that float32 holds exactly.
    a = np.full((1, 5000), 125)
    one = rns_negatives.Residues(a, rns_negatives.moduli(5000 * 125**2))
    assert one.products(one, 0, 1)[0, 0] == 5000 * 125**2


def test_general_interface_keeps_ranks(spark, tmp_path):
    rows = [(i, [float(i % 5), 1.0], i % 2) for i in range(40)]
    stored(spark, tmp_path, rows)
    vectors = spark.read.parquet(f"{tmp_path}/embeddings.parquet")
    got = rns_negatives.mine(vectors, F.col("vec_id") == 4, positives=2, negatives=3, low=(1, 2), high=(3, 2)).collect()
    assert {r.positive_rank for r in got} == {1, 2} and {r["rank"] for r in got} == {1, 2, 3}
    assert all(2 * r.negative_score >= r.positive_score >= r.negative_score / 1.5 for r in got)
