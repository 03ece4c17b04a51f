import random

import pytest
from portfolio import rows_of
from pyspark.sql import functions as F

from ballast.functions.numbering import number_by_id, number_by_pair
from ballast.operators import generate, shaping


@pytest.mark.parametrize("top", [60, 1 << 62])
def test_number_by_id_within_group(spark, top):
    rng = random.Random(1)
    rows = [(g, k - top // 2) for g in (1, 2, 5) for k in rng.sample(range(top), 20)]
    df = spark.createDataFrame(rows, "g long, k long")
    want = [
        (g, k, 1 + sum(1 for h, j in rows if h == g and j < k)) for g, k in rows
    ]
    assert rows_of(number_by_id(df, "k", "n", ["g"]), "g", "k", "n") == sorted(want, key=repr)


def test_number_by_pair_over_everything(spark):
    rng = random.Random(2)
    # One major holds a third of the rows.
    rows = [(7, k) for k in range(30)] + [(rng.randint(0, 30), 100 + i) for i in range(60)]
    df = spark.createDataFrame(rows, "a long, b long")
    want = [(a, b, i + 1) for i, (a, b) in enumerate(sorted(rows))]
    assert rows_of(number_by_pair(df, "a", "b", "n"), "a", "b", "n") == sorted(want, key=repr)


def test_successor(spark):
    keys = [1, 2, 2, 9, 30, 31, 77, 1 << 60]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    distinct = sorted(set(keys))
    want = list(zip(distinct, [*distinct[1:], None]))
    assert rows_of(shaping.successor(df, "k")) == sorted(want, key=repr)


def test_weights_agree_in_both_forms_and_sum_to_one(spark):
    rng = random.Random(4)
    rows = [(m, a, "X", "C", rng.randint(1, 50)) for m in range(6) for a in range(rng.randint(1, 9))]
    raw = spark.createDataFrame(
        rows, "model_id long, asset_id long, exch_code string, curr_code string, size long"
    )
    small, any_size = shaping.spread_weights(raw, max_group=9), shaping.spread_weights(raw)
    assert rows_of(small) == rows_of(any_size)
    totals = any_size.groupBy("model_id").sum("weighting").collect()
    assert len(totals) == 6 and all(t[1] == 1 for t in totals)


def test_pick_kth_skips_what_the_model_holds(spark):
    listing = spark.createDataFrame(
        [(a, "X", "C") for a in (10, 20, 30, 40, 50, 60)],
        "asset_id long, exch_code string, curr_code string",
    )
    held = spark.createDataFrame(
        [(1, 10, "C"), (1, 40, "C"), (2, 60, "C")], "model_id long, asset_id long, curr_code string"
    )
    for k in range(1, 7):
        models = spark.createDataFrame(
            [(1, "C", k), (2, "C", k), (3, "C", k)], "model_id long, curr_code string, k long"
        )
        free = {1: [20, 30, 50, 60], 2: [10, 20, 30, 40, 50], 3: [10, 20, 30, 40, 50, 60]}
        want = [(m, f[k - 1]) for m, f in free.items() if k <= len(f)]
        assert rows_of(shaping.pick_kth(models, listing, held), "model_id", "asset_id") == want
        if k == 1:
            counts = shaping.available_counts(models, listing, held)
            assert rows_of(counts, "model_id", "available") == [(1, 4), (2, 5), (3, 6)]
            one = shaping.available_listings(1, models, listing, held)
            assert rows_of(one, "asset_id") == [(a,) for a in free[1]]


@pytest.mark.parametrize("funds,workers", [(6, 60), (3, 3), (4, 8)])
def test_cohorts_cover_each_fund_once(spark, funds, workers):
    rng = random.Random(5)
    sizes = {f: rng.randint(workers, 3 * workers) for f in range(1, funds + 1)}
    rows = [(f * 1000 + i, f, "C") for f, n in sizes.items() for i in range(n)]
    account = spark.createDataFrame(rows, "accnt_id long, fund_id long, curr_code string")
    ranges = shaping.cohort_ranges(account, workers).collect()
    assert len(ranges) == workers
    for fund, n in sizes.items():
        covered = [
            q for r in ranges if r.fund_id == fund for q in range(r.queue_no_from, r.queue_no_to + 1)
        ]
        assert sorted(covered) == list(range(1, n + 1))


def test_account_queue_restarts_per_fund(spark):
    account = spark.createDataFrame(
        [(5, 1, "C"), (9, 1, "C"), (7, 2, "C")], "accnt_id long, fund_id long, curr_code string"
    )
    assert rows_of(shaping.number_accounts(account), "fund_id", "queue_no", "accnt_id") == [
        (1, 1, 5),
        (1, 2, 9),
        (2, 1, 7),
    ]


def test_isin_keeps_long_ids_whole(spark):
    from pyspark.sql import functions as F

    ids = spark.createDataFrame([(7,), (123456789012,)], "asset_id long")
    isin = ids.select(shaping.isin_code(F.lit("UK"), F.col("asset_id")))
    assert rows_of(isin) == [("UK0000000007",), ("UK123456789012",)]


def test_sparse_ids_are_numbered_over_many_ranges(spark):
    rng = random.Random(9)
    keys = list({rng.getrandbits(64) - (1 << 63) for _ in range(3000)})
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_by_id(df, "k", "n")
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        got = {r.k: r.n for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}
    # What meets in one partition is a count per range.
    assert "row_number" not in plan


def test_model_assets_are_dealt_out_before_they_are_many(spark):
    """Of many listings, neither the models nor what they become is broadcast."""
    listing = spark.range(1, 200_101).selectExpr("id asset_id", "'X' exch_code", "concat('C', id % 2) curr_code")
    model = spark.range(1, 41).selectExpr("id model_id", "concat('C', id % 2) curr_code", "20 assets_count")
    picked = generate.gen_model_assets(model, listing)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [curr_code" in plan and "hashpartitioning(model_id" in plan
    sums = rows_of(picked.groupBy("model_id").agg(F.count_distinct("asset_id").alias("n"), F.sum("weighting").alias("w")))
    assert [(m, n, w) for m, n, w in sorted(sums)] == [(m, 20, 1) for m in range(1, 41)]
