"""The closed form of the trim against the loop it replaces."""

import random

import pytest
from portfolio import dec, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ballast.operators import allocation

MICRO = 1_000_000


def half_up(a: int, b: int) -> int:
    q = (2 * abs(a) + b) // (2 * b)
    return q if a >= 0 else -q


def by_loop(target: int, assets: list[tuple[int, int, int]], trigger: str):
    """One unit off per step. ``assets`` is (asset id, weight, price), in millionths."""
    units = {a: half_up(target * w * (1 if p > 0 else -1), abs(p)) for a, w, p in assets}
    price = {a: p for a, _, p in assets}
    rounded = {a: half_up(u, MICRO) for a, u in units.items()}
    if trigger == "unrounded":
        nanos = sum(half_up(units[a] * price[a], 1000) for a in units if rounded[a] > 0)
        value = half_up(nanos, 1000)
    else:
        value = sum(rounded[a] * price[a] for a in units if rounded[a] >= 1)
    adjusted = dict(rounded)

    def cheapest():
        left = [(price[a], a) for a in adjusted if adjusted[a] >= 1]
        return min(left)[1] if left else None

    if value > target:
        pick = cheapest()
        while pick is not None:
            adjusted[pick] -= 1
            value = sum(n * price[a] for a, n in adjusted.items() if n >= 1)
            pick = cheapest() if value > target else None
    for a in adjusted:
        if adjusted[a] == 0:
            adjusted[a] = rounded[a]
    invested = sum(n * price[a] for a, n in adjusted.items())
    return adjusted, value, invested


def random_accounts(n: int, seed: int):
    rng = random.Random(seed)
    accounts = []
    for i in range(n):
        k = rng.randint(1, 8)
        weights = [rng.randint(0, 300_000) for _ in range(k)]
        if rng.random() < 0.7 and sum(weights):
            weights[-1] += MICRO - sum(weights)
        low_prices = rng.random() < 0.5
        prices = [
            rng.choice([1, 2, 3, 3, 4, 5]) * MICRO if low_prices else rng.randint(1, 9_000_000)
            for _ in range(k)
        ]
        if rng.random() < 0.05:
            prices[rng.randrange(k)] *= -1
        scale = rng.choice([10, 100, 1000, 20_000])
        target = rng.randint(-scale // 5, scale) * MICRO // rng.choice([1, 3, 7])
        ids = rng.sample(range(100), k)
        accounts.append((i, target, list(zip(ids, weights, prices))))
    return accounts


TARGET = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("accnt_id", "fund_id", "model_id")]
    + [T.StructField(c, T.StringType()) for c in ("rebal_id", "curr_code")]
    + [T.StructField("target_invest_value", T.DecimalType(20, 6))]
)
SNAPSHOT = (
    "rebal_id string, fund_id long, asset_id long, exch_code string, curr_code string,"
    " price decimal(20,6)"
)
MODEL = (
    "model_id long, asset_id long, exch_code string, curr_code string, weighting decimal(9,6)"
)


@pytest.mark.parametrize("trigger", ["unrounded", "rounded"])
@pytest.mark.parametrize("window_rows", [100, 2])
def test_trim_equals_loop(spark, trigger, window_rows):
    accounts = random_accounts(400 if window_rows == 100 else 40, seed=7)
    # Each account is its own model and rebalance, so prices differ freely.
    target = spark.createDataFrame(
        [(i, 1, i, f"R{i}", "C", dec(t) / MICRO) for i, t, _ in accounts], TARGET
    )
    rows = [(i, a, w, p) for i, _, assets in accounts for a, w, p in assets]
    models = spark.createDataFrame(
        [(i, a, "X", "C", dec(w) / MICRO) for i, a, w, _ in rows], MODEL
    )
    snapshot = spark.createDataFrame(
        [(f"R{i}", 1, a, "X", "C", dec(p) / MICRO) for i, a, _, p in rows], SNAPSHOT
    )
    # A model only meets its own rebalance here.
    priced, _ = allocation.price_models(models, snapshot, window_rows)
    priced = priced.filter(F.concat(F.lit("R"), F.col("model_id").cast("string")) == F.col("rebal_id"))
    assert ("chunk" in priced.columns) == (window_rows == 2)
    adjusted = allocation.trim_to_budget(
        allocation.round_units(allocation.allocate(target, priced)), trigger
    )
    got = {
        (r.accnt_id, r.asset_id): int(r.units_adjusted)
        for r in adjusted.select("accnt_id", "asset_id", "units_adjusted").collect()
    }
    balances = {
        r.accnt_id: (
            int(r.rounded_target_invest_value * MICRO),
            int(r.rebalanced_invest_value * MICRO),
            int(r.rebalanced_cash_balance * MICRO),
        )
        for r in allocation.new_balances(target, adjusted).collect()
    }
    trimmed = 0
    for i, t, assets in accounts:
        want, value, invested = by_loop(t, assets, trigger)
        assert {a: got[i, a] for a in want} == want, (i, t, assets)
        assert balances[i] == (value, invested, t - invested), (i, t, assets)
        trimmed += value != t and any(want[a] for a in want)
    assert trimmed


def test_at_most_one_asset_ends_trimmed(spark):
    from ballast.plans import catalog
    from ballast.sources.star import StarSource

    src = StarSource(spark, "/root/testdata/sf0.001")
    rows = catalog.queries()["holdings_adjusted"](spark, src.path)
    changed = rows.filter("units_adjusted <> units_rounded")
    assert changed.filter("units_adjusted > units_rounded").count() == 0
    assert changed.groupBy("accnt_id").count().filter("count > 1").count() == 0


def test_cheapest_breaks_ties_by_asset(spark):
    rows = spark.createDataFrame(
        [(1, 9, 2, 5), (1, 4, 2, 5), (1, 3, 1, 0), (2, 7, 3, 1)],
        "accnt_id long, asset_id long, price int, units_rounded int",
    )
    assert rows_of(allocation.cheapest(rows)) == [(1, 4, 2), (2, 7, 3)]


def test_accounts_are_not_spread_in_the_tasks_of_the_models(spark, table, monkeypatch):
    """Beyond the bound of a broadcast both sides are shuffled, however small one looks."""
    monkeypatch.setattr(allocation, "MAX_BROADCAST_ROWS", 1)
    snapshot = spark.createDataFrame(
        [("R", 1, a, "X", "C0", dec(a)) for a in (1, 2)],
        "rebal_id string, fund_id long, asset_id long, exch_code string, curr_code string, price decimal(20,6)",
    )
    models = spark.createDataFrame(
        [(9, a, "X", "C0", dec("0.5")) for a in (1, 2)],
        "model_id long, asset_id long, exch_code string, curr_code string, weighting decimal(20,6)",
    )
    target = spark.createDataFrame(
        [("R", k, 1, "C0", 9, dec(k * 10)) for k in (1, 2, 3)],
        "rebal_id string, accnt_id long, fund_id long, curr_code string, model_id long, target_invest_value decimal(20,6)",
    )
    spread = allocation.allocate(target, allocation.price_models(models, snapshot)[0])
    assert "SortMergeJoin [rebal_id" in spread._jdf.queryExecution().executedPlan().toString()
    assert rows_of(spread, "accnt_id", "asset_id", "units_target") == sorted(
        ((k, a, dec(k * 5 / a)) for k in (1, 2, 3) for a in (1, 2)), key=repr
    )
