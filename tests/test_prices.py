import random
from datetime import datetime, timedelta

import pytest
from portfolio import dec, rows_of

import numpy as np
from pyspark.sql import functions as F

from ballast.functions.sizing import cut_lineage
from ballast.functions.tickfold import LISTING, fold_runs, next_price
from ballast.operators import prices
from ballast.plans.jobs import run_ticks
from ballast.sources.state import read_table, write_tables

START = datetime(2024, 1, 1)
MICRO = 1_000_000


def tick(event, minutes, asset, variance, curr="C0"):
    return (event, START + timedelta(minutes=minutes), asset, "X", curr, variance)


def by_loop(opening: dict, ticks: list):
    price = {asset: int(dec(p) * MICRO) for asset, p in opening.items()}
    log = []
    for event, ts, asset, _, _, variance in sorted(ticks, key=lambda t: (t[1], t[0])):
        if asset not in price:
            continue
        after = next_price(price[asset], variance)
        if after is None:
            continue
        log.append((event, asset, dec(price[asset]) / MICRO, dec(after) / MICRO))
        price[asset] = after
    return {a: dec(p) / MICRO for a, p in price.items()}, log


def check(spark, table, opening, ticks, **limits):
    listing = table("listing_price", [(a, "X", "C0", dec(p)) for a, p in opening.items()])
    update = prices.apply_ticks(listing, table("price_tick", ticks), **limits)
    latest, log = by_loop(opening, ticks)
    assert dict(rows_of(update.latest, "asset_id", "price")) == latest
    assert rows_of(update.history, "id", "asset_id", "price_pre", "price_post") == sorted(log, key=repr)
    return update


def test_rounding_is_half_away_from_zero():
    assert next_price(50, 1) == 51  # 50.5
    assert next_price(-50, 1) == -51
    assert next_price(100, -100) == 0
    assert next_price(100, -250) == -150
    assert next_price(10**20 - 1, 1) is None
    assert next_price(0, 10**14) is None


def test_ticks_in_order_of_time_then_id(spark, table):
    ticks = [tick(3, 5, 1, 10), tick(1, 5, 1, -10), tick(2, 1, 1, 7), tick(4, 0, 2, 50)]
    check(spark, table, {1: "10.01", 2: 3, 3: 4}, ticks)


def test_unknown_listing_and_overflow_are_rejected(spark, table):
    ticks = [tick(1, 0, 9, 5), tick(2, 1, 1, 10**14), tick(3, 2, 1, 900), tick(4, 3, 1, 5)]
    update = check(spark, table, {1: "60000000000000"}, ticks)
    assert rows_of(update.rejects, "key", "reason") == [
        ("1", "unknown listing"),
        ("2", "price out of range"),
        ("3", "price out of range"),
    ]


@pytest.mark.parametrize("spread", [(-10, 10), (-3, 4), (-1, 1)])
def test_hot_listing_in_pieces_equals_sequential_fold(spark, table, spread):
    rng = random.Random(3)
    ticks = [
        tick(i, rng.randint(0, 4000), rng.choice([1, 1, 1, 1, 2, 3, 7]), rng.randint(*spread))
        for i in range(1500)
    ]
    check(spark, table, {1: "99.5", 2: 1, 3: "0.000007"}, ticks, hot_ticks=100, piece_ticks=90)


def test_pieces_with_one_listing_only(spark, table):
    ticks = [tick(i, i // 3, 1, (i * 7) % 11 - 5) for i in range(400)]
    check(spark, table, {1: 500}, ticks, hot_ticks=10, piece_ticks=40)


def test_gate_drops_ticks_in_half_open_interval(spark, table):
    ticks = table("price_tick", [tick(i, m, 1, 1) for i, m in enumerate([9, 10, 70, 129, 130])])
    closed = table(
        "gate_closed",
        [
            ("C0", START + timedelta(minutes=10), START + timedelta(minutes=130)),
            ("C1", START, START + timedelta(days=2)),
        ],
    )
    assert rows_of(prices.gate_ticks(ticks, closed), "event_id") == [(0,), (4,)]


def test_gate_finds_the_interval_among_long_and_overlapping_ones(spark, table):
    draw = random.Random(5)
    minute = timedelta(minutes=1)
    closed = [("C0", START - 4000 * 1440 * minute, START - 900 * 1440 * minute), ("C1", START, START)]
    for _ in range(300):
        begin = START + draw.randrange(-50_000, 150_000) * minute
        length = draw.choice([-5, 0, 1, 3, 40, 60_000 if draw.random() < 0.05 else 7])
        closed.append((draw.choice(["C0", "C1"]), begin, begin + length * minute))
    at = [START + draw.randrange(-60_000, 210_000) * minute for _ in range(2000)]
    at += [bound for _, a, b in closed for bound in (a, b)]
    ticks = [(i, t, 1, "X", f"C{i % 3}", 1) for i, t in enumerate(at)]
    kept = {
        (i,)
        for i, t, _, _, curr, _ in ticks
        if not any(c == curr and a <= t < b for c, a, b in closed)
    }
    got = rows_of(prices.gate_ticks(table("price_tick", ticks), table("gate_closed", closed)), "event_id")
    assert 100 < len(kept) < len(ticks) - 100 and got == sorted(kept, key=repr)
    # Ten years are one row a month, however many hours they have.
    ten = table("gate_closed", [("C0", START, START + timedelta(days=3650))])
    assert prices.gate_index(ten).count() <= 121


def test_asof_uses_change_before_then_after_then_current(spark, table):
    listing = table("listing_price", [(a, "X", "C0", dec(a)) for a in (1, 2, 3)])
    history = table(
        "listing_price_history",
        [
            (1, 1, "X", "C0", START, dec(5), dec(6)),
            (2, 1, "X", "C0", START, dec(6), dec(7)),
            (3, 1, "X", "C0", START + timedelta(days=3), dec(7), dec(8)),
            (4, 2, "X", "C0", START + timedelta(days=3), dec(20), dec(21)),
        ],
    )
    at = prices.snapshot_asof(history, listing, "2024-01-02 00:00:00")
    assert rows_of(at, "asset_id", "price") == [(1, dec(7)), (2, dec(20)), (3, dec(3))]


def test_tick_job_moves_the_price_table(spark, table, tmp_path):
    folders = write_tables(
        {"listing_price": table("listing_price", [(1, "X", "C0", dec(10))])}, str(tmp_path / "0")
    )
    for n in (1, 2):
        folders = run_ticks(
            spark, folders, table("price_tick", [tick(n, n, 1, 10)]), str(tmp_path / str(n))
        )
    assert rows_of(read_table(spark, folders, "listing_price"), "price") == [(dec("12.1"),)]
    assert read_table(spark, folders, "listing_price_history").count() == 2


def test_runs_are_folded_as_one_by_one():
    rng = random.Random(11)
    for spread, top in [((-10, 10), 10**9), ((-300, 300), 10**4), ((-1, 1), 50), ((0, 900), 10**17), ((-10, 10**15), 10)]:
        sizes = [rng.choice([1, 2, 40, 700, 3000]) for _ in range(5)]
        openings = [rng.randint(-top, top) for _ in sizes]
        variances = [rng.randint(*spread) for _ in range(sum(sizes))]
        before, after, ends = fold_runs(openings, np.array(sizes), np.array(variances))
        at = 0
        for price, size, end in zip(openings, sizes, ends):
            for i in range(at, at + size):
                moved = next_price(price, variances[i])
                assert (before[i], after[i]) == (price, moved)
                price = price if moved is None else moved
            assert end == price
            at += size


@pytest.mark.parametrize("spread", [(-10, 10), (-2, 2), (-10, 11)])
def test_pieces_of_one_listing_agree_in_three_rounds(spark, table, spread):
    rng = random.Random(12)
    ticks = [tick(i, i, 1, rng.randint(*spread)) for i in range(4000)]
    listing = table("listing_price", [(1, "X", "C0", dec("912.34"))])
    order = [*LISTING, "ts", "event_id"]
    ranged = prices.priced_ticks(listing, table("price_tick", ticks)).repartitionByRange(8, *order)
    ranged = cut_lineage(ranged.sortWithinPartitions(*order).withColumn("piece", F.spark_partition_id()))
    opened, rounds = prices.piece_openings(ranged)
    price, wanted = int(dec("912.34") * MICRO), {}
    pieces = {r.event_id: r.piece for r in ranged.collect()}
    for event, _, _, _, _, variance in ticks:
        wanted.setdefault(pieces[event], price)
        moved = next_price(price, variance)
        price = price if moved is None else moved
    assert opened == wanted and len(opened) > 4 and rounds <= 3


def test_prices_at_many_moments(spark, table):
    rng = random.Random(13)
    listing = table("listing_price", [(a, "X", "C0", dec(a)) for a in range(1, 6)])
    ticks = [tick(i, rng.randint(0, 5000), rng.choice([1, 1, 1, 2, 3]), rng.randint(-9, 9)) for i in range(600)]
    update = prices.apply_ticks(listing, table("price_tick", ticks))
    moments = [(i, rng.choice([1, 1, 1, 2, 3, 4, 9]), "X", "C0", START + timedelta(minutes=rng.randint(-10, 5010))) for i in range(400)]
    asked = spark.createDataFrame(moments, "no long, asset_id long, exch_code string, curr_code string, at timestamp_ntz")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.no: r.price for r in prices.prices_at(asked, update.history, listing, "at").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    log = sorted(update.history.collect(), key=lambda r: (r.price_dt, r.id))
    for no, asset, _, _, at in moments:
        own = [r for r in log if r.asset_id == asset]
        upto = [r for r in own if r.price_dt <= at]
        want = upto[-1].price_post if upto else own[0].price_pre if own else dec(asset) if asset < 6 else None
        assert got[no] == want


def test_many_closings_are_merged_with_the_ticks(spark):
    draw = random.Random(8)
    second = timedelta(seconds=1)
    closed = [("C0", START, None), (None, START, START + 9000 * second), ("C1", START + second, START)]
    for _ in range(2000):
        begin = START + draw.randrange(-2000, 60_000) * second
        length = draw.choice([-5, 0, 1, 3, 4000 if draw.random() < 0.02 else 7])
        closed.append((draw.choice(["C0", "C1"]), begin, begin + length * second))
    at = [START + draw.randrange(-3000, 70_000) * second for _ in range(3000)]
    at += [bound for _, a, b in closed if b for bound in (a, b)] + [None]
    ticks = [(i, t, 1, "X", [None, "C0", "C1", "C2"][i % 4], 1) for i, t in enumerate(at)]
    ticks += ticks[:50]
    kept = [
        (i,)
        for i, t, _, _, curr, _ in ticks
        if t is None or not any(b and c == curr and a <= t < b for c, a, b in closed if c)
    ]
    tick_rows = spark.createDataFrame(
        ticks, "event_id long, ts timestamp_ntz, asset_id long, exch_code string, curr_code string, variance long"
    )
    closings = spark.createDataFrame(closed, "curr_code string, closed_from timestamp_ntz, closed_to timestamp_ntz")
    got = prices.gate_ticks(tick_rows, closings)
    assert got.dtypes == tick_rows.dtypes
    assert 100 < len(kept) < len(ticks) - 100 and rows_of(got, "event_id") == sorted(kept, key=repr)
    # No tick carries the closings of a month.
    assert "array" not in got._jdf.queryExecution().analyzed().toString()
